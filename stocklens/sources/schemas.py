"""Columns and types of the 18 input relations.

Quantities have ten decimals, so that small daily amounts survive until they
are summed. Days may carry a time. A timestamp with a zone becomes one without
in the time zone of the session.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The columns of each relation.
_DDL = {
    "dim_product": """product_skey bigint, product_id string, ean string, product_name string,
        available_again_from date, division_id string, quantity_instock decimal(28,10),
        manufacturer_item_no string, product_status string, release_date date,
        shop_activity_status string, shop_activity_status_config string,
        shop_visibility string, shop_visibility_config string""",
    "fact_purchase": """purchase_id string, purchase_receipt_id string, product_skey bigint,
        division_skey int, order_type string, purchase_status string,
        purchase_order_date timestamp_ntz, expected_receipt_date timestamp_ntz,
        outstanding_quantity decimal(28,10)""",
    "item_ledger": """item_no string, remaining_quantity decimal(28,10), document_no string,
        location_code string, delete_flag string, entry_type string""",
    "hub_vendor_division": "vendor_division_hashkey string, no_ string",
    "sat_vendor_division": """vendor_division_hashkey string, name string, delete_flag string,
        valid_to timestamp_ntz""",
    "fact_sales": "product_skey bigint, quantity decimal(28,10), order_date timestamp_ntz",
    "supplier_leadtime": "division_id string, jahr string, booking_lt_avg double",
    "dim_division": "division_skey int, division_id string, supplier_name string",
    "purchase_line_archive": """no_ string, document_no string, version_no int,
        quantity decimal(28,10), delete_flag boolean""",
    "purchase_header_archive": "no string, order_date timestamp_ntz, delete_flag boolean",
    "daily_forecast": """product_id string, calendar_date timestamp_ntz,
        snop_daily_forecast decimal(28,10)""",
    "visits_per_sku": "product_id string, visit_date timestamp_ntz, oos_visits decimal(28,10)",
    "division_ek_code": "division_id string, ek_code string",
    "weekly_history": """product_id string, week_start_date date, net_qty decimal(28,10),
        bulk_order_qty decimal(28,10), outlier_correction_qty decimal(28,10),
        oos_correction_qty decimal(28,10)""",
    "base_history": """product_id string, week_start_date date, as_of_date date,
        forecast_quantity decimal(28,10), sku_uplift decimal(28,10),
        forecast_quantity_after_uplifts_before_adjustment decimal(28,10),
        top_down_adjustment decimal(28,10), married_forecast_quantity decimal(28,10)""",
    "daily_forecast_by_business_id": """productbusinessid string, calendar_date timestamp_ntz,
        daily_married_forecast decimal(28,10)""",
    "product": "productbusinessid string, unitcost double",
    "management_report_daily": """productname string, productbusinessid string,
        snapshot_day timestamp_ntz, ordered_qty decimal(28,10),
        invoiced_sales_ad decimal(28,10), invoiced_db3_ad decimal(28,10)""",
}

RELATIONS = tuple(_DDL)


def schema(relation: str) -> T.StructType:
    return T.StructType.fromDDL(_DDL[relation])


def conform(df: DataFrame, relation: str, extra: Sequence[str] = ()) -> DataFrame:
    """Select and cast the columns of ``relation`` and take ``extra`` ones as they are.

    Other columns are left out. A decimal keeps its own type where it has more
    digits, in all or after the point, than the declared one.
    """
    kinds = {f.name.lower(): f.dataType for f in df.schema.fields}

    def cast(f: T.StructField) -> str:
        kind, own = f.dataType, kinds.get(f.name.lower())
        if isinstance(kind, T.DecimalType) and isinstance(own, T.DecimalType):
            kind = own if own.precision > kind.precision or own.scale > kind.scale else kind
        return f"CAST(`{f.name}` AS {kind.simpleString()}) AS {f.name}"

    return df.selectExpr(*map(cast, schema(relation)), *[f"`{name}`" for name in extra])
