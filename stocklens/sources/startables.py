"""The input relations, derived from the star-schema test tables.

Only this module knows the test tables. Doubles with two decimals become
decimals, or whole hundredths where very many are summed, before any
arithmetic, so sums are exact. Columns are given as SQL expressions.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stocklens.sources.schemas import conform

# Columns of the test tables.
COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "part": """p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,
        p_retailprice double""",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_quantity double, l_extendedprice double, l_discount double, l_tax double,
        l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""",
    "events": "ts timestamp_ntz, user_id bigint, event_type string, value double",
}

# Codes and dates of the derived relations.
AVAILABLE_FROM = {0: "1753-01-01", 1: "2000-05-01", 2: "2000-07-01"}
STATUS_OF_TYPE = {
    "STANDARD": "Basis",
    "PROMO": "Limitiert",
    "SMALL": "Ex",
    "LARGE": "OneShot",
}
ORDER_TYPE_OF_PRIORITY = {"1-URGENT": "AKT-1", "5-LOW": "GWP", "4-NOT SPECIFIED": None}
PURCHASE_STATUS_OF_ORDER = {"F": "5", "P": "6", "O": "1"}
OPEN_END = "9999-12-31 23:59:59"
VISIT_SHIFT_DAYS = 8614
NATIONS_WITH_CODE = 20


def _money(name: str) -> str:
    return f"CAST({name} AS decimal(12,2))"


def _hundredths(name: str) -> str:
    return f"CAST(rint({name} * 100) AS bigint)"


def _scaled(total: str, digits: int) -> str:
    """A whole number of units of ``10 ** -digits`` as a decimal."""
    return f"CAST({total} AS decimal(20,0)) * {10 ** -digits:.{digits}f}BD"


def _literal(value: int | str | None) -> str:
    return "NULL" if value is None else repr(value)


def _lookup(column: str, values: dict, default: str = "NULL") -> str:
    cases = " ".join(f"WHEN {_literal(k)} THEN {_literal(v)}" for k, v in values.items())
    return f"CASE {column} {cases} ELSE {default} END"


PURCHASE_NUMBER = "concat('EBE', lpad(CAST(l_orderkey AS string), 8, '0'))"
SUPPLIER = "CAST(l_suppkey AS string)"
MONDAY = "date_sub(CAST(l_shipdate AS date), weekday(CAST(l_shipdate AS date)))"


@dataclass(frozen=True)
class StarTables:
    """Relations over the parquet files in one directory, each built once."""

    spark: SparkSession
    path: str
    extra: tuple[str, ...] = ()  # further columns of the management report

    def _read(self, table: str) -> DataFrame:
        # With its columns given, opening a table runs no job.
        return self.spark.read.schema(COLUMNS[table]).parquet(f"{self.path}/{table}.parquet")

    @cached_property
    def _lines_with_orders(self) -> DataFrame:
        return self._read("lineitem").join(
            self._read("orders"), F.col("l_orderkey") == F.col("o_orderkey")
        )

    @cached_property
    def dim_product(self) -> DataFrame:
        return conform(
            self._read("part").selectExpr(
                "p_partkey AS product_skey",
                "CAST(p_partkey AS string) AS product_id",
                "concat('EAN', p_partkey) AS ean",
                "p_name AS product_name",
                f"{_lookup('p_partkey % 4', AVAILABLE_FROM)} AS available_again_from",
                "concat('NATION_', p_partkey % 25) AS division_id",
                "p_size - 10 AS quantity_instock",
                "p_brand AS manufacturer_item_no",
                _lookup("p_type", STATUS_OF_TYPE, "'Archiv'") + " AS product_status",
                "date_add(DATE '1999-01-01', 12 * p_size) AS release_date",
                "if(p_partkey % 3 = 0, 'deactivated', 'activated') AS shop_activity_status",
                "'activated' AS shop_activity_status_config",
                "if(p_partkey % 5 = 0, 'Katalog, Suche', 'Einzeln nicht sichtbar')"
                " AS shop_visibility",
                "if(p_partkey % 7 = 0, 'x', 'Katalog, Suche') AS shop_visibility_config",
            ),
            "dim_product",
        )

    @cached_property
    def fact_purchase(self) -> DataFrame:
        suppliers = self._read("supplier").select("s_suppkey", "s_nationkey")
        return conform(
            self._lines_with_orders.join(
                suppliers, F.col("l_suppkey") == F.col("s_suppkey")
            ).selectExpr(
                f"{PURCHASE_NUMBER} AS purchase_id",
                f"{PURCHASE_NUMBER} AS purchase_receipt_id",
                "l_partkey AS product_skey",
                "s_nationkey AS division_skey",
                _lookup("o_orderpriority", ORDER_TYPE_OF_PRIORITY, "'STD'") + " AS order_type",
                _lookup("o_orderstatus", PURCHASE_STATUS_OF_ORDER) + " AS purchase_status",
                "o_orderdate AS purchase_order_date",
                "o_orderdate + make_dt_interval(l_linenumber) AS expected_receipt_date",
                f"if(l_linestatus = 'O', {_money('l_quantity')} - 5, 0) AS outstanding_quantity",
            ),
            "fact_purchase",
        )

    @cached_property
    def item_ledger(self) -> DataFrame:
        return conform(
            self._read("lineitem").selectExpr(
                "CAST(l_partkey AS string) AS item_no",
                f"{_money('l_quantity')} - 5 AS remaining_quantity",
                f"{PURCHASE_NUMBER} AS document_no",
                "if(l_returnflag = 'A', 'MARK_WE', 'HL') AS location_code",
                "if(l_tax = 0.08D, 'true', 'false') AS delete_flag",
                "if(l_linestatus = 'O', '0', '1') AS entry_type",
            ),
            "item_ledger",
        )

    @cached_property
    def hub_vendor_division(self) -> DataFrame:
        return conform(
            self._read("customer").selectExpr(
                "c_custkey AS vendor_division_hashkey", "c_name AS no_"
            ),
            "hub_vendor_division",
        )

    @cached_property
    def sat_vendor_division(self) -> DataFrame:
        """Each order is valid until the customer's next one.

        The window runs over a customer's distinct order days. Within a day
        every order but the last ends on that same day.
        """
        orders = self._read("orders")
        by_day = Window.partitionBy("o_custkey").orderBy("o_orderdate")
        order_days = (
            orders.groupBy("o_custkey", "o_orderdate")
            .agg(F.max("o_orderkey").alias("last_key"))
            .withColumn("next_day", F.lead("o_orderdate", 1).over(by_day))
        )
        return conform(
            orders.join(order_days, ["o_custkey", "o_orderdate"]).selectExpr(
                "o_custkey AS vendor_division_hashkey",
                "o_orderpriority AS name",
                "if(o_orderstatus = 'F', 'true', 'false') AS delete_flag",
                f"if(o_orderkey = last_key, coalesce(next_day, TIMESTAMP_NTZ '{OPEN_END}'),"
                " o_orderdate) AS valid_to",
            ),
            "sat_vendor_division",
        )

    @cached_property
    def fact_sales(self) -> DataFrame:
        return conform(
            self._lines_with_orders.selectExpr(
                "l_partkey AS product_skey",
                f"{_money('l_quantity')} AS quantity",
                "o_orderdate AS order_date",
            ),
            "fact_sales",
        )

    @cached_property
    def supplier_leadtime(self) -> DataFrame:
        """Average line number per nation and year, counted per supplier first."""
        per_supplier = (
            self._lines_with_orders.groupBy("l_suppkey", F.year("o_orderdate").alias("jahr"))
            .agg(F.sum("l_linenumber").alias("total"), F.count("l_linenumber").alias("n"))
        )
        return conform(
            per_supplier.join(
                self._read("supplier"), F.col("l_suppkey") == F.col("s_suppkey")
            )
            .join(self._read("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .groupBy(F.col("n_name").alias("division_id"), "jahr")
            .agg((F.sum("total") / F.sum("n")).alias("booking_lt_avg")),
            "supplier_leadtime",
        )

    @cached_property
    def dim_division(self) -> DataFrame:
        return conform(
            self._read("nation")
            .join(self._read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .selectExpr(
                "n_nationkey AS division_skey", "n_name AS division_id", "r_name AS supplier_name"
            ),
            "dim_division",
        )

    @cached_property
    def purchase_line_archive(self) -> DataFrame:
        return conform(
            self._read("lineitem").selectExpr(
                "CAST(l_partkey % 50 AS string) AS no_",
                "CAST(l_orderkey AS string) AS document_no",
                "l_linenumber AS version_no",
                f"{_money('l_quantity')} - 10 AS quantity",
                "l_tax = 0.08D AS delete_flag",
            ),
            "purchase_line_archive",
        )

    @cached_property
    def purchase_header_archive(self) -> DataFrame:
        return conform(
            self._read("orders").selectExpr(
                "CAST(o_orderkey AS string) AS no",
                "o_orderdate AS order_date",
                "o_orderstatus = 'F' AS delete_flag",
            ),
            "purchase_header_archive",
        )

    @cached_property
    def daily_forecast(self) -> DataFrame:
        return conform(
            self._read("lineitem").selectExpr(
                "CAST(l_partkey AS string) AS product_id",
                "CAST(l_shipdate AS date) AS calendar_date",
                f"{_money('l_quantity')} * (1 - {_money('l_discount')}) AS snop_daily_forecast",
            ),
            "daily_forecast",
        )

    @cached_property
    def visits_per_sku(self) -> DataFrame:
        return conform(
            self._read("events")
            .where("event_type = 'view'")
            .selectExpr(
                "CAST(user_id AS string) AS product_id",
                f"date_sub(CAST(ts AS date), {VISIT_SHIFT_DAYS}) AS visit_date",
                f"{_money('value')} AS oos_visits",
            ),
            "visits_per_sku",
        )

    @cached_property
    def division_ek_code(self) -> DataFrame:
        return conform(
            self._read("nation")
            .where(f"n_nationkey < {NATIONS_WITH_CODE}")
            .selectExpr("n_name AS division_id", "concat('EK', n_regionkey) AS ek_code"),
            "division_ek_code",
        )

    def _supplier_weeks(self, **totals: str) -> DataFrame:
        """Totals per supplier and ISO week."""
        return (
            self._read("lineitem")
            .groupBy(
                F.expr(SUPPLIER).alias("product_id"), F.expr(MONDAY).alias("week_start_date")
            )
            .agg(*[F.expr(total).alias(name) for name, total in totals.items()])
        )

    @cached_property
    def weekly_history(self) -> DataFrame:
        """One row per supplier and week."""

        def units(condition: str) -> str:
            return _scaled(f"sum(if({condition}, {_hundredths('l_quantity')}, 0))", 2)

        return conform(
            self._supplier_weeks(
                net_qty=units("l_returnflag <> 'R'"),
                bulk_order_qty=units("l_quantity >= 40"),
                outlier_correction_qty=units("l_discount >= 0.08D"),
                oos_correction_qty=units("l_tax = 0"),
            ),
            "weekly_history",
        )

    @cached_property
    def base_history(self) -> DataFrame:
        """Two snapshots per supplier and week: at its start and one week before."""
        base = f"{_hundredths('l_quantity')} * (100 - {_hundredths('l_discount')})"
        tax = _hundredths("l_tax")
        weeks = self._supplier_weeks(
            forecast_quantity=_scaled(f"sum({base})", 4),
            sku_uplift=_scaled(f"sum(if(l_linestatus = 'O', {tax}, 0))", 2),
            after=f"CAST({_scaled(f'sum({base} * (100 + {tax}))', 6)} AS decimal(18,4))",
            top_down_adjustment="max(l_linenumber) - 5",
            top_factor=_scaled(f"100 + max({tax})", 2),
        )
        return conform(
            weeks.withColumn("lag_weeks", F.explode(F.array(F.lit(0), F.lit(1)))).selectExpr(
                "*",
                "date_sub(week_start_date, 7 * lag_weeks) AS as_of_date",
                "after AS forecast_quantity_after_uplifts_before_adjustment",
                "CAST(after * top_factor AS decimal(28,10)) AS married_forecast_quantity",
            ),
            "base_history",
        )

    @cached_property
    def daily_forecast_by_business_id(self) -> DataFrame:
        return conform(
            self._read("lineitem").selectExpr(
                "l_partkey AS productbusinessid",
                "CAST(l_shipdate AS date) AS calendar_date",
                f"{_money('l_quantity')} AS daily_married_forecast",
            ),
            "daily_forecast_by_business_id",
        )

    @cached_property
    def product(self) -> DataFrame:
        return conform(
            self._read("part").selectExpr(
                "p_partkey AS productbusinessid", "p_retailprice AS unitcost"
            ),
            "product",
        )

    @cached_property
    def management_report_daily(self) -> DataFrame:
        parts = self._read("part").select("p_partkey", "p_name", "p_retailprice", "p_brand", "p_type")
        sales = f"{_money('l_extendedprice')} * (1 - {_money('l_discount')})"
        return conform(
            self._lines_with_orders.join(
                parts, F.col("l_partkey") == F.col("p_partkey")
            ).selectExpr(
                "p_name AS productname",
                "p_partkey AS productbusinessid",
                "o_orderdate AS snapshot_day",
                f"{_money('l_quantity')} AS ordered_qty",
                f"{sales} AS invoiced_sales_ad",
                f"{sales} - {_money('p_retailprice')} * {_money('l_quantity')} AS invoiced_db3_ad",
                "p_brand AS brand",
                "p_type AS division",
            ),
            "management_report_daily",
            self.extra,
        )
