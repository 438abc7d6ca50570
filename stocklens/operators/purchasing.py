"""Open purchase quantities, oldest open orders, lead times."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklens.constants import (
    CAMPAIGN_TYPE,
    GIFT_TYPE,
    INBOUND_LOCATION,
    LEADTIME_YEAR,
    PURCHASE_ENTRY,
    STATUS_CLOSED,
    STATUS_INTERNAL,
)
from stocklens.functions.quantities import Amount, contains_none
from stocklens.functions.timewin import plus_days


# What makes a purchase group, beside the product.
GROUP = ("purchase_id", "purchase_order_date", "expected_receipt_date", "order_type")


def purchase_open_qty(fact_purchase: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Outstanding quantity per product and purchase.

    Nothing is filtered: closed and negative lines count, and lines without a
    product form groups with a null ``product_id``.
    """
    products = dim_product.select("product_skey", "product_id")
    total = Amount.of(fact_purchase, "outstanding_quantity").total()
    return (
        fact_purchase.join(products, "product_skey", "left")
        .groupBy("product_id", *GROUP)
        .agg(total.alias("outstanding_quantity_external"))
    )


def purchase_groups(fact_purchase: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Purchase lines summed per product, purchase, dates, type and status; open ones apart.

    What the ordering list needs of purchases beside their order types. Lines
    are dealt by product and purchase, which every further grouping here keeps
    to; and every use needs all the columns, so Spark computes them once for all.
    """
    amount = Amount.of(fact_purchase, "outstanding_quantity")
    is_open = F.col("outstanding_quantity") > 0
    products = dim_product.select("product_skey", "product_id").where("product_id IS NOT NULL")
    return (
        fact_purchase.join(products, "product_skey")
        .select("product_id", *GROUP, "purchase_status", "outstanding_quantity")
        .repartition("product_id", "purchase_id")
        .groupBy("product_id", *GROUP, "purchase_status", is_open.alias("is_open"))
        .agg(amount.summed().alias("outstanding"))
        .select("*", amount.value(F.col("outstanding")).isNotNull().alias("has_quantity"))
    )


def largest_purchase_group(groups: DataFrame, fact_purchase: DataFrame) -> DataFrame:
    """Largest outstanding quantity of any one purchase of each product, at least a 0 for unknown."""
    amount = Amount.of(fact_purchase, "outstanding_quantity")
    total = amount.value(amount.again("outstanding"))
    return (
        groups.groupBy("product_id", *GROUP)
        .agg(total.alias("external"))
        .groupBy("product_id")
        .agg(F.max(F.coalesce("external", F.lit(0))).alias("best_external"))
    )


def order_type_base(fact_purchase: DataFrame) -> DataFrame:
    """Order type of every purchase line, one row per line."""
    return fact_purchase.select("purchase_receipt_id", "order_type")


def inbound_open_internal(
    item_ledger: DataFrame,
    order_types: DataFrame,
    exclude: Sequence[str] = (CAMPAIGN_TYPE, GIFT_TYPE),
) -> DataFrame:
    """Quantity in goods receipt per item, counted once per matching purchase line.

    The matching lines are counted per receipt and type before the join, so a
    document with many ledger rows and many lines never expands into pairs.
    """
    kinds = (
        order_types.where(contains_none(F.col("order_type"), exclude))
        .groupBy("purchase_receipt_id", "order_type")
        .agg(F.count(F.lit(1)).alias("n_lines"))
    )
    received = item_ledger.where(
        (F.col("location_code") == INBOUND_LOCATION)
        & (F.col("remaining_quantity") > 0)
        & (F.col("delete_flag") == "false")
        & (F.col("entry_type") == PURCHASE_ENTRY)
    ).select("item_no", "document_no", "remaining_quantity")
    total = Amount.of(received, "remaining_quantity").total_times(F.col("n_lines"))
    return (
        received.join(kinds, F.col("document_no") == F.col("purchase_receipt_id"))
        .groupBy("item_no")
        .agg(total.cast("decimal(18,2)").alias("outstanding_quantity_internal"))
    )


def _external() -> Column:
    return ~F.col("purchase_status").isin(STATUS_CLOSED, STATUS_INTERNAL)


def _internal() -> Column:
    return F.col("purchase_status") == STATUS_INTERNAL


def _oldest(
    fact_purchase: DataFrame, dim_product: DataFrame, kinds: Mapping[str, Column]
) -> DataFrame:
    """Smallest open purchase id per product, one column per kind of purchase."""
    # The minimum per surrogate key comes first, so each key meets the
    # product table once however many purchase lines it has.
    per_key = (
        fact_purchase.where(
            (F.col("outstanding_quantity") > 0)
            & reduce(or_, kinds.values())
            & contains_none(F.col("order_type"), [CAMPAIGN_TYPE])
        )
        .groupBy("product_skey")
        .agg(*[F.min(F.when(kind, F.col("purchase_id"))).alias(n) for n, kind in kinds.items()])
    )
    products = dim_product.select("product_skey", F.col("product_id").alias("sku"))
    return (
        per_key.join(products, "product_skey", "left")
        .groupBy("sku")
        .agg(*[F.min(n).alias(n) for n in kinds])
    )


def oldest_po_min(fact_purchase: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Smallest id among a product's open external purchases, in text order."""
    return _oldest(fact_purchase, dim_product, {"ebe": _external()})


def oldest_po_min_internal(fact_purchase: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Smallest id among a product's open internal purchases, in text order."""
    return _oldest(fact_purchase, dim_product, {"ebe": _internal()})


def _lines_of(fact_purchase: DataFrame, dim_product: DataFrame, oldest: DataFrame) -> DataFrame:
    """Open lines of each product's oldest purchase, gift lines left out."""
    # The oldest id is spread to the product's surrogate keys, and lines are
    # met on purchase and key together: no shuffle on the product alone.
    wanted = dim_product.select("product_skey", "product_id").join(
        oldest.withColumnRenamed("sku", "product_id"), "product_id"
    )
    lines = fact_purchase.where(
        (F.col("outstanding_quantity") > 0) & contains_none(F.col("order_type"), [GIFT_TYPE])
    )
    return lines.withColumnRenamed("purchase_id", "ebe").join(wanted, ["product_skey", "ebe"])


def oldest_po_result(
    fact_purchase: DataFrame, dim_product: DataFrame, oldest: DataFrame
) -> DataFrame:
    """Open quantity and attributes of each product's oldest external purchase.

    A product whose oldest purchase is a gift order has no row here.
    """
    total = Amount.of(fact_purchase, "outstanding_quantity").total()
    return (
        _lines_of(fact_purchase, dim_product, oldest)
        .groupBy("product_id", "ebe", "order_type", "purchase_status", "purchase_order_date")
        .agg(F.coalesce(total, F.lit(0)).alias("open_qty_oldest_po"))
        .select(
            "product_id",
            "ebe",
            "order_type",
            F.col("purchase_status").alias("delivery_status"),
            "open_qty_oldest_po",
            F.to_date("purchase_order_date").alias("order_date_oldest_po"),
        )
    )


def leadtime(supplier_leadtime: DataFrame, year: str = LEADTIME_YEAR) -> DataFrame:
    """Average booking lead time per division in one year; duplicates stay."""
    return supplier_leadtime.where(F.col("jahr") == year).select("division_id", "booking_lt_avg")


def oldest_po_result_internal(
    fact_purchase: DataFrame,
    dim_product: DataFrame,
    oldest: DataFrame,
    dim_division: DataFrame,
    leadtimes: DataFrame,
) -> DataFrame:
    """Attributes of each product's oldest internal purchase.

    Rows are distinct over receipt date, order time and expected delivery as
    well, which are not returned; so equal rows can appear.
    """
    divisions = dim_division.select("division_skey", "division_id").distinct()
    leads = leadtimes.select("division_id", F.col("booking_lt_avg").alias("lead")).distinct()
    order_day = F.to_date("purchase_order_date")
    return (
        _lines_of(fact_purchase, dim_product, oldest)
        .where(_internal())
        .join(divisions, "division_skey", "left")
        .join(leads, "division_id", "left")
        .select(
            "product_id",
            "ebe",
            "order_type",
            F.col("purchase_status").alias("delivery_status"),
            order_day.alias("order_date_oldest_po"),
            "purchase_order_date",
            "expected_receipt_date",
            plus_days(order_day, F.col("lead")).alias("expected_delivery"),
        )
        .distinct()
        .select("product_id", "ebe", "order_type", "delivery_status", "order_date_oldest_po")
    )


def oldest_po_both(
    fact_purchase: DataFrame, dim_product: DataFrame, groups: DataFrame | None = None
) -> DataFrame:
    """Oldest external and internal purchase of each product, side by side.

    What the two detail lists give a report that needs only the ids and the
    external order day. ``groups`` are the ``purchase_groups``, where the report
    has them already. Conditions on a group's type
    and status are aggregated, not filtered, so that the search for the oldest
    and its details take the same groups. A product has one row per order day
    of its oldest external purchase.
    """
    groups = purchase_groups(fact_purchase, dim_product) if groups is None else groups
    # one condition on both columns: anything that follows for is_open alone would
    # move below the grouping, and the groups would be computed once more for this use
    both = F.col("is_open").cast("int") + F.col("has_quantity").cast("int")
    groups = groups.where(both.eqNullSafe(F.lit(2)))
    no_campaign = contains_none(F.col("order_type"), [CAMPAIGN_TYPE])
    no_gift = contains_none(F.col("order_type"), [GIFT_TYPE])

    def smallest(kind: Column) -> Column:
        return F.min(F.when(no_campaign & kind, F.col("purchase_id")))

    oldest = groups.groupBy("product_id").agg(
        smallest(_external()).alias("ext"), smallest(_internal()).alias("int")
    )
    kinds = F.array(
        F.struct(F.col("ext").alias("ebe"), F.lit(False).alias("is_internal")),
        F.struct(F.col("int").alias("ebe"), F.lit(True).alias("is_internal")),
    )
    wanted = oldest.select(F.col("product_id").alias("sku"), F.inline(kinds)).where(
        F.col("ebe").isNotNull()
    )
    is_detail = no_gift & (~F.col("is_internal") | _internal())
    details = (
        groups.join(
            wanted,
            (F.col("product_id") == F.col("sku")) & F.col("purchase_id").eqNullSafe(F.col("ebe")),
        )
        .groupBy(
            "product_id",
            "ebe",
            "is_internal",
            F.when(~F.col("is_internal"), F.to_date("purchase_order_date")).alias("order_day"),
        )
        .agg(F.bool_or(is_detail).alias("has_detail"))
        .where("has_detail")
    )
    external = details.where(~F.col("is_internal")).select(
        "product_id",
        F.col("ebe").alias("oldest_ebe_external"),
        F.col("order_day").alias("order_date_oldest_po"),
    )
    internal = details.where("is_internal").select(
        "product_id", F.col("ebe").alias("oldest_ebe_internal")
    )
    return external.join(internal, "product_id", "full_outer").select(
        "product_id", "oldest_ebe_internal", "oldest_ebe_external", "order_date_oldest_po"
    )
