"""Stockouts, the active assortment and its turnover clusters."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocklens.constants import (
    ASSORTMENT_STATUSES,
    LAST_VALID_DAY,
    SHOP_ACTIVE,
    SHOP_VISIBILITY,
    SHOP_VISIBILITY_CONFIG,
    STOCKOUT_STATUSES,
    TURNOVER_CUTS,
    TURNOVER_LETTERS,
)
from stocklens.functions.quantities import Amount, contains_any, is_positive
from stocklens.functions.timewin import moment

# Quantities that share all but their lowest bits form one bucket, so a bucket
# holds at most 2**BUCKET_BITS distinct quantities.
BUCKET_BITS = 20

# Purchase groups of a product that meet its row in one part.
GROUPS_IN_PART = 100_000


def stockout_products(dim_product: DataFrame) -> DataFrame:
    """Products in the regular or limited range with no stock left."""
    return dim_product.where(
        (F.col("quantity_instock") <= 0) & F.col("product_status").isin(*STOCKOUT_STATUSES)
    ).select(
        "product_id",
        "ean",
        "product_name",
        F.to_date("available_again_from").alias("available_again_from"),
        "division_id",
        F.col("quantity_instock").alias("lagerbestand"),
        "manufacturer_item_no",
    )


def vendor_division_current(hub: DataFrame, satellite: DataFrame) -> DataFrame:
    """Current, undeleted name of each vendor division."""
    current = satellite.where(
        (F.col("delete_flag") == "false") & (F.col("valid_to") > moment(LAST_VALID_DAY))
    ).select("vendor_division_hashkey", "name")
    keys = hub.select("vendor_division_hashkey", "no_")
    return keys.join(current, "vendor_division_hashkey").select("no_", "name")


def _best_groups(on_order: DataFrame) -> DataFrame:
    """Largest group of each product, a missing quantity as 0, and how many it has."""
    return (
        on_order.where(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(
            F.max(F.coalesce("outstanding_quantity_external", F.lit(0))).alias("best_external"),
            F.count(F.lit(1)).alias("n_groups"),
        )
    )


def _candidates(
    dim_product: DataFrame,
    best: DataFrame,
    internal: DataFrame,
    units: DataFrame,
    as_of: dt.datetime,
) -> DataFrame:
    """Released products with their shop state, stock and columns of ``best``."""
    # A product qualifies through any one purchase group, so the largest decides.
    instock = Amount.of(dim_product, "quantity_instock").column
    released = dim_product.where(
        contains_any(F.col("product_status"), ASSORTMENT_STATUSES)
        & (F.to_date("release_date") <= F.lit(as_of.date()))
    ).select(
        "product_id",
        "product_status",
        F.coalesce(
            (F.col("shop_activity_status") == SHOP_ACTIVE)
            & (F.col("shop_activity_status_config") == SHOP_ACTIVE)
            & (F.col("shop_visibility") == SHOP_VISIBILITY)
            & (F.col("shop_visibility_config") == SHOP_VISIBILITY_CONFIG),
            F.lit(False),
        ).alias("in_shop"),
        F.coalesce(instock, F.lit(0)).alias("instock"),
    )
    inbound = internal.select(
        F.col("item_no").alias("product_id"),
        F.col("outstanding_quantity_internal").alias("inbound"),
    )
    return (
        released.join(best, "product_id", "left")
        .join(inbound, "product_id", "left")
        .join(units, "product_id", "left")
        .select(
            "product_id",
            "product_status",
            F.coalesce("sold_qty_ytd", F.lit(0)).alias("sold_qty_ytd"),
            "in_shop",
            "instock",
            F.coalesce("inbound", F.lit(0)).alias("inbound"),
            *[c for c in best.columns if c != "product_id"],
        )
    )


def _is_member(external: str | None) -> Column:
    """In the shop, or something of it on hand or on order."""
    amounts = [F.col("instock"), F.col("inbound")]
    if external:
        amounts.append(F.coalesce(external, F.lit(0)))
    return F.col("in_shop") | is_positive(amounts)


def members_by_best_group(
    dim_product: DataFrame,
    best: DataFrame,
    internal: DataFrame,
    units: DataFrame,
    as_of: dt.datetime,
) -> DataFrame:
    """The active assortment, one row per product row.

    ``best`` has product_id and best_external, see ``largest_purchase_group``.
    """
    best = best.select("product_id", "best_external")
    return (
        _candidates(dim_product, best, internal, units, as_of)
        .where(_is_member("best_external"))
        .select("product_id", "product_status", "sold_qty_ytd")
    )


def assortment_members(
    dim_product: DataFrame,
    on_order: DataFrame,
    internal: DataFrame,
    units: DataFrame,
    as_of: dt.datetime,
) -> DataFrame:
    """The active assortment, one row per product row, from its purchase groups."""
    return members_by_best_group(dim_product, _best_groups(on_order), internal, units, as_of)


def assortment_base(
    dim_product: DataFrame,
    on_order: DataFrame,
    internal: DataFrame,
    units: DataFrame,
    as_of: dt.datetime,
    groups_in_part: int = GROUPS_IN_PART,
) -> DataFrame:
    """The active assortment, one row per qualifying purchase group.

    Products without purchases have one row and are added beside the others.
    The groups of a product with more than ``groups_in_part`` are dealt into as
    many parts as that takes, and only its row is repeated, once for each part.
    Largest group and number of groups come from one aggregate, which all sides
    that use either of them share.
    """
    best = _best_groups(on_order)
    candidates = _candidates(dim_product, best, internal, units, as_of)
    result = ["product_id", "product_status", "sold_qty_ytd"]
    alone = candidates.where(F.col("best_external").isNull() & F.col("n_groups").isNull()).where(
        _is_member(None)
    )
    n_parts = F.ceil(F.col("n_groups") / groups_in_part)
    # no group is without a largest quantity, but asking for it keeps the aggregate the same
    large = best.where(
        (F.col("n_groups") > groups_in_part) & F.col("best_external").isNotNull()
    ).select("product_id", n_parts.alias("n_parts"))
    hashed = F.xxhash64(*on_order.columns)
    groups = (
        on_order.where(F.col("product_id").isNotNull())
        .select(
            "product_id",
            hashed.alias("hashed"),
            F.coalesce("outstanding_quantity_external", F.lit(0)).alias("external"),
        )
        .join(large, "product_id", "left")
        .select(
            "product_id",
            F.pmod("hashed", F.coalesce("n_parts", F.lit(1).cast("bigint"))).alias("part"),
            "external",
        )
    )
    repeated = candidates.where(
        F.col("n_groups").isNotNull() & _is_member("best_external")
    ).withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), n_parts - 1)))
    grouped = groups.join(repeated, ["product_id", "part"]).where(_is_member("external"))
    return grouped.select(result).unionAll(alone.select(result))


def _running_totals(skus: DataFrame) -> DataFrame:
    """Running and grand total per distinct quantity, from the largest down.

    Equal quantities share one total. Totals run inside buckets of the
    quantity, and a bucket starts from the sum of all buckets above it. The
    only unpartitioned window is over the buckets: with quantities >= 0 that
    sum up to T there are at most sqrt(2 * T / 2**BUCKET_BITS) + 1 of them.
    """
    peers = (
        skus.groupBy("sold_qty_ytd")
        .agg(F.sum("sold_qty_ytd").alias("peer_total"))
        .withColumn("bucket", F.shiftright("sold_qty_ytd", BUCKET_BITS))
    )
    downward = Window.orderBy(F.desc("bucket"))
    buckets = peers.groupBy("bucket").agg(F.sum("peer_total").alias("bucket_total"))
    offsets = buckets.select(
        "bucket",
        (F.sum("bucket_total").over(downward) - F.col("bucket_total")).alias("above"),
        F.sum("bucket_total").over(Window.partitionBy()).alias("total_sales_ytd"),
    )
    inside = Window.partitionBy("bucket").orderBy(F.desc("sold_qty_ytd"))
    return peers.join(offsets, "bucket").select(
        "sold_qty_ytd",
        (F.col("above") + F.sum("peer_total").over(inside)).alias("cumulative_sales_ytd"),
        "total_sales_ytd",
    )


def abc_clustering(
    assortment: DataFrame, cuts: Sequence[float] = TURNOVER_CUTS
) -> DataFrame:
    """Turnover cluster per product by cumulative share of units sold.

    ``sold_qty_ytd`` holds whole units and no nulls. If nothing was sold the
    share is null and every product falls into the last cluster.
    """
    skus = assortment.select("product_id", "product_status", "sold_qty_ytd").distinct()
    share = F.col("cumulative_percentage_ytd")
    first, second, third, last = TURNOVER_LETTERS
    return (
        skus.join(_running_totals(skus), "sold_qty_ytd")
        .withColumn(
            "cumulative_percentage_ytd",
            F.try_divide(
                F.col("cumulative_sales_ytd").cast("double"),
                F.col("total_sales_ytd").cast("double"),
            ),
        )
        .select(
            "product_id",
            "product_status",
            "sold_qty_ytd",
            "cumulative_sales_ytd",
            "total_sales_ytd",
            "cumulative_percentage_ytd",
            F.when(share <= cuts[0], first)
            .when(share <= cuts[1], second)
            .when(share <= cuts[2], third)
            .otherwise(last)
            .alias("turnover_rate_cluster"),
        )
    )
