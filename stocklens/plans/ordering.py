"""The ordering list: fast sellers that are out of stock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocklens.functions.labels import availability_label
from stocklens.functions.timewin import plus_days


def ordering_master(
    stockouts: DataFrame,
    clusters: DataFrame,
    oldest: DataFrame,
    leadtimes: DataFrame,
    zero_orders: DataFrame,
    last_days: DataFrame,
    next_days: DataFrame,
    visits: DataFrame,
    dim_division: DataFrame,
    ek_codes: DataFrame,
    as_of: dt.datetime,
) -> DataFrame:
    """One distinct row per out-of-stock A or B product and purchase combination.

    ``oldest`` holds the oldest purchases of both kinds per product. Quantities
    on order are not an input: nothing of them is returned, and rows are
    distinct. The cluster comes first, as it drops most products;
    inputs are cut to the columns returned and made distinct before they are
    joined, product inputs before division inputs so that one partitioning on
    the product serves them all.
    """
    fast = (
        clusters.where(F.col("turnover_rate_cluster").isin("A", "B"))
        .select("product_id", "turnover_rate_cluster")
        .distinct()
    )
    leads = leadtimes.select("division_id", F.col("booking_lt_avg").alias("lead")).distinct()
    divisions = dim_division.select("division_id", "supplier_name").distinct()
    codes = ek_codes.select("division_id", "ek_code").distinct()

    rows = stockouts.join(fast, "product_id")
    for part in (zero_orders, oldest, last_days, next_days, visits):
        rows = rows.join(part, "product_id", "left")
    for part in (leads, divisions, codes):
        rows = rows.join(part, "division_id", "left")
    return rows.select(
        "product_id",
        "turnover_rate_cluster",
        "ek_code",
        "ean",
        "manufacturer_item_no",
        "product_name",
        availability_label(F.col("available_again_from"), as_of).alias("available_again_from"),
        "division_id",
        "supplier_name",
        "zero_order_delivery",
        "oldest_ebe_external",
        plus_days(F.col("order_date_oldest_po"), F.col("lead")).alias("lieferdatum_o_ebe_ex"),
        "oldest_ebe_internal",
        F.coalesce("sold_qty_7days", F.lit(0)).alias("sold_units_7days"),
        "fcst_7days",
        F.round("oos_visits", 0).cast("bigint").alias("oos_visits_yesterday"),
    ).distinct()
