"""Every query by name, over the star-schema test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocklens.plans.reports import ReportDates, Reports
from stocklens.session import tune
from stocklens.sources.startables import StarTables

# Report dates suited to the test tables.
TEST_DATES = ReportDates(
    as_of=dt.datetime(2000, 6, 15, 10),
    ytd_start=dt.date(2000, 1, 1),
    leadtime_year="2000",
    sales_since=dt.date(2000, 1, 1),
)
TEST_BRAND = "Brand#13"

NAMES = (
    "stockout_products",
    "purchase_open_qty",
    "order_type_base",
    "inbound_open_internal",
    "inbound_open_internal_incl_akt",
    "vendor_division_current",
    "units_ytd",
    "assortment_base",
    "abc_clustering",
    "oldest_po_min",
    "oldest_po_result",
    "oldest_po_min_internal",
    "leadtime",
    "oldest_po_result_internal",
    "latest_line_version",
    "zero_qty_lines",
    "zero_order_count",
    "units_last_days",
    "forecast_next_days",
    "forecast_next_days_calendar",
    "oos_visits",
    "ordering_master",
    "prior_week_bulk",
    "prior_week_outlier",
    "prior_week_oos",
    "prior_week_bulk_any_year",
    "prior_week_bulk_calendar",
    "prior_week_outlier_calendar",
    "prior_week_oos_calendar",
    "duplicate_weeks",
    "flag_bulk_order",
    "flag_uplift_low",
    "flag_top_down",
    "flag_oos",
    "flag_outlier",
    "forecast_mad",
    "forecast_mape",
    "forecast_monitor",
    "forecast_monitor_calendar",
    "forecast_horizons",
    "forecast_horizons_calendar",
    "sold_units_per_sku",
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def query(name: str) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, path: str) -> DataFrame:
            tables = StarTables(tune(spark), path)
            # the derived weekly history is grouped by product and week
            return getattr(Reports(tables, TEST_DATES, unique_weeks=True), name)()

        return run

    def brand(spark: SparkSession, path: str) -> DataFrame:
        tables = StarTables(tune(spark), path, extra=("brand", "division"))
        return Reports(tables, TEST_DATES).sold_units_of(F.col("brand") == TEST_BRAND)

    return {name: query(name) for name in NAMES} | {"sold_units_of_brand": brand}
