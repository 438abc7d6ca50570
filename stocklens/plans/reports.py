"""Every operator applied to a set of tables, one method per result.

``tables`` has the 18 relations as attributes: ``NamedTables`` reads them from
the session catalog, ``StarTables`` derives them from the test tables.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklens.constants import GIFT_TYPE, LEADTIME_YEAR, SALES_SINCE, YTD_START
from stocklens.functions import timewin
from stocklens.operators import archive, assortment, demand, monitor, purchasing
from stocklens.plans import ordering


@dataclass(frozen=True)
class ReportDates:
    """The time a report is made for, and the starts of its fixed periods."""

    as_of: dt.datetime
    ytd_start: dt.date = YTD_START
    leadtime_year: str = LEADTIME_YEAR
    sales_since: dt.date = SALES_SINCE


@dataclass(frozen=True)
class Reports:
    """Results over ``tables``; ``unique_weeks`` states that product and week are unique.

    ``duplicate_weeks`` lists the rows that speak against that.
    """

    tables: Any
    dates: ReportDates
    unique_weeks: bool = False

    # Stock, purchasing and assortment

    def stockout_products(self) -> DataFrame:
        return assortment.stockout_products(self.tables.dim_product)

    def purchase_open_qty(self) -> DataFrame:
        return purchasing.purchase_open_qty(self.tables.fact_purchase, self.tables.dim_product)

    def order_type_base(self) -> DataFrame:
        return purchasing.order_type_base(self.tables.fact_purchase)

    def inbound_open_internal(self) -> DataFrame:
        return purchasing.inbound_open_internal(self.tables.item_ledger, self.order_type_base())

    def inbound_open_internal_incl_akt(self) -> DataFrame:
        return purchasing.inbound_open_internal(
            self.tables.item_ledger, self.order_type_base(), exclude=[GIFT_TYPE]
        )

    def vendor_division_current(self) -> DataFrame:
        return assortment.vendor_division_current(
            self.tables.hub_vendor_division, self.tables.sat_vendor_division
        )

    def units_ytd(self) -> DataFrame:
        return demand.units_ytd(
            self.tables.fact_sales,
            self.tables.dim_product,
            self.dates.as_of,
            self.dates.ytd_start,
        )

    def _assortment_inputs(self) -> tuple:
        return (
            self.tables.dim_product,
            self.purchase_open_qty(),
            self.inbound_open_internal(),
            self.units_ytd(),
            self.dates.as_of,
        )

    def assortment_base(self) -> DataFrame:
        return assortment.assortment_base(*self._assortment_inputs())

    def abc_clustering(self) -> DataFrame:
        return self._clusters(self._purchase_groups())

    def _purchase_groups(self) -> DataFrame:
        return purchasing.purchase_groups(self.tables.fact_purchase, self.tables.dim_product)

    def _clusters(self, groups: DataFrame) -> DataFrame:
        best = purchasing.largest_purchase_group(groups, self.tables.fact_purchase)
        members = assortment.members_by_best_group(
            self.tables.dim_product,
            best,
            self.inbound_open_internal(),
            self.units_ytd(),
            self.dates.as_of,
        )
        return assortment.abc_clustering(members)

    def oldest_po_min(self) -> DataFrame:
        return purchasing.oldest_po_min(self.tables.fact_purchase, self.tables.dim_product)

    def oldest_po_result(self) -> DataFrame:
        return purchasing.oldest_po_result(
            self.tables.fact_purchase, self.tables.dim_product, self.oldest_po_min()
        )

    def oldest_po_min_internal(self) -> DataFrame:
        return purchasing.oldest_po_min_internal(
            self.tables.fact_purchase, self.tables.dim_product
        )

    def leadtime(self) -> DataFrame:
        return purchasing.leadtime(self.tables.supplier_leadtime, self.dates.leadtime_year)

    def oldest_po_result_internal(self) -> DataFrame:
        return purchasing.oldest_po_result_internal(
            self.tables.fact_purchase,
            self.tables.dim_product,
            self.oldest_po_min_internal(),
            self.tables.dim_division,
            self.leadtime(),
        )

    def latest_line_version(self) -> DataFrame:
        return archive.latest_line_version(
            self.tables.purchase_line_archive,
            self.tables.purchase_header_archive,
            self.dates.as_of,
        )

    def zero_qty_lines(self) -> DataFrame:
        return archive.zero_qty_lines(
            self.tables.purchase_line_archive,
            self.tables.purchase_header_archive,
            self.dates.as_of,
        )

    def zero_order_count(self) -> DataFrame:
        return archive.zero_order_count(self.tables.dim_product, self.zero_qty_lines())

    # Demand

    def units_last_days(self) -> DataFrame:
        return demand.units_last_days(
            self.tables.fact_sales, self.tables.dim_product, self.dates.as_of
        )

    def forecast_next_days(self, mode: str = timewin.FAITHFUL) -> DataFrame:
        return demand.forecast_next_days(
            self.tables.daily_forecast, self.dates.as_of, mode=mode
        )

    def forecast_next_days_calendar(self) -> DataFrame:
        return self.forecast_next_days(timewin.CALENDAR)

    def oos_visits(self) -> DataFrame:
        return demand.oos_visits(self.tables.visits_per_sku, self.dates.as_of)

    def forecast_horizons(self, mode: str = timewin.FAITHFUL) -> DataFrame:
        return demand.forecast_horizons(
            self.tables.daily_forecast_by_business_id,
            self.tables.product,
            self.dates.as_of,
            mode=mode,
        )

    def forecast_horizons_calendar(self) -> DataFrame:
        return self.forecast_horizons(timewin.CALENDAR)

    def sold_units_per_sku(self) -> DataFrame:
        return demand.sold_units_per_sku(
            self.tables.management_report_daily, self.dates.sales_since
        )

    def sold_units_of(self, only: Column) -> DataFrame:
        """Sold units of the rows that ``only`` picks, by an extra column such as the brand."""
        return demand.sold_units_per_sku(
            self.tables.management_report_daily, self.dates.sales_since, only
        )

    def ordering_master(self) -> DataFrame:
        groups = self._purchase_groups()
        return ordering.ordering_master(
            self.stockout_products(),
            self._clusters(groups),
            purchasing.oldest_po_both(self.tables.fact_purchase, self.tables.dim_product, groups),
            self.leadtime(),
            self.zero_order_count(),
            self.units_last_days(),
            self.forecast_next_days(),
            self.oos_visits(),
            self.tables.dim_division,
            self.tables.division_ek_code,
            self.dates.as_of,
        )

    # Forecast monitoring

    def prior_week_bulk(self, mode: str = monitor.ISO_YEAR) -> DataFrame:
        return monitor.prior_week_bulk(self.tables.weekly_history, mode, self.unique_weeks)

    def prior_week_outlier(self, mode: str = monitor.ISO_YEAR) -> DataFrame:
        return monitor.prior_week_outlier(self.tables.weekly_history, mode, self.unique_weeks)

    def prior_week_outlier_calendar(self) -> DataFrame:
        return self.prior_week_outlier(monitor.CALENDAR)

    def prior_week_oos(self, mode: str = monitor.ISO_YEAR) -> DataFrame:
        return monitor.prior_week_oos(self.tables.weekly_history, mode, self.unique_weeks)

    def prior_week_oos_calendar(self) -> DataFrame:
        return self.prior_week_oos(monitor.CALENDAR)

    def prior_week_bulk_any_year(self) -> DataFrame:
        """The literal rule by week number alone, over the ISO year of the report it is meant for."""
        history = self.tables.weekly_history
        year = self.dates.as_of.isocalendar().year
        own_year = timewin.iso_year(F.col("week_start_date")) == year
        return monitor.prior_week_bulk(history.where(own_year), monitor.WEEK_NUMBER)

    def duplicate_weeks(self) -> DataFrame:
        return monitor.duplicate_weeks(self.tables.weekly_history)

    def prior_week_bulk_calendar(self) -> DataFrame:
        return self.prior_week_bulk(monitor.CALENDAR)

    def _released(self) -> DataFrame:
        return monitor.with_released_forecast(
            self.tables.weekly_history, self.tables.base_history
        )

    def _check(self, name: str, needs_prior_week: bool = True) -> DataFrame:
        weeks = self._released()
        if needs_prior_week:
            weeks = monitor.with_prior_week(
                weeks, self.tables.weekly_history, one_row_per_week=self.unique_weeks
            )
        return weeks.select(
            "product_id", "week_start_date", monitor.check_columns()[name].alias("value")
        )

    def flag_bulk_order(self) -> DataFrame:
        return self._check("bulk_order_fail")

    def flag_uplift_low(self) -> DataFrame:
        return self._check("uplift_zu_niedrig", needs_prior_week=False)

    def flag_top_down(self) -> DataFrame:
        return self._check("topdown_fail", needs_prior_week=False)

    def flag_oos(self) -> DataFrame:
        return self._check("oos_correction_fail")

    def flag_outlier(self) -> DataFrame:
        return self._check("outlier_correction_fail")

    def forecast_mad(self) -> DataFrame:
        return self._check("snop_mad", needs_prior_week=False)

    def forecast_mape(self) -> DataFrame:
        return self._check("snop_mape", needs_prior_week=False)

    def forecast_monitor(self, mode: str = monitor.ISO_YEAR) -> DataFrame:
        return monitor.forecast_monitor(
            self.tables.weekly_history,
            self.tables.base_history,
            mode=mode,
            one_row_per_week=self.unique_weeks,
        )

    def forecast_monitor_calendar(self) -> DataFrame:
        return self.forecast_monitor(monitor.CALENDAR)
