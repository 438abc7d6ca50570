"""Sales, forecast and visit totals per product."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklens.constants import HORIZONS, LAST_DAYS, NEXT_DAYS, SALES_SINCE, YTD_START
from stocklens.functions import timewin
from stocklens.functions.quantities import Amount, whole_units


def _units(fact_sales: DataFrame, dim_product: DataFrame, when: Column, name: str) -> DataFrame:
    # Summed per surrogate key first: a bestseller reaches the join as one row.
    amount = Amount.of(fact_sales, "quantity")
    per_key = fact_sales.where(when).groupBy("product_skey").agg(amount.summed().alias("units"))
    products = dim_product.select("product_skey", "product_id")
    return (
        per_key.join(products, "product_skey", "left")
        .groupBy("product_id")
        .agg(whole_units(amount.value(amount.again("units"))).alias(name))
    )


def units_ytd(
    fact_sales: DataFrame,
    dim_product: DataFrame,
    as_of: dt.datetime,
    start: dt.date = YTD_START,
) -> DataFrame:
    """Units sold per product from ``start`` to midnight of the ``as_of`` day."""
    window = timewin.between(F.col("order_date"), start, as_of.date())
    return _units(fact_sales, dim_product, window, "sold_qty_ytd")


def units_last_days(
    fact_sales: DataFrame, dim_product: DataFrame, as_of: dt.datetime, days: int = LAST_DAYS
) -> DataFrame:
    """Units sold per product in the ``days`` up to ``as_of``."""
    window = timewin.between(F.col("order_date"), as_of - timewin.days(days), as_of)
    return _units(fact_sales, dim_product, window, "sold_qty_7days")


def forecast_next_days(
    daily_forecast: DataFrame,
    as_of: dt.datetime,
    days: int = NEXT_DAYS,
    mode: str = timewin.FAITHFUL,
) -> DataFrame:
    """Forecast per product from ``as_of`` over the next ``days``.

    Both ends are included; in ``calendar`` mode that is the whole last day.
    """
    start = timewin.anchor(as_of, mode)
    last = start + timewin.days(days)
    day = F.col("calendar_date")
    window = (
        timewin.between(day, start, last)
        if mode == timewin.FAITHFUL
        else timewin.from_until(day, start, last + timewin.days(1))
    )
    return (
        daily_forecast.where(window)
        .groupBy("product_id")
        .agg(Amount.of(daily_forecast, "snop_daily_forecast").total().alias("fcst_7days"))
    )


def oos_visits(
    visits: DataFrame, as_of: dt.datetime, mode: str = timewin.CALENDAR
) -> DataFrame:
    """Visits to out-of-stock product pages one day before ``as_of``.

    ``faithful`` matches only visits of that very time of day.
    """
    today = timewin.anchor(as_of, mode)
    yesterday = today - timewin.days(1)
    day = F.col("visit_date")
    window = (
        day == timewin.moment(yesterday)
        if mode == timewin.FAITHFUL
        else timewin.from_until(day, yesterday, today)
    )
    return (
        visits.where(window)
        .groupBy("product_id")
        .agg(Amount.of(visits, "oos_visits").total().alias("oos_visits"))
    )


def forecast_horizons(
    daily_forecast: DataFrame,
    product: DataFrame,
    as_of: dt.datetime,
    horizons: Sequence[int] = HORIZONS,
    mode: str = timewin.FAITHFUL,
) -> DataFrame:
    """Forecast per product over nested windows from ``as_of``, with unit cost.

    Products without demand in a window keep 0; forecasts without a product
    row drop out. Only rows inside the longest window are summed, so the date
    bound reaches their scan; a second narrow scan finds the products that
    have rows elsewhere. Product rows are counted per unit cost, and a
    product's forecast is multiplied by that count instead of joined to each.
    """
    start = timewin.anchor(as_of, mode)

    def within(days: int) -> Column:
        return timewin.from_until(F.col("calendar_date"), start, start + timewin.days(days))

    longest = within(max(horizons))
    amount = Amount.of(daily_forecast, "daily_married_forecast")
    totals = (
        daily_forecast.where(longest)
        .groupBy("productbusinessid")
        .agg(*[amount.summed(within(n)).alias(f"total_{n}") for n in horizons])
    )
    # A row outside a window adds 0 to it, so such a product has no null total.
    products = daily_forecast.groupBy("productbusinessid").agg(
        F.bool_or(~F.coalesce(longest, F.lit(False))).alias("has_other_days")
    )
    costs = product.groupBy("productbusinessid", "unitcost").agg(
        F.count(F.lit(1)).alias("n_rows")
    )

    def rounded(days: int) -> Column:
        total = F.round(amount.value(F.col(f"total_{days}"), F.col("n_rows")), 0).cast("bigint")
        none = F.when(F.col("has_other_days"), F.lit(0).cast("bigint"))
        return F.coalesce(total, none).alias(f"fcst_{days}days")

    return (
        products.join(totals, "productbusinessid", "left")
        .join(costs, "productbusinessid")
        .select(
            "productbusinessid",
            *[rounded(n) for n in horizons],
            F.col("unitcost").cast("double").alias("Unit Cost"),
        )
    )


def sold_units_per_sku(
    management_report_daily: DataFrame,
    since: dt.date = SALES_SINCE,
    only: Column | None = None,
) -> DataFrame:
    """Units, revenue, profit and margin per product, best sellers first.

    ``only`` picks rows before they are grouped, by brand or division for
    example. Equal units are sorted by product, so they spread over tasks too.
    """
    picked = management_report_daily if only is None else management_report_daily.where(only)
    sums = (
        picked.where(
            (F.col("snapshot_day") > timewin.moment(since))
            & (F.col("invoiced_sales_ad") > 0)
            & (F.col("invoiced_db3_ad") > 0)
        )
        .groupBy("productbusinessid", "productname")
        .agg(
            *[
                Amount.of(picked, column).total().alias(name)
                for column, name in (
                    ("ordered_qty", "sold_units"),
                    ("invoiced_sales_ad", "revenue"),
                    ("invoiced_db3_ad", "profit"),
                )
            ]
        )
    )
    return sums.select(
        "productname",
        "productbusinessid",
        "sold_units",
        "revenue",
        "profit",
        F.try_divide(F.col("profit").cast("double"), F.col("revenue").cast("double")).alias(
            "db3_marge"
        ),
    ).orderBy(F.desc("sold_units"), "productbusinessid", "productname")
