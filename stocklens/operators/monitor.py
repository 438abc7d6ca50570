"""Forecast monitoring per product and week.

How a week finds the week before it, by ``mode``:

``week_number``  ISO week number minus one, whatever the year. Week 1 finds
                 nothing, and every further year in the table adds matches.
``iso_year``     the same inside each ISO year, so a history of several years
                 gives what one report per year would give.
``calendar``     the Monday seven days earlier, across the turn of the year.
"""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from stocklens.constants import MIN_MAD, MIN_MAPE
from stocklens.functions import forecast_checks as checks
from stocklens.functions.timewin import iso_week, iso_year

WEEK_NUMBER = "week_number"
ISO_YEAR = "iso_year"
CALENDAR = "calendar"

# Column of the week before -> its name beside the current week.
BULK = {"bulk_order_qty": "bulk_order_last_kw"}
OUTLIER = {"outlier_correction_qty": "outlier_correction_qty_last_kw"}
OOS = {"oos_correction_qty": "oos_correction_qty_last_kw"}


def _week_keys(week_start: Column, mode: str, shift: int) -> dict[str, Column]:
    """Join keys of a week, moved ``shift`` weeks ahead."""
    number = F.weekofyear(week_start) + shift
    if mode == WEEK_NUMBER:
        return {"_kw": number}
    if mode == ISO_YEAR:
        return {"_kw": number, "_year": iso_year(week_start)}
    if mode == CALENDAR:
        return {"_monday": F.date_add(week_start, 7 * shift)}
    raise ValueError(f"unknown week mode: {mode!r}")


def _join_prior(
    current: DataFrame, weekly: DataFrame, columns: Mapping[str, str], mode: str
) -> DataFrame:
    week = F.col("week_start_date")
    prior = weekly.select(
        "product_id",
        *[key.alias(name) for name, key in _week_keys(week, mode, 1).items()],
        *[F.col(old).alias(new) for old, new in columns.items()],
    )
    keys = _week_keys(week, mode, 0)
    return (
        current.withColumns(keys).join(prior, ["product_id", *keys], "left").drop(*keys)
    )


def _beside(weekly: DataFrame, columns: Mapping[str, str], mode: str) -> DataFrame:
    """Each week with columns of the week before, where product and week are unique.

    The row before it in time is the week before or there is none, so the
    history is read and shuffled once.
    """
    if mode == WEEK_NUMBER:
        raise ValueError("weeks of several years have the same number")
    week = F.col("week_start_date")
    [(_, own)] = [k for k in _week_keys(week, mode, 0).items() if k[0] != "_year"]
    [(_, expected)] = [
        k for k in _week_keys(F.lag(week).over(_by_product(mode)), mode, 1).items() if k[0] != "_year"
    ]
    is_prior = own == expected
    return weekly.withColumns(
        {new: F.when(is_prior, F.lag(old).over(_by_product(mode))) for old, new in columns.items()}
    )


def _by_product(mode: str) -> WindowSpec:
    year = [iso_year(F.col("week_start_date"))] if mode == ISO_YEAR else []
    return Window.partitionBy("product_id", *year).orderBy("week_start_date")


def with_prior_week(
    weeks: DataFrame, weekly: DataFrame, mode: str = ISO_YEAR, one_row_per_week: bool = False
) -> DataFrame:
    """Weeks with the bulk order and corrections of the week before beside them.

    Each quantity is looked up in the ``weekly`` history on its own, so several
    rows in the week before multiply. With ``one_row_per_week`` the caller
    states that product and week are unique there (see ``duplicate_weeks``),
    and a single lookup gives the same rows.
    """
    if one_row_per_week:
        return _join_prior(weeks, weekly, {**BULK, **OOS, **OUTLIER}, mode)
    for columns in (BULK, OOS, OUTLIER):
        weeks = _join_prior(weeks, weekly, columns, mode)
    return weeks


def duplicate_weeks(weekly: DataFrame) -> DataFrame:
    """Products and weeks that have more than one row, and how many."""
    return (
        weekly.groupBy("product_id", "week_start_date")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )


def _prior_week(
    weekly: DataFrame, columns: Mapping[str, str], mode: str, one_row_per_week: bool = False
) -> DataFrame:
    own = weekly.select("product_id", "week_start_date", *columns)
    if one_row_per_week and mode != WEEK_NUMBER:
        beside = _beside(own, columns, mode)
    else:
        beside = _join_prior(own, own, columns, mode)
    return beside.select(
        F.col("product_id").alias("sku"),
        "week_start_date",
        iso_week(F.col("week_start_date")).alias("kw"),
        *columns,
        *columns.values(),
    )


def prior_week_bulk(
    weekly: DataFrame, mode: str = ISO_YEAR, one_row_per_week: bool = False
) -> DataFrame:
    """Bulk order quantity of each week and of the week before."""
    return _prior_week(weekly, BULK, mode, one_row_per_week)


def prior_week_outlier(
    weekly: DataFrame, mode: str = ISO_YEAR, one_row_per_week: bool = False
) -> DataFrame:
    """Outlier correction of each week and of the week before."""
    return _prior_week(weekly, OUTLIER, mode, one_row_per_week)


def prior_week_oos(
    weekly: DataFrame, mode: str = ISO_YEAR, one_row_per_week: bool = False
) -> DataFrame:
    """Out-of-stock correction of each week and of the week before."""
    return _prior_week(weekly, OOS, mode, one_row_per_week)


def with_released_forecast(weekly: DataFrame, base_history: DataFrame) -> DataFrame:
    """Weeks with the forecast snapshot taken at the start of that week."""
    snapshot = base_history.where(F.col("as_of_date") == F.col("week_start_date")).drop(
        "as_of_date"
    )
    return weekly.join(snapshot, ["product_id", "week_start_date"])


def check_columns() -> dict[str, Column]:
    """Flags and error measures over the joined weekly row, by result name."""
    net, married = F.col("net_qty"), F.col("married_forecast_quantity")
    after = F.col("forecast_quantity_after_uplifts_before_adjustment")
    return {
        "bulk_order_fail": checks.flag_bulk_order(
            F.col("bulk_order_last_kw"), F.col("bulk_order_qty")
        ),
        "uplift_zu_niedrig": checks.flag_uplift_low(F.col("sku_uplift"), after, net),
        "topdown_fail": checks.flag_top_down(F.col("top_down_adjustment"), after, net, married),
        "oos_correction_fail": checks.flag_oos(
            F.col("oos_correction_qty"),
            F.col("oos_correction_qty_last_kw"),
            F.col("forecast_quantity"),
            net,
        ),
        "outlier_correction_fail": checks.flag_outlier(
            F.col("outlier_correction_qty_last_kw"), F.col("outlier_correction_qty")
        ),
        "snop_mad": checks.forecast_mad(net, married),
        "snop_mape": checks.forecast_mape(net, married),
    }


def forecast_monitor(
    weekly: DataFrame,
    base_history: DataFrame,
    min_mape: Decimal = MIN_MAPE,
    min_mad: Decimal | int = MIN_MAD,
    mode: str = ISO_YEAR,
    one_row_per_week: bool = False,
) -> DataFrame:
    """Product weeks with a bad forecast and the steps that caused it.

    Sorted by product and week number. Where weeks are unique, the week before
    is found beside each week in the one pass over the history that the error
    needs as well; else the error decides first, so that only bad weeks look it up.
    """
    net, married = F.col("net_qty"), F.col("married_forecast_quantity")
    is_bad = checks.mape_above(net, married, min_mape) & checks.mad_above(net, married, min_mad)
    if one_row_per_week and mode != WEEK_NUMBER:
        history = _beside(weekly, {**BULK, **OOS, **OUTLIER}, mode)
        bad = with_released_forecast(history, base_history).where(is_bad)
    else:
        bad = with_released_forecast(weekly, base_history).where(is_bad)
        bad = with_prior_week(bad, weekly, mode, one_row_per_week)
    return bad.select(
        "product_id",
        iso_week(F.col("week_start_date")).alias("kw"),
        "net_qty",
        "bulk_order_last_kw",
        "outlier_correction_qty_last_kw",
        "oos_correction_qty_last_kw",
        "sku_uplift",
        "top_down_adjustment",
        checks.final_forecast(married).alias("snop_fcst"),
        *[column.alias(name) for name, column in check_columns().items()],
    ).orderBy("product_id", "kw")
