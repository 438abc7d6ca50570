"""Forecast failure flags and error measures, one column expression each.

Flags are the strings '1' and '0'. A comparison with null does not raise a flag.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from stocklens.constants import MIN_MAD, MIN_MAPE, NO_SALES_MAPE
from stocklens.functions.quantities import QUANTITY


def _flag(condition: Column) -> Column:
    return F.when(condition, F.lit("1")).otherwise(F.lit("0"))


def final_forecast(married: Column) -> Column:
    """The released forecast at two decimals, rounded half up."""
    return married.cast("decimal(18,2)")


def flag_bulk_order(prior_bulk: Column, bulk: Column) -> Column:
    """Bulk orders in this week and the one before."""
    return _flag((prior_bulk > 0) & (bulk > 0))


def flag_uplift_low(uplift: Column, after_uplifts: Column, net: Column) -> Column:
    """An uplift was planned, and sales still ran past it."""
    return _flag((uplift > 0) & (after_uplifts < net))


def flag_top_down(top_down: Column, after_uplifts: Column, net: Column, married: Column) -> Column:
    """The top-down step raised the forecast, and sales ran past that too."""
    final = final_forecast(married)
    return _flag((top_down > 1) & (final > after_uplifts) & (net > final))


def flag_oos(oos: Column, prior_oos: Column, base_forecast: Column, net: Column) -> Column:
    """Out-of-stock correction stopped although sales exceed the base forecast."""
    return _flag((oos == 0) & (prior_oos > 0) & (base_forecast < net))


def flag_outlier(prior_outlier: Column, outlier: Column) -> Column:
    """Outlier corrections in this week and the one before."""
    return _flag((prior_outlier > 0) & (outlier > 0))


def _by_case(net: Column, married: Column, neither: Column, unsold: Column, other: Column) -> Column:
    nothing_sold = F.coalesce(net, F.lit(0)) == 0
    final = final_forecast(married)
    return (
        F.when(nothing_sold & (final == 0), neither)
        .when(nothing_sold & (final > 0), unsold)
        .otherwise(other)
    )


def _gap(net: Column, married: Column) -> Column:
    return F.abs(net - final_forecast(married))


def forecast_mad(net: Column, married: Column) -> Column:
    """Absolute deviation of the final forecast from net sales."""
    return _by_case(
        net,
        married,
        neither=F.lit(0).cast(QUANTITY),
        unsold=final_forecast(married).cast(QUANTITY),
        other=_gap(net, married).cast(QUANTITY),
    )


def forecast_mape(net: Column, married: Column) -> Column:
    """Absolute deviation relative to net sales, null where sales are zero."""
    return _by_case(
        net,
        married,
        neither=F.lit(0.0),
        unsold=F.lit(float(NO_SALES_MAPE)),
        other=F.try_divide(_gap(net, married).cast("double"), net.cast("double")),
    )


def mape_above(net: Column, married: Column, limit: Decimal = MIN_MAPE) -> Column:
    """Whether the percentage error exceeds ``limit``, compared in decimals."""
    bound = F.lit(limit) * net
    gap = _gap(net, married)
    return _by_case(
        net,
        married,
        neither=F.lit(Decimal(0) > limit),
        unsold=F.lit(NO_SALES_MAPE > limit),
        other=F.when(net > 0, gap > bound).when(net < 0, gap < bound),
    )


def mad_above(net: Column, married: Column, limit: Decimal | int = MIN_MAD) -> Column:
    return forecast_mad(net, married) > F.lit(limit)
