"""Date windows around an explicit ``as_of`` time; no wall clock anywhere.

``as_of`` is a naive ``datetime``. In ``faithful`` mode its time of day counts,
so midnight dates on its own day lie before it. In ``calendar`` mode it is cut
to the day first.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

FAITHFUL = "faithful"
CALENDAR = "calendar"


def anchor(as_of: dt.datetime, mode: str = FAITHFUL) -> dt.datetime:
    """The point in time a window starts from."""
    if mode == FAITHFUL:
        return as_of
    if mode == CALENDAR:
        return dt.datetime.combine(as_of.date(), dt.time())
    raise ValueError(f"unknown day mode: {mode!r}")


def days(n: int) -> dt.timedelta:
    return dt.timedelta(days=n)


def moment(value: dt.datetime | dt.date) -> Column:
    """A ``timestamp_ntz`` literal; folds to a constant, so scans can use it."""
    if not isinstance(value, dt.datetime):
        value = dt.datetime.combine(value, dt.time())
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def between(column: Column, first: dt.datetime | dt.date, last: dt.datetime | dt.date) -> Column:
    """Both ends included."""
    return (column >= moment(first)) & (column <= moment(last))


def from_until(column: Column, start: dt.datetime | dt.date, stop: dt.datetime | dt.date) -> Column:
    """Start included, stop excluded."""
    return (column >= moment(start)) & (column < moment(stop))


def iso_week(column: Column) -> Column:
    """ISO week number as two characters, so text order is number order."""
    return F.lpad(F.weekofyear(column).cast("string"), 2, "0")


def iso_year(column: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), column)


def plus_days(day: Column, lead: Column) -> Column:
    """Date plus a possibly fractional number of days, fraction cut off."""
    return F.date_add(day, lead.cast("int"))
