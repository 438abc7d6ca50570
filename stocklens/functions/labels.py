"""Display columns of the ordering list."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from stocklens.constants import AVAILABLE_LABEL, NO_DATE
from stocklens.functions.timewin import moment


def availability_label(day: Column, as_of: dt.datetime) -> Column:
    """A label for dates that are unset or past, else the date as text."""
    past = (day == F.lit(NO_DATE)) | (day < moment(as_of))
    return F.when(past, F.lit(AVAILABLE_LABEL)).otherwise(F.date_format(day, "yyyy-MM-dd"))
