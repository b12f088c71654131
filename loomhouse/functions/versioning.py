"""Open-ended validity and typed batch parameters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The end of a version that is still open.
OPEN_DATE = dt.date(9999, 12, 31)
OPEN_TIMESTAMP = dt.datetime(9999, 12, 31)


def as_date(value: dt.date | str) -> dt.date:
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


def day(value: dt.date | str) -> Column:
    """Date literal."""
    return F.lit(as_date(value).isoformat()).cast("date")


def as_timestamp(value: dt.datetime | str) -> Column:
    """Zone-free timestamp literal."""
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def is_open(valid_to: Column) -> Column:
    return valid_to == day(OPEN_DATE)
