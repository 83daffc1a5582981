"""Column expressions shared by the operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

OPEN_END = dt.date(9999, 12, 31)


def day(value: dt.date | str | Column) -> Column:
    """A DATE column from a date, an ISO string or a column."""
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def instant(value: dt.datetime | str | Column | None) -> Column:
    """A TIMESTAMP column (UTC); ``None`` means the time of the query."""
    if value is None:
        return F.current_timestamp()
    return value if isinstance(value, Column) else F.lit(str(value)).cast("timestamp")


def percent_change(value: Column, base: Column) -> Column:
    """Change against ``base`` in percent, NULL when ``base`` is NULL or zero."""
    return F.try_divide(value - base, base) * 100


def size_gb(size: Column) -> Column:
    """Bytes as gibibytes with two decimals."""
    return F.round(size / F.pow(F.lit(1024.0), F.lit(3.0)), 2)


def text(value: Column) -> Column:
    return value.cast("string")
