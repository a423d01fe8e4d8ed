"""Time expressions of the date dimension."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_time(c: Column) -> Column:
    """Zone-free timestamp; NULL when the text is not one."""
    return c.try_cast("timestamp_ntz")


def date_key(day: Column) -> Column:
    """``YYYYMMDD`` as a number."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def calendar_parts(day: Column) -> list[Column]:
    """The columns of the date dimension for one date column."""
    return [
        date_key(day).alias("date_key"),
        day.alias("full_date"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.weekofyear(day).alias("week"),
        F.dayname(day).alias("day_name"),
    ]
