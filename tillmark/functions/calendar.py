"""Calendar expressions used by the date dimension, the fact and the report."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(col: Column) -> Column:
    """Day as the integer yyyymmdd, by arithmetic instead of formatting and parsing text."""
    return (F.year(col) * 10000 + F.month(col) * 100 + F.dayofmonth(col)).cast("int")


def is_weekend(col: Column) -> Column:
    """Saturday or Sunday (weekday() counts Monday as 0)."""
    return F.weekday(col) >= 5


def month_label(year: Column, month: Column) -> Column:
    return F.format_string("%d-%02d", year, month)


def calendar_columns(day: Column) -> list[Column]:
    return [
        date_key(day).alias("date_key"),
        day.alias("full_date"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day"),
        F.date_format(day, "EEEE").alias("day_name"),
        is_weekend(day).alias("is_weekend"),
    ]
