"""Calendar columns and durations."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The holidays (month-day) and the end date of an open dimension row.
HOLIDAYS = ("01-01", "12-25")
OPEN_END = "9999-12-31"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(c: Column | str) -> Column:
    """yyyyMMdd as an integer; null stays null. Integer arithmetic, no text formatting per row."""
    c = _col(c)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def day_name(c: Column | str) -> Column:
    return F.date_format(_col(c), "EEEE")


def is_weekend(c: Column | str) -> Column:
    return F.dayofweek(_col(c)).isin(1, 7)


def is_holiday(c: Column | str, holidays: Sequence[str] = HOLIDAYS) -> Column:
    return F.date_format(_col(c), "MM-dd").isin(*holidays)


def open_end_date() -> Column:
    return F.lit(OPEN_END).cast("date")


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Whole seconds from start to end, in minutes rounded half away from zero.

    Null if either end is null; negative when ``end`` lies before ``start``.
    """
    seconds = F.unix_timestamp(_col(end)) - F.unix_timestamp(_col(start))
    # ``round`` would make a decimal of each value; every number of seconds between two dates is exact in a double.
    minutes = F.floor((F.abs(seconds) + 30) / 60)
    return F.when(seconds < 0, -minutes).otherwise(minutes).cast("long")


def calendar_days(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day from start to end, both included; no row when they are reversed."""
    days = (end - start).days + 1
    return spark.range(max(days, 0)).select(
        F.date_add(F.lit(start.isoformat()).cast("date"), F.col("id").cast("int")).alias("full_date")
    )
