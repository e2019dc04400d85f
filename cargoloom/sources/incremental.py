"""Rows above a high-water mark, for any DataFrame source."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargoloom.functions.moments import moment


def newer_than(
    df: DataFrame, column: str, after: datetime | None, with_unmarked: bool = False, key: str = ""
) -> DataFrame:
    """Rows strictly after the mark (all rows without one). Catalyst pushes the filter to the scan.

    Rows whose ``column`` is null have no place before or after a mark. They come with a full load; ``with_unmarked``
    returns them each time, for readers that keep one row per ``key``; a row that lacks the key as well would multiply and
    does not come.
    """
    if after is None:
        return df
    newer = F.col(column) > moment(after)
    unmarked = F.col(column).isNull() & F.col(key).isNotNull() if key else F.col(column).isNull()
    return df.filter(newer | unmarked if with_unmarked else newer)


def high_water_mark(df: DataFrame, column: str) -> DataFrame:
    """The next mark and how many rows lead up to it, as one row."""
    return df.agg(F.max(column).alias("mark"), F.count(F.lit(1)).alias("new_rows"))
