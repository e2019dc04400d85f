"""Dimension rows over time: a change closes a row and opens the next.

A history has the columns of a dimension with ``is_active``, ``effective_start_date`` and ``effective_end_date``. A row holds from its start
up to, but not including, its end; the open row of a key ends on the open end date. So a key's rows lie end to end, and exactly
one of them is open unless the key was closed.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargoloom.functions.dates import open_end_date

INTERVAL = ("is_active", "effective_start_date", "effective_end_date")


def begin_history(rows: DataFrame, day: date) -> DataFrame:
    """Every row as open from ``day`` on; columns of an interval that are there already are replaced."""
    plain = [c for c in rows.columns if c not in INTERVAL]
    return rows.select(*plain, F.lit(True).alias(INTERVAL[0]), F.lit(day).alias(INTERVAL[1]), open_end_date().alias(INTERVAL[2]))


def before_day(history: DataFrame, day: date) -> DataFrame:
    """``history`` as it was before ``day``: rows begun that day are gone, rows closed that day are open again.

    Row by row, no shuffle. A history that has gone past ``day`` fails when it is computed, as its later rows rest on that day.
    """
    start, end, today = F.col(INTERVAL[1]), F.col(INTERVAL[2]), F.lit(day)
    is_open = F.coalesce(F.col(INTERVAL[0]), F.lit(False))
    later = (start > today) | (~is_open & (end > today))
    refused = F.raise_error(F.lit(f"the history is already past {day}")).cast("boolean")
    again = ~is_open & (end == today)
    rows = history.where(F.when(later, refused).otherwise(start < today))
    return rows.withColumns({INTERVAL[0]: is_open | again, INTERVAL[2]: F.when(again, open_end_date()).otherwise(end)}).select(*history.columns)


def advance_history(
    history: DataFrame,
    incoming: DataFrame,
    key: str,
    day: date,
    tracked: Sequence[str] | None = None,
    close_missing: bool = False,
) -> DataFrame:
    """``history`` after the state ``incoming`` of ``day``.

    A key whose ``tracked`` columns (by default all that ``incoming`` has but the key) differ, nulls being values, has its open row closed on
    ``day`` and a new one opened. An unchanged key keeps its row as it is, a new one gets its first. A key that ``incoming`` lacks stays
    open, or is closed with ``close_missing``; one that comes back later opens again, with a gap for the time between.
    Days go forward; the last one can be run again, with the same or a corrected state, and then replaces what it did (``before_day``).
    ``key`` must be unique in ``incoming``; rows without a key have no history and are left out. Columns
    of the history that ``incoming`` lacks, such as surrogate keys, go on from row to row of a key.

    Only open rows are joined. Closed ones pass through: in files partitioned by ``is_active`` they are not shuffled.
    """
    plain = [c for c in history.columns if c not in INTERVAL]
    compared = [c for c in incoming.columns if c != key and c not in INTERVAL] if tracked is None else list(tracked)
    given = [c for c in plain if c in incoming.columns]
    history = before_day(history, day)
    today = F.lit(day)
    was = history.where(INTERVAL[0]).select(F.struct(*history.columns).alias("was"))
    came = incoming.where(F.col(key).isNotNull()).select(F.struct(*given).alias("came"))
    both = was.join(came, F.col(f"was.`{key}`") == F.col(f"came.`{key}`"), "full_outer")

    known, comes = F.col("was").isNotNull(), F.col("came").isNotNull()
    same = reduce(and_, [F.col(f"was.`{c}`").eqNullSafe(F.col(f"came.`{c}`")) for c in compared], F.lit(True))
    changed = known & comes & ~same
    gone = known & ~comes & F.lit(close_missing)

    closed = F.col("was").withField(INTERVAL[0], F.lit(False)).withField(INTERVAL[2], today)

    def opened():
        columns = [(F.col(f"came.`{c}`") if c in given else F.col(f"was.`{c}`")).alias(c) for c in plain]
        return F.struct(*columns, F.lit(True).alias(INTERVAL[0]), today.alias(INTERVAL[1]), open_end_date().alias(INTERVAL[2]))

    rows = (
        F.when(~known, F.array(opened()))
        .when(changed, F.array(closed, opened()))
        .when(gone, F.array(closed))
        .otherwise(F.array(F.col("was")))
    )
    after = both.select(F.explode(rows).alias("row"))
    after = after.select(*[F.col(f"row.`{c}`").alias(c) for c in history.columns])
    return history.where(f"NOT {INTERVAL[0]}").unionByName(after)


def as_of_day(history: DataFrame, day: date) -> DataFrame:
    """The rows that hold on ``day``."""
    return history.where((F.col("effective_start_date") <= F.lit(day)) & (F.lit(day) < F.col("effective_end_date")))


def with_row_of_day(
    facts: DataFrame, history: DataFrame, key: str, day: str, columns: Sequence[str]
) -> DataFrame:
    """``facts`` with ``columns`` of the history row that holds on the fact's ``day``; null where none does.

    The join is on the key, the day narrows it: a fact meets only its key's few rows.
    """
    held = history.select(F.col(key).alias("__key"), *[F.col(c).alias(f"__{c}") for c in ("effective_start_date", "effective_end_date")],
                          *[F.col(c).alias(f"__row_{c}") for c in columns])
    on = (F.col(key) == F.col("__key")) & (F.col("__effective_start_date") <= F.col(day)) & (F.col(day) < F.col("__effective_end_date"))
    return facts.join(held, on, "left").select(*facts.columns, *[F.col(f"__row_{c}").alias(c) for c in columns])
