"""Source tables to the raw zone."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from datetime import datetime
from time import monotonic

from pyspark.sql import DataFrame

from cargoloom.functions.moments import batch_id
from cargoloom.functions.text import trim_padding
from cargoloom.sinks.zones import Zones
from cargoloom.sources.incremental import newer_than
from cargoloom.sources.specs import LOGISTICS_TABLES, TableSpec

Reader = Callable[[TableSpec], DataFrame]
Metric = tuple[str, str, str, float]


def each(tasks: Sequence[Callable], max_concurrent: int = 4) -> list:
    """Submit some independent Spark jobs at the same time and wait for all."""
    with ThreadPoolExecutor(max_concurrent) as pool:
        return [f.result() for f in [pool.submit(copy_context().run, t) for t in tasks]]


def land(read: Reader, zones: Zones, spec: TableSpec, as_of: datetime) -> list[Metric]:
    """Land one whole table; the row count comes from the write itself."""
    started = monotonic()
    rows = zones.land_raw(trim_padding(read(spec), spec.padded), spec, as_of)
    return [("landing", spec.name, "rows", rows), ("landing", spec.name, "seconds", monotonic() - started)]


def land_all(
    read: Reader,
    zones: Zones,
    as_of: datetime,
    specs: Sequence[TableSpec] = LOGISTICS_TABLES,
    max_concurrent: int = 4,
    incremental: bool = False,
) -> list[Metric]:
    step = land_new if incremental else land
    landed = each([lambda s=s: step(read, zones, s, as_of) for s in specs], max_concurrent)
    return [metric for metrics in landed for metric in metrics]


def land_new(read: Reader, zones: Zones, spec: TableSpec, as_of: datetime) -> list[Metric]:
    """Land what a source has above the mark of the loads before ``as_of``; the whole source where there is no mark.

    Rows without a mark of their own come each time: readers keep one row per key (``Zones.newest``).
    """
    started, mark = monotonic(), landed_mark(zones, spec, as_of)
    if spec.incremental_column is None or mark is None:
        return land(read, zones, spec, as_of)
    rows, _ = land_increment(read(spec), zones, spec, as_of, mark, with_unmarked=True)
    return [("landing", spec.name, "rows", rows), ("landing", spec.name, "seconds", monotonic() - started)]


def land_increment(
    df: DataFrame, zones: Zones, spec: TableSpec, as_of: datetime, after: datetime | None, with_unmarked: bool = False
) -> tuple[int, datetime | None]:
    """Land the rows above the mark as the batch ``as_of``; returns their number and the next mark.

    Pass the mark that the batches before reached (see ``landed_mark``). Landing the batch again replaces its rows, all of
    them; another ``as_of`` of the same day is another batch.
    """
    if spec.incremental_column is None:
        raise ValueError(f"{spec.name} has no incremental column")
    fresh = newer_than(df, spec.incremental_column, after, with_unmarked, spec.key)
    rows, mark = zones.land_batch(trim_padding(fresh, spec.padded), spec, as_of)
    return rows, mark or after


def landed_mark(zones: Zones, spec: TableSpec, before: datetime) -> datetime | None:
    """The mark reached by loads before ``before``, full or not, from the marks kept with them: one small row per batch."""
    held = zones.loads(spec.name).items()
    return max((e["mark"] for b, e in held if b < batch_id(before) and e["mark"] is not None), default=None)
