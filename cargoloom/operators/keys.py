"""Surrogate keys without a single-partition window."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from cargoloom.operators.joins import fan_out_left_join, frequent_keys

from cargoloom.session import new_work_path, stored_frame

_SLOT = "__slot"
_BEFORE = "__before"
_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def dense_keys(df: DataFrame, order_by: Sequence[str], key: str, after: int = 0, weight: str | None = None) -> DataFrame:
    """Number the rows ``after + 1, after + 2, ...`` in the order of ``order_by``.

    The values are those of ``row_number() over (order by ...)`` (nulls first), but
    the work is a range-partitioned sort: each task numbers its own slice, and one number
    per slice tells how many rows come before it. A frequent leading value does not
    make a hot task as long as ``order_by`` goes on with columns that tell its rows
    apart, because all of them bound the ranges.

    The sorted rows are written to the shared work folder once, with their slot
    numbers as data, and everything after that reads the file: the two readers agree
    on the slices whatever happens to an executor, and later steps read only the
    columns they use.

    With ``weight`` (a column of whole numbers) a row takes as many numbers as it weighs, and gets the first of them.
    """
    spark = df.sparkSession
    path = new_work_path(spark, f"sorted-{key}")
    slotted = df.orderBy(*order_by).withColumn(_SLOT, F.monotonically_increasing_id())
    if weight:
        slotted = slotted.mapInArrow(_with_running_sum(weight), StructType([*slotted.schema.fields]).add(_BEFORE, LongType()))
    # Work files are read soon and then removed: the smaller, the better.
    slotted.write.option("compression", "zstd").parquet(path)

    rows = spark.read.schema(slotted.schema).parquet(path)
    slice_no = F.shiftright(_SLOT, _ROW_BITS)
    taken = F.sum(F.col(weight).cast("long")) if weight else F.count(F.lit(1))
    # One row per sort task, so at most spark.sql.shuffle.partitions rows reach the driver.
    sizes = {s: n for s, n in rows.groupBy(slice_no).agg(taken).collect()}
    before, starts = after, []
    for s in range(max(sizes, default=0) + 1):
        starts.append(before)
        before += sizes.get(s, 0)
    # A single constant for Catalyst: looking up a slice's start needs no join.
    start = F.get(F.split(F.lit(",".join(map(str, starts))), ",").cast("array<bigint>"), slice_no.cast("int"))
    place = F.col(_BEFORE) if weight else F.col(_SLOT).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return rows.select((start + place + 1).alias(key), *df.columns)


def _with_running_sum(weight: str):
    """For ``mapInArrow``: the batches of a sorted slice, each row with what the rows before it weigh."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0
        for batch in batches:
            weights = batch.column(batch.schema.get_field_index(weight)).to_numpy(zero_copy_only=False).astype(np.int64)
            sums = before + np.cumsum(weights)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums - weights)], [*batch.schema.names, _BEFORE])
            before = int(sums[-1]) if len(sums) else before

    return run


def fan_out_keys(
    left: DataFrame, right: DataFrame, on: str, left_order: str, right_order: str, key: str, rows_per_task: int | None = None
) -> DataFrame:
    """``left LEFT JOIN right USING (on)`` with the dense keys of its rows in the order of ``left_order, right_order``.

    Nothing but the left rows is sorted over the cluster, where the right side multiplies them: a left row takes as many numbers
    as it has matches, and a match's place is that among the right rows of its ``on``. The joined rows are not stored; they come
    out the same each time, as right rows that agree on ``right_order`` are told apart by their other columns.

    Left rows that share ``left_order`` share their numbers in the order of ``right_order``. They are told by an aggregate, and only
    what becomes of them is sorted. An ``on`` with very many right rows is ranked and joined by several tasks.
    """
    many = {} if rows_per_task is None else {"rows_per_task": rows_per_task}
    matches = right.where(F.col(on).isNotNull())
    weights = matches.groupBy(on).agg(F.count(F.lit(1)).alias("__weight"))
    weighed = left.join(weights, on, "left").withColumn("__weight", F.coalesce(F.col("__weight"), F.lit(1).cast("long")))
    placed = dense_keys(weighed, [left_order], "__start", weight="__weight").drop("__weight")
    ranked = _ranked(matches, on, right_order, **many)
    repeated = repeated_keys(placed, [left_order])
    number = (F.col("__start") + F.coalesce(F.col("__rank"), F.lit(0))).alias(key)
    columns = [*left.columns, *[c for c in right.columns if c != on]]
    if repeated is None:
        return fan_out_left_join(placed, ranked, on, ["__rank"], **many).select(number, *columns)
    same = F.col(left_order).eqNullSafe(F.col(f"__{left_order}"))
    alone = fan_out_left_join(placed.join(repeated, same, "left_anti"), ranked, on, ["__rank"], **many).select(number, *columns)
    shared = fan_out_left_join(placed.join(repeated, same, "left_semi"), ranked, on, ["__rank"], **many)
    placed_again = dense_keys(shared, [left_order, right_order], "__place")
    firsts = placed_again.groupBy(left_order).agg(F.min("__place").alias("__first"), F.min("__start").alias("__begin"))
    firsts = firsts.withColumnRenamed(left_order, f"__{left_order}")
    number = (F.col("__begin") + F.col("__place") - F.col("__first")).alias(key)
    return alone.unionByName(placed_again.join(firsts, same, "left").select(number, *columns))


def _ranked(df: DataFrame, group: str, order: str, **many) -> DataFrame:
    """``df`` with ``__rank``: 0, 1, ... in each group, in the order of a column and then of all others."""
    others = [c for c in df.columns if c not in (group, order)]
    rank = (F.row_number().over(Window.partitionBy(group).orderBy(order, *others)) - 1).cast("long")
    busy = frequent_keys(df, group, **many)
    if busy.isEmpty():
        return df.withColumn("__rank", rank)
    few = df.join(busy, group, "left_anti").withColumn("__rank", rank)
    placed = dense_keys(df.join(busy, group, "left_semi"), [group, order, *others], "__place")
    firsts = placed.groupBy(group).agg(F.min("__place").alias("__first"))
    most = placed.join(firsts, group).withColumn("__rank", F.col("__place") - F.col("__first"))
    return few.unionByName(most.select(*few.columns))


@dataclass(frozen=True)
class KnownKeys:
    """Rows with keys given earlier, and the highest key ever given: the latter from a log (``VersionedTables``), not from a scan."""

    rows: DataFrame
    highest: int


def stable_keys(
    incoming: DataFrame,
    known: KnownKeys,
    natural_key: str,
    key: str,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of ``incoming`` with the key each natural key already has in ``known``.

    Natural keys seen for the first time get dense keys above the highest one ever
    given, so a key once given never moves to another row. ``natural_key`` must be
    unique in both inputs; null counts as a value.
    """
    return stable_keys_by(incoming, known, [natural_key], key, order_by)


def stable_keys_by(
    incoming: DataFrame, known: KnownKeys, natural: Sequence[str], key: str, order_by: Sequence[str] | None = None
) -> DataFrame:
    """``stable_keys`` for a natural key of several columns, which both have in the same types.

    Both sides are joined once, into the work folder: what ``incoming`` is made of is not evaluated again to find the rows that are
    not known, nor to sort them.
    """
    held = known.rows.select(F.col(key), *[F.col(c).alias(f"__known_{c}") for c in natural], F.lit(True).alias("__held"))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"__known_{c}")) for c in natural])
    joined = incoming.join(held, same, "left").select(F.col(key).cast("long").alias(key), *incoming.columns, "__held")
    rows = stored_frame(joined, f"known-{key}")
    fresh = rows.where("__held IS NULL").select(*incoming.columns)
    numbered = dense_keys(fresh, order_by or natural, key, after=known.highest)
    return rows.where("__held").select(key, *incoming.columns).unionByName(numbered)


def repeated_keys(df: DataFrame, natural: Sequence[str]) -> DataFrame | None:
    """The natural keys that several rows have, each column with ``__`` before its name; None where no key repeats.

    Hashes of the keys are counted first, eight bytes a row. Rows with the hash of another row are then compared by the keys
    themselves, so that keys of one hash are not taken for one.
    """
    spark, hashed = df.sparkSession, F.xxhash64(*natural)

    def kept(rows: DataFrame, label: str) -> DataFrame:
        path = new_work_path(spark, label)
        rows.write.parquet(path)
        return spark.read.schema(rows.schema).parquet(path)

    counted = df.groupBy(hashed.alias("__hash")).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select("__hash")
    alike = kept(counted, "repeated-hashes")
    if alike.isEmpty():
        return None
    suspects = df.select(*natural, hashed.alias("__hash")).join(alike, "__hash", "left_semi")
    repeated = suspects.groupBy(*natural).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    keys = kept(repeated.select(*[F.col(c).alias(f"__{c}") for c in natural]), "repeated-keys")
    return None if keys.isEmpty() else keys


def numbered_copies(df: DataFrame, natural: Sequence[str], name: str) -> DataFrame:
    """``df`` with a column that tells rows of one natural key apart: 0, 1, ... in the order of their other columns.

    Nulls count as values. Where no key repeats, as it should be, this costs one aggregate. Only rows of repeated keys are
    sorted, over the whole cluster, so a key that a third of all rows share is no hot task.
    """
    keys = repeated_keys(df, natural)
    if keys is None:
        return df.withColumn(name, F.lit(0).cast("long"))

    def same(prefix: str):
        return reduce(and_, [F.col(c).eqNullSafe(F.col(f"{prefix}{c}")) for c in natural])

    others = [c for c in df.columns if c not in natural]
    placed = dense_keys(df.join(keys, same("__"), "left_semi"), [*natural, *others], "__place")
    first = placed.groupBy(*natural).agg(F.min("__place").alias("__first"))
    first = first.select("__first", *[F.col(c).alias(f"__{c}") for c in natural])
    copies = placed.join(first, same("__"), "left").withColumn(name, F.col("__place") - F.col("__first"))
    return df.join(keys, same("__"), "left_anti").withColumn(name, F.lit(0).cast("long")).unionByName(copies.select(*df.columns, name))
