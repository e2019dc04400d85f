"""Joins that need more than ``DataFrame.join``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargoloom.session import new_work_path

_SALTS = "__salts"
_SALT = "__salt"
_HIT = "__hit"


#: A key with more rows than this is spread over several tasks.
ROWS_PER_TASK = 1_000_000


def frequent_keys(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``key`` and ``__salts`` for each value with more than ``rows_per_task`` rows: how many tasks' worth of rows it has.

    Exact counts, summed before the shuffle, so a busy key arrives as one row per task. The list has at most
    rows / ``rows_per_task`` entries. It is written to the work folder, for it is used more than once.
    """
    counted = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    salts = F.ceil(F.col("__n") / F.lit(rows_per_task)).cast("int").alias(_SALTS)
    frequent = counted.where(F.col("__n") > rows_per_task).select(key, salts)
    path = new_work_path(df.sparkSession, "frequent-keys")
    # Gathered after the count: ``coalesce`` would have one task count all keys.
    frequent.repartition(1).write.parquet(path)
    return df.sparkSession.read.schema(frequent.schema).parquet(path)


def fan_out_left_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread_by: Sequence[str],
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """``left LEFT JOIN right USING (key)`` where the right side may repeat a key very often.

    Adaptive execution splits a hot partition of a left join only on the left side.
    So the right rows of a frequent key are spread over several salts by a hash of
    ``spread_by``, and the few left rows of that key are copied once per salt. A copy
    whose salt got no right row is dropped: the key is known to have matches, so the
    copy is never the row that must stay unmatched. Keys that are not frequent take
    the plain join, and so does everything where no key is frequent.
    """
    salts = frequent_keys(right, key, rows_per_task)
    if salts.isEmpty():
        return left.join(right, key, "left")

    spread = (
        right.join(salts, key, "left")
        .withColumn(
            _SALT,
            F.when(F.col(_SALTS).isNull(), F.lit(0)).otherwise(
                F.pmod(F.xxhash64(*spread_by), F.col(_SALTS).cast("long")).cast("int")
            ),
        )
        .drop(_SALTS)
        .withColumn(_HIT, F.lit(True))
    )
    copied = left.join(salts, key, "left").withColumn(
        _SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_SALTS), F.lit(1)) - 1))
    )
    return (
        copied.join(spread, [key, _SALT], "left")
        .filter(F.col(_SALTS).isNull() | F.col(_HIT).isNotNull())
        .drop(_SALT, _SALTS, _HIT)
    )
