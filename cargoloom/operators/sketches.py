"""Distinct counts that add up: one sketch per batch, merged without reading the batches again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Base-two logarithm of a sketch's registers: some 16 kB a sketch, standard error ``1.04 / sqrt(2 ** LG_K)``, 0.8 %.
LG_K = 14


def error_bound(lg_k: int = LG_K) -> float:
    """Relative error that three standard errors bound."""
    return 3 * 1.04 / 2 ** (lg_k / 2)


def distinct_sketches(df: DataFrame, column: str, by: Sequence[str], lg_k: int = LG_K) -> DataFrame:
    """Per batch (``by``) its ``rows`` and the ``sketch`` of the column's distinct values (nulls do not count).

    Sketches merge before the shuffle, so a batch that holds a third of all rows sends one sketch per task.
    """
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.hll_sketch_agg(column, lg_k).alias("sketch"))


def merged_distinct(sketch: str = "sketch") -> Column:
    """The estimated distinct values of all grouped sketches together."""
    return F.hll_sketch_estimate(F.hll_union_agg(sketch))
