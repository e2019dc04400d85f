"""Upsert of a dimension as a new snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def updatable_columns(df: DataFrame, key: str, foreign_keys: Sequence[str] = ()) -> list[str]:
    return [c for c in df.columns if c != key and c not in foreign_keys]


def upsert(
    current: DataFrame, incoming: DataFrame, key: str, update_columns: Sequence[str] | None = None
) -> DataFrame:
    """``current`` with ``incoming`` merged in by ``key``, which must be unique in both.

    A new key is inserted with all its columns. A known key takes the incoming value,
    null included, in ``update_columns`` (by default all but the key) and keeps its other
    columns, such as foreign keys. Columns are matched by name.
    """
    if set(current.columns) != set(incoming.columns):
        raise ValueError(f"columns differ: {sorted(set(current.columns) ^ set(incoming.columns))}")
    updated = set(updatable_columns(current, key) if update_columns is None else update_columns)
    old, new = current.withColumn("__there", F.lit(True)), incoming.withColumn("__there", F.lit(True))
    old, new = old.alias("old"), new.alias("new")
    came, was = F.col("new.__there").isNotNull(), F.col("old.__there").isNotNull()

    def merged(column: str):
        ours, theirs = F.col(f"old.`{column}`"), F.col(f"new.`{column}`")
        picked = F.when(came, theirs).otherwise(ours) if column in updated else F.when(was, ours).otherwise(theirs)
        return picked.alias(column)

    joined = old.join(new, F.col(f"old.`{key}`") == F.col(f"new.`{key}`"), "full_outer")
    return joined.select(*[merged(c) for c in current.columns])
