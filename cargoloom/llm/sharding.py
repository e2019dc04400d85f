"""Placement of documents on shards by a lookup table that permutations fill.

Every shard orders all slots of a table of prime size by a permutation of its own (an offset and a
step, both from a hash of its name). The shards take turns; in its turn a shard claims the first
slot of its order that is still free, until none is free. A document goes to the shard of slot
``hash(key) mod size``: one lookup, whatever the number of shards. Shards get equal numbers of slots up
to one per unit of weight, and a shard that joins or leaves moves few slots but its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_SIZE = 65_537


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def _hash(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.sha256(f"{salt}\x00{name}".encode()).digest()[:8], "big")


def lookup_table(shards: Sequence[str] | Mapping[str, int], size: int = TABLE_SIZE) -> np.ndarray:
    """The shard number (place in the sorted names) of every slot.

    ``shards`` names the shards, or maps names to whole weights: a shard of weight 3 claims three slots
    a turn. Order and repeats of names do not matter. ``size`` must be prime and at least the sum of
    weights; it bounds the table and what is broadcast.
    """
    weights = dict(shards) if isinstance(shards, Mapping) else dict.fromkeys(shards, 1)
    weights = {name: int(w) for name, w in weights.items() if int(w) > 0}
    if not weights:
        raise ValueError("no shard with a positive weight")
    if not _is_prime(size) or size < sum(weights.values()):
        raise ValueError("the table size must be a prime, no smaller than the sum of weights")
    names = sorted(weights)
    orders = [
        ((_hash(n, "offset") % size + np.arange(size) * (_hash(n, "step") % (size - 1) + 1)) % size) for n in names
    ]
    table, at, free = np.full(size, -1, np.int32), [0] * len(names), size
    while free:
        for i, name in enumerate(names):
            for _ in range(min(weights[name], free)):
                order = orders[i]
                while table[order[at[i]]] >= 0:
                    at[i] += 1
                table[order[at[i]]] = i
                free -= 1
            if not free:
                break
    return table


def table_frame(spark: SparkSession, table: np.ndarray, names: Sequence[str]) -> DataFrame:
    """The table as rows ``(slot, shard, shard_name)``."""
    ordered = sorted(set(names))
    return spark.createDataFrame(
        [(slot, int(s), ordered[s]) for slot, s in enumerate(table.tolist())], "slot int, shard int, shard_name string"
    )


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    """The slot of a key: the first 48 bits of the MD5 of its text, modulo the size; a null key has the empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 12), 16, 10).cast("long"), F.lit(size)).cast("int")


def place(docs: DataFrame, shards: Sequence[str] | Mapping[str, int], key: str = "doc_id", size: int = TABLE_SIZE):
    """``docs`` with ``slot``, ``shard`` and ``shard_name`` of the key; columns of those names are replaced.

    Every row gets exactly one shard: repeated keys the same one, null keys that of the empty text, and an
    empty table gives an empty frame. The table (``size`` rows) is broadcast: no row is shuffled.
    """
    names = [n for n, w in (shards.items() if isinstance(shards, Mapping) else ((n, 1) for n in shards)) if int(w) > 0]
    kept = [c for c in docs.columns if c not in ("slot", "shard", "shard_name")]
    found = table_frame(docs.sparkSession, lookup_table(shards, size), names)
    return docs.select(*[F.col(f"`{c}`") for c in kept], slot_of(docs[key], size).alias("slot")).join(
        F.broadcast(found), "slot"
    )


def write_shards(placed: DataFrame, path: str) -> DataFrame:
    """One directory per shard, written whole rows and all, and read back. Rows are rebalanced on their shard: few files in each,
    and a shard that holds much of the data is written by several tasks."""
    placed.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
    return placed.sparkSession.read.schema(placed.schema).parquet(path).select(*placed.columns)
