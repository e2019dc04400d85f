"""Nearest neighbours by inner product: one hierarchical navigable small-world graph per shard, results merged.

Vectors are dealt to shards by a hash of their number, some ``SHARD_ROWS`` each. A shard's graph has layers: each vector is in layer 0 and
with probability ``1 / LINKS`` in each further one. Vectors are inserted a block at a time: a beam search in what stands already finds
a vector's candidates, to which the rest of its block comes. In a layer a vector keeps up to ``LINKS`` neighbours (twice as many in layer
0): candidates from near to far, each kept only if it is nearer to the vector than to those kept before; every link is
made both ways and the furthest are dropped. A graph is stored as flat arrays: numbers, vectors, and for each
layer one row of neighbour places per member (-1: none); vectors of higher layers come first, so a layer's members are the first so many.

Largest inner product is not a metric, so graphs use one more coordinate, ``sqrt(m - |x|^2)`` with ``m`` the largest squared norm
(queries: 0): nearest in that space are the largest inner products. Scores are of the original vectors, in doubles.

A block of queries goes down a graph together: greedily through the upper layers, then with a beam through layer 0. Every
query visits every shard; its best of all shards are merged by a ranking per query. Equal vectors are one vector in
the graph; they are told apart at the end, where the ``k + 1`` of smallest number are enough.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cargoloom.llm.common import saved

#: The beam is the same in every shard, whatever their number: one shard may hold most of a query's nearest.
LINKS, BEAM, SHARD_ROWS, BLOCK = 24, 160, 16384, 512
#: Query blocks that one task takes through one graph.
GROUP_BLOCKS = 16


def usable(vector: str = "embedding") -> Column:
    """Whether a vector takes part: it and its components are there and finite, and not all are zero."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0)


def _layers(n: int, seed: int) -> np.ndarray:
    draw = np.random.default_rng(seed).random(n)
    return np.minimum((-np.log(np.maximum(draw, 1e-300)) / math.log(LINKS)).astype(int), 8)


def _diverse(near: np.ndarray, distance: np.ndarray, points: np.ndarray, most: int) -> np.ndarray:
    """Of each row's candidates, nearest first, up to ``most`` that are nearer to the row than to any kept before."""
    n, width = near.shape
    those = points[np.maximum(near, 0)]
    squares = (those**2).sum(axis=2)
    gap = squares[:, :, None] + squares[:, None, :] - 2 * those @ those.transpose(0, 2, 1)
    kept = np.full((n, most), -1)
    held = np.zeros(n, int)
    left = near >= 0
    nearest_kept = np.full((n, width), np.inf)
    for j in range(width):
        fine = np.flatnonzero(left[:, j] & (held < most) & (distance[:, j] < nearest_kept[:, j]))
        kept[fine, held[fine]] = near[fine, j]
        held[fine] += 1
        left[fine, j] = False
        nearest_kept[fine] = np.minimum(nearest_kept[fine], gap[fine, j])
    # Free room goes to the nearest that were passed over, so that close groups stay well linked inside.
    for j in range(width):
        more = np.flatnonzero(left[:, j] & (held < most // 2))
        kept[more, held[more]] = near[more, j]
        held[more] += 1
    return kept


def _down(layers: list[np.ndarray], points: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """The place that each target reaches greedily through ``layers``, from the top down; place 0 without layers."""
    row = np.arange(len(targets))
    at = np.zeros(len(targets), int)
    best = -(targets @ points[0])
    for links in layers:
        live = row
        while len(live):
            near = links[at[live]]
            d = -np.einsum("qkd,qd->qk", points[np.maximum(near, 0)], targets[live])
            d[near < 0] = np.inf
            i = d.argmin(axis=1)
            least = d[np.arange(len(live)), i]
            better = least < best[live]
            to = near[np.arange(len(live)), i][better]
            live = live[better]
            at[live], best[live] = to, least[better]
    return at


def _beam(links: np.ndarray, points: np.ndarray, entry: np.ndarray, targets: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The best places found for each target in one layer, in no order (-1: none), and their negative inner products."""
    n, q = len(links), len(targets)
    beam = min(beam, n)
    row = np.arange(q)
    held, distance = np.full((q, beam), -1), np.full((q, beam), np.inf)
    done = np.ones((q, beam), bool)
    held[:, 0], distance[:, 0], done[:, 0] = entry, -np.einsum("qd,qd->q", points[entry], targets), False
    seen = np.zeros((q, n), bool)
    seen[row, entry] = True
    live = row
    while True:
        open_ = np.where(done[live], np.inf, distance[live])
        i = open_.argmin(axis=1)
        some = np.isfinite(open_[np.arange(len(live)), i])
        live, i = live[some], i[some]
        if not len(live):
            return held, distance
        done[live, i] = True
        near = links[held[live, i]]
        fresh = (near >= 0) & ~seen[live[:, None], np.maximum(near, 0)]
        of, place = np.nonzero(fresh)[0], near[fresh]
        seen[live[of], place] = True
        d = np.full(near.shape, np.inf)
        d[fresh] = -np.einsum("id,id->i", points[place], targets[live[of]])
        every = np.concatenate((distance[live], d), axis=1)
        order = np.argpartition(every, beam - 1, axis=1)[:, :beam]
        held[live] = np.take_along_axis(np.concatenate((held[live], np.where(fresh, near, -1)), axis=1), order, 1)
        done[live] = np.take_along_axis(np.concatenate((done[live], ~fresh), axis=1), order, 1)
        distance[live] = np.take_along_axis(every, order, 1)


def _grown(points: np.ndarray, most: int, above: list[np.ndarray]) -> np.ndarray:
    """One layer: the neighbours of every point, which are inserted in their order, a block at a time.

    A point's candidates are what a beam of ``2 * most`` finds among the points before its block, from where the layers ``above`` lead,
    and the rest of its block. Links go both ways; a point keeps the nearest ``most`` it was ever given."""
    n = len(points)
    links, far = np.full((n, most), -1), np.full((n, most), np.inf)
    squares = (points**2).sum(axis=1)
    for first in range(0, n, BLOCK):
        rows = np.arange(first, min(first + BLOCK, n))
        own = points[rows]
        distance = squares[rows][:, None] - 2 * own @ own.T + squares[rows]
        np.fill_diagonal(distance, np.inf)
        near = np.broadcast_to(rows, distance.shape)
        if first:
            entry = _down(above, points, own)
            # The layers above hold points that are not yet in this one.
            held, product = _beam(links[:first], points[:first], np.where(entry < first, entry, 0), own, 2 * most)
            gap = squares[rows][:, None] + 2 * product + squares[np.maximum(held, 0)]
            near = np.concatenate((held, near), axis=1)
            distance = np.concatenate((np.where(held >= 0, gap, np.inf), distance), axis=1)
        width = min(2 * most, distance.shape[1])
        some = np.argpartition(distance, width - 1, axis=1)[:, :width]
        some = np.take_along_axis(some, np.argsort(np.take_along_axis(distance, some, 1), axis=1, kind="stable"), 1)
        near, distance = np.take_along_axis(near, some, 1), np.take_along_axis(distance, some, 1)
        kept = _diverse(np.where(np.isfinite(distance), near, -1), distance, points, most // 2)
        a, b = np.repeat(rows, kept.shape[1]), kept.ravel()
        a, b = a[b >= 0], b[b >= 0]
        pair = np.unique(np.concatenate((a * n + b, b * n + a)))
        a, b = pair // n, pair % n
        gap = ((points[a] - points[b]) ** 2).sum(axis=1)
        touched = np.unique(a)
        old = links[touched]
        a = np.concatenate((a, np.repeat(touched, most)[old.ravel() >= 0]))
        gap = np.concatenate((gap, far[touched].ravel()[old.ravel() >= 0]))
        b = np.concatenate((b, old[old >= 0]))
        order = np.lexsort((b, gap, a))
        a, b, gap = a[order], b[order], gap[order]
        rank = np.arange(len(a)) - np.searchsorted(a, a)
        inside = rank < most
        links[touched], far[touched] = -1, np.inf
        links[a[inside], rank[inside]], far[a[inside], rank[inside]] = b[inside], gap[inside]
    return links


class Graph:
    """One shard. ``layers`` has, from the top down, the neighbours' places of each layer's members; a layer holds the first so many places."""

    def __init__(self, numbers: np.ndarray, vectors: np.ndarray):
        self.numbers, self.vectors = numbers, vectors
        self.layers: list[np.ndarray] = []

    @classmethod
    def built(cls, numbers: np.ndarray, vectors: np.ndarray, largest: float) -> Graph:
        """Places go by layer, highest first, and by chance within a layer."""
        n = len(numbers)
        level = _layers(n, n)
        order = np.lexsort((np.random.default_rng(n + 1).random(n), -level))
        graph = cls(numbers[order], vectors[order])
        wide = np.sqrt(np.maximum(largest - (graph.vectors**2).sum(axis=1), 0.0))
        points = np.column_stack((graph.vectors, wide))
        for layer in range(int(level.max()), -1, -1):
            members = int((level >= layer).sum())
            if not layer or members >= 4:
                graph.layers.append(_grown(points[:members], LINKS if layer else 2 * LINKS, list(graph.layers)))
        return graph

    def flat(self) -> dict:
        """The shard as flat arrays, in bytes."""
        return {
            "numbers": self.numbers.astype("<i8").tobytes(),
            "vectors": self.vectors.astype("<f8").tobytes(),
            "width": self.vectors.shape[1],
            "links": np.concatenate([x.ravel() for x in self.layers]).astype("<i4").tobytes(),
            "sizes": [len(x) for x in self.layers],
        }

    @classmethod
    def of(cls, row) -> Graph:
        graph = cls(np.frombuffer(row["numbers"], "<i8"), np.frombuffer(row["vectors"], "<f8").reshape(-1, row["width"]))
        links, sizes, at = np.frombuffer(row["links"], "<i4"), list(row["sizes"]), 0
        for i, n in enumerate(sizes):
            wide = 2 * LINKS if i == len(sizes) - 1 else LINKS
            graph.layers.append(links[at : at + n * wide].reshape(n, wide))
            at += n * wide
        return graph

    def search(self, queries: np.ndarray, k: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the ``k`` nearest found for each query (-1: none), and their scores."""
        beam = min(max(beam, 2 * k), len(self.numbers))
        # All points have one length with their further coordinate and a query's is zero, so nearer is: larger inner product.
        held, distance = _beam(self.layers[-1], self.vectors, _down(self.layers[:-1], self.vectors, queries), queries, beam)
        held[~np.isfinite(distance)] = -1
        score = np.where(held >= 0, np.einsum("qkd,qd->qk", self.vectors[np.maximum(held, 0)], queries), -np.inf)
        number = np.where(held >= 0, self.numbers[np.maximum(held, 0)], np.iinfo(np.int64).max)
        order = np.lexsort((number, -score), axis=1)[:, : min(k, beam)]
        return np.take_along_axis(held, order, 1), np.take_along_axis(score, order, 1)


_GRAPH = "shard int, numbers binary, vectors binary, width int, links binary, sizes array<int>"


def build(different: DataFrame, shards: int, largest: float) -> DataFrame:
    """One row per shard, its graph in flat arrays. ``different`` has ``number`` and ``vector``, no vector twice."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("number")
        numbers = rows.column("number").to_numpy()
        vectors = np.stack(rows.column("vector").to_numpy(zero_copy_only=False)).astype(np.float64)
        flat = Graph.built(numbers, vectors, largest).flat()
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32())} | {c: [v] for c, v in flat.items()}).cast(target)

    binary, integer = pa.binary(), pa.int32()
    target = pa.schema(
        [("shard", integer), ("numbers", binary), ("vectors", binary), ("width", integer), ("links", binary), ("sizes", pa.list_(integer))]
    )
    dealt = different.withColumn("shard", F.pmod(F.xxhash64("number"), F.lit(shards)).cast("int"))
    return saved(dealt.groupBy("shard").applyInArrow(run, _GRAPH), "graphs")


def search(graphs: DataFrame, queries: DataFrame, shards: int, asked: int, k: int, beam: int = BEAM) -> DataFrame:
    """For every query (``number``, ``vector``) and shard its ``k`` best: ``query``, ``number``, ``score``.

    Queries travel in blocks, one copy of a block per shard: what is shuffled grows with queries times shards, as it must
    where each shard has a graph of its own. ``asked``, the number of queries, tells in how many groups blocks are dealt: a
    task holds one graph and the blocks of one group."""
    groups = max(1, math.ceil(asked / (BLOCK * GROUP_BLOCKS)))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column(0).to_numpy()
            vectors = np.stack(batch.column(1).to_numpy(zero_copy_only=False)).astype("<f8") if len(numbers) else None
            for at in range(0, len(numbers), BLOCK):
                part = slice(at, at + BLOCK)
                yield pa.RecordBatch.from_pydict(
                    {"queries": pa.array([numbers[part].astype("<i8").tobytes()]), "targets": pa.array([vectors[part].tobytes()])}
                )

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in left.to_dict("records"):
            graph = Graph.of(row)
            for numbers, targets in zip(right["queries"], right["targets"], strict=True):
                of = np.frombuffer(numbers, "<i8")
                places, score = graph.search(np.frombuffer(targets, "<f8").reshape(len(of), -1), k, beam)
                found = places >= 0
                out.append(
                    pd.DataFrame(
                        {
                            "query": np.repeat(of, places.shape[1])[found.ravel()],
                            "number": graph.numbers[places[found]],
                            "score": score[found],
                        }
                    )
                )
        return pd.concat(out) if out else pd.DataFrame({"query": [], "number": [], "score": []})

    # A block is part of one task's batch; blocks far below ``BLOCK`` rows would each cost as much as a whole one.
    even = queries.select("number", "vector").repartition(groups, "number")
    blocks = even.mapInArrow(pack, "queries binary, targets binary")
    blocks = blocks.withColumn("part", F.pmod(F.xxhash64("queries"), F.lit(groups)).cast("int"))
    everywhere = blocks.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    copies = graphs.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    return copies.groupBy("shard", "part").cogroup(everywhere.groupBy("shard", "part")).applyInPandas(run, "query long, number long, score double")


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    number: str = "vec_id",
    vector: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    beam: int = BEAM,
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score``: for the rows that ``is_query`` tells, their ``k`` nearest others.

    Rows whose number or vector is null, or whose vector is zero or holds null or non-finite components, take no part. A vector of
    other width than most is left out as well. Rows that repeat a number count once, by the least vector. Ties go to the smaller
    number. Fewer others than ``k``: all of them that were found. Other columns are ignored; an empty table gives none.
    """
    rows = vectors.where(F.col(number).isNotNull()).where(usable(vector))
    rows = rows.select(
        F.col(number).cast("long").alias("id"),
        F.col(vector).cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    widths = rows.groupBy(F.size("vector").alias("width")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "width").first()
    if widths is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("vector") == widths["width"])
    rows = saved(rows.groupBy("id").agg(F.min("vector").alias("vector"), F.max("asks").alias("asks")), "vectors")
    # Equal vectors: one number stands for them; of its members the k + 1 smallest can be needed at most.
    stands = rows.groupBy("vector").agg(F.min("id").alias("number"), F.max("asks").alias("asks"))
    stands = saved(stands, "different-vectors")
    square = reduce(lambda a, b: a + b, [F.pow(F.get("vector", F.lit(i)), 2) for i in range(widths["width"])])
    figures = stands.agg(F.count("*").alias("n"), F.max(square).alias("largest"), F.count_if("asks").alias("asked")).first()
    shards = max(1, math.ceil(figures["n"] / shard_rows))
    graphs = build(stands.select("number", "vector"), shards, figures["largest"])
    asked = stands.where("asks").select("number", "vector")
    # One more than k, as the query's own vector may be among them.
    found = search(graphs, asked, shards, figures["asked"], k + 1, beam)
    best = Window.partitionBy("query").orderBy(F.desc("score"), "number")
    merged = saved(found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1), "merged")
    member = rows.join(stands.select("vector", "number"), "vector").select("id", "number", "asks")
    first = Window.partitionBy("number").orderBy("id")
    # A limit within each number that no result can exceed, as ties go to smaller ids.
    few = saved(member.withColumn("place", F.row_number().over(first)).where(F.col("place") <= k + 1).select("id", "number"), "members")
    askers = member.where("asks").select(F.col("id").alias("query_id"), F.col("number").alias("query"))
    # Candidates per different query vector, the k + 1 best of them: enough for any asker of that vector but itself.
    candidates = merged.select("query", "number", "score").join(few, "number").select("query", F.col("id").alias("vec_id"), "score")
    ranked = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    short = candidates.withColumn("place", F.row_number().over(ranked)).where(F.col("place") <= k + 1).drop("place")
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        askers.join(short, "query")
        .where("query_id <> vec_id")
        .withColumn("rank", F.row_number().over(final))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
