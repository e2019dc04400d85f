"""Near-duplicate documents by SimHash fingerprints, joined through binary tries.

**Fingerprint.** A-Z are lower-cased, words are runs of other than ASCII white space, shingles are ``words`` words
joined by one space (a shorter text is one shingle). Each of 64 bits is one if more than half of the
shingles' XXH64 values (seed 42) have it. A text without words has fingerprint zero.

**Join.** Two fingerprints link if at most ``distance`` bits differ. A binary trie over the fingerprints is joined
with itself: a pair of nodes of one depth carries the bits that differ above it, its four child pairs add the next
bit, and a pair over its budget is cut with everything below. Of a pair that may differ in ``d`` bits, one of
``1 + d // 2`` equal blocks of bits differs in at most one; so one trie per block, whose path begins with that
block and there allows one differing bit, finds every link with few node pairs. The first ``depth`` levels are walked by
rows: a fingerprint goes to its own node and to the pairs with nodes one bit away. Below, tasks
walk sorted arrays, many pairs at once. Node pairs that hold too many fingerprints for one task
are walked on by rows, level by level, as far as needed.

**Groups.** A task reports a spanning forest of the links it found, never all links of a group. Groups are the
connected components over all tasks, by min-label hooking and shortcutting in rounds of joins, each round written.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cargoloom.llm.common import identified_texts, numbers_of, saved, sliced, texts_of

WORDS, DISTANCE = 4, 4
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(text: str, words: int) -> list[int]:
    cut = text.encode("utf-8", "surrogatepass").lower().split()
    hash_of = xxhash.xxh64_intdigest
    if len(cut) <= words:
        return [hash_of(b" ".join(cut), 42)] if cut else []
    line = b" ".join(cut)
    ends = np.cumsum([len(w) + 1 for w in cut]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    return [
        hash_of(line[a:b], 42)
        for a, b in zip(starts[: len(cut) - words + 1].tolist(), ends[words - 1 :].tolist(), strict=True)
    ]


def majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per group of ``sizes`` hashes the bits set in over half of them; an empty group has none."""
    counts, group_of = np.zeros((len(sizes), 64), np.int64), np.repeat(np.arange(len(sizes)), sizes)
    for first in range(0, len(hashes), 1 << 16):  # a bound on the unpacked bits
        part, groups = hashes[first : first + (1 << 16)], group_of[first : first + (1 << 16)]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        edges = np.flatnonzero(np.diff(groups, prepend=-1))
        counts[groups[edges]] += np.add.reduceat(bits, edges, axis=0, dtype=np.int64)
    over = (2 * counts > sizes[:, None]).astype(np.uint8)
    return np.packbits(over, axis=1, bitorder="little").view("<u8").reshape(-1)


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id`` and ``fp``, the 64 bits as a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 2 << 20):
            hashed = [np.array(shingle_hashes(t, words), np.uint64) for t in texts_of(batch)]
            sizes = np.array([len(h) for h in hashed], np.int64)
            found = majority(np.concatenate(hashed) if hashed else np.zeros(0, np.uint64), sizes)
            yield pa.RecordBatch.from_pydict(
                {"doc_id": pa.array(numbers_of(batch, "doc_id")), "fp": pa.array(found.view(np.int64))}
            )

    return identified_texts(docs).mapInArrow(run, "doc_id long, fp long")


def _blocks(distance: int) -> list[int]:
    """Where each block starts, counted from the highest bit."""
    n = 1 + distance // 2
    return [64 * i // n for i in range(n)]


def _turned(fp: np.ndarray, start: int) -> np.ndarray:
    """The bits turned so that the block at ``start`` is highest."""
    start %= 64
    return fp if not start else (fp << np.uint64(start)) | (fp >> np.uint64(64 - start))


def _turned_column(start: int):
    fp = F.col("fp")
    return fp if not start else F.shiftleft(fp, start).bitwiseOR(F.shiftrightunsigned(fp, 64 - start))


def walk(values: np.ndarray, pairs: np.ndarray, depth: int, block: int, distance: int, report) -> None:
    """Descend from node pairs to pairs of fingerprints and report those that link.

    ``values`` are turned fingerprints, each node's sorted and together. ``pairs`` has rows
    (a0, a1, b0, b1, differing bits): two ranges of ``values``, the same twice for a node with itself.
    """
    stack = [(depth, pairs)]
    while stack:
        level, p = stack.pop()
        if len(p) > 1 << 18:
            stack += [(level, p[i : i + (1 << 18)]) for i in range(0, len(p), 1 << 18)]
            continue
        one = ((p[:, 1] - p[:, 0]) == 1) & ((p[:, 3] - p[:, 2]) == 1)
        leaves = p[one & (p[:, 0] != p[:, 2])]
        if len(leaves):
            a, b = leaves[:, 0], leaves[:, 2]
            linked = np.bitwise_count(values[a] ^ values[b]) <= distance
            report(a[linked], b[linked])
        p = p[~one]
        if not len(p) or level == 64:
            continue
        mask = np.uint64(1 << (63 - level))

        def split(lo: np.ndarray, hi: np.ndarray, level=level, mask=mask) -> np.ndarray:
            """Where the next bit turns to one, in ranges that agree on all bits before it."""
            lo, hi = lo.copy(), hi.copy()
            while (open_ := lo < hi).any():
                middle = (lo + hi) // 2
                is_one = (values[np.minimum(middle, len(values) - 1)] & mask) != 0
                hi = np.where(open_ & is_one, middle, hi)
                lo = np.where(open_ & ~is_one, middle + 1, lo)
            return lo

        sa = split(p[:, 0], p[:, 1])
        sb = split(p[:, 2], p[:, 3])
        same = p[:, 0] == p[:, 2]
        budget = min(1, distance) if level + 1 <= block else distance
        out = []
        for left, right, more in ((0, 0, 0), (1, 1, 0), (0, 1, 1), (1, 0, 1)):
            a0, a1 = (p[:, 0], sa) if left == 0 else (sa, p[:, 1])
            b0, b1 = (p[:, 2], sb) if right == 0 else (sb, p[:, 3])
            kept = (a0 < a1) & (b0 < b1) & (p[:, 4] + more <= budget)
            if (left, right) == (1, 0):
                kept &= ~same  # the mirror of (0, 1)
            if more == 0:
                # A single fingerprint with itself is no pair.
                kept &= ~(same & (a1 - a0 == 1))
            if kept.any():
                out.append(np.column_stack((a0, a1, b0, b1, p[:, 4] + more))[kept])
        if out:
            stack.append((level + 1, np.concatenate(out)))


class Forest:
    """Links that join two trees of indices so far; others add nothing to the groups."""

    def __init__(self, n: int):
        self.root, self.links = np.arange(n), []

    def find(self, i: int) -> int:
        root = self.root
        while root[i] != i:
            root[i] = root[root[i]]
            i = int(root[i])
        return i

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        for _ in range(64):  # hook whole arrays at once, then shortcut, until all links are inside trees
            ra, rb = self.root[a], self.root[b]
            while (self.root[ra] != ra).any() or (self.root[rb] != rb).any():
                ra, rb = self.root[ra], self.root[rb]
            open_ = ra != rb
            a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
            if not len(a):
                return
            high, low = np.maximum(ra, rb), np.minimum(ra, rb)
            _, first = np.unique(high, return_index=True)
            self.root[high[first]] = low[first]
            self.links.append(np.column_stack((a[first], b[first])))
        for i, j in zip(a.tolist(), b.tolist(), strict=True):
            x, y = self.find(i), self.find(j)
            if x != y:
                self.root[max(x, y)] = min(x, y)
                self.links.append(np.array([[i, j]]))


def _join_task(distance: int):
    starts = _blocks(distance)
    ends = [*starts[1:], 64]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        if not rows:
            return
        names = ("trie", "depth", "bits", "left", "right", "side", "fp")
        trie, depth, bits, left, right, side, fp = (
            np.concatenate([numbers_of(b, n) for b in rows]).astype(np.int64) for n in names
        )
        fp = fp.view(np.uint64)
        forest_of, number = np.unique(fp, return_inverse=True)
        forest = Forest(len(forest_of))
        for t in np.unique(trie).tolist():
            for d in np.unique(depth[trie == t]).tolist():
                at = np.flatnonzero((trie == t) & (depth == d))
                turned = _turned(fp[at], starts[t])
                order = np.lexsort((turned, side[at], right[at].view(np.uint64), left[at].view(np.uint64)))
                at, turned = at[order], turned[order]
                # Runs of one node pair and side.
                key = np.column_stack((left[at], right[at], side[at]))
                first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)])
                last = np.r_[first[1:], len(at)]
                head, seen = key[first], bits[at][first]
                itself = head[:, 0] == head[:, 1]
                own = np.column_stack((first, last, first, last, seen))[itself]
                two = np.flatnonzero(
                    ~itself[:-1] & (head[:-1, :2] == head[1:, :2]).all(axis=1) & (head[:-1, 2] != head[1:, 2])
                )
                cross = np.column_stack((first[two], last[two], first[two + 1], last[two + 1], seen[two]))
                to = number[at]
                block = ends[t] - starts[t]
                pairs = np.concatenate((own[own[:, 1] - own[:, 0] > 1], cross))
                walk(turned, pairs, d, block, distance, lambda a, b, to=to: forest.add(to[a], to[b]))
        if forest.links:
            links = np.concatenate(forest.links)
            yield pa.RecordBatch.from_pydict(
                {"a": pa.array(forest_of[links[:, 0]].view(np.int64)), "b": pa.array(forest_of[links[:, 1]].view(np.int64))}
            )

    return run


def _prefix(turned, depth: int):
    return F.shiftrightunsigned(turned, 64 - depth)


def trie_links(distinct: DataFrame, distance: int = DISTANCE, per_node: int = 1000, per_task: int = 200_000) -> DataFrame:
    """Links ``(a, b)`` between different fingerprints of column ``fp`` that span the same groups as all links.

    ``per_node`` is how many fingerprints a node of the first depth holds on average, ``per_task`` how many rows
    one task walks at most on average; a node pair of over ``per_task`` rows is divided into its children first.
    """
    spark, starts = distinct.sparkSession, _blocks(distance)
    n = distinct.count()
    depth = max(2, min(20, math.ceil(math.log2(max(n, 1) / per_node + 1))))
    sides = []
    for t, start in enumerate(starts):
        turned = _turned_column(start)
        node = _prefix(turned, depth)
        near = F.concat(F.array(node), *[F.array(node.bitwiseXOR(F.lit(1 << i).cast("long"))) for i in range(depth * min(1, distance))])
        sides.append(
            distinct.select("fp", turned.alias("turned"), node.alias("node"), F.explode(near).alias("other")).select(
                F.lit(t).alias("trie"),
                F.lit(depth).alias("depth"),
                F.when(F.col("node") == F.col("other"), 0).otherwise(1).alias("bits"),
                F.least("node", "other").alias("left"),
                F.greatest("node", "other").alias("right"),
                F.when(F.col("node") <= F.col("other"), 0).otherwise(1).alias("side"),
                "fp",
                "turned",
            )
        )
    rows = sides[0]
    for more in sides[1:]:
        rows = rows.unionByName(more)
    pair = ["trie", "depth", "left", "right"]
    whole = ["trie", "depth", "bits", "left", "right", "side", "fp"]
    found = None
    while True:
        tall = rows.groupBy(*pair).agg(F.count("*").alias("held")).where(F.col("held") > per_task)
        tall = saved(tall.withColumn("one", F.col("left") == F.col("right")), "tall-nodes")
        heavy = tall.count() and depth < 64
        small = rows.join(tall.select(*pair), pair, "left_anti") if heavy else rows
        total = n * len(starts) * (1 + depth)
        task = small.select(*whole).repartition(max(1, math.ceil(total / per_task)), *pair)
        links = saved(task.mapInArrow(_join_task(distance), "a long, b long"), "links")
        found = links if found is None else found.unionByName(links)
        if not heavy:
            return found
        rows = saved(_children(rows.join(tall.select(*pair), pair, "left_semi"), depth, distance), "node-pairs")
        depth += 1


def _children(rows: DataFrame, depth: int, distance: int) -> DataFrame:
    """The rows of node pairs dealt to the pairs' children one level down, within the budget."""
    starts = _blocks(distance)
    ends = [*starts[1:], 64]
    bit = _prefix(F.col("turned"), depth + 1).bitwiseAND(F.lit(1).cast("long"))
    itself = F.col("left") == F.col("right")
    block = F.element_at(F.array(*[F.lit(e - s) for s, e in zip(starts, ends, strict=True)]), F.col("trie") + 1)
    budget = F.when(F.lit(depth + 1) <= block, min(1, distance)).otherwise(distance)
    other = F.explode(F.array(F.lit(0).cast("long"), F.lit(1).cast("long"))).alias("other")
    dealt = rows.select("*", bit.alias("bit"), other)
    l_bit = F.when(F.col("side") == 0, F.col("bit")).otherwise(F.col("other"))
    r_bit = F.when(F.col("side") == 0, F.col("other")).otherwise(F.col("bit"))
    differs = (F.col("bit") != F.col("other")).cast("int")
    # A node with itself has one pair of different children, whose lower side is child zero.
    crossing = itself & (F.col("bit") != F.col("other"))
    return (
        dealt.withColumn("new_bits", F.col("bits") + differs)
        .where(F.col("new_bits") <= budget)
        .select(
            "trie",
            F.lit(depth + 1).alias("depth"),
            F.col("new_bits").alias("bits"),
            F.when(crossing, F.col("left") * 2).otherwise(F.col("left") * 2 + l_bit).alias("left"),
            F.when(crossing, F.col("right") * 2 + 1).otherwise(F.col("right") * 2 + r_bit).alias("right"),
            F.when(crossing, F.col("bit").cast("int")).otherwise(F.col("side")).alias("side"),
            "fp",
            "turned",
        )
    )


def components(links: DataFrame) -> DataFrame:
    """Per linked node the least node of its group: ``(node, least)``.

    Every round moves each node's link to the least neighbour (both ways of the two-star method), so the
    rounds grow with the logarithm of a chain's length. Minima are taken before the shuffle, so a busy node
    arrives as one row per task.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = saved(edges, "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Large star: bigger neighbours move to the least of the neighbourhood.
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = saved(large.where("u <> v"), "large-star")
        # Small star: smaller neighbours and the node itself move to the least smaller one.
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u")
        moved = (
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(lower.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct()
        )
        moved = saved(moved, "small-star")
        # Done when every node has one link and links go to least nodes only.
        several = moved.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
        inner = moved.join(moved.select(F.col("u").alias("v")), "v", "left_semi").limit(1).count()
        edges = moved
        if not several and not inner:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("least")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("least")).distinct()
    )


def near_duplicates(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hexadecimal digits) and ``component_id``, the least ``doc_id`` of its group.

    Null texts are empty and link with each other and with texts without words. Rows without
    ``doc_id`` are left out; repeated rows each have a row, in one group if their texts are equal. Other columns are
    ignored; an empty table gives none. Equal fingerprints are one node, however many documents have it.
    """
    prints = saved(fingerprints(docs, words), "fingerprints")
    distinct = saved(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    groups = components(trie_links(distinct.select("fp"), distance))
    grouped = distinct.join(groups.withColumnRenamed("node", "fp"), "fp")
    firsts = grouped.groupBy("least").agg(F.min("first").alias("component"))
    known = grouped.join(firsts, "least").select("fp", "component")
    label = distinct.join(known, "fp", "left").select("fp", F.coalesce("component", "first").alias("component_id"))
    return prints.join(label, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def without_near_duplicates(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """``docs`` with one row of each group: that of the least ``doc_id``, all its columns as they were.

    An id goes if each of its rows is in a group with a smaller id. Of rows that repeat an id that stays one is
    kept, the first by hash of the text and then of all columns. Rows without an id have no group and stay.
    """
    groups = near_duplicates(docs.select("doc_id", "text"), words, distance)
    ids = saved(groups.groupBy("doc_id").agg(F.max("component_id").alias("group"), F.count("*").alias("n")), "grouped-ids")
    kept = docs.join(ids.where("group < doc_id").select("doc_id"), "doc_id", "left_anti").select(*_names(docs))
    repeated = ids.where("n > 1").select("doc_id")
    if not repeated.limit(1).count():
        return kept
    several = kept.join(repeated, "doc_id", "left_semi").select(*_names(docs))
    order = [F.xxhash64(F.coalesce("text", F.lit(""))), F.xxhash64(F.to_json(F.struct(*_names(docs))))]
    one = several.withColumn("__order", F.row_number().over(Window.partitionBy("doc_id").orderBy(*order)))
    single = kept.join(repeated, "doc_id", "left_anti").select(*_names(docs))
    return single.unionByName(one.where("__order = 1").drop("__order"))


def _names(docs: DataFrame) -> list[str]:
    return [f"`{c}`" for c in docs.columns]
