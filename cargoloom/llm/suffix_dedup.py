"""Repeated passages removed, found by merging Burrows-Wheeler transforms of shards.

A byte goes if some string of ``length`` bytes that covers it also starts earlier (in a document of smaller id, or earlier in
the same one). Strings are judged on the input and never cross documents.

**Where strings can meet.** Every string of ``length`` bytes has one anchor: of the hashes of its ``k``-byte substrings the
least, leftmost if tied. Equal strings have equal anchors. The strings of a document that share an anchor are neighbours; they
make one fragment. Only fragments of one anchor value can hold equal strings, so fragments are dealt by it. Fragments
that are equal as a whole are collapsed before the shuffle, and after it: all but the first are repeats from end to end.
An anchor value with one fragment left needs no more work; bytes travel for the others only.

**What is equal.** The distinct fragments of an anchor value are put in shards. A shard sorts its rotations (each fragment with
an end mark, as a ring) by their first ``length`` symbols and so has its Burrows-Wheeler transform, here with the ``STRIDE``
symbols before each rotation as one letter. Shards are merged without sorting rotations again: an interleave of their
entries starts as shard after shard; dealing its entries stably by their transform's letter gives the interleave for
``STRIDE`` symbols more. Entries that agreed so far and have one letter stay in one block, the others part: where two neighbours part
is their common prefix. After ``length`` symbols every block of two or more is a repeated interval, and of
its strings all but the earliest are repeats.

**Busy anchors.** Where the fragments of one anchor value exceed ``most_bytes``, its fragments are cut again by anchors of more
bytes, last of ``length`` bytes, where every value stands for one string: no task has to hold what a common line's neighbours are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargoloom.llm.common import identified_texts, numbers_of, saved, sliced, texts_of
from cargoloom.operators.keys import dense_keys

LENGTH = 100
#: Bytes of the first anchors and of those that busy ones are cut by; the last step is always ``length``.
ANCHOR, FINER = 32, (64,)
STRIDE = 10
SHARD_BYTES, RUN_BYTES = 1 << 18, 1 << 20
#: Bytes of distinct fragments of one anchor value that one task may hold.
MOST_BYTES = 2 << 20
#: Fragments collapsed together on the map side.
COLLAPSE = 400_000
_BASE = 0x9E3779B97F4A7C15
_SEGMENT = 1 << 23
_48 = np.uint64((1 << 48) - 1)


def _window_hashes(raw: np.ndarray, k: int) -> np.ndarray:
    """A mixed 64-bit hash of every ``k`` bytes, by doubling."""
    with np.errstate(over="ignore"):
        power, grown = np.uint64(_BASE), raw.astype(np.uint64) + np.uint64(1)
        size, done, out = 1, 0, None
        while True:
            if k & size:
                # ``out`` covers ``done`` bytes; append the next ``size``.
                if out is None:
                    out = grown
                else:
                    n = len(raw) - done - size + 1
                    out = out[:n] * power + grown[done : done + n]
                done += size
            if 2 * size > k:
                break
            grown = grown[:-size] * power + grown[size:]
            power, size = power * power, 2 * size
        out = out ^ (out >> np.uint64(29))
        out = out * np.uint64(0xBF58476D1CE4E5B9)
        return out ^ (out >> np.uint64(32))


def anchored(raw: np.ndarray, k: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fragments of a text: first string's start, length in bytes, and the anchor's hash."""
    starts, sizes, anchors = [], [], []
    for begin in range(0, max(len(raw) - length + 1, 0), _SEGMENT):
        part = raw[begin : begin + _SEGMENT + length - 1]
        h = _window_hashes(part, k)
        w, n = length - k + 1, len(part) - length + 1
        low = np.uint64((1 << 24) - 1)
        key = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        rows = -(-len(key) // w)
        block = np.full(rows * w, np.iinfo(np.uint64).max, np.uint64)
        block[: len(key)] = key
        block = block.reshape(rows, w)
        after = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
        before = np.minimum.accumulate(block, axis=1).ravel()
        at = (np.minimum(after[:n], before[w - 1 : w - 1 + n]) & low).astype(np.int64)
        first = np.flatnonzero(np.diff(at, prepend=-1))
        starts.append(first + begin)
        sizes.append(np.diff(np.append(first, n)) + length - 1)
        anchors.append(h[at[first]])
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(starts), np.concatenate(sizes), np.concatenate(anchors)


_PACKED = np.dtype([("h", "<u8"), ("f", "<u8"), ("doc", "<i8"), ("start", "<i4"), ("size", "<i4")])


def _collapse(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first of each set of equal fragments, and the others. Firsts are in order of anchor and fragment."""
    rows = rows[np.lexsort((rows["start"], rows["doc"], rows["f"], rows["h"]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows["h"][1:] != rows["h"][:-1]) | (rows["f"][1:] != rows["f"][:-1])
    return rows[new], rows[~new]


def _columns(rows: np.ndarray) -> bytes:
    """Packed rows, column by column and ids and starts as differences, which compress well."""
    rows = rows[np.lexsort((rows["start"], rows["doc"]))]
    doc = np.diff(rows["doc"], prepend=0)
    six = [np.ascontiguousarray(rows[c]).view(np.uint8).reshape(-1, 8)[:, :6].tobytes() for c in ("h", "f")]
    return b"".join([np.int64(len(rows)).tobytes(), *six, doc.tobytes(), rows["start"].tobytes(), rows["size"].astype("<i4").tobytes()])


def _rows(data: bytes) -> np.ndarray:
    n = int(np.frombuffer(data, "<i8", 1)[0])
    rows, at = np.zeros(n, _PACKED), 8
    for c in ("h", "f"):
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :6] = np.frombuffer(data, np.uint8, 6 * n, at).reshape(n, 6)
        rows[c], at = wide.view("<u8").ravel(), at + 6 * n
    rows["doc"], at = np.cumsum(np.frombuffer(data, "<i8", n, at)), at + 8 * n
    rows["start"], at = np.frombuffer(data, "<i4", n, at), at + 4 * n
    rows["size"] = np.frombuffer(data, "<i4", n, at)
    return rows


def _ranges(doc: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Ranges joined where they touch, in order."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    if not len(doc):
        return doc, start, end
    # The furthest end so far, per document: ends are shifted so that every document lies behind the one before it.
    number = np.cumsum(np.diff(doc, prepend=doc[0] - 1) != 0)
    shift = number * (int(end.max()) + 2)
    reach = np.maximum.accumulate(end + shift)
    new = np.ones(len(doc), bool)
    new[1:] = start[1:] + shift[1:] > reach[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], start[first], reach[last] - shift[last]


_FOUND = "doc_id long, start int, size int, h long"
_NO_ANCHOR = 0


def _found(doc, start, size, h=None) -> pa.RecordBatch:
    h = np.full(len(doc), -1, np.int64) if h is None else h
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": pa.array(doc, pa.int64()),
            "start": pa.array(start, pa.int32()),
            "size": pa.array(size, pa.int32()),
            "h": pa.array(h, pa.int64()),
        }
    )


def _fragments(length: int, buckets: int):
    """Map side: each document's fragments, collapsed, dealt by anchor; what is a repeat already goes with them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            firsts, others = _collapse(np.concatenate(held))
            doc, start, end = _ranges(others["doc"], others["start"].astype(np.int64), others["start"] + others["size"].astype(np.int64))
            known = np.zeros(len(doc), _PACKED)
            known["doc"], known["start"], known["size"] = doc, start, end - start
            bucket = (firsts["h"] % np.uint64(buckets)).astype(np.int64)
            aside = (xxhash.xxh64_intdigest(str(firsts["doc"][0])) if len(firsts) else 0) % buckets
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
            parts = [(int(bucket[p[0]]), 0, _columns(firsts[p])) for p in np.split(order, cuts[1:]) if len(p)]
            if len(known):
                parts.append((aside, 1, _columns(known)))
            yield pa.RecordBatch.from_pydict(
                {
                    "bucket": pa.array([p[0] for p in parts], pa.int32()),
                    "known": pa.array([p[1] for p in parts], pa.int32()),
                    "rows": pa.array([p[2] for p in parts], pa.binary()),
                }
            )

        for batch in sliced(batches):
            for doc_id, text in zip(numbers_of(batch, "doc_id").tolist(), texts_of(batch), strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                if len(raw) < length:
                    continue
                starts, sizes, anchors = anchored(np.frombuffer(raw, np.uint8), ANCHOR, length)
                rows = np.empty(len(starts), _PACKED)
                hashed = [
                    xxhash.xxh64_intdigest(raw[a:b]) for a, b in zip(starts.tolist(), (starts + sizes).tolist(), strict=True)
                ]
                # 48 bits of each: 96 tell fragments apart, and anchors that agree by chance only meet in vain.
                rows["h"], rows["f"] = anchors & _48, np.array(hashed, np.uint64) & _48
                rows["doc"], rows["start"], rows["size"] = doc_id, starts, sizes
                held.append(rows)
                size += len(rows)
                if size > COLLAPSE:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    return run


def _contested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reduce side: repeats found by collapsing (``h`` -1), and the fragments whose anchor has others (their anchor as ``h``)."""
    held = []
    for batch in batches:
        for known, data in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            rows = _rows(data)
            if known:
                yield _found(rows["doc"], rows["start"], rows["size"])
            else:
                held.append(rows)
    if not held:
        return
    firsts, others = _collapse(np.concatenate(held))
    held.clear()
    doc, start, end = _ranges(others["doc"], others["start"].astype(np.int64), others["start"] + others["size"].astype(np.int64))
    yield _found(doc, start, end - start)
    same = firsts["h"][1:] == firsts["h"][:-1]
    several = np.r_[False, same] | np.r_[same, False]
    firsts = firsts[several]
    for at in range(0, len(firsts), 100_000):
        part = firsts[at : at + 100_000]
        yield _found(part["doc"], part["start"], part["size"], part["h"].astype(np.int64))


def _bytes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of each document's wanted fragments."""
    for batch in sliced(batches):
        out = {"h": [], "doc_id": [], "start": [], "bytes": []}
        wanted = batch.column(2).to_pylist()
        for doc_id, text, wants in zip(batch.column(0).to_pylist(), texts_of(batch), wanted, strict=True):
            raw = text.encode("utf-8", "surrogatepass")
            for w in wants:
                out["h"].append(w["h"])
                out["doc_id"].append(doc_id)
                out["start"].append(w["start"])
                out["bytes"].append(raw[w["start"] : w["start"] + w["size"]])
        yield pa.RecordBatch.from_pydict(
            {
                "h": pa.array(out["h"], pa.int64()),
                "doc_id": pa.array(out["doc_id"], pa.int64()),
                "start": pa.array(out["start"], pa.int32()),
                "bytes": pa.array(out["bytes"], pa.binary()),
            }
        )


def _in_order(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A stable order of numbers from 0 on, and the numbers in it.

    Where a number and its place go into 63 bits they are sorted as one: a plain sort is several times faster than one of places.
    """
    bits = max(len(keys) - 1, 1).bit_length()
    if len(keys) and int(keys.max()).bit_length() + bits > 63:
        order = np.argsort(keys, kind="stable")
        return order, keys[order]
    both = keys.astype(np.int64) << bits
    both |= np.arange(len(keys))
    both.sort()
    return both & ((1 << bits) - 1), both >> bits


def _ranked(keys: np.ndarray) -> tuple[np.ndarray, int]:
    """Keys (from 0 on) as dense numbers in their order."""
    order, keys = _in_order(keys)
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    out = np.empty(len(keys), np.int64)
    out[order] = np.cumsum(new) - 1
    return out, int(new.sum())


class Rings:
    """Fragments as rings of symbols (byte + 1, end mark 0), laid end to end."""

    def __init__(self, fragments: list[bytes]):
        sizes = np.array([len(f) + 1 for f in fragments], np.int64)
        self.begin = np.cumsum(sizes) - sizes
        raw = np.frombuffer(b"\x00".join(fragments) + b"\x00", np.uint8).astype(np.int64) + 1
        raw[self.begin + sizes - 1] = 0
        self.symbols, self.sizes = raw, sizes
        self.ring = np.repeat(np.arange(len(sizes)), sizes)
        self.first, self.size = np.repeat(self.begin, sizes), np.repeat(sizes, sizes)
        self.offset = np.arange(len(raw)) - self.first
        self.least = int(sizes.min()) if len(sizes) else 0

    def ahead(self, by: int, places: slice = slice(None)) -> np.ndarray:
        """Of every place the place ``by`` symbols on, around its ring."""
        size, at = self.size[places], self.offset[places] + by
        if abs(by) > self.least:
            at %= size
        elif by < 0:
            at += size * (at < 0)
        else:
            at -= size * (at >= size)
        return self.first[places] + at


def shard_order(letters: np.ndarray, rings: Rings, places: slice, length: int) -> np.ndarray:
    """The rotations of one shard in order of their first ``length`` symbols (ties as they lie): its suffix array.

    ``letters`` ranks the ``STRIDE`` symbols from each place on; ranks of twice as many follow from pairs.
    """
    base = places.start
    rank = letters[places]
    n = len(rank)
    have, done = STRIDE, {STRIDE: rank}
    while 2 * have <= length:
        ahead = rings.ahead(have, places) - base
        rank, _ = _ranked(rank * (int(rank.max()) + 1) + rank[ahead])
        have *= 2
        done[have] = rank
    while have < length:
        step = max(s for s in done if s <= length - have)
        ahead = rings.ahead(have, places) - base
        rank, _ = _ranked(rank * n + done[step][ahead])
        have += step
    return base + _in_order(rank)[0]


def merged_blocks(fragments: list[bytes], length: int, shard_bytes: int = SHARD_BYTES):
    """Rings, the merged order of all rotations, per rotation of it the block of equal first ``length`` symbols, and the common
    prefix with the one before it (in steps of ``STRIDE``, at most ``length``)."""
    rings = Rings(fragments)
    n = len(rings.symbols)
    # Letters: ranks of STRIDE symbols, from two halves of half as many.
    half = STRIDE // 2
    code = np.zeros(n, np.int64)
    for j in range(half):
        code = code * 257 + rings.symbols[rings.ahead(j)]
    short, n_short = _ranked(code)
    letters, n_letters = _ranked(short * n_short + short[rings.ahead(half)])
    # Shards of whole rings.
    cut, ends = [0], np.cumsum(rings.sizes)
    while cut[-1] < n:
        i = int(np.searchsorted(ends, cut[-1] + shard_bytes, side="right"))
        first = int(np.searchsorted(ends, cut[-1], side="right"))
        cut.append(int(ends[max(i - 1, first)]))
    orders = [shard_order(letters, rings, slice(a, b), length) for a, b in zip(cut, cut[1:], strict=False)]
    arrays = np.concatenate(orders)
    # The transform: the letter before each rotation of a shard's order.
    transform = letters[rings.ahead(-STRIDE)][arrays].astype(np.int32)
    # The j-th of a shard's entries stands for the j-th of its order, so one entry is always followed by the same: where a stable deal of
    # its own shard by letters puts it.
    shard = np.repeat(np.arange(len(orders)), np.diff(cut))
    follows = np.empty(n, np.int32)
    follows[_in_order(shard * n_letters + transform)[0]] = np.arange(n, dtype=np.int32)
    entry = np.arange(n, dtype=np.int32)
    block, prefix = np.zeros(n, np.int32), np.zeros(n, np.int32)
    for _ in range(length // STRIDE):
        moved, letter = _in_order(transform[entry])
        old = block[moved]
        # Places agree in STRIDE symbols more if their letters agree and what follows was in one block.
        part = np.ones(n, bool)
        part[1:] = (letter[1:] != letter[:-1]) | (old[1:] != old[:-1])
        block = np.cumsum(part, dtype=np.int32)
        prefix += ~part
        entry = follows[entry[moved]]
    return rings, arrays[entry], block, prefix * STRIDE


def repeats(doc: np.ndarray, start: np.ndarray, fragments: list[bytes], length: int, shard_bytes: int = SHARD_BYTES):
    """Ranges ``(doc, start, end)`` of the strings among the fragments of which an equal one starts earlier."""
    rings, order, block, _ = merged_blocks(fragments, length, shard_bytes)
    ring, offset = rings.ring[order], rings.offset[order]
    whole = offset + length < rings.sizes[ring]
    block, ring, offset = block[whole], ring[whole], offset[whole]
    # Blocks lie in order; one with a single string holds no repeat.
    same = block[1:] == block[:-1]
    several = np.r_[False, same] | np.r_[same, False]
    block, ring, offset = block[several], ring[several], offset[several]
    at = start[ring] + offset
    inside = np.lexsort((at, doc[ring], block))
    block, ring, at = block[inside], ring[inside], at[inside]
    later = np.zeros(len(block), bool)
    later[1:] = block[1:] == block[:-1]
    return _ranges(doc[ring[later]], at[later], at[later] + length)


def _merge(length: int, run_bytes: int, shard_bytes: int):
    """Fragments in order of anchors to ranges of repeats: whole anchors are worked on together, some MB at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None

        def flush() -> pa.RecordBatch:
            doc = np.array([x[0] for x in held], np.int64)
            start = np.array([x[1] for x in held], np.int64)
            doc, start, end = repeats(doc, start, [x[2] for x in held], length, shard_bytes)
            return _found(doc, start, end - start)

        for batch in batches:
            for h, doc_id, start, raw in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if h != last and size > run_bytes:
                    yield flush()
                    held, size = [], 0
                held.append((doc_id, start, raw))
                size, last = size + len(raw), h
        if held:
            yield flush()

    return run


def _finer(k: int, length: int):
    """Fragments cut by anchors of ``k`` bytes; ``f`` tells equal ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1 << 20):
            out = {"h": [], "f": [], "doc_id": [], "start": [], "bytes": []}
            for doc_id, start, raw in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                starts, sizes, anchors = anchored(np.frombuffer(raw, np.uint8), k, length)
                for a, n, h in zip(starts.tolist(), sizes.tolist(), anchors.view(np.int64).tolist(), strict=True):
                    out["h"].append(h)
                    out["f"].append(xxhash.xxh128_hexdigest(raw[a : a + n]))
                    out["doc_id"].append(doc_id)
                    out["start"].append(start + a)
                    out["bytes"].append(raw[a : a + n])
            types = (pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_pydict({c: pa.array(v, t) for (c, v), t in zip(out.items(), types, strict=True)})

    return run


def repeated_ranges(
    texts: DataFrame,
    length: int = LENGTH,
    most_bytes: int = MOST_BYTES,
    run_bytes: int = RUN_BYTES,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Ranges ``(doc_id, start, size)`` of bytes to remove; they may touch or overlap. ``doc_id`` is unique in ``texts``."""
    if length % STRIDE or length < ANCHOR + STRIDE:
        raise ValueError(f"the length must be a multiple of {STRIDE}, above {ANCHOR + STRIDE - 1}")
    spark = texts.sparkSession
    buckets = max(12, int(spark.conf.get("spark.sql.shuffle.partitions")), texts.rdd.getNumPartitions())
    dealt = texts.mapInArrow(_fragments(length, buckets), "bucket int, known int, rows binary").repartition(buckets, "bucket")
    found = saved(dealt.mapInArrow(_contested, _FOUND), "repeat-candidates")
    out = found.where("h = -1").select("doc_id", "start", "size")
    wanted = found.where("h <> -1").groupBy("doc_id").agg(F.collect_list(F.struct("h", "start", "size")).alias("wanted"))
    cut = "h long, doc_id long, start int, bytes binary"
    level = saved(texts.join(wanted, "doc_id").select("doc_id", "text", "wanted").mapInArrow(_bytes_of, cut), "fragments")
    for k in (*FINER, length, None):
        busy = level.groupBy("h").agg(F.sum(F.length("bytes")).alias("held")).where(F.col("held") > most_bytes)
        busy = saved(busy.select("h"), "busy-anchors")
        any_busy = k is not None and busy.limit(1).count() > 0
        calm = level.join(busy, "h", "left_anti") if any_busy else level
        merged = calm.repartition("h").sortWithinPartitions("h", "doc_id", "start")
        ranges = merged.mapInArrow(_merge(length, run_bytes, shard_bytes), _FOUND)
        out = out.unionByName(saved(ranges.select("doc_id", "start", "size"), "merged-repeats"))
        if not any_busy:
            return out
        pieces = saved(
            level.join(busy, "h", "left_semi").select("h", "doc_id", "start", "bytes").mapInArrow(
                _finer(k, length), "h long, f string, doc_id long, start int, bytes binary"
            ),
            "finer-fragments",
        )
        first = pieces.groupBy("h", "f").agg(F.min(F.struct("doc_id", "start")).alias("first"))
        own = F.struct("doc_id", "start")
        told = saved(pieces.join(first, ["h", "f"]).withColumn("is_first", own == F.col("first")), "told-fragments")
        copies = told.where("NOT is_first").select("doc_id", "start", F.length("bytes").alias("size"))
        out = out.unionByName(copies)
        level = told.where("is_first").select("h", "doc_id", "start", "bytes")
    return out


#: ``text_hash`` is of the whole text: with the id it tells to which row a result belongs.
_KEPT = "doc_id long, text_hash long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        out = {name.split()[0]: [] for name in _KEPT.split(", ")}
        hashes, spans_of = batch.column(1).to_pylist(), batch.column(3).to_pylist()
        for doc_id, hashed, text, spans in zip(batch.column(0).to_pylist(), hashes, texts_of(batch), spans_of, strict=True):
            raw, kept, runs, at = text.encode("utf-8", "surrogatepass"), [], 0, 0
            removed = 0
            if spans:
                begin = np.array([s["start"] for s in spans], np.int64)
                end = begin + np.array([s["size"] for s in spans], np.int64)
                _, begin, end = _ranges(np.zeros(len(begin), np.int64), begin, end)
                runs, removed = len(begin), int((end - begin).sum())
                for a, b in zip(begin.tolist(), end.tolist(), strict=True):
                    kept.append(raw[at:a])
                    at = b
            kept = b"".join([*kept, raw[at:]])
            figures = (doc_id, hashed, len(raw), removed, runs, hashlib.sha256(kept).hexdigest(), kept)
            for name, value in zip(out, figures, strict=True):
                out[name].append(value)
        types = (*(pa.int64(),) * 5, pa.string(), pa.binary())
        yield pa.RecordBatch.from_pydict({c: pa.array(v, t) for (c, v), t in zip(out.items(), types, strict=True)})


def remove_repeats(docs: DataFrame, length: int = LENGTH, **options) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal runs removed), ``kept_sha256`` and ``kept``, the bytes left.

    Null texts are empty. Rows without ``doc_id`` have no place in the order and are left out. Of rows that repeat an id, equal
    texts are one document, of which each row gets the result; different texts of one id are told apart and ordered
    by a hash of the text. Other columns are ignored; an empty table gives none.
    """
    return _remains(docs, length, options).drop("text_hash")


def _remains(docs: DataFrame, length: int, options) -> DataFrame:
    """The result of :func:`remove_repeats` with ``text_hash``, the XXH64 of each row's whole text."""
    texts = identified_texts(docs)
    repeated = texts.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
    if repeated:
        return _with_repeated_ids(texts, length, options)
    return _removed(texts, texts, length, options)


def _removed(texts: DataFrame, rows: DataFrame, length: int, options) -> DataFrame:
    spans = repeated_ranges(texts, length, **options).groupBy("doc_id").agg(F.collect_list(F.struct("start", "size")).alias("spans"))
    return rows.join(spans, "doc_id", "left").select(
        "doc_id", F.xxhash64("text").alias("text_hash"), "text", "spans"
    ).mapInArrow(_apply, _KEPT)


def _with_repeated_ids(texts: DataFrame, length: int, options) -> DataFrame:
    """Documents numbered anew where ids repeat, in the order of id and text hash; the ids themselves are never reckoned with."""
    hashed = texts.withColumn("t", F.xxhash64("text"))
    numbers = saved(dense_keys(hashed.select("doc_id", "t").distinct(), ["doc_id", "t"], "own"), "numbers")
    numbered = saved(hashed.join(numbers, ["doc_id", "t"]).select("own", "text"), "numbered")
    once = numbered.groupBy("own").agg(F.first("text").alias("text")).select(F.col("own").alias("doc_id"), "text")
    done = _removed(once, numbered.select(F.col("own").alias("doc_id"), "text"), length, options)
    names = numbers.select(F.col("own").alias("__own"), F.col("doc_id").alias("__id"))
    return done.join(names, F.col("doc_id") == F.col("__own")).withColumn("doc_id", F.col("__id")).drop("__own", "__id")


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        texts = [raw.decode("utf-8", "ignore") for raw in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_pydict(
            {"__id": batch.column(0), "__hash": batch.column(1), "__kept": pa.array(texts, pa.string())}
        )


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with repeated passages cut from ``text`` and ``n_chars`` (where there is one) set anew; other columns as they were.

    A cut may leave part of a character of several bytes; such bytes are left out of the text. Rows of whose text
    nothing but white space is left go, unless it was so before. Rows without ``doc_id`` stay as they are. Of rows that repeat an
    id, each keeps what is left of its own text.
    """
    cut = _remains(docs.select("doc_id", "text"), length, {}).where("n_removed > 0").select("doc_id", "text_hash", "kept")
    kept = cut.mapInArrow(_decoded, "__id long, __hash long, __kept string")
    # Rows that repeat id and text have one result; a row's own text tells which of its id's results it gets.
    by_text = kept.groupBy("__id", "__hash").agg(F.min("__kept").alias("__kept"))
    own = docs.withColumn("__own_hash", F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))).alias("d")
    joined = own.join(by_text, (F.col("d.doc_id") == F.col("__id")) & (F.col("__own_hash") == F.col("__hash")), "left")
    left = F.when(F.col("__id").isNull(), F.col("text")).otherwise(F.col("__kept"))
    cut = joined.withColumn("__left", left).where(F.col("__id").isNull() | (F.trim("__left") != ""))
    columns = [
        F.col("__left").alias(c) if c == "text" else F.length("__left").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"d.`{c}`")
        for c in docs.columns
    ]
    return cut.select(*columns)
