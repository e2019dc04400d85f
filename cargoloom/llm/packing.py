"""Documents packed into training sequences in their order, by dynamic programming over the cuts.

The ids of all documents of a range, in ascending ``doc_id``, are one stream. It is cut into windows
of at most ``length`` ids. A cut costs nothing at a document's end, ``sentence_cost`` at a sentence's end,
and ``word_cost`` elsewhere (such places are offered only every ``stride`` ids, so that no text without
sentence ends is left without one); a window costs ``window_cost`` and the ids it is padded by. With cuts at ``x``,

    best[j] = cost(cut j) + window_cost + min over cuts i, x[j] - length <= x[i] < x[j], of best[i] + padding(x[j] - x[i])

and padding ``length - (x[j] - x[i])`` splits into a part of ``j`` and a part of ``i``, so the least ``best[i] + x[i]``
of a sliding window is all that is needed: a monotone queue gives it in constant time. A window whose size is
a power of two is not padded, which adds one look-up per power.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from cargoloom.llm.common import identified_texts, in_id_order, numbers_of, sliced
from cargoloom.llm.pieces import PieceEncoder, encoder

LENGTH = 2048
ROWS = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Ids packed by one run of the dynamic program, as many whole documents as reach it: a bound on memory.
#: A longer document is one run by itself.
CHUNK = 1_000_000


def cuts(places: np.ndarray, costs: np.ndarray, length: int, window_cost: float) -> np.ndarray:
    """The cheapest cuts: indices into ``places``, from 0 to the last.

    ``places`` are the allowed cuts in ascending order, from 0 to the stream's end, no two further apart than
    ``length``; ``costs`` are theirs. Ties go to the earlier start of the window.
    """
    x, n = places.tolist(), len(places)
    price = (costs + window_cost).tolist()
    # Cuts a power of two before each cut, found for all cuts at once; few cuts have any.
    powers = [1 << k for k in range(length.bit_length())]
    number = np.full(int(places[-1]) + 1, -1)
    number[places] = np.arange(n)
    later, earlier = [], []
    for p in powers:
        exact = np.where(places >= p, number[np.maximum(places - p, 0)], -1)
        later.append(np.flatnonzero(exact >= 0))
        earlier.append(exact[later[-1]])
    later, earlier = np.concatenate(later), np.concatenate(earlier)
    order = np.argsort(later, kind="stable")
    bounds, earlier = np.searchsorted(later[order], np.arange(n + 1)).tolist(), earlier[order].tolist()
    best, came = [0.0] * n, [0] * n
    keys: deque[float] = deque([0.0])
    held: deque[int] = deque([0])
    for j in range(1, n):
        xj = x[j]
        least = xj - length
        while x[held[0]] < least:
            held.popleft()
            keys.popleft()
        i, total = held[0], keys[0] - least
        for k in earlier[bounds[j] : bounds[j + 1]]:
            if best[k] < total:
                total, i = best[k], k
        total += price[j]
        best[j], came[j] = total, i
        key = total + xj
        while keys and keys[-1] > key:
            keys.pop()
            held.pop()
        keys.append(key)
        held.append(j)
    chosen = [n - 1]
    while chosen[-1]:
        chosen.append(came[chosen[-1]])
    return np.array(chosen[::-1])


def sentence_ends(code: PieceEncoder) -> np.ndarray:
    """Which ids end a sentence: those whose text ends in a stop, question or exclamation mark."""
    vocabulary = code.library.get_vocab()
    ends = np.zeros(max(vocabulary.values()) + 1, bool)
    for token, i in vocabulary.items():
        ends[i] = token.removesuffix("</w>")[-1:] in (".", "!", "?")
    return ends


def places_of(ids: np.ndarray, doc_ends: np.ndarray, ends: np.ndarray, stride: int, sentence_cost, word_cost):
    """Allowed cuts of a stream and their costs."""
    n = len(ids)
    cost = np.full(n + 1, np.inf)
    cost[np.arange(0, n, stride)] = word_cost
    inside = ids < len(ends)
    cost[1:][inside] = np.where(ends[ids[inside]], sentence_cost, cost[1:][inside])
    cost[doc_ends] = 0.0
    cost[[0, n]] = 0.0
    places = np.flatnonzero(np.isfinite(cost))
    return places, cost[places]


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    style: str = "word",
    end_id: int = 1,
    length: int = LENGTH,
    sentence_cost: float = 2.0,
    word_cost: float = 12.0,
    stride: int = 16,
    window_cost: float = 16.0,
) -> DataFrame:
    """One row per piece of a document: where it starts in its document, its length, and its sequence and offset there.

    Each id of a document (its text's ids, then the end id; null text: only that) lies in one piece. Rows
    without ``doc_id`` are left out, repeated ids are documents of their own, other columns are ignored, and an
    empty table has no pieces. Documents keep their order. A range of ids is packed by one task in runs of
    bounded size; only the last window of a run can be padded for want of a neighbour, and then the
    program ends it in powers of two where that is cheaper. ``sequence_id`` is the number of the range times
    2**40 plus the number of the sequence in it, so no count has to be gathered.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(tokenizer_path, style)
        ends, sequence = sentence_ends(code), TaskContext.get().partitionId() << 40
        held: list[tuple[int, np.ndarray]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, size, sequence
            sizes = np.array([len(x) for _, x in held])
            doc_ends = np.cumsum(sizes)
            stream = np.concatenate([x for _, x in held])
            places, costs = places_of(stream, doc_ends, ends, stride, sentence_cost, word_cost)
            windows = places[cuts(places, costs, length, window_cost)]
            # Pieces: the stream cut at both kinds of ends.
            edges = np.union1d(windows, doc_ends)
            starts, stops = edges[:-1], edges[1:]
            document = np.searchsorted(doc_ends, starts, side="right")
            window = np.searchsorted(windows, starts, side="right") - 1
            raw = stream.astype("<u4")
            out = {
                "doc_id": np.array([d for d, _ in held])[document],
                "start": starts - (doc_ends - sizes)[document],
                "length": stops - starts,
                "ids_crc32": np.array(
                    [zlib.crc32(raw[a:b]) for a, b in zip(starts.tolist(), stops.tolist(), strict=True)], np.int64
                ),
                "doc_tokens": sizes[document],
                "sequence_id": window + sequence,
                "offset": starts - windows[window],
            }
            sequence += len(windows) - 1
            held, size = [], 0
            return pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in out.items()})

        for batch in sliced(batches):
            for doc_id, ids in zip(numbers_of(batch, "doc_id").tolist(), code.encode(batch.column(batch.schema.get_field_index("text"))), strict=True):
                if held and size + len(ids) + 1 > CHUNK:
                    yield flush()
                held.append((doc_id, np.append(ids, ids.dtype.type(end_id))))
                size += len(ids) + 1
        if held:
            yield flush()

    return in_id_order(identified_texts(docs)).mapInArrow(run, ROWS)
