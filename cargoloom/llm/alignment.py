"""How the tokens of two tokenizers go together over a corpus, counted through a minimal perfect hash.

Both encode the same bytes, so an end of a token of A and one of B can be at the same byte. Such ends cut a document into groups, and
the two tokens that end there are linked. The count of an id pair is the number of its links in the corpus.

**Bound.** Of two tokens that end together one's bytes are a suffix of the other's. So there are at most as many distinct pairs as
tokens of either vocabulary have suffixes in the other, some hundred thousands, whatever the corpus (``most_pairs``). That
is the proof for what is collected and broadcast here: distinct pairs, their hash and their counts.

**First pass.** Texts are encoded once and their ids written. Each task also hands on the distinct pairs it met. On these a minimal
perfect hash is built: a key takes its place in the first of several bit arrays where no other key hashes to, and its number is the count of bits
before. The keys are kept in that order, and each look-up compares them: an unknown pair is found out, never miscounted.
**Counting.** Every task aligns its documents and adds up a dense vector, indexed by the hash; vectors are summed in a tree, ``FAN`` at a time and
slice by slice. **Second pass.** Documents are aligned again from their ids and look their links' counts up.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargoloom.llm.common import give_back_memory, numbers_of, saved, sliced, taken
from cargoloom.llm.pieces import byte_letters

FAN, SLICE = 16, 1 << 16
#: Bytes of texts, or of ids, that a worker has in hand: it takes some 25 times as many for their words, ids and places.
BATCH = 4 << 20
ROWS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mix of each key (the finaliser of splitmix)."""
    x = keys.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class PerfectHash:
    """Numbers 0 to n - 1 of n distinct keys. ``before[level]`` counts the places taken before each place, over all levels."""

    before: list[np.ndarray]
    keys: np.ndarray

    @staticmethod
    def of(keys: np.ndarray) -> PerfectHash:
        left, before, ordered, taken = np.unique(keys.astype(np.int64)), [], [], 0
        while len(left):
            size = 2 * len(left) + 1
            place = (_mixed(left, len(before)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            before.append(taken + np.concatenate(([0], np.cumsum(alone))).astype(np.int32))
            kept = alone[place]
            ordered.append(left[kept][np.argsort(place[kept])])
            taken += int(kept.sum())
            left = left[~kept]
        return PerfectHash(before, np.concatenate(ordered) if ordered else np.zeros(0, np.int64))

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 where it is none of the hashed ones."""
        out, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, before in enumerate(self.before):
            if not len(open_):
                break
            place = (_mixed(keys[open_], level) % np.uint64(len(before) - 1)).astype(np.int64)
            hit = before[place + 1] > before[place]
            found = before[place[hit]]
            same = self.keys[found] == keys[open_[hit]]
            out[open_[hit][same]] = found[same]
            open_ = open_[~hit]
        return out


def most_pairs(a: list[bytes], b: list[bytes]) -> int:
    """How many pairs of tokens can end together: one is a suffix of the other. Repeated tokens count apart."""

    def suffixes(these: list[bytes], those: list[bytes]) -> int:
        known: dict[bytes, int] = {}
        for x in those:
            known[x] = known.get(x, 0) + 1
        return sum(known.get(x[i:], 0) for x in these for i in range(len(x)))

    return suffixes(a, b) + suffixes(b, a)


#: Two characters of white space side by side, or one at the end: what either library may read as a space counts.
_GAP = r"[\s\v\x1c-\x1f\x{85}\p{Z}]"
_BLANK = "\u2581"


def _laid(texts: pa.Array) -> bytes:
    """All texts of an array end to end."""
    _, offsets, data = texts.buffers()
    if not len(texts) or data is None:
        return b""
    ends = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    return data[int(ends[0]) : int(ends[-1])].to_pybytes()


class Pair:
    """Both tokenizers in a worker: ids of texts, lengths of tokens in bytes, and their digits with what follows them.

    A's file is read as ranks: the order of its merges is the order of its ids, which is checked. Where no white space stands next to
    other white space, each blank and each line end begins a token of A, and of B (no piece of B holds a blank behind another character,
    or a line end). So texts are cut there, the distinct words of a batch are encoded once, all A's in one call and all B's in
    one, and documents are put together from numbers of words. Other texts are encoded as they are.
    """

    def __init__(self, a_path: str, b_path: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(a_path, encoding="utf-8") as held:
            model = json.load(held)
        back = {letter: byte for byte, letter in byte_letters().items()}
        special = {t["content"] for t in model["added_tokens"]}
        vocabulary, merges = model["model"]["vocab"], model["model"]["merges"]
        made = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in merges]
        if made != sorted(made) or model["normalizer"] is not None:
            raise ValueError(f"{a_path} is no byte-level file whose merges are in the order of their ids")
        ranks = {bytes(back[c] for c in token): i for token, i in vocabulary.items() if token not in special}
        self.a = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in ranks.items():
            self.a_bytes[i] = token
        self.b = b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        shown = [b.id_to_piece(i) for i in range(b.vocab_size())]
        self.b_bytes = [bytes([int(x[3:5], 16)]) if b.is_byte(i) else x.replace(_BLANK, " ").encode() for i, x in enumerate(shown)]
        self.blank = b.piece_to_id(_BLANK)
        words = [x for i, x in enumerate(shown) if not (b.is_control(i) or b.is_unknown(i) or b.is_byte(i))]
        whole = b.encode("ab cd \nef  g", out_type=str)
        parts = [*b.encode("ab", out_type=str), *b.encode("cd", out_type=str), _BLANK, *b.encode("\nef", out_type=str)[1:], *b.encode(" g", out_type=str)]
        self.cuts = whole == parts and not any("\n" in x or _BLANK in x.lstrip(_BLANK) for x in words)
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self.a_flat, self.b_flat = (np.frombuffer(b"".join(t), np.uint8) for t in (self.a_bytes, self.b_bytes))
        self.kind = np.dtype("<u2" if max(len(self.a_bytes), len(self.b_bytes)) <= 1 << 16 else "<u4")
        ids_a, ids_b = range(len(self.a_bytes)), range(len(self.b_bytes))
        self.words = [b"%d%s" % (i, end) for i in ids_a for end in (b",", b"|")]
        self.b_words = len(self.words)
        self.words += [b"%d%s" % (i, end) for i in ids_b for end in (b",", b";")]

    def _of_a(self, text: str) -> np.ndarray:
        return self.a.encode_to_numpy(text, disallowed_special=()).astype(self.kind)

    def _words(self, words: pa.Array) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray], np.ndarray]:
        """Ids of A and of B with their numbers for each distinct word, and which words B does not give back."""
        lined = pc.starts_with(words, "\n")
        shown = pc.if_else(lined, words, pc.binary_join_element_wise(pa.scalar(""), words, " "))
        open_ = pc.match_substring_regex(shown, _GAP + r"\z").to_numpy(zero_copy_only=False)
        # A: all words that end in no white space in one text, the few others one by one.
        joined = shown.filter(pa.array(~open_))
        ids, sizes = np.zeros(0, self.kind), np.zeros(len(words), np.int64)
        if len(joined):
            ids = self._of_a(_laid(joined).decode())
            ends, stops = np.cumsum(self.a_sizes[ids]), np.cumsum(pc.binary_length(joined).to_numpy())
            last = np.searchsorted(ends, stops)
            if not (ends[last] == stops).all():
                raise ValueError("a word of A does not end where it was cut")
            sizes[~open_] = np.diff(last + 1, prepend=0)
        single = [self._of_a(w) for w in shown.filter(pa.array(open_)).to_pylist()]
        sizes[open_] = [len(x) for x in single]
        order = np.concatenate((np.flatnonzero(~open_), np.flatnonzero(open_)))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        a = taken(np.concatenate([ids, *single]), sizes[order], place)
        # B: its library takes a list; a word's blank is added by it, before a line end it is taken off again.
        plain = words.to_pylist()
        lists = self.b.encode(plain, num_threads=1) if plain else []
        lists = [[self.blank] if not w else x[1:] if w[0] == "\n" else x for w, x in zip(plain, lists, strict=True)]
        b_sizes = np.array([len(x) for x in lists], np.int64)
        b = np.fromiter(chain.from_iterable(lists), self.kind, int(b_sizes.sum())), b_sizes
        raw, length = np.frombuffer(_laid(shown), np.uint8), pc.binary_length(shown).to_numpy().astype(np.int64)
        bad = np.zeros(len(words), bool)
        for (flat, n), table, widths in ((a, self.a_flat, self.a_sizes), (b, self.b_flat, self.b_sizes)):
            spelled = np.diff(np.concatenate(([0], np.cumsum(widths[flat])))[np.cumsum(n)], prepend=0)
            same = np.flatnonzero(spelled == length)
            bad |= spelled != length
            if len(same):
                there, _ = taken(raw, length, same)
                got, _ = taken(table, widths, taken(flat, n, same)[0])
                bad[same] |= np.add.reduceat(there != got, np.cumsum(length[same]) - length[same]) > 0
        return a, b, bad

    def tokens(self, texts: pa.Array) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """Ids of A and of B of all texts, laid end to end, with their numbers; none at all where either is not a space and the text."""
        texts = pc.fill_null(texts, "")
        full = pc.binary_length(texts).to_numpy() > 0
        odd = pc.match_substring_regex(pc.binary_join_element_wise(pa.scalar(""), texts, " "), _GAP + "{2}").to_numpy(zero_copy_only=False)
        cut = full & ~odd if self.cuts else np.zeros(len(texts), bool)
        lists = pc.split_pattern(pc.replace_substring(texts.filter(pa.array(cut)), "\n", " \n"), " ")
        numbers, distinct = np.zeros(0, np.int64), pa.array([], pa.string())
        if len(lists):
            coded = pc.dictionary_encode(lists.flatten())
            numbers, distinct = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        (a, a_n), (b, b_n), bad = self._words(distinct)
        in_text = pc.list_value_length(lists).to_numpy().astype(np.int64)
        ends = np.cumsum(in_text)

        def per_text(values: np.ndarray) -> np.ndarray:
            return np.diff(np.concatenate(([0], np.cumsum(values)))[ends], prepend=0)

        wrong = per_text(bad[numbers]) > 0
        found = []
        for flat, n in ((a, a_n), (b, b_n)):
            whole, _ = taken(flat, n, numbers)
            found.append(([whole], per_text(n[numbers])))
        rest = np.flatnonzero(full & ~cut)
        rest_sizes: list[list[int]] = [[], []]
        for text in texts.take(pa.array(rest)).to_pylist():
            raw = b" " + text.encode()
            ids = self._of_a(" " + text), np.array(self.b.encode(text), self.kind)
            spelled = [b"".join(map(t.__getitem__, x.tolist())) for t, x in zip((self.a_bytes, self.b_bytes), ids, strict=True)]
            for i in (0, 1):
                kept = ids[i] if spelled == [raw, raw] else ids[i][:0]
                found[i][0].append(kept)
                rest_sizes[i].append(len(kept))
        # All texts, those cut first, then the rest; the wrong ones lose their ids, and texts take their places again.
        out, places = [], np.flatnonzero(cut)
        for i in (0, 1):
            sizes = np.concatenate((found[i][1], np.array(rest_sizes[i], np.int64)))
            order = np.full(len(texts), -1)
            order[places], order[rest] = np.arange(len(places)), len(places) + np.arange(len(rest))
            order[places[wrong]] = -1
            there = order[order >= 0]
            flat, n = np.concatenate(found[i][0]), sizes
            found[i] = ([], sizes)
            if len(there) < len(sizes) or (np.diff(there) < 0).any():
                flat, n = taken(flat, sizes, there)
            per = np.zeros(len(texts), np.int64)
            per[order >= 0] = n
            out.append((flat, per))
        return out[0], out[1]

    def ends(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which tokens of documents laid end to end have an end in common with one of the other side."""
        at_a, at_b = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        here = np.zeros(int(at_a[-1]) + 1 if len(at_a) else 1, bool)
        here[at_a] = True
        of_b = here[at_b]
        here[:] = False
        here[at_b] = True
        return here[at_a], of_b

    def lines(self, a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray) -> np.ndarray:
        """Words of all groups in order, as indices into ``words``: a group's tokens of A, then those of B."""
        b_before = np.concatenate(([0], np.flatnonzero(of_b) + 1))
        a_until = np.flatnonzero(of_a) + 1
        out = np.empty(len(a) + len(b), np.int64)
        out[np.arange(len(a)) + b_before[np.cumsum(of_a) - of_a]] = a.astype(np.int64) * 2 + of_a
        out[np.arange(len(b)) + a_until[np.cumsum(of_b) - of_b]] = self.b_words + b.astype(np.int64) * 2 + of_b
        return out


_pairs: dict[tuple[str, str], Pair] = {}


def _pair(a_path: str, b_path: str) -> Pair:
    if (a_path, b_path) not in _pairs:
        _pairs[a_path, b_path] = Pair(a_path, b_path)
    return _pairs[a_path, b_path]


def _codes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a.astype(np.int64) << 32 | b.astype(np.int64)


def _batch_ids(batch: pa.RecordBatch, name: str, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a batch's rows laid end to end, and how many each row has."""
    rows = [np.frombuffer(x, kind) for x in batch.column(batch.schema.get_field_index(name)).to_pylist()]
    return np.concatenate([np.zeros(0, kind), *rows]).astype(np.int64), np.array([len(x) for x in rows], np.int64)


def _first_pass(a_path: str, b_path: str):
    """Ids of both tokenizers per document, and at a task's end the distinct pairs it met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, met = _pair(a_path, b_path), np.zeros(0, np.int64)
        names, kinds = ["doc_id", "a", "b", "pairs"], [pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        for batch in sliced(batches, BATCH):
            (a, a_n), (b, b_n) = pair.tokens(batch.column(batch.schema.get_field_index("text")))
            of_a, of_b = pair.ends(a, b)
            met = np.union1d(met, _codes(a[of_a], b[of_b]))
            columns = [numbers_of(batch, "doc_id")]
            for flat, n in ((a, a_n), (b, b_n)):
                cut = np.concatenate(([0], np.cumsum(n))).tolist()
                ids = flat.astype(pair.kind)
                columns.append([ids[i:j].tobytes() for i, j in zip(cut, cut[1:], strict=False)])
            columns.append([None] * batch.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
        columns = [[None], [None], [None], [met.astype("<i8").tobytes()]]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return run


def encoded(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """The first pass, written: ids of both tokenizers per document, and a row per task with the distinct pairs it met."""
    texts = docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return saved(texts.mapInArrow(_first_pass(a_path, b_path), "doc_id long, a binary, b binary, pairs binary"), "alignment-ids")


def _distinct_pairs(tokens: DataFrame, most: int) -> np.ndarray:
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for held in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(held, "<i8"))], ["pair"])

    rows = tokens.where(F.col("pairs").isNotNull()).select("pairs").mapInArrow(unpack, "pair long").distinct()
    found = rows.limit(most + 1).toArrow()["pair"].to_numpy()
    if len(found) > most:
        raise ValueError(f"{len(found)} pairs, over the {most} that the vocabularies allow")
    return found


def summed_tree(vectors: DataFrame) -> DataFrame:
    """Vectors (``node``, ``slice``, ``v`` of 64-bit integers) summed per slice, ``FAN`` nodes at a time, up to node 0."""

    def add(rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(v, "<i8") for v in rows["v"].to_pylist())
        return pa.table({"node": rows["node"][:1], "slice": rows["slice"][:1], "v": pa.array([total.tobytes()], pa.binary())})

    top = vectors.agg(F.max("node")).first()[0] or 0
    while top:
        vectors = vectors.withColumn("node", F.expr(f"node div {FAN}").cast("int")).groupBy("node", "slice").applyInArrow(
            lambda t: add(t), "node int, slice int, v binary"
        )
        top //= FAN
    return vectors


def _counts(tokens: DataFrame, a_path: str, b_path: str, known: PerfectHash) -> np.ndarray:
    """How many links hold each pair, in the order of the hash."""
    shared = tokens.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, perfect, part = _pair(a_path, b_path), shared.value, TaskContext.get().partitionId()
        total = np.zeros(len(perfect.keys), "<i8")
        for batch in sliced(batches, BATCH):
            (a, _), (b, _) = _batch_ids(batch, "a", pair.kind), _batch_ids(batch, "b", pair.kind)
            of_a, of_b = pair.ends(a, b)
            numbers = perfect.numbers(_codes(a[of_a], b[of_b]))
            if (numbers < 0).any():
                raise ValueError("a pair that the first pass did not meet")
            total += np.bincount(numbers, minlength=len(total))
        cut = [total[i : i + SLICE].tobytes() for i in range(0, len(total), SLICE)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([part] * len(cut), pa.int32()), pa.array(range(len(cut)), pa.int32()), pa.array(cut, pa.binary())],
            ["node", "slice", "v"],
        )

    documents = tokens.where(F.col("doc_id").isNotNull()).select("a", "b")
    vectors = saved(documents.mapInArrow(run, "node int, slice int, v binary"), "alignment-vectors")
    total = np.zeros(len(known.keys), np.int64)
    for row in summed_tree(vectors).collect():  # one vector, as long as there are pairs
        total[row["slice"] * SLICE :][: len(row["v"]) // 8] = np.frombuffer(row["v"], "<i8")
    return total


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per document: tokens of both, groups, links, links that are the best of their B id, their counts' sum, and a digest of the groups.

    ``a_path`` is a byte-level ``tokenizers`` file and encodes a space and the text, ``b_path`` a ``sentencepiece`` file, which
    adds that space itself. Texts that are null or empty, or that either does not give back byte by byte, have no tokens: zeros and an
    empty digest. Rows without ``doc_id`` are left out, rows of one id are documents of their own, other columns are
    not read, an empty table gives no rows.
    """
    give_back_memory(docs.sparkSession)  # for the last pass as well, which the caller runs
    pair = _pair(a_path, b_path)
    if min(pair.a_sizes.min(), pair.b_sizes.min()) < 1:
        raise ValueError("a token without bytes")
    tokens = encoded(docs, a_path, b_path)
    known = PerfectHash.of(_distinct_pairs(tokens, most_pairs(pair.a_bytes, pair.b_bytes)))
    counts = _counts(tokens, a_path, b_path, known)
    best = np.zeros(len(pair.b_sizes), np.int64)
    np.maximum.at(best, known.keys & 0xFFFFFFFF, counts)
    shared = docs.sparkSession.sparkContext.broadcast((known, counts, best))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, (perfect, total, highest) = _pair(a_path, b_path), shared.value
        for batch in sliced(batches, BATCH):
            (a, n_a), (b, n_b) = _batch_ids(batch, "a", pair.kind), _batch_ids(batch, "b", pair.kind)
            of_a, of_b = pair.ends(a, b)
            numbers = perfect.numbers(_codes(a[of_a], b[of_b]))
            if (numbers < 0).any():
                raise ValueError("a pair that the first pass did not meet")
            count = total[numbers]
            is_best = count == highest[b[of_b]]

            def per_row(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
                """Sums of consecutive values, up to each end."""
                return np.diff(np.concatenate(([0], np.cumsum(values)))[ends], prepend=0)

            a_ends, b_ends = np.cumsum(n_a), np.cumsum(n_b)
            links = per_row(of_a, a_ends)
            link_ends = np.cumsum(links)
            words, lines, start, digests = pair.words, pair.lines(a, b, of_a, of_b), 0, []
            for end in (a_ends + b_ends).tolist():
                line = b"".join(map(words.__getitem__, lines[start:end].tolist()))
                digests.append(hashlib.sha256(line[:-1]).hexdigest() if line else "")
                start = end
            numbers_out = [numbers_of(batch, "doc_id"), n_a, n_b, links, links, per_row(is_best, link_ends), per_row(count, link_ends)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x.astype(np.int64)) for x in numbers_out] + [pa.array(digests, pa.string())],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
            )

    return tokens.where(F.col("doc_id").isNotNull()).select("doc_id", "a", "b").mapInArrow(run, ROWS)
