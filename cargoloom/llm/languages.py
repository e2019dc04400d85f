"""The language of a text by cross-parsing it with suffix automata of labelled text.

Each language has an automaton of all substrings of a sample of its text. A text is parsed greedily: a phrase is the longest match
with the sample from where the last phrase ended. The fewer phrases a language needs, the closer it is. A larger sample of ``n``
symbols gives longer matches by chance, so a phrase counts ``log2(n + 1)`` bits (the cross-parsing estimate of entropy);
the language of fewest bits wins, ties go to the lesser value.

**Sample.** Texts of a language are cut in stretches of ``STRETCH`` symbols, equal stretches count once, and those of least hash are
learned, as many as make ``SYMBOLS`` in all languages together. That bounds the fit and the tables it broadcasts:
an automaton has at most two states per symbol, a state ``LETTERS`` numbers of four bytes.

**Symbols.** Texts are lower-cased; a run of other than letters is one blank. The most frequent letters of the sample have a
symbol each, all others share sixteen by their code point, so other scripts work, less finely.

**Speed.** The transitions are one table, in which a missing one leads to where the next phrase begins, marked as such. Texts
are parsed in stretches of ``LANE`` symbols laid side by side, all stretches of a batch and all languages at once, so
a step is one look-up in an array for thousands of stretches. A phrase ends with its stretch.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cargoloom.llm.common import numbers_of, sliced

SYMBOLS, STRETCH, LANE, LETTERS = 1 << 17, 512, 512, 64
_SHARED = 16
ROWS = "doc_id long, held_out boolean, lang_pred string, score double"


def _is_letter() -> np.ndarray:
    """Per code point whether it is a letter, or a mark that belongs to one."""
    kinds = [unicodedata.category(chr(c))[0] for c in range(0x110000)]
    return np.array([k in "LM" for k in kinds])


def letters_of(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")


class Alphabet:
    """``table[code point]``: zero for what is no letter, else the letter's symbol."""

    def __init__(self, frequent: list[int]):
        own = frequent[: LETTERS - _SHARED - 1]
        points = np.arange(0x110000)
        self.table = np.where(_is_letter(), LETTERS - _SHARED + points % _SHARED, 0).astype(np.uint8)
        self.table[own] = np.arange(1, len(own) + 1)

    def symbols(self, text: str) -> np.ndarray:
        """Symbols of a text, runs of blanks as one."""
        found = self.table[letters_of(text)]
        return found[(found > 0) | (np.concatenate(([1], found[:-1])) > 0)] if len(found) else found


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the states of the least automaton of all substrings; state 0 is the start."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for s in symbols:
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and s not in moves[p]:
            moves[p][s] = new
            p = link[p]
        if p >= 0:
            q = moves[p][s]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p].get(s) == q:
                    moves[p][s] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return moves


@dataclass(frozen=True)
class Model:
    """Languages in order, bits per phrase, first row of each automaton, and the letters with symbols of their own.

    ``table`` holds, per state and symbol, twice the next state's first cell, plus one where a phrase ends before the symbol."""

    names: list[str]
    bits: np.ndarray
    starts: np.ndarray
    table: np.ndarray
    frequent: list[int]


def _table(moves: list[dict[int, int]], first: int) -> np.ndarray:
    """The cells of one automaton whose states begin at row ``first`` of the whole table.

    One more state stands behind a symbol that the sample lacks: such a symbol is a phrase by itself."""
    lost = len(moves)
    cells = np.full((lost + 1, LETTERS), -1, np.int64)
    for state, out in enumerate(moves):
        for s, to in out.items():
            cells[state, s] = to
    again, ends = np.where(cells[0] >= 0, cells[0], lost), cells < 0
    ends[0] = False  # a text begins here: no phrase is left behind
    return (np.where(cells < 0, again, cells) + first) * LETTERS * 2 + ends


def model_of(samples: dict[str, list[str]]) -> Model:
    """Automata of texts by language."""
    names = sorted(samples)
    points = np.concatenate([letters_of(t) for n in names for t in samples[n]] or [np.zeros(0, "<u4")])
    points = points[np.isin(points, np.flatnonzero(_is_letter()))]
    seen, counts = np.unique(points, return_counts=True)
    frequent = seen[np.lexsort((seen, -counts))][: LETTERS - _SHARED - 1].tolist()
    alphabet, tables, starts, bits, rows = Alphabet(frequent), [], [], [], 0
    for name in names:
        symbols = np.concatenate([alphabet.symbols(t + " ") for t in samples[name]])
        moves = suffix_automaton(symbols.tolist())
        tables.append(_table(moves, rows))
        starts.append(rows * LETTERS)
        bits.append(np.log2(len(symbols) + 1))
        rows += len(moves) + 1
    if rows * LETTERS * 2 >= 1 << 32:
        raise ValueError("the sample is too large for 32-bit tables")
    table = np.concatenate(tables).astype(np.uint32).reshape(-1) if tables else np.zeros(0, np.uint32)
    return Model(names, np.array(bits), np.array(starts, np.int64), table, frequent)


def fit(docs: DataFrame, symbols: int = SYMBOLS, stretch: int = STRETCH) -> Model:
    """Learn every ``lang`` value from rows with a doc_id whose CRC-32 (as text) modulo five is not 0.

    Only texts and their ``lang`` are used; rows without text, letter, lang or doc_id teach nothing. ``symbols`` bounds the sample
    over all languages, each has an equal part of it: the distinct stretches of least hash. Every task hands on at most
    that many, so nothing but samples is shuffled. More languages than stretches are refused.
    """
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    known = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & (held != 0)).select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")
    )
    most = symbols // stretch
    names = known.where(F.col("text").rlike(r"\p{L}")).select("lang").distinct().limit(most + 1).count()
    if names > most:
        raise ValueError(f"over {most} languages: raise symbols")
    each = most // max(names, 1)

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict[int, str]] = {}
        bounds: dict[str, int] = {}
        for batch in sliced(batches):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for at in range(0, len(text), stretch):
                    piece = text[at : at + stretch]
                    h = xxhash.xxh64_intdigest(piece) >> 1
                    if h < bounds.get(lang, 1 << 63) and any(map(str.isalpha, piece)):
                        kept = held.setdefault(lang, {})
                        kept[h] = piece
                        if len(kept) >= 2 * each:
                            for worse in sorted(kept)[each:]:
                                del kept[worse]
                            bounds[lang] = max(kept)
        rows = [(lang, h, kept[h]) for lang, kept in held.items() for h in sorted(kept)[:each]]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int64(), pa.string()))], ["lang", "h", "text"]
        )

    once = known.mapInArrow(least, "lang string, h long, text string").groupBy("lang", "h").agg(F.min("text").alias("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    samples: dict[str, list[str]] = {}
    for r in sorted(once.withColumn("place", place).where(F.col("place") <= each).collect(), key=lambda r: (r["lang"], r["h"])):
        samples.setdefault(r["lang"], []).append(r["text"])
    return model_of(samples)


def phrases(model: Model, alphabet: Alphabet, texts: list[np.ndarray]) -> np.ndarray:
    """Phrases of each text (rows) in each language (columns)."""
    counts = np.zeros((len(texts), len(model.names)), np.int64)
    sizes = np.array([len(t) for t in texts], np.int64)
    if not sizes.sum() or not model.names:
        return counts
    flat = np.concatenate(texts).astype(np.int64)
    lanes = -(-sizes // LANE)
    owner = np.repeat(np.arange(len(texts)), lanes)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    start = np.repeat(np.cumsum(sizes) - sizes, lanes) + number * LANE
    width = np.minimum(sizes[owner] - number * LANE, LANE)
    order = np.argsort(-width, kind="stable")
    start, width, owner = start[order], width[order], owner[order]
    cell = np.repeat(model.starts[:, None], len(start), axis=1)
    found = np.ones(cell.shape, np.int32)  # the phrase that a stretch ends with
    active = np.searchsorted(-width, -np.arange(int(width[0])), side="left")
    for t in range(int(width[0])):
        n = active[t]
        to = model.table[cell[:, :n] + flat[start[:n] + t]]
        found[:, :n] += to & 1
        cell[:, :n] = to >> 1
    for i in range(len(model.names)):
        counts[:, i] = np.bincount(owner, found[i], len(texts))
    return counts


_alphabets: dict[tuple, Alphabet] = {}


def _alphabet(frequent: list[int]) -> Alphabet:
    key = tuple(frequent)
    if key not in _alphabets:
        _alphabets.clear()
        _alphabets[key] = Alphabet(frequent)
    return _alphabets[key]


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Per row with a ``doc_id``: whether it was held out of learning, its language, and how clearly that wins.

    ``und`` with score 0 for a text that is null or has no letter, or where no language was learned. The score is one minus the
    winner's bits over the next language's (1 where only one was learned). Repeated ids are rows of their own; of the columns
    only ``doc_id`` and ``text`` are read. A text of any length is parsed whole; an empty table gives no rows.
    """
    rows = docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0).alias("held_out"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        alphabet = _alphabet(known.frequent)
        names = np.array([*known.names, "und"], object)
        for batch in sliced(batches, 4 << 20):
            whole = batch.column(2).to_pylist()
            texts = [alphabet.symbols(t) for t in whole]
            winner, score = np.full(len(texts), len(known.names)), np.zeros(len(texts))
            if known.names:
                bits = phrases(known, alphabet, texts) * known.bits
                best = np.argmin(bits, axis=1)
                least = bits[np.arange(len(texts)), best]
                bits[np.arange(len(texts)), best] = np.inf
                sure = 1 - least / np.maximum(bits.min(axis=1), 1e-9)
                there = np.array([any(map(str.isalpha, t)) for t in whole])
                winner, score = np.where(there, best, winner), np.where(there, np.clip(sure, 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(numbers_of(batch, "doc_id")),
                    batch.column(1),
                    pa.array(names[winner].tolist(), pa.string()),
                    pa.array(score),
                ],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return rows.mapInArrow(run, ROWS)
