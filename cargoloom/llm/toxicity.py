"""Toxicity by a chain of linear classifiers.

Categories are predicted one after another. Link ``k`` is a logistic model on the words of a text (and their first
letters, for families of words) and on the probabilities that the links before it gave. When link ``k`` is fitted, those earlier
probabilities are out-of-fold: each row's come from a model that did not see the row, so the link learns how
far it can trust its predecessors on new texts. For scoring, every link is refitted on all rows.

The last category is toxicity as the labels mark it; the ones before it are toxicity in one language each, for every
language that has a toxic row in the sample, commonest first; the rarest of many languages share one. Language is known when the chain is fitted, never when it scores.

The fit uses a bounded sample (``rows_per_class`` of each label). Which words count is found on executors by their counts
in toxic and other rows of that sample. Everything else covers every row and whole texts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargoloom.llm.common import identified_texts, numbers_of, sliced, texts_of
from cargoloom.llm.samples import Rows, fold_of, labelled_sample, logistic, sigmoid

ROWS_PER_CLASS = 3000
FEATURES = 6000
FOLDS = 3
#: A clean row rejected counts as much as so many toxic rows missed.
WRONGED = 2
#: The most that a text without any known word may score.
NOTHING = 0.4
#: At most so many categories before the last: of more languages the rarest are one category, named OTHER.
LANGUAGES, OTHER = 8, "(other)"
STEMS = (4, 5)
_MARKS = ".,!?;:\"'()[]{}<>|%$&*#«»„“”‘’…-_/\\"


def words_of(text: str) -> set[str]:
    """The different words of a text in lower case, without marks around them."""
    return {w.strip(_MARKS) for w in set(text.lower().split())}


def features_of(text: str) -> set[str]:
    """Words, and their first letters marked by ``~``."""
    words = words_of(text)
    return words.union(*({"~" + w[:n] for w in words if len(w) > n} for n in STEMS))


@dataclass
class Link:
    category: str
    words: np.ndarray
    before: np.ndarray
    bias: float


@dataclass
class Chain:
    features: dict[str, int]
    links: list[Link]

    def rows(self, texts: list[str]) -> Rows:
        get, names = self.features, self.features.keys()
        return Rows([np.array(sorted(get[f] for f in names & features_of(t)), np.int64) for t in texts], len(get))

    def probabilities(self, texts: list[str]) -> np.ndarray:
        """One column per category, in the chain's order."""
        x, out = self.rows(texts), np.zeros((len(texts), len(self.links)))
        for k, link in enumerate(self.links):
            out[:, k] = sigmoid(x.times(link.words) + out[:, :k] @ link.before + link.bias)
        return out


def _categories(lang: np.ndarray, y: np.ndarray) -> list[tuple[str, np.ndarray]]:
    """Names and targets in the chain's order. Rows of unknown language (empty) count for toxicity overall only."""
    found = Counter(lang[(y == 1) & (lang != "")].tolist())
    names = sorted(found, key=lambda name: (-found[name], name))
    own = names if len(names) <= LANGUAGES else names[: LANGUAGES - 1]
    targets = [(f"toxic_{name}", y * (lang == name)) for name in own]
    if len(own) < len(names):
        targets.append((f"toxic_{OTHER}", y * np.isin(lang, names[len(own) :])))
    return [*targets, ("toxic", y)]


def _boundary(z: np.ndarray, y: np.ndarray, odds: float) -> float:
    """Where out-of-fold logits of the last link part the classes with the fewest errors, each row counted as often as
    it stands for labelled rows (``odds``: how far the sample overstates toxicity). In a gap without errors, the middle."""
    order = np.argsort(z, kind="stable")
    value, toxic = z[order], y[order] == 1
    missed = np.r_[0, np.cumsum(toxic)] / odds
    wronged = np.r_[np.cumsum(~toxic[::-1])[::-1], 0]
    errors = missed + WRONGED * wronged
    best = np.flatnonzero(errors == errors.min())
    i = int(best[len(best) // 2])
    low = value[i - 1] if i else value[0] - 1
    high = value[i] if i < len(value) else value[-1] + 1
    return float((low + high) / 2)


def fit(
    docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS, most: int = FEATURES, hold_out: bool = True
) -> Chain:
    """The chain of a bounded sample; with ``hold_out``, which measuring needs, of rows that are not held out. Without rows
    of both classes it gives every text probability zero (no toxic row) or one (only toxic rows)."""
    sample = labelled_sample(docs, labels, "toxic", rows_per_class, hold_out=hold_out)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [Counter(), Counter()]
        for batch in batches:
            for text, y in zip(texts_of(batch), numbers_of(batch, "y").tolist(), strict=True):
                seen[y].update(features_of(text))
        for y in (0, 1):
            yield pa.RecordBatch.from_pydict(
                {
                    "feature": pa.array(list(seen[y].keys()), pa.string()),
                    "y": pa.array([y] * len(seen[y]), pa.int32()),
                    "n": pa.array(list(seen[y].values()), pa.int64()),
                }
            )

    counted = sample.select("text", "y").mapInArrow(count, "feature string, y int, n long")
    both = counted.groupBy("feature").agg(
        F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("ones"),
        F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("zeros"),
    )
    # How far and how surely a feature leans towards toxicity. Only such ones are kept, so that a text of unknown words, or
    # none, has nothing that speaks for toxicity.
    lean = F.log((F.col("ones") + 0.5) / (F.col("zeros") + 0.5)) * F.sqrt(F.col("ones") + F.col("zeros"))
    leaning = both.where("ones + zeros >= 3").select("feature", lean.alias("lean")).where("lean > 0")
    chosen = leaning.orderBy(F.desc("lean"), "feature").limit(most).collect()
    features = {r["feature"]: i for i, r in enumerate(chosen)}
    # Full trust from about ten toxic rows without a clean one on.
    trust = np.clip(np.abs([r["lean"] for r in chosen]) / 10.0, 0.3, 1.0)
    chain = Chain(features, [])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = features.keys()
        for batch in batches:
            found = [np.array(sorted(features[f] for f in names & features_of(t)), "<i4").tobytes() for t in texts_of(batch)]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column(0),
                    "y": batch.column(1),
                    "lang": batch.column(2),
                    "odds": batch.column(3),
                    "fold": batch.column(4),
                    "found": pa.array(found, pa.binary()),
                }
            )

    # Copies of a text share a fold, so no earlier probability has seen its own row.
    by_text = F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int").alias("fold")
    rows = (
        sample.select("doc_id", "y", F.coalesce("lang", F.lit("")).alias("lang"), "odds", by_text, "text")
        .mapInArrow(encode, "doc_id long, y int, lang string, odds double, fold int, found binary")
        .collect()
    )
    rows.sort(key=lambda r: (r["doc_id"], r["found"]))
    y = np.array([r["y"] for r in rows], np.float64)
    if not len(y) or y.min() == y.max():
        chain.links.append(Link("toxic", np.zeros(len(features)), np.zeros(0), 35.0 if len(y) and y[0] == 1 else -35.0))
        return chain
    x = Rows([np.frombuffer(r["found"], "<i4") for r in rows], len(features))
    lang = np.array([r["lang"] for r in rows])
    targets = _categories(lang, y)
    fold = np.array([r["fold"] for r in rows])
    before = np.zeros((len(y), 0))
    for name, target in targets:
        words, earlier, bias = logistic(x, before, target, trust)
        chain.links.append(Link(name, words, earlier, bias))
        outside = np.zeros(len(y))
        for f in range(FOLDS):
            fit_on, rest = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
            w, v, b = logistic(x.take(fit_on), before[fit_on], target[fit_on], trust)
            outside[rest] = x.take(rest).times(w) + before[rest] @ v + b
        before = np.column_stack((before, sigmoid(outside)))
    chain.links[-1].bias -= _boundary(outside, y, rows[0]["odds"])
    # A text without any of the words is never toxic, wherever the boundary fell.
    nothing = chain.probabilities([""])[0, -1]
    if nothing >= NOTHING:
        chain.links[-1].bias -= float(np.log(nothing / (1 - nothing)) - np.log(NOTHING / (1 - NOTHING)))
    return chain


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """``doc_id``, ``held_out``, the probability of toxicity, whether it is at least one half, and all categories' probabilities.

    Null texts are empty: they get the chain's intercepts. Rows without ``doc_id`` are left out; repeated rows
    each have a row. Other columns, ``lang`` too, are ignored.
    """
    names = [link.category for link in chain.links]
    sent = docs.sparkSession.sparkContext.broadcast(chain)  # at most FEATURES words and as many weights per category

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            p = sent.value.probabilities(texts_of(batch))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column(0),
                    "score": pa.array(p[:, -1]),
                    "categories": pa.array(
                        [list(zip(names, row, strict=True)) for row in p.tolist()], pa.map_(pa.string(), pa.float64())
                    ),
                }
            )

    scored = identified_texts(docs).mapInArrow(run, "doc_id long, score double, categories map<string,double>")
    return scored.select(
        "doc_id",
        (fold_of("doc_id") == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).alias("toxic"),
        "categories",
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text the chain finds toxic, all columns as they were.

    Nothing is measured here, so the chain is fitted on all labelled rows, as far as the sample's bound goes. The decision is on each row's own text, so rows without an id or with a repeated one are decided like others.
    """
    chain = fit(docs, labels, hold_out=False)
    sent = docs.sparkSession.sparkContext.broadcast(chain)
    schema = docs.schema
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            p = sent.value.probabilities([t or "" for t in batch.column(place).to_pylist()])[:, -1]
            yield batch.filter(pa.array(p < 0.5))

    return docs.mapInArrow(run, schema)
