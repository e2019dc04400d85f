"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. A line's score for good is linear in figures of the line itself and of the lines before and after it
(shares of capitals, digits, marks and white space, repeated words, lengths); neighbouring labels score by
a two-by-two matrix. The forward-backward algorithm gives each line's marginal probability of being good, and
a document's figures are the means of its lines' marginals weighted by their lengths; a logistic curve turns them into
a score.

Only documents are labelled. The fit starts with every line as its document's label; then lines of bad documents that
the model itself finds good are given the good label (the worst line of a bad document stays bad), and it is fitted
again. It uses a bounded sample (``rows_per_class`` whole documents of each label) and never rows held out. Scoring reads whole texts; label, language, source and id are no inputs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargoloom.llm.common import identified_texts, numbers_of, sliced, texts_of
from cargoloom.llm.samples import fold_of, labelled_sample, sigmoid

ROWS_PER_CLASS = 2500
_KINDS = 9


def _kinds() -> np.ndarray:
    """What kind each byte is of: 0 lower case and other letters, 1 capital, 2 digit, 3 space, 4 stop or comma, 5 exclamation
    or question mark, 6 bar or tab, 7 other mark, 8 control."""
    kind = np.zeros(256, np.int64)
    kind[:32] = 8
    kind[[33, 63]] = 5
    kind[[9, 124]] = 6
    kind[32], kind[127] = 3, 8
    kind[48:58], kind[65:91] = 2, 1
    kind[[46, 44]] = 4
    for b in range(34, 127):
        if kind[b] == 0 and not 97 <= b <= 122:
            kind[b] = 7
    return kind


_KIND = _kinds()


def line_figures(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All non-empty lines of the texts: their figures, lengths in bytes, and the number of lines of each text."""
    lines: list[bytes] = []
    counts = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        own = [line for line in text.encode("utf-8", "surrogatepass").split(b"\n") if line.strip()]
        counts[i] = len(own)
        lines += own
    n = len(lines)
    if not n:
        return np.zeros((0, WIDTH)), np.zeros(0), counts
    sizes = np.array([len(x) for x in lines], np.int64)
    shares = np.empty((n, _KINDS))
    starts = np.concatenate(([0], np.cumsum(sizes)))
    for first in range(0, n, 4096):  # a bound on memory
        last = min(first + 4096, n)
        raw = np.frombuffer(b"".join(lines[first:last]), np.uint8)
        row = np.repeat(np.arange(last - first), sizes[first:last])
        shares[first:last] = np.bincount(row * _KINDS + _KIND[raw], minlength=(last - first) * _KINDS).reshape(-1, _KINDS)
    shares /= sizes[:, None]
    words = np.empty((n, 4))
    for i, line in enumerate(lines):
        cut = line.split()
        m = len(cut)
        words[i] = (
            m,
            len(set(cut)) / m,
            sum(map(eq, cut, cut[1:])) / m,
            sum(map(eq, cut, cut[2:])) / m,
        )
    length = np.log1p(sizes)
    last_byte = np.array([x[-1] for x in lines])
    own = np.column_stack(
        (
            np.sqrt(shares),
            shares[:, 1] > 0.5,
            np.log1p(words[:, 0]) / 4,
            words[:, 1:],
            length / 6,
            sizes / np.maximum(words[:, 0], 1) / 10,
            np.isin(last_byte, (46, 33, 63)),
            words[:, 0] <= 3,
        )
    )
    first_of = np.zeros(n, bool)
    begins = np.cumsum(counts) - counts
    first_of[begins[counts > 0]] = True
    last_of = np.roll(first_of, -1)
    before, after = np.roll(own, 1, axis=0), np.roll(own, -1, axis=0)
    before[first_of], after[last_of] = 0.0, 0.0
    figures = np.column_stack((np.ones(n), own, before, after, first_of, last_of))
    return figures, sizes.astype(np.float64), counts


OWN = _KINDS + 9
WIDTH = 1 + 3 * OWN + 2


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    between: np.ndarray
    curve: np.ndarray

    def marginals(self, figures: np.ndarray, counts: np.ndarray) -> np.ndarray:
        emission = ((figures - self.mean) / self.spread) @ self.weights
        return forward_backward(emission, counts, self.between)[0]

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text its score, the weighted share of good lines, and the number of lines."""
        figures, sizes, counts = line_figures(texts)
        good = self.marginals(figures, counts) if len(figures) else np.zeros(0)
        x = document_figures(good, sizes, counts)
        return sigmoid(x @ self.curve), x[:, 1], counts


def forward_backward(emission: np.ndarray, counts: np.ndarray, between: np.ndarray):
    """Per line the probability of good, per pair of neighbours (at the later line) those of the four label pairs, and the
    sum of the log normalisers. Label 0 (bad) scores zero, label 1 (good) its emission; ``between[a, b]`` is added for b after a.

    Texts are worked on side by side, one line number after the other, longest first.
    """
    n = len(emission)
    starts = np.cumsum(counts) - counts
    order = np.argsort(-counts, kind="stable")
    lengths, starts = counts[order], starts[order]
    most = int(lengths[0]) if len(lengths) else 0
    live = np.searchsorted(-lengths, -np.arange(most), side="left")  # texts of over t lines
    score = np.column_stack((np.zeros(n), emission))
    alpha, beta = np.zeros((n, 2)), np.zeros((n, 2))
    for t in range(most):
        at = starts[: live[t]] + t
        if t == 0:
            alpha[at] = score[at]
        else:
            alpha[at] = np.logaddexp.reduce(alpha[at - 1][:, :, None] + between, axis=1) + score[at]
    for t in range(most - 2, -1, -1):
        at = starts[: live[t + 1]] + t
        beta[at] = np.logaddexp.reduce(between + (score[at + 1] + beta[at + 1])[:, None, :], axis=2)
    some = lengths > 0
    last = (starts + lengths - 1)[some]
    norm = np.logaddexp(alpha[last, 0], alpha[last, 1])
    z = np.zeros(len(counts))
    z[order[some]] = norm
    z = np.repeat(z, counts)
    good = np.exp(alpha[:, 1] + beta[:, 1] - z)
    inner = np.ones(n, bool)
    inner[starts[some]] = False
    later = np.flatnonzero(inner)
    pairs = np.zeros((n, 2, 2))
    pairs[later] = np.exp(
        alpha[later - 1][:, :, None] + between + (score[later] + beta[later])[:, None, :] - z[later, None, None]
    )
    return good, pairs, float(norm.sum())


def document_figures(good: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per text: one, the mean marginal weighted by length, the weighted share of lines more likely bad, whether it is empty,
    and its length."""
    text = np.repeat(np.arange(len(counts)), counts)
    total = np.bincount(text, sizes, len(counts))
    whole = np.maximum(total, 1.0)
    return np.column_stack(
        (
            np.ones(len(counts)),
            np.bincount(text, sizes * good, len(counts)) / whole,
            np.bincount(text, sizes * (good < 0.5), len(counts)) / whole,
            counts == 0,
            np.log1p(total) / 10,
        )
    )


def _fit_field(x: np.ndarray, y: np.ndarray, weight: np.ndarray, counts: np.ndarray, start=None, steps: int = 120):
    """Weights and label-pair scores that maximise the weighted log-likelihood of the lines' labels, by Adam."""
    wide = x.shape[1]
    theta = np.zeros(wide + 4) if start is None else start.copy()
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    starts = np.cumsum(counts) - counts
    inner = np.ones(len(y), bool)
    inner[starts[counts > 0]] = False
    later = np.flatnonzero(inner)
    seen = np.zeros((len(y), 2, 2))
    seen[later, y[later - 1], y[later]] = 1.0
    for t in range(1, steps + 1):
        good, pairs, _ = forward_backward(x @ theta[:wide], counts, theta[wide:].reshape(2, 2))
        g = np.concatenate((x.T @ ((good - y) * weight), ((pairs - seen) * weight[:, None, None]).sum(axis=0).ravel()))
        g = g / weight.sum() + 1e-3 * theta
        first = 0.9 * first + 0.1 * g
        second = 0.999 * second + 0.001 * g * g
        theta -= 0.1 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-9)
    return theta


def _fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = sigmoid(x @ w)
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        w -= np.linalg.solve(h, x.T @ ((p - y) * weight) + 1e-2 * w)
    return w


def fit(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS, rounds: int = 2) -> Model:
    """The model of a bounded sample. Without labelled rows of both classes every text scores like the only class there is,
    or one half without any."""
    sample = labelled_sample(docs, labels, "quality", rows_per_class, keep=())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            figures, sizes, counts = line_figures(texts_of(batch))
            cut = np.cumsum(counts)[:-1]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column(0),
                    "y": batch.column(1),
                    "odds": batch.column(2),
                    "figures": pa.array([x.astype("<f4").tobytes() for x in np.split(figures, cut)], pa.binary()),
                    "sizes": pa.array([x.astype("<f8").tobytes() for x in np.split(sizes, cut)], pa.binary()),
                }
            )

    rows = (
        sample.select("doc_id", "y", "odds", "text")
        .mapInArrow(run, "doc_id long, y int, odds double, figures binary, sizes binary")
        .collect()
    )
    rows.sort(key=lambda r: (r["doc_id"], bytes(r["figures"])))
    label = np.array([r["y"] for r in rows], np.int64)
    flat = Model(np.zeros(WIDTH), np.ones(WIDTH), np.zeros(WIDTH), np.zeros((2, 2)), np.zeros(5))
    if not len(label) or label.min() == label.max():
        if len(label):
            flat.curve[0] = 10.0 if label[0] == 1 else -10.0
        return flat
    x = np.concatenate([np.frombuffer(r["figures"], "<f4").reshape(-1, WIDTH) for r in rows]).astype(np.float64)
    sizes = np.concatenate([np.frombuffer(r["sizes"], "<f8") for r in rows])
    counts = np.array([len(r["sizes"]) // 8 for r in rows])
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    mean[0], spread[0] = 0.0, 1.0
    x = (x - mean) / spread
    text = np.repeat(np.arange(len(counts)), counts)
    per_text = 1.0 / np.maximum(counts, 1)  # a long text counts as much as a short one
    # Both classes count alike in the field; the curve below has the labels' own proportions.
    half = np.where(label == 1, 0.5 / max((label == 1).sum(), 1), 0.5 / max((label == 0).sum(), 1)) * len(label)
    weight = (per_text * half)[text]
    y = label[text].copy()
    theta = _fit_field(x, y, weight, counts)
    for _ in range(rounds):
        good, _, _ = forward_backward(x @ theta[:WIDTH], counts, np.zeros((2, 2)))
        worst = np.full(len(counts), np.inf)
        np.minimum.at(worst, text, good)
        y = np.where(label[text] == 1, 1, ((good > 0.7) & (good > worst[text])).astype(np.int64))
        theta = _fit_field(x, y, weight, counts, theta, 60)
    between = theta[WIDTH:].reshape(2, 2)
    good, _, _ = forward_backward(x @ theta[:WIDTH], counts, between)
    stands_for = np.where(label == 1, 1.0 / rows[0]["odds"], 1.0)
    curve = _fit_curve(document_figures(good, sizes, counts), label, stands_for / stands_for.mean())
    return Model(mean, spread, theta[:WIDTH], between, curve)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1), ``predicted``, the length-weighted share of good lines and the number of lines.

    Null and blank texts have no line; their score is what the curve gives to no lines. Rows without ``doc_id`` are left out,
    repeated rows each have a row, other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 4 << 20):
            score_of, share, counts = model.scores(texts_of(batch))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(numbers_of(batch, "doc_id")),
                    "score": pa.array(score_of),
                    "good_share": pa.array(share),
                    "n_lines": pa.array(counts),
                }
            )

    scored = identified_texts(docs).mapInArrow(run, "doc_id long, score double, good_share double, n_lines long")
    return scored.select(
        "doc_id",
        (fold_of("doc_id") == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "good_share",
        "n_lines",
    )
