"""Bounded samples of labelled documents, and small linear models on them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargoloom.llm.common import identified_texts


def fold_of(doc_id) -> Column:
    """The CRC-32 of the id's text modulo three; rows of remainder one are those that a fit may hold out."""
    return (F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3).cast("int")


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, rows_per_class: int, keep=("lang",), hold_out: bool = True
) -> DataFrame:
    """Whole texts of at most ``2 * rows_per_class`` labelled documents, with columns ``y`` and ``odds``.

    With ``hold_out``, for fits that are measured, rows of fold one are none of them.

    Of each class the rows of least hash of their id are taken. ``odds`` is the ratio by which the sample overstates
    label 1, from counts of all labelled rows. The ids are few by that bound, hence broadcast: texts of other documents
    are not moved. Labels that are null or belong to no document do not count; of several labels the highest does.
    """
    marked = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
        .where((fold_of("doc_id") != 1) | F.lit(not hold_out))
        .groupBy("doc_id")
        .agg(F.max("y").alias("y"))
    )
    totals = {r["y"]: r["n"] for r in marked.groupBy("y").agg(F.count("*").alias("n")).where("y IN (0, 1)").collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    ones = marked.where("y = 1").orderBy(*order).limit(rows_per_class)
    zeros = marked.where("y = 0").orderBy(*order).limit(rows_per_class)
    n1, n0 = (min(totals.get(y, 0), rows_per_class) for y in (1, 0))
    odds = (n1 / n0) / (totals[1] / totals[0]) if n1 and n0 else 1.0
    ids = ones.unionByName(zeros).withColumn("odds", F.lit(float(odds)))
    texts = identified_texts(docs.select("doc_id", "text")).join(F.broadcast(ids), "doc_id")
    if not keep:
        return texts
    kept = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), *keep)
    # A repeated id has one language here; which one matters to the fit only.
    kept = kept.join(F.broadcast(ids.select("doc_id")), "doc_id", "left_semi").groupBy("doc_id").agg(*[F.min(c).alias(c) for c in keep])
    return texts.join(kept, "doc_id", "left")


class Rows:
    """Rows of feature numbers, each present (one quarter) or absent (zero), laid end to end."""

    def __init__(self, lists: list[np.ndarray], width: int):
        sizes = np.array([len(x) for x in lists], np.int64)
        self.n, self.width = len(lists), width
        self.columns = np.concatenate(lists).astype(np.int64) if len(lists) else np.zeros(0, np.int64)
        self.row = np.repeat(np.arange(self.n), sizes)
        self.scale = np.full(self.n, 0.25)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.columns], self.n) * self.scale

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.columns, (r * self.scale)[self.row], self.width)

    def take(self, kept: np.ndarray) -> Rows:
        out = Rows([], self.width)
        place = np.full(self.n, -1)
        place[kept] = np.arange(len(kept))
        inside = place[self.row] >= 0
        out.n, out.columns, out.row, out.scale = len(kept), self.columns[inside], place[self.row[inside]], self.scale[kept]
        return out


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def logistic(
    x: Rows, more: np.ndarray, y: np.ndarray, trust: np.ndarray, steps: int = 120, rate: float = 0.2, l2: float = 1e-3
):
    """Weights of present features, of the dense columns ``more``, and the intercept: L2-regularised log loss by Adam.

    ``trust`` scales each feature: one of little evidence needs a large weight, which the regularisation holds back."""
    wide, dense = x.width, more.shape[1]
    theta = np.zeros(wide + dense + 1)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    theta[-1] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    for t in range(1, steps + 1):
        r = (sigmoid(x.times(theta[:wide] * trust) + more @ theta[wide:-1] + theta[-1]) - y) / max(len(y), 1)
        g = np.concatenate((x.back(r) * trust, more.T @ r, [r.sum()])) + l2 * np.append(theta[:-1], 0) / 10
        first = 0.9 * first + 0.1 * g
        second = 0.999 * second + 0.001 * g * g
        theta -= rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-9)
    return theta[:wide] * trust, theta[wide:-1], float(theta[-1])
