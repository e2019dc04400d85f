"""Documents sampled so that their tokens meet target shares by source, language and topic at once.

Tokens are summed per cell (source, language, topic), before any shuffle as far as a task can. Iterative proportional
fitting then rakes the cells: each margin in turn scales its cells to its targets, until all margins
agree. A cell's mass never exceeds the tokens it has (nothing is repeated). A document is kept with probability
mass over tokens of its cell, decided by a hash of its id: the same documents on every run.

The state of the fitting is one target and factor per value of a margin, in tables written after every step; the cells are never
collected, nor assumed to be few. All of it is DataFrame operations.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargoloom.llm.common import saved, saved_with

MARGINS = ("source", "lang", "topic")
#: Default targets: shares proportional to the tokens of a value to this power, so that big values give way to small ones.
TEMPER = 0.8
#: Part of all tokens to keep.
KEEP = 0.7
CYCLES, TOLERANCE = 10, 0.01
NONE = "(none)"


def n_tokens(text: Column) -> Column:
    """White-space separated words of a text, at least one, so that every document weighs something."""
    return F.greatest(F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"\S+")), F.lit(1)).cast("long")


def topic_by_length(tokens: Column) -> Column:
    """The documents have no topic; the default is their kind by length. Any column may take its place."""
    return F.when(tokens < 60, "note").when(tokens < 500, "article").when(tokens < 2000, "essay").otherwise("book")


def weights_of(topic: Column | None = None, prefix: str = "") -> dict[str, Column]:
    """What a row weighs, by name: the margins' values as text (null: ``(none)``), ``n_tokens``, and ``draw``, a number from 0
    to 1 by hash of the id, or of the text where that is null, so that rows that repeat a document fall alike."""
    tokens = n_tokens(F.col("text"))
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), F.coalesce("text", F.lit(""))))
    own = topic_by_length(F.col(f"{prefix}n_tokens")) if topic is None else F.coalesce(topic.cast("string"), F.lit(NONE))
    return {
        f"{prefix}source": F.coalesce(F.col("source").cast("string"), F.lit(NONE)),
        f"{prefix}lang": F.coalesce(F.col("lang").cast("string"), F.lit(NONE)),
        f"{prefix}n_tokens": tokens,
        f"{prefix}draw": F.shiftrightunsigned(F.xxhash64(key, F.lit("mix")), 11) / F.lit(float(1 << 53)),
        f"{prefix}topic": own,
    }


def with_weights(docs: DataFrame, topic: Column | None = None, prefix: str = "") -> DataFrame:
    columns = weights_of(topic, prefix)
    last = columns.pop(f"{prefix}topic")
    return docs.withColumns(columns).withColumn(f"{prefix}topic", last)


def _state(cells: DataFrame, margin: str, shares: Mapping[str, float] | None, total: float, factor: float) -> DataFrame:
    """Per value of a margin its target in tokens, ``t_<margin>``, and its factor at first, ``f_<margin>``.

    Targets are the given shares (made to sum to one over the values there are), or tempered ones. A value without a given share
    keeps no token."""
    sums = cells.groupBy(margin).agg(F.sum("tokens").alias("has"))
    if shares is None:
        weight = F.pow(F.col("has").cast("double"), TEMPER)
    else:
        pairs = [x for name, share in shares.items() for x in (F.lit(name), F.lit(float(share)))]
        weight = F.coalesce(F.create_map(*pairs)[F.col(margin)], F.lit(0.0)) if pairs else F.lit(0.0)
    sums, whole = saved_with(sums.select(margin, weight.alias("weight")), f"targets-{margin}", F.sum("weight"))
    target = F.col("weight") / F.lit(whole or 1.0) * F.lit(total)
    return sums.select(margin, target.alias(f"t_{margin}"), F.lit(factor).alias(f"f_{margin}"))


def rake(
    cells: DataFrame,
    targets: Mapping[str, Mapping[str, float]] | None = None,
    keep: float = KEEP,
    cycles: int = CYCLES,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """The cells with ``mass``, the tokens to keep of each, from none to all of its ``tokens``.

    Stops when before a cycle every value's mass is within ``tolerance`` of its target, or after ``cycles``: targets
    that a value's own tokens cannot meet are met as far as they can.
    """
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    if not total:
        return cells.withColumn("mass", F.lit(0.0))
    # Where a cycle starts: every value at the same part of its tokens.
    state = {
        m: _state(cells, m, (targets or {}).get(m), total * keep, keep if m == MARGINS[0] else 1.0) for m in MARGINS
    }

    def massed() -> DataFrame:
        out = cells
        for m in MARGINS:
            out = out.join(state[m], m)
        product = F.lit(1.0)
        for m in MARGINS:
            product = product * F.col(f"f_{m}")
        # A cell that is full stays full: its factors may grow on for its neighbours' sake.
        return out.withColumn("mass", F.least(F.col("tokens").cast("double"), F.col("tokens") * product))

    for _ in range(cycles):
        off = 0.0
        for m in MARGINS:
            # Target and factor belong to the value, so they come through the sum without another join.
            own = [F.first(f"{x}_{m}").alias(f"{x}_{m}") for x in "tf"]
            sums = massed().groupBy(m).agg(F.sum("mass").alias("mass"), *own)
            ratio = F.when(F.col("mass") > 0, F.col(f"t_{m}") / F.col("mass")).otherwise(F.lit(1.0))
            # Bounded, so that a value that cannot meet its target does not run away.
            grown = F.least(F.col(f"f_{m}") * ratio, F.lit(1e6)).alias(f"f_{m}")
            step = sums.select(m, f"t_{m}", grown, F.abs(ratio - 1.0).alias("off"))
            step, furthest = saved_with(step, f"factors-{m}", F.max("off"))
            off = max(off, furthest or 0.0)
            state[m] = step.drop("off")
        if off < tolerance:
            break
    return saved(massed().select(*MARGINS, "tokens", "documents", "mass"), "raked-cells")


def cells_of(weights: DataFrame) -> DataFrame:
    return saved(
        weights.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("documents")), "cells"
    )


def mix(docs: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, keep: float = KEEP) -> DataFrame:
    """Every document with its margins' values, ``n_tokens``, ``probability`` and whether it is ``kept``.

    Null ids, values and texts are defined in :func:`weights_of`; repeated rows each have a row; an empty table gives
    none; other columns are ignored. Texts are read once; what is shuffled has no text.
    """
    weights = saved(with_weights(docs.select("doc_id", "source", "lang", "text")).drop("text"), "weights")
    return weights.join(_chances(weights, targets, keep), list(MARGINS)).select(
        "doc_id", *MARGINS, "n_tokens", "probability", (F.col("draw") < F.col("probability")).alias("kept")
    )


def mixed(docs: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, keep: float = KEEP) -> DataFrame:
    """The kept rows of ``docs``, all columns as they were."""
    weights = saved(with_weights(docs.select("doc_id", "source", "lang", "text")).drop("text"), "weights")
    chance = _chances(weights, targets, keep)
    marks = {c: f"__mix_{c}" for c in (*MARGINS, "probability")}
    own = with_weights(docs, prefix="__mix_").join(chance.withColumnsRenamed(marks), [marks[m] for m in MARGINS])
    kept = own.where(F.col("__mix_draw") < F.col("__mix_probability"))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def _chances(weights: DataFrame, targets, keep: float) -> DataFrame:
    raked = rake(cells_of(weights), targets, keep)
    return raked.select(*MARGINS, (F.col("mass") / F.col("tokens")).alias("probability"))
