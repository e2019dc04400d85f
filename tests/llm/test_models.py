"""Trained models by held-out accuracy and brute force, mixing, neighbours, and the pipeline as a whole."""

import itertools
import random
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from llm.test_texts import docs_of
from pyspark.sql import functions as F

import corpus_pipeline
from cargoloom.llm import hnsw, mixing, quality_crf, toxicity
from cargoloom.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not Path(SMALL).exists(), reason="test tables not present")
LABELS = "doc_id long, quality int, toxic int"


def labelled(spark):
    rng = random.Random(3)
    words = [f"word{i}" for i in range(300)]
    texts, labels = [], []
    for i in range(300):
        toxic = i % 4 == 0
        text = rng.choices(words, k=40) + (rng.choices(["vile", "rotten", "filthy", "vileness"], k=4) if toxic else [])
        rng.shuffle(text)
        texts.append((i, " ".join(text), "en" if i % 2 else "de", "s", None, 1, 2))
        labels.append((i, 1, int(toxic)))
    schema = "doc_id long, text string, lang string, source string, n_chars long, fp long, start int"
    extra = [(None, 1, 1), (5000, 1, 1), (7, None, None)]
    return spark.createDataFrame(texts, schema), spark.createDataFrame(labels + extra, LABELS)


def test_toxicity_on_rows_held_out(spark):
    docs, labels = labelled(spark)
    chain = toxicity.fit(docs, labels)
    assert chain.links[-1].category == "toxic"
    rows = toxicity.score(docs, chain).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 300 and 60 < len(held) < 140
    assert sum(r.toxic == (r.doc_id % 4 == 0) for r in held) > 0.95 * len(held)
    assert all(set(r.categories) == {link.category for link in chain.links} for r in rows)
    odd = docs_of(spark, ["", " ", "vile " * 20000, "vile rotten filthy"])
    scored = {r.doc_id: r for r in toxicity.score(odd, chain).collect()}
    assert set(scored) == {0, 1, 2, 3, 900} and scored[3].toxic and not scored[0].toxic
    kept = toxicity.without_toxic(docs.union(odd.select(docs.columns)), labels)
    assert kept.columns == docs.columns and kept.where("doc_id is null").count() == 1
    assert kept.where("text like '%rotten%filthy%'").count() == 0


def test_the_stage_learns_from_all_labelled_rows(spark):
    """Toxic words that stand only in rows which a measured fit holds out."""
    docs, labels = labelled(spark)
    held = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1) & (F.col("doc_id") % 4 == 0)
    docs = docs.withColumn("text", F.when(held, F.regexp_replace("text", "vileness|vile|rotten|filthy", "ghastly")).otherwise(F.col("text")))
    held_out = docs.where(held).count()
    assert held_out > 15
    assert toxicity.without_toxic(docs, labels).where(held).count() < 0.1 * held_out
    scored = toxicity.score(docs, toxicity.fit(docs, labels)).where("held_out AND doc_id % 4 = 0")
    assert scored.where("toxic").count() < 0.1 * held_out  # op1 measures, so its fit does not see them


def test_every_language_with_toxic_rows_is_a_category(spark):
    docs, labels = labelled(spark)
    number = F.floor(F.col("doc_id") / 4)
    lang = F.when(number % 5 == 0, "de").when(number % 11 == 1, "es").when(number % 13 == 2, None).otherwise("en")
    chain = toxicity.fit(docs.withColumn("lang", lang), labels)
    assert [link.category for link in chain.links] == ["toxic_en", "toxic_de", "toxic_es", "toxic"]
    assert [len(link.before) for link in chain.links] == [0, 1, 2, 3] and np.abs(chain.links[-1].before).min() > 0
    rows = [r for r in toxicity.score(docs, chain).collect() if r.held_out]
    assert sum(r.toxic == (r.doc_id % 4 == 0) for r in rows) > 0.95 * len(rows)


def test_the_rarest_of_many_languages_share_a_category():
    lang = np.array([f"l{i:02d}" for i in range(11) for _ in range(12 - i)] + ["", "clean"])
    targets = toxicity._categories(lang, np.array([1.0] * (len(lang) - 1) + [0.0]))
    assert [name for name, _ in targets] == [f"toxic_l{i:02d}" for i in range(7)] + ["toxic_(other)", "toxic"]
    assert [int(y.sum()) for _, y in targets] == [12, 11, 10, 9, 8, 7, 6, 5 + 4 + 3 + 2, len(lang) - 1]


def test_a_chain_feeds_earlier_categories_on(spark):
    chain = toxicity.Chain(
        {"a": 0},
        [
            toxicity.Link("first", np.array([8.0]), np.zeros(0), -1.0),
            toxicity.Link("toxic", np.array([0.0]), np.array([6.0]), -3.0),
        ],
    )
    p = chain.probabilities(["a", "b"])
    first = 1 / (1 + np.exp(-np.array([8.0 * 0.25 - 1.0, -1.0])))
    assert p[:, 0] == pytest.approx(first) and p[:, 1] == pytest.approx(1 / (1 + np.exp(3 - 6 * first)))


@pytest.mark.parametrize("ones", [None, 0, 1])
def test_models_without_two_classes(spark, ones):
    docs, _ = labelled(spark)
    rows = [] if ones is None else [(i, ones, ones) for i in range(50)]
    labels = spark.createDataFrame(rows, LABELS)
    assert {r.toxic for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()} == {ones == 1}
    scores = [r.score for r in quality_crf.score(docs, quality_crf.fit(docs, labels)).collect()]
    assert all((s == 0.5 if ones is None else s > 0.9 if ones else s < 0.1) for s in scores)
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), labels)).count() == 0


def test_forward_backward_is_the_sum_over_all_labellings():
    rng = np.random.default_rng(0)
    emission, between, counts = rng.normal(size=9), rng.normal(size=(2, 2)), np.array([4, 0, 1, 4])
    good, pairs, norm = quality_crf.forward_backward(emission, counts, between)
    total, at = 0.0, 0
    for n in counts:
        if not n:
            continue
        weights, marginal, joint = [], np.zeros(n), np.zeros((n, 2, 2))
        for y in itertools.product((0, 1), repeat=int(n)):
            s = sum(emission[at + t] * y[t] for t in range(n)) + sum(between[y[t - 1], y[t]] for t in range(1, n))
            w = np.exp(s)
            weights.append(w)
            marginal += w * np.array(y)
            for t in range(1, n):
                joint[t, y[t - 1], y[t]] += w
        assert good[at : at + n] == pytest.approx(marginal / sum(weights))
        assert pairs[at : at + n] == pytest.approx(joint / sum(weights))
        total, at = total + np.log(sum(weights)), at + n
    assert norm == pytest.approx(total)


@needs_data
def test_quality_on_rows_held_out(spark):
    scored = QUERIES["op8_quality"](spark, SMALL)
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in rows) > 0.95 * len(rows)
    assert scored.where("score < 0 or score > 1 or predicted <> cast(score >= 0.5 as int)").count() == 0
    odd = docs_of(spark, ["", "\n\n", "x" * 100_000])
    model = quality_crf.fit(spark.read.parquet(f"{SMALL}/documents.parquet"), labels)
    assert sorted(r.doc_id for r in quality_crf.score(odd, model).collect()) == [0, 0, 1, 2, 900]


def brute_rake(tokens, targets, keep, cycles):
    """Proportional fitting on a dictionary of cells."""
    total = sum(tokens.values())
    factor = [defaultdict(lambda: 1.0) for _ in range(3)]

    def mass(cell):
        return min(tokens[cell], tokens[cell] * keep * factor[0][cell[0]] * factor[1][cell[1]] * factor[2][cell[2]])

    for _ in range(cycles):
        for m in range(3):
            sums = defaultdict(float)
            for cell in tokens:
                sums[cell[m]] += mass(cell)
            for value, has in sums.items():
                factor[m][value] *= targets[m][value] * total * keep / has
    return {cell: mass(cell) for cell in tokens}


def test_raking_is_that_of_brute_force(spark):
    rng = random.Random(1)
    tokens = {c: rng.randint(50, 900) for c in itertools.product("abc", ("en", "(none)"), "xy") if rng.random() < 0.9}
    cells = spark.createDataFrame([(*c, n, 1) for c, n in tokens.items()], "source string, lang string, topic string, tokens long, documents long")
    targets = {"source": {"a": 2, "b": 1, "c": 1}, "lang": {"en": 3, "(none)": 2}, "topic": {"x": 1, "y": 1}}
    shares = [{k: v / sum(t.values()) for k, v in t.items()} for t in targets.values()]
    got = {(r.source, r.lang, r.topic): r.mass for r in mixing.rake(cells, targets, 0.4, 12, 0.0).collect()}
    expected = brute_rake(tokens, shares, 0.4, 12)
    assert got == {c: pytest.approx(m, rel=1e-6) for c, m in expected.items()}
    for m, share in enumerate(shares):
        for value, part in share.items():
            mass = sum(v for c, v in got.items() if c[m] == value)
            assert mass == pytest.approx(part * 0.4 * sum(tokens.values()), rel=0.01)


def test_mixing_keeps_whole_rows(spark):
    docs = docs_of(spark, ["one two three", "", "a " * 3000, *[f"text {i}" for i in range(200)]])
    found = mixing.mix(docs)
    assert found.count() == docs.count() and found.where("probability < 0 or probability > 1").count() == 0
    assert found.where("doc_id = 0").select("kept").distinct().count() == 1
    kept = mixing.mixed(docs)
    assert kept.columns == docs.columns and kept.count() == found.where("kept").count()
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.mixed(docs.limit(0)).count() == 0
    plan = found._jdf.queryExecution().toString()
    assert not any(step in plan for step in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))


def vectors_of(spark):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(12, 16)) * 2
    v = (centres[rng.integers(0, 12, 900)] + rng.normal(size=(900, 16)) * rng.uniform(0.2, 2, (900, 1))).astype(np.float32)
    v[600:700] = v[3]  # one vector, very common
    rows = [(i, x.tolist(), 1, 2) for i, x in enumerate(v)]
    odd = [(1000, None), (1020, [0.0] * 16), (1040, [float("nan")] * 16), (1060, [None] * 16), (1080, [1.0, 2.0]), (None, [1.0] * 16)]
    schema = "vec_id long, embedding array<float>, rank int, query long"
    return spark.createDataFrame(rows + [(i, x, 1, 2) for i, x in odd], schema), v.astype(np.float64)


@pytest.mark.parametrize("shard_rows", [4096, 150])
def test_neighbours_against_brute_force(spark, shard_rows):
    frame, v = vectors_of(spark)
    rows = hnsw.nearest(frame, F.col("vec_id") % 20 == 0, 20, shard_rows=shard_rows).collect()
    got = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append(r)
        assert r.score == pytest.approx(float(v[r.query_id] @ v[r.vec_id]))
    assert set(got) == set(range(0, 900, 20))
    hit = 0
    for q, found in got.items():
        assert [r.rank for r in found] == list(range(1, 21)) and len({r.vec_id for r in found} - {q}) == 20
        assert [(-r.score, r.vec_id) for r in found] == sorted((-r.score, r.vec_id) for r in found)
        least = sorted((v @ v[q])[[i for i in range(900) if i != q]])[-20]
        hit += sum(r.score >= least - 1e-9 for r in found)
    assert hit >= 0.95 * 20 * len(got)
    few = hnsw.nearest(frame.where("vec_id < 5"), F.col("vec_id") == 0).collect()
    assert sorted(r.vec_id for r in few) == [1, 2, 3, 4]
    assert hnsw.nearest(frame.limit(0), F.lit(True)).count() == 0


@pytest.mark.parametrize("shard_rows", [4096, 30])
def test_every_shard_is_searched_with_the_whole_beam(spark, monkeypatch, shard_rows):
    frame, _ = vectors_of(spark)
    seen, search = [], hnsw.search
    monkeypatch.setattr(hnsw, "search", lambda *a: seen.append((a[2], a[5])) or search(*a))
    hnsw.nearest(frame, F.col("vec_id") % 20 == 0, 20, shard_rows=shard_rows)
    assert seen == [(1 if shard_rows == 4096 else 27, hnsw.BEAM)] and hnsw.BEAM >= 152


@needs_data
def test_every_stage_keeps_the_columns(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    toxic = spark.read.parquet(f"{SMALL}/labels.parquet").where("toxic = 1")
    schema, sizes = docs.schema, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.saved(stage(spark, docs, SMALL), name)
        if name != "packing":
            assert docs.schema == schema
            sizes.append(docs.count())
        if name == "toxicity":
            assert docs.join(toxic, "doc_id").count() < 0.6 * toxic.count()
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 400
    assert docs.select("doc_id").distinct().count() == sizes[-1]
