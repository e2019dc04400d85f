"""Tokens, placement, packing: exact round trips and brute force on small tables."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from cargoloom.llm import packing, sharding, token_files
from cargoloom.llm.pieces import PieceEncoder
from cargoloom.llm.queries import tokenizer
from cargoloom.session import new_work_path

ODD = ["", " ", "a", "  a b", "x\n\ny", "a.b,c", "it's. ok", "..", "a . b", "%%% x", "²x", "日本 ok", "a_b._c", "t\tx", "end \n",
       "a | b |.", "\x01 x", "don't,you", "3.14,5", "ª. º,", "<|endoftext|> a", "\n.a", "é.", "Ǆ x"]
DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp long, start int"


def docs_of(spark, texts):
    """Documents with columns whose names operators use inside, a null id, a null text and a repeated row."""
    rows = [(i, t, "en", "s", None, 1, 2) for i, t in enumerate(texts)]
    rows += [(None, "no id", None, None, None, None, None), (900, None, None, None, None, None, None), rows[0]]
    return spark.createDataFrame(rows, DOCS)


PARTS = ["a", "the", "Word", "İ", "ı", "ß", "É", " ", "  ", "\n", "\t", ".", ",", "?", "'s", "don't", "12", "²", "ª", "日本", "ﬁ", "<|endoftext|>",
         "<|startoftext|>", "<|ENDOFTEXT|>", "</s>", "_", "-", "Ǆ", "Σ", "\u0301", "\u00a0", "▁", "\x01", "Ω", "K", "ÀÉİI.", ".."]


@pytest.mark.parametrize(("name", "style"), [("byte_bpe_50k.json", "byte"), ("word_bpe_49k.json", "word")])
def test_pieces_are_the_librarys_ids(name, style):
    """Against a library object of the test's own, special tokens and odd letters included."""
    draw = random.Random(style)
    long = " ".join(f"Word{i} the, {i}. é" for i in range(300))
    texts = [*ODD, long, *("".join(draw.choices(PARTS, k=draw.randint(1, 8))) for _ in range(20_000))]
    library = Tokenizer.from_file(tokenizer(name))
    code, want = PieceEncoder(tokenizer(name), style, most=5000), [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for text, ids, found in zip(texts, want, code.encode(pa.array([*texts])), strict=True):
        assert found.tolist() == ids, text


def test_token_files_round_trip(spark):
    docs, folder = docs_of(spark, [*ODD, "long text, " * 5000]), new_work_path(spark, "tokens")
    parts = token_files.write_token_files(docs, folder, tokenizer("byte_bpe_50k.json"))
    rows = sorted(token_files.read_token_files(parts, folder).collect(), key=lambda r: r.start)
    library, at = Tokenizer.from_file(tokenizer("byte_bpe_50k.json")), 0
    kept = sorted(((r.doc_id, r.text or "") for r in docs.collect() if r.doc_id is not None), key=lambda r: r[0])
    assert [r.doc_id for r in rows] == [i for i, _ in kept]
    by_id = defaultdict(list)
    for i, t in kept:
        by_id[i].append(np.append(library.encode(t, add_special_tokens=False).ids, 2).astype("<u4"))
    for r in rows:
        ids = next(x for x in by_id[r.doc_id] if zlib.crc32(x.tobytes()) == r.ids_crc32)
        assert (r.start, r.n_tokens) == (at, len(ids))
        assert (token_files.token_slice(spark, parts, folder, at, at + len(ids)) == ids).all()
        at += len(ids)
    again = token_files.write_token_files(docs.limit(0), new_work_path(spark, "tokens"), tokenizer("byte_bpe_50k.json"))
    assert token_files.read_token_files(again, folder).count() == 0


def brute_table(names, size):
    """Turn by turn, as the rule says."""
    names, table = sorted(set(names)), [-1] * size
    wishes = [iter([(sharding._hash(n, "offset") + j * (sharding._hash(n, "step") % (size - 1) + 1)) % size for j in range(size)]) for n in names]
    while -1 in table:
        for i, wish in enumerate(wishes):
            slot = next((s for s in wish if table[s] < 0), None)
            if slot is not None and -1 in table:
                table[slot] = i
    return table


def test_placement(spark, rows):
    names = [f"n{i}" for i in range(7)]
    table = sharding.lookup_table(names, 101)
    assert table.tolist() == brute_table(names, 101)
    assert max(Counter(table.tolist()).values()) - min(Counter(table.tolist()).values()) <= 1
    big, fewer = sharding.lookup_table(names, 10007), sharding.lookup_table(names[:-1], 10007)
    stay = [(a, b) for a, b in zip(big.tolist(), fewer.tolist(), strict=True) if a != 6]
    assert sum(a != b for a, b in stay) < 0.1 * len(stay)
    weighted = Counter(sharding.lookup_table({"a": 3, "b": 1, "gone": 0}, 101).tolist())
    assert weighted[0] > 2.5 * weighted[1] and len(weighted) == 2
    for wrong in ([], names):
        with pytest.raises(ValueError):
            sharding.lookup_table(wrong, 100)
    docs = docs_of(spark, ODD).withColumnRenamed("fp", "shard")
    placed = sharding.place(docs, names, size=101)
    back = sharding.write_shards(placed, new_work_path(spark, "shards"))
    assert back.dtypes == placed.dtypes and rows(back) == rows(placed)
    assert sharding.write_shards(placed.limit(0), new_work_path(spark, "shards")).count() == 0
    assert placed.count() == docs.count() and placed.columns.count("shard") == 1
    assert placed.where("shard_name is null").count() == 0
    assert placed.where("doc_id = 0").select("shard").distinct().count() == 1
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan and "hashpartitioning" not in plan
    assert sharding.place(docs.limit(0), names, size=101).count() == 0


def test_cuts_are_the_cheapest():
    rng = np.random.default_rng(1)
    for _ in range(30):
        length = int(rng.choice([8, 12, 16]))
        places = np.unique(np.concatenate(([0], np.cumsum(rng.integers(1, 6, 12)))))
        costs = rng.integers(0, 4, len(places)).astype(float)

        def price(chosen, places=places, costs=costs, length=length):
            sizes = np.diff(places[chosen])
            pad = np.where((sizes & (sizes - 1)) == 0, 0, length - sizes)
            return float((pad + 1.5).sum() + costs[chosen[1:]].sum())

        best = {0: 0.0}
        for j in range(1, len(places)):
            best[j] = min(
                best[i] + price([i, j]) for i in range(j) if places[j] - places[i] <= length and i in best
            )
        assert price(packing.cuts(places, costs, length, 1.5)) == pytest.approx(best[len(places) - 1])


def test_packing_holds_every_id_once(spark):
    texts = [*ODD, "One two three. " * 900, "word " * 9000]
    docs = docs_of(spark, texts)
    pieces = packing.pack(docs, tokenizer("word_bpe_49k.json")).collect()
    library = Tokenizer.from_file(tokenizer("word_bpe_49k.json"))
    whole = {r.doc_id: np.append(library.encode(r.text or "", add_special_tokens=False).ids, 1).astype("<u4") for r in docs.collect() if r.doc_id is not None}
    of, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        of[p.doc_id].append(p)
        sequences[p.sequence_id].append(p)
    assert set(of) == set(whole)
    for i, ids in whole.items():
        assert sum(p.length for p in of[i]) == len(ids) * (2 if i == 0 else 1)
        for p in of[i]:
            assert p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes())
    total = padded = 0
    for held in sequences.values():
        at = 0
        for p in sorted(held, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048
        total, padded = total + at, padded + (0 if at & (at - 1) == 0 else 2048 - at)
    assert padded < 0.05 * total
    assert packing.pack(docs.limit(0), tokenizer("word_bpe_49k.json")).count() == 0
