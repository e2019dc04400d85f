"""What operators take of memory and time: bounds on a worker's batches, and faster steps that must give what slow ones gave."""

import os
import random
import subprocess
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from cargoloom.llm import suffix_dedup
from cargoloom.llm.pieces import PieceEncoder
from cargoloom.llm.queries import tokenizer

FIRST_PASS = """
import random, resource
import pyarrow as pa
from cargoloom.llm import alignment
from cargoloom.llm.queries import tokenizer

a, b = tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")
draw = random.Random(1)
words = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=draw.randint(4, 12))) for _ in range(400_000)]
texts = pa.array([" ".join(draw.choices(words, k=400)) for _ in range(7_000)], pa.string())
batch = pa.RecordBatch.from_arrays([pa.array(range(7_000), pa.int64()), texts], ["doc_id", "text"])
alignment._pair(a, b)
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
n = sum(x.num_rows for x in alignment._first_pass(a, b)(iter([batch])))
print(n, (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""


def test_a_worker_that_aligns_stays_small():
    # with 8 MB of texts in hand and ids of 64 bits, a worker took some 450 MB more than its tokenizers here.
    env = {**os.environ, "PYTHONPATH": str(Path(__file__).resolve().parents[2]), "MALLOC_ARENA_MAX": "1", "ARROW_DEFAULT_MEMORY_POOL": "system"}
    out = subprocess.run([sys.executable, "-c", FIRST_PASS], env=env, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) == 7_001
    assert int(out[1]) < 340


def test_stable_orders_of_any_numbers():
    draw = np.random.default_rng(2)
    for top, n in ((3, 0), (3, 1), (1, 9), (50, 20_000), (1 << 40, 20_000), (1 << 62, 20_000)):
        keys = draw.integers(0, top, n)
        keys[n // 2 :] = keys[: n - n // 2]
        order, ordered = suffix_dedup._in_order(keys)
        assert order.tolist() == np.argsort(keys, kind="stable").tolist()
        assert ordered.tolist() == sorted(keys.tolist())


def test_merging_sorts_no_places(monkeypatch):
    # half of the merge's time were argsorts; a number and its place are sorted as one.
    draw = random.Random(3)
    common = ["".join(draw.choices("ab ", k=130)).encode() for _ in range(20)]
    fragments = [draw.choice(common)[draw.randint(0, 30) :] + bytes(draw.choices(b"xyz", k=draw.randint(0, 40))) for _ in range(300)]
    doc, start = np.arange(300), np.zeros(300, np.int64)

    def refused(*args, **named):
        raise AssertionError("places were sorted")

    monkeypatch.setattr(np, "argsort", refused)
    merged = suffix_dedup.repeats(doc, start, fragments, 100, shard_bytes=4_000)
    monkeypatch.undo()
    seen, gone = set(), set()
    for i, f in enumerate(fragments):
        for at in range(len(f) - 99):
            if f[at : at + 100] in seen:
                gone |= {(i, x) for x in range(at, at + 100)}
            seen.add(f[at : at + 100])
    assert gone
    assert {(d, x) for d, a, b in zip(*map(np.ndarray.tolist, merged), strict=True) for x in range(a, b)} == gone


def counted(monkeypatch, most):
    """An encoder of words, and what it gives to the whole library."""
    code, asked, whole = PieceEncoder(tokenizer("word_bpe_49k.json"), "word", most=most), [], PieceEncoder.whole
    monkeypatch.setattr(PieceEncoder, "whole", lambda self, text: (asked.append(text), whole(self, text))[1])
    return code, asked


def of_library(texts):
    library = Tokenizer.from_file(tokenizer("word_bpe_49k.json"))
    return [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_words_with_signs_are_cut_like_the_library_does(monkeypatch):
    # each new piece such as "word###" went through the whole library.
    draw = random.Random(4)
    words = ["".join(draw.choices("abcdeéß", k=draw.randint(1, 9))) for _ in range(300)]
    texts = [w + sign for w in words for sign in ("###", "!!", "_", "$1", "42")] + ["it's we'll a'b!", "x<|y", "A<|endoftext|>b"]
    code, asked = counted(monkeypatch, 1 << 20)
    assert [x.tolist() for x in code.encode(pa.array(texts))] == of_library(texts)
    assert len(asked) < 20


def test_pieces_outlive_a_full_memory(monkeypatch):
    # a full memory was emptied, and frequent pieces were encoded again.
    code, asked = counted(monkeypatch, 100_000)
    often = ["it's", "we'll", "don't!"]
    draw, texts = random.Random(5), []
    for _ in range(12):
        batch = [*often, *("".join(draw.choices("abcdefgh", k=9)) for _ in range(100))]
        texts += batch
        assert [x.tolist() for x in code.encode(pa.array(batch))] == of_library(batch)
    assert len(code) + len(code.older) < len(set(texts))
    assert sorted(asked) == sorted(often)
