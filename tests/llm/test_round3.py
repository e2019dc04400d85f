"""Alignment, languages and dialogue repair against plain brute force on small tables."""

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from cargoloom.llm import alignment, dialogue, languages
from cargoloom.llm.pieces import byte_letters
from cargoloom.llm.queries import tokenizer

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
TURNS = "conv_id long, turn long, role string, text string, kind int, part string, cost int"


# --- dialogue ----------------------------------------------------------------------


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        shown = [" " if x is None else str(x) for x in (conv, turn)]
        role, text = (" " if x is None else x for x in (role, text))
        fate = zlib.crc32(":".join(shown).encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(conv, turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return out


def cheapest(rows, faults):
    """The least (cost, audit) by a search over all edits, and what they leave. States: rows read, roles written (folded)."""

    def after(state, initial):
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("p", "u"): "u", ("u", "a"): "p"}.get((state, initial))

    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, kept = heapq.heappop(heap)
        if i == len(rows) and state in ("", "p"):
            return cost, audit, kept
        if (i, state) in done:
            continue
        done.add((i, state))
        for name in ("user", "assistant"):
            if after(state, name[0]):
                heapq.heappush(heap, (cost + 5, audit + "I", i, after(state, name[0]), (*kept, f"{name}:")))
        if i < len(rows):
            role, text = rows[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, state, kept))
            if faults[i] not in ("blank", "duplicate"):
                more = 5 * (faults[i] == "truncated")
                if after(state, role[:1]):
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, after(state, role[:1]), (*kept, f"{role}:{text}")))
                for name in ("user", "assistant"):
                    if after(state, name[0]):
                        heapq.heappush(heap, (cost + 1 + more, audit + "R", i + 1, after(state, name[0]), (*kept, f"{name}:{text}")))
    raise AssertionError


def brute_repair(ids, rows):
    out = {}
    for conv in ids:
        own = [r for r in rows if r[0] == conv]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0))
        seen, faults = set(), []
        for _, _, role, text in own:
            body = text.strip(" \t\n\x0b\f\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
        turns = [r[1] for r in own if r[1] is not None]
        cost, audit, kept = cheapest([r[2:] for r in own], faults)
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(own, own[1:], strict=False)]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(x) for x in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs),
            cost,
            audit,
            hashlib.sha256("\n".join(kept).encode()).hexdigest(),
        )
    return out


def conversations(n, longest, seed):
    draw, rows = random.Random(seed), []
    for conv in [*range(n), None]:
        for turn in range(draw.randint(1, longest)):
            role = draw.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None])
            text = draw.choice(["One.", "Two!", "no end", "", " \n", None, "é?  ", f"{draw.random()}.", "One."])
            rows.append((conv, draw.choice([turn * 2, turn * 2, None]) if draw.random() < 0.2 else turn * 2, role, text))
    # Rows of one turn have an order of their own here, so the brute force gets distinct turns, or equal rows, only.
    once = {}
    for r in rows:
        once.setdefault(r[:2], r)
    return list(once.values()) + list(once.values())[:3]


def results(df):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r[c] for c in names) for r in rows}


def test_repair_is_the_cheapest(spark):
    rows = conversations(60, 12, 1)
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], TURNS).repartition(5)
    found = results(dialogue.repair(dialogue.damaged(df)))
    assert found == brute_repair({r[0] for r in rows}, brute_damage(rows))
    assert dialogue.repair(dialogue.damaged(df.limit(0))).count() == 0


def test_a_conversation_in_many_chunks(spark, monkeypatch):
    """One conversation holds most rows; chunks of a few rows are put together to the same result."""
    monkeypatch.setattr(dialogue, "CHUNK_ROWS", 7)
    rows = conversations(5, 10, 2)
    draw = random.Random(3)
    rows += [(77, t, draw.choice(["user", "assistant", "system"]), draw.choice(["a.", "b", "", f"{t}."])) for t in range(400)]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], TURNS)
    found = results(dialogue.repair(dialogue.damaged(df)))
    assert found == brute_repair({r[0] for r in rows}, brute_damage(rows))
    assert set("DKR") <= set(found[77][6])


def test_repair_of_undamaged_rows(spark):
    rows = [(1, 0, "system", "Be good."), (1, 1, "user", "Hi."), (2, 0, "user", "Hi."), (3, None, None, None), (4, 5, "user", "x.")]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], TURNS)
    found = {k: v[-3:-1] for k, v in results(dialogue.repair(df)).items()}
    assert found == {1: (2, "RR"), 2: (2, "D"), 3: (2, "D"), 4: (2, "D")}


# --- languages ---------------------------------------------------------------------


def brute_phrases(sample, text):
    """Phrases of a text of symbols, cut greedily at the longest match with a sample, lane by lane."""
    n = 0
    for lane in range(0, len(text), languages.LANE):
        at, part = 0, text[lane : lane + languages.LANE]
        while at < len(part):
            size = 1
            while at + size < len(part) and part[at : at + size + 1] in sample:
                size += 1
            at, n = at + size, n + 1
    return n


def test_phrases_are_longest_matches():
    draw = random.Random(5)
    samples = {"x": ["".join(draw.choices("abc ", k=300)) for _ in range(3)], "y": ["".join(draw.choices("abd é", k=200))]}
    model = languages.model_of(samples)
    alphabet = languages.Alphabet(model.frequent)
    texts = ["".join(draw.choices("abcdé z日", k=draw.choice([0, 1, 5, 700, 2000]))) for _ in range(40)]
    symbols = [alphabet.symbols(t) for t in texts]
    found = languages.phrases(model, alphabet, symbols)
    for i, name in enumerate(model.names):
        sample = bytes(np.concatenate([alphabet.symbols(t + " ") for t in samples[name]]))
        assert found[:, i].tolist() == [brute_phrases(sample, bytes(s)) for s in symbols]


def test_automaton_has_all_substrings_and_no_other():
    text = [1, 2, 1, 1, 3, 2, 1, 2, 1, 3]
    moves = languages.suffix_automaton(text)
    assert len(moves) <= 2 * len(text)

    def known(word):
        state = 0
        for s in word:
            state = moves[state].get(s)
            if state is None:
                return False
        return True

    words = {tuple(text[a:b]) for a in range(len(text)) for b in range(a + 1, len(text) + 1)}
    assert all(known(w) for w in words)
    assert not any(known(w + (s,)) for w in words for s in (1, 2, 3) if w + (s,) not in words)


SHAPE = "doc_id long, text string, lang string, source string, n_chars long, h long, place int"


def test_languages_predicted(spark):
    draw = random.Random(7)
    words = {k: ["".join(draw.choices(a, k=draw.randint(2, 8))) for _ in range(80)] for k, a in {"p": "abcdef", "q": "abcxyz", "r": "дежз"}.items()}
    rows = [(i, " ".join(draw.choices(words[lang], k=draw.randint(20, 200))), lang) for i in range(300) for lang in ["pqr"[i % 3]]]
    rows += [(900, None, "p"), (901, "", "p"), (902, " 12 ..", None), (903, "abc", None), (904, "́", "q"), (None, "abc", "p"), rows[0]]
    rows += [(905, " ".join(draw.choices(words["q"], k=60_000)), None)]
    docs = spark.createDataFrame([(*r, "s", 1, 2, 3) for r in rows], SHAPE)
    model = languages.fit(docs, symbols=1 << 15)
    assert model.names == ["p", "q", "r"]
    found = languages.predict(docs, model).collect()
    assert len(found) == len(rows) - 1
    held = {i: zlib.crc32(str(i).encode()) % 5 == 0 for i, *_ in rows}
    assert all(r.held_out == held[r.doc_id] and 0 <= r.score <= 1 for r in found)
    truth = {i: lang for i, _, lang in rows}
    assert all(r.lang_pred == truth[r.doc_id] for r in found if r.doc_id < 300)
    by_id = {r.doc_id: r for r in found}
    assert {by_id[i].lang_pred for i in (900, 901, 902, 904)} == {"und"} and by_id[900].score == 0
    assert by_id[905].lang_pred == "q"
    # Held-out labels teach nothing, and neither source nor lang of a document counts for its prediction.
    wrong = spark.createDataFrame([(i, t, ("z" if held[i] else lang), str(i), 1, 2, 3) for i, t, lang in rows if i is not None], SHAPE)
    again = {r.doc_id: (r.lang_pred, r.score) for r in languages.predict(wrong.drop("lang", "source"), languages.fit(wrong, symbols=1 << 15)).collect()}
    assert again == {r.doc_id: (r.lang_pred, r.score) for r in found}
    nothing = languages.fit(docs.limit(0))
    assert {r.lang_pred for r in languages.predict(docs, nothing).collect()} == {"und"}
    assert languages.predict(docs.limit(0), model).count() == 0
    with pytest.raises(ValueError):
        languages.fit(docs, symbols=1024)


def test_the_sample_is_the_least_stretches(spark):
    import xxhash

    docs = spark.createDataFrame([(1, "ab" * 50, "x"), (2, "ab" * 50, "x"), (3, "".join(chr(97 + i % 26) for i in range(95)), "x")], "doc_id long, text string, lang string")
    assert zlib.crc32(b"1") % 5 and zlib.crc32(b"2") % 5
    model = languages.fit(docs, symbols=60, stretch=20)
    texts = [t for i, t, _ in docs.collect() if zlib.crc32(str(i).encode()) % 5]
    pieces = sorted({t[k : k + 20] for t in texts for k in range(0, len(t), 20)}, key=lambda p: xxhash.xxh64_intdigest(p) >> 1)[:3]
    assert (model.table == languages.model_of({"x": pieces}).table).all()


# --- alignment ---------------------------------------------------------------------

TEXTS = ["Hello, world. This is fine.", "  two  blanks ", "a\nb\n\n c\n", "日本語 ok é ﬁ İ.", "a▁b", "<|endoftext|> and </s><0x41>",
         "tab\there\x01 x", "3.14,5 don't", "", None, "x" * 3000, "end ", "\n", " ", "Hello, world. This is fine.", "ab cd " * 4000]


def brute_alignment(texts):
    a = Tokenizer.from_file(tokenizer(A))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=tokenizer(B))
    back = {v: k for k, v in byte_letters().items()}

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    rows, pairs = [], Counter()
    for text in texts:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [bytes(back[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [piece(i) for i in ids_b]
        if b"".join(bytes_a) != (" " + (text or "")).encode() or b"".join(bytes_b) != (" " + (text or "")).encode():
            rows.append(([], [], []))
            continue
        ends_a, ends_b = (np.cumsum([len(x) for x in t]).tolist() for t in (bytes_a, bytes_b))
        where_a = {e: i for i, e in enumerate(ends_a)}
        groups, i, j = [], 0, 0
        for k, e in enumerate(ends_b):
            if e in where_a:
                groups.append((ids_a[i : where_a[e] + 1], ids_b[j : k + 1]))
                i, j = where_a[e] + 1, k + 1
        pairs.update((g[0][-1], g[1][-1]) for g in groups)
        rows.append((ids_a, ids_b, groups))
    best = Counter()
    for (_, y), n in pairs.items():
        best[y] = max(best[y], n)
    out = []
    for ids_a, ids_b, groups in rows:
        links = [(g[0][-1], g[1][-1]) for g in groups]
        line = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        digest = hashlib.sha256(line.encode()).hexdigest() if ids_a else ""
        out.append((len(ids_a), len(ids_b), len(groups), len(links), sum(pairs[p] == best[p[1]] for p in links), sum(pairs[p] for p in links), digest))
    return out


def test_alignment(spark):
    docs = spark.createDataFrame(
        [(i, t, "en", "s", 1, 2, 3) for i, t in enumerate(TEXTS)] + [(None, "lost", None, None, None, None, None)],
        "doc_id long, text string, lang string, a string, b long, pairs long, node int",
    ).repartition(40, "doc_id")
    found = sorted(alignment.align(docs, tokenizer(A), tokenizer(B)).collect(), key=lambda r: r.doc_id)
    assert [tuple(r)[1:] for r in found] == brute_alignment(TEXTS)
    assert found[4].n_a == 0 and found[5].n_a > 5 and found[8].groups_sha256 == ""
    assert alignment.align(docs.limit(0), tokenizer(A), tokenizer(B)).count() == 0


ODD = ["a", "the", "Word", "İ", " ", " ", " ", "  ", "\n", "\t", ".", ",", "'s", "12", "²", "日本", "ﬁ", "<|endoftext|>", "</s>", "\u0301", "\u00a0",
       "\u3000", "▁", "\x01", "\x1c", "\x85", "K", "\r"]


def test_tokens_are_the_libraries():
    draw = random.Random(11)
    texts = [t or "" for t in TEXTS] + ["".join(draw.choices(ODD, k=draw.randint(0, 12))) for _ in range(20_000)]
    pair = alignment.Pair(tokenizer(A), tokenizer(B))
    assert pair.cuts
    (a, a_n), (b, b_n) = pair.tokens(pa.array(texts, pa.string()))
    library = Tokenizer.from_file(tokenizer(A))
    library.encode_special_tokens = True
    of_a = [e.ids for e in library.encode_batch([" " + t for t in texts], add_special_tokens=False)]
    of_b = pair.b.encode(texts)
    for i, (text, x, y) in enumerate(zip(texts, of_a, of_b, strict=True)):
        if not text or "▁" in text:
            assert a_n[i] == b_n[i] == 0, text
            of_a[i], of_b[i] = [], []
        else:
            assert (a_n[i], b_n[i]) == (len(x), len(y)), text
    assert a.tolist() == [x for ids in of_a for x in ids]
    assert b.tolist() == [x for ids in of_b for x in ids]


def test_perfect_hash_numbers_every_key_once():
    keys = np.random.default_rng(1).integers(0, 1 << 48, 20_000)
    perfect = alignment.PerfectHash.of(np.concatenate((keys, keys[:100])))
    known = np.unique(keys)
    assert sorted(perfect.numbers(known).tolist()) == list(range(len(known)))
    assert (perfect.keys[perfect.numbers(known)] == known).all()
    assert (perfect.numbers(np.arange(1000) + (1 << 50)) == -1).all()
    assert alignment.PerfectHash.of(np.zeros(0)).numbers(known[:3]).tolist() == [-1, -1, -1]


def test_pairs_that_end_together_are_suffixes():
    a, b = [b"a", b"ba", b"cba"], [b"ba", b"a", b"xa"]
    ends = {(x, y) for x in a for y in b if x.endswith(y) or y.endswith(x)}
    assert len(ends) <= alignment.most_pairs(a, b) <= sum(map(len, a + b))


def test_tree_sums(spark):
    rows = [(n, s, np.array([n, s, 1], "<i8").tobytes()) for n in range(300) for s in range(2)]
    found = alignment.summed_tree(spark.createDataFrame(rows, "node int, slice int, v binary")).collect()
    total = {r["slice"]: np.frombuffer(r["v"], "<i8").tolist() for r in found}
    assert total == {s: [sum(range(300)), 300 * s, 300] for s in range(2)}
