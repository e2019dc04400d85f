"""SimHash groups, repeated passages, syncmers: against brute force."""

import hashlib
import random
import struct

import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from cargoloom.llm import simhash, suffix_dedup, syncmers
from llm.test_texts import docs_of


def print_of(text):
    words = text.encode().lower().split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_of(numbers, distance):
    root = list(range(len(numbers)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(numbers)):
        for j in range(i):
            if bin(numbers[i] ^ numbers[j]).count("1") <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(numbers))]


def near_texts():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 300))) for _ in range(40)]
    texts += [t + " tail" for t in texts[:15]] + [t.upper() for t in texts[15:20]] + ["", " \n", "One", "one", "ÄB cd", "äb cd"]
    return texts


def test_simhash_groups(spark):
    docs = docs_of(spark, near_texts())
    got = simhash.near_duplicates(docs).collect()
    kept = [(r.doc_id, r.text or "") for r in docs.collect() if r.doc_id is not None]
    ids = sorted({i for i, _ in kept})
    text = dict(kept)
    numbers = [print_of(text[i]) for i in ids]
    root = groups_of(numbers, 4)
    expected = {i: (f"{n:016x}", ids[r]) for i, n, r in zip(ids, numbers, root, strict=True)}
    assert len(got) == len(kept)
    assert all((r.fingerprint, r.component_id) == expected[r.doc_id] for r in got)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize(("distance", "per_task"), [(4, 200_000), (4, 20), (3, 15), (0, 50), (7, 40)])
def test_trie_join_finds_every_group(spark, distance, per_task):
    """Dense balls of fingerprints, with node pairs divided into their children where tasks may hold few rows."""
    rng = random.Random(distance)
    numbers = [rng.getrandbits(64) for _ in range(40)]
    for n in list(numbers[:6]):
        numbers += [n ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3))) for _ in range(8)]
    numbers = sorted(set(numbers) | {0, 1, (1 << 64) - 1, 1 << 63})
    signed = [n - (1 << 64) if n >> 63 else n for n in numbers]
    links = simhash.trie_links(spark.createDataFrame([(s,) for s in signed], "fp long"), distance, 4, per_task)
    for r in links.collect():
        assert bin((r.a ^ r.b) & ((1 << 64) - 1)).count("1") <= distance
    least = {r.node: r.least for r in simhash.components(links).collect()}
    root, mine = groups_of(numbers, distance), {}
    for s, r in zip(signed, root, strict=True):
        mine.setdefault(r, set()).add(least.get(s, s))
    assert all(len(v) == 1 for v in mine.values()) and len({next(iter(v)) for v in mine.values()}) == len(mine)


def test_components_of_a_long_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 101)], "a long, b long")
    found = {r.node: r.least for r in simhash.components(chain).collect()}
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_one_document_of_each_group_stays(spark):
    docs = docs_of(spark, near_texts())
    kept = simhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.where("doc_id is null").count() == 1
    ids = sorted(r.doc_id for r in kept.where("doc_id is not null").collect())
    firsts = {r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert ids == sorted(firsts)


def brute_repeats(docs, length=100):
    seen, out = set(), {}
    for i in sorted(docs):
        raw = docs[i].encode()
        marked = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            if raw[s : s + length] in seen:
                marked[s : s + length] = b"\1" * length
            seen.add(raw[s : s + length])
        kept = bytes(c for c, m in zip(raw, marked, strict=True) if not m)
        spans = sum(1 for k, m in enumerate(marked) if m and not (k and marked[k - 1]))
        out[i] = (len(raw), sum(marked), spans, hashlib.sha256(kept).hexdigest())
    return out


def repeat_texts():
    rng = random.Random(9)
    letters = "abcde é\n"
    passages = ["".join(rng.choices(letters, k=k)) for k in (90, 100, 101, 130, 260, 500)]
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(1, 5)):
            parts.append(rng.choice(passages) if rng.random() < 0.5 else "".join(rng.choices(letters, k=rng.randint(0, 150))))
        texts.append("".join(parts))
    return [*texts, texts[3], texts[3], "a" * 350, "Are, " * 120, "Are, " * 90, "", "short", "x" * 100, "x" * 99]


@pytest.mark.parametrize(
    "options", [{}, {"most_bytes": 300, "run_bytes": 2000, "shard_bytes": 500}, {"most_bytes": 1000, "run_bytes": 1, "shard_bytes": 64}]
)
def test_repeats_are_those_of_brute_force(spark, options):
    texts = repeat_texts()
    docs = docs_of(spark, texts)
    expected = brute_repeats({**dict(enumerate(texts)), 900: ""})
    got = suffix_dedup.remove_repeats(docs, **options).collect()
    assert len(got) == len(texts) + 2  # the null text and the repeated row have theirs
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == expected[r.doc_id]
        assert hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_merged_order_is_that_of_sorted_rings():
    rng = random.Random(2)
    rings = ["".join(rng.choices("ab", k=rng.randint(1, 60))).encode() for _ in range(40)]
    made, order, block, prefix = suffix_dedup.merged_blocks(rings, 20, 100)
    whole = [[*(c + 1 for c in f), 0] for f in rings]

    def head(place):
        ring, at = made.ring[place], made.offset[place]
        turned = whole[ring][at:] + whole[ring][:at]
        return tuple((turned * 25)[:20])

    heads = [head(p) for p in order]
    assert heads == sorted(heads)
    for i in range(1, len(heads)):
        same = heads[i] == heads[i - 1]
        common = next((k for k in range(20) if heads[i][k] != heads[i - 1][k]), 20)
        assert (block[i] == block[i - 1]) == same and prefix[i] == common // 10 * 10


def test_texts_without_repeats(spark):
    texts = repeat_texts()
    docs = docs_of(spark, texts).drop("start").withColumn("n_chars", F.length("text").cast("long"))
    left = suffix_dedup.without_repeats(docs)
    assert left.columns == docs.columns and left.schema == docs.schema
    rows = {r.doc_id: r for r in left.collect()}
    assert rows[None].text == "no id" and 61 not in rows and 64 not in rows and rows[65].text == ""
    assert all(r.n_chars == len(r.text) for r in rows.values() if r.text is not None)


def test_rows_of_one_id_and_length_keep_their_own_text(spark):
    rng = random.Random(8)
    first, second, other = ("".join(rng.choices("abcdefgh ", k=400)).strip().ljust(400, "z") for _ in range(3))
    texts = [(1, first), (2, first[:200] + second[:200]), (2, second[200:] + other[200:]), (2, second[200:] + other[200:])]
    left = suffix_dedup.without_repeats(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert sorted(map(tuple, left)) == sorted([(1, first), (2, second[:200]), *[(2, second[200:] + other[200:])] * 2])


def test_repeated_ids_of_any_size(spark):
    """Ids near both ends of the range, some repeated, come back as they are, and their texts are judged in id order."""
    same = "".join(random.Random(4).choices("abcdefgh ", k=300))
    rows = [(2**60 + 1, same), (2**60 + 1, "x" * 60 + same[:150]), (2**60 + 1, same), (2**60 + 3, same[:120]), (2**63 - 10, same), (-(2**63), "short"), (2**63 - 10, "")]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_bytes) for r in got) == sorted((i, len(t)) for i, t in rows)
    for r in got:
        if r.doc_id in (2**60 + 3, 2**63 - 10):
            assert r.n_removed == r.n_bytes
        elif r.doc_id < 0:
            assert r.n_removed == 0
    # Of the two texts of one id that share 150 bytes, the one of lesser hash keeps them.
    assert sorted({r.n_removed for r in got if r.doc_id == 2**60 + 1}) in ([0, 150],)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def spark_hash(*values):
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else struct.pack("<q", v), seed)
    return signed(seed)


def words_of(text):
    words = []
    for stretch in regex.split(r"[ \t-\r\x85\p{Z}]+", text):
        words += [stretch[: syncmers.LONG_WORD], *stretch[syncmers.LONG_WORD :]]
    return words


ALWAYS = -(1 << 63) + (1 << 63) // syncmers.SPARSE


def sketch_of(text):
    words = words_of(text)
    pairs = [spark_hash(a, b) for a, b in zip(words, words[1:], strict=False)]
    found = [(spark_hash(text), 0)] if len(words) < 2 else []
    for i in range(len(pairs) - 6):
        if min(pairs[i : i + 7]) in (pairs[i], pairs[i + 6]):
            found.append((spark_hash(*pairs[i : i + 7 : 2]) | (-1 << 63), i))
    if len(words) > 1 and len(found) < syncmers.SIZE:
        found += [(h & ((1 << 63) - 1), i) for i, h in enumerate(pairs)]
    first = {}
    for h, i in sorted((h >> 24, i) for h, i in found):
        first.setdefault(h, i)
    return [(h, i) for k, (h, i) in enumerate(sorted(first.items())) if k < syncmers.SIZE or (h << 24 | i) < ALWAYS]


def alike(a, b):
    a, b = dict(a), dict(b)
    union = sorted(set(a) | set(b))
    least = union[: syncmers.SIZE][-1]
    comparable = [h for h in union if h <= least or h < ALWAYS >> 24]
    moves = [b[h] - a[h] for h in comparable if h in a and h in b]
    still = sum(abs(d) <= syncmers.SHIFT for d in moves)
    together = max((sum(0 <= e - d <= syncmers.SHIFT for e in moves) for d in moves), default=0)
    return max(still, together if together >= syncmers.TOGETHER else 0) / len(comparable)


def odd_spaces():
    """Lists, texts with all kinds of white space, texts without any, some with the other kind beside them; long ones."""
    rng = random.Random(5)
    lines = ["\n".join(f"item{rng.randrange(900)}" for _ in range(400)) for _ in range(4)]
    mixed = ["".join(f"w{rng.randrange(900)}" + rng.choice([" ", "\t", "\u00a0", "\u3000", " \r\n ", "\x85", "  "]) for _ in range(90)) for _ in range(4)]
    unspaced = ["".join(chr(0x4E00 + rng.randrange(800)) for _ in range(n)) for n in (5, 21, 90, 900)]
    beyond = ["".join(chr(0x20000 + rng.randrange(800)) for _ in range(300)) + " and words"]
    long = [" ".join(f"v{rng.randrange(5000)}" for _ in range(3000)) for _ in range(2)]
    return [*lines, *mixed, *unspaced, *beyond, *long, " ".join(["head"] * 60) + " " + long[0]]


@pytest.mark.parametrize("kind", [near_texts, odd_spaces])
def test_syncmers(spark, kind):
    texts = kind()
    docs = docs_of(spark, texts)
    rows = syncmers.fingerprints(docs).collect()
    text = {**dict(enumerate(texts)), 900: ""}
    ids = sorted(text, reverse=True)
    after = {i: ids[(k + 1) % len(ids)] for k, i in enumerate(ids)}
    assert len(rows) == len(texts) + 2
    for r in rows:
        own, following = text[r.doc_id], text[after[r.doc_id]]
        third = len(own) // 3
        edited = own[: len(own) - third] + following[:third]
        assert r.n_chars == len(own) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == ",".join(str((h << 24) | i) for h, i in sketch_of(own))
        assert r.near_edited == pytest.approx(alike(sketch_of(own), sketch_of(edited)))
        assert r.near_next == pytest.approx(alike(sketch_of(own), sketch_of(following)))
    # Two thirds stay, so half of all anchors are common; 32 of them tell it to within a tenth.
    long = [r.near_edited for r in rows if kind is odd_spaces and len(text[r.doc_id]) > 60]
    assert not long or (sum(long) / len(long) > 0.4 and min(long) > 0.25)
    assert syncmers.fingerprints(docs.limit(0)).count() == 0


def test_syncmers_find_moved_and_long_texts(spark):
    rng = random.Random(11)

    def prose(n):
        return [f"v{rng.randrange(5000)}" for _ in range(n)]

    body, passage, alone, far, long = prose(400), prose(400), prose(20000), prose(15000), prose(20000)
    pairs = [
        (" ".join(body), " ".join(prose(60) + body)),  # behind a header
        (" ".join(body), " ".join(body[:50] + prose(100) + body[50:])),  # an insertion near the start
        (" ".join(alone[:9000] + passage + alone[9000:]), " ".join(far[:2000] + passage + far[2000:])),
        (" ".join(alone), " ".join(far)),
        (" ".join(long), " ".join(long)),
        (" ".join(prose(30)), " ".join(prose(30))),
    ]
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    prints = frame.select("i", syncmers.sketch(F.col("a")).alias("a"), syncmers.sketch(F.col("b")).alias("b"))
    rows = prints.select("*", syncmers.likeness(F.col("a"), F.col("b")).alias("alike")).orderBy("i").collect()
    header, inserted, shared, apart, same, short = (r.alike for r in rows)
    assert header > 0.7 and inserted > 0.5 and same == 1 and apart == 0 and short == 0
    assert 5 <= round(shared * len(set(rows[2].a) | set(rows[2].b))) <= 40
    assert len(rows[3].a) > 300 and len(rows[5].a) <= syncmers.SIZE


def test_syncmers_run_no_python(spark):
    plan = syncmers.fingerprints(docs_of(spark, ["a b c"]))._jdf.queryExecution().toString()
    assert not any(step in plan for step in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))
