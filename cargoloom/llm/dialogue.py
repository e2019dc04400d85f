"""Conversations whose roles break the rules of turn taking, repaired at least cost by a generalised LR parse.

**Grammar.** ``dialogue -> opening pairs | empty``, ``opening -> s | empty``, ``pairs -> pair | pairs pair``, ``pair -> u a``, over the
initials of roles. A stack ends in one of four tops: nothing read, ``s`` shifted, ``u`` shifted (inside a pair), or pairs
reduced. Shifting ``a`` inside a pair reduces ``pair`` and then ``pairs`` at once, whatever lay below, so the top tells all that later rows need.

**Parse.** Each row may be kept, given the role user or assistant, or deleted, and empty rows may be inserted before it. All parses advance
together on a graph-structured stack: per row one node for each top, with a link to the node it came from. Paths that reach equal
tops merge; the one of least ``(cost, audit)`` stays, where the audit is the edits' initials. Two audits over the same rows are never
prefixes of each other (inserts stand before a row's edit), so their order is settled once and kept as a rank. A step depends on
the costs relative to the least, the ranks and the kind of row alone; every step met is remembered, and a row costs one look-up.
Tops that cost over ``HOPELESS`` more than the cheapest can't win any more: any other top can take over their rest for less.

**Spark.** Rows are sorted over the cluster by conversation and turn. A task parses its conversations as they stream by. One that may go on in another
task, or is longer than ``CHUNK_ROWS``, is cut in chunks; each is parsed from every top, which gives a four by four table
of costs and audit ranks. One pass along a conversation's tables picks the tops at the cuts, and the chunks are edited by them.
So no task holds a conversation, only chunks, and five numbers for each chunk of one. SHA-256 is sequential: the edited
chunks of one conversation stream through one hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargoloom.llm.common import saved, sliced

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
START, SYSTEM, INSIDE, PAIRS = range(4)
_OTHER, _S, _U, _A = range(4)
SHIFT = {(START, _S): SYSTEM, (START, _U): INSIDE, (SYSTEM, _U): INSIDE, (PAIRS, _U): INSIDE, (INSIDE, _A): PAIRS}
ACCEPTED = (START, PAIRS)
_FINE, _BLANK, _REPEATED, _CUT_OFF = range(4)
#: The role an inserted or reroled row takes under each top.
_ROLE = {START: _U, SYSTEM: _U, PAIRS: _U, INSIDE: _A}
_NAMES = {_U: b"user", _A: b"assistant"}
HOPELESS = 20
CHUNK_ROWS, CHUNK_BYTES = 4096, 4 << 20
_SPACE = " \t\n\x0b\f\r"


def _inserted(top: int, n: int) -> int:
    for _ in range(n):
        top = SHIFT[top, _ROLE[top]]
    return top


def _moves(kind: int) -> list[tuple[int, int, int, str]]:
    """What a row of a kind (four times the initial, plus the fault) allows: from top, to top, cost, letters."""
    initial, fault = divmod(kind, 4)
    found: dict[tuple[int, int], tuple[int, str]] = {}
    for top in range(4):
        for n in range(3):  # after two inserts the top is one of those before
            here, price, letters = _inserted(top, n), n * INSERT, "I" * n
            edits = [(here, DELETE, "D")]
            if fault in (_FINE, _CUT_OFF):
                extra = TRUNCATED if fault == _CUT_OFF else 0
                if (here, initial) in SHIFT:
                    edits.append((SHIFT[here, initial], KEEP + extra, "K"))
                edits.append((SHIFT[here, _ROLE[here]], REROLE + extra, "R"))
            for to, cost, letter in edits:
                move = (price + cost, letters + letter)
                found[top, to] = min(found.get((top, to), move), move)
    return [(a, b, c, x) for (a, b), (c, x) in found.items()]


class Parser:
    """Remembered steps of the stack: ``(stack, kind)`` gives the next stack, the rise of the least cost, and the links."""

    def __init__(self):
        self.moves = {kind: _moves(kind) for kind in range(16)}
        self.stacks: list[tuple] = []
        self.numbers: dict[tuple, int] = {}
        self.steps: dict[tuple[int, int], tuple[int, int, tuple]] = {}
        self.starts = [self._number(tuple((0, 0) if t == top else None for t in range(4))) for top in range(4)]

    def _number(self, stack: tuple) -> int:
        if stack not in self.numbers:
            self.numbers[stack] = len(self.stacks)
            self.stacks.append(stack)
        return self.numbers[stack]

    def step(self, stack: int, kind: int) -> tuple[int, int, tuple]:
        tops, best = self.stacks[stack], {}
        for a, b, cost, letters in self.moves[kind]:
            if tops[a] is not None:
                path = (tops[a][0] + cost, tops[a][1], letters, a)
                best[b] = min(best.get(b, path), path)
        least = min(p[0] for p in best.values())
        best = {b: p for b, p in best.items() if p[0] - least <= HOPELESS}
        order = sorted(best, key=lambda b: best[b][1:3])
        nodes = tuple((best[t][0] - least, order.index(t)) if t in best else None for t in range(4))
        links = tuple((best[t][3], best[t][2]) if t in best else None for t in range(4))
        self.steps[stack, kind] = found = (self._number(nodes), least, links)
        return found

    def parse(self, kinds: list[int], start: int) -> tuple[dict[int, tuple[int, int]], list[tuple]]:
        """Cost and audit rank of each top after the rows, and the links of every row."""
        stack, total, links, steps = self.starts[start], 0, [], self.steps
        for kind in kinds:
            stack, rise, back = steps.get((stack, kind)) or self.step(stack, kind)
            total += rise
            links.append(back)
        return {t: (total + n[0], n[1]) for t, n in enumerate(self.stacks[stack]) if n is not None}, links


def letters_to(links: list[tuple], top: int) -> list[str]:
    """The letters of every row on the path to a top."""
    out = []
    for back in reversed(links):
        top, letters = back[top]
        out.append(letters)
    return out[::-1]


_LAST = {START: (0, ""), PAIRS: (0, ""), INSIDE: (INSERT, "I"), SYSTEM: (2 * INSERT, "II")}


def finish(ends: dict[int, tuple[int, int]]) -> tuple[int, int, str]:
    """The best top at the end of a conversation, its cost with the last inserts, and their letters."""
    top = min(ends, key=lambda t: (ends[t][0] + _LAST[t][0], ends[t][1]))
    return top, ends[top][0] + _LAST[top][0], _LAST[top][1]


def edited(letters: list[str], top: int, initials: list[int], roles: list[bytes], texts: list[bytes]) -> tuple[list[bytes], int]:
    """The rows that the letters leave, as ``role:text``, and the top behind them. Letters beyond the rows are inserts."""
    out = []
    for i, word in enumerate(letters):
        for letter in word:
            if letter == "I":
                out.append(_NAMES[_ROLE[top]] + b":")
                top = SHIFT[top, _ROLE[top]]
            elif letter == "K":
                out.append(roles[i] + b":" + texts[i])
                top = SHIFT[top, initials[i]]
            elif letter == "R":
                out.append(_NAMES[_ROLE[top]] + b":" + texts[i])
                top = SHIFT[top, _ROLE[top]]
    return out, top


_LEGAL = {(_S, _U), (_U, _A), (_A, _U)}
_COUNTS = ("n_rows", "blank", "duplicate", "truncated", "illegal", "min_turn", "max_turn", "turns", "first_initial", "last_initial")


def _counts(kinds: list[int], turns: list[int | None]) -> list[int | None]:
    numbered = [t for t in turns if t is not None]
    initials = [k >> 2 for k in kinds]
    faults = [k & 3 for k in kinds]
    return [
        len(kinds),
        faults.count(_BLANK),
        faults.count(_REPEATED),
        faults.count(_CUT_OFF),
        sum(pair not in _LEGAL for pair in zip(initials, initials[1:], strict=False)),
        numbered[0] if numbered else None,
        numbered[-1] if numbered else None,
        1 + sum(a != b for a, b in zip(numbered, numbered[1:], strict=False)) if numbered else 0,
        initials[0] if initials else None,
        initials[-1] if initials else None,
    ]


def _joined(a: list, b: list) -> list:
    """The counts of two stretches of one conversation, one behind the other."""
    if not a[0] or not b[0]:
        return b if not a[0] else a
    out = [x + y for x, y in zip(a[:5], b[:5], strict=True)]
    out[4] += (a[9], b[8]) not in _LEGAL
    turns = a[7] + b[7] - (a[6] is not None and a[6] == b[5])
    return [*out, b[5] if a[5] is None else a[5], a[6] if b[6] is None else b[6], turns, a[8], b[9]]


def _gaps(c: list) -> int:
    return 0 if c[5] is None else c[6] - c[5] + 1 - c[7]


def damaged(conversations: DataFrame) -> DataFrame:
    """The damage of the contract, by the CRC-32 of ``conv_id:turn`` (nulls as one space). Rows that it drops stay, with ``gone`` true."""

    def shown(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fate = F.col("__fate")
    rows = conversations.select(
        "conv_id",
        "turn",
        shown("role").alias("role"),
        shown("text").alias("text"),
        (F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20).alias("__fate"),
    )
    return rows.select(
        "conv_id",
        "turn",
        F.when(fate == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (fate == 0).alias("gone"),
        F.explode(F.when(fate == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _sorted_rows(rows: DataFrame) -> DataFrame:
    """Rows in order of conversation and turn with their ``kind`` (null: gone). The first of equal texts is found by an aggregate that
    combines before its shuffle, and told to its row by the row's number: no key is hot, whatever text repeats how often."""
    numbered = saved(rows.withColumn("tag", F.monotonically_increasing_id()), "dialogue-rows")
    text = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    firsts = (
        numbered.where(~F.col("gone"))
        .groupBy("conv_id", F.unhex(text).alias("text"))
        .agg(F.min(F.struct("turn", "tag"))["tag"].alias("tag"))
        .select("tag", F.lit(True).alias("first"))
    )
    seen = F.btrim(F.col("text"), F.lit(_SPACE))
    initial = F.substring("role", 1, 1)
    fault = (
        F.when(seen == "", _BLANK)
        .when(F.col("first").isNull(), _REPEATED)
        .when(~F.substring(seen, -1, 1).isin(".", "!", "?"), _CUT_OFF)
        .otherwise(_FINE)
    )
    code = F.when(initial == "s", _S).when(initial == "u", _U).when(initial == "a", _A).otherwise(_OTHER)
    return (
        numbered.join(firsts, "tag", "left")
        .select(
            "conv_id",
            "turn",
            F.when(~F.col("gone"), code * 4 + fault).cast("int").alias("kind"),
            F.col("role").cast("binary").alias("role"),
            F.col("text").cast("binary").alias("text"),
            F.xxhash64("role", "text").alias("tie"),
            "tag",
        )
        .repartitionByRange("conv_id", "turn", "tie", "tag")
        .sortWithinPartitions("conv_id", "turn", "tie", "tag")
        .drop("tie", "tag")
    )


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation: faults found, and the cheapest repair with its cost, audit and text.

    ``rows`` has ``conv_id``, ``turn``, ``role``, ``text`` and, optionally, ``gone``: such rows only see to it that their
    conversation is returned. Other columns are left behind. Null roles and texts count as one space, null turns come first,
    a null ``conv_id`` is a conversation of its own. Rows of one turn come in the order of a hash of role and text, so equal ones
    are neighbours. A role that is empty or begins with another letter than s, u, a fits nowhere: its row is reroled or deleted. A
    conversation without rows has zeros, an empty audit and the hash of nothing; an empty table gives no rows.
    """
    gone = F.col("gone") if "gone" in rows.columns else F.lit(False)
    plain = rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        gone.alias("gone"),
    )
    id_type = plain.schema["conv_id"].dataType.simpleString()
    counts = ", ".join(f"{c} long" for c in _COUNTS)
    result = "cost long, audit string, repaired_sha256 string"
    inside = "part int, number int, costs array<long>, ranks array<long>, audits array<string>, initials array<long>, roles array<binary>, texts array<binary>"
    schema = f"conv_id {id_type}, {counts}, {result}, {inside}"
    sorted_rows = _sorted_rows(plain)
    names = [*_COUNTS, "cost", "audit", "repaired_sha256", "part", "number", "costs", "ranks", "audits", "initials", "roles", "texts"]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser, part = Parser(), TaskContext.get().partitionId()
        out: list[tuple] = []
        ids: list = []
        # The conversation being read: its id, whether chunks of it are given out, whether it may have begun before; the task's chunks.
        state = {"id": None, "none": True, "cut": False, "before": True, "number": 0}
        kinds, turns, roles, texts = [], [], [], []

        def give(whole: bool) -> None:
            initials = [k >> 2 for k in kinds]
            head = _counts(kinds, turns)
            ids.append(state["id"])
            if whole:
                ends, links = parser.parse(kinds, START)
                top, cost, last = finish(ends)
                letters = [*letters_to(links, top), last]
                kept, _ = edited(letters, START, initials, roles, texts)
                digest = hashlib.sha256(b"\n".join(kept)).hexdigest()
                out.append((*head, cost, "".join(letters), digest, *[None] * 8))
            else:
                costs, audits = [-1] * 16, [""] * 16
                for start in range(4):
                    ends, links = parser.parse(kinds, start)
                    for top, (cost, _) in ends.items():
                        costs[4 * start + top] = cost
                        audits[4 * start + top] = " ".join(letters_to(links, top))
                order = {a: i for i, a in enumerate(sorted({a.replace(" ", "") for a in audits}))}
                ranks = [order[a.replace(" ", "")] for a in audits]
                out.append((*head, None, None, None, part, state["number"], costs, ranks, audits, initials, list(roles), list(texts)))
                state.update(number=state["number"] + 1, cut=True)
            for held in (kinds, turns, roles, texts):
                held.clear()

        def emitted() -> Iterator[pa.RecordBatch]:
            if ids:
                columns = [pa.array(ids, id_kind)] + [
                    pa.array([r[i] for r in out], kind) for i, kind in enumerate(_ARROW)
                ]
                yield pa.RecordBatch.from_arrays(columns, ["conv_id", *names])
                ids.clear()
                out.clear()

        for batch in sliced(batches, 2 << 20):
            columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            id_kind = columns["conv_id"].type
            owner, kind = columns["conv_id"].to_pylist(), columns["kind"].to_pylist()
            turn, role, text = (columns[n].to_pylist() for n in ("turn", "role", "text"))
            edges = [0, *(i for i in range(1, len(owner)) if owner[i] != owner[i - 1]), len(owner)]
            for a, b in zip(edges, edges[1:], strict=False):
                if state["none"]:
                    state.update(id=owner[a], none=False)
                elif owner[a] != state["id"]:
                    give(whole=not state["cut"] and not state["before"])
                    state.update(id=owner[a], cut=False, before=False)
                there = [i for i in range(a, b) if kind[i] is not None]
                kinds += [kind[i] for i in there]
                turns += [turn[i] for i in there]
                roles += [role[i] for i in there]
                texts += [text[i] for i in there]
                if len(kinds) >= CHUNK_ROWS or (b - a > 64 and sum(map(len, texts)) >= CHUNK_BYTES):
                    give(whole=False)
            yield from emitted()
        if not state["none"]:
            give(whole=False)
            yield from emitted()

    found = saved(sorted_rows.mapInArrow(pieces, schema), "dialogue-pieces")
    digest = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    gaps = F.when(F.col("min_turn").isNull(), F.lit(0)).otherwise(F.col("max_turn") - F.col("min_turn") + 1 - F.col("turns"))
    whole = found.where(F.col("part").isNull()).withColumn("gaps", gaps.cast("long")).select(*digest)

    cut_schema = f"conv_id {id_type}, part int, number int, start int, stop int, last string, cost long, {counts}"

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Forward over a conversation's tables, then back along the best path. Five small numbers per chunk are held."""
        held = {"id": None, "none": True}
        places, backs = [], []
        tops: dict[int, tuple[int, int]] = {}
        total: list = [0] * 10

        def give() -> pa.RecordBatch:
            top, cost, last = finish(tops)
            rows_out = []
            for i in range(len(places) - 1, -1, -1):
                came = backs[i][top]
                end = i == len(places) - 1
                rows_out.append((*places[i], came, top, last if end else "", cost if end else None, *(total if end else [None] * 10)))
                top = came
            kinds = [pa.int32()] * 4 + [pa.string()] + [pa.int64()] * 11
            columns = [pa.array([held["id"]] * len(places), id_kind)]
            columns += [pa.array([r[i] for r in rows_out], k) for i, k in enumerate(kinds)]
            return pa.RecordBatch.from_arrays(columns, ["conv_id", "part", "number", "start", "stop", "last", "cost", *_COUNTS])

        for batch in batches:
            id_kind = batch.column(0).type
            for row in batch.to_pylist():
                if held["none"] or row["conv_id"] != held["id"]:
                    if not held["none"]:
                        yield give()
                    held = {"id": row["conv_id"], "none": False}
                    places, backs, tops, total = [], [], {START: (0, 0)}, [0] * 10
                best: dict[int, tuple] = {}
                for a, (cost, rank) in tops.items():
                    for b in range(4):
                        more = row["costs"][4 * a + b]
                        if more >= 0:
                            path = (cost + more, rank, row["ranks"][4 * a + b], a)
                            best[b] = min(best.get(b, path), path)
                order = sorted(best, key=lambda b: best[b][1:])
                tops = {b: (best[b][0], order.index(b)) for b in best}
                backs.append(bytes(best[b][3] if b in best else 0 for b in range(4)))
                places.append((row["part"], row["number"]))
                total = _joined(total, [row[c] for c in _COUNTS])
        if not held["none"]:
            yield give()

    chunks = found.where(F.col("part").isNotNull())
    by_chunk = ["conv_id", "part", "number"]
    tables = chunks.select(*by_chunk, "costs", "ranks", *_COUNTS).repartition("conv_id").sortWithinPartitions(*by_chunk)
    chosen = saved(tables.mapInArrow(choose, cut_schema), "dialogue-cuts")
    parts = (
        chosen.join(chunks.select("part", "number", "audits", "initials", "roles", "texts"), ["part", "number"])
        .withColumn("audits", F.col("audits")[F.col("start") * 4 + F.col("stop")])
        .repartition("conv_id")
        .sortWithinPartitions(*by_chunk)
    )

    def join_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Edited chunks in order through one hash; the row behind a conversation's last chunk."""
        audit, hashed, empty = [], hashlib.sha256(), True
        for batch in sliced(batches, 2 << 20):
            id_kind = batch.schema.field("conv_id").type
            for row in batch.to_pylist():
                n = len(row["initials"])
                letters = row["audits"].split(" ") if n else []
                kept, _ = edited([*letters, row["last"]], row["start"], row["initials"], row["roles"], row["texts"])
                for line in kept:
                    hashed.update(line if empty else b"\n" + line)
                    empty = False
                audit += [*letters, row["last"]]
                if row["cost"] is not None:
                    c = [row[x] for x in _COUNTS]
                    values = [_gaps(c), *c[1:5], row["cost"]]
                    columns = [pa.array([row["conv_id"]], id_kind), *[pa.array([v], pa.int64()) for v in values]]
                    columns += [pa.array(["".join(audit)]), pa.array([hashed.hexdigest()])]
                    yield pa.RecordBatch.from_arrays(columns, digest)
                    audit, hashed, empty = [], hashlib.sha256(), True

    cut = parts.mapInArrow(join_chunks, whole.schema)
    return whole.unionByName(cut)


_ARROW = [pa.int64()] * 11 + [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())]
_ARROW += [pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(pa.binary())]
