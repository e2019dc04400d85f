"""Document fingerprints from closed syncmers, in DataFrame operations.

The letters are words: a text is split at white space of any kind and length. Of a stretch of more than ``LONG_WORD`` code points without any, as in
languages that do not set spaces, every code point beyond the first so many is a word. Of ``K`` words in a row, the ``K - 1`` pairs of neighbours are hashed; the
``K`` words are a closed syncmer, and an anchor, if the least of the pairs is the first or the last. Whether they are depends on these
words alone, so a passage has the same anchors wherever it stands, and of any ``K - 1`` runs of words in a row at least
one is an anchor. Texts with fewer than ``SIZE`` of them add their closed syncmers of two words, whose one pair is the first and the last: these
are all pairs of neighbours. Texts of one word have the word.

A fingerprint holds each anchor once, with the word where it first stands: the ``SIZE`` of least hash, and every further one whose hash
is among the least ``1 / SPARSE`` of all hashes, so its size grows with the text and long texts share anchors wherever they share a
passage. Two fingerprints are as alike as the part of their comparable anchors (those of least hash of both, by the same
two rules) that both have and that agree in place. Anchors agree if they moved by nearly the same number of words (``SHIFT`` apart at
most), as behind a header or an insertion; the largest such group counts. Anchors that did not move (by more than ``SHIFT``) agree
even alone; one that moved alone agrees with nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargoloom.llm.common import identified_texts, saved
from cargoloom.operators.keys import dense_keys

K, SIZE, SHIFT = 8, 32, 32
LONG_WORD = 20
#: The character that is looked for no times makes Java's lookbehind count code points, not halves of surrogate pairs.
_BETWEEN_WORDS = rf"[\s\x85\p{{Z}}]+|(?<=[^\s\x85\p{{Z}}]{{{LONG_WORD}}}{chr(0x10FFFF)}{{0}})(?=[^\s\x85\p{{Z}}])"
#: Beyond ``SIZE``, one anchor of so many is kept; the least group of moved anchors.
SPARSE, TOGETHER = 8, 2
#: An anchor is one number: its hash above, its place in words below.
PLACE_BITS = 24
_PLACE = (1 << PLACE_BITS) - 1
#: The sign bit: anchors have it, pairs do not, so anchors come first in order.
_FIRST = -(1 << 63)
#: Anchors below are kept in every fingerprint (pairs, which are not negative, never are).
_ALWAYS = _FIRST + (1 << 63) // SPARSE


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _packed(hashed: Column, place: Column) -> Column:
    return hashed.bitwiseAND(F.lit(~_PLACE)).bitwiseOR(F.least(place, F.lit(_PLACE)).cast("long"))


def _hash(anchor: Column) -> Column:
    return F.shiftright(anchor, PLACE_BITS)


def anchors(text: Column) -> Column:
    """The anchors of a text as packed numbers, in order of hash, each hash at its first place; at least one."""
    wide = K - 1  # pairs in K words

    def of_pairs(pairs: Column) -> Column:
        def mark(first: Column, i: Column) -> Column:
            least = F.least(first, *[F.get(pairs, i + j) for j in range(1, wide)])
            closed = (first == least) | (F.get(pairs, i + (wide - 1)) == least)
            whole = F.xxhash64(first, *[F.get(pairs, i + j) for j in range(2, wide, 2)])
            return F.when((i + wide <= F.size(pairs)) & closed, _packed(whole, i).bitwiseOR(F.lit(_FIRST)))

        found = F.transform(pairs, mark)
        filling = F.transform(pairs, lambda x, i: _packed(x, i).bitwiseAND(F.lit(~_FIRST)))
        return let(
            F.filter(found, lambda x: x.isNotNull()),
            lambda some: F.when(F.size(some) >= SIZE, some).otherwise(F.concat(some, filling)),
        )

    def of_words(words: Column) -> Column:
        n = F.size(words)
        pairs = F.zip_with(F.slice(words, 1, n - 1), F.slice(words, 2, n), lambda a, b: F.xxhash64(a, b))
        return F.when(n >= 2, let(pairs, of_pairs)).otherwise(F.array(_packed(F.xxhash64(text), F.lit(0))))

    every = let(F.split(text, _BETWEEN_WORDS), of_words)
    return let(
        F.sort_array(every),
        lambda a: F.filter(a, lambda x, i: (i == 0) | (_hash(x) != _hash(F.get(a, i - 1)))),
    )


def sketch(text: Column) -> Column:
    return F.filter(anchors(text), lambda x, i: (i < SIZE) | (x < F.lit(_ALWAYS)))


def _most_within(moves: Column) -> Column:
    """The most of ``moves`` (in order) that lie at most ``SHIFT`` apart, in one pass: a group of one more must end at the
    move at hand, as the best so far was found among those before it."""

    def longer(best: Column, i: Column) -> Column:
        return F.when(F.get(moves, i) - F.get(moves, i - best) <= SHIFT, best + 1).otherwise(best)

    places = F.sequence(F.lit(0), F.size(moves) - 1)
    return F.when(F.size(moves) > 0, F.aggregate(places, F.lit(0), lambda best, i: F.when(best > i, best).otherwise(longer(best, i)))).otherwise(0)


def likeness(a: Column, b: Column) -> Column:
    """How alike two fingerprints (arrays of packed anchors) are, from 0 to 1; equal ones are 1."""

    def sided(x: Column, side: int) -> Column:
        place = x.bitwiseAND(F.lit(_PLACE)).cast("int")
        return F.struct(_hash(x).alias("h"), F.lit(side).alias("side"), place.alias("place"))

    def of_both(both: Column) -> Column:
        def before(i: Column) -> Column:
            return F.get(both, i - 1)

        new = F.filter(both, lambda x, i: (i == 0) | (x["h"] != before(i)["h"]))

        def shared(different: Column) -> Column:
            # Up to here both fingerprints hold every anchor of their texts.
            least = F.coalesce(F.get(different, F.lit(SIZE - 1)), F.get(different, F.size(different) - 1))["h"]
            comparable = F.size(F.filter(different, lambda x: (x["h"] <= least) | (x["h"] < F.lit(_ALWAYS >> PLACE_BITS))))

            def part(last: Column) -> Column:
                moves = F.transform(
                    both,
                    lambda x, i: F.when(
                        (i > 0) & (x["h"] == before(i)["h"]) & (x["h"] <= last), x["place"] - before(i)["place"]
                    ),
                )

                def agreeing(moves: Column) -> Column:
                    still = F.size(F.filter(moves, lambda d: F.abs(d) <= SHIFT))
                    return let(_most_within(moves), lambda n: F.greatest(still, F.when(n >= TOGETHER, n).otherwise(0)))

                return let(F.array_sort(F.filter(moves, lambda d: d.isNotNull())), agreeing)

            return let(comparable, lambda n: part(F.get(different, n - 1)["h"]) / n)

        return let(new, shared)

    return let(
        F.sort_array(F.concat(F.transform(a, lambda x: sided(x, 0)), F.transform(b, lambda x: sided(x, 1)))), of_both
    )


def as_text(fingerprint: Column) -> Column:
    return F.array_join(fingerprint.cast("array<string>"), ",")


def _documents(docs: DataFrame) -> DataFrame:
    """Documents by id and hash of the text; rows that repeat both are one."""
    return identified_texts(docs).withColumn("h", F.xxhash64("text"))


def linked(docs: DataFrame) -> DataFrame:
    """Per document (``doc_id``, ``h``) its length in code points, how many rows it has, and the next one in descending order
    (equal ids: by ``h``, descending), the first after the last. Only ids and lengths are sorted, in ranges."""
    narrow = (
        _documents(docs)
        .groupBy("doc_id", "h")
        .agg(F.first(F.length("text")).cast("long").alias("n_chars"), F.count("*").alias("copies"))
    )
    ordered = saved(dense_keys(narrow, ["doc_id", "h"], "place"), "document-places")
    n = ordered.count()
    # Ascending places, so the next is the place below, and the lowest is followed by the highest.
    follower = ordered.select(
        F.when(F.col("place") == n, F.lit(1)).otherwise(F.col("place") + 1).cast("long").alias("place"),
        F.col("doc_id").alias("next_id"),
        F.col("h").alias("next_h"),
    )
    return saved(ordered.join(follower, "place").drop("place"), "document-links")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_chars``, ``edited_sha256``, both fingerprints as text, and the likeness of the document's to the edited
    text's and to the next document's.

    The edited text has the last third of the code points (rounded down) replaced by as many first ones of the next
    document, or by all if it has fewer. Null texts are empty. Rows without ``doc_id`` are left out; rows that repeat id and
    text are one document in the order and have one result row each; other columns are ignored; an empty table gives none.
    A single document is followed by itself.
    """
    base = _documents(docs)
    links = linked(docs)
    third = F.floor(F.col("n_chars") / 3).cast("int")
    # The links are renamed, not the texts: both joins then use one and the same shuffle of the texts.
    asked = links.select(
        F.struct("doc_id", "h").alias("of"), "n_chars", "copies", F.col("next_id").alias("doc_id"), F.col("next_h").alias("h")
    )
    tails = base.join(asked, ["doc_id", "h"]).select(
        F.col("of.doc_id").alias("doc_id"),
        F.col("of.h").alias("h"),
        "n_chars",
        "copies",
        F.col("doc_id").alias("next_id"),
        F.col("h").alias("next_h"),
        F.substring(F.col("text"), F.lit(1), third).alias("tail"),
    )
    # Rows that repeat a document are one on either side of the join: the links tell how many there are.
    once = base.dropDuplicates(["doc_id", "h"]) if links.where("copies > 1").limit(1).count() else base
    tails = tails.dropDuplicates(["doc_id", "h"]) if once is not base else tails
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - third), F.col("tail"))
    texts = once.join(tails, ["doc_id", "h"]).select(
        "doc_id", "h", "n_chars", "copies", "next_id", "next_h", "text", edited.alias("edited")
    )
    prints = saved(
        texts.select(
            "doc_id",
            "h",
            "n_chars",
            "copies",
            "next_id",
            "next_h",
            F.sha2("edited", 256).alias("edited_sha256"),
            sketch(F.col("text")).alias("own"),
            sketch(F.col("edited")).alias("changed"),
        ),
        "fingerprints",
    )
    following = prints.select(F.col("doc_id").alias("next_id"), F.col("h").alias("next_h"), F.col("own").alias("following"))
    return (
        prints.join(following, ["next_id", "next_h"])
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select(
            "doc_id",
            "n_chars",
            "edited_sha256",
            as_text(F.col("own")).alias("fingerprint"),
            as_text(F.col("changed")).alias("edited_fingerprint"),
            likeness(F.col("own"), F.col("changed")).alias("near_edited"),
            likeness(F.col("own"), F.col("following")).alias("near_next"),
        )
    )
