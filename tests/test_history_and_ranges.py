from datetime import date
from unittest.mock import MagicMock

import pytest
from pyspark.sql import functions as F

from cargoloom.operators.history import advance_history, as_of_day, begin_history, with_row_of_day
from cargoloom.operators.sketches import distinct_sketches, error_bound, merged_distinct
from cargoloom.sources import jdbc
from cargoloom.sources.even_ranges import cells_relation, even_ranges, frame_cells, range_predicates

DAYS = [date(2024, 1, d) for d in (1, 5, 9)]
OPEN = date(9999, 12, 31)


def users(spark, *data):
    return spark.createDataFrame(data, "id int, name string, city string")


def history_of(spark, *states, **options):
    history = begin_history(users(spark, *states[0]).withColumn("key", F.col("id") + 100), DAYS[0])
    for day, state in zip(DAYS[1:], states[1:], strict=False):
        history = advance_history(history, users(spark, *state), "id", day, **options)
    return history


def told(df):
    return sorted((r.id, r.city, r.is_active, r.effective_start_date, r.effective_end_date) for r in df.collect())


def test_a_change_closes_a_row_and_opens_the_next(spark):
    history = history_of(
        spark, [(1, "a", "X"), (2, "b", None)], [(1, "a", "Y"), (2, "b", None), (3, "c", "Z"), (None, "n", "N")], [(1, "a", "X")]
    )
    assert [(r[0], r[1] or "", *r[2:]) for r in sorted(told(history.fillna("", ["city"])))] == [
        (1, "X", False, DAYS[0], DAYS[1]),
        (1, "X", True, DAYS[2], OPEN),
        (1, "Y", False, DAYS[1], DAYS[2]),
        (2, "", True, DAYS[0], OPEN),
        (3, "Z", True, DAYS[1], OPEN),
    ]
    # Columns that the states lack go on from row to row of a key.
    assert {(r.id, r.key) for r in history.collect()} == {(1, 101), (2, 102), (3, None)}
    assert [r.city for r in as_of_day(history.where("id = 1"), DAYS[1]).collect()] == ["Y"]


def test_only_tracked_columns_make_a_row(spark):
    history = history_of(spark, [(1, "a", "X")], [(1, "b", "X")], tracked=["city"])
    assert [tuple(r)[:2] for r in history.collect()] == [(1, "a")]


def test_missing_keys_close_when_asked_and_may_come_back(spark):
    states = [(1, "a", "X"), (2, "b", "Y")], [(1, "a", "X")], [(1, "a", "X"), (2, "b", "Y")]
    assert told(history_of(spark, *states, close_missing=True)) == [
        (1, "X", True, DAYS[0], OPEN),
        (2, "Y", False, DAYS[0], DAYS[1]),
        (2, "Y", True, DAYS[2], OPEN),
    ]
    assert len(told(history_of(spark, *states))) == 2


def test_the_last_day_run_again_replaces_what_it_did(spark):
    first = history_of(spark, [(1, "a", "X"), (2, "b", "Y"), (4, "d", "W")])
    wrong = advance_history(first, users(spark, (1, "a", "Q"), (3, "c", "Z")), "id", DAYS[1], close_missing=True)
    right = users(spark, (1, "a", "X"), (2, "b", "V"), (4, "d", "W"))
    once = advance_history(first, right, "id", DAYS[1], close_missing=True)
    assert told(advance_history(wrong, right, "id", DAYS[1], close_missing=True)) == told(once)
    assert told(advance_history(once, right, "id", DAYS[1], close_missing=True)) == told(once)


def test_an_older_day_is_refused(spark):
    history = history_of(spark, [(1, "a", "X")], [(1, "a", "Y")])
    with pytest.raises(Exception, match="already past"):
        advance_history(history, users(spark, (1, "a", "Z")), "id", DAYS[0]).collect()


def test_empty_states_and_histories(spark):
    history = history_of(spark, [(1, "a", "X")])
    assert told(advance_history(history, users(spark, (1, "a", "X")).limit(0), "id", DAYS[1])) == told(history)
    assert told(advance_history(history.limit(0), users(spark, (7, "g", "G")), "id", DAYS[1])) == [(7, "G", True, DAYS[1], OPEN)]


def test_facts_take_the_row_of_their_day(spark):
    history = history_of(spark, [(1, "a", "X")], [(1, "a", "Y")])
    facts = spark.createDataFrame([(1, d) for d in (date(2023, 12, 31), *DAYS)] + [(9, DAYS[0])], "id int, day date")
    got = with_row_of_day(facts, history, "id", "day", ["city"])
    assert [(r.id, r.city) for r in got.orderBy("id", "day").collect()] == [(1, None), (1, "X"), (1, "Y"), (1, "Y"), (9, None)]


def keys_with_gaps(spark):
    near = spark.range(0, 4000).select(F.col("id").alias("k"))
    far = spark.range(0, 3000).select((F.lit(10**15) + F.col("id") * F.col("id") * 7).alias("k"))
    return near.unionByName(far).unionByName(spark.range(1).select(F.lit(-(10**12)).alias("k")))


@pytest.mark.parametrize("most", [1, 10, 700, 3500, 10_000])
def test_even_ranges_follow_the_rows(spark, most):
    keys = keys_with_gaps(spark)
    low, high = keys.agg(F.min("k"), F.max("k")).first()
    ranges = even_ranges(frame_cells(keys, "k", low), low, high, most)
    sizes = [n for _, n in ranges]
    assert sum(sizes) == 7001 and max(sizes) <= most
    assert max(sizes) * len(sizes) <= 2 * sum(sizes)
    assert ranges[0][0] == low and ranges == sorted(ranges)
    if most > 100:
        held = [keys.where(p).count() for p in range_predicates("k", [s for s, _ in ranges])]
        assert held == sizes


def test_one_crowded_key_is_one_range(spark):
    keys = spark.range(300).select(F.when(F.col("id") < 250, 5).otherwise(F.col("id")).cast("long").alias("k"))
    ranges = even_ranges(frame_cells(keys, "k", 5), 5, 299, 40)
    assert (5, 250) in ranges and sum(n for _, n in ranges) == 300


def test_predicates_hold_null_and_later_keys():
    assert range_predicates("k", [3]) == ["1 = 1"]
    assert range_predicates("k", [3, 9, 20]) == ["k < 9 OR k IS NULL", "k >= 9 AND k < 20", "k >= 20"]


def test_the_database_counts_cells_as_frames_do(spark):
    keys = keys_with_gaps(spark)
    keys.createOrReplaceTempView("gapped")
    low = -(10**12)
    for width, coarser, starts in [(16**10, None, []), (16, 256, [low, low + 256 * 3906250000])]:
        text = cells_relation("gapped", "k", "k <> 7", low, width, coarser, starts)
        got = sorted(tuple(r) for r in spark.sql(f"SELECT * FROM {text}").collect())
        assert got == sorted(frame_cells(keys.where("k <> 7"), "k", low)(width, coarser, starts)) and got
    spark.catalog.dropTempView("gapped")


def test_an_even_read_hands_over_its_ranges(spark, monkeypatch):
    keys = keys_with_gaps(spark)
    low, high = keys.agg(F.min("k"), F.max("k")).first()
    session, count = MagicMock(), frame_cells(keys, "k", low)
    source = jdbc.JdbcSource(session, "jdbc:x", {"user": "u"})
    asked = []

    def scan(self, relation):
        asked.append(relation)
        answer = MagicMock()
        answer.first.return_value = (low, high, 7001)
        answer.collect.side_effect = lambda: count(*answers[len(asked) - 2])
        return answer

    answers = []
    even_ranges(lambda *a: answers.append(a) or count(*a), low, high, 1751)
    monkeypatch.setattr(jdbc.JdbcSource, "scan", scan)
    source.extract("T", "k", "k <> 7", even=True)
    told = session.read.jdbc.call_args
    assert told.args == ("jdbc:x", "(SELECT * FROM T WHERE k <> 7) filtered")
    assert told.kwargs["properties"]["user"] == "u" and told.kwargs["properties"]["fetchsize"] == "100000"
    assert told.kwargs["predicates"][0].endswith("OR k IS NULL") and 4 <= len(told.kwargs["predicates"]) <= 8
    assert all("k <> 7" in text for text in asked)


def test_sketches_of_batches_add_up(spark):
    df = spark.range(60_000).select((F.col("id") % 3).alias("batch"), (F.col("id") % 20_000).alias("user"))
    df = df.unionByName(spark.range(30_000).select(F.lit(9).cast("long"), F.lit(None).cast("long")).toDF("batch", "user"))
    sketches = distinct_sketches(df, "user", ["batch"])
    total = sketches.agg(F.sum("rows"), merged_distinct()).first()
    assert total[0] == 90_000 and abs(total[1] - 20_000) <= 20_000 * error_bound()
    assert sketches.where("batch = 9").agg(merged_distinct()).first()[0] == 0
