"""Steps of a whole run that took time for each row (F3)."""

from datetime import datetime

from pyspark.sql import functions as F

from cargoloom.functions.dates import minutes_between
from cargoloom.operators import quality
from cargoloom.operators.joins import frequent_keys
from cargoloom.sinks import versions
from cargoloom.sinks.versions import VersionedTables
from cargoloom.sinks.zones import _formatted

TEXTS = [
    "1", "+1", "-1", " 1 ", "\t1\n", "0001", "1-2", "1-2-3-4-1996-01-02", "1-", "--1", "+-1", "- 1", "1 2", "1.5", "1.", ".", "", "  ",
    "1e3", "x", "127", "128", "-129", "32768", "2147483647", "2147483648", "-2147483648", "-2147483649", "9223372036854775807",
    "9223372036854775808", "-9223372036854775809", "12345678901234567890", "0" * 30 + "7", "\x001\x7f", "1\x85", "１", None,
]


def test_texts_of_a_wrong_form_are_told_without_a_cast(spark):
    """An id such as 1-2-3 has a number's letters only; casting it cost an exception for each row."""
    df = spark.createDataFrame([(t,) for t in TEXTS], "v string")
    v = F.col("v")
    told = {r.v: r.form for r in df.where(v.isNotNull()).select("v", v.rlike(quality.WHOLE_NUMBER).alias("form")).collect()}
    assert not any(told[t] for t in ("1-2", "1-2-3-4-1996-01-02", "1-", "--1", "1.5", "", "x", "12345678901234567890"))
    for kind in quality.INTEGRAL_BITS:
        expected = F.col("v").isNotNull() & v.try_cast(kind).isNull()
        assert df.where(quality._misfits(v, df.schema["v"].dataType, kind) != expected).collect() == []


def test_rows_of_directories_are_counted_without_their_paths(spark, tmp_path, monkeypatch):
    """The path of its file was cut by a regular expression for each row."""

    def per_row(*_):
        raise AssertionError("a text function for each row")

    monkeypatch.setattr(versions.F, "regexp_replace", per_row)
    tables = VersionedTables(spark, str(tmp_path))
    rows = [(1, "a b", "x"), (2, "a b", "x"), (3, "100%=/é", "x"), (4, None, "y"), (5, "01", "y"), (6, "1", "y"), (7, "", None)]
    df = spark.createDataFrame(rows, "id long, p string, q string")
    assert tables.publish(df, "t", datetime(2024, 1, 1), ["p", "q"]) == len(rows)
    entry = tables._newest("t")
    assert sorted(p["rows"] for p in entry["parts"]) == [1, 1, 1, 1, 1, 2]
    for part in entry["parts"]:
        assert spark.read.parquet(f"{tables._root('t')}/{part['path']}").count() == part["rows"]
    assert tables.keep_parts("t", datetime(2024, 1, 2), lambda v: v["p"] == "a b" and v["q"] == "x") == 2
    assert tables.merge(df, "m", datetime(2024, 1, 1), "id", buckets=4) == len(rows)
    assert tables.rows("m") == tables.current("m").count()


def test_frequent_keys_are_counted_by_all_tasks(spark):
    """Gathering the list in one file had one task count all keys."""
    df = spark.range(4000).select((F.col("id") % 500).alias("k")).unionAll(spark.range(30).select(F.lit(7).cast("long").alias("k")))
    found = frequent_keys(df, "k", rows_per_task=20)
    assert [tuple(r) for r in found.collect()] == [(7, 2)]
    assert len(found.inputFiles()) <= 1


def test_minutes_round_half_away_from_zero(spark):
    at = F.expr("timestamp_ntz '2000-01-01 00:00:00'")
    df = spark.createDataFrame([(s,) for s in [*range(-200, 201), 10**9 + 30, -(10**9) - 30]], "s long")
    end = F.expr("timestampadd(SECOND, s, timestamp_ntz '2000-01-01 00:00:00')")
    got = df.select(minutes_between(at, end).alias("m"), F.round(F.col("s") / 60).cast("long").alias("e")).collect()
    assert [r.m for r in got] == [r.e for r in got]


def test_years_are_those_of_the_format(spark):
    days = ["0001-01-01", "0999-12-31", "1000-01-01", "1998-05-06", "9999-12-31", "+10000-01-01", "-0044-03-15", None]
    df = spark.createDataFrame([(d,) for d in days], "t string").select(F.col("t").cast("date").alias("d"))
    ours = [r[0] for r in df.where("d < date '10000-01-01' or d is null").select(_formatted("d", "yyyy")).collect()]
    assert ours == [r[0] for r in df.where("d < date '10000-01-01' or d is null").select(F.date_format("d", "yyyy")).collect()]
