"""What a day's run does no more than once, and not at all."""

from datetime import datetime, timedelta

import pytest

from pyspark.sql import functions as F

from cargoloom.operators.keys import KnownKeys, stable_keys
from cargoloom.plans.facts import keyed_facts
from cargoloom.plans.warehouse_run import load_keys
from cargoloom.sinks.versions import VersionedTables

FACTS = "owner long, key long, v string, at long"


def days(n):
    return datetime(2024, 1, 1) + timedelta(days=n)


def counted(spark, df):
    """The frame, and how many of its rows have been evaluated."""
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(run, df.schema), seen


def test_stable_keys_evaluate_what_comes_once(spark):
    known = KnownKeys(spark.range(50).select(F.concat(F.lit("n"), "id").alias("name"), (F.col("id") + 1).alias("k")), 50)
    incoming, seen = counted(spark, spark.range(80).select(F.concat(F.lit("n"), "id").alias("name")))
    held = {r["name"]: r["k"] for r in stable_keys(incoming, known, "name", "k").collect()}
    assert all(held[f"n{i}"] == i + 1 for i in range(50)) and sorted(held.values()) == list(range(1, 81))
    assert seen.value == 80


def test_keyed_facts_compare_columns_with_nulls(spark, rows):
    schema = "owner string, copy long, v string"
    known = KnownKeys(spark.createDataFrame([(1, "a", 0), (2, None, 0), (3, "b", 1)], "k long, owner string, copy long"), 9)
    came = spark.createDataFrame([("a", 0, "x"), ("a", 1, "y"), (None, 0, "z"), ("b", 1, "u"), (None, None, "w")], schema)
    incoming, seen = counted(spark, came)
    found = keyed_facts(incoming, ["owner", "copy"], "k", known).select("k", *came.columns)
    assert rows(found) == [(1, "a", 0, "x"), (10, None, None, "w"), (11, "a", 1, "y"), (2, None, 0, "z"), (3, "b", 1, "u")]
    assert seen.value == 5


def test_keys_are_only_added(spark, rows, tmp_path):
    tables = VersionedTables(spark, str(tmp_path / "w"))
    schema = "key long, owner long, copy long"
    assert load_keys(tables, spark.createDataFrame([(1, 7, 0), (2, None, 0)], schema), "k", ("owner", "copy"), "key", days(0)) == 2
    before = tables.directories_of("k")
    # Owner 7 comes with a second copy, the null owner not at all, 8 is new.
    later = spark.createDataFrame([(1, 7, 0), (3, 7, 1), (4, 8, 0)], schema)
    for _ in range(2):
        assert load_keys(tables, later, "k", ("owner", "copy"), "key", days(1)) == 4
        assert rows(tables.current("k")) == [(1, 7, 0), (2, None, 0), (3, 7, 1), (4, 8, 0)]
        assert set(before) < set(tables.directories_of("k"))  # no directory that was there is written anew
        assert tables.highest_key("k", days(2)) == 4
    # Nothing new: the same directories.
    held = tables.directories_of("k")
    assert load_keys(tables, later.limit(1), "k", ("owner", "copy"), "key", days(2)) == 4
    assert tables.directories_of("k") == held
    for n in range(3, 13):
        one = spark.createDataFrame([(n + 2, 7, n)], schema)
        assert load_keys(tables, one, "k", ("owner", "copy"), "key", days(n)) == n + 2
    assert rows(tables.current("k").where("owner = 7"))[0] == (1, 7, 0) and tables.current("k").count() == 14
    assert len(tables.directories_of("k")) < 11


def test_keys_that_come_several_times_are_all_kept(spark, rows, tmp_path):
    tables = VersionedTables(spark, str(tmp_path / "w"))
    schema = "key long, owner long, copy long"
    load_keys(tables, spark.createDataFrame([(1, 7, 0), (2, 7, 1), (3, 8, 0)], schema), "k", ("owner", "copy"), "key", days(0))
    later = spark.createDataFrame([(1, 7, 0), (1, 7, 0), (4, 7, 2)], schema)
    assert load_keys(tables, later, "k", ("owner", "copy"), "key", days(1)) == 5
    assert rows(tables.current("k")) == [(1, 7, 0), (1, 7, 0), (2, 7, 1), (3, 8, 0), (4, 7, 2)]


@pytest.mark.parametrize(
    "change, gone, outside",
    [(lambda i: True, 0, 0), (lambda i: i % 50 != 0, 3, 4), (lambda i: i % 50 == 0, 3, 4), (lambda i: True, 0, 4), (lambda i: True, 2, 0)],
)
def test_merge_is_right_whichever_owners_change(spark, rows, tmp_path, change, gone, outside):
    tables = VersionedTables(spark, str(tmp_path / "w"))
    first = [(None if i == 0 else i, 2 * i + c, f"v{c}", 0) for i in range(200 + outside) for c in range(2)]
    tables.merge(spark.createDataFrame(first, FACTS), "f", days(0), "owner", "key", ["at"], buckets=4)
    inside = [r for r in first if r[0] is None or (r[0] < 200 and r[0] not in range(100, 100 + gone))]
    came = [(o, k, v + "!" if change(o or 0) else v, 1) for o, k, v, _ in inside]
    expected = [r if not change(r[0] or 0) else c for r, c in zip(inside, came, strict=True)] + [r for r in first if r not in inside]
    assert tables.merge(spark.createDataFrame(came, FACTS), "f", days(1), "owner", "key", ["at"]) == len(expected)
    assert rows(tables.current("f")) == sorted(expected, key=repr)
    assert rows(tables.before("f", days(1))) == sorted(first, key=repr)


def test_merge_joins_no_rows_where_all_owners_change(spark, tmp_path, monkeypatch):
    """A source that is loaded whole each day: its facts are written as they come."""
    from cargoloom.sinks import versions

    tables, plans = VersionedTables(spark, str(tmp_path / "w")), []
    df = spark.range(300).select(F.col("id").alias("owner"), F.col("id").alias("key"), F.lit("a").alias("v"), F.lit(0).alias("at"))
    tables.merge(df, "f", days(0), "owner", "key", ["at"], buckets=4)
    write = versions.write_rows
    monkeypatch.setattr(versions, "write_rows", lambda d, *a, **k: (plans.append(d._jdf.queryExecution().toString()), write(d, *a, **k)))
    assert tables.merge(df.withColumn("v", F.lit("b")), "f", days(1), "owner", "key", ["at"]) == 300
    assert len(plans) == 1 and "Join" not in plans[0]
    assert tables.current("f").where("v = 'b'").count() == 300


def test_lookups_of_instalment_facts_are_not_broadcast_by_the_size_of_files(spark, tmp_path, monkeypatch):
    """Users that take little room in a file, and much in the driver."""
    from cargoloom.operators import keys
    from cargoloom.workload.queries import QUERIES

    def save(name, df):
        df.coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))

    at = "timestamp_ntz'1996-01-01 00:00:00'"
    save("region", spark.sql("SELECT 0 AS r_regionkey, 'R' AS r_name"))
    save("nation", spark.sql("SELECT 0 AS n_nationkey, 'N' AS n_name, 0 AS n_regionkey"))
    customers = "id AS c_custkey", "concat('c', id) AS c_name", "0 AS c_nationkey", "1.5D AS c_acctbal", "'m' AS c_mktsegment"
    save("customer", spark.range(4000).selectExpr(*customers))
    save("supplier", spark.range(20).selectExpr("id AS s_suppkey", "'s' AS s_name", "0 AS s_nationkey", "1D AS s_acctbal"))
    orders = "id AS o_orderkey", "id % 4000 AS o_custkey", "'F' AS o_orderstatus", "9D AS o_totalprice", f"{at} AS o_orderdate"
    save("orders", spark.range(500).selectExpr(*orders, "'1' AS o_orderpriority"))
    lines = "id % 400 AS l_orderkey", "id AS l_partkey", "id % 20 AS l_suppkey", "CAST(id AS INT) AS l_linenumber", "1D AS l_quantity"
    more = "2D AS l_extendedprice", "0D AS l_discount", "0D AS l_tax", "'N' AS l_returnflag", "'F' AS l_linestatus"
    save("lineitem", spark.range(800).selectExpr(*lines, *more, f"{at} AS l_shipdate"))
    dense, plans = keys.dense_keys, []

    def seen(df, order_by, key, *args, **named):
        plans.append((key, df._jdf.queryExecution().executedPlan().toString()))
        return dense(df, order_by, key, *args, **named)

    monkeypatch.setattr(keys, "dense_keys", seen)
    threshold, factor = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.sources.fileCompressionFactor"
    before = spark.conf.get(threshold), spark.conf.get(factor)
    spark.conf.set(threshold, "20000")
    try:
        found = QUERIES["fact_shipment_tracking_instalments"](spark, str(tmp_path)).collect()
        assert spark.conf.get(factor) == before[1]
    finally:
        spark.conf.set(threshold, before[0])
    assert len(found) == 800 and all(r.order_key for r in found)
    joined = [p for key, p in plans if key == "__start"]
    assert joined and all("Join [user_id" in p and "BroadcastHashJoin [user_id" not in p for p in joined)
