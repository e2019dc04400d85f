"""What grows with the input: broadcasts by file sizes, files of shuffles and of attempts, and rows moved for keys and directories."""

import glob
from datetime import datetime
from random import Random

from pyspark.sql import functions as F

from cargoloom.operators.keys import fan_out_keys, repeated_keys
from cargoloom.plans.warehouse_run import load_fact
from cargoloom.session import RUN_SETTINGS, run_settings
from cargoloom.sinks.versions import VersionedTables
from cargoloom.sinks.zones import Zones
from cargoloom.sources.specs import TableSpec


def test_files_that_compress_well_are_not_broadcast_in_a_run(spark, tmp_path):
    path = str(tmp_path / "ids")
    spark.range(400_000).select(F.concat(F.lit("a-long-prefix-of-every-id-"), F.col("id")).alias("k")).write.parquet(path)
    spark.createDataFrame([("x",)], "k string").write.parquet(f"{path}-few")
    ids, few = spark.read.parquet(path), spark.read.parquet(f"{path}-few")
    before = {k: spark.conf.get(k) for k in RUN_SETTINGS}

    def plan():
        joined = ids.join(spark.read.parquet(path), "k", "left_semi")
        return joined._jdf.queryExecution().sparkPlan().toString()

    assert "BroadcastHashJoin" in plan()
    with run_settings(spark), run_settings(spark):
        assert "BroadcastHashJoin" not in plan()
        assert "BroadcastHashJoin" in ids.join(few, "k", "left_semi")._jdf.queryExecution().sparkPlan().toString()
    assert {k: spark.conf.get(k) for k in RUN_SETTINGS} == before


def test_replaced_loads_and_attempts_leave_no_files(spark, tmp_path, as_of):
    zones, spec = Zones(spark, str(tmp_path)), TableSpec("t", partitions=("s",), key="id")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id int, s string")
    for at in (as_of, as_of, datetime(2024, 12, 27)):
        zones.land_raw(rows, spec, at)
    assert zones.drop_replaced("t") == 2 and zones.drop_replaced("t") == 0
    assert zones.read("raw", "t").count() == 2 and len(glob.glob(f"{tmp_path}/raw/t__increments/whole/*/*")) == 1

    tables = VersionedTables(spark, str(tmp_path / "warehouse"))
    for at in (as_of, as_of, datetime(2024, 12, 27)):
        tables.publish(rows, "t", at)
    assert tables.vacuum("t", keep_versions=None) == 1
    assert tables.current("t").count() == 2 and tables.before("t", datetime(2024, 12, 27)).count() == 2


def test_first_loads_move_no_rows(spark, tmp_path, as_of):
    """One task writes one file into each directory it has rows for: a shuffle would deal them to as many tasks as there are."""
    tables = VersionedTables(spark, str(tmp_path))
    facts = spark.range(2000).repartition(3).selectExpr("CAST(id AS int) AS order_id", "id AS order_key")
    assert load_fact(tables, facts, "fact_orders", as_of) == 2000
    files = glob.glob(f"{tmp_path}/fact_orders/parts/*/*/part-*.parquet")
    assert len(files) == 3 * 32 and len({f.rsplit("part-", 1)[1][:5] for f in files}) == 3


def test_fan_out_keys_are_row_numbers(spark):
    """Null and repeated ids on either side, orders without matches, and an order with very many: as row_number has them."""
    pick = Random(3)
    left = [(pick.choice([None, *range(25)]) if pick.random() < 0.3 else 100 + i, pick.choice([None, *range(12)]), i) for i in range(90)]
    right = [(pick.choice([None, *range(4, 14), 5, 5, 5, 5]), pick.choice([None, *range(40)]), float(i)) for i in range(160)]
    a = spark.createDataFrame(left, "a int, o int, x int")
    b = spark.createDataFrame(right, "o int, b int, y double")
    expected = a.join(b, "o", "left").selectExpr("row_number() OVER (ORDER BY a, b) AS k", "a", "b").collect()
    totals = sorted(map(tuple, a.join(b, "o", "left").select("a", "o", "x", "b", "y").collect()), key=repr)
    for most in (None, 10):
        found = fan_out_keys(a, b, "o", "a", "b", "k", rows_per_task=most)
        assert found.columns == ["k", "a", "o", "x", "b", "y"]
        rows = found.collect()
        assert sorted((r.k, r.a, r.b) for r in rows) == sorted((r.k, r.a, r.b) for r in expected)
        assert sorted((tuple(r)[1:] for r in rows), key=repr) == totals
    assert fan_out_keys(a.limit(0), b, "o", "a", "b", "k").count() == 0
    assert {r[0] for r in repeated_keys(a, ["a"]).collect()} == {x for x in [r[0] for r in left] if [r[0] for r in left].count(x) > 1}


def test_fan_out_keys_sort_no_joined_rows(spark):
    a, b = spark.range(50).toDF("o"), spark.range(200).selectExpr("id % 40 AS o", "id AS b")
    found = fan_out_keys(a, b, "o", "o", "b", "k")
    assert "rangepartitioning" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert not any("sorted-k-" in f for f in found.inputFiles())
    assert [r.k for r in found.orderBy("o", "b").collect()] == list(range(1, 211))
