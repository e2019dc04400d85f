from datetime import date, datetime, timedelta
from unittest.mock import MagicMock

import pytest
from pyspark.sql import functions as F

from cargoloom.operators.upsert import updatable_columns, upsert
from cargoloom.plans.landing import each, land, land_increment, landed_mark
from cargoloom.session import all_shuffle_tasks, new_work_path, path_exists, work_dir, work_scope
from cargoloom.sinks.versions import VersionedTables, apply_retention, retained
from cargoloom.sinks.zones import LINEAGE, Zones, with_lineage, write_parquet
from cargoloom.sources import jdbc
from cargoloom.sources.incremental import newer_than
from cargoloom.sources.specs import LOGISTICS_TABLES, TableSpec
from cargoloom.streaming.increments import land_new_files

EVENTS = "notification_id int, user_id int, message string, notification_date timestamp_ntz"


def events(spark, first, last):
    start = datetime(2024, 1, 1)
    data = [(i, i % 5, "m  ", start + timedelta(hours=i)) for i in range(first, last)]
    return spark.createDataFrame(data, EVENTS)


# --- relational sources: the text and numbers given to the reader, no database needed ---


@pytest.mark.parametrize(
    ("rows", "partitions"),
    [(0, 4), (99_999, 4), (100_000, 8), (999_999, 8), (1_000_000, 16), (16_000_001, 17), (10**9, 1000), (10**12, 10**6)],
)
def test_readers_follow_the_rows_from_the_ladder_on(rows, partitions):
    assert jdbc.partitions_for(rows) == partitions


def test_rows_per_partition_is_the_callers():
    assert jdbc.partitions_for(10**9, 10_000_000) == 100
    assert jdbc.partitions_for(10, 10_000_000) == 4


def test_bounds_give_the_plan_of_the_read(spark):
    df = spark.range(5, 300).withColumnRenamed("id", "k")
    assert jdbc.read_bounds(jdbc.bounds(df, "k"), 10) == jdbc.ReadBounds(5, 299, 295, 30)
    assert jdbc.read_bounds(jdbc.bounds(df.limit(0), "k")) == jdbc.ReadBounds(None, None, 0, 4)


def test_append_writes_as_many_parts_as_rows_need():
    df = MagicMock()
    df.count.return_value = 50_000_000
    jdbc.JdbcSource(MagicMock(), "jdbc:x").append(df, "facts")
    df.repartition.assert_called_once_with(50)


def test_filters_sit_inside_the_subquery():
    where = jdbc.incremental_clause("created_at", datetime(2024, 1, 2, 3, 4, 5))
    assert where == "created_at > '2024-01-02 03:04:05'"
    assert jdbc.filtered_relation("Orders", where) == f"(SELECT * FROM Orders WHERE {where}) filtered"
    assert jdbc.filtered_relation("Orders", None) == "Orders"
    assert where in jdbc.bounds_relation("Orders", "order_id", where)


def test_parallel_extract_reads_the_filtered_subquery_in_ranges():
    """What the JDBC reader is told, with the reader itself stood in for."""
    spark, told = MagicMock(), {}
    reader = spark.read.format.return_value
    reader.option.side_effect = lambda k, v: told.__setitem__(k, v) or reader
    reader.options.return_value = reader
    reader.load.return_value.first.return_value = (5, 900_004, 250_000)
    source = jdbc.JdbcSource(spark, "jdbc:x", {"user": "u"})
    source.extract_incremental("Orders", "created_at", "2024-01-01", "order_id")
    assert told == {
        "url": "jdbc:x",
        "dbtable": "(SELECT * FROM Orders WHERE created_at > '2024-01-01') filtered",
        "partitionColumn": "order_id",
        "lowerBound": "5",
        "upperBound": "900005",
        "numPartitions": "8",
    }
    assert reader.options.call_args.kwargs["fetchsize"] == "100000"
    told.clear()
    reader.load.return_value.first.return_value = (None, None, 0)  # an empty table is read as it is
    source.extract_spec(LOGISTICS_TABLES[0])
    assert told == {"url": "jdbc:x", "dbtable": "Orders"}


# --- zones -------------------------------------------------------------------------


def test_raw_landing_adds_lineage_and_partitions(spark, as_of, tmp_path):
    zones, spec = Zones(spark, str(tmp_path)), TableSpec("n", None, None, ("notification_date",), ("user_id",))
    assert zones.land_raw(events(spark, 0, 48), spec, as_of) == 48
    back = zones.read("raw", "n")
    assert set(LINEAGE) < set(back.columns) and back.count() == 48
    assert back.select("dl_batch_id").distinct().collect() == [("20241226_100000",)]
    pruned = back.filter(F.col("notification_date_partition") == "2024-01-01")
    assert pruned.count() == 24
    assert "PartitionFilters: [isnotnull(notification_date_partition" in pruned._jdf.queryExecution().toString()
    assert zones.land_raw(events(spark, 0, 3), spec, as_of) == 3
    assert zones.read("raw", "n", ["message"]).columns == ["message"]
    assert zones.read("raw", "n").count() == 3
    with pytest.raises(ValueError):
        zones.path("gold", "n")


def test_merged_schema_and_given_schema(spark, tmp_path):
    path = str(tmp_path / "raw" / "t")
    spark.createDataFrame([(1,)], "a int").write.parquet(f"{path}/p=1")
    spark.createDataFrame([(2, "x")], "a int, b string").write.parquet(f"{path}/p=2")
    zones = Zones(spark, str(tmp_path))
    assert zones.read("raw", "t").columns == ["a", "b", "p"]
    assert zones.read("raw", "t", ["b"], schema="a int, b string, p int").count() == 2


def test_increments_leave_no_gap_and_repeat_nothing(spark, tmp_path):
    zones = Zones(spark, str(tmp_path))
    spec = next(s for s in LOGISTICS_TABLES if s.name == "notifications")
    first, second = datetime(2024, 1, 3), datetime(2024, 1, 9)
    assert land_increment(events(spark, 0, 40), zones, spec, first, None) == (40, datetime(2024, 1, 2, 15))
    for _ in range(2):
        mark = landed_mark(zones, spec, second)
        assert mark == datetime(2024, 1, 2, 15)
        assert land_increment(events(spark, 0, 100), zones, spec, second, mark)[0] == 60
    assert zones.read("raw", "notifications").count() == 100
    with pytest.raises(ValueError):
        land_increment(events(spark, 0, 1), zones, TableSpec("drivers"), first, None)


STATUS_SPEC = TableSpec("o", None, "at", ("at",), ("status",))


def _orders(spark, first, last, status):
    start = datetime(2024, 1, 1)
    data = [(i, status, start + timedelta(minutes=i)) for i in range(first, last)]
    return spark.createDataFrame(data, "id int, status string, at timestamp_ntz")


def test_a_repeated_increment_replaces_rows_of_other_statuses(spark, tmp_path):
    zones, at = Zones(spark, str(tmp_path)), datetime(2024, 1, 2)
    land_increment(_orders(spark, 0, 10, "processing"), zones, STATUS_SPEC, at, None)
    land_increment(_orders(spark, 0, 10, "accepted"), zones, STATUS_SPEC, at, None)
    assert zones.read("raw", "o").groupBy("status").count().collect() == [("accepted", 10)]


def test_a_second_increment_of_a_day_stands_beside_the_first(spark, tmp_path):
    zones, at = Zones(spark, str(tmp_path)), datetime(2024, 1, 2)
    _, mark = land_increment(_orders(spark, 0, 10, "007"), zones, STATUS_SPEC, at, None)
    later = at + timedelta(hours=2)
    assert landed_mark(zones, STATUS_SPEC, later) == mark
    assert land_increment(_orders(spark, 0, 13, "007"), zones, STATUS_SPEC, later, mark)[0] == 3
    assert land_increment(_orders(spark, 0, 13, ""), zones, STATUS_SPEC, later + timedelta(hours=1), datetime(2025, 1, 1)) == (
        0,
        datetime(2025, 1, 1),
    )
    landed = zones.read("raw", "o")
    assert landed.count() == 13 and {r.status for r in landed.collect()} == {"007"}


def test_a_full_load_replaces_the_increments(spark, tmp_path):
    zones, at = Zones(spark, str(tmp_path)), datetime(2024, 1, 2)
    land_increment(_orders(spark, 0, 10, "a"), zones, STATUS_SPEC, at, None)
    zones.land_raw(_orders(spark, 0, 12, "b"), STATUS_SPEC, at + timedelta(days=1))
    assert zones.read("raw", "o").count() == 12
    land_increment(_orders(spark, 12, 15, "c"), zones, STATUS_SPEC, at + timedelta(days=2), None)
    assert zones.read("raw", "o").count() == 15


def test_partition_columns_keep_their_types(spark, tmp_path):
    zones = Zones(spark, str(tmp_path))
    zones.land_raw(_orders(spark, 0, 3, "007"), STATUS_SPEC, datetime(2024, 1, 2))
    row = zones.read("raw", "o").first()
    assert (row.status, row.at_partition) == ("007", "2024-01-01")


def test_rows_without_a_mark_come_when_asked(spark):
    df = spark.createDataFrame([(1, None), (2, datetime(2024, 1, 5))], "id int, at timestamp_ntz")
    mark = datetime(2024, 1, 3)
    assert newer_than(df, "at", mark).count() == 1 and newer_than(df, "at", mark, with_unmarked=True).count() == 2


def test_landing_trims_only_the_padded_columns(spark, as_of, tmp_path):
    zones, spec = Zones(spark, str(tmp_path)), TableSpec("t", padded=("a",))
    land(lambda s: spark.createDataFrame([("x  ", "y  ")], "a string, b string"), zones, spec, as_of)
    assert zones.read("raw", "t", ["a", "b"]).first() == ("x", "y  ")


def test_streamed_landing_takes_each_file_once(spark, as_of, tmp_path):
    folder, zones = str(tmp_path / "in"), Zones(spark, str(tmp_path / "lake"))
    spec = next(s for s in LOGISTICS_TABLES if s.name == "notifications")
    for first in (0, 30, 60):
        events(spark, first, first + 30).coalesce(1).write.mode("append").parquet(folder)
        land_new_files(spark, folder, EVENTS, zones, spec, str(tmp_path / "check"), as_of)
        landed = zones.read("raw", "notifications")
        assert landed.count() == landed.select("notification_id").distinct().count() == first + 30
    assert zones.read("raw", "notifications").filter("message = 'm  '").count() == 90


def test_batches_replace_themselves(spark, as_of, tmp_path):
    zones = Zones(spark, str(tmp_path))
    for n in (5, 7):
        assert zones.load_batch(spark.range(n), "f", as_of) == n
    zones.load_batch(spark.range(2), "f", as_of + timedelta(days=1))
    assert zones.read("processed", "f").count() == 9


def test_processed_and_staging_modes(spark, tmp_path):
    zones = Zones(spark, str(tmp_path))
    for mode, total in (("overwrite", 3), ("append", 6), ("overwrite", 3)):
        assert zones.load_processed(spark.range(3), "dim_x", mode) == 3
        assert zones.read("processed", "dim_x").count() == total
    assert zones.load_staging(spark.range(4).withColumn("p", F.lit("a")), "s", ["p"]) == 4
    assert (tmp_path / "staging" / "s" / "p=a").exists()


def test_rebalanced_write_makes_few_files(spark, tmp_path):
    df = spark.range(0, 4000, 1, 40).withColumn("d", F.col("id") % 3)
    assert write_parquet(df, str(tmp_path / "t"), partition_by=["d"]) == 4000
    assert len(list((tmp_path / "t").glob("d=*/*.parquet"))) == 3


# --- versions and retention --------------------------------------------------------


def test_version_is_current_only_once_logged(spark, as_of, tmp_path):
    tables = VersionedTables(spark, str(tmp_path))
    assert tables.current("t") is None
    tables.publish(spark.range(3), "t", as_of)
    # A later run that wrote its rows but died before the log entry.
    spark.range(99).write.parquet(str(tmp_path / "t" / "version_20300101_000000_1"))
    assert tables.current("t").count() == 3
    tables.publish(tables.current("t").filter("id > 0"), "t", as_of + timedelta(days=1))
    assert tables.current("t").count() == 2


def test_a_version_may_be_published_again_but_not_an_older_one(spark, as_of, tmp_path):
    tables, next_day = VersionedTables(spark, str(tmp_path)), as_of + timedelta(days=1)
    tables.publish(spark.range(3), "t", as_of)
    for n in (5, 4):
        grown = tables.before("t", next_day).unionAll(spark.range(3, 3 + n))
        assert tables.publish(grown, "t", next_day) == 3 + n
    assert tables.current("t").count() == 7 and tables.before("t", next_day).count() == 3
    with pytest.raises(ValueError, match="newer"):
        tables.publish(spark.range(1), "t", as_of)


def test_retention_keeps_the_cutoff_day_and_prunes(spark, as_of, tmp_path):
    rows = with_lineage(events(spark, 0, 240), "n", as_of)
    rows = rows.withColumn("dl_process_date", F.col("notification_date").cast("date"))
    tables = VersionedTables(spark, str(tmp_path))
    tables.publish(rows, "n", datetime(2024, 1, 10), ["dl_process_date"])
    assert apply_retention(tables, "n", datetime(2024, 1, 11), 3, ["dl_process_date"]) == 72
    kept = tables.current("n")
    assert kept.agg(F.min("dl_process_date")).first()[0] == date(2024, 1, 8)
    plan = retained(kept, datetime(2024, 1, 11), 2)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(dl_process_date" in plan
    with pytest.raises(ValueError):
        apply_retention(tables, "other", as_of, 3)


# --- upsert ------------------------------------------------------------------------

DIM = "k int, name string, fk int"


def test_upsert(spark, rows):
    current = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, "c", 30)], DIM)
    incoming = spark.createDataFrame([(99, 2, "B"), (98, 3, None), (97, 4, "d")], "fk int, k int, name string")
    merged = upsert(current, incoming, "k", updatable_columns(current, "k", ["fk"]))
    expected = [(1, "a", 10), (2, "B", 20), (3, None, 30), (4, "d", 97)]
    assert merged.columns == current.columns and rows(merged) == sorted(expected, key=repr)
    again = upsert(merged, incoming, "k", ["name"])
    assert rows(again) == rows(merged)
    assert rows(upsert(current, incoming, "k"))[1] == (2, "B", 99)
    with pytest.raises(ValueError):
        upsert(current, incoming.drop("fk"), "k")


def test_work_paths(spark):
    path = new_work_path(spark, "x")
    assert path.startswith(work_dir(spark)) and not path_exists(spark, path)
    spark.range(1).write.parquet(path)
    assert path_exists(spark, path)


def test_work_scope_removes_what_was_made_inside(spark):
    def make():
        path = new_work_path(spark, "y")
        spark.range(1).write.parquet(path)
        return path

    with work_scope(spark):
        inside = each([make, make])
        assert all(path_exists(spark, p) for p in inside)
    outside = make()
    assert not any(path_exists(spark, p) for p in inside) and path_exists(spark, outside)


def test_directories_are_dealt_to_all_tasks_and_the_setting_comes_back(spark, tmp_path):
    """A few bytes in many directories: several tasks write, one for each directory, also when two writes overlap."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    rows = spark.range(400).selectExpr("id", "id % 40 AS d")
    with all_shuffle_tasks(spark):
        with all_shuffle_tasks(spark):
            assert spark.conf.get(name) == "false"
        assert spark.conf.get(name) == "false"
    assert spark.conf.get(name) == before
    assert write_parquet(rows, str(tmp_path / "t"), partition_by=["d"]) == 400
    assert spark.conf.get(name) == before
    files = list((tmp_path / "t").glob("d=*/part-*"))
    assert len(files) == 40
    assert len({f.name.split("-")[1] for f in files}) > 1
    assert spark.read.parquet(str(tmp_path / "t")).selectExpr("sum(id)").first()[0] == 399 * 200
