"""Versions that share files, merges by bucket, incremental loads, and facts that neither multiply nor move."""

from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cargoloom.operators.keys import numbered_copies
from cargoloom.plans import warehouse_run
from cargoloom.plans.landing import land, land_increment, land_new, landed_mark
from cargoloom.sinks import versions
from cargoloom.sinks.versions import MOST_PARTS, VersionedTables, apply_retention
from cargoloom.sinks.zones import Zones
from cargoloom.sources.specs import LOGISTICS_TABLES, TableSpec

DAY = datetime(2024, 1, 10)
FACTS = "owner long, key long, v string, at int"


def files(root) -> set[str]:
    return {str(p) for p in Path(root).rglob("*.parquet") if "/log/" not in str(p)}


def days(n):
    return DAY + timedelta(days=n)


def test_a_merge_writes_the_buckets_that_changed(spark, rows, tmp_path):
    tables, root = VersionedTables(spark, str(tmp_path)), tmp_path / "f" / "parts"
    first = [(i, i + 1, "a", 0) for i in range(400)] + [(None, 900, "n", 0)]
    df = spark.createDataFrame(first, FACTS)
    assert tables.merge(df, "f", days(0), "owner", "key", ["at"], buckets=16) == 401
    assert tables.highest_key("f", days(1)) == 900
    old, listed = files(root), tables.directories_of("f")
    # All rows come again, written at another time, and three owners changed, one of them null.
    again = [(i, i + 1, "b" if i in (7, 8) else "a", 1) for i in range(400)] + [(None, 900, "m", 1)]
    assert tables.merge(spark.createDataFrame(again, FACTS), "f", days(1), "owner", "key", ["at"]) == 401
    written = files(root) - old
    changed = {r.b for r in df.where("owner IN (7, 8) OR owner IS NULL").select(F.pmod(F.xxhash64("owner"), F.lit(16)).alias("b")).collect()}
    assert {p.split("dl_bucket=")[1].split("/")[0] for p in written} == {str(b) for b in changed} and len(written) == len(changed)
    assert len(set(tables.directories_of("f")) & set(listed)) == 16 - len(changed)
    kept = {(i, "b" if i in (7, 8) else "a") for i in range(400)} | {(None, "m")}
    assert {(r.owner, r.v) for r in tables.current("f").collect()} == kept and tables.current("f").count() == 401
    assert tables.before("f", days(1)).where("v = 'a'").count() == 400
    # The same rows once more: a version of its own, and nothing written.
    before = files(root)
    assert tables.merge(spark.createDataFrame(again, FACTS), "f", days(2), "owner", "key", ["at"]) == 401
    assert files(root) == before and tables.current_version("f") == "20240112_000000"


def test_new_owners_are_added_and_directories_joined_in_time(spark, tmp_path):
    tables, root = VersionedTables(spark, str(tmp_path)), tmp_path / "f" / "parts"
    tables.merge(spark.range(100).select(F.col("id").alias("owner"), F.lit(1).alias("v")), "f", days(0), "owner", buckets=2)
    for n in range(1, MOST_PARTS + 3):
        old = files(root)
        fresh = spark.range(100 * n, 100 * n + 10).select(F.col("id").alias("owner"), F.lit(1).alias("v"))
        assert tables.merge(fresh, "f", days(n), "owner") == 100 + 10 * n
        counted = spark.read.parquet(*sorted(files(root) - old)).count()
        assert counted == 10 or n >= MOST_PARTS
        assert len(tables.directories_of("f")) <= 2 * MOST_PARTS
    assert tables.current("f").select("owner").distinct().count() == tables.current("f").count() == 100 + 10 * n
    # A repeated version is built from the one before, and an empty merge changes nothing.
    assert tables.merge(fresh, "f", days(n), "owner") == 100 + 10 * n
    assert tables.merge(fresh.limit(0), "f", days(n + 1), "owner") == 100 + 10 * n
    # Only what the last versions list stays.
    now = sorted(r.owner for r in tables.current("f").collect())
    assert tables.vacuum("f", keep_versions=1) > 0
    assert sorted(r.owner for r in tables.current("f").collect()) == now
    listed = {f"{root}/{p}" for p in tables.directories_of("f")}
    assert {str(Path(p).parent) for p in files(root)} == listed
    assert tables.vacuum("none") == 0


def test_retention_writes_no_data(spark, tmp_path):
    tables, root = VersionedTables(spark, str(tmp_path)), tmp_path / "n" / "parts"
    rows = spark.range(100).select(F.col("id"), F.expr("date'2024-01-01' + cast(id % 10 as int)").alias("dl_process_date"))
    rows = rows.unionByName(spark.range(1).select("id", F.lit(None).cast("date").alias("dl_process_date")))
    tables.publish(rows, "n", days(0), ["dl_process_date"])
    old = files(root)
    assert apply_retention(tables, "n", days(1), 3, ["dl_process_date"]) == 30
    assert files(root) == old
    assert {str(r.dl_process_date) for r in tables.current("n").collect()} == {"2024-01-08", "2024-01-09", "2024-01-10"}
    assert tables.before("n", days(1)).count() == 101 and tables.rows("n") == 30
    assert apply_retention(tables, "n", days(30), 3) == 0 and tables.current("n").count() == 0
    # A table without such partitions is written anew.
    tables.publish(rows, "plain", days(0))
    assert apply_retention(tables, "plain", days(1), 3) == 30


def test_the_log_knows_the_highest_key(spark, tmp_path):
    tables = VersionedTables(spark, str(tmp_path))
    assert tables.known_keys("d", days(0)) is None and tables.highest_key("d", days(0)) == 0
    tables.publish(spark.range(1, 10).withColumnRenamed("id", "k"), "d", days(0), key="k")
    # The highest key was given once, even if its row is gone.
    tables.publish(spark.range(1, 4).withColumnRenamed("id", "k"), "d", days(1), key="k")
    known = tables.known_keys("d", days(2))
    assert (known.highest, known.rows.count()) == (9, 3)


def test_copies_are_numbered(spark, rows):
    data = [(1, None), (1, "b"), (1, "a"), (1, "a"), (None, "x"), (None, None), (2, "z")]
    df = spark.createDataFrame(data, "id int, v string").repartition(3)
    got = rows(numbered_copies(df, ["id"], "n"))
    assert got == sorted([(1, None, 0), (1, "a", 1), (1, "a", 2), (1, "b", 3), (None, None, 0), (None, "x", 1), (2, "z", 0)], key=repr)
    assert {r.n for r in numbered_copies(df.where("id = 2"), ["id"], "n").collect()} == {0}


# --- incremental loads -------------------------------------------------------------

SPEC = TableSpec("o", "id", "at", ("at",), key="id")


def orders(spark, first, last, status="s"):
    data = [(i, status, DAY + timedelta(hours=i)) for i in range(first, last)]
    return spark.createDataFrame(data, "id int, status string, at timestamp_ntz")


def test_a_full_load_has_a_mark_and_what_comes_again_counts_once(spark, tmp_path):
    zones = Zones(spark, str(tmp_path))
    assert landed_mark(zones, SPEC, days(1)) is None
    land(lambda _: orders(spark, 0, 10), zones, SPEC, days(1))
    mark = landed_mark(zones, SPEC, days(2))
    assert mark == DAY + timedelta(hours=9)
    assert land_increment(orders(spark, 0, 11), zones, SPEC, days(2), mark)[0] == 1
    assert zones.read("raw", "o").count() == 11
    # An order that changed comes with a later mark; one without a mark comes each time.
    changed = spark.createDataFrame([(3, "new", DAY + timedelta(days=9)), (77, "u", None), (None, "u", None)], orders(spark, 0, 0).schema)
    for n in (3, 4):
        land_new(lambda _: changed, zones, SPEC, days(n))
    newest = zones.newest("o", "id")
    assert newest.count() == newest.select("id").distinct().count() == 12
    assert newest.where("id = 3").first().status == "new"
    assert zones.batch("o", days(1)).count() == 10 and zones.batch("o", days(9)) is None
    # A full load begins anew.
    land(lambda _: orders(spark, 0, 4), zones, SPEC, days(5))
    assert zones.newest("o", "id").count() == 4 and list(zones.loads("o")) == ["20240115_000000"]


def test_a_load_that_breaks_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    zones = Zones(spark, str(tmp_path))
    land(lambda _: orders(spark, 0, 10), zones, SPEC, days(1))
    # Rows of a load that died before its log row.
    orders(spark, 0, 5).write.parquet(zones._attempt_path("o", "20240112_000000", 1, True))
    assert zones.read("raw", "o").count() == 10 and landed_mark(zones, SPEC, days(9)) == DAY + timedelta(hours=9)


# --- facts over several runs -------------------------------------------------------

SCHEMAS = {
    "users": "user_id int, full_name string, email string, phone_number string, address string, role string, created_at timestamp_ntz",
    "drivers": "driver_id int, user_id int, vehicle_license_plate string, vehicle_type string, vehicle_year int",
    "orders": "order_id int, user_id int, pickup_address string, delivery_address string, package_description string,"
    " package_weight double, delivery_time timestamp_ntz, status string, created_at timestamp_ntz",
    "payments": "payment_id int, order_id int, amount double, payment_method string, payment_status string, payment_date timestamp_ntz",
    "shipments": "shipment_id int, order_id int, driver_id int, current_location string, estimated_delivery_time timestamp_ntz, status string",
    "notifications": "notification_id int, user_id int, message string, notification_date timestamp_ntz",
}


@pytest.fixture
def few_buckets(monkeypatch):
    """Whole runs over a handful of rows."""
    monkeypatch.setattr(versions, "BUCKETS", 2)


SPECS = tuple(TableSpec(s.name, None, s.incremental_column, source_table=s.source_table, key=s.key) for s in LOGISTICS_TABLES)


def reader(spark, **data):
    return lambda spec: spark.createDataFrame(data.get(spec.name, []), SCHEMAS[spec.name])


def small(payments, shipments, orders=(1, 2, 3)):
    return {
        "users": [(7, "G", None, None, "a", "user", DAY)],
        "drivers": [(2, 7, "P", "car", 2020)],
        "orders": [(i, 7, "X", "Y", "p", 1.0, None, "processing", DAY) for i in orders],
        "payments": payments,
        "shipments": [(i, o, 2, "Q", DAY, "completed") for i, o in shipments],
    }


def facts(warehouse, name, *columns):
    return sorted(tuple(r) for r in warehouse.current(name).select(*columns).collect())


def test_null_and_repeated_shipments_stay_as_many(spark, tmp_path, few_buckets):
    warehouse = VersionedTables(spark, f"{tmp_path}/warehouse")
    read = reader(spark, **small([], [(None, 1), (None, 2), (5, 1), (5, 2), (6, 3)]))
    keys = None
    for n in range(3):
        warehouse_run.run(spark, read, str(tmp_path), days(n), "me", SPECS)
        found = {r.tracking_key: r.shipment_id for r in warehouse.current("fact_shipment_tracking").collect()}
        assert warehouse.current("fact_shipment_tracking").count() == len(found) == 5
        assert sorted(map(str, found.values())) == ["5", "5", "6", "None", "None"] and (keys is None or found == keys)
        keys = found


@pytest.mark.parametrize("policy", ["latest", "sum"])
def test_a_new_payment_moves_no_key(spark, tmp_path, few_buckets, policy):
    warehouse = VersionedTables(spark, f"{tmp_path}/warehouse")
    paid = [(1, 1, 5.0, "cash", "completed", DAY), (2, 2, 6.0, "cash", "pending", None)]
    for n, payments in enumerate((paid, [*paid, (3, 1, 7.0, "cash", "completed", days(1)), (4, 3, 1.0, "cash", "pending", None)])):
        warehouse_run.run(spark, reader(spark, **small(payments, [(5, 1), (6, 3)])), str(tmp_path), days(n), "me", SPECS, policy)
    assert facts(warehouse, "fact_orders", "order_key", "order_id") == [(1, 1), (2, 2), (3, 3)]
    assert facts(warehouse, "fact_shipment_tracking", "tracking_key", "order_key") == [(1, 1), (2, 3)]
    assert float(warehouse.current("fact_orders").where("order_id = 1").first().order_amount) == (7 if policy == "latest" else 12)


def test_increments_give_what_a_full_run_gives(spark, tmp_path, few_buckets):
    """New orders, a changed order, a payment of an old order, a payment again, and a user that comes after their order."""

    def day(n):
        tables = small(
            [(1, 1, 5.0, "cash", "completed", DAY), (2, 2, 6.0, "cash", "pending", None), *([(3, 1, 7.0, "cash", "failed", days(n))] if n else [])],
            [(5, 1), (6, 3), *([(7, 4)] if n else [])],
        )
        tables["orders"] += [(4, 8, "X", "Z", "p", 1.0, None, "accepted", days(1))] if n else []
        if n > 1:
            tables["users"].append((8, "H", None, None, "b", "user", days(2)))
            tables["orders"][1] = (2, 7, "X", "Y", "p", 1.0, days(2), "delivered", days(2))
        return reader(spark, **tables)

    for n in (0, 1, 1, 2):
        warehouse_run.run(spark, day(n), f"{tmp_path}/a", days(n), "me", SPECS, incremental=True)
    warehouse_run.run(spark, day(2), f"{tmp_path}/b", days(2), "me", SPECS)
    a, b = (VersionedTables(spark, f"{tmp_path}/{x}/warehouse") for x in "ab")
    assert Zones(spark, f"{tmp_path}/a").newest("orders", "order_id").count() == 4
    for name, columns in (
        ("fact_orders", ["order_id", "order_amount", "order_status", "payment_status", "order_date_key"]),
        ("fact_shipment_tracking", ["shipment_id", "date_key", "status", "driver_key"]),
        ("dim_user", ["user_id", "full_name"]),
        ("dim_location", ["full_address"]),
    ):
        rows_a, rows_b = (sorted(map(repr, facts_of(t, name, columns))) for t in (a, b))
        assert rows_a == rows_b, name
    users = {r.user_id: r.user_key for r in a.current("dim_user").collect()}
    assert {r.order_id: r.user_key for r in a.current("fact_orders").collect()}[4] == users[8]
    keys = facts(a, "fact_orders", "order_key")
    assert len(keys) == len(set(keys)) == 5


def facts_of(tables, name, columns):
    return [tuple(r) for r in tables.current(name).select(*columns).collect()]
