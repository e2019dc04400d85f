from datetime import datetime, timedelta

from pyspark.sql import functions as F

from cargoloom.operators import lifecycle, quality
from cargoloom.plans.warehouse_schema import FACT_ORDERS, TABLES
from cargoloom.sinks.zones import with_lineage


def as_dict(checks):
    return {r.check_name: (r.value, r.passed) for r in checks.collect()}


def test_key_checks(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,), (None,)], "t_key int")
    assert as_dict(quality.key_checks(df, "t", "t_key")) == {
        "row_count": (5, True),
        "missing_key_column": (0, True),
        "null_keys": (2, False),
        "distinct_keys": (3, True),
        "duplicate_keys": (2, False),
    }
    assert as_dict(quality.key_checks(df.limit(0), "t", "t_key"))["row_count"] == (0, False)
    assert as_dict(quality.key_checks(df, "t", "other"))["missing_key_column"] == (1, False)


def test_null_checks_and_reports(spark):
    df = spark.createDataFrame([(1, None, "x"), (None, None, "y"), (3, 4, None)], "a_key int, b_key int, status string")
    assert as_dict(quality.null_key_checks(df, "t")) == {
        "null_a_key": (1, False),
        "null_b_key": (2, False),
        "null_keys": (3, False),
    }
    assert as_dict(quality.fact_report(df, "t", ["a_key", "b_key"], ["status", "amount"])) == {
        "total_rows": (3, True),
        "null_keys": (2, False),
        "missing_columns": (1, False),
    }
    assert as_dict(quality.null_key_checks(df.limit(0), "t"))["null_keys"] == (0, True)


def test_orphans_ignore_nulls_and_count_rows(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,), (2,), (2,), (None,)], "fk int")
    dim = spark.createDataFrame([(1,), (3,)], "pk int")
    assert as_dict(quality.orphan_checks(fact, "f", [("fk", dim, "pk")])) == {"orphans_fk": (3, False)}
    assert as_dict(quality.orphan_checks(fact, "f", [("fk", fact, "fk")])) == {"orphans_fk": (0, True)}


def test_reconcile(spark):
    assert quality.reconcile("t", spark.range(3), spark.range(3)).first() == ("t", 3, 3, True)
    assert quality.reconcile("t", spark.range(3), spark.range(0)).first() == ("t", 3, 0, False)


def test_zone_checks(spark, as_of):
    df = with_lineage(spark.range(4), "z", as_of)
    query = "SELECT count(*) FROM v_z WHERE id > 2"
    assert as_dict(quality.zone_checks(df, "z", query)) == {
        "row_count": (4, True),
        "missing_lineage_columns": (0, True),
        "custom_query": (1, True),
    }
    found = as_dict(quality.zone_checks(df.drop("dl_batch_id").limit(0), "z", query))
    assert found == {"row_count": (0, False), "missing_lineage_columns": (1, False), "custom_query": (0, False)}


def test_zone_statistics_count_nested_files(spark, tmp_path):
    path = tmp_path / "t"
    spark.range(100).withColumn("p", F.col("id") % 4).repartition(2, "p").write.partitionBy("p").parquet(str(path))
    files = list(path.glob("p=*/*.parquet"))
    row = quality.zone_statistics(spark.read.parquet(str(path)), "t").first()
    assert (row.record_count, row.file_count, row.column_count) == (100, len(files), 2)
    assert row.size_bytes == sum(f.stat().st_size for f in files)


def test_schema_conformance(spark):
    rules = (
        quality.ColumnRule("k", "int", nullable=False, primary_key=True),
        quality.ColumnRule("name", "varchar(3)"),
        quality.ColumnRule("amount", "decimal(4,2)", nullable=False),
        quality.ColumnRule("gone", "int"),
    )
    df = spark.createDataFrame(
        [(1, "abc", 99.99), (1, "abcd", 100.0), (3_000_000_000, "đđđ", None)], "k long, name string, amount double"
    )
    assert {n: v for n, (v, _) in as_dict(quality.schema_conformance(df, "t", rules)).items()} == {
        "missing_columns": 1,
        "k_null": 0,
        "k_not_int": 1,
        "name_too_long": 1,
        "amount_null": 1,
        "amount_not_decimal": 1,
        "k_repeated": 1,
    }


def test_misfits_are_those_of_the_cast(spark):
    """The range and letter tests in front of the cast must not change its answer."""
    texts = ["12", " 12 ", "+5", "-5", "1.5", "5-LOW", "", "1e3", "99999999999", "\t7", "--1", None, "१२"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    rule = (quality.ColumnRule("v", "int"),)
    expected = df.filter("v IS NOT NULL AND try_cast(v AS INT) IS NULL").count()
    assert as_dict(quality.schema_conformance(df, "t", rule))["v_not_int"][0] == expected
    numbers = [9.994, 9.995, 10.0, -9.999, -10.0, 2147483647.0, 2147483648.0, -2147483648.0, -2147483649.0, -(2.0**63), 2.0**63, 1e8, 1e300, float("nan"), float("inf"), None]
    df = spark.createDataFrame([(n,) for n in numbers], "v double")
    for kind in ("int", "decimal(3,2)", "bigint", "decimal(10,2)"):
        expected = df.filter(f"v IS NOT NULL AND try_cast(v AS {kind}) IS NULL").count()
        name = f"v_not_{kind.split('(')[0]}"
        assert as_dict(quality.schema_conformance(df, "t", (quality.ColumnRule("v", kind),)))[name][0] == expected


def test_declared_tables(spark):
    assert [len(TABLES[t]) for t in sorted(TABLES)] == [9, 10, 6, 3, 11, 15, 11]
    assert [r.name for r in FACT_ORDERS if not r.nullable] == ["order_key", "order_id", "user_key"]
    df = spark.createDataFrame([("5", 1.239)], "a string, b double")
    rules = (quality.ColumnRule("b", "decimal(10,2)"), quality.ColumnRule("a", "int"))
    assert quality.cast_to_declared(df, rules).dtypes == [("b", "decimal(10,2)"), ("a", "int")]


NOW = datetime(2024, 12, 24, 12, 0)
ORDERS = "order_id int, user_id int, status string, created_at timestamp_ntz, delivery_time timestamp_ntz"


def ages(spark, cases):
    """Orders from (status, age in seconds, seconds until delivery)."""
    data = [
        (i, 7, s, NOW - timedelta(seconds=age), None if due is None else NOW + timedelta(seconds=due))
        for i, (s, age, due) in enumerate(cases)
    ]
    return spark.createDataFrame(data, ORDERS)


def test_advance_status_at_the_thresholds(spark):
    cases = [
        ("processing", 1800, 0),
        ("processing", 1801, 0),
        ("processing", 999_999, -5),
        ("accepted", 3600, 0),
        ("accepted", 3601, 0),
        ("in_transit", 10, 0),
        ("in_transit", 10, -1),
        ("in_transit", 10, None),
        ("delivered", 9999, -9),
        ("cancelled", 9999, -9),
    ]
    moved = lifecycle.advance_status(ages(spark, cases), NOW).orderBy("order_id").collect()
    assert [r.status for r in moved] == [
        "processing",
        "accepted",
        "accepted",
        "accepted",
        "in_transit",
        "in_transit",
        "delivered",
        "in_transit",
        "delivered",
        "cancelled",
    ]
    assert [r.previous_status for r in moved] == [c[0] for c in cases]


def test_initial_status_and_status_by_age(spark):
    cases = [(None, 1799, 0), (None, 1800, 0), (None, 7199, 0), (None, 7200, 1), (None, 7200, 0)]
    got = ages(spark, cases).orderBy("order_id").select(lifecycle.initial_status(NOW)).collect()
    assert [r[0] for r in got] == ["processing", "accepted", "accepted", "in_transit", "delivered"]
    limits = [7199, 7200, 21599, 21600, 172799, 172800]
    got = ages(spark, [(None, a, 0) for a in limits]).orderBy("order_id").select(lifecycle.status_by_age(NOW)).collect()
    assert [r[0] for r in got] == ["processing", "accepted", "accepted", "in_transit", "in_transit", "delivered"]


def test_cascades(spark, rows):
    changes = spark.createDataFrame(
        [(1, "delivered", "d1"), (2, "in_transit", "d2"), (3, "accepted", "d3")],
        "order_id int, new_status string, delivery_address string",
    )
    shipments = spark.createDataFrame(
        [(10, 1, "in_transit", "x"), (11, 1, "in_transit", "y"), (20, 2, "assigned", "z"), (30, 3, "assigned", "w"), (40, None, "assigned", "v")],
        "shipment_id int, order_id int, status string, current_location string",
    )
    assert rows(lifecycle.cascade_to_shipments(shipments, changes)) == [
        (10, 1, "completed", "Đã giao thành công"),
        (11, 1, "completed", "Đã giao thành công"),
        (20, 2, "in_transit", "Đang giao tại d2"),
        (30, 3, "assigned", "w"),
        (40, None, "assigned", "v"),
    ]
    payments = spark.createDataFrame(
        [(1, 1, "pending", None), (2, 2, "pending", None)],
        "payment_id int, order_id int, payment_status string, payment_date timestamp_ntz",
    )
    assert rows(lifecycle.cascade_to_payments(payments, changes, NOW)) == [
        (1, 1, "completed", NOW),
        (2, 2, "pending", None),
    ]


def test_messages(spark, rows):
    orders = ages(spark, [("processing", 2000, 0), ("in_transit", 10, -1), ("delivered", 99, -50)])
    sent = rows(lifecycle.status_notifications(lifecycle.status_changes(orders, NOW), NOW))
    assert sent == [
        (0, 7, "Đơn hàng #0 đã được xác nhận và sẽ sớm được giao", NOW),
        (1, 7, "Đơn hàng #1 đã được giao thành công", NOW),
    ]
    timeline = lifecycle.notification_timeline(orders)
    per_order = {r.order_id: r.n for r in timeline.groupBy("order_id").agg(F.count("*").alias("n")).collect()}
    assert per_order == {0: 1, 1: 3, 2: 5}
    review = timeline.filter(F.col("message").startswith("Hãy đánh giá")).collect()
    due = NOW - timedelta(seconds=50) + timedelta(hours=1)
    assert [(r.order_id, r.notification_date) for r in review] == [(2, due)]


def test_drivers_and_users(spark, rows):
    drivers = spark.createDataFrame([(1,), (2,), (3,), (4,)], "driver_id int")
    shipments = spark.createDataFrame(
        [(1, "completed"), (1, "in_transit"), (2, "in_transit"), (3, "completed"), (3, "completed"), (None, "completed")],
        "driver_id int, status string",
    )
    assert rows(lifecycle.available_drivers(drivers, shipments)) == [(1,), (3,), (4,)]
    assert rows(lifecycle.idle_drivers(drivers, shipments)) == [(3,), (4,)]
    unknown = spark.createDataFrame([(1, None), (2, None), (2, "completed")], "driver_id int, status string")
    assert rows(lifecycle.available_drivers(drivers, unknown)) == [(2,), (3,), (4,)]
    assert rows(lifecycle.idle_drivers(drivers, unknown)) == [(3,), (4,)]
    users = spark.createDataFrame([(1, "user  "), (2, "driver"), (3, "user")], "user_id int, role string")
    assert rows(lifecycle.active_users(users)) == [(1,), (3,)]


def test_shipment_status_map(spark):
    df = spark.createDataFrame([("processing",), ("accepted",), ("in_transit",), ("delivered",)], "s string")
    got = [r[0] for r in df.select(lifecycle.shipment_status("s")).collect()]
    assert got == [None, "assigned", "in_transit", "completed"]
