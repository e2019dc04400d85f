from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from cargoloom.plans.dimensions import dim_driver, dim_location, dim_payment_method, dim_user
from cargoloom.plans.facts import fact_orders, fact_shipment_tracking
from cargoloom.plans.warehouse_run import load_database
from cargoloom.sources.specs import ROWS_PER_PARTITION

ORDERS = (
    "order_id int, user_id int, pickup_address string, delivery_address string, package_description string,"
    " package_weight double, delivery_time timestamp_ntz, status string, created_at timestamp_ntz"
)
PAYMENTS = (
    "payment_id int, order_id int, amount double, payment_method string, payment_status string,"
    " payment_date timestamp_ntz"
)
SHIPMENTS = (
    "shipment_id int, order_id int, driver_id int, current_location string,"
    " estimated_delivery_time timestamp_ntz, status string"
)
USERS = (
    "user_id int, full_name string, email string, phone_number string, address string, role string,"
    " created_at timestamp_ntz"
)
DAY = datetime(2024, 3, 1, 8)


def frames(spark):
    users = spark.createDataFrame(
        [(7, "G", "g@x", "1", "a", "user", DAY), (3, "C", None, None, None, "driver", None)], USERS
    )
    orders = spark.createDataFrame(
        [
            (20, 7, " A, B, C ", "X", "p", 1.5, datetime(2024, 3, 1, 9, 30, 30), "delivered", DAY),
            (10, 3, "X", "A, B, C", "p", 2.5, None, "processing", DAY),
            (30, 99, None, "Y, Z", "p", None, DAY, "delivered", None),
        ],
        ORDERS,
    )
    payments = spark.createDataFrame(
        [
            (1, 20, 10.1, "e_wallet", "completed", datetime(2024, 3, 2)),
            (2, 20, 20.2, "cash", "pending", None),
            (3, 20, 30.3, "credit_card", "failed", datetime(2024, 3, 2)),
            (4, 77, 5.0, "cash", "pending", None),
        ],
        PAYMENTS,
    )
    drivers = spark.createDataFrame(
        [(2, 3, "P2", "car", 2020), (1, 3, "P1", "bike", 2021), (5, 50, "P5", "car", 2022)],
        "driver_id int, user_id int, vehicle_license_plate string, vehicle_type string, vehicle_year int",
    )
    shipments = spark.createDataFrame(
        [
            (100, 20, 2, "X", datetime(2024, 12, 26, 9, 0, 30), "completed"),
            (101, 10, 5, "Q", None, "in_transit"),
            (102, 55, None, None, datetime(2025, 1, 1), "assigned"),
        ],
        SHIPMENTS,
    )
    return users, orders, payments, drivers, shipments


def test_dimensions(spark, as_of, rows):
    users, orders, _, drivers, shipments = frames(spark)
    user = dim_user(users, as_of)
    assert user.columns[0] == "user_key"
    got = rows(user.select("user_key", "user_id", "is_active", "effective_start_date", "effective_end_date"))
    assert got == [(1, 3, True, date(2024, 12, 26), date(9999, 12, 31)), (2, 7, True, date(2024, 3, 1), date(9999, 12, 31))]
    driver = dim_driver(drivers, user, as_of)
    assert rows(driver.select("driver_key", "driver_id", "user_key", "full_name")) == [(1, 1, 1, "C"), (2, 2, 1, "C")]
    place = dim_location(orders, as_of)
    assert rows(place.select("location_key", "full_address", "city")) == [
        (1, None, None),
        (2, "A, B, C", "B"),
        (3, "X", None),
        (4, "Y, Z", None),
    ]
    assert dim_location(orders, as_of, shipments=shipments).count() == 5
    assert dim_payment_method(spark).count() == 3


def test_location_needs_orders_only(spark, as_of):
    _, orders, _, _, shipments = frames(spark)
    assert dim_location(orders, as_of, shipments=shipments.limit(0)).count() == 4


@pytest.mark.parametrize(
    ("policy", "expected"),
    [
        ("all", [(1, 10, None, None), (2, 20, 10.1, "completed"), (3, 20, 20.2, "pending"), (4, 20, 30.3, "failed"), (5, 30, None, None)]),
        ("latest", [(1, 10, None, None), (2, 20, 30.3, "failed"), (3, 30, None, None)]),
        ("sum", [(1, 10, None, None), (2, 20, 60.6, "failed"), (3, 30, None, None)]),
    ],
)
def test_payment_policies(spark, as_of, rows, policy, expected):
    users, orders, payments, _, _ = frames(spark)
    fact = fact_orders(orders, payments, dim_user(users, as_of), dim_location(orders, as_of), as_of, "me", policy)
    assert rows(fact.select("order_key", "order_id", "order_amount", "payment_status")) == expected


def test_fact_orders_lookups(spark, as_of, rows):
    users, orders, payments, _, _ = frames(spark)
    fact = fact_orders(
        orders,
        payments,
        dim_user(users, as_of),
        dim_location(orders, as_of),
        as_of,
        "me",
        "latest",
        dim_payment_method(spark),
    )
    got = rows(
        fact.select(
            "order_id",
            "user_key",
            "order_date_key",
            "pickup_location_key",
            "delivery_location_key",
            "payment_method_key",
            "delivery_duration_minutes",
        )
    )
    assert got == [
        (10, 1, 20240301, 3, 2, None, None),
        (20, 2, 20240301, 2, 3, 1, 91),
        (30, None, None, None, 4, None, None),
    ]
    assert fact.select("etl_timestamp", "etl_user").distinct().collect() == [(as_of, "me")]
    with pytest.raises(ValueError):
        fact_orders(orders, payments, dim_user(users, as_of), dim_location(orders, as_of), as_of, "me", "first")


def test_shipment_tracking(spark, as_of, rows):
    users, orders, payments, drivers, shipments = frames(spark)
    user, place = dim_user(users, as_of), dim_location(orders, as_of)
    fact = fact_orders(orders, payments, user, place, as_of, "me", "latest")
    tracking = fact_shipment_tracking(shipments, fact, dim_driver(drivers, user, as_of), as_of, "me", place)
    columns = ["tracking_key", "shipment_id", "order_key", "driver_key", "date_key", "current_location_key"]
    assert rows(tracking.select(*columns, "elapsed_time_minutes")) == [
        (1, 100, 2, 2, 20241226, 3, 60),
        (2, 101, 1, None, None, None, None),
        (3, 102, None, None, 20250101, None, -8040),
    ]


def test_empty_sources(spark, as_of):
    users, orders, payments, drivers, shipments = [f.limit(0) for f in frames(spark)]
    user, place = dim_user(users, as_of), dim_location(orders, as_of)
    fact = fact_orders(orders, payments, user, place, as_of, "me")
    tracking = fact_shipment_tracking(shipments, fact, dim_driver(drivers, user, as_of), as_of, "me")
    assert fact.count() == tracking.count() == place.count() == 0


def test_busy_order_is_spread(spark, as_of):
    """One order with a third of all payments gives every pair exactly once."""
    users, orders, _, _, _ = frames(spark)
    many = spark.range(3000).select(
        F.col("id").cast("int").alias("payment_id"),
        F.when(F.col("id") % 3 == 0, 20).otherwise(1000 + F.col("id")).cast("int").alias("order_id"),
        F.lit(1.0).alias("amount"),
        F.lit("cash").alias("payment_method"),
        F.lit("pending").alias("payment_status"),
        F.lit(None).cast("timestamp_ntz").alias("payment_date"),
    )
    fact = fact_orders(orders, many, dim_user(users, as_of), dim_location(orders, as_of), as_of, "me")
    assert fact.count() == 1002
    assert fact.select("order_key").distinct().count() == 1002


def test_database_load_stages_dimensions_then_appends_facts(spark, as_of):
    """Tables reach the writer by name, in declared types, dimensions first; the writer is stood in for."""
    users, orders, payments, drivers, shipments = frames(spark)
    user, place = dim_user(users, as_of), dim_location(orders, as_of)
    fact = fact_orders(orders, payments, user, place, as_of, "me", "latest").filter("user_key IS NOT NULL")
    written = []

    class Target:
        def stage(self, df, table):
            written.append((table, df.dtypes[0], df.count()))

        def append(self, df, table, partitions):
            written.append((table, df.dtypes[7], partitions))

    load_database(Target(), {"user": user, "location": place}, {"orders": fact})
    assert written == [
        ("dim_user", ("user_key", "int"), 2),
        ("dim_location", ("location_key", "int"), 4),
        ("fact_orders", ("order_amount", "decimal(10,2)"), ROWS_PER_PARTITION),
    ]
