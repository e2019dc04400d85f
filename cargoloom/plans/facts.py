"""The fact tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargoloom.functions.dates import date_key, minutes_between
from cargoloom.functions.moments import moment
from cargoloom.operators.joins import fan_out_left_join
from cargoloom.operators.keys import KnownKeys, dense_keys, fan_out_keys, numbered_copies, stable_keys, stable_keys_by
from cargoloom.session import stored_frame

PAYMENT_POLICIES = ("all", "latest", "sum")
ORDER_FACT_KEY = ("order_id", "order_copy", "payment_id", "payment_copy")


def audit_columns(as_of: datetime, etl_user: str) -> dict[str, Column]:
    return {"etl_timestamp": moment(as_of), "etl_user": F.lit(etl_user)}


def payments_per_order(payments: DataFrame, policy: str = "all") -> DataFrame:
    """Payments at the grain the order facts shall have.

    ``all`` keeps every payment, ``latest`` the one paid last (a missing date comes
    first, ties go to the higher payment id), ``sum`` the exact total amount with the
    latest payment's method and status. The last two merge a busy order's payments
    before the shuffle.
    """
    if policy not in PAYMENT_POLICIES:
        raise ValueError(f"payment policy must be one of {PAYMENT_POLICIES}, not {policy!r}")
    kept = ["payment_id", "amount", "payment_method", "payment_status"]
    if policy == "all":
        return payments.select("order_id", *kept, *[c for c in ("payment_copy",) if c in payments.columns])
    latest = F.max_by(F.struct(*kept), F.struct("payment_date", "payment_id")).alias("latest")
    total = F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("total")
    merged = payments.groupBy("order_id").agg(latest, total)
    return merged.select(
        "order_id",
        "latest.payment_id",
        (F.col("total") if policy == "sum" else F.col("latest.amount")).alias("amount"),
        "latest.payment_method",
        "latest.payment_status",
    )


def orders_with_payments(orders: DataFrame, payments: DataFrame, policy: str = "all") -> DataFrame:
    billed = payments_per_order(payments, policy)
    if policy == "all":
        return fan_out_left_join(orders, billed, "order_id", spread_by=["payment_id"])
    return orders.join(billed, "order_id", "left")


def fact_orders(
    orders: DataFrame,
    payments: DataFrame,
    dim_user: DataFrame,
    dim_location: DataFrame,
    as_of: datetime,
    etl_user: str,
    payment_policy: str = "all",
    dim_payment_method: DataFrame | None = None,
    known_keys: KnownKeys | None = None,
    with_natural_key: bool = False,
    stored: bool = True,
) -> DataFrame:
    """One row per order and payment (or per order, see ``payments_per_order``).

    The lookups are left joins on keys that are unique in the dimension, so Catalyst
    broadcasts a dimension whose measured size allows it and otherwise sorts and
    merges, and adaptive execution splits a busy user's or address's order rows. They
    come before the payments, while there is one row per order. With
    ``dim_payment_method`` the method's key is looked up as well. Keys are
    those of ``known_keys`` for a fact known there, and follow the highest for others. What tells facts apart is
    ``ORDER_FACT_KEY``: the order and, under ``all``, its payment, each with a number among source rows of one id. Under ``latest`` and
    ``sum`` the grain is the order, so a later payment doesn't move its key. ``with_natural_key`` keeps those columns, to save keys. The facts are read from
    the work folder; without ``stored`` (where no keys are kept) those of several payments are joined as they are read, for a
    caller that reads them once.
    """
    stable = known_keys is not None or with_natural_key
    if stable:
        orders = numbered_copies(orders, ["order_id"], "order_copy")
        payments = numbered_copies(payments, ["order_id", "payment_id"], "payment_copy") if payment_policy == "all" else payments
    places = dim_location.select("full_address", "location_key")
    placed = (
        orders.select(
            "order_id",
            "user_id",
            F.trim("pickup_address").alias("pickup_address"),
            F.trim("delivery_address").alias("delivery_address"),
            "package_weight",
            "delivery_time",
            "status",
            "created_at",
            *(["order_copy"] if stable else []),
        )
        .join(dim_user.select("user_id", "user_key"), "user_id", "left")
        .join(places.toDF("pickup_address", "pickup_location_key"), "pickup_address", "left")
        .join(places.toDF("delivery_address", "delivery_location_key"), "delivery_address", "left")
        .drop("user_id", "pickup_address", "delivery_address")
    )
    fanned = payment_policy == "all" and not stable
    if fanned:
        # Both ids make the order total: an order's payments take the numbers from its own on.
        rows = fan_out_keys(placed, payments_per_order(payments), "order_id", "order_id", "payment_id", "order_key")
    else:
        rows = orders_with_payments(placed, payments, payment_policy)
    method_key = []
    if dim_payment_method is not None:
        methods = dim_payment_method.select("payment_method", "payment_method_key")
        rows = rows.join(methods, "payment_method", "left")
        method_key = ["payment_method_key"]

    columns = [
        "order_id",
        "user_key",
        "order_date_key",
        "pickup_location_key",
        "delivery_location_key",
        *method_key,
        "package_weight",
        "order_amount",
        "delivery_duration_minutes",
        "order_status",
        "payment_status",
        "order_created_at",
        "order_completed_at",
    ]
    # What is computed of the times comes last: the rows are joined and sorted without it.
    shaped = rows.select(
        *[c for c in columns if c in rows.columns],
        F.col("amount").alias("order_amount"),
        F.col("status").alias("order_status"),
        F.col("created_at").alias("order_created_at"),
        F.col("delivery_time").alias("order_completed_at"),
        "payment_id",
        *([c for c in ("order_key", "order_copy", "payment_copy") if c in rows.columns]),
    )
    # The payment id makes the order total where an order has several payments.
    natural = ["order_id", "payment_id"]
    if stable:
        by_payment = payment_policy == "all"
        no = F.lit(None).cast("long")
        shaped = shaped.withColumns(
            {
                "payment_id": F.col("payment_id") if by_payment else F.lit(None).cast(shaped.schema["payment_id"].dataType),
                "payment_copy": F.coalesce(F.col("payment_copy"), F.lit(0)) if by_payment else no,
            }
        )
        natural = list(ORDER_FACT_KEY)
    numbered = shaped if fanned else keyed_facts(shaped, natural, "order_key", known_keys)
    if fanned and stored:
        numbered = stored_frame(numbered.drop("payment_id"), "order-facts")
    last = [c for c in ORDER_FACT_KEY if c != "order_id"] if with_natural_key else []
    timed = numbered.withColumns(
        {
            "order_date_key": date_key("order_created_at"),
            "delivery_duration_minutes": minutes_between("order_created_at", "order_completed_at"),
        }
    )
    return timed.select("order_key", *[c for c in columns if c in timed.columns], *last).withColumns(audit_columns(as_of, etl_user))


def fact_shipment_tracking(
    shipments: DataFrame,
    fact_orders: DataFrame,
    dim_driver: DataFrame,
    as_of: datetime,
    etl_user: str,
    dim_location: DataFrame | None = None,
    known_keys: KnownKeys | None = None,
    per_order_fact: bool = False,
    with_natural_key: bool = False,
) -> DataFrame:
    """One row per shipment, with the minutes since its estimated time.

    An order with several facts (payment policy ``all``) gives the lowest ``order_key`` of them; with
    ``per_order_fact`` its shipments get one row for each. Keys are those of ``known_keys`` for a shipment known there, and
    follow the highest for others; source rows of one shipment id, or without one, are told apart by ``shipment_copy``,
    which ``with_natural_key`` keeps.

    With ``dim_location`` the key of the current location is looked up as well. The
    lookups in dimensions come first, before an order with several facts repeats rows.
    """
    wanted = ["shipment_id", "order_id", "driver_id", "estimated_delivery_time", "status", "current_location"]
    source, copy = shipments.select(*wanted), []
    if known_keys is not None or with_natural_key:
        source, copy = numbered_copies(source, ["shipment_id"], "shipment_copy"), ["shipment_copy"]
    rows = source.join(dim_driver.select("driver_id", "driver_key"), "driver_id", "left")
    location_key = []
    if dim_location is not None:
        places = dim_location.select(
            F.col("full_address").alias("__place"), F.col("location_key").alias("current_location_key")
        )
        rows = rows.join(places, F.trim("current_location") == F.col("__place"), "left").drop("__place")
        location_key = ["current_location_key"]
    facts = fact_orders.select("order_id", "order_key")
    paired = per_order_fact and not copy
    if paired:
        facts = stored_frame(facts, "keys-of-orders")
        rows = fan_out_keys(rows.drop("driver_id"), facts, "order_id", "shipment_id", "order_key", "tracking_key")
    elif per_order_fact:
        rows = fan_out_left_join(rows.drop("driver_id"), facts, "order_id", spread_by=["order_key"])
    else:
        one = facts.groupBy("order_id").agg(F.min("order_key").alias("order_key"))
        rows = rows.drop("driver_id").join(one, "order_id", "left")

    # What is computed of the time comes last: the rows are joined and sorted without it.
    kept = ["shipment_id", "order_key", "driver_key", "estimated_delivery_time", *location_key, "status", "current_location", *copy]
    shaped = rows.select(*(["tracking_key"] if paired else []), *kept)
    # A shipment keeps its key when its order arrives later.
    natural = ["shipment_id", *copy, *(["order_key"] if per_order_fact else [])]
    numbered = shaped if paired else keyed_facts(shaped, natural, "tracking_key", known_keys)
    return numbered.select(
        "tracking_key",
        "shipment_id",
        "order_key",
        "driver_key",
        date_key("estimated_delivery_time").alias("date_key"),
        *location_key,
        "status",
        moment(as_of).alias("tracking_timestamp"),
        "current_location",
        minutes_between(F.col("estimated_delivery_time"), moment(as_of)).alias("elapsed_time_minutes"),
        *(copy if with_natural_key else []),
    ).withColumns(audit_columns(as_of, etl_user))


def keyed_facts(rows: DataFrame, natural: list[str], key: str, known: KnownKeys | None) -> DataFrame:
    """Facts with a key per natural key: the known one, else the next ones in order. Nulls count as values."""
    if known is None:
        return dense_keys(rows, natural, key)
    if all(rows.schema[c].dataType == known.rows.schema[c].dataType for c in natural):
        return stable_keys_by(rows, known, natural, key)
    name = F.to_json(F.struct(*natural), {"ignoreNullFields": "false"})
    held = KnownKeys(known.rows.select(key, name.alias("__natural")), known.highest)
    kept = stable_keys(rows.withColumn("__natural", name), held, "__natural", key, natural)
    return kept.drop("__natural")
