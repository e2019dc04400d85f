"""Rules of an order's life: status steps, what follows from them, messages."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargoloom.functions.moments import moment

# The ages at which a status changes.
ACCEPT_AFTER = timedelta(minutes=30)
DISPATCH_AFTER = timedelta(hours=1)
ACCEPTED_BEFORE = timedelta(hours=2)
AGE_STEPS = (
    ("processing", timedelta(hours=2)),
    ("accepted", timedelta(hours=6)),
    ("in_transit", timedelta(hours=48)),
)
FINAL = "delivered"
CLOSED = ("delivered", "cancelled")

# Shipment status by order status.
SHIPMENT_STATUS = {"accepted": "assigned", "in_transit": "in_transit", "delivered": "completed"}

# Location texts by order status.
SORTING_CENTRE = "Trung tâm phân loại "
ON_THE_WAY = "Đang giao tại "
ARRIVED = "Đã giao thành công"

# The message sent when an order reaches a status.
STATUS_MESSAGES = {
    "processing": "Đơn hàng #%s đã được tạo và đang chờ xử lý",
    "accepted": "Đơn hàng #%s đã được xác nhận và sẽ sớm được giao",
    "in_transit": "Đơn hàng #%s đang được giao đến bạn",
    "delivered": "Đơn hàng #%s đã được giao thành công",
}

# The messages of an order's whole timeline.
CREATED_MESSAGE = "Đơn hàng #%s đã được tạo thành công"
CONFIRMED_MESSAGE = "Đơn hàng #%s đã được xác nhận và đang tìm tài xế"
MOVING_MESSAGE = "Đơn hàng #%s đang được giao đến bạn"
DELIVERED_MESSAGE = "Đơn hàng #%s đã được giao thành công"
REVIEW_MESSAGE = "Hãy đánh giá trải nghiệm giao hàng của bạn với đơn hàng #%s"


def _earlier(as_of: datetime, age: timedelta) -> Column:
    """The moment ``age`` before now: comparing creation times with it keeps the filter on a bare column."""
    return moment(as_of - age)


def next_status(
    as_of: datetime, accept_after: timedelta = ACCEPT_AFTER, dispatch_after: timedelta = DISPATCH_AFTER
) -> Column:
    """The status an order moves to now, null if it stays; one step only."""
    status, created = F.col("status"), F.col("created_at")
    return (
        F.when((status == "processing") & (created < _earlier(as_of, accept_after)), "accepted")
        .when((status == "accepted") & (created < _earlier(as_of, dispatch_after)), "in_transit")
        .when((status == "in_transit") & (F.col("delivery_time") < moment(as_of)), "delivered")
    )


def advance_status(orders: DataFrame, as_of: datetime, **thresholds: timedelta) -> DataFrame:
    """Orders with ``previous_status`` and the status after one step; closed orders stay."""
    moved = F.coalesce(next_status(as_of, **thresholds), F.col("status"))
    return orders.withColumns({"previous_status": F.col("status"), "status": moved})


def status_changes(orders: DataFrame, as_of: datetime, **thresholds: timedelta) -> DataFrame:
    """Only the orders that move now, with their ``new_status``."""
    return orders.withColumn("new_status", next_status(as_of, **thresholds)).filter(F.col("new_status").isNotNull())


def initial_status(
    as_of: datetime, fresh: timedelta = ACCEPT_AFTER, accepted_before: timedelta = ACCEPTED_BEFORE
) -> Column:
    """The status a new order starts with, from its creation and promised delivery time."""
    created = F.col("created_at")
    return (
        F.when(created.isNull(), None)
        .when(created > _earlier(as_of, fresh), "processing")
        .when(created > _earlier(as_of, accepted_before), "accepted")
        .when(F.col("delivery_time") > moment(as_of), "in_transit")
        .otherwise(FINAL)
    )


def status_by_age(as_of: datetime, steps: tuple[tuple[str, timedelta], ...] = AGE_STEPS) -> Column:
    """The status by age alone: each step holds while the order is younger than its limit."""
    status = F.when(F.col("created_at").isNull(), None)
    for name, limit in steps:
        status = status.when(F.col("created_at") > _earlier(as_of, limit), name)
    return status.otherwise(FINAL)


def shipment_status(order_status: Column | str, mapping: Mapping[str, str] = SHIPMENT_STATUS) -> Column:
    """Shipment status for an order status; null where no shipment exists yet."""
    order_status = F.col(order_status) if isinstance(order_status, str) else order_status
    result = None
    for order, shipment in mapping.items():
        hit = order_status == order
        result = F.when(hit, shipment) if result is None else result.when(hit, shipment)
    return result


def location_text(order_status: Column, centre: Column, street: Column) -> Column:
    """Where a shipment is, in words: none while processing."""
    return (
        F.when(order_status == "accepted", F.concat(F.lit(SORTING_CENTRE), centre))
        .when(order_status == "in_transit", F.concat(F.lit(ON_THE_WAY), street))
        .when(order_status == "delivered", F.lit(ARRIVED))
    )


def cascade_to_shipments(shipments: DataFrame, changes: DataFrame) -> DataFrame:
    """Shipments after the order changes: status and location follow orders now moving or delivered.

    ``changes`` holds one row per changed order (``order_id``, ``new_status``,
    ``delivery_address``); shipments of other orders stay as they are.
    """
    moved = changes.filter(F.col("new_status").isin("in_transit", "delivered")).select(
        "order_id",
        "new_status",
        location_text(F.col("new_status"), F.lit(None), F.col("delivery_address")).alias("__place"),
    )
    changed = F.col("new_status").isNotNull()
    return (
        shipments.join(moved, "order_id", "left")
        .withColumns(
            {
                "status": F.when(changed, shipment_status("new_status")).otherwise(F.col("status")),
                "current_location": F.when(changed, F.col("__place")).otherwise(F.col("current_location")),
            }
        )
        .select(*shipments.columns)
    )


def cascade_to_payments(payments: DataFrame, changes: DataFrame, as_of: datetime) -> DataFrame:
    """Payments after the order changes: those of orders now delivered are completed and dated."""
    done = changes.filter(F.col("new_status") == "delivered").select("order_id", F.lit(True).alias("__done"))
    changed = F.col("__done").isNotNull()
    return (
        payments.join(done, "order_id", "left")
        .withColumns(
            {
                "payment_status": F.when(changed, "completed").otherwise(F.col("payment_status")),
                "payment_date": F.when(changed, moment(as_of)).otherwise(F.col("payment_date")),
            }
        )
        .select(*payments.columns)
    )


def status_notifications(changes: DataFrame, as_of: datetime) -> DataFrame:
    """One message to the user of each changed order."""
    order = F.col("order_id").cast("string")
    message = None
    for status, form in STATUS_MESSAGES.items():
        hit, text = F.col("new_status") == status, F.format_string(form, order)
        message = F.when(hit, text) if message is None else message.when(hit, text)
    return changes.select(
        "order_id", "user_id", message.alias("message"), moment(as_of).alias("notification_date")
    )


def notification_timeline(
    orders: DataFrame,
    confirmed_after: timedelta = timedelta(minutes=15),
    moving_after: timedelta = timedelta(hours=2),
    review_after: timedelta = timedelta(hours=1),
) -> DataFrame:
    """All messages an order has caused by its present status, one to five per order.

    One pass: the messages are an array per row, filtered and exploded.
    """
    status, created, delivered = F.col("status"), F.col("created_at"), F.col("delivery_time")
    order = F.col("order_id").cast("string")

    def entry(due: Column, form: str, at: Column, after: timedelta = timedelta()) -> Column:
        seconds = F.make_dt_interval(secs=F.lit(after.total_seconds()))
        return F.when(
            due, F.struct(F.format_string(form, order).alias("message"), (at + seconds).alias("notification_date"))
        )

    entries = F.array(
        entry(F.lit(True), CREATED_MESSAGE, created),
        entry(status != "processing", CONFIRMED_MESSAGE, created, confirmed_after),
        entry(status.isin("in_transit", "delivered"), MOVING_MESSAGE, created, moving_after),
        entry(status == "delivered", DELIVERED_MESSAGE, delivered),
        entry(status == "delivered", REVIEW_MESSAGE, delivered, review_after),
    )
    return orders.select("order_id", "user_id", F.explode(F.array_compact(entries)).alias("entry")).select(
        "order_id", "user_id", "entry.message", "entry.notification_date"
    )


def available_drivers(drivers: DataFrame, shipments: DataFrame) -> DataFrame:
    """Drivers never assigned, or with any completed shipment; one row per driver. A missing status is not completed.

    Shipments are first reduced to one flag per driver, before they are shuffled.
    """
    seen = shipments.groupBy("driver_id").agg(F.coalesce(F.bool_or(F.col("status") == "completed"), F.lit(False)).alias("__completed"))
    free = F.col("__completed").isNull() | F.col("__completed")
    return drivers.select("driver_id").distinct().join(seen, "driver_id", "left").filter(free).select("driver_id")


def idle_drivers(drivers: DataFrame, shipments: DataFrame) -> DataFrame:
    """Drivers without any open shipment: the stricter form. A shipment with a missing status is open."""
    busy = shipments.filter(~F.col("status").eqNullSafe("completed")).select("driver_id").distinct()
    return drivers.select("driver_id").distinct().join(busy, "driver_id", "left_anti")


def active_users(users: DataFrame) -> DataFrame:
    """Ids of the users in the role ``user``, whatever padding the role was read with."""
    return users.filter(F.rtrim("role") == "user").select("user_id")
