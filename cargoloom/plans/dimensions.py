"""The dimension tables.

Each builder returns one frame with the surrogate key in front. ``as_of`` stands
for "now". Pass ``known`` (the last published rows and the highest key) to keep the keys already given.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargoloom.functions.addresses import address_city, address_district
from cargoloom.functions.dates import (
    HOLIDAYS,
    calendar_days,
    date_key,
    day_name,
    is_holiday,
    is_weekend,
    open_end_date,
)
from cargoloom.functions.moments import moment_date
from cargoloom.operators.keys import KnownKeys, dense_keys, stable_keys

# The payment methods.
PAYMENT_METHODS = (
    (1, "credit_card", "Card Payment"),
    (2, "e_wallet", "Digital Payment"),
    (3, "bank_transfer", "Bank Payment"),
)


def _keyed(rows: DataFrame, natural_key: str, key: str, known: KnownKeys | None) -> DataFrame:
    if known is None:
        return dense_keys(rows, [natural_key], key)
    return stable_keys(rows, known, natural_key, key)


def dim_date(spark: SparkSession, start: date, end: date, holidays: tuple[str, ...] = HOLIDAYS) -> DataFrame:
    day = F.col("full_date")
    return calendar_days(spark, start, end).select(
        date_key(day).alias("date_key"),
        day,
        day_name(day).alias("day_of_week"),
        F.dayofmonth(day).alias("day_of_month"),
        F.month(day).alias("month"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        is_weekend(day).alias("is_weekend"),
        is_holiday(day, holidays).alias("is_holiday"),
    )


def dim_date_covering(df: DataFrame, column: str) -> DataFrame:
    """Every day from the earliest to the latest value of a column; one row reaches the driver."""
    first, last = df.agg(F.min(column).cast("date"), F.max(column).cast("date")).first()
    if first is None:
        first, last = date(1970, 1, 2), date(1970, 1, 1)  # reversed: no day
    return dim_date(df.sparkSession, first, last)


def dim_user(users: DataFrame, as_of: datetime, known: KnownKeys | None = None) -> DataFrame:
    rows = users.select(
        "user_id",
        "full_name",
        "email",
        "phone_number",
        "address",
        "role",
        "created_at",
        F.lit(True).alias("is_active"),
        F.coalesce(F.col("created_at").cast("date"), moment_date(as_of)).alias("effective_start_date"),
        open_end_date().alias("effective_end_date"),
    )
    return _keyed(rows, "user_id", "user_key", known)


def dim_driver(
    drivers: DataFrame, users: DataFrame, as_of: datetime, known: KnownKeys | None = None
) -> DataFrame:
    """Drivers with the key and name of their user (``users`` is dim_user); drivers without one are left out."""
    rows = drivers.join(users.select("user_id", "user_key", "full_name"), "user_id").select(
        "driver_id",
        "user_key",
        "full_name",
        "vehicle_license_plate",
        "vehicle_type",
        "vehicle_year",
        F.lit(True).alias("is_active"),
        moment_date(as_of).alias("effective_start_date"),
        open_end_date().alias("effective_end_date"),
    )
    return _keyed(rows, "driver_id", "driver_key", known)


def distinct_addresses(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The set union of several address columns, blanks trimmed: one scan, one shuffle of distinct values."""
    address = F.explode(F.array(*[F.trim(c) for c in columns]))
    return df.select(address.alias("full_address")).distinct()


def dim_location(
    orders: DataFrame,
    as_of: datetime,
    known: KnownKeys | None = None,
    shipments: DataFrame | None = None,
    layout: str = "default",
) -> DataFrame:
    """One row per distinct pickup or delivery address, with shipments also per current location."""
    addresses = distinct_addresses(orders, ("pickup_address", "delivery_address"))
    if shipments is not None:
        addresses = addresses.unionByName(distinct_addresses(shipments, ("current_location",))).distinct()
    rows = addresses.select(
        "full_address",
        address_city("full_address", layout).alias("city"),
        address_district("full_address", layout).alias("district"),
        moment_date(as_of).alias("effective_start_date"),
        open_end_date().alias("effective_end_date"),
    )
    return _keyed(rows, "full_address", "location_key", known)


def dim_payment_method(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        PAYMENT_METHODS,
        "payment_method_key int, payment_method string, payment_method_category string",
    )
