"""Declared columns of the warehouse tables."""

from __future__ import annotations

from cargoloom.operators.quality import ColumnRule


def _columns(text: str, primary_key: str, required: tuple[str, ...] = ()) -> tuple[ColumnRule, ...]:
    pairs = [line.split(None, 1) for line in text.strip().splitlines()]
    return tuple(
        ColumnRule(name, kind.strip(), name not in (*required, primary_key), name == primary_key)
        for name, kind in pairs
    )


# Names, types, keys and required columns of the warehouse tables.
DIM_DATE = _columns(
    """
    date_key int
    full_date date
    day_of_week varchar(20)
    day_of_month int
    month int
    quarter int
    year int
    is_weekend boolean
    is_holiday boolean
    """,
    "date_key",
    ("full_date",),
)
DIM_USER = _columns(
    """
    user_key int
    user_id int
    full_name varchar(255)
    email varchar(255)
    phone_number varchar(50)
    address varchar(255)
    role varchar(50)
    created_at timestamp_ntz
    is_active boolean
    effective_start_date date
    effective_end_date date
    """,
    "user_key",
    ("user_id",),
)
DIM_DRIVER = _columns(
    """
    driver_key int
    driver_id int
    user_key int
    full_name varchar(255)
    vehicle_license_plate varchar(50)
    vehicle_type varchar(50)
    vehicle_year int
    is_active boolean
    effective_start_date date
    effective_end_date date
    """,
    "driver_key",
    ("driver_id", "user_key"),
)
DIM_LOCATION = _columns(
    """
    location_key int
    full_address varchar(255)
    city varchar(100)
    district varchar(100)
    effective_start_date date
    effective_end_date date
    """,
    "location_key",
    ("full_address",),
)
DIM_PAYMENT_METHOD = _columns(
    """
    payment_method_key int
    payment_method varchar(50)
    payment_method_category varchar(100)
    """,
    "payment_method_key",
    ("payment_method",),
)
FACT_ORDERS = _columns(
    """
    order_key bigint
    order_id int
    user_key int
    order_date_key int
    pickup_location_key int
    delivery_location_key int
    package_weight decimal(10,2)
    order_amount decimal(10,2)
    delivery_duration_minutes int
    order_status varchar(50)
    payment_status varchar(50)
    order_created_at timestamp_ntz
    order_completed_at timestamp_ntz
    etl_timestamp timestamp_ntz
    etl_user varchar(50)
    """,
    "order_key",
    ("order_id", "user_key"),
)
FACT_SHIPMENT_TRACKING = _columns(
    """
    tracking_key bigint
    shipment_id int
    order_key bigint
    driver_key int
    date_key int
    status varchar(50)
    tracking_timestamp timestamp_ntz
    current_location varchar(255)
    elapsed_time_minutes int
    etl_timestamp timestamp_ntz
    etl_user varchar(50)
    """,
    "tracking_key",
    ("shipment_id",),
)

TABLES = {
    "dim_date": DIM_DATE,
    "dim_user": DIM_USER,
    "dim_driver": DIM_DRIVER,
    "dim_location": DIM_LOCATION,
    "dim_payment_method": DIM_PAYMENT_METHOD,
    "fact_orders": FACT_ORDERS,
    "fact_shipment_tracking": FACT_SHIPMENT_TRACKING,
}

# Foreign keys as (column, referenced table, its key).
FOREIGN_KEYS = {
    "dim_driver": (("user_key", "dim_user", "user_key"),),
    "fact_orders": (
        ("user_key", "dim_user", "user_key"),
        ("order_date_key", "dim_date", "date_key"),
        ("pickup_location_key", "dim_location", "location_key"),
        ("delivery_location_key", "dim_location", "location_key"),
    ),
    "fact_shipment_tracking": (
        ("order_key", "fact_orders", "order_key"),
        ("driver_key", "dim_driver", "driver_key"),
        ("date_key", "dim_date", "date_key"),
    ),
}


def foreign_key_columns(table: str) -> tuple[str, ...]:
    return tuple(column for column, _, _ in FOREIGN_KEYS.get(table, ()))
