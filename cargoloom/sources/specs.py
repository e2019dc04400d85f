"""What to ingest: one spec per source table."""

from __future__ import annotations

from dataclasses import dataclass


#: Rows that one task reads from or writes to a database.
ROWS_PER_PARTITION = 1_000_000


@dataclass(frozen=True)
class TableSpec:
    """``date_partitions`` become ``<column>_partition`` days; ``partitions`` partition the files as they are.

    A table with few rows per day gets larger files with a coarser ``partition_format``,
    such as ``yyyy-MM``. ``source_table`` is its name in the source database. ``padded`` names the
    fixed-width text columns, whose trailing blanks are dropped at landing; other texts land as they are. ``key`` is what a
    source row is told by when it comes again. ``even_ranges`` reads ranges of equal row counts, for a key with gaps.
    """

    name: str
    partition_column: str | None = None
    incremental_column: str | None = None
    date_partitions: tuple[str, ...] = ()
    partitions: tuple[str, ...] = ()
    partition_format: str = "yyyy-MM-dd"
    source_table: str = ""
    padded: tuple[str, ...] = ()
    rows_per_partition: int = ROWS_PER_PARTITION
    key: str = ""
    even_ranges: bool = False


# The six source tables with their read keys, marks and file partitions.
LOGISTICS_TABLES = (
    TableSpec("orders", "order_id", "created_at", ("created_at",), ("status",), source_table="Orders", key="order_id"),
    TableSpec("shipments", "shipment_id", None, (), ("status",), source_table="Shipments", key="shipment_id"),
    TableSpec("payments", "payment_id", "payment_date", ("payment_date",), ("payment_status",), source_table="Payments", key="payment_id"),
    TableSpec("notifications", "notification_id", "notification_date", ("notification_date",), source_table="Notifications", key="notification_id"),
    TableSpec("users", None, "created_at", source_table="Users", padded=("role",), key="user_id"),
    TableSpec("drivers", source_table="Drivers", key="driver_id"),
)
