"""The generated test tables in the shape of the logistics source tables.

Every expression is valid Spark SQL and DuckDB SQL with the same result, so a query
and its SQL check start from the same rows. ``SOURCES[name] = (from_clause, columns)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CUSTOMER_PLACE = (
    "{customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey"
)
LINE_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE))"
METHOD = (
    "CASE {0} % 4 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'e_wallet' WHEN 2 THEN 'bank_transfer' ELSE 'cash' END"
)

SOURCES: dict[str, tuple[str, dict[str, str]]] = {
    "users": (
        CUSTOMER_PLACE,
        {
            "user_id": "c_custkey",
            "full_name": "c_name",
            "email": "lower(c_name) || '@example.com'",
            "phone_number": "'+84-' || CAST(c_custkey AS STRING)",
            "address": "n_name || ', ' || r_name",
            "role": "CASE WHEN c_custkey % 20 = 0 THEN 'driver' ELSE 'user  ' END",
            "created_at": "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST('1995-01-01 06:30:00' AS {timestamp})"
            " + INTERVAL '1' DAY * CAST(c_custkey % 1000 AS INT) END",
        },
    ),
    "drivers": (
        "{supplier}",
        {
            "driver_id": "s_suppkey",
            "user_id": "s_suppkey * 20",
            "vehicle_license_plate": "'P-' || CAST(s_suppkey AS STRING)",
            "vehicle_type": "CASE s_suppkey % 3 WHEN 0 THEN 'car' WHEN 1 THEN 'bike' ELSE 'truck' END",
            "vehicle_year": "CAST(2010 + s_suppkey % 15 AS INT)",
        },
    ),
    "orders": (
        "{orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey"
        " JOIN {region} ON n_regionkey = r_regionkey",
        {
            "order_id": "o_orderkey",
            "user_id": "o_custkey",
            "pickup_address": "CASE WHEN o_orderkey % 5 = 0 THEN ' ' ELSE '' END || 'No ' ||"
            " CAST(o_orderkey % 200 AS STRING) || ', D' || CAST(o_custkey % 10 AS STRING) || ', ' || n_name",
            "delivery_address": "'No ' || CAST(o_orderkey % 150 AS STRING) || ', D' ||"
            " CAST(o_orderkey % 9 AS STRING) || ', ' || n_name || ', ' || r_name",
            "package_description": "o_orderpriority",
            "package_weight": "round(o_totalprice / 10000, 2)",
            "delivery_time": "CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderdate"
            " + INTERVAL '1' SECOND * CAST(86400 + o_orderkey % 86399 AS INT) END",
            "status": "CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'P' THEN 'in_transit' ELSE"
            " CASE WHEN o_orderkey % 2 = 0 THEN 'processing' ELSE 'accepted' END END",
            "created_at": "o_orderdate",
        },
    ),
    # Orders without a stated priority are not billed: the misses of the payments join.
    "payments": (
        "{orders} WHERE o_orderpriority <> '4-NOT SPECIFIED'",
        {
            "payment_id": "o_orderkey",
            "order_id": "o_orderkey",
            "amount": "o_totalprice",
            "payment_method": METHOD.format("o_orderkey"),
            "payment_status": "CASE WHEN o_orderstatus = 'F' THEN 'completed' ELSE 'pending' END",
            "payment_date": "CASE WHEN o_orderstatus = 'F' THEN o_orderdate END",
        },
    ),
    # Several payments per order.
    "instalments": (
        "{lineitem}",
        {
            "payment_id": LINE_ID,
            "order_id": "l_orderkey",
            "amount": "l_extendedprice",
            "payment_method": METHOD.format("l_partkey"),
            "payment_status": "CASE WHEN l_linestatus = 'F' THEN 'completed' ELSE 'pending' END",
            "payment_date": "CASE WHEN l_linestatus = 'F' THEN l_shipdate END",
        },
    ),
    "shipments": (
        "{lineitem}",
        {
            "shipment_id": LINE_ID,
            "order_id": "l_orderkey",
            "driver_id": "l_suppkey",
            "current_location": "l_returnflag || ' hub'",
            "estimated_delivery_time": "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_shipdate END",
            "status": "CASE WHEN l_linestatus = 'F' THEN 'completed' ELSE 'in_transit' END",
        },
    ),
    "notifications": (
        "{events}",
        {
            "notification_id": "event_id",
            "user_id": "user_id",
            "message": "event_type",
            "notification_date": "ts",
        },
    ),
}

# Given schemas spare each read the job that would look them up in a file's footer.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}
TABLES = tuple(SCHEMAS)


def source_sql(name: str, dialect: str = "duckdb") -> str:
    """``SELECT`` text of one logistics table over the views named like the test tables."""
    clause, columns = SOURCES[name]
    names = {t: t for t in TABLES}
    zoneless = "TIMESTAMP" if dialect == "duckdb" else "TIMESTAMP_NTZ"
    picked = ", ".join(f"{e.format(timestamp=zoneless)} AS {c}" for c, e in columns.items())
    return f"SELECT {picked} FROM {clause.format(**names)}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One logistics table from the test tables; the frames are passed by name, no view is left behind."""
    clause, columns = SOURCES[name]
    used = [t for t in TABLES if f"{{{t}}}" in clause]
    picked = ", ".join(f"{e.format(timestamp='TIMESTAMP_NTZ')} AS {c}" for c, e in columns.items())
    return spark.sql(f"SELECT {picked} FROM {clause}", **{t: table(spark, sf_dir, t) for t in used})
