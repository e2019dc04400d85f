"""Independent SQL for the registered queries, for DuckDB over views named like the test tables."""

from __future__ import annotations

from cargoloom.adapters import source_sql
from cargoloom.plans.warehouse_schema import TABLES

# Fixed values, written out so that the SQL does not take them from the code it checks: accented letters, their plain ones.
ACCENTED = (
    "đĐàáãảạăằắẵẳặâầấẫẩậèéẽẻẹêềếễểệìíĩỉịòóõỏọôồốỗổộơờớỡởợùúũủụưừứữửựỳ"
    "ýỹỷỵÀÁÃẢẠĂẰẮẴẲẶÂẦẤẪẨẬÈÉẼẺẸÊỀẾỄỂỆÌÍĨỈỊÒÓÕỎỌÔỒỐỖỔỘƠỜỚỠỞỢÙÚŨỦỤƯỪỨỮỬ"
    "ỰỲÝỸỶỴ"
)
FOLDED = (
    "dDaaaaaaaaaaaaaaaaaeeeeeeeeeeeiiiiiooooooooooooooooouuuuuuuuuuuy"
    "yyyyAAAAAAAAAAAAAAAAAEEEEEEEEEEEIIIIIOOOOOOOOOOOOOOOOOUUUUUUUUUU"
    "UYYYYY"
)

AS_OF = "TIMESTAMP '2001-08-02 09:30:00'"
LIFE_AS_OF = "TIMESTAMP '1998-06-01 12:00:00'"
AUDIT = f"{AS_OF} AS etl_timestamp, 'etl' AS etl_user"
OPEN = "DATE '2001-08-02' AS effective_start_date, DATE '9999-12-31' AS effective_end_date"
CITY = r"nullif(regexp_extract({0}, ',\s*([^,]+),\s*[^,]+$', 1), '')"
DISTRICT = r"nullif(regexp_extract({0}, ',\s*([^,]+),\s*[^,]+,', 1), '')"
DATE_KEY = "CAST(strftime({0}, '%Y%m%d') AS INTEGER)"
MINUTES = "CAST(round((floor(epoch({1})) - floor(epoch({0}))) / 60) AS BIGINT)"


def _sources(*names: str) -> dict[str, str]:
    return {f"s_{n}": source_sql(n) for n in names}


DIM_USER = {
    **_sources("users"),
    "d_user": f"""SELECT row_number() OVER (ORDER BY user_id) AS user_key,
        user_id, full_name, email, phone_number, address, rtrim(role) AS role, created_at, true AS is_active,
        coalesce(CAST(created_at AS DATE), DATE '2001-08-02') AS effective_start_date,
        DATE '9999-12-31' AS effective_end_date FROM s_users""",
}
DIM_DRIVER = {
    **DIM_USER,
    **_sources("drivers"),
    "d_driver": f"""SELECT row_number() OVER (ORDER BY driver_id) AS driver_key, driver_id, user_key, full_name,
        vehicle_license_plate, vehicle_type, vehicle_year, true AS is_active, {OPEN}
        FROM s_drivers JOIN d_user USING (user_id)""",
}
ADDRESSES = "SELECT trim(pickup_address) AS full_address FROM s_orders UNION SELECT trim(delivery_address) FROM s_orders"


# What is known of every user on every day, a row only where it differs from the day before, each up to the next.
HISTORY = {
    **_sources("users"),
    "states": """SELECT user_id, full_name, DATE '1995-01-01' AS day, user_id % 10 <> 0 AS there, address FROM s_users
        UNION ALL SELECT user_id, full_name, DATE '1996-07-01', true,
            CASE WHEN user_id % 4 = 0 THEN address || ' 2' ELSE address END FROM s_users
        UNION ALL SELECT user_id, full_name, DATE '1998-01-01', user_id % 11 <> 0,
            CASE WHEN user_id % 6 = 0 THEN address || ' 3' WHEN user_id % 4 = 0 THEN address || ' 2' ELSE address END FROM s_users""",
    "told": """SELECT *, lag(there, 1, false) OVER w AS was_there, lag(address) OVER w AS was FROM states
        WINDOW w AS (PARTITION BY user_id ORDER BY day)""",
    "history": """SELECT user_id, full_name, address, effective_end_date = DATE '9999-12-31' AS is_active, effective_start_date, effective_end_date
        FROM (SELECT *, day AS effective_start_date, lead(day, 1, DATE '9999-12-31') OVER (PARTITION BY user_id ORDER BY day) AS effective_end_date
            FROM told WHERE there <> was_there OR (there AND address <> was)) x WHERE there""",
}


def _dim_location(addresses: str = ADDRESSES) -> str:
    return f"""SELECT row_number() OVER (ORDER BY full_address) AS location_key, full_address,
        {CITY.format("full_address")} AS city, {DISTRICT.format("full_address")} AS district, {OPEN}
        FROM ({addresses}) a"""


DIM_LOCATION = {**_sources("orders"), "d_location": _dim_location()}
HUBS = f"{ADDRESSES} UNION SELECT trim(current_location) FROM s_shipments"


def _fact_orders(paid: str, method: str = "", method_join: str = "") -> str:
    return f"""SELECT row_number() OVER (ORDER BY o.order_id NULLS FIRST, p.payment_id NULLS FIRST) AS order_key,
        o.order_id, u.user_key, {DATE_KEY.format("o.created_at")} AS order_date_key,
        pl.location_key AS pickup_location_key, dl.location_key AS delivery_location_key, {method}
        o.package_weight, p.amount AS order_amount,
        {MINUTES.format("o.created_at", "o.delivery_time")} AS delivery_duration_minutes,
        o.status AS order_status, p.payment_status, o.created_at AS order_created_at,
        o.delivery_time AS order_completed_at, {AUDIT}
        FROM s_orders o LEFT JOIN {paid} p ON o.order_id = p.order_id
        LEFT JOIN d_user u ON o.user_id = u.user_id
        LEFT JOIN d_location pl ON trim(o.pickup_address) = pl.full_address
        LEFT JOIN d_location dl ON trim(o.delivery_address) = dl.full_address {method_join}"""


STAR = {**DIM_USER, **DIM_LOCATION}
ORDERS_FACT = {**STAR, **_sources("payments"), "f_orders": _fact_orders("s_payments")}
METHODS = (
    "(VALUES (1, 'credit_card', 'Card Payment'), (2, 'e_wallet', 'Digital Payment'),"
    " (3, 'bank_transfer', 'Bank Payment')) m(payment_method_key, payment_method, payment_method_category)"
)
LATEST = """SELECT order_id, payment_id, {amount} AS amount, payment_method, payment_status FROM (
        SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY payment_date DESC NULLS LAST, payment_id DESC) AS rn,
        CAST(sum(CAST(amount AS DECIMAL(18, 2))) OVER (PARTITION BY order_id) AS DOUBLE) AS total
        FROM s_instalments) r WHERE rn = 1"""


def _tracking(location: str = "", location_join: str = "", orders: str = "f_orders") -> str:
    return f"""SELECT row_number() OVER (ORDER BY s.shipment_id, o.order_key NULLS FIRST) AS tracking_key, s.shipment_id,
        o.order_key, d.driver_key, {DATE_KEY.format("s.estimated_delivery_time")} AS date_key, {location}
        s.status, {AS_OF} AS tracking_timestamp, s.current_location,
        {MINUTES.format("s.estimated_delivery_time", AS_OF)} AS elapsed_time_minutes, {AUDIT}
        FROM s_shipments s LEFT JOIN {orders} o ON s.order_id = o.order_id
        LEFT JOIN d_driver d ON s.driver_id = d.driver_id {location_join}"""


TRACKING_FACT = {**ORDERS_FACT, **DIM_DRIVER, **_sources("shipments"), "f_tracking": _tracking()}

INSTALMENT_FACT = {
    **STAR,
    **_sources("instalments", "shipments"),
    "f_orders": _fact_orders("s_instalments"),
    **DIM_DRIVER,
}


def sql(final: str, *parts: dict[str, str]) -> str:
    """``final`` with the named steps in front of it."""
    steps = {name: text for part in parts for name, text in part.items()}
    if not steps:
        return final
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in steps.items()) + "\n" + final


def _check(table: str, name: str, value: str, passed: str, relation: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{name}' AS check_name, CAST({value} AS BIGINT) AS value,"
        f" {passed.format(value)} AS passed FROM {relation}"
    )


ZERO, POSITIVE, ANY = "({0}) = 0", "({0}) > 0", "true"


def _key_checks(table: str, relation: str, key: str) -> list[str]:
    per_key = f"(SELECT {key} AS k, count(*) AS n FROM {relation} GROUP BY 1) g"
    return [
        _check(table, "row_count", "coalesce(sum(n), 0)", POSITIVE, per_key),
        _check(table, "missing_key_column", "0", ZERO, "(SELECT 1) x"),
        _check(table, "null_keys", "coalesce(sum(n) FILTER (WHERE k IS NULL), 0)", ZERO, per_key),
        _check(table, "distinct_keys", "count(*)", ANY, per_key),
        _check(table, "duplicate_keys", "count(*) FILTER (WHERE n > 1)", ZERO, per_key),
    ]


def _null_checks(table: str, relation: str, keys: list[str]) -> list[str]:
    nulls = {k: f"count(*) FILTER (WHERE {k} IS NULL)" for k in keys}
    checks = [_check(table, f"null_{k}", v, ZERO, relation) for k, v in nulls.items()]
    return [*checks, _check(table, "null_keys", " + ".join(nulls.values()), ZERO, relation)]


def _fact_checks(table: str, relation: str, keys: list[str]) -> list[str]:
    """The null checks of all keys, and repeats of the first, the table's own."""
    per_key = f"(SELECT {keys[0]} AS k, count(*) AS n FROM {relation} GROUP BY 1) g"
    repeated = _check(table, "duplicate_keys", "count(*) FILTER (WHERE n > 1)", ZERO, per_key)
    return [*_null_checks(table, relation, keys), repeated]


def _union(parts: list[str]) -> str:
    return "\nUNION ALL ".join(parts)


def _orphans(table: str, relation: str, fk: str, dim: str, pk: str) -> str:
    lost = f"{relation} f WHERE {fk} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{pk} = f.{fk})"
    return _check(table, f"orphans_{fk}", "count(*)", ZERO, lost)


FACT_ORDER_KEYS = ["order_key", "user_key", "order_date_key", "pickup_location_key", "delivery_location_key"]
TRACKING_KEYS = ["tracking_key", "order_key", "driver_key", "date_key"]
DIM_CHECKS = [
    *_key_checks("dim_user", "d_user", "user_key"),
    *_key_checks("dim_driver", "d_driver", "driver_key"),
    *_key_checks("dim_location", "d_location", "location_key"),
]

NEXT_STATUS = f"""CASE WHEN status = 'processing' AND {LIFE_AS_OF} - created_at > INTERVAL 30 MINUTE THEN 'accepted'
    WHEN status = 'accepted' AND {LIFE_AS_OF} - created_at > INTERVAL 1 HOUR THEN 'in_transit'
    WHEN status = 'in_transit' AND {LIFE_AS_OF} > delivery_time THEN 'delivered' END"""
CHANGES = {
    **_sources("orders"),
    "changes": f"SELECT * FROM (SELECT *, {NEXT_STATUS} AS new_status FROM s_orders) n WHERE new_status IS NOT NULL",
}
BY_AGE = f"""CASE WHEN {AS_OF} - created_at < INTERVAL 100 DAY THEN 'processing'
    WHEN {AS_OF} - created_at < INTERVAL 300 DAY THEN 'accepted'
    WHEN {AS_OF} - created_at < INTERVAL 900 DAY THEN 'in_transit' ELSE 'delivered' END"""


def _message(form: str) -> str:
    before, after = form.split("%s")
    return f"'{before}' || CAST(order_id AS VARCHAR) || '{after}'"


def _timeline() -> str:
    rows = [
        ("Đơn hàng #%s đã được tạo thành công", "created_at", "true"),
        ("Đơn hàng #%s đã được xác nhận và đang tìm tài xế", "created_at + INTERVAL 15 MINUTE", "status <> 'processing'"),
        ("Đơn hàng #%s đang được giao đến bạn", "created_at + INTERVAL 2 HOUR", "status IN ('in_transit', 'delivered')"),
        ("Đơn hàng #%s đã được giao thành công", "delivery_time", "status = 'delivered'"),
        ("Hãy đánh giá trải nghiệm giao hàng của bạn với đơn hàng #%s", "delivery_time + INTERVAL 1 HOUR", "status = 'delivered'"),
    ]
    return _union(
        [
            f"SELECT order_id, user_id, {_message(form)} AS message, {at} AS notification_date FROM s_orders WHERE {due}"
            for form, at, due in rows
        ]
    )


def _bounds(table: str, key: str) -> str:
    return f"""SELECT '{table}' AS table_name, CAST(min({key}) AS BIGINT) AS min_id, CAST(max({key}) AS BIGINT) AS max_id,
        count(*) AS total_count,
        CAST(CASE WHEN count(*) < 100000 THEN 4 WHEN count(*) < 1000000 THEN 8 ELSE 16 END AS INTEGER) AS partitions
        FROM {table}"""


def _violations() -> list[str]:
    rules = {
        "missing_columns": "count(*) * 0 + 1",
        "order_id_null": "count(*) FILTER (WHERE order_id IS NULL)",
        "order_id_not_int": "count(*) FILTER (WHERE order_id IS NOT NULL AND TRY_CAST(order_id AS INTEGER) IS NULL)",
        "user_id_null": "count(*) FILTER (WHERE user_id IS NULL)",
        "user_id_not_int": "count(*) FILTER (WHERE user_id IS NOT NULL AND TRY_CAST(user_id AS INTEGER) IS NULL)",
        "pickup_address_too_long": "count(*) FILTER (WHERE length(pickup_address) > 20)",
        "package_description_not_int": "count(*) FILTER (WHERE package_description IS NOT NULL"
        " AND TRY_CAST(package_description AS INTEGER) IS NULL)",
        "package_weight_not_decimal": "count(*) FILTER (WHERE package_weight IS NOT NULL"
        " AND TRY_CAST(package_weight AS DECIMAL(3, 2)) IS NULL)",
        "delivery_time_null": "count(*) FILTER (WHERE delivery_time IS NULL)",
        "delivery_time_not_timestamp_ntz": "count(*) FILTER (WHERE delivery_time IS NOT NULL"
        " AND TRY_CAST(delivery_time AS TIMESTAMP) IS NULL)",
        "order_id_repeated": "count(*) - count(DISTINCT order_id)",
    }
    return [_check("orders", name, value, ZERO, "s_orders") for name, value in rules.items()]


def _reconciled(name: str, label: str = "", where: str = "true") -> str:
    return f"""SELECT '{label or name}' AS table_name, count(*) FILTER (WHERE {where}) AS source_count,
        count(*) AS extracted_count, count(*) FILTER (WHERE {where}) = count(*) AS passed FROM s_{name}"""


ADDRESS_LINE = """SELECT o_orderkey AS order_id,
    'Số ' || CAST(o_custkey AS VARCHAR) || ' ' || o_orderpriority || ', ' || n_name || ', ' || r_name AS address,
    r_name AS city, n_name AS district
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey"""

FACT_FIGURES = [
    f"""SELECT '{table}' AS table_name, count(*) AS fact_rows, count(DISTINCT {own}) AS natural_keys, count({value}) AS "values",
        count({other}) AS others, CAST(0 AS BIGINT) AS moved_keys FROM {rows}"""
    for table, rows, own, value, other in (
        ("fact_orders", "f_orders", "order_id", "order_amount", "user_key"),
        ("fact_shipment_tracking", "f_tracking", "shipment_id", "driver_key", "order_key"),
    )
]
LANDED = (("orders", "order_id"), ("payments", "payment_id"), ("users", "user_id"))


def _landed(table: str, key: str) -> str:
    zero = "CAST(0 AS BIGINT)"
    return f"""SELECT '{table}' AS table_name, count(*) AS fact_rows, count(DISTINCT {key}) AS natural_keys, {zero} AS "values",
        {zero} AS others, {zero} AS moved_keys FROM s_{table}"""


def _broken_rules() -> list[str]:
    """Every declared rule of the warehouse tables, measured on the SQL's own rows."""
    held = {"dim_user": "d_user", "dim_driver": "d_driver", "dim_location": "d_location", "fact_orders": "f_orders",
            "fact_shipment_tracking": "f_tracking"}
    found = []
    for table, rows in held.items():
        for rule in TABLES[table]:
            kind = rule.type.split("(")[0]
            if not rule.nullable or rule.primary_key:
                found.append(_check(table, f"{rule.name}_null", f"count(*) FILTER (WHERE {rule.name} IS NULL)", ZERO, rows))
            if kind == "varchar":
                long = f"length(CAST({rule.name} AS VARCHAR)) > {rule.type[8:-1]}"
                found.append(_check(table, f"{rule.name}_too_long", f"count(*) FILTER (WHERE {long})", ZERO, rows))
            elif kind != "timestamp_ntz":
                unfit = f"{rule.name} IS NOT NULL AND TRY_CAST({rule.name} AS {rule.type}) IS NULL"
                found.append(_check(table, f"{rule.name}_not_{kind}", f"count(*) FILTER (WHERE {unfit})", ZERO, rows))
            if rule.primary_key:
                found.append(_check(table, f"{rule.name}_repeated", f"count(*) - count(DISTINCT {rule.name})", ZERO, rows))
    return found


RUN_ROWS = {
    "d_date": """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key FROM (SELECT unnest(generate_series(
        (SELECT least(min(created_at), (SELECT min(estimated_delivery_time) FROM s_shipments)) FROM s_orders),
        (SELECT greatest(max(created_at), (SELECT max(estimated_delivery_time) FROM s_shipments)) FROM s_orders),
        INTERVAL 1 DAY)) AS d) x""",
}


def _run_counts() -> str:
    def rows(phase: str, table: str, relation: str) -> str:
        return (
            f"SELECT '{phase}' AS phase, '{table}' AS table_name, 'rows' AS metric,"
            f" CAST(count(*) AS DOUBLE) AS value FROM {relation}"
        )

    sources = ("orders", "shipments", "payments", "notifications", "users", "drivers")
    landed = [rows("landing", t, f"s_{t}") for t in sources]
    dims = {"dim_date": "d_date", "dim_user": "d_user", "dim_driver": "d_driver", "dim_location": "d_location"}
    tables = {**dims, "fact_orders": "f_orders", "fact_shipment_tracking": "f_tracking"}
    built = [rows("build", t, r) for t, r in tables.items()]
    loaded = [rows("warehouse", t, r) for t, r in tables.items()]
    checks = [
        *_key_checks("dim_date", "d_date", "date_key"),
        *DIM_CHECKS,
        *_fact_checks("fact_orders", "f_orders", FACT_ORDER_KEYS),
        *_fact_checks("fact_shipment_tracking", "f_tracking", TRACKING_KEYS),
        _orphans("dim_driver", "d_driver", "user_key", "d_user", "user_key"),
        _orphans("fact_orders", "f_orders", "user_key", "d_user", "user_key"),
        _orphans("fact_orders", "f_orders", "order_date_key", "d_date", "date_key"),
        _orphans("fact_orders", "f_orders", "pickup_location_key", "d_location", "location_key"),
        _orphans("fact_orders", "f_orders", "delivery_location_key", "d_location", "location_key"),
        _orphans("fact_shipment_tracking", "f_tracking", "order_key", "f_orders", "order_key"),
        _orphans("fact_shipment_tracking", "f_tracking", "driver_key", "d_driver", "driver_key"),
        _orphans("fact_shipment_tracking", "f_tracking", "date_key", "d_date", "date_key"),
    ]
    checked = (
        "SELECT 'checks' AS phase, table_name, check_name AS metric, CAST(value AS DOUBLE) AS value"
        f" FROM ({_union(checks)}) c"
    )
    return _union([*landed, *built, *loaded, checked])


BATCHES = """SELECT '20010802_093000' AS dl_batch_id, count(*) AS n, max(created_at) AS newest FROM s_orders
    UNION ALL SELECT '20010803_093000', count(*), max(payment_date) FROM s_payments"""

# The message sent when an order reaches a status.
STATUS_MESSAGES = {
    "processing": "Đơn hàng #%s đã được tạo và đang chờ xử lý",
    "accepted": "Đơn hàng #%s đã được xác nhận và sẽ sớm được giao",
    "in_transit": "Đơn hàng #%s đang được giao đến bạn",
    "delivered": "Đơn hàng #%s đã được giao thành công",
}

INCREMENTS = """SELECT CASE WHEN notification_date <= TIMESTAMP '2024-01-15 00:00:00' THEN '20240115_000000'
    WHEN notification_date <= TIMESTAMP '2024-01-25 00:00:00' THEN '20240131_000000' ELSE '20240131_060000' END
    AS dl_batch_id, count(*) AS n, max(notification_date) AS mark FROM s_notifications GROUP BY 1"""

FRESH = "s_notifications WHERE notification_date > TIMESTAMP '2024-01-15 00:00:00'"

ORACLES: dict[str, str] = {
    "city_delivery": sql(
        f"""SELECT {CITY.format("trim(delivery_address)")} AS city, count(*) AS orders,
        round(avg({MINUTES.format("created_at", "delivery_time")}), 2) AS mean_delivery_minutes
        FROM s_orders GROUP BY 1""",
        _sources("orders"),
    ),
    "dim_date": sql(
        f"""SELECT {DATE_KEY.format("d")} AS date_key, CAST(d AS DATE) AS full_date, dayname(d) AS day_of_week,
        CAST(day(d) AS INTEGER) AS day_of_month, CAST(month(d) AS INTEGER) AS month,
        CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year, dayofweek(d) IN (0, 6) AS is_weekend,
        strftime(d, '%m-%d') IN ('01-01', '12-25') AS is_holiday
        FROM (SELECT unnest(generate_series(min(created_at), max(created_at), INTERVAL 1 DAY)) AS d FROM s_orders) x""",
        _sources("orders"),
    ),
    "dim_user": sql("SELECT * FROM d_user", DIM_USER),
    "dim_driver": sql("SELECT * FROM d_driver", DIM_DRIVER),
    "dim_location": sql("SELECT * FROM d_location", DIM_LOCATION),
    "dim_location_with_hubs": sql(_dim_location(HUBS), _sources("orders", "shipments")),
    "dim_payment_method": sql(
        f"""SELECT p.payment_method, payments, CAST(payment_method_key AS INTEGER) AS payment_method_key,
        payment_method_category FROM (SELECT payment_method, count(*) AS payments FROM s_payments GROUP BY 1) p
        LEFT JOIN {METHODS} ON p.payment_method = m.payment_method""",
        _sources("payments"),
    ),
    "fact_orders": sql("SELECT * FROM f_orders", ORDERS_FACT),
    "fact_orders_payment_method": sql(
        _fact_orders(
            "s_payments",
            "CAST(m.payment_method_key AS INTEGER) AS payment_method_key,",
            f"LEFT JOIN {METHODS} ON p.payment_method = m.payment_method",
        ),
        STAR,
        _sources("payments"),
    ),
    "fact_orders_fanout_all": sql(_fact_orders("s_instalments"), STAR, _sources("instalments")),
    "fact_orders_fanout_latest": sql(
        _fact_orders("paid"), STAR, _sources("instalments"), {"paid": LATEST.format(amount="amount")}
    ),
    "fact_orders_fanout_sum": sql(
        _fact_orders("paid"), STAR, _sources("instalments"), {"paid": LATEST.format(amount="total")}
    ),
    "fact_shipment_tracking": sql("SELECT * FROM f_tracking", TRACKING_FACT),
    "fact_shipment_tracking_located": sql(
        _tracking(
            "l.location_key AS current_location_key,",
            "LEFT JOIN d_hubs l ON trim(s.current_location) = l.full_address",
        ),
        ORDERS_FACT,
        DIM_DRIVER,
        _sources("shipments"),
        {"d_hubs": _dim_location(HUBS)},
    ),
    "fact_shipment_tracking_instalments": sql(
        _tracking(orders="(SELECT order_id, min(order_key) AS order_key FROM f_orders GROUP BY order_id)"),
        INSTALMENT_FACT,
    ),
    "fact_shipment_tracking_pairs": sql(_tracking(), INSTALMENT_FACT),
    "order_time_range": sql(
        "SELECT min(created_at) AS first_order, max(created_at) AS last_order FROM s_orders", _sources("orders")
    ),
    "distinct_addresses": sql(ADDRESSES, _sources("orders")),
    "distinct_users_by_year": sql(
        """SELECT CAST(year(created_at) AS INTEGER) AS year, count(*) AS orders, count(DISTINCT user_id) AS users, true AS near
        FROM s_orders GROUP BY ROLLUP (1)""",
        _sources("orders"),
    ),
    "user_history": sql("SELECT * FROM history", HISTORY),
    "orders_by_user_history": sql(
        """SELECT h.effective_start_date, count(*) AS orders FROM s_orders o LEFT JOIN history h ON o.user_id = h.user_id
        AND CAST(o.created_at AS DATE) >= h.effective_start_date AND CAST(o.created_at AS DATE) < h.effective_end_date
        GROUP BY 1""",
        HISTORY,
        _sources("orders"),
    ),
    "distinct_users_in_orders": "SELECT count(*) AS orders, count(DISTINCT o_custkey) AS users FROM orders",
    "surrogate_key_dense": """SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey,
        l_shipdate) AS line_key, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem""",
    "surrogate_key_stable": sql(
        """SELECT location_key, full_address FROM first_keys UNION ALL
        SELECT (SELECT max(location_key) FROM first_keys) + row_number() OVER (ORDER BY full_address), full_address
        FROM (SELECT DISTINCT trim(delivery_address) AS full_address FROM s_orders) d
        WHERE full_address NOT IN (SELECT full_address FROM first_keys)""",
        _sources("orders"),
        {
            "first_keys": """SELECT row_number() OVER (ORDER BY full_address) AS location_key, full_address
            FROM (SELECT DISTINCT trim(pickup_address) AS full_address FROM s_orders) p"""
        },
    ),
    "incremental_extract": sql(f"SELECT * FROM {FRESH}", _sources("notifications")),
    "next_mark": sql(
        f"SELECT max(notification_date) AS mark, count(*) AS new_rows FROM {FRESH}", _sources("notifications")
    ),
    "incremental_landing": sql(INCREMENTS, _sources("notifications")),
    "partition_bounds": _union(
        [
            _bounds(t, k)
            for t, k in {
                "customer": "c_custkey",
                "orders": "o_orderkey",
                "lineitem": "l_orderkey",
                "events": "event_id",
                "part": "p_partkey",
            }.items()
        ]
    ),
    "partition_bounds_even": _union(
        [
            f"""SELECT '{t}' AS table_name, min(k) AS min_id, max(k) AS max_id, count(*) AS total_count, true AS even
            FROM (SELECT CASE WHEN {k} % 3 = 0 THEN {k} + 1000000000000 ELSE {k} END AS k FROM {t}) x"""
            for t, k in {"customer": "c_custkey", "orders": "o_orderkey", "events": "event_id", "part": "p_partkey"}.items()
        ]
    ),
    "char_padding_join": sql(
        """SELECT count(*) FILTER (WHERE role = rtrim(role)) AS hits_untrimmed, count(role) AS hits_trimmed
        FROM s_users""",
        _sources("users"),
    ),
    "raw_zone_roundtrip": sql(
        f"""SELECT *, {AS_OF} AS dl_ingestion_timestamp, 'notifications' AS dl_source_table,
        '20010802_093000' AS dl_batch_id, DATE '2001-08-02' AS dl_process_date,
        strftime(notification_date, '%Y-%m-%d') AS notification_date_partition FROM s_notifications""",
        _sources("notifications"),
    ),
    "staging_roundtrip": sql("SELECT shipment_id, order_id, status FROM s_shipments", _sources("shipments")),
    "processed_batches": sql(BATCHES, _sources("orders", "payments")),
    "retention_filter": """SELECT CAST(ts AS DATE) AS dl_process_date, count(*) AS n FROM events
        WHERE CAST(ts AS DATE) >= DATE '2024-01-24' GROUP BY 1""",
    "retention_swap": """SELECT event_id AS notification_id, user_id, CAST(ts AS DATE) AS dl_process_date
        FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-24'""",
    "upsert_dimension": """SELECT coalesce(c_custkey, s_suppkey * 20) AS user_key,
        CASE WHEN s_suppkey IS NOT NULL THEN s_name ELSE c_name END AS full_name,
        CASE WHEN s_suppkey IS NOT NULL THEN s_acctbal ELSE c_acctbal END AS balance,
        CASE WHEN c_custkey IS NOT NULL THEN c_nationkey ELSE s_nationkey END AS nation_key
        FROM customer FULL OUTER JOIN supplier ON c_custkey = s_suppkey * 20""",
    "dimension_checks": sql(_union(DIM_CHECKS), DIM_DRIVER, DIM_LOCATION),
    "duplicate_keys": _union(_key_checks("lineitem", "lineitem", "l_orderkey || '/' || l_linenumber")),
    "null_key_counts": sql(_union(_null_checks("fact_shipment_tracking", "f_tracking", TRACKING_KEYS)), TRACKING_FACT),
    "null_address_counts": sql(
        _union(_null_checks("dim_location", "d_location", ["full_address", "city", "district"])), DIM_LOCATION
    ),
    "fact_report": sql(
        _union(
            [
                _check("fact_orders", "total_rows", "count(*)", ANY, "f_orders"),
                _check(
                    "fact_orders",
                    "null_keys",
                    "count(*) FILTER (WHERE order_key IS NULL OR order_date_key IS NULL)",
                    ZERO,
                    "f_orders",
                ),
                _check("fact_orders", "missing_columns", "0", ZERO, "(SELECT 1) x"),
                _check("fact_shipment_tracking", "total_rows", "count(*)", ANY, "f_tracking"),
                _check(
                    "fact_shipment_tracking",
                    "null_keys",
                    "count(*) FILTER (WHERE tracking_key IS NULL OR order_key IS NULL)",
                    ZERO,
                    "f_tracking",
                ),
                _check("fact_shipment_tracking", "missing_columns", "0", ZERO, "(SELECT 1) x"),
            ]
        ),
        TRACKING_FACT,
    ),
    "orphan_counts": sql(
        _union(
            [
                _orphans("shipments", "s_shipments", "driver_id", "d_driver", "driver_id"),
                _orphans("shipments", "s_shipments", "order_id", "s_payments", "order_id"),
            ]
        ),
        DIM_DRIVER,
        _sources("shipments", "payments"),
    ),
    "schema_conformance": sql(_union(_violations()), _sources("orders")),
    "reconcile_counts": sql(
        _union(
            [
                *[_reconciled(n) for n in ("orders", "payments", "drivers")],
                _reconciled("orders", "delivered_orders", "status = 'delivered'"),
            ]
        ),
        _sources("orders", "payments", "drivers"),
    ),
    "zone_validation": sql(
        _union(
            [
                _check("payments", "row_count", "count(*)", POSITIVE, "s_payments"),
                _check("payments", "missing_lineage_columns", "0", ZERO, "(SELECT 1) x"),
                _check(
                    "payments",
                    "custom_query",
                    "count(*) FILTER (WHERE payment_status = 'completed')",
                    POSITIVE,
                    "s_payments",
                ),
            ]
        ),
        _sources("payments"),
    ),
    "zone_statistics": sql(
        """SELECT 'notifications' AS table_name, count(*) AS record_count, CAST(9 AS BIGINT) AS column_count,
        count(DISTINCT CAST(notification_date AS DATE)) >= 28 AS has_many_files, count(*) > 0 AS has_size,
        count(*) > 0 AS has_time FROM s_notifications""",
        _sources("notifications"),
    ),
    "zone_row_statistics": _union(
        [
            f"SELECT '{t}' AS table_name, count(*) AS record_count, CAST({c} AS BIGINT) AS column_count,"
            f" CAST(1 AS BIGINT) AS file_count FROM {t}"
            for t, c in {"lineitem": 11, "orders": 6, "events": 6}.items()
        ]
    ),
    "transform_metrics": sql(
        f"""SELECT *, 'transform' AS builder, {AS_OF} AS build_timestamp, 'etl' AS build_user, '1.0.0' AS version
        FROM ({_union([*DIM_CHECKS, *_fact_checks("fact_orders", "f_orders", FACT_ORDER_KEYS)])}) c""",
        ORDERS_FACT,
        DIM_DRIVER,
    ),
    "warehouse_run_counts": sql(_run_counts(), TRACKING_FACT, _sources("notifications"), RUN_ROWS),
    "warehouse_rerun": sql(_union(FACT_FIGURES), TRACKING_FACT),
    "incremental_runs": sql(_union([*FACT_FIGURES, *[_landed(t, k) for t, k in LANDED]]), TRACKING_FACT, _sources("payments")),
    "warehouse_conformance": sql(
        f"SELECT table_name, check_name, value FROM ({_union(_broken_rules())}) c WHERE NOT passed",
        TRACKING_FACT,
    ),
    "advance_status": sql(
        f"""SELECT order_id, status AS previous_status, coalesce({NEXT_STATUS}, status) AS status FROM s_orders""",
        _sources("orders"),
    ),
    "initial_status": sql(
        f"""SELECT order_id, CASE WHEN {LIFE_AS_OF} - created_at < INTERVAL 30 DAY THEN 'processing'
        WHEN {LIFE_AS_OF} - created_at < INTERVAL 120 DAY THEN 'accepted'
        WHEN delivery_time > {LIFE_AS_OF} THEN 'in_transit' ELSE 'delivered' END AS status FROM s_orders""",
        _sources("orders"),
    ),
    "status_by_age": sql(f"SELECT {BY_AGE} AS status, count(*) AS n FROM s_orders GROUP BY 1", _sources("orders")),
    "shipment_status_map": sql(
        f"""SELECT order_id, CASE {BY_AGE} WHEN 'accepted' THEN 'assigned' WHEN 'in_transit' THEN 'in_transit'
        WHEN 'delivered' THEN 'completed' END AS shipment_status FROM s_orders""",
        _sources("orders"),
    ),
    "shipment_cascade": sql(
        f"""SELECT s.shipment_id, s.order_id, s.driver_id,
        CASE new_status WHEN 'delivered' THEN 'Đã giao thành công'
            WHEN 'in_transit' THEN 'Đang giao tại ' || delivery_address ELSE s.current_location END
            AS current_location,
        s.estimated_delivery_time,
        CASE new_status WHEN 'delivered' THEN 'completed' WHEN 'in_transit' THEN 'in_transit' ELSE s.status END AS status
        FROM s_shipments s LEFT JOIN changes c ON s.order_id = c.order_id""",
        CHANGES,
        _sources("shipments"),
    ),
    "payment_cascade": sql(
        f"""SELECT p.payment_id, p.order_id, p.amount, p.payment_method,
        CASE WHEN new_status = 'delivered' THEN 'completed' ELSE p.payment_status END AS payment_status,
        CASE WHEN new_status = 'delivered' THEN {LIFE_AS_OF} ELSE p.payment_date END AS payment_date
        FROM s_instalments p LEFT JOIN changes c ON p.order_id = c.order_id""",
        CHANGES,
        _sources("instalments"),
    ),
    "status_notifications": sql(
        "SELECT order_id, user_id, CASE new_status "
        + " ".join(f"WHEN '{s}' THEN {_message(form)}" for s, form in STATUS_MESSAGES.items())
        + f" END AS message, {LIFE_AS_OF} AS notification_date FROM changes",
        CHANGES,
    ),
    "notification_timeline": sql(_timeline(), _sources("orders")),
    "available_drivers": sql(
        """SELECT d.driver_id FROM s_drivers d LEFT JOIN s_shipments s ON d.driver_id = s.driver_id
        WHERE s.driver_id IS NULL OR s.estimated_delivery_time <= TIMESTAMP '1995-01-08 00:00:00'
        GROUP BY d.driver_id""",
        _sources("drivers", "shipments"),
    ),
    "idle_drivers": sql(
        """SELECT driver_id FROM s_drivers EXCEPT SELECT driver_id FROM s_shipments
        WHERE estimated_delivery_time > TIMESTAMP '2001-10-25 00:00:00'""",
        _sources("drivers", "shipments"),
    ),
    "active_users": sql("SELECT user_id FROM s_users WHERE rtrim(role) = 'user'", _sources("users")),
    "fold_accents_documents": f"SELECT doc_id, translate(text, '{ACCENTED}', '{FOLDED}') AS folded FROM documents",
    "normalise_contact": f"""SELECT doc_id, regexp_replace(translate(lower(text), '{ACCENTED}', '{FOLDED}'),
        '[^a-z0-9]', '', 'g') AS handle FROM documents""",
    "full_addresses": f"""SELECT order_id, address, city, district, substring(address, 1, 30) AS clipped
        FROM ({ADDRESS_LINE}) a""",
    "address_parts": sql(
        f"""SELECT order_id, {CITY.format("pickup_address")} AS pickup_city,
        {DISTRICT.format("pickup_address")} AS pickup_district, {CITY.format("delivery_address")} AS delivery_city,
        {DISTRICT.format("delivery_address")} AS delivery_district,
        {DATE_KEY.format("delivery_time")} AS delivery_date_key FROM s_orders""",
        _sources("orders"),
    ),
}
