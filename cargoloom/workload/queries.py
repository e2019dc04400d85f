"""The registered queries: each operator over whole tables in the shape of ``adapters``."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargoloom.adapters import source, table
from cargoloom.functions.addresses import address_city, address_district, full_address
from cargoloom.functions.dates import date_key, minutes_between
from cargoloom.functions.moments import moment
from cargoloom.functions.text import clip, contact_handle, fold_accents, trim_padding
from cargoloom.operators import lifecycle, quality
from cargoloom.operators.history import advance_history, begin_history, with_row_of_day
from cargoloom.operators.keys import dense_keys, stable_keys
from cargoloom.operators.sketches import distinct_sketches, error_bound, merged_distinct
from cargoloom.operators.upsert import updatable_columns, upsert
from cargoloom.plans import dimensions, facts, metrics, warehouse_run
from cargoloom.plans.landing import each, land, land_increment, landed_mark
from cargoloom.plans.warehouse_schema import TABLES
from cargoloom.session import new_work_path, run_settings
from cargoloom.sinks.versions import VersionedTables, apply_retention, retained
from cargoloom.sinks.zones import Zones, with_lineage
from cargoloom.sources import jdbc
from cargoloom.sources.even_ranges import even_ranges, frame_cells
from cargoloom.sources.incremental import high_water_mark, newer_than
from cargoloom.sources.specs import LOGISTICS_TABLES

AS_OF = datetime(2001, 8, 2, 9, 30)
LIFE_AS_OF = datetime(1998, 6, 1, 12, 0)
EVENTS_MARK = datetime(2024, 1, 15)
EVENTS_SECOND = datetime(2024, 1, 25)
EVENTS_AS_OF = datetime(2024, 1, 31)
ETL_USER = "etl"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


# A whole run writes all tables. Orders and payments fall on thousands of days with a few rows each in the test tables, and on
# their file system thousands of directories take minutes; the runs partition them by year. Single landings use the specs as shipped.
RUN_SPECS = tuple(
    replace(s, partition_format="yyyy") if s.name in ("orders", "payments") else s for s in LOGISTICS_TABLES
)


def _spec(name: str):
    return next(s for s in LOGISTICS_TABLES if s.name == name)


def _users(spark, sf):
    return dimensions.dim_user(trim_padding(source(spark, sf, "users"), ["role"]), AS_OF)


def _drivers(spark, sf, users=None):
    return dimensions.dim_driver(source(spark, sf, "drivers"), users or _users(spark, sf), AS_OF)


def _locations(spark, sf):
    return dimensions.dim_location(source(spark, sf, "orders"), AS_OF)


def _users_and_locations(spark, sf):
    """Two dimensions that do not need each other, built at the same time."""
    return each([lambda: _users(spark, sf), lambda: _locations(spark, sf)])


def _orders_fact(spark, sf, payments="payments", dims=None, **options):
    users, places = dims or _users_and_locations(spark, sf)
    return facts.fact_orders(
        source(spark, sf, "orders"), source(spark, sf, payments), users, places, AS_OF, ETL_USER, **options
    )


def _facts(spark, sf, places=None):
    """Order facts and drivers, built at the same time; with ``places`` the tracking facts look locations up too."""
    dims = _users_and_locations(spark, sf)
    orders, drivers = each(
        [lambda: _orders_fact(spark, sf, dims=dims), lambda: _drivers(spark, sf, dims[0])]
    )
    tracking = facts.fact_shipment_tracking(
        source(spark, sf, "shipments"), orders, drivers, AS_OF, ETL_USER, dim_location=places
    )
    return orders, tracking


# --- star schema -------------------------------------------------------------------


@query
def city_delivery(spark, sf):
    """Orders and mean delivery minutes per destination city: the flagship report. Every order counts once."""
    orders = source(spark, sf, "orders")
    return orders.groupBy(address_city(F.trim("delivery_address")).alias("city")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.round(F.avg(minutes_between("created_at", "delivery_time")), 2).alias("mean_delivery_minutes"),
    )


@query
def dim_date(spark, sf):
    return dimensions.dim_date_covering(source(spark, sf, "orders"), "created_at")


@query
def dim_user(spark, sf):
    return _users(spark, sf)


@query
def dim_driver(spark, sf):
    return _drivers(spark, sf)


@query
def dim_location(spark, sf):
    return _locations(spark, sf)


@query
def dim_location_with_hubs(spark, sf):
    """Locations from orders and from the shipments' current locations."""
    return dimensions.dim_location(source(spark, sf, "orders"), AS_OF, shipments=source(spark, sf, "shipments"))


@query
def dim_payment_method(spark, sf):
    """Payments per method with the method's key and category; unknown methods have none."""
    used = source(spark, sf, "payments").groupBy("payment_method").agg(F.count(F.lit(1)).alias("payments"))
    return used.join(dimensions.dim_payment_method(spark), "payment_method", "left")


@query
def fact_orders(spark, sf):
    return _orders_fact(spark, sf)


@query
def fact_orders_payment_method(spark, sf):
    return _orders_fact(spark, sf, dim_payment_method=dimensions.dim_payment_method(spark))


@query
def fact_orders_fanout_all(spark, sf):
    return _orders_fact(spark, sf, "instalments", payment_policy="all")


@query
def fact_orders_fanout_latest(spark, sf):
    return _orders_fact(spark, sf, "instalments", payment_policy="latest")


@query
def fact_orders_fanout_sum(spark, sf):
    return _orders_fact(spark, sf, "instalments", payment_policy="sum")


@query
def fact_shipment_tracking(spark, sf):
    return _facts(spark, sf)[1]


@query
def fact_shipment_tracking_located(spark, sf):
    places = dimensions.dim_location(source(spark, sf, "orders"), AS_OF, shipments=source(spark, sf, "shipments"))
    return _facts(spark, sf, places)[1]


def _instalment_tracking(spark, sf, per_order_fact: bool):
    # Customers and users grow with the tables: files of theirs that look small are not broadcast.
    with run_settings(spark):
        orders = _orders_fact(spark, sf, "instalments", stored=False)
        return facts.fact_shipment_tracking(
            source(spark, sf, "shipments"), orders, _drivers(spark, sf), AS_OF, ETL_USER, per_order_fact=per_order_fact
        )


@query
def fact_shipment_tracking_instalments(spark, sf):
    """Orders with several payments: still one row per shipment."""
    return _instalment_tracking(spark, sf, per_order_fact=False)


@query
def fact_shipment_tracking_pairs(spark, sf):
    """The same with a row per shipment and order fact, where that is asked for."""
    return _instalment_tracking(spark, sf, per_order_fact=True)


@query
def order_time_range(spark, sf):
    """First and last order time, null keys left aside."""
    return source(spark, sf, "orders").agg(
        F.min("created_at").alias("first_order"), F.max("created_at").alias("last_order")
    )


@query
def distinct_addresses(spark, sf):
    return dimensions.distinct_addresses(source(spark, sf, "orders"), ("pickup_address", "delivery_address"))


@query
def distinct_users_in_orders(spark, sf):
    return source(spark, sf, "orders").agg(
        F.count(F.lit(1)).alias("orders"), F.count_distinct("user_id").alias("users")
    )


@query
def distinct_users_by_year(spark, sf):
    """Users with an order, per year and in all (year null): exact, and whether what the sketches of the years add up to is near enough."""
    orders = source(spark, sf, "orders").withColumn("year", F.year("created_at"))
    path = new_work_path(spark, "sketches")
    distinct_sketches(orders, "user_id", ["year"]).write.parquet(path)
    merged = spark.read.parquet(path).rollup("year").agg(F.sum("rows").alias("orders"), merged_distinct().alias("estimate"))
    exact = orders.rollup("year").agg(F.count_distinct("user_id").alias("users")).withColumnRenamed("year", "of")
    near = F.abs(F.col("estimate") - F.col("users")) <= F.ceil(F.col("users") * error_bound())
    return merged.join(exact, F.col("year").eqNullSafe(F.col("of"))).select("year", "orders", "users", near.alias("near"))


# --- keys --------------------------------------------------------------------------


@query
def surrogate_key_dense(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    return dense_keys(lines, order, "line_key")


@query
def surrogate_key_stable(spark, sf):
    """Keys given to pickup addresses stay when delivery addresses join them; the highest key comes from the table's log."""
    orders, tables = source(spark, sf, "orders"), VersionedTables(spark, new_work_path(spark, "tables"))
    first = dense_keys(dimensions.distinct_addresses(orders, ("pickup_address",)), ["full_address"], "location_key")
    tables.publish(first, "places", AS_OF, key="location_key")
    grown = dimensions.distinct_addresses(orders, ("pickup_address", "delivery_address"))
    return stable_keys(grown, tables.known_keys("places", AS_OF + timedelta(days=1)), "full_address", "location_key")


# --- sources -----------------------------------------------------------------------


@query
def incremental_extract(spark, sf):
    return newer_than(source(spark, sf, "notifications"), "notification_date", EVENTS_MARK)


@query
def next_mark(spark, sf):
    fresh = newer_than(source(spark, sf, "notifications"), "notification_date", EVENTS_MARK)
    return high_water_mark(fresh, "notification_date")


@query
def incremental_landing(spark, sf):
    """Three increments, one of them landed twice and two on one day, without gap or repetition: rows per batch."""
    zones = Zones(spark, new_work_path(spark, "zones"))
    events, spec = source(spark, sf, "notifications"), _spec("notifications")
    at = F.col("notification_date")
    land_increment(events.filter(at <= moment(EVENTS_MARK)), zones, spec, EVENTS_MARK, None)
    mark = landed_mark(zones, spec, EVENTS_AS_OF)
    until = events.filter(at <= moment(EVENTS_SECOND))
    # The first attempt has other dates, hence other directories; the second replaces all of it.
    land_increment(until.withColumn("notification_date", at + F.expr("INTERVAL 90 DAYS")), zones, spec, EVENTS_AS_OF, mark)
    land_increment(until, zones, spec, EVENTS_AS_OF, mark)
    later = EVENTS_AS_OF + timedelta(hours=6)
    land_increment(events, zones, spec, later, landed_mark(zones, spec, later))
    landed = zones.read("raw", "notifications", merge_schema=False)
    return landed.groupBy("dl_batch_id").agg(F.count(F.lit(1)).alias("n"), F.max("notification_date").alias("mark"))


@query
def partition_bounds(spark, sf):
    tables = {
        "customer": "c_custkey",
        "orders": "o_orderkey",
        "lineitem": "l_orderkey",
        "events": "event_id",
        "part": "p_partkey",
    }
    found = {t: jdbc.read_bounds(jdbc.bounds(table(spark, sf, t), k)) for t, k in tables.items()}
    return spark.createDataFrame(
        [(t, b.min_id, b.max_id, b.total_count, b.partitions) for t, b in found.items()],
        "table_name string, min_id long, max_id long, total_count long, partitions int",
    )


@query
def partition_bounds_even(spark, sf):
    """Keys of which every third lies behind a gap: the ranges hold all rows, the largest at most twice the mean."""
    tables = {"customer": "c_custkey", "orders": "o_orderkey", "events": "event_id", "part": "p_partkey"}
    out = []
    for name, key in tables.items():
        value = F.col(key).cast("long")
        keys = table(spark, sf, name).select(F.when(value % 3 == 0, value + 1_000_000_000_000).otherwise(value).alias("k"))
        found = jdbc.read_bounds(jdbc.bounds(keys, "k"))
        most = -(-found.total_count // found.partitions)
        sizes = [n for _, n in even_ranges(frame_cells(keys, "k", found.min_id), found.min_id, found.max_id, most)]
        out.append((name, found.min_id, found.max_id, sum(sizes), max(sizes) * len(sizes) <= 2 * sum(sizes)))
    return spark.createDataFrame(out, "table_name string, min_id long, max_id long, total_count long, even boolean")


@query
def char_padding_join(spark, sf):
    """Padded roles meet unpadded ones once the padding is trimmed; untrimmed they mostly miss."""
    users = source(spark, sf, "users")
    roles = users.select(F.rtrim("role").alias("role")).distinct().withColumn("known", F.lit(1))
    raw = users.join(roles.withColumnRenamed("known", "hit_untrimmed"), "role", "left")
    both = trim_padding(raw, ["role"]).join(roles, "role", "left")
    return both.agg(F.count("hit_untrimmed").alias("hits_untrimmed"), F.count("known").alias("hits_trimmed"))


# --- sinks -------------------------------------------------------------------------


@query
def raw_zone_roundtrip(spark, sf):
    zones = Zones(spark, new_work_path(spark, "zones"))
    land(lambda spec: source(spark, sf, spec.name), zones, _spec("notifications"), AS_OF)
    return zones.read("raw", "notifications")


@query
def staging_roundtrip(spark, sf):
    zones = Zones(spark, new_work_path(spark, "zones"))
    zones.load_staging(source(spark, sf, "shipments"), "shipments", ["status"])
    return zones.read("staging", "shipments", ["shipment_id", "order_id", "status"], merge_schema=False)


@query
def processed_batches(spark, sf):
    """History by batch: a batch written twice counts once."""
    zones = Zones(spark, new_work_path(spark, "zones"))
    orders, payments = source(spark, sf, "orders"), source(spark, sf, "payments")
    keys = orders.select("order_id", "created_at")
    paid = payments.select("order_id", F.col("payment_date").alias("created_at"))
    for batch, at in ((keys, AS_OF), (keys, AS_OF), (paid, AS_OF + timedelta(days=1))):
        zones.load_batch(batch, "order_history", at)
    return zones.read("processed", "order_history").groupBy("dl_batch_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("created_at").alias("newest")
    )


def _dated_events(spark, sf):
    events = with_lineage(source(spark, sf, "notifications"), "notifications", EVENTS_AS_OF)
    return events.withColumn("dl_process_date", F.col("notification_date").cast("date"))


@query
def retention_filter(spark, sf):
    kept = retained(_dated_events(spark, sf), EVENTS_AS_OF, 7)
    return kept.groupBy("dl_process_date").agg(F.count(F.lit(1)).alias("n"))


@query
def retention_swap(spark, sf):
    """Retention as a new version of a stored table."""
    tables = VersionedTables(spark, new_work_path(spark, "tables"))
    by_day = ["dl_process_date"]
    tables.publish(_dated_events(spark, sf), "notifications", EVENTS_AS_OF - timedelta(days=1), by_day)
    apply_retention(tables, "notifications", EVENTS_AS_OF, 7, by_day)
    return tables.current("notifications").select("notification_id", "user_id", "dl_process_date")


@query
def upsert_dimension(spark, sf):
    """Suppliers merged into the customers' dimension: some keys known, some new, nation left alone."""
    current = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_key"),
        F.col("c_name").alias("full_name"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_nationkey").alias("nation_key"),
    )
    incoming = table(spark, sf, "supplier").select(
        F.col("s_nationkey").alias("nation_key"),
        (F.col("s_suppkey") * 20).alias("user_key"),
        F.col("s_name").alias("full_name"),
        F.col("s_acctbal").alias("balance"),
    )
    return upsert(current, incoming, "user_key", updatable_columns(current, "user_key", ["nation_key"]))


HISTORY_DAYS = (date(1995, 1, 1), date(1996, 7, 1), date(1998, 1, 1))


def _address_history(spark, sf):
    """Users over three days: some come on the second, some move on the second or third, some are gone on the third. The last
    day is run twice."""
    users = source(spark, sf, "users").select("user_id", "full_name", "address")
    number, address = F.col("user_id"), F.col("address")
    second = F.when(number % 4 == 0, F.concat(address, F.lit(" 2"))).otherwise(address)
    third = F.when(number % 6 == 0, F.concat(address, F.lit(" 3"))).otherwise(second)
    first = begin_history(users.where(number % 10 != 0), HISTORY_DAYS[0])
    states = (
        (HISTORY_DAYS[1], users.withColumn("address", second)),
        (HISTORY_DAYS[2], users.where(number % 11 != 0)),
        (HISTORY_DAYS[2], users.where(number % 11 != 0).withColumn("address", third)),
    )

    def written(df):
        path = new_work_path(spark, "history")
        df.write.partitionBy("is_active").parquet(path)
        return spark.read.schema(df.schema).parquet(path).select(*df.columns)

    history = written(first)
    for day, state in states:
        history = written(advance_history(history, state, "user_id", day, close_missing=True))
    return history


@query
def user_history(spark, sf):
    """Every row of the history, closed and open."""
    return _address_history(spark, sf)


@query
def orders_by_user_history(spark, sf):
    """Orders per row of the history that held on their day, by that row's start; null where none held."""
    orders = source(spark, sf, "orders").select("user_id", F.col("created_at").cast("date").alias("day"))
    placed = with_row_of_day(orders, _address_history(spark, sf), "user_id", "day", ["effective_start_date"])
    return placed.groupBy("effective_start_date").agg(F.count(F.lit(1)).alias("orders"))


# --- checks ------------------------------------------------------------------------


@query
def dimension_checks(spark, sf):
    users, places = _users_and_locations(spark, sf)
    return quality.union_checks(
        [
            quality.key_checks(users, "dim_user", "user_key"),
            quality.key_checks(_drivers(spark, sf, users), "dim_driver", "driver_key"),
            quality.key_checks(places, "dim_location", "location_key"),
        ]
    )


@query
def duplicate_keys(spark, sf):
    lines = table(spark, sf, "lineitem")
    return quality.key_checks(lines.select(F.struct("l_orderkey", "l_linenumber").alias("line_key")), "lineitem", "line_key")


@query
def null_key_counts(spark, sf):
    return quality.null_key_checks(_facts(spark, sf)[1], "fact_shipment_tracking")


@query
def null_address_counts(spark, sf):
    """Locations without an address, city or district."""
    return quality.null_key_checks(_locations(spark, sf), "dim_location", ["full_address", "city", "district"])


@query
def fact_report(spark, sf):
    orders, tracking = _facts(spark, sf)
    return quality.union_checks([quality.orders_report(orders), quality.tracking_report(tracking)])


@query
def orphan_counts(spark, sf):
    """Shipments of drivers without a user have no row in the driver dimension."""
    return quality.orphan_checks(
        source(spark, sf, "shipments"),
        "shipments",
        [
            ("driver_id", _drivers(spark, sf), "driver_id"),
            ("order_id", source(spark, sf, "payments"), "order_id"),
        ],
    )


ORDER_RULES = (
    quality.ColumnRule("order_id", "int", nullable=False, primary_key=True),
    quality.ColumnRule("user_id", "int", nullable=False),
    quality.ColumnRule("pickup_address", "varchar(20)"),
    quality.ColumnRule("package_description", "int"),
    quality.ColumnRule("package_weight", "decimal(3,2)"),
    quality.ColumnRule("delivery_time", "timestamp_ntz", nullable=False),
    quality.ColumnRule("weight_unit", "varchar(5)"),
)


@query
def schema_conformance(spark, sf):
    return quality.schema_conformance(source(spark, sf, "orders"), "orders", ORDER_RULES)


@query
def reconcile_counts(spark, sf):
    """Source rows against landed rows."""
    zones = Zones(spark, new_work_path(spark, "zones"))
    pairs = []
    for name in ("orders", "payments", "drivers"):
        land(lambda spec: source(spark, sf, spec.name), zones, _spec(name), AS_OF)
        landed = zones.read("raw", name, merge_schema=False)
        pairs.append(quality.reconcile(name, source(spark, sf, name), landed))
        if name == "orders":  # a pair that must not agree
            pairs.append(quality.reconcile("delivered_orders", landed.filter("status = 'delivered'"), landed))
    return quality.union_checks(pairs)


@query
def zone_validation(spark, sf):
    zones = Zones(spark, new_work_path(spark, "zones"))
    land(lambda spec: source(spark, sf, spec.name), zones, _spec("payments"), AS_OF)
    landed = zones.read("raw", "payments")
    return quality.zone_checks(
        landed, "payments", "SELECT count(*) FROM v_payments WHERE payment_status = 'completed'"
    )


@query
def zone_statistics(spark, sf):
    """Statistics of a table landed in a directory per day; whether its files have a size and a time."""
    zones = Zones(spark, new_work_path(spark, "zones"))
    land(lambda spec: source(spark, sf, spec.name), zones, _spec("notifications"), AS_OF)
    found = quality.zone_statistics(zones.read("raw", "notifications", merge_schema=False), "notifications")
    return found.select(
        "table_name",
        "record_count",
        "column_count",
        (F.col("file_count") >= 28).alias("has_many_files"),
        (F.col("size_bytes") > 0).alias("has_size"),
        F.col("last_modified").isNotNull().alias("has_time"),
    )


@query
def zone_row_statistics(spark, sf):
    """The part of the statistics that does not depend on the files."""
    found = [quality.zone_statistics(table(spark, sf, t), t) for t in ("lineitem", "orders", "events")]
    return quality.union_checks(found).select("table_name", "record_count", "column_count", "file_count")


@query
def transform_metrics(spark, sf):
    users, places = _users_and_locations(spark, sf)
    orders, drivers = each(
        [lambda: _orders_fact(spark, sf, dims=(users, places)), lambda: _drivers(spark, sf, users)]
    )
    checks = metrics.transform_metrics({"user": users, "driver": drivers, "location": places}, {"orders": orders})
    return metrics.with_build_metadata(checks, "transform", AS_OF, ETL_USER)


@query
def warehouse_run_counts(spark, sf):
    """A whole run on a fresh base path: its metrics but the timings."""
    done = warehouse_run.run(
        spark, lambda spec: source(spark, sf, spec.name), new_work_path(spark, "run"), AS_OF, ETL_USER, RUN_SPECS
    )
    return done.filter(F.col("metric") != "seconds").select("phase", "table_name", "metric", "value")


FACT_FIGURES = {
    "fact_orders": ("order_key", "order_id", "order_amount", "user_key"),
    "fact_shipment_tracking": ("tracking_key", "shipment_id", "driver_key", "order_key"),
}


def _fact_figures(tables: VersionedTables, first: datetime):
    """Per fact table its rows, natural keys, values looked up, and keys that moved since the version before ``first``."""
    for name, (key, own, value, other) in FACT_FIGURES.items():
        now, then = tables.current(name), tables.before(name, first)
        old = then.select(F.col(key).alias("old_key"), F.col(own).alias("own"))
        yield now.join(old, now[own] == old["own"], "left").agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("fact_rows"),
            F.count_distinct(own).alias("natural_keys"),
            F.count(value).alias("values"),
            F.count(other).alias("others"),
            F.coalesce(F.count_if((F.col(key) != F.col("old_key")) | F.col(key).isNull()), F.lit(0)).alias("moved_keys"),
        )


@query
def warehouse_rerun(spark, sf):
    """A run, the same run again, and the next day's with orders changed and payments and orders come: what the facts are then."""
    base, tomorrow = new_work_path(spark, "run"), AS_OF + timedelta(days=1)
    tables = VersionedTables(spark, f"{base}/warehouse")

    def first_day(spec):
        rows = source(spark, sf, spec.name)
        if spec.name == "orders":
            early = rows.filter("order_id % 50 <> 0")
            return early.withColumn("status", F.when(F.expr("order_id % 97 = 0"), "processing").otherwise(F.col("status")))
        return rows.filter("payment_id % 3 <> 0") if spec.name == "payments" else rows

    for at in (AS_OF, AS_OF):
        warehouse_run.run(spark, first_day, base, at, ETL_USER, RUN_SPECS, "latest")
    warehouse_run.run(spark, lambda spec: source(spark, sf, spec.name), base, tomorrow, ETL_USER, RUN_SPECS, "latest")
    return quality.union_checks(list(_fact_figures(tables, tomorrow)))


RUN_MARKS = (datetime(1996, 1, 1), datetime(1997, 6, 1))


def _source_until(spark, sf, spec, until: datetime | None):
    """A source table as it was at a moment: orders by their time, what belongs to orders with them, users by theirs."""
    rows = source(spark, sf, spec.name)
    if until is None or spec.name in ("drivers", "notifications"):
        return rows
    made = F.col("created_at").isNull() | (F.col("created_at") <= moment(until))
    if spec.name in ("orders", "users"):
        return rows.filter(made)
    return rows.join(source(spark, sf, "orders").filter(made).select("order_id"), "order_id", "left_semi").select(rows.columns)


@query
def incremental_runs(spark, sf):
    """A full run, an increment, the same increment again, and the next day's: each row once, as one full run has them."""
    base, days = new_work_path(spark, "run"), [AS_OF + timedelta(days=i) for i in range(3)]
    tables, zones = VersionedTables(spark, f"{base}/warehouse"), Zones(spark, base)
    for at, until in ((days[0], RUN_MARKS[0]), (days[1], RUN_MARKS[1]), (days[1], RUN_MARKS[1]), (days[2], None)):
        warehouse_run.run(
            spark, lambda spec, t=until: _source_until(spark, sf, spec, t), base, at, ETL_USER, RUN_SPECS, "latest", incremental=True
        )
    landed = [
        zones.newest(s.name, s.key).agg(
            F.lit(s.name).alias("table_name"),
            F.count(F.lit(1)).alias("fact_rows"),
            F.count_distinct(s.key).alias("natural_keys"),
            F.lit(0).cast("long").alias("values"),
            F.lit(0).cast("long").alias("others"),
            F.lit(0).cast("long").alias("moved_keys"),
        )
        for s in RUN_SPECS
        if s.name in ("orders", "payments", "users")
    ]
    return quality.union_checks([*_fact_figures(tables, days[1]), *landed])


@query
def warehouse_conformance(spark, sf):
    """The declared rules of every warehouse table against what a run loaded. One is broken: the test tables number shipments
    in text, where whole numbers are declared."""
    base = new_work_path(spark, "run")
    warehouse_run.run(spark, lambda spec: source(spark, sf, spec.name), base, AS_OF, ETL_USER, RUN_SPECS, payment_methods=True)
    tables = VersionedTables(spark, f"{base}/warehouse")
    checked = [quality.schema_conformance(tables.current(t), t, rules) for t, rules in TABLES.items()]
    return quality.union_checks(checked).filter("NOT passed").select("table_name", "check_name", "value")


# --- order lifecycle ---------------------------------------------------------------


@query
def advance_status(spark, sf):
    return lifecycle.advance_status(source(spark, sf, "orders"), LIFE_AS_OF).select(
        "order_id", "previous_status", "status"
    )


@query
def initial_status(spark, sf):
    """Initial status of every order, with limits of days that suit the tables' whole-day times."""
    status = lifecycle.initial_status(LIFE_AS_OF, timedelta(days=30), timedelta(days=120))
    return source(spark, sf, "orders").select("order_id", status.alias("status"))


AGE_STEPS_DAYS = (
    ("processing", timedelta(days=100)),
    ("accepted", timedelta(days=300)),
    ("in_transit", timedelta(days=900)),
)


@query
def status_by_age(spark, sf):
    status = lifecycle.status_by_age(AS_OF, AGE_STEPS_DAYS)
    return source(spark, sf, "orders").groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query
def shipment_status_map(spark, sf):
    orders = source(spark, sf, "orders")
    status = lifecycle.shipment_status(lifecycle.status_by_age(AS_OF, AGE_STEPS_DAYS))
    return orders.select("order_id", status.alias("shipment_status"))


def _changes(spark, sf):
    return lifecycle.status_changes(source(spark, sf, "orders"), LIFE_AS_OF)


@query
def shipment_cascade(spark, sf):
    return lifecycle.cascade_to_shipments(source(spark, sf, "shipments"), _changes(spark, sf))


@query
def payment_cascade(spark, sf):
    return lifecycle.cascade_to_payments(source(spark, sf, "instalments"), _changes(spark, sf), LIFE_AS_OF)


@query
def status_notifications(spark, sf):
    return lifecycle.status_notifications(_changes(spark, sf), LIFE_AS_OF)


@query
def notification_timeline(spark, sf):
    return lifecycle.notification_timeline(source(spark, sf, "orders"))


def _dispatched(spark, sf, as_of: datetime, undated: str):
    """Shipments with the status they have at a moment: those due later are on their way."""
    due = F.col("estimated_delivery_time") <= moment(as_of)
    status = F.when(due, "completed").when(~due, "in_transit").otherwise(undated)
    return source(spark, sf, "shipments").withColumn("status", status)


@query
def available_drivers(spark, sf):
    return lifecycle.available_drivers(
        source(spark, sf, "drivers"), _dispatched(spark, sf, datetime(1995, 1, 8), undated="in_transit")
    )


@query
def idle_drivers(spark, sf):
    return lifecycle.idle_drivers(
        source(spark, sf, "drivers"), _dispatched(spark, sf, datetime(2001, 10, 25), undated="completed")
    )


@query
def active_users(spark, sf):
    return lifecycle.active_users(source(spark, sf, "users"))


# --- text --------------------------------------------------------------------------


@query
def fold_accents_documents(spark, sf):
    return table(spark, sf, "documents").select("doc_id", fold_accents("text").alias("folded"))


@query
def normalise_contact(spark, sf):
    return table(spark, sf, "documents").select("doc_id", contact_handle("text").alias("handle"))


def _lines_of_address(spark, sf):
    nations = table(spark, sf, "nation").join(table(spark, sf, "region"), F.expr("n_regionkey = r_regionkey"))
    orders = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.expr("o_custkey = c_custkey"))
    return orders.join(nations, F.expr("c_nationkey = n_nationkey")).select(
        F.col("o_orderkey").alias("order_id"),
        full_address(F.col("o_custkey"), F.col("o_orderpriority"), F.col("n_name"), F.col("r_name")).alias("address"),
    )


@query
def full_addresses(spark, sf):
    """Composed addresses, their parts read back in their own layout, and a copy cut to a column's length."""
    address = F.col("address")
    return _lines_of_address(spark, sf).select(
        "order_id",
        address,
        address_city(address, "street_district_city").alias("city"),
        address_district(address, "street_district_city").alias("district"),
        clip(address, 30).alias("clipped"),
    )


@query
def address_parts(spark, sf):
    orders = source(spark, sf, "orders")
    return orders.select(
        "order_id",
        address_city("pickup_address").alias("pickup_city"),
        address_district("pickup_address").alias("pickup_district"),
        address_city("delivery_address").alias("delivery_city"),
        address_district("delivery_address").alias("delivery_district"),
        date_key("delivery_time").alias("delivery_date_key"),
    )
