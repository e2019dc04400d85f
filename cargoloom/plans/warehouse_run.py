"""One whole run: land, build, save, load the warehouse, check, record."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime
from time import monotonic

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargoloom.functions.moments import batch_id
from cargoloom.operators.keys import KnownKeys
from cargoloom.operators.quality import cast_to_declared, orphan_checks, union_checks
from cargoloom.operators.upsert import updatable_columns, upsert
from cargoloom.plans.dimensions import dim_date_covering, dim_driver, dim_location, dim_payment_method, dim_user
from cargoloom.plans.facts import ORDER_FACT_KEY, fact_orders, fact_shipment_tracking
from cargoloom.plans.landing import Metric, Reader, each, land_all
from cargoloom.plans.metrics import metric_rows, save_metrics, transform_metrics
from cargoloom.plans.warehouse_schema import FOREIGN_KEYS, TABLES, foreign_key_columns
from cargoloom.session import new_work_path, run_settings, stored_frame, work_scope
from cargoloom.sinks.versions import VersionedTables
from cargoloom.sinks.zones import Zones
from cargoloom.sources.jdbc import JdbcSource
from cargoloom.sources.specs import LOGISTICS_TABLES, ROWS_PER_PARTITION, TableSpec



#: What a run brings facts of: all of an owner's facts come together. Then their key.
FACT_OWNERS = {"fact_orders": ("order_id", "order_key"), "fact_shipment_tracking": ("shipment_id", "tracking_key")}
#: Columns that tell when facts were written: alone they don't make them other facts.
AUDIT = ("etl_timestamp", "etl_user")
#: Dimensions of at most so many rows, of which a lookup takes two numbers, are broadcast.
BROADCAST_ROWS = 500_000


def merged_dimension(tables: VersionedTables, df: DataFrame, table: str, key: str, as_of: datetime) -> DataFrame:
    """A dimension, in its declared types, merged into the warehouse as it was before ``as_of``, by its key; foreign keys of
    known rows stay untouched."""
    df, current = cast_to_declared(df, TABLES[table], keep_text_ids=True), tables.before(table, as_of)
    if current is None:
        return df
    return upsert(current, df, key, updatable_columns(df, key, foreign_key_columns(table)))


def load_dimension(tables: VersionedTables, df: DataFrame, table: str, key: str, as_of: datetime) -> int:
    """Publish the merged dimension. A repeat of the run merges into the same state again."""
    return tables.publish(merged_dimension(tables, df, table, key, as_of), table, as_of, key=key)


def load_fact(tables: VersionedTables, df: DataFrame, table: str, as_of: datetime) -> int:
    """Merge facts, in their declared types, into the warehouse as it was before ``as_of``: all facts of an order or
    shipment that is there again, and changed, give way to the new ones. Buckets without any are not written."""
    owner, key = FACT_OWNERS[table]
    return tables.merge(cast_to_declared(df, TABLES[table], keep_text_ids=True), table, as_of, owner, key, AUDIT)


def load_keys(tables: VersionedTables, df: DataFrame, table: str, natural: Sequence[str], key: str, as_of: datetime) -> int:
    """Keys given to facts, in a table of their own as facts don't show all that tells them apart. A natural key that does not
    come with its owner any more keeps its key, should it come back. So rows are added, those of keys above the highest one given
    before. Only where a key given before comes several times, all rows of the owners that came are merged."""
    owner, known, highest = natural[0], tables.before(table, as_of), tables.highest_key(table, as_of)
    df = df.select(key, *natural)
    if known is None:
        return tables.add(df, table, as_of, owner, key)
    given = df.where(F.col(key) <= highest).groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    if given.where("__n > 1").isEmpty():
        return tables.add(df.where(F.col(key) > highest), table, as_of, owner, key)
    came = df.select(F.col(owner).alias("__owner")).distinct()
    held = known.join(came, F.col(owner).eqNullSafe(F.col("__owner")), "left_semi")
    df = df.unionByName(held.join(df.select(key), key, "left_anti"))
    return tables.merge(df, table, as_of, owner, key)


def keys_of(tables: VersionedTables, table: str, as_of: datetime, incoming: DataFrame, owner: str) -> KnownKeys | None:
    """The keys known before ``as_of`` of owners between the least and the greatest incoming one, so that parquet skips the rest."""
    known = tables.known_keys(table, as_of)
    if known is None:
        return None
    low, high = incoming.agg(F.min(owner), F.max(owner)).first()
    inside = F.col(owner).isNull() if low is None else F.col(owner).isNull() | F.col(owner).between(F.lit(low), F.lit(high))
    return KnownKeys(known.rows.where(inside), known.highest)


def load_database(
    target: JdbcSource,
    dims: dict[str, DataFrame],
    facts: dict[str, DataFrame],
    rows_per_partition: int = ROWS_PER_PARTITION,
) -> None:
    """Load a relational warehouse: dimensions staged as ``temp_dim_*`` for its merge, then facts appended."""
    for name, df in dims.items():
        target.stage(cast_to_declared(df, TABLES[f"dim_{name}"]), f"dim_{name}")
    for name, df in facts.items():
        target.append(cast_to_declared(df, TABLES[f"fact_{name}"]), f"fact_{name}", rows_per_partition)


def arrived(
    spark: SparkSession, zones: Zones, warehouse: VersionedTables, specs: Sequence[TableSpec], as_of: datetime
) -> dict[str, DataFrame]:
    """What a run must build anew after an increment: rows that came, and all that belongs to an order that came itself, with a
    payment, or whose user is new. Rows are in their newest state; a table that is loaded whole comes whole."""
    by_name = {s.name: s for s in specs}
    came = {n: zones.batch(n, as_of) for n in ("users", "drivers", "orders", "shipments", "payments")}
    whole = {n: all(e["whole"] for e in zones.loads(n).values()) for n in ("orders", "payments", "shipments")}
    if all(whole.values()):
        return came
    path = new_work_path(spark, "orders-that-came")
    orders = zones.newest("orders", by_name["orders"].key)
    touched = came["orders"].select("order_id").unionByName(came["payments"].select("order_id"))
    users = warehouse.before("dim_user", as_of)
    if users is not None:
        late = came["users"].select("user_id").join(users.select("user_id"), "user_id", "left_anti")
        touched = touched.unionByName(orders.select("order_id", "user_id").join(late, "user_id", "left_semi").select("order_id"))
    touched.distinct().write.parquet(path)
    ids = spark.read.parquet(path).select(F.col("order_id").alias("__id"))
    raw = dict(came)
    # What came whole names all of its orders. Anything else is read many times, so it is found once.
    for name, rows in (("orders", orders), ("payments", zones.newest("payments", by_name["payments"].key))):
        if not whole[name]:
            raw[name] = stored_frame(rows.join(ids, F.col("order_id").eqNullSafe(F.col("__id")), "left_semi"), f"{name}-that-came")
    if not whole["shipments"]:
        # Of a source with marks: shipments that came, and those whose order did.
        rows, own = zones.newest("shipments", by_name["shipments"].key), came["shipments"].select(F.col("shipment_id").alias("__own"))
        rows = rows.join(own.distinct().withColumn("__came", F.lit(True)), F.col("shipment_id").eqNullSafe(F.col("__own")), "left")
        rows = rows.join(ids.withColumn("__with", F.lit(True)), F.col("order_id").eqNullSafe(F.col("__id")), "left")
        raw["shipments"] = stored_frame(rows.where("__came OR __with").drop("__own", "__came", "__id", "__with"), "shipments-that-came")
    return raw


def build_tables(
    spark: SparkSession,
    zones: Zones,
    warehouse: VersionedTables,
    raw: dict[str, DataFrame],
    as_of: datetime,
    etl_user: str,
    payment_policy: str = "all",
    payment_methods: bool = False,
    incremental: bool = False,
) -> tuple[dict[str, DataFrame], dict[str, DataFrame], dict[str, DataFrame], list[Metric]]:
    """Build and save dimensions and facts of ``raw`` rows; later steps read what was saved.

    Returns the dimensions, the facts, what their foreign keys refer to, and metrics. The last are the dimensions, or, where an
    increment brings only some rows of them, the warehouse's merged with these.
    """
    metrics: list[Metric] = []
    known = {t: warehouse.known_keys(f"dim_{t}", as_of) for t in ("user", "driver", "location")}

    def save_dim(name: str, build: Callable[[], DataFrame]) -> tuple[DataFrame, DataFrame]:
        started, table = monotonic(), f"dim_{name}"
        rows = zones.load_processed(build(), table)
        metrics.extend([("build", table, "rows", rows), ("build", table, "seconds", monotonic() - started)])
        saved = zones.read("processed", table, merge_schema=False)
        if not incremental:
            small = rows <= BROADCAST_ROWS and name in ("user", "driver")
            return saved, F.broadcast(saved) if small else saved
        path = new_work_path(spark, f"merged-{table}")
        merged = merged_dimension(warehouse, saved, table, f"{name}_key", as_of)
        merged.write.parquet(path)
        return saved, spark.read.schema(merged.schema).parquet(path)

    def build_users_and_drivers() -> dict[str, tuple[DataFrame, DataFrame]]:
        user = save_dim("user", lambda: dim_user(raw["users"], as_of, known["user"]))
        driver = save_dim("driver", lambda: dim_driver(raw["drivers"], user[1], as_of, known["driver"]))
        return {"user": user, "driver": driver}

    def build_dates() -> dict[str, tuple[DataFrame, DataFrame]]:
        return {"date": save_dim("date", lambda: dim_date_covering(dates_of(raw), "day"))}

    def build_locations() -> dict[str, tuple[DataFrame, DataFrame]]:
        return {"location": save_dim("location", lambda: dim_location(raw["orders"], as_of, known["location"]))}

    def build_methods() -> dict[str, tuple[DataFrame, DataFrame]]:
        return {"payment_method": save_dim("payment_method", lambda: dim_payment_method(spark))}

    parts = [build_dates, build_users_and_drivers, build_locations, *([build_methods] if payment_methods else [])]
    built = {name: pair for part in each(parts) for name, pair in part.items()}
    dims, lookups = {n: p[0] for n, p in built.items()}, {n: p[1] for n, p in built.items()}

    def save_fact(table: str, build: Callable[[], DataFrame]) -> DataFrame:
        started = monotonic()
        rows = zones.load_processed(build(), table)
        metrics.extend([("build", table, "rows", rows), ("build", table, "seconds", monotonic() - started)])
        return zones.read("processed", table, merge_schema=False)

    held = save_fact(
        "fact_orders",
        lambda: fact_orders(
            raw["orders"],
            raw["payments"],
            lookups["user"],
            lookups["location"],
            as_of,
            etl_user,
            payment_policy,
            dim_payment_method=lookups.get("payment_method"),
            known_keys=keys_of(warehouse, "keys_fact_orders", as_of, raw["orders"], "order_id"),
            with_natural_key=True,
        ),
    )
    orders = held.drop(*ORDER_FACT_KEY[1:])
    given, earlier = orders.select("order_id", "order_key"), warehouse.before("fact_orders", as_of)
    if incremental and earlier is not None:
        came = given.select(F.col("order_id").alias("__id")).distinct()
        rest = earlier.select("order_id", "order_key").join(came, F.col("order_id").eqNullSafe(F.col("__id")), "left_anti")
        given = given.unionByName(rest)

    def track() -> DataFrame:
        tracked = save_fact(
            "fact_shipment_tracking",
            lambda: fact_shipment_tracking(
                raw["shipments"],
                given,
                lookups["driver"],
                as_of,
                etl_user,
                known_keys=keys_of(warehouse, "keys_fact_shipment_tracking", as_of, raw["shipments"], "shipment_id"),
                with_natural_key=True,
            ),
        )
        load_keys(warehouse, tracked, "keys_fact_shipment_tracking", ("shipment_id", "shipment_copy"), "tracking_key", as_of)
        return tracked

    # The orders' keys are written beside the shipments' facts, which do not need them.
    tracked, _ = each([track, lambda: load_keys(warehouse, held, "keys_fact_orders", ORDER_FACT_KEY, "order_key", as_of)])
    refer = {**{f"dim_{n}": df for n, df in lookups.items()}, "fact_orders": given}
    return dims, {"orders": orders, "shipment_tracking": tracked.drop("shipment_copy")}, refer, metrics


def dates_of(raw: dict[str, DataFrame]) -> DataFrame:
    """All days that a fact's date key may name."""
    ordered = raw["orders"].select(F.col("created_at").cast("date").alias("day"))
    due = raw["shipments"].select(F.col("estimated_delivery_time").cast("date").alias("day"))
    return ordered.unionAll(due)


def reference_checks(
    dims: dict[str, DataFrame], facts: dict[str, DataFrame], refer: dict[str, DataFrame] | None = None
) -> DataFrame:
    """Orphans of every foreign key. ``refer`` holds what keys refer to where that is more than the tables given."""
    tables = {**{f"dim_{n}": d for n, d in dims.items()}, **{f"fact_{n}": d for n, d in facts.items()}}
    others = refer or tables
    return union_checks(
        [
            orphan_checks(tables[table], table, [(fk, others[other], pk) for fk, other, pk in references])
            for table, references in FOREIGN_KEYS.items()
            if table in tables
        ]
    )


def run(
    spark: SparkSession,
    read: Reader,
    base_path: str,
    as_of: datetime,
    etl_user: str,
    specs: Sequence[TableSpec] = LOGISTICS_TABLES,
    payment_policy: str = "all",
    required_checks: Sequence[str] = (),
    payment_methods: bool = False,
    incremental: bool = False,
) -> DataFrame:
    """Run everything for ``as_of`` and return the run's metrics, which are also saved.

    The processed zone holds the tables of the last run. The warehouse holds every dimension row and fact once, with the
    key it was first given: each run merges into the warehouse as it was before ``as_of``, so the same run may be
    repeated, or finished after it broke off. An ``as_of`` older than what the warehouse holds is refused.
    With ``incremental`` sources are read above the mark of the loads before (whole where they have none), and only what belongs to
    the rows that came is built and merged. The warehouse is then as after a full run, but for facts of rows deleted at the source.
    With ``payment_methods`` their dimension is built and looked up too. The checks come before the warehouse: all are recorded, and a failed one among
    ``required_checks`` (such as ``duplicate_keys``) stops the run.
    """
    zones = Zones(spark, base_path)
    warehouse = VersionedTables(spark, f"{base_path.rstrip('/')}/warehouse")
    newest = warehouse.current_version("dim_user")
    if newest is not None and newest > batch_id(as_of):
        raise ValueError(f"the warehouse has version {newest}, newer than {batch_id(as_of)}")
    with run_settings(spark):
        return _run(spark, read, zones, warehouse, base_path, as_of, etl_user, specs, payment_policy, required_checks, payment_methods, incremental)


def _run(
    spark, read, zones, warehouse, base_path, as_of, etl_user, specs, payment_policy, required_checks, payment_methods, incremental
) -> DataFrame:
    with work_scope(spark):
        metrics = land_all(read, zones, as_of, specs, incremental=incremental)
        each([lambda s=s: zones.drop_replaced(s.name) for s in specs])
        names = ("users", "drivers", "orders", "shipments", "payments")
        raw = arrived(spark, zones, warehouse, specs, as_of) if incremental else {n: zones.batch(n, as_of) for n in names}
        dims, facts, refer, built = build_tables(
            spark, zones, warehouse, raw, as_of, etl_user, payment_policy, payment_methods, incremental
        )
        # One row per table and check, some dozens in all.
        checks = union_checks([transform_metrics(dims, facts), reference_checks(dims, facts, refer)]).collect()
    failed = [f"{c.table_name}.{c.check_name}" for c in checks if c.check_name in required_checks and not c.passed]
    if failed:
        raise ValueError(f"failed checks: {failed}")
    checked = [("checks", c.table_name, c.check_name, c.value) for c in checks]

    def load(name: str) -> Metric:
        table = f"dim_{name}"
        return ("warehouse", table, "rows", load_dimension(warehouse, dims[name], table, f"{name}_key", as_of))

    def load_facts(name: str) -> Metric:
        return ("warehouse", f"fact_{name}", "rows", load_fact(warehouse, facts[name], f"fact_{name}", as_of))

    loaded = each([lambda n=n: load(n) for n in dims])
    loaded += each([lambda n=n: load_facts(n) for n in facts])
    written = (*[f"dim_{n}" for n in dims], *FACT_OWNERS, *[f"keys_{t}" for t in FACT_OWNERS])
    each([lambda t=t: warehouse.vacuum(t, keep_versions=None) for t in written])
    rows = metric_rows(spark, as_of, [*metrics, *built, *checked, *loaded])
    save_metrics(rows, base_path)
    saved = spark.read.parquet(f"{base_path.rstrip('/')}/metrics")
    return saved.filter(F.col("run_id") == batch_id(as_of)).select(rows.columns)
