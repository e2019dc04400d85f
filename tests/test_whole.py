import re
from datetime import timedelta
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from cargoloom.adapters import TABLES, source
from cargoloom.plans import warehouse_run
from cargoloom.sinks.versions import VersionedTables
from cargoloom.workload.queries import AS_OF, RUN_SPECS

SMALL = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not Path(SMALL).exists(), reason="test tables not present")


def test_registry():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    own = {n for n in contract.queries() if n != "pipeline" and not re.match(r"op\d+_", n)}
    assert own <= set(contract.oracle_sql())


@needs_data
@pytest.mark.parametrize("name", ["city_delivery", "fact_orders_fanout_all", "surrogate_key_stable", "notification_timeline"])
def test_query_equals_its_sql(spark, rows, name):
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    df = contract.queries()[name](spark, SMALL)
    result = connection.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert rows(df.select(columns)) == sorted(result.fetchall(), key=repr)


@needs_data
def test_second_run_keeps_keys_and_history(spark, tmp_path):
    """A later run with more orders: location keys stay, fact keys stay unique, each run is one batch."""

    def early(spec):
        df = source(spark, SMALL, spec.name)
        return df.filter(F.col("created_at") < "1999-01-01") if spec.name == "orders" else df

    base, later = str(tmp_path), AS_OF + timedelta(days=1)
    warehouse = VersionedTables(spark, f"{base}/warehouse")
    warehouse_run.run(spark, early, base, AS_OF, "me")
    before = {r.full_address: r.location_key for r in warehouse.current("dim_location").collect()}
    metrics = warehouse_run.run(spark, lambda s: source(spark, SMALL, s.name), base, later, "me")
    after = {r.full_address: r.location_key for r in warehouse.current("dim_location").collect()}
    assert len(after) > len(before) and {a: after[a] for a in before} == before
    assert sorted(after.values()) == list(range(1, len(after) + 1))

    for name, key, own in (("fact_orders", "order_key", "order_id"), ("fact_shipment_tracking", "tracking_key", "shipment_id")):
        now, then = warehouse.current(name), warehouse.before(name, later)
        assert now.count() == now.select(key).distinct().count() == now.select(own).distinct().count()
        given = {r[own]: r[key] for r in then.collect()}
        kept = {r[own]: r[key] for r in now.collect()}
        assert given and {o: kept[o] for o in given} == given
    assert dict(warehouse.current("fact_orders").dtypes)["order_amount"] == "decimal(10,2)"
    assert metrics.filter("metric = 'orphans_order_key' and value > 0").count() == 0
    assert metrics.select("run_id").distinct().collect() == [("20010803_093000",)]

    # Shipments of drivers without a user have no driver key: as a required check that stops the load.
    with pytest.raises(ValueError, match="null_driver_key"):
        warehouse_run.run(
            spark,
            lambda s: source(spark, SMALL, s.name),
            base,
            later + timedelta(days=1),
            "me",
            required_checks=["null_driver_key"],
        )
    assert warehouse.current_version("dim_user") == "20010803_093000"


@needs_data
def test_a_run_that_breaks_in_the_fact_load_can_be_finished(spark, tmp_path, monkeypatch):
    base, read = str(tmp_path), lambda s: source(spark, SMALL, s.name)
    warehouse = VersionedTables(spark, f"{base}/warehouse")

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as m, pytest.raises(OSError):
        m.setattr(warehouse_run, "load_fact", broken)
        warehouse_run.run(spark, read, base, AS_OF, "me", RUN_SPECS)
    assert warehouse.current("dim_user") is not None and warehouse.current("fact_orders") is None
    warehouse_run.run(spark, read, base, AS_OF, "me", RUN_SPECS)
    once = {n: warehouse.current(n).count() for n in ("dim_user", "dim_location", "fact_orders")}
    warehouse_run.run(spark, read, base, AS_OF, "me", RUN_SPECS)
    assert once == {n: warehouse.current(n).count() for n in once}
    with pytest.raises(ValueError, match="newer"):
        warehouse_run.run(spark, read, base, AS_OF - timedelta(days=1), "me", RUN_SPECS)


@needs_data
def test_filters_and_columns_reach_the_scan(spark):
    plan = contract.queries()["incremental_extract"](spark, SMALL)._jdf.queryExecution().toString()
    assert "GreaterThan(ts," in plan
    plan = contract.queries()["order_time_range"](spark, SMALL)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan


@needs_data
@pytest.mark.parametrize("name", ["dim_location", "fact_shipment_tracking", "shipment_cascade", "orphan_counts"])
def test_no_cross_join_and_no_python_in_plans(spark, name):
    plan = contract.queries()[name](spark, SMALL)._jdf.queryExecution().toString()
    for step in ("Cartesian", "BroadcastNestedLoop", "PythonUDF", "MapInPandas"):
        assert step not in plan
