"""Run metrics as rows."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargoloom.functions.moments import batch_id, moment
from cargoloom.operators.quality import key_checks, null_key_checks, union_checks

BUILD_VERSION = "1.0.0"
FACT_KEYS = {"fact_orders": "order_key", "fact_shipment_tracking": "tracking_key"}
METRIC_SCHEMA = "run_id string, phase string, table_name string, metric string, value double"


def metric_rows(
    spark: SparkSession, as_of: datetime, rows: Iterable[tuple[str, str, str, float]]
) -> DataFrame:
    """``(phase, table, metric, value)`` tuples, some dozens per run, as a frame."""
    run_id = batch_id(as_of)
    return spark.createDataFrame([(run_id, p, t, m, float(v)) for p, t, m, v in rows], METRIC_SCHEMA)


def transform_metrics(dimensions: dict[str, DataFrame], facts: dict[str, DataFrame]) -> DataFrame:
    """Row counts and key checks of the built tables: one aggregation per table."""
    parts = [key_checks(df, f"dim_{name}", f"{name}_key") for name, df in dimensions.items()]
    for name, df in facts.items():
        keys = [c for c in df.columns if c.endswith("_key")]
        parts.append(null_key_checks(df, f"fact_{name}", keys))
        own = key_checks(df, f"fact_{name}", FACT_KEYS[f"fact_{name}"])
        parts.append(own.filter("check_name = 'duplicate_keys'"))
    return union_checks(parts)


def with_build_metadata(df: DataFrame, builder: str, as_of: datetime, user: str) -> DataFrame:
    return df.withColumns(
        {
            "builder": F.lit(builder),
            "build_timestamp": moment(as_of),
            "build_user": F.lit(user),
            "version": F.lit(BUILD_VERSION),
        }
    )


def save_metrics(metrics: DataFrame, base_path: str) -> None:
    """Add a run's rows to the metrics table; the same run again replaces its own rows."""
    (
        metrics.coalesce(1)  # some dozens of rows
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id")
        .parquet(f"{base_path.rstrip('/')}/metrics")
    )
