"""Incremental landing of sources that arrive as files.

A relational source is read above a high-water mark (``sources.incremental``). For a folder
of files Structured Streaming keeps the mark itself: its checkpoint records which files were
landed, so each run takes the new ones and a run that dies is repeated without loss.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cargoloom.functions.moments import batch_id
from cargoloom.functions.text import trim_padding
from cargoloom.sinks.zones import Zones
from cargoloom.sources.specs import TableSpec


def land_new_files(
    spark: SparkSession,
    folder: str,
    schema: StructType | str,
    zones: Zones,
    spec: TableSpec,
    checkpoint: str,
    as_of: datetime,
    max_files_per_batch: int = 10_000,
) -> None:
    """Land the parquet files that came since the last call, in micro-batches, then stop.

    ``checkpoint`` must be a folder of this table's own that all executors share. Each
    micro-batch is an increment of the raw zone, named by ``as_of`` and its number, so a repeated one replaces
    what it had written. After a checkpoint is lost, the next call lands all files again under its own ``as_of``: begin with
    a full load then, which replaces the increments before it.
    """

    def write(batch: DataFrame, number: int) -> None:
        zones.land_batch(trim_padding(batch, spec.padded), spec, as_of, f"{batch_id(as_of)}_{number:06d}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_batch).parquet(folder)
    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
