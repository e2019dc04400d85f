"""What several operators share: written intermediate tables, prefix sums, null-safe texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cargoloom.session import new_work_path


def saved(df: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared work folder and read back: a short lineage that outlives executors."""
    path = new_work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def saved_with(df: DataFrame, label: str, figure: Column) -> tuple[DataFrame, object]:
    """:func:`saved`, and one aggregate of all rows that the write itself observes: no second job."""
    seen = Observation()
    out = saved(df.observe(seen, figure.alias("figure")), label)
    return out, seen.get["figure"]


def identified_texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and whole ``text`` (null: empty) of the rows with an id; every other column is left behind."""
    return docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )


def in_id_order(docs: DataFrame) -> DataFrame:
    """The frame in one global order of ``doc_id`` (equal ids: by text), cut into ranges that tasks hold in order.

    Every range is sorted; a lower range number has lower ids. Only ids decide the ranges, so rows
    with one id stay together.
    """
    return docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"), "text")


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """A batch's texts; null is empty."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def numbers_of(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def sliced(batches: Iterator[pa.RecordBatch], most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that their buffers stay near ``most_bytes``, long texts or not."""
    for batch in batches:
        rows = max(1, int(batch.num_rows * most_bytes / max(batch.nbytes, 1)))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def taken(flat: np.ndarray, sizes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ``rows`` of lists laid end to end in ``flat``, laid end to end, and their sizes."""
    n = sizes[rows]
    starts = (np.cumsum(sizes) - sizes)[rows]
    return flat[np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))], n


def give_back_memory(spark: SparkSession) -> None:
    """Python workers of this session hand freed memory back to the system, so that one that lives through many stages does not keep
    the most that each of them needed: Arrow takes its memory from the C library, which has one pool and trims it. Batches of texts are
    handed to workers some 8 MB at a time, as ``sliced`` would cut them: both ends of the pipe hold a batch or two."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    settings = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "1", "MALLOC_TRIM_THRESHOLD_": str(8 << 20)}
    spark.sparkContext.environment.update(settings)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


Query = Callable[[SparkSession, str], DataFrame]
