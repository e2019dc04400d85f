"""The raw, staging and processed zones: parquet under one base path."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cargoloom.functions.moments import batch_id, moment, moment_date
from cargoloom.session import all_shuffle_tasks, delete_path, path_exists
from cargoloom.sources.specs import TableSpec

_INCREMENT_LOG = (
    "number int, batch string, attempt int, rows long, mark timestamp_ntz, whole boolean, schema string"
)
ZONES = ("raw", "staging", "processed")
LINEAGE = ("dl_ingestion_timestamp", "dl_source_table", "dl_batch_id", "dl_process_date")


def with_lineage(df: DataFrame, table: str, as_of: datetime) -> DataFrame:
    return df.withColumns(
        {
            "dl_ingestion_timestamp": moment(as_of),
            "dl_source_table": F.lit(table),
            "dl_batch_id": F.lit(batch_id(as_of)),
            "dl_process_date": moment_date(as_of),
        }
    )


def with_file_partitions(df: DataFrame, spec: TableSpec) -> tuple[DataFrame, list[str]]:
    """The frame with its derived day columns, and the names to partition the files by."""
    days = {f"{c}_partition": _formatted(c, spec.partition_format) for c in spec.date_partitions}
    return (df.withColumns(days) if days else df), [*days, *spec.partitions]


def _formatted(column: str, form: str) -> Column:
    """A date in a format. Four-digit years need no formatter for each row."""
    formatted, year = F.date_format(column, form), F.year(column)
    return F.when(year.between(1000, 9999), year.cast("string")).otherwise(formatted) if form == "yyyy" else formatted


def write_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()
) -> int:
    """Write snappy parquet and return the row count, taken during the write.

    Partitioned writes are first rebalanced on the partition columns: each directory gets
    few files of the advisory size, and adaptive execution splits the directory that
    holds a large part of all rows over several tasks. The directories are dealt to all
    shuffle tasks, even where there are few bytes: small files cost time, not bytes.
    """
    counted = Observation()
    write_rows(df.observe(counted, F.count(F.lit(1)).alias("n")), path, mode, partition_by)
    return figures(counted)["n"]


def figures(seen: Observation) -> dict:
    """What was observed on a write. Of a frame that Catalyst knows to be empty nothing is written or observed: no rows."""
    try:
        return seen.get
    except Py4JJavaError:
        return {"n": 0}


def write_rows(df: DataFrame, path: str, mode: str, partition_by: Sequence[str] = (), gather: bool = True) -> None:
    """Write rows; without ``gather`` each task writes its own files into the directories: for some dozens of them, where moving
    all rows costs more than the files do."""
    if not (partition_by and gather):
        writer = df.write.mode(mode).option("compression", "snappy")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
        return
    with all_shuffle_tasks(df.sparkSession):
        writer = df.hint("rebalance", *partition_by).write.mode(mode).option("compression", "snappy")
        writer.partitionBy(*partition_by).parquet(path)


def write_batch(df: DataFrame, path: str, as_of: datetime) -> int:
    """Write ``df`` as the batch ``as_of`` of a table, in place of an earlier attempt at the same batch.

    Every row goes to the batch's one directory, so nothing is shuffled to gather rows.
    """
    counted = Observation()
    (
        df.withColumn("dl_batch_id", F.lit(batch_id(as_of)))
        .observe(counted, F.count(F.lit(1)).alias("n"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dl_batch_id")
        .parquet(path)
    )
    return figures(counted)["n"]


@dataclass(frozen=True)
class Zones:
    spark: SparkSession
    base_path: str

    def path(self, zone: str, table: str) -> str:
        if zone not in ZONES:
            raise ValueError(f"zone must be one of {ZONES}, not {zone!r}")
        return f"{self.base_path.rstrip('/')}/{zone}/{table}"

    # A raw table is its last full load and the increments since. Each is a batch, each attempt at a batch has a directory of its
    # own and, once written, a row in the table's small log with its row count and mark; readers take the last attempt at each.
    # So a load is there as a whole or not at all, a repeat replaces its batch whatever file partitions the rows are in,
    # another batch of the same day stands beside it, and the next mark is known after full loads and increments alike.

    def _place(self, table: str) -> str:
        return f"{self.path('raw', table)}__increments"

    def _attempt_path(self, table: str, batch: str, attempt: int, whole: bool) -> str:
        return f"{self._place(table)}/{'whole' if whole else 'batches'}/dl_increment={batch}/dl_attempt={attempt}"

    def _log(self, table: str) -> list:
        path = f"{self._place(table)}/log"
        if not path_exists(self.spark, path):
            return []
        return sorted(self.spark.read.schema(_INCREMENT_LOG).parquet(path).collect(), key=lambda e: e["number"])

    def loads(self, table: str) -> dict[str, object]:
        """The last attempt's log row of each batch, from the last full load on: one small row per batch."""
        found: dict[str, object] = {}
        for entry in self._log(table):
            if entry["whole"]:
                found.clear()
            found[entry["batch"]] = entry
        return found

    def increments(self, table: str) -> dict[str, object]:
        return {batch: e for batch, e in self.loads(table).items() if not e["whole"]}

    def _land(self, df: DataFrame, spec: TableSpec, as_of: datetime, batch: str, whole: bool):
        rows, partition_by = with_file_partitions(with_lineage(df, spec.name, as_of), spec)
        log = self._log(spec.name)
        attempt = 1 + sum(1 for e in log if e["batch"] == batch)
        marked = spec.incremental_column and spec.incremental_column in df.columns
        mark = F.max(F.col(spec.incremental_column).cast("timestamp_ntz")) if marked else F.lit(None).cast("timestamp_ntz")
        seen = Observation()
        counted = rows.observe(seen, F.count(F.lit(1)).alias("n"), mark.alias("mark"))
        # A directory per year or status makes dozens; a directory per day makes thousands.
        many = bool(spec.date_partitions) and spec.partition_format != "yyyy"
        write_rows(counted, self._attempt_path(spec.name, batch, attempt, whole), "overwrite", partition_by, gather=many)
        n, reached = figures(seen)["n"], figures(seen).get("mark")
        number = 1 + max((e["number"] for e in log), default=-1)
        entry = (number, batch, attempt, n, reached, whole, rows.schema.json())
        row = self.spark.createDataFrame([entry], _INCREMENT_LOG)
        row.coalesce(1).write.mode("append").parquet(f"{self._place(spec.name)}/log")
        return n, reached

    def land_raw(self, df: DataFrame, spec: TableSpec, as_of: datetime) -> int:
        """Write a whole source table with lineage columns; returns its row count. It replaces all loads so far."""
        return self._land(df, spec, as_of, batch_id(as_of), True)[0]

    def land_batch(self, df: DataFrame, spec: TableSpec, as_of: datetime, batch: str | None = None):
        """Write an increment as a batch (by default ``as_of``'s), in place of earlier attempts at it; rows and their mark."""
        return self._land(df, spec, as_of, batch or batch_id(as_of), False)

    def drop_replaced(self, table: str) -> int:
        """Remove the files of loads that a later full load, or a later attempt at the same batch, has replaced; how many went.

        Frames that read them can't be read afterwards.
        """
        kept = {(e["batch"], e["attempt"], e["whole"]) for e in self.loads(table).values()}
        old = [a for a in ((e["batch"], e["attempt"], e["whole"]) for e in self._log(table)) if a not in kept]
        gone = [p for p in (self._attempt_path(table, *a) for a in old) if path_exists(self.spark, p)]
        for path in gone:
            delete_path(self.spark, path)
        return len(gone)

    def _load_rows(self, table: str, entries: Sequence, with_batch: bool = False) -> DataFrame | None:
        """The rows of some loads of one kind, with the columns of all of them."""
        if not entries:
            return None
        fields = {f.name: f for e in entries for f in StructType.fromJson(json.loads(e["schema"])).fields}
        schema = StructType([*fields.values(), *([StructField("dl_increment", StringType())] if with_batch else [])])
        whole = entries[0]["whole"]
        paths = [self._attempt_path(table, e["batch"], e["attempt"], whole) for e in entries if e["rows"]]
        if not paths:
            return self.spark.createDataFrame([], schema)
        root = f"{self._place(table)}/{'whole' if whole else 'batches'}"
        return self.spark.read.schema(schema).option("basePath", root).parquet(*paths).select(*schema.names)

    def batch(self, table: str, as_of: datetime) -> DataFrame | None:
        """The rows that the load ``as_of`` brought, whole or increment."""
        entry = self.loads(table).get(batch_id(as_of))
        return None if entry is None else self._load_rows(table, [entry])

    def newest(self, table: str, key: str) -> DataFrame:
        """One state of each source row: a key that came again in a later batch counts as it was in the last one.

        Only the increments since the full load are grouped; the full load loses their keys by an anti join, whose right side
        Catalyst broadcasts where its measured size allows it. Rows without a key can't be told when they come again and all stay.
        """
        held = list(self.loads(table).values())
        whole = self._load_rows(table, [e for e in held if e["whole"]])
        later = self._load_rows(table, [e for e in held if not e["whole"]], with_batch=True)
        if later is None:
            return self.read("raw", table, merge_schema=False) if whole is None else whole
        last = later.where(F.col(key).isNotNull()).groupBy(key).agg(F.max("dl_increment").alias("__last"))
        rows = later.join(last, key, "left").where(F.col(key).isNull() | (F.col("dl_increment") == F.col("__last")))
        rows = rows.drop("dl_increment", "__last")
        if whole is None:
            return rows
        return whole.join(last.select(key), key, "left_anti").unionByName(rows, allowMissingColumns=True)

    def _schema_path(self, zone: str, table: str) -> str:
        return f"{self.base_path.rstrip('/')}/_schemas/{zone}/{table}"

    def _write(self, df: DataFrame, zone: str, table: str, mode: str, partition_by: Sequence[str]) -> int:
        """Write, and keep the schema where directory names would leave a column's type to be guessed."""
        n = write_parquet(df, self.path(zone, table), mode, partition_by)
        if partition_by:
            kept = self.spark.createDataFrame([(df.schema.json(),)], "schema string")
            kept.coalesce(1).write.mode("overwrite").parquet(self._schema_path(zone, table))
        return n

    def _kept_schema(self, zone: str, table: str) -> StructType | None:
        path = self._schema_path(zone, table)
        if not path_exists(self.spark, path):
            return None
        return StructType.fromJson(json.loads(self.spark.read.schema("schema string").parquet(path).first()[0]))

    def load_staging(self, df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> int:
        return self._write(df, "staging", table, "overwrite", partition_by)

    def load_processed(
        self, df: DataFrame, table: str, mode: str = "overwrite", partition_by: Sequence[str] = ()
    ) -> int:
        return self._write(df, "processed", table, mode, partition_by)

    def load_batch(self, df: DataFrame, table: str, as_of: datetime) -> int:
        """Add a batch to a processed table's history; the same batch again replaces itself."""
        return write_batch(df, self.path("processed", table), as_of)

    def read(
        self,
        zone: str,
        table: str,
        columns: Sequence[str] | None = None,
        merge_schema: bool = True,
        schema: StructType | None = None,
    ) -> DataFrame:
        """A zone table with the columns of all its files, optionally only some of them.

        A partitioned table comes back with the schema it was written with. Otherwise merging opens every file's
        footer; for a table of very many files pass its ``schema``, or ``merge_schema=False`` if all files are alike.
        A raw table is its last full load and the batches landed since.
        """
        held = list(self.loads(table).values()) if zone == "raw" else []
        if held:
            parts = [self._load_rows(table, [e for e in held if e["whole"] == whole]) for whole in (True, False)]
            rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [p for p in parts if p is not None])
            return rows.select(*columns) if columns else rows
        path, schema = self.path(zone, table), schema or self._kept_schema(zone, table)
        reader = self.spark.read.option("mergeSchema", str(merge_schema and schema is None).lower())
        rows = (reader.schema(schema) if schema else reader).parquet(path)
        return rows.select(*columns) if columns else rows
