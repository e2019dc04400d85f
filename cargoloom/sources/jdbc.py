"""Relational sources over Spark's JDBC reader."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargoloom.sources.even_ranges import cells_relation, even_ranges, range_predicates
from cargoloom.sources.specs import ROWS_PER_PARTITION, TableSpec

# Below this many rows, read with at least that many partitions; else with at least the last number.
PARTITION_LADDER = ((100_000, 4), (1_000_000, 8))
PARTITIONS_ABOVE = 16
FETCH_SIZE = 100_000
BATCH_SIZE = 10_000


def partitions_for(rows: int, rows_per_partition: int = ROWS_PER_PARTITION) -> int:
    """How many ranges to read or write ``rows`` rows in: one per ``rows_per_partition``, never below the ladder's number.

    There is no upper limit. How many run at once is for the cluster's cores and the database's connections to say.
    """
    step = next((n for limit, n in PARTITION_LADDER if rows < limit), PARTITIONS_ABOVE)
    return max(step, -(-rows // rows_per_partition))


@dataclass(frozen=True)
class ReadBounds:
    """Smallest and largest key, row count, and the number of ranges to read them in."""

    min_id: int | None
    max_id: int | None
    total_count: int
    partitions: int


def read_bounds(bounds_row: DataFrame, rows_per_partition: int = ROWS_PER_PARTITION) -> ReadBounds:
    """The bounds of a one-row frame ``(min_id, max_id, total_count)``, from SQL or from ``bounds``."""
    low, high, rows = bounds_row.first()
    return ReadBounds(low, high, rows, partitions_for(rows, rows_per_partition))


def bounds(df: DataFrame, column: str) -> DataFrame:
    """Smallest and largest key and the row count, as one row."""
    return df.agg(
        F.min(column).cast("long").alias("min_id"),
        F.max(column).cast("long").alias("max_id"),
        F.count(F.lit(1)).alias("total_count"),
    )


@dataclass(frozen=True)
class JdbcSource:
    """One database. Credentials come from the caller's ``options``, never from here."""

    spark: SparkSession
    url: str
    options: dict[str, str] = field(default_factory=dict)
    fetch_size: int = FETCH_SIZE

    def _reader(self):
        settings = {"fetchsize": str(self.fetch_size), "preferTimestampNTZ": "true", **self.options}
        return self.spark.read.format("jdbc").option("url", self.url).options(**settings)

    def scan(self, relation: str) -> DataFrame:
        """One table or parenthesised subquery. Filters and columns chosen later are pushed down by Catalyst."""
        return self._reader().option("dbtable", relation).load()

    def extract(
        self,
        table: str,
        partition_column: str | None = None,
        where: str | None = None,
        rows_per_partition: int = ROWS_PER_PARTITION,
        even: bool = False,
    ) -> DataFrame:
        """A whole or filtered table, read in parallel ranges if a partition column is given.

        The filter sits inside the subquery that is split, so it holds for every range.
        An empty table gives an empty frame with the table's schema. Ranges are of equal width, or with ``even``
        of about equal row counts, which the database counts first: for keys with gaps.
        """
        relation = filtered_relation(table, where)
        if partition_column is None:
            return self.scan(relation)
        found = read_bounds(self.scan(bounds_relation(table, partition_column, where)), rows_per_partition)
        if found.total_count == 0 or found.max_id is None:
            return self.scan(relation)
        if even:
            starts = self._even_starts(table, partition_column, where, found)
            settings = {"fetchsize": str(self.fetch_size), "preferTimestampNTZ": "true", **self.options}
            predicates = range_predicates(partition_column, starts)
            return self.spark.read.jdbc(self.url, relation, predicates=predicates, properties=settings)
        return (
            self._reader()
            .option("dbtable", relation)
            .option("partitionColumn", partition_column)
            .option("lowerBound", str(found.min_id))
            .option("upperBound", str(found.max_id + 1))
            .option("numPartitions", str(found.partitions))
            .load()
        )

    def _even_starts(self, table: str, column: str, where: str | None, found: ReadBounds) -> list[int]:
        def count(width, coarser, starts):
            return [tuple(r) for r in self.scan(cells_relation(table, column, where, found.min_id, width, coarser, starts)).collect()]

        most = -(-found.total_count // found.partitions)
        return [start for start, _ in even_ranges(count, found.min_id, found.max_id, most)]

    def extract_incremental(
        self, table: str, timestamp_column: str, after: datetime | str, partition_column: str | None = None
    ) -> DataFrame:
        return self.extract(table, partition_column, incremental_clause(timestamp_column, after))

    def extract_spec(self, spec: TableSpec) -> DataFrame:
        return self.extract(
            spec.source_table or spec.name,
            spec.partition_column,
            rows_per_partition=spec.rows_per_partition,
            even=spec.even_ranges,
        )

    def count(self, table: str) -> DataFrame:
        return self.scan(f"(SELECT COUNT(*) AS n FROM {table}) counted")

    def stage(self, df: DataFrame, table: str) -> None:
        """Overwrite the table ``temp_<table>``, from where the database can merge it."""
        self._writer(df).mode("overwrite").option("dbtable", f"temp_{table}").save()

    def append(
        self, df: DataFrame, table: str, rows_per_partition: int = ROWS_PER_PARTITION, rows: int | None = None
    ) -> None:
        """Append in even parts of at most ``rows_per_partition`` rows; a frequent key does not make one of them slow.

        ``rows`` is their number where it is known, as from the write of the frame; else they are counted first.

        A retried task may insert its rows again, so let the table's primary key guard
        it or append to a staging table.
        """
        parts = partitions_for(df.count() if rows is None else rows, rows_per_partition)
        self._writer(df.repartition(parts)).mode("append").option("dbtable", table).save()

    def _writer(self, df: DataFrame):
        settings = {"batchsize": str(BATCH_SIZE), **self.options}
        return df.write.format("jdbc").option("url", self.url).options(**settings)


def filtered_relation(table: str, where: str | None) -> str:
    return f"(SELECT * FROM {table} WHERE {where}) filtered" if where else table


def bounds_relation(table: str, column: str, where: str | None) -> str:
    condition = f" WHERE {where}" if where else ""
    return (
        f"(SELECT MIN({column}) AS min_id, MAX({column}) AS max_id, COUNT(*) AS total_count"
        f" FROM {table}{condition}) bounds"
    )


def incremental_clause(timestamp_column: str, after: datetime | str) -> str:
    text = after.isoformat(sep=" ") if isinstance(after, datetime) else after
    return f"{timestamp_column} > '{text}'"
