"""Data checks.

Every check returns rows ``(table_name, check_name, value, passed)``; several checks on
one table share one aggregation over it.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType, StringType

from cargoloom.sinks.zones import LINEAGE

ZERO = "zero"
POSITIVE = "positive"
ANY = "any"


def _count_if(condition: Column) -> Column:
    return F.coalesce(F.count_if(condition), F.lit(0)).cast("long")


def _as_checks(totals: DataFrame, table: str, checks: Mapping[str, tuple[Column, str]]) -> DataFrame:
    """A one-row frame of totals as one row per check."""

    def row(name: str, value: Column, rule: str) -> Column:
        value = value.cast("long")
        passed = {ZERO: value == 0, POSITIVE: value > 0, ANY: F.lit(True)}[rule]
        return F.struct(F.lit(name).alias("check_name"), value.alias("value"), passed.alias("passed"))

    rows = F.array(*[row(name, value, rule) for name, (value, rule) in checks.items()])
    return totals.select(F.explode(rows).alias("c")).select(F.lit(table).alias("table_name"), "c.*")


def union_checks(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def key_checks(df: DataFrame, table: str, key: str) -> DataFrame:
    """Rows present, null keys, and key values that occur more than once (null counts as a value)."""
    if key not in df.columns:
        totals = df.agg(F.count(F.lit(1)).alias("n"))
        return _as_checks(totals, table, {"row_count": (F.col("n"), POSITIVE), "missing_key_column": (F.lit(1), ZERO)})
    # A busy key value is merged before the shuffle, so it makes no large group.
    per_key = df.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    totals = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("n"))), F.lit(0)).alias("null_keys"),
        F.count(F.lit(1)).alias("distinct_keys"),
        _count_if(F.col("n") > 1).alias("duplicate_keys"),
    )
    return _as_checks(
        totals,
        table,
        {
            "row_count": (F.col("row_count"), POSITIVE),
            "missing_key_column": (F.lit(0), ZERO),
            "null_keys": (F.col("null_keys"), ZERO),
            "distinct_keys": (F.col("distinct_keys"), ANY),
            "duplicate_keys": (F.col("duplicate_keys"), ZERO),
        },
    )


def null_key_checks(df: DataFrame, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls per ``*_key`` column (or per given column) and their sum, in one pass."""
    chosen = list(columns or [c for c in df.columns if c.endswith("_key")])
    totals = df.agg(F.count(F.lit(1)).alias("n"), *[_count_if(F.col(c).isNull()).alias(c) for c in chosen])
    checks = {f"null_{c}": (F.col(c), ZERO) for c in chosen}
    total = reduce(lambda a, b: a + b, [F.col(c) for c in chosen], F.lit(0).cast("long"))
    return _as_checks(totals, table, {**checks, "null_keys": (total, ZERO)})


def fact_report(df: DataFrame, table: str, keys: Sequence[str], required: Sequence[str]) -> DataFrame:
    """Total rows, rows with any null among the given keys, and required columns that are missing."""
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    totals = df.agg(F.count(F.lit(1)).alias("total_rows"), _count_if(any_null).alias("null_keys"))
    missing = len([c for c in required if c not in df.columns])
    return _as_checks(
        totals,
        table,
        {
            "total_rows": (F.col("total_rows"), ANY),
            "null_keys": (F.col("null_keys"), ZERO),
            "missing_columns": (F.lit(missing), ZERO),
        },
    )


def orders_report(fact_orders: DataFrame) -> DataFrame:
    return fact_report(
        fact_orders,
        "fact_orders",
        ["order_key", "order_date_key"],
        ["package_weight", "order_amount", "delivery_duration_minutes"],
    )


def tracking_report(fact_shipment_tracking: DataFrame) -> DataFrame:
    return fact_report(
        fact_shipment_tracking,
        "fact_shipment_tracking",
        ["tracking_key", "order_key"],
        ["status", "tracking_timestamp", "elapsed_time_minutes"],
    )


def orphan_checks(
    fact: DataFrame, table: str, references: Sequence[tuple[str, DataFrame, str]]
) -> DataFrame:
    """Fact rows per foreign key whose value has no row in the dimension; nulls are not orphans.

    ``references`` lists ``(foreign key, dimension, its key)``. The fact is counted per
    key value before any join, so the joins see distinct values, not fact rows.
    """

    def one(fk: str, dim: DataFrame, pk: str) -> DataFrame:
        used = fact.filter(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("n"))
        lost = used.join(dim.select(F.col(pk).alias(fk)), fk, "left_anti")
        totals = lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
        return _as_checks(totals, table, {f"orphans_{fk}": (F.col("n"), ZERO)})

    return union_checks([one(*reference) for reference in references])


def reconcile(table: str, source: DataFrame, extracted: DataFrame) -> DataFrame:
    """Row counts of the source and of what was extracted, in one row with their comparison."""
    tagged = source.select(F.lit(True).alias("s")).unionByName(extracted.select(F.lit(False).alias("s")))
    return tagged.agg(
        _count_if(F.col("s")).alias("source_count"), _count_if(~F.col("s")).alias("extracted_count")
    ).select(
        F.lit(table).alias("table_name"),
        "source_count",
        "extracted_count",
        (F.col("source_count") == F.col("extracted_count")).alias("passed"),
    )


def zone_checks(df: DataFrame, table: str, query: str | None = None) -> DataFrame:
    """Rows present and lineage columns complete; with ``query`` also a check of the caller's.

    ``query`` is SQL over the view ``v_<table>``; the first value it returns must exceed zero.
    """
    totals = df.agg(F.count(F.lit(1)).alias("n"))
    missing = len([c for c in LINEAGE if c not in df.columns])
    checks = {"row_count": (F.col("n"), POSITIVE), "missing_lineage_columns": (F.lit(missing), ZERO)}
    if query is not None:
        df.createOrReplaceTempView(f"v_{table}")
        first = df.sparkSession.sql(query).first()
        value = int(first[0]) if first is not None and first[0] is not None else 0
        checks["custom_query"] = (F.lit(value), POSITIVE)
    return _as_checks(totals, table, checks)


def zone_statistics(df: DataFrame, table: str) -> DataFrame:
    """Rows, files, columns, bytes and newest file time of a table read from files.

    Rows are counted per file first, so only one row per file is shuffled. The scan
    reads no data column.
    """
    files = df.groupBy(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("changed"),
    ).agg(F.count(F.lit(1)).alias("n"))
    return files.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("record_count"),
        F.count(F.lit(1)).alias("file_count"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("size_bytes"),
        F.max("changed").alias("last_modified"),
    ).select(F.lit(table).alias("table_name"), F.lit(len(df.columns)).cast("long").alias("column_count"), "*")


@dataclass(frozen=True)
class ColumnRule:
    """One declared column: its SQL type, and what else must hold."""

    name: str
    type: str
    nullable: bool = True
    primary_key: bool = False

    def length(self) -> int | None:
        kind = self.type.lower()
        return int(kind[8:-1]) if kind.startswith("varchar(") else None

    def spark_type(self) -> str:
        return "string" if self.length() is not None else self.type


# The ranges of the integral types, and the only texts that a cast to one of them takes.
INTEGRAL_BITS = {"tinyint": 7, "smallint": 15, "int": 31, "bigint": 63}
WHOLE_NUMBER = r"^[\s\p{Cntrl}]*[+\-]?0*[0-9]{1,19}[\s\p{Cntrl}]*$"


def _misfits(value: Column, held: DataType, target: str) -> Column:
    """Whether a value cannot be cast. ``try_cast`` decides, but it costs an exception per misfit,
    so values that cannot fit by their range or form are told apart before it. Nearly all ids of a source may be misfits."""
    unfit = value.try_cast(target).isNull()
    decimal = re.fullmatch(r"decimal\((\d+),\s*(\d+)\)", target)
    if isinstance(held, NumericType) and (decimal or target in INTEGRAL_BITS):
        limit = 10.0 ** (int(decimal[1]) - int(decimal[2])) if decimal else 2.0 ** INTEGRAL_BITS[target]
        unfit = (F.abs(value.cast("double")) > limit) | unfit
    elif isinstance(held, StringType) and target in INTEGRAL_BITS:
        bits = INTEGRAL_BITS[target]
        inside = value.try_cast("bigint").between(-(2**bits), 2**bits - 1)
        unfit = F.when(~value.rlike(WHOLE_NUMBER), True).otherwise(~F.coalesce(inside, F.lit(False)))
    return value.isNotNull() & unfit


def schema_conformance(df: DataFrame, table: str, rules: Sequence[ColumnRule]) -> DataFrame:
    """Violations of a declared schema, one row per column and rule, in one pass and one per primary key.

    Checked are missing columns, nulls where none may be, texts over their length, and
    values that do not fit the type (a decimal too large, a text that is no number).
    """
    present = [r for r in rules if r.name in df.columns]
    missing = len(rules) - len(present)
    measures: dict[str, Column] = {}
    for r in present:
        value = F.col(r.name)
        if not r.nullable or r.primary_key:
            measures[f"{r.name}_null"] = _count_if(value.isNull())
        if r.length() is not None:
            measures[f"{r.name}_too_long"] = _count_if(F.length(value.cast("string")) > r.length())
        else:
            misfit = _misfits(value, df.schema[r.name].dataType, r.spark_type().lower())
            measures[f"{r.name}_not_{r.type.split('(')[0].lower()}"] = _count_if(misfit)
    totals = df.agg(F.count(F.lit(1)).alias("__rows"), *[m.alias(n) for n, m in measures.items()])
    checks = {n: (F.col(n), ZERO) for n in measures}
    parts = [_as_checks(totals, table, {"missing_columns": (F.lit(missing), ZERO), **checks})]
    for r in present:
        if r.primary_key:
            per_key = df.groupBy(r.name).agg(F.count(F.lit(1)).alias("n"))
            repeated = per_key.agg(_count_if(F.col("n") > 1).alias("n"))
            parts.append(_as_checks(repeated, table, {f"{r.name}_repeated": (F.col("n"), ZERO)}))
    return union_checks(parts)


def cast_to_declared(df: DataFrame, rules: Sequence[ColumnRule], keep_text_ids: bool = False) -> DataFrame:
    """The declared columns that the frame has, in their order and types, for the warehouse edge; a misfit value is an error.

    With ``keep_text_ids`` a text column that is declared a whole number stays text: ids of sources that number in text,
    which ``schema_conformance`` then reports.
    """

    def shaped(rule: ColumnRule) -> Column:
        text = isinstance(df.schema[rule.name].dataType, StringType)
        kept = keep_text_ids and text and rule.spark_type() in INTEGRAL_BITS
        return F.col(rule.name) if kept else F.col(rule.name).cast(rule.spark_type()).alias(rule.name)

    return df.select(*[shaped(r) for r in rules if r.name in df.columns])
