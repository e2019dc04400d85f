"""Tables in versions that are never half there, and that share the files they have in common.

A version is one row of the table's small log. Its manifest lists the directories the version is made of, each with its row count.
New rows go to directories of the version's own; directories that did not change are listed again and no row of them is copied.
A run that dies before its log row leaves the old version current. Publishing a version again is a newer attempt at
it, built from ``before`` that version. The log also keeps the schema, so partition columns come back with the types they were written
with, and the highest surrogate key ever given, so that new keys need no scan of the old ones.

**Merged tables** are dealt into hash buckets of their owner (such as the order a fact belongs to): :meth:`VersionedTables.merge` writes
the buckets in which known owners changed, and adds directories to buckets that got new owners. Where a bucket has come to
more than ``MOST_PARTS`` directories, the next merge that touches it writes it as one. **Partitioned tables** lose whole
partitions by :meth:`VersionedTables.keep_parts`, which writes no data at all.

The log serves one writer at a time. Directories that no version of interest lists are removed by :meth:`VersionedTables.vacuum`.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce
from operator import and_
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from cargoloom.functions.moments import batch_id
from cargoloom.operators.keys import KnownKeys
from cargoloom.session import delete_path, directories, new_work_path, path_exists
from cargoloom.sinks.zones import figures, write_rows

_LOG_SCHEMA = (
    "version string, attempt int, schema string, layout string, parts array<struct<path: string, rows: long>>, highest long"
)
_VERSION, _BUCKET = "dl_version", "dl_bucket"
BUCKETS, MOST_PARTS = 32, 8


@dataclass(frozen=True)
class VersionedTables:
    spark: SparkSession
    base_path: str

    def _log_path(self, table: str) -> str:
        return f"{self.base_path.rstrip('/')}/{table}/log"

    def _root(self, table: str) -> str:
        return f"{self.base_path.rstrip('/')}/{table}/parts"

    def _log(self, table: str) -> DataFrame | None:
        if not path_exists(self.spark, self._log_path(table)):
            return None
        return self.spark.read.schema(_LOG_SCHEMA).parquet(self._log_path(table))

    def _newest(self, table: str, before: str | None = None):
        """The log row of the newest attempt at the newest version, or at the newest one before a version."""
        log = self._log(table)
        if log is None:
            return None
        log = log if before is None else log.filter(F.col("version") < before)
        order = F.struct("version", "attempt")
        return log.agg(F.max_by(F.struct(*log.columns), order).alias("entry")).first()["entry"]

    def _read(self, table: str, entry, parts=None, with_bucket: bool = False) -> DataFrame | None:
        if entry is None:
            return None
        schema, layout = StructType.fromJson(json.loads(entry["schema"])), json.loads(entry["layout"])
        names = [*schema.names, *([_BUCKET] if with_bucket else [])]
        more = StructType([*schema.fields, StructField(_VERSION, StringType())])
        if layout["owner"]:
            more = more.add(_BUCKET, IntegerType())
        parts = entry["parts"] if parts is None else parts
        if not parts:
            return self.spark.createDataFrame([], more).select(*names)
        root = self._root(table)
        paths = [f"{root}/{p['path']}" for p in parts]
        return self.spark.read.schema(more).option("basePath", root).parquet(*paths).select(*names)

    def current_version(self, table: str) -> str | None:
        entry = self._newest(table)
        return None if entry is None else entry["version"]

    def current(self, table: str) -> DataFrame | None:
        return self._read(table, self._newest(table))

    def before(self, table: str, as_of: datetime) -> DataFrame | None:
        """The table as it was before version ``as_of``, whether that version is there yet or not."""
        return self._read(table, self._newest(table, batch_id(as_of)))

    def highest_key(self, table: str, as_of: datetime) -> int:
        """The highest key given before version ``as_of``, from the log alone."""
        entry = self._newest(table, batch_id(as_of))
        return 0 if entry is None else entry["highest"] or 0

    def known_keys(self, table: str, as_of: datetime) -> KnownKeys | None:
        """The rows before version ``as_of`` with the highest key given by then."""
        rows = self.before(table, as_of)
        return None if rows is None else KnownKeys(rows, self.highest_key(table, as_of))

    def rows(self, table: str) -> int:
        """Rows of the current version, from its manifest."""
        return sum(p["rows"] for p in self._newest(table)["parts"])

    def directories_of(self, table: str, as_of: datetime | None = None) -> list[str]:
        """The manifest of the current version, or of the newest one before ``as_of``."""
        return [p["path"] for p in self._newest(table, batch_id(as_of) if as_of else None)["parts"]]

    def _attempt(self, table: str, as_of: datetime) -> tuple[str, int]:
        """The next attempt's name. A version older than the current one could not become current and is refused."""
        version, newest = batch_id(as_of), self._newest(table)
        if newest is not None and version < newest["version"]:
            raise ValueError(f"{table} already has version {newest['version']}, newer than {version}")
        return version, newest["attempt"] + 1 if newest is not None and version == newest["version"] else 1

    def _write(
        self, df: DataFrame, table: str, name: tuple[str, int], partition_by: Sequence[str], key: str | None, gather: bool = True
    ):
        """Write rows to a directory of the attempt's own: its parts with their rows, and the highest key in them."""
        place, counted = f"{_VERSION}={name[0]}_{name[1]}", Observation()
        path = f"{self._root(table)}/{place}"
        highest = F.max(F.col(key).cast("long")) if key else F.lit(None).cast("long")
        write_rows(df.observe(counted, F.count(F.lit(1)).alias("n"), highest.alias("highest")), path, "overwrite", partition_by, gather)
        seen = figures(counted)
        if not partition_by:
            return [(place, seen["n"])], seen.get("highest")
        # How many rows each directory has: its values alone are read, as texts, and row counts of footers; one row per directory.
        texts = StructType([StructField(c, StringType()) for c in partition_by])
        found = self.spark.read.schema(texts).parquet(path).groupBy(*partition_by).count().collect() if seen["n"] else []
        counts = {tuple(r)[:-1]: r["count"] for r in found}
        inside = directories(self.spark, path, len(partition_by))
        return [(f"{place}/{d}", counts[tuple(_values(d).values())]) for d in inside], seen.get("highest")

    def _enter(self, table, name, schema: StructType, layout: dict, parts, highest: int | None) -> int:
        entry = (*name, schema.json(), json.dumps(layout), [(p[0], p[1]) for p in parts], highest)
        self.spark.createDataFrame([entry], _LOG_SCHEMA).coalesce(1).write.mode("append").parquet(self._log_path(table))
        return sum(p[1] for p in parts)

    def publish(
        self, df: DataFrame, table: str, as_of: datetime, partition_by: Sequence[str] = (), key: str | None = None
    ) -> int:
        """Write ``df`` as the table's version ``as_of`` and make it current; ``df`` may read older versions and attempts.

        With ``key`` the highest value of that column ever published is kept in the log. Returns the version's rows.
        """
        name, earlier = self._attempt(table, as_of), self.highest_key(table, as_of)
        parts, highest = self._write(df, table, name, partition_by, key)
        highest = max(highest or 0, earlier) if key else None
        return self._enter(table, name, df.schema, {"partition_by": list(partition_by), "owner": None}, parts, highest)

    def keep_parts(self, table: str, as_of: datetime, keep: Callable[[dict[str, str | None]], bool]) -> int:
        """Publish those partitions of the version before ``as_of`` whose values ``keep`` wants. Writes one log row and no data."""
        entry = self._newest(table, batch_id(as_of))
        if entry is None:
            raise ValueError(f"no version of {table} to clean up")

        kept = [(p["path"], p["rows"]) for p in entry["parts"] if keep(_values(p["path"].partition("/")[2]))]
        schema = StructType.fromJson(json.loads(entry["schema"]))
        return self._enter(table, self._attempt(table, as_of), schema, json.loads(entry["layout"]), kept, entry["highest"])

    def partitioned_by(self, table: str, as_of: datetime) -> list[str]:
        entry = self._newest(table, batch_id(as_of))
        return [] if entry is None else json.loads(entry["layout"])["partition_by"]

    def merge(
        self,
        df: DataFrame,
        table: str,
        as_of: datetime,
        owner: str,
        key: str | None = None,
        ignore: Sequence[str] = (),
        buckets: int | None = None,
    ) -> int:
        """Publish the version before ``as_of`` with all rows of each owner in ``df`` replaced by those of ``df``; returns its rows.

        Null is an owner like any other. An owner whose rows are as they were, but for the columns ``ignore``, is left alone.
        Rows of new owners are added to their buckets; only buckets with changed owners, or with very many directories, are
        written anew. The number of buckets (``BUCKETS``, if none is given) is the one the table began with.
        """
        name, entry = self._attempt(table, as_of), self._newest(table, batch_id(as_of))
        bucketed, layout = _bucketed(df, owner, entry, buckets)
        if entry is None:
            return self._begin(bucketed, table, name, layout, key)

        earlier = [(p["path"], p["rows"]) for p in entry["parts"]]
        schema = StructType.fromJson(json.loads(entry["schema"]))
        columns = [c for c in df.columns if c in schema.names and c not in ignore]
        bounds = df.agg(F.min(owner), F.max(owner), F.count_if(F.col(owner).isNull())).first()
        within = _between(owner, *bounds)
        compared = _compared(bucketed, self._read(table, entry).where(within), owner, columns)
        path, seen = new_work_path(self.spark, "owners-compared"), Observation()
        counted = [F.count_if(F.expr(c)).alias(n) for n, c in (("changed", "changed"), ("same", "came AND NOT changed"), ("gone", "NOT came"))]
        compared.observe(seen, *counted).write.parquet(path)
        compared, of = self.spark.read.schema(compared.schema).parquet(path), {"changed": 0, "same": 0, "gone": 0, **figures(seen)}
        # One row per bucket.
        by_bucket = compared.where("changed").groupBy(_BUCKET).agg(F.max("known").alias("known"))
        touched = {r[_BUCKET]: r["known"] for r in by_bucket.collect()}
        if not touched:
            return self._enter(table, name, schema, layout, earlier, entry["highest"])
        anew = _anew(earlier, touched)

        def among(rows: DataFrame, wanted: str, how: str) -> DataFrame:
            owners = compared.where(wanted).select(F.col(owner).alias("__owner"))
            return rows.join(owners, F.col(owner).eqNullSafe(F.col("__owner")), how)

        # Rows are told by the owners that changed or by all others, whichever are fewer; where there are no others, by none.
        rows = bucketed
        if of["same"]:
            rows = among(rows, "came AND NOT changed", "left_anti") if of["same"] < of["changed"] else among(rows, "changed", "left_semi")
        others = of["same"] + of["gone"]
        if anew:
            old = self._read(table, entry, [p for p in entry["parts"] if _bucket_of(p["path"]) in anew], with_bucket=True)
            if others < of["changed"]:
                rows = rows.unionByName(old.where(~within), allowMissingColumns=True)
                rest = among(old.where(within), "NOT changed", "left_semi") if others else None
            else:
                rest = among(old, "changed", "left_anti")
            rows = rows if rest is None else rows.unionByName(rest, allowMissingColumns=True)
        # Where nearly all is written as it comes, each task deals its own rows into the buckets, like those of a first version.
        parts, highest = self._write(rows, table, name, [_BUCKET], key, gather=bool(others) or 2 * len(anew) < layout["buckets"])
        return self._replace(table, name, rows, layout, entry, anew, parts, highest, key)

    def add(self, df: DataFrame, table: str, as_of: datetime, owner: str, key: str | None = None, buckets: int | None = None) -> int:
        """Publish the version before ``as_of`` with the rows of ``df`` beside its own, whoever they belong to; returns its rows.

        Rows that are there are read only in buckets with very many directories.
        """
        name, entry = self._attempt(table, as_of), self._newest(table, batch_id(as_of))
        bucketed, layout = _bucketed(df, owner, entry, buckets)
        if entry is None:
            return self._begin(bucketed, table, name, layout, key)
        earlier = [(p["path"], p["rows"]) for p in entry["parts"]]
        touched = {r[_BUCKET]: False for r in bucketed.select(_BUCKET).distinct().collect()}
        if not touched:
            return self._enter(table, name, StructType.fromJson(json.loads(entry["schema"])), layout, earlier, entry["highest"])
        anew, rows = _anew(earlier, touched), bucketed
        if anew:
            old = [p for p in entry["parts"] if _bucket_of(p["path"]) in anew]
            rows = rows.unionByName(self._read(table, entry, old, with_bucket=True), allowMissingColumns=True)
        parts, highest = self._write(rows, table, name, [_BUCKET], key)
        return self._replace(table, name, rows, layout, entry, anew, parts, highest, key)

    def _begin(self, bucketed: DataFrame, table: str, name: tuple[str, int], layout: dict, key: str | None) -> int:
        """The first version is all rows there are: each task deals its own into the buckets, none are moved."""
        parts, highest = self._write(bucketed, table, name, [_BUCKET], key, gather=False)
        return self._enter(table, name, bucketed.drop(_BUCKET).schema, layout, parts, highest)

    def _replace(self, table, name, rows: DataFrame, layout: dict, entry, anew: set[int], parts, highest: int | None, key) -> int:
        """Publish an entry's directories with the new ones, in place of those of the buckets written anew."""
        kept = [(p["path"], p["rows"]) for p in entry["parts"] if _bucket_of(p["path"]) not in anew]
        highest = max(highest or 0, entry["highest"] or 0) if key else None
        return self._enter(table, name, rows.drop(_BUCKET).schema, layout, kept + parts, highest)

    def vacuum(self, table: str, keep_versions: int | None = 2) -> int:
        """Remove the directories that none of the newest versions lists, and log rows no more needed; how many directories went.

        Frames of older versions can't be read afterwards. With None all versions stay, and only what earlier attempts at
        them have written goes.
        """
        log = self._log(table)
        if log is None:
            return 0
        newest = log.groupBy("version").agg(F.max_by(F.struct(*log.columns), "attempt").alias("e")).orderBy(F.desc("version"))
        entries = [r["e"] for r in (newest if keep_versions is None else newest.limit(keep_versions)).collect()]
        used = {p["path"] for e in entries for p in e["parts"]}
        root, gone = self._root(table), 0
        for version in directories(self.spark, root, 1):
            inside = [p for p in used if p == version or p.startswith(version + "/")]
            if not inside:
                gone += 1
                delete_path(self.spark, f"{root}/{version}")
            elif version not in used:
                depth = inside[0].count("/")
                for d in directories(self.spark, f"{root}/{version}", depth):
                    if f"{version}/{d}" not in used:
                        gone += 1
                        delete_path(self.spark, f"{root}/{version}/{d}")
        return gone


def _values(path: str) -> dict[str, str | None]:
    """The partition values that the steps of a path name."""
    pairs = [unquote(step).split("=", 1) for step in path.split("/") if step]
    return {c: None if v == "__HIVE_DEFAULT_PARTITION__" else v for c, v in pairs}


def _bucket_of(path: str) -> int:
    return int(path.rsplit("=", 1)[1])


def _bucketed(df: DataFrame, owner: str, entry, buckets: int | None) -> tuple[DataFrame, dict]:
    """Rows with their buckets, and the layout: its number of buckets is the one the table began with."""
    n = (buckets or BUCKETS) if entry is None else json.loads(entry["layout"])["buckets"]
    layout = {"partition_by": [_BUCKET], "owner": owner, "buckets": n}
    return df.withColumn(_BUCKET, F.pmod(F.xxhash64(owner), F.lit(n)).cast("int")), layout


def _anew(earlier: Sequence[tuple[str, int]], touched: dict[int, bool]) -> set[int]:
    """Of the touched buckets those to write anew: they hold known owners that changed, or very many directories."""
    held: dict[int, int] = {}
    for place, _ in earlier:
        held[_bucket_of(place)] = held.get(_bucket_of(place), 0) + 1
    return {b for b, has_known in touched.items() if has_known or held.get(b, 0) >= MOST_PARTS}


def _between(owner: str, low, high, nulls: int) -> Column:
    """Where an owner of the frame can be, true or false: parquet skips row groups outside."""
    inside = F.lit(False) if low is None else F.col(owner).isNotNull() & F.col(owner).between(F.lit(low), F.lit(high))
    return inside | F.col(owner).isNull() if nulls else inside


def _compared(new: DataFrame, old: DataFrame, owner: str, columns: Sequence[str]) -> DataFrame:
    """Each owner of either side with its bucket (of the new side), whether it ``came``, was ``known``, and ``changed`` as it came.

    Rows are compared whatever their order, by their number and the sums of the four halves of two 64-bit hashes of each: those of
    the new side less those of the old one. Both sides meet in one aggregate.
    """
    halves = [f"__half{i}" for i in range(4)]

    def side(df: DataFrame, bucket: Column, sign: int) -> DataFrame:
        hashes = [F.xxhash64(F.lit(seed), *columns) for seed in (1, 2)]
        parts = [part for h in hashes for part in (h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32))]
        signed = [(F.lit(sign) * p).alias(n) for p, n in zip(parts, halves, strict=True)]
        flag = F.lit(1).cast("long")
        return df.select(owner, bucket.alias(_BUCKET), flag.alias("__new" if sign > 0 else "__old"), *signed)

    both = side(new, F.col(_BUCKET), 1).unionByName(side(old, F.lit(None).cast("int"), -1), allowMissingColumns=True)
    sums = [F.max(_BUCKET).alias(_BUCKET), F.count("__new").alias("__new"), F.count("__old").alias("__old")]
    # A sum beyond 64 bits is null and counts as a change.
    met = both.groupBy(owner).agg(*sums, *[F.try_sum(h).alias(h) for h in halves])
    same = reduce(and_, [F.coalesce(F.col(h) == 0, F.lit(False)) for h in halves], F.col("__new") == F.col("__old"))
    came, known = F.col("__new") > 0, F.col("__old") > 0
    return met.select(owner, _BUCKET, came.alias("came"), known.alias("known"), (came & ~same).alias("changed"))


def retained(df: DataFrame, as_of: datetime, days: int, column: str = "dl_process_date") -> DataFrame:
    """Rows of the last ``days`` days. On a partition column this prunes whole directories."""
    return df.filter(F.col(column) >= F.date_sub(F.lit(as_of.date().isoformat()).cast("date"), days))


def apply_retention(
    tables: VersionedTables,
    table: str,
    as_of: datetime,
    days: int,
    partition_by: Sequence[str] = (),
    column: str = "dl_process_date",
) -> int:
    """Publish the retained rows as the next version; returns how many there are.

    A table partitioned by ``column`` loses directories from its manifest and no row is copied; any other is written anew.
    """
    if column in tables.partitioned_by(table, as_of):
        first = (as_of.date() - timedelta(days=days)).isoformat()
        return tables.keep_parts(table, as_of, lambda values: values[column] is not None and values[column] >= first)
    rows = tables.before(table, as_of)
    if rows is None:
        raise ValueError(f"no version of {table} to clean up")
    return tables.publish(retained(rows, as_of, days, column), table, as_of, partition_by)
