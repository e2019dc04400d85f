"""Session settings and the shared work folder."""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

_scope: ContextVar[str | None] = ContextVar("cargoloom_work_scope", default=None)

_COALESCE = "spark.sql.adaptive.coalescePartitions.enabled"
_uncoalesced: dict[str, list[str]] = defaultdict(list)  # per session what the setting was, once for each write under way
_uncoalesced_lock = Lock()

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.compression.codec": "snappy",
    # Tasks that list directories; a task per directory costs more than the listing.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256",
}


def build_session(app_name: str = "cargoloom", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the defaults above; ``settings`` (dots as ``__``) win over them.

    ``spark.sql.shuffle.partitions`` is left to the cluster: give it a number near
    (largest shuffle in bytes / 128 MB), AQE then merges what turns out small.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """The shared folder for data that must outlive an executor.

    It is whatever the cluster names in ``spark.checkpoint.dir``, or the context's checkpoint folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return named.rstrip("/")


def new_work_path(spark: SparkSession, label: str) -> str:
    """A path under the work folder that nothing has used before."""
    return f"{_scope.get() or work_dir(spark) + '/cargoloom'}/{label}-{uuid.uuid4().hex}"


@contextmanager
def work_scope(spark: SparkSession) -> Iterator[None]:
    """Work paths made inside are removed at the end.

    Use it around building *and saving* tables: frames with new surrogate keys read
    their work path until they are saved. Outside a scope work paths stay until the
    owner of the work folder clears it, like checkpoints.
    """
    root = new_work_path(spark, "scope")
    token = _scope.set(root)
    try:
        yield
    finally:
        _scope.reset(token)
        delete_path(spark, root)


def stored_frame(rows: DataFrame, label: str) -> DataFrame:
    """The rows in the work folder, where they are read more than once."""
    path = new_work_path(rows.sparkSession, label)
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


@contextmanager
def all_shuffle_tasks(spark: SparkSession) -> Iterator[None]:
    """Shuffles inside keep ``spark.sql.shuffle.partitions`` tasks, however few bytes they move.

    For writes into many directories: what costs there is the files, and a directory has one task (more if it is large) however
    many tasks there are. Writes may overlap; the last one to end puts the setting back.
    """
    session = str(id(spark._jsparkSession))
    with _uncoalesced_lock:
        _uncoalesced[session].append(spark.conf.get(_COALESCE))
        spark.conf.set(_COALESCE, "false")
    try:
        yield
    finally:
        with _uncoalesced_lock:
            before = _uncoalesced[session]
            if len(before) == 1:
                spark.conf.set(_COALESCE, before[0])
                del _uncoalesced[session]
            else:
                before.pop()


#: What a long run sets. Files are compressed, and what is read from them takes many times their size in the driver: Catalyst estimates
#: by file sizes which side of a join it broadcasts, adaptive execution by the rows it has measured. The files of a shuffle go when its
#: job ends, not when the driver happens to collect its garbage. Joins whose smaller side takes so few bytes in
#: every shuffle task hash it and sort neither side.
RUN_SETTINGS = {
    "spark.sql.sources.fileCompressionFactor": "16.0",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
}
_before_runs: dict[str, list[dict[str, str]]] = defaultdict(list)  # per session, like _uncoalesced
_before_runs_lock = Lock()


@contextmanager
def run_settings(spark: SparkSession) -> Iterator[None]:
    """``RUN_SETTINGS`` inside, whatever they were before afterwards. Runs may overlap; the last one to end puts them back."""
    session = str(id(spark._jsparkSession))
    with _before_runs_lock:
        _before_runs[session].append({k: spark.conf.get(k) for k in RUN_SETTINGS})
        for k, v in RUN_SETTINGS.items():
            spark.conf.set(k, v)
    try:
        yield
    finally:
        with _before_runs_lock:
            before = _before_runs[session]
            if len(before) == 1:
                for k, v in before[0].items():
                    spark.conf.set(k, v)
                del _before_runs[session]
            else:
                before.pop()


def _place(spark: SparkSession, path: str):
    """A path and the file system it belongs to."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    place, system = _place(spark, path)
    return system.exists(place)


def delete_path(spark: SparkSession, path: str) -> None:
    place, system = _place(spark, path)
    system.delete(place, True)


def directories(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Names of the directories ``depth`` steps below a path, such as the partitions of a table; nothing else in it is listed."""
    found = [""]
    for _ in range(depth):
        place_of = [_place(spark, f"{path}/{d}" if d else path) for d in found]
        below = [(d, status) for d, (place, system) in zip(found, place_of, strict=True) for status in system.listStatus(place)]
        found = [f"{d}/{s.getPath().getName()}".lstrip("/") for d, s in below if s.isDirectory()]
    return sorted(d for d in found if not d.rsplit("/", 1)[-1].startswith(("_", ".")))
