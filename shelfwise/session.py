"""Session settings and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Look-ups hand lists of keys to the scan.
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
    # Keyed stream state on local disk plus shared checkpoints, not on the heap.
    STATE_STORE: ROCKSDB,
}

_local_dirs: dict[str, str] = {}
_runs: list[str] = []


def build_session(app: str = "shelfwise", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs expect."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Epoch <-> calendar conversions follow the session zone; pin it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, whoever built the session; Spark's default store has no list states.

    A stream takes the settings it was started with, so the session gets its own back at once."""
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(STATE_STORE) if before is None else spark.conf.set(STATE_STORE, before)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local master may fall back to a temporary folder, because there the
    driver and the executors are one machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="shelfwise-")
    return _local_dirs[app]


def run_dir(spark: SparkSession, purpose: str) -> str:
    """A new, never reused path below the shared folder; ``clean_runs`` removes it."""
    _runs.append(f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}")
    return _runs[-1]


def clean_runs(spark: SparkSession) -> None:
    """Removes what ``run_dir`` has handed out, once no result that reads it is needed any more."""
    while _runs:
        _delete(spark, _runs.pop())


def drop_run(spark: SparkSession, path: str) -> None:
    """Removes one folder of ``run_dir``; any other path is left alone."""
    name = path.rpartition("/")[2]
    for run in [r for r in _runs if r.rpartition("/")[2] == name]:
        _runs.remove(run)
        _delete(spark, run)


def _delete(spark: SparkSession, run: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(run)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write inside go when it ends, not when the driver happens to collect its garbage."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(DROP_SHUFFLES) if before is None else spark.conf.set(DROP_SHUFFLES, before)


def enable_checkpoints(spark: SparkSession) -> None:
    """Let iterative fits cut their lineage on shared storage."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(run_dir(spark, "checkpoints"))
