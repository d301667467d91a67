"""Session defaults, the shared work folder, and the number of tasks for row work."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def build_session(
    app: str = "broadsheet",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with UTC time, AQE (coalescing and skew joins) and a disk-backed state store.

    On a cluster leave ``shuffle_partitions`` unset and let AQE coalesce from the
    submitted value; tests pass a small number.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session may fall back to a folder of its own; elsewhere a missing
    setting is an error, because executors would not see the driver's disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="broadsheet-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Streams started here keep state by column family (``transformWithState``).

    Spark's default store, which holds state in memory, cannot; it is set aside for RocksDB. A
    stream takes its settings when it starts, so the session has its own again afterwards.
    """
    name = "spark.sql.streaming.stateStore.providerClass"
    given = spark.conf.get(name)
    if not given.endswith(".HDFSBackedStateStoreProvider"):
        yield
        return
    spark.conf.set(name, ROCKSDB_PROVIDER)
    try:
        yield
    finally:
        spark.conf.set(name, given)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it knows it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame, *keys: str, tasks: int | None = None) -> DataFrame:
    """Deal rows out to ``tasks`` tasks before heavy per-row work, where the caller asks.

    Without ``tasks`` the setting spark.broadsheet.tasks decides; without either the scan
    keeps its own splits, which is right for tables of many files or row groups.
    """
    asked = tasks or df.sparkSession.conf.get("spark.broadsheet.tasks", None)
    return df.repartition(int(asked), *keys) if asked else df
