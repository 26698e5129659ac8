"""Session settings, the shared scratch folder and lineage cuts."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

#: Codec of staged and stored tables.
CODEC = "zstd"

_local_base: str | None = None
_scratch: list[str] = []


def build_session(app: str = "tillwork", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the settings the library is tuned for; `extra` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_base(spark: SparkSession) -> str:
    """Folder reachable from every executor: the cluster's `spark.checkpoint.dir`.

    Only a local master may fall back to a temporary folder of this machine.
    """
    global _local_base
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    if _local_base is None or not os.path.isdir(_local_base):
        _local_base = tempfile.mkdtemp(prefix="tillwork-")
        atexit.register(shutil.rmtree, _local_base, ignore_errors=True)
    return _local_base


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nobody has used before; `clear_scratch` removes it."""
    path = f"{shared_base(spark)}/{label}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables this process has made, and say how many.

    For the end of a job: frames that read a staged table cannot be used any more.
    """
    gone = 0
    while _scratch:
        gone += _delete(spark, _scratch.pop())
    return gone


def _delete(spark: SparkSession, name: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return bool(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True))


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write a large frame as a parquet table in the shared folder and read it back.

    For frames that several passes read: later scans are column-pruned and split by file.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", CODEC).parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def staged(df: DataFrame, label: str = "stage") -> Iterator[DataFrame]:
    """`stage` for a frame that nothing reads afterwards: its files are removed at the end of the block."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", CODEC).parquet(path)
    try:
        yield df.sparkSession.read.parquet(path)
    finally:
        _delete(df.sparkSession, path)
        _scratch.remove(path)


def collect_garbage(spark: SparkSession) -> None:
    """Let the driver drop what nothing refers to any more: shuffle files stay on the executors' disks until it does."""
    spark.sparkContext._jvm.System.gc()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows and their partitions no longer depend on recomputation.

    For frames of keys rather than lines, and where row order and partitions must stay fixed.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_base(spark))
    return df.checkpoint(eager=True)
