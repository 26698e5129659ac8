"""Listing of folders on whatever file system the session is configured for."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def modified(spark: SparkSession, path: str) -> str | None:
    """Latest change of a file, or of any file in a folder, as sortable UTC text."""
    fs, p = _fs(spark, path)
    newest, found = 0, fs.listFiles(p, True)
    while found.hasNext():
        newest = max(newest, found.next().getModificationTime())
    if not newest:
        return None
    return datetime.fromtimestamp(newest / 1000, tz=timezone.utc).isoformat(timespec="milliseconds")


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as file listings show it."""
    fs, p = _fs(spark, path)
    return fs.makeQualified(p).toString()


def children(spark: SparkSession, path: str) -> list[str]:
    """Sorted names in a folder, hidden and bookkeeping entries left out."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(p)]
    return sorted(n for n in names if not n.startswith((".", "_")))


def set_age(spark: SparkSession, path: str, days: int) -> None:
    """Date the files of a folder back, as a copy that keeps times does."""
    fs, p = _fs(spark, path)
    found = fs.listFiles(p, True)
    while found.hasNext():
        status = found.next()
        fs.setTimes(status.getPath(), status.getModificationTime() - days * 86_400_000, -1)


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file; it is there at once or not at all."""
    fs, p = _fs(spark, path)
    fs.create(p, False).close()


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder with all it holds."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)
