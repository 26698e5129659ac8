"""Parquet tables under one root folder, plus the control table of marks.

Growing tables are appended in batches: a batch is a partition named by the mark it starts from, and
is written with dynamic partition overwrite. A step that dies after writing and before moving its
mark rewrites the same partition when it runs again, so no row is lost or doubled and no stored row
is rewritten.

A table that is replaced as a whole is written as a new version beside the old one; an empty marker file, created when
all rows are there, makes the version the current one. Until then, and after a write that dies, readers see the old one.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork import schemas
from tillwork.operators.incremental import merge_watermarks
from tillwork.session import CODEC, collect_garbage
from tillwork.sources import storage
from tillwork.sources.names import clean_name, table_name

BATCH = "LOAD_BATCH"
_MARKS = "_watermarks"
_FILES = "_files"
_VERSIONS, _CURRENT = "versions", "current"
#: Versions that stay: the current one, and the one that running readers may still hold.
KEPT_VERSIONS = 2


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def current(self, name: str) -> str:
        """Folder of the table's rows: its current version, or the table's own folder if it never was replaced."""
        done = storage.children(self.spark, f"{self.path(name)}/{_CURRENT}")
        return f"{self.path(name)}/{_VERSIONS}/{done[-1]}" if done else self.path(name)

    def exists(self, name: str) -> bool:
        """Finished: with a current version, marked by a plain write, or holding batches, which appear only at commit."""
        if self.current(name) != self.path(name):
            return True
        if storage.exists(self.spark, f"{self.path(name)}/_SUCCESS"):
            return True
        return any(c.startswith(f"{BATCH}=") for c in storage.children(self.spark, self.path(name)))

    def tables(self, prefix: str = "") -> list[str]:
        """Sorted names of finished tables that start with the prefix."""
        return [n for n in storage.children(self.spark, self.root) if n.startswith(prefix) and self.exists(n)]

    def read(self, name: str, *columns: str) -> DataFrame:
        df = self.spark.read.parquet(self.current(name))
        return df.select(*columns) if columns else df.drop(BATCH)

    def read_batches(self, name: str) -> DataFrame:
        """With the batch column; a filter on it prunes partitions."""
        return self.spark.read.parquet(self.current(name))

    def prefix_union_scan(self, prefix: str) -> DataFrame:
        """All tables of a prefix in name order, columns aligned by name."""
        names = self.tables(prefix)
        if not names:
            raise LookupError(f"no table starts with {prefix}")
        result = self.read(names[0])
        for name in names[1:]:
            result = result.unionByName(self.read(name), allowMissingColumns=True)
        return result

    def overwrite(self, layer: str, table: str, df: DataFrame, ddl: str | None = None, by: str | None = None) -> str:
        """Replace a table by `df`, cast to the declared columns. `df` may read the table itself.

        `by` partitions the new version by a column, as the batches of a folded table are.
        """
        name = table_name(layer, table)
        made = storage.children(self.spark, f"{self.path(name)}/{_VERSIONS}")
        version = f"{int(made[-1]) + 1 if made else 1:012d}"
        writer = conform(df, ddl).write.option("compression", CODEC)
        (writer.partitionBy(by) if by else writer).parquet(f"{self.path(name)}/{_VERSIONS}/{version}")
        storage.touch(self.spark, f"{self.path(name)}/{_CURRENT}/{version}")
        self._forget_versions(name)
        collect_garbage(self.spark)
        return name

    def _forget_versions(self, name: str) -> None:
        """Delete versions older than the kept ones, rows before markers, and rows of the table's time without versions."""
        done = storage.children(self.spark, f"{self.path(name)}/{_CURRENT}")
        if len(done) >= KEPT_VERSIONS:
            oldest = done[-KEPT_VERSIONS]
            for part in (_VERSIONS, _CURRENT):
                for old in storage.children(self.spark, f"{self.path(name)}/{part}"):
                    if old < oldest:
                        storage.delete(self.spark, f"{self.path(name)}/{part}/{old}")
            for old in storage.children(self.spark, self.path(name)):
                if old.startswith(f"{BATCH}="):
                    storage.delete(self.spark, f"{self.path(name)}/{old}")

    def fold(self, layer: str, table: str, combine: Callable[[DataFrame], DataFrame], most: int = 16) -> bool:
        """Rewrite a table of more than `most` batches as one batch with the rows that `combine` makes of all of them.

        The batch keeps the latest name, so marks that compare batch names stay valid.
        """
        name = table_name(layer, table)
        batches = self.batches(name)
        if len(batches) <= most:
            return False
        rows = combine(self.read_batches(name)).drop(BATCH)
        self.overwrite(layer, table, rows.withColumn(BATCH, F.lit(batches[-1])), by=BATCH)
        return True

    def batches(self, name: str) -> list[str]:
        """Sorted batches of a table, from the folder names."""
        found = [c for c in storage.children(self.spark, self.current(name)) if c.startswith(f"{BATCH}=")]
        return sorted(c[len(BATCH) + 1 :] for c in found)

    def batch_counts(self, name: str) -> dict[str, int]:
        """Rows per batch, from partition names and file footers."""
        if not self.exists(name):
            return {}
        rows = self.read_batches(name).groupBy(BATCH).agg(F.count(F.lit(1)).alias("n")).collect()
        return {r[BATCH]: r["n"] for r in rows}

    def write_batch(self, layer: str, table: str, df: DataFrame, batch: str, ddl: str | None = None) -> str:
        """Add `df` as one batch, or replace that batch when it exists."""
        return self.write_batches(layer, table, conform(df, ddl).withColumn(BATCH, F.lit(batch_key(batch))))

    def write_batches(self, layer: str, table: str, df: DataFrame) -> str:
        """Replace the batches that occur in `df`, which carries the batch column; keep the others."""
        name = table_name(layer, table)
        (
            df.write.mode("overwrite")
            .option("compression", CODEC)
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BATCH)
            .parquet(self.current(name))
        )
        collect_garbage(self.spark)
        return name

    def seen_files(self, step: str) -> DataFrame:
        """Ledger of the files a step has loaded: path, time, size and load."""
        if not storage.exists(self.spark, self.path(_FILES)):
            return self.spark.createDataFrame([], schemas.FILES).filter(F.col("step") == step)
        return self.spark.read.schema(schemas.FILES).parquet(self.path(_FILES)).filter(F.col("step") == step)

    def note_files(self, rows: DataFrame) -> None:
        """Add files to the ledger. Called after their rows are written."""
        conform(rows, schemas.FILES).coalesce(1).write.mode("append").parquet(self.path(_FILES))

    def watermarks(self) -> DataFrame:
        """Latest mark per step."""
        empty = self.spark.createDataFrame([], schemas.WATERMARKS)
        if not storage.exists(self.spark, self.path(_MARKS)):
            return empty
        stored = self.spark.read.schema(schemas.WATERMARKS).parquet(self.path(_MARKS))
        return merge_watermarks(empty, stored)

    def marks(self) -> dict[str, str]:
        """Latest mark of every step, in one read."""
        return {r["table_name"]: r["last_value"] for r in self.watermarks().collect()}

    def get_watermark(self, name: str) -> str | None:
        row = self.watermarks().filter(F.col("table_name") == name).select("last_value").first()
        return row[0] if row else None

    def set_watermark(self, name: str, value: str, kind: str = "timestamp") -> None:
        """Append the new mark; reading keeps the latest. Called after the step's data is written."""
        last = self.watermarks().filter(F.col("table_name") == name).select("version").first()
        now = datetime.now(timezone.utc).replace(tzinfo=None).isoformat(timespec="microseconds")
        row = (name, str(value), kind, now, (last[0] if last else 0) + 1)
        self.append_watermarks(self.spark.createDataFrame([row], schemas.WATERMARKS))

    def append_watermarks(self, rows: DataFrame) -> None:
        rows.coalesce(1).write.mode("append").parquet(self.path(_MARKS))


def batch_key(batch: str) -> str:
    """Text of a batch in a folder name; never numeric, so it reads back as text."""
    return "b_" + clean_name(batch)


def conform(df: DataFrame, ddl: str | None) -> DataFrame:
    """Declared columns in declared order, cast to declared types."""
    if ddl is None:
        return df
    return df.select(*[F.col(n).cast(t).alias(n) for n, t in schemas.columns(ddl)])
