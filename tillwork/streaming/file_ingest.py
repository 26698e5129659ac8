"""Ingest only the files that have not been seen, with the stream checkpoint as the memory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwork.sources.names import clean_name, table_name
from tillwork.sources.warehouse import BATCH, Warehouse, batch_key


def incr_file_ingest(
    warehouse: Warehouse,
    folder: str,
    layer: str,
    table: str,
    schema: str | T.StructType,
    checkpoint: str,
    fmt: str = "csv",
    max_files: int | None = None,
) -> str:
    """Load files that arrived since the last call into a table, then stop.

    Each micro-batch is one partition written with dynamic overwrite, so a batch that is replayed
    after a lost driver or executor replaces itself instead of adding rows twice.
    """
    spark = warehouse.spark
    name = table_name(layer, table)
    reader = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("escape", '"')
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def store(batch: DataFrame, number: int) -> None:
        renamed = batch.toDF(*[clean_name(c) for c in batch.columns])
        warehouse.write_batches(layer, table, renamed.withColumn(BATCH, F.lit(batch_key(f"ingest {number}"))))

    query = (
        reader.load(folder)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return name


def text_schema(spark: SparkSession, path: str) -> T.StructType:
    """All-text schema from the header of the files in a folder."""
    return spark.read.option("header", True).csv(path).schema
