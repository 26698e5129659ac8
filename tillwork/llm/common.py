"""Small helpers shared by the operators: tables, ASCII case, linked components."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.session import cut_lineage

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


#: Rows of an Arrow batch that are turned into Python objects at a time.
SLICE_ROWS = 500
#: Rows that Spark puts into an Arrow batch of texts.
ARROW_ROWS = 1000


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in short pieces, so that a task holds few texts as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


def small_batches(spark: SparkSession) -> None:
    """Bound what a task holds outside of the heap: texts are long, and Spark's own 10,000 rows a batch suit numbers."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= ARROW_ROWS:
        spark.conf.set(name, str(ARROW_ROWS))


def map_texts(df: DataFrame, text: str, keep: Sequence[str], work: Callable[[list[str]], list[pa.Array]], made: str) -> DataFrame:
    """The kept columns beside the columns `made` (DDL) that `work` returns for a list of texts, row by row, without a shuffle.

    Null texts are passed as empty. Kept columns stay in Arrow, so any value of theirs comes back as it was.
    """
    small_batches(df.sparkSession)
    kinds = dict(df.dtypes)
    head = [f"_{i}" for i in range(len(keep))]
    names = [part.split()[0] for part in made.split(", ")]
    source = head[list(keep).index(text)] if text in keep else "_text"  # a kept text is sent once

    def run(batches):
        for batch in slices(batches):
            new = work([t or "" for t in batch.column(source).to_pylist()])
            yield pa.RecordBatch.from_arrays([*(batch.column(h) for h in head), *new], [*head, *names])

    columns = [F.col(c).alias(h) for c, h in zip(keep, head)]
    rows = df.select(*columns) if text in keep else df.select(*columns, F.col(text).alias("_text"))
    schema = ", ".join([*(f"{h} {kinds[c]}" for c, h in zip(keep, head)), made])
    return rows.mapInArrow(run, schema).toDF(*keep, *names)


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star pass over edges (u, v); the result has u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = large.filter("u > v").distinct()
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    joined = large.join(low, "u")
    small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        joined.select("u", F.col("m").alias("v"))
    )
    return small.filter("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of an edge table (u, v) of longs.

    Alternates large-star and small-star passes until the edges no longer change. Each pass aggregates before it
    joins, a hub's neighbours may be split over tasks, and every pass ends in a reliable checkpoint.
    """
    edges = cut_lineage(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if state == seen:
            break
        seen = state
        edges = cut_lineage(_stars(edges))
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
