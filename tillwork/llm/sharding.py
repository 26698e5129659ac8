"""Rendezvous hashing of record keys over weighted shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwork.llm.common import query, table
from tillwork.session import stage


def _score(key: Column, shard: int, weight: float) -> Column:
    """-weight / ln(u): the largest score wins with a probability proportional to its weight."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11).cast("double")
    return F.lit(-float(weight)) / F.log((bits + F.lit(0.5)) / F.lit(2.0**53))


def rendezvous_shard(key: Column, weights: Sequence[float]) -> Column:
    """Shard of a key: its highest scored shard. A new last shard takes keys only into itself.

    The result depends on the key and the weights alone. A null key is a key like any other; a shard of weight 0
    gets nothing. Raises ValueError if no weight is positive.
    """
    if not any(w > 0 for w in weights) or any(w < 0 for w in weights):
        raise ValueError("weights must not be negative and one must be positive")
    scored = [F.struct(_score(key, i, w).alias("s"), F.lit(-i).alias("i")) for i, w in enumerate(weights) if w > 0]
    return -F.array_max(F.array(*scored))["i"]


def with_slots(df: DataFrame, group: str, out: str = "slot", cells: int = 1024) -> DataFrame:
    """Gapless numbers from 0 within each group, without one task per group.

    Rows of a group are dealt to `cells` cells by their row number in the staged table; cells are numbered apart
    and shifted by the counts of the cells before them. What is joined has groups x cells rows, whatever the input.
    """
    df = stage(df.withColumn("_row", F.monotonically_increasing_id()), "slots")
    df = df.withColumn("_cell", F.pmod(F.xxhash64("_row"), F.lit(cells)))
    before = W.partitionBy(group).orderBy("_cell").rowsBetween(W.unboundedPreceding, -1)
    base = df.groupBy(group, "_cell").agg(F.count("*").alias("_n"))
    base = base.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    numbered = df.withColumn("_i", F.row_number().over(W.partitionBy(group, "_cell").orderBy("_row")) - 1)
    return numbered.join(base, [group, "_cell"]).withColumn(out, (F.col("_base") + F.col("_i")).cast("long")).drop(
        "_row", "_cell", "_base", "_i"
    )


@query("op1_rendezvous_shards")
def op1_rendezvous_shards(spark, sf_dir: str, shards: int = 40) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    placed = docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous_shard(F.col("doc_id"), [1.0] * shards).alias("shard"),
        rendezvous_shard(F.col("doc_id"), [1.0] * (shards + 1)).alias("grown_shard"),
    )
    return with_slots(placed, "shard").select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
