"""SimHash near-duplicates through one-wildcard variants of fingerprint segments."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.llm.common import components, map_texts, query, table
from tillwork.session import stage

#: Fingerprints of one segment variant that are compared pair by pair.
CROWD = 32
#: Fingerprints whose variants one task makes.
NODES = 10_000


def simhash(text: str, width: int = 3, seed: int = 42) -> int:
    """Majority of the bits of the XXH64 of all shingles, repeats included; 0 without words."""
    words = text.encode().lower().split()  # bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    if len(words) < width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, seed) for s in shingles), dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65536):
        block = hashes[at : at + 65536].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def fingerprints(df: DataFrame, key: str, text: str, width: int = 3, seed: int = 42) -> DataFrame:
    """(key, fp) of every row; fp is the fingerprint as a signed long."""

    def work(texts: list[str]) -> list[pa.Array]:
        fps = np.array([simhash(t, width, seed) for t in texts], dtype=np.uint64)
        return [pa.array(fps.view(np.int64))]

    return map_texts(df, text, [key], work, "fp long")


def near_edges(fps: DataFrame, distance: int = 2) -> DataFrame:
    """Edges (u, v) that connect all distinct fingerprints `fp` at `distance` 2 bits or fewer, and no others.

    Two segments of 32 bits: of two bits, one segment holds at most one, so the fingerprints agree on one of its
    32 variants with a bit masked. Equal variants are joined and their fingerprints verified. A variant shared
    by more than CROWD fingerprints is not paired up: each of its fingerprints is filed under itself and its 64
    one-bit neighbours, and all that share such a place (they differ by two bits at most) are tied to the smallest.
    Every link at distance 1 or 2 has such a place, so the components are the same, with 65 rows per fingerprint.
    """
    if distance != 2:
        raise ValueError("two segments serve distance 2")
    variants = F.expr(
        "transform(sequence(0, 63), i -> struct(cast(i as byte) AS i,"
        " IF(i < 32, shiftrightunsigned(fp, 32), fp & 4294967295L) & ~shiftleft(1L, i % 32) AS part))"
    )
    tasks = max(1, fps.count() // NODES)  # 64 rows are made of each, so few bytes are many rows
    keyed = fps.repartition(tasks, "fp").select("fp", F.explode(variants).alias("k")).select("fp", "k.i", "k.part")
    shared = keyed.groupBy("i", "part").agg(F.count("*").alias("n")).filter("n > 1")
    live = keyed.join(shared, ["i", "part"])
    few = live.filter(F.col("n") <= CROWD).groupBy("i", "part").agg(F.collect_list("fp").alias("all"))
    close = few.select(
        F.explode(
            F.expr(
                "flatten(transform(all, a -> transform(filter(all, b -> b < a AND bit_count(a ^ b) <= 2),"
                " b -> struct(a AS u, b AS v))))"
            )
        ).alias("e")
    ).select("e.u", "e.v")
    crowd = live.filter(F.col("n") > CROWD).select("fp").distinct()
    places = crowd.select(
        "fp", F.explode(F.expr("concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i)))")).alias("at")
    )
    tied = places.join(places.groupBy("at").agg(F.min("fp").alias("low"), F.count("*").alias("n")).filter("n > 1"), "at")
    ties = tied.filter("fp > low").select(F.col("fp").alias("u"), F.col("low").alias("v"))
    return close.unionByName(ties).distinct()


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, seed: int = 42) -> DataFrame:
    """(key, fp, component): component is the smallest key reachable by links of at most two bits, itself included.

    Equal fingerprints are one node, so copies are never paired. Null and empty texts have fingerprint 0, linked like
    any other. Repeated rows get the same component; a null key stays and is never the smallest.
    """
    prints = stage(fingerprints(df, key, text, width, seed), "simhash")
    nodes = stage(prints.groupBy("fp").agg(F.min(key).alias("low")), "simhash-nodes")
    linked = components(near_edges(nodes.select("fp")))
    groups = nodes.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "group", F.coalesce("component", "fp")
    )
    lows = groups.groupBy("group").agg(F.min("low").alias("least"))
    named = groups.join(lows, "group").select("fp", F.col("least").alias("component"))
    return prints.join(named, "fp").select(key, "fp", "component")


@query("op9_simhash")
def op9_simhash(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id")
    )
