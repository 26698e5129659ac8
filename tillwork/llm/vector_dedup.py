"""Near-duplicate vectors by counting collisions of one-dimensional projections.

A window around every query on one projection holds a fixed share of all vectors, so pairs met there grow with the
square of the table. Each list is therefore keyed by several projections at once: windows become cells of one width
with a random offset, and a list collides for a pair when all its projections do. The number of projections per list
grows with the logarithm of the table, so that chance meetings stay below the number of vectors; the number of lists
and the count a pair must pass follow from the wanted recall at the cosine threshold.
"""

from __future__ import annotations

from math import ceil, comb, erf, exp, log, pi, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.llm.common import components, query, table
from tillwork.session import stage

#: Members of one cell that are compared in one block.
BLOCK = 512
#: Rows of small cells that one task takes together.
TASK_ROWS = 8000


def same_cell(distance: float, width: float) -> float:
    """Probability that two points at a distance fall into one cell of a Gaussian projection."""
    if distance <= 0:
        return 1.0
    a = width / distance
    return erf(a / sqrt(2)) - sqrt(2 / pi) * (1 - exp(-a * a / 2)) / a


class Projections:
    """Keys of unit vectors in every list, from a seed; `least` is the collision count that a pair has to pass."""

    def __init__(self, dim: int, rows: int, cosine: float, recall: float, width: float = 2.4, seed: int = 7):
        far, near = same_cell(sqrt(2.0), width), same_cell(sqrt(2 - 2 * cosine), width)
        self.each = max(4, ceil(log(10.0 * max(rows, 2)) / log(1 / far)))
        p = near**self.each
        self.lists = max(1, ceil(log(1 - recall) / log(1 - p))) if p < 1 else 1
        reach, self.least = 1.0, 0
        while self.least < self.lists:  # the largest count that still reaches the recall
            reach -= comb(self.lists, self.least) * p**self.least * (1 - p) ** (self.lists - self.least)
            if self.least and reach < recall:
                break
            self.least += 1
        self.least = max(1, self.least)
        self.dim, self.width, self.seed = dim, width, seed

    def keys(self, unit: np.ndarray) -> np.ndarray:
        """One 64-bit key per vector and list."""
        rng = np.random.default_rng(self.seed)
        out = np.empty((len(unit), self.lists), dtype=np.int64)
        for t in range(self.lists):
            lines = rng.standard_normal((self.dim, self.each))
            offset = rng.uniform(0, self.width, self.each)
            odd = rng.integers(1, 2**62, self.each, dtype=np.int64) * 2 + 1
            with np.errstate(over="ignore"):
                out[:, t] = (np.floor((unit @ lines + offset) / self.width).astype(np.int64) * odd).sum(axis=1)
        return out


def _units(vectors) -> np.ndarray:
    x = np.array([np.asarray(v, dtype=np.float64) for v in vectors])
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _labels(near: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Smallest id in each row's component of a symmetric boolean matrix."""
    low = ids.copy()
    while True:
        new = np.minimum(low, np.where(near, low[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (new == low).all():
            return low
        low = new


def _compare(unit, keys, ids, left, right, t, least, cosine):
    """Which pairs of two blocks link; each pair counts only in its first colliding list."""
    same = keys[left][:, None, :] == keys[right][None, :, :] if len(left) * len(right) * keys.shape[1] <= 4_000_000 else None
    if same is None:
        hits = np.zeros((len(left), len(right)), dtype=np.int32)
        before = np.zeros(hits.shape, dtype=bool)
        for k in range(keys.shape[1]):
            hit = keys[left, k][:, None] == keys[right, k][None, :]
            hits += hit
            if k < t:
                before |= hit
    else:
        hits, before = same.sum(axis=2), same[:, :, :t].any(axis=2)
    ok = (hits >= least) & ~before & (ids[left][:, None] != ids[right][None, :])
    return ok & (unit[left] @ unit[right].T >= cosine)


def _task(group: pd.DataFrame, plan: Projections, cosine: float) -> pd.DataFrame:
    unit = _units(group["v"])
    keys, ids, times = plan.keys(unit), group["id"].to_numpy(np.int64), group["times"].to_numpy(np.int64)
    lists, cells, side = group["t"].to_numpy(), group["cell"].to_numpy(np.int64), group["side"].to_numpy()
    order = np.lexsort((cells, lists))
    ends = np.flatnonzero((np.diff(lists[order]) != 0) | (np.diff(cells[order]) != 0)) + 1
    out = []
    for member in np.split(order, ends):
        t = int(lists[member[0]])
        left, right = member[side[member] != 2], member[side[member] != 1]
        if not len(left) or not len(right):
            continue
        near = _compare(unit, keys, ids, left, right, t, plan.least, cosine)
        if not near.any():
            continue
        one_block = (side[member] == 0).all()
        parts = [(left, near, right)] if one_block else [(left, near, right), (right, near.T, left)]
        for mine, links, others in parts:
            has = links.any(axis=1)
            out.append((ids[mine][has], (links[has] * times[others][None, :]).sum(axis=1), ids[mine][has], np.zeros(has.sum(), bool)))
        n, at = len(member), {m: i for i, m in enumerate(member)}
        full = np.zeros((n, n), dtype=bool)
        full[np.ix_([at[m] for m in left], [at[m] for m in right])] = near
        low = _labels(full | full.T, ids[member])
        moved = low < ids[member]
        out.append((ids[member][moved], np.zeros(moved.sum(), np.int64), low[moved], np.ones(moved.sum(), bool)))
    if not out:
        return pd.DataFrame({"id": [], "links": [], "low": [], "edge": []}).astype({"id": "int64", "links": "int64", "low": "int64", "edge": bool})
    return pd.DataFrame(dict(zip(("id", "links", "low", "edge"), map(np.concatenate, zip(*out)))))


def _task_of(plan: Projections, cosine: float):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        return _task(group, plan, cosine)

    return run


def near_vectors(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = 0.95, recall: float = 0.995
) -> DataFrame:
    """(key, n_links, component): other vectors at `cosine` or above, and the smallest key reachable, itself included.

    Every pair reported is verified in double precision; pairs at the threshold are found with probability `recall`,
    closer ones more often. Equal vectors are one node that carries their number. Pairs are never written: a cell's
    task returns link counts and a spanning set of edges. Cells over BLOCK members are cut into block pairs that are
    tasks of their own, so a hot cell is spread and compared in full. Null, empty and zero vectors and those with null
    or non-finite parts link with nothing, and neither do vectors of different lengths.
    """
    sound = F.coalesce(
        F.expr(
            f"size(`{vector}`) > 0 AND forall(`{vector}`, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf'))"
            f" AND exists(`{vector}`, x -> x <> 0)"
        ),
        F.lit(False),
    )
    rows = df.select(F.col(key).alias("_key"), F.when(sound, F.col(vector)).alias("v"))
    classes = rows.filter("v IS NOT NULL AND _key IS NOT NULL").groupBy("v").agg(F.min("_key").alias("id"), F.count("*").alias("times"))
    classes = stage(classes, "vectors")
    links, edges = None, None
    for size in classes.groupBy(F.size("v").alias("dim")).count().collect():  # the lengths of a table's vectors
        dim, count = size["dim"], size["count"]
        plan = Projections(dim, count, cosine, recall)
        part = classes.filter(F.size("v") == dim)

        def cells(batches, plan=plan):
            for batch in batches:
                if len(batch):
                    yield pd.DataFrame({"id": batch["id"], "keys": list(plan.keys(_units(batch["v"])))})

        keyed = stage(part.select("id", "v").mapInPandas(cells, "id long, keys array<long>"), "cells")
        keyed = keyed.select("id", F.posexplode("keys").alias("t", "cell"))
        crowd = keyed.groupBy("t", "cell").agg(F.count("*").alias("n")).filter("n > 1")
        met = keyed.join(crowd, ["t", "cell"]).withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
        tasks = max(1, ceil(count * plan.lists / 10 / TASK_ROWS))
        small = met.filter("blocks = 1").select(
            "id", "t", "cell", F.lit(0).alias("side"), F.lit(0).alias("a"), F.lit(0).alias("b"),
            F.pmod(F.xxhash64("t", "cell"), F.lit(tasks)).alias("task"),
        )
        own = F.expr("cast(pmod(xxhash64(id, t), blocks) as int)")
        large = met.filter("blocks > 1").withColumn("own", own).withColumn("o", F.explode(F.expr("sequence(0, blocks - 1)")))
        large = large.select(
            "id", "t", "cell", F.expr("IF(own = o, 0, IF(own < o, 1, 2))").alias("side"), F.least("own", "o").alias("a"),
            F.greatest("own", "o").alias("b"), F.xxhash64("t", "cell").alias("task"),
        )
        work = small.unionByName(large).join(part, "id")

        found = stage(
            work.groupBy("task", "a", "b").applyInPandas(_task_of(plan, cosine), "id long, links long, low long, edge boolean"), "links"
        )
        here = found.filter("NOT edge").groupBy("id").agg(F.sum("links").alias("links"))
        tied = found.filter("edge").select(F.col("id").alias("u"), F.col("low").alias("v"))
        links, edges = (here, tied) if links is None else (links.unionByName(here), edges.unionByName(tied))
    named = classes.select("v", "id", "times")
    if links is None:
        named = named.withColumn("links", F.lit(0).cast("long")).withColumn("component", F.col("id"))
    else:
        linked = components(edges).withColumnRenamed("node", "id")
        named = named.join(links, "id", "left").join(linked, "id", "left")
    named = named.select("v", "times", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "id").alias("component"))
    known = F.col("component").isNotNull() & F.col("_key").isNotNull()
    return rows.join(named, "v", "left").select(
        F.col("_key").alias(key),
        F.when(known, F.col("links") + F.col("times") - 1).otherwise(0).cast("long").alias("n_links"),
        F.when(known, F.col("component")).otherwise(F.col("_key")).alias("component"),
    )


@query("op7_vector_dedup")
def op7_vector_dedup(spark, sf_dir: str) -> DataFrame:
    found = near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return found.select(
        "vec_id", "n_links", F.col("component").alias("component_id"), (F.col("vec_id") == F.col("component")).alias("kept")
    )
