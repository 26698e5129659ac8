"""Random forests and boosted trees over many training sets at once, grown level by level from histograms.

The fits of a cross-validation share their rows: a row is kept once, as one byte per feature and training set, and one
job grows a level of all trees of all training sets (or as many as fit a task's memory). Tasks send sums per node and
bin, never rows; files of a level's sums are removed with the level. Thresholds, splits and leaves follow Spark ML's
tree learners; between splits of equal gain rounding decides, so held-out scores differ from theirs. The bootstrap of a forest is drawn from a hash of the
row and the tree, so it does not depend on partitions, and differs from Spark ML's draw, which does.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from math import ceil, exp, factorial

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

MAX_BINS = 32
#: Bytes of sums that a task holds for one job.
HELD_BYTES = 64 << 20
#: Bytes of all tasks' sums up to which the driver adds them up itself.
DRIVER_BYTES = 32 << 20
#: Rows from which a task is worth its start, and rows of one block.
LEAST_ROWS, BLOCK_ROWS = 4_096, 16_384
#: Rounds of boosting after which the rows' predictions are checkpointed.
CHECKPOINT_ROUNDS = 10


@dataclass
class Tree:
    """Nodes in heap order from 1: the split feature (-1 in a leaf), the last bin that goes left, the mean, gain * rows."""

    feature: np.ndarray
    bin: np.ndarray
    mean: np.ndarray
    gain: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 2 << depth
        return cls(np.full(n, -1, np.int16), np.zeros(n, np.uint8), np.zeros(n), np.zeros(n))

    def places(self, codes: np.ndarray, levels: int) -> np.ndarray:
        """Node of each row after so many levels; `codes` has a row per feature."""
        n = codes.shape[1]
        flat, at, node = codes.ravel(), np.arange(n), np.ones(n, np.int64)
        for _ in range(levels):
            feature = self.feature[node].astype(np.int64)
            inner = feature >= 0
            right = flat[np.where(inner, feature, 0) * n + at] > self.bin[node]
            node = np.where(inner, 2 * node + right, node)
        return node


class Importances:
    def __init__(self, values: np.ndarray):
        self.values = values

    def toArray(self) -> np.ndarray:
        return self.values


@dataclass
class TreeEnsemble:
    """A fitted forest or sequence of boosted trees; the prediction is the weighted sum of the trees' leaves."""

    thresholds: list[np.ndarray]
    depth: int
    weights: list[float]
    boosted: bool
    trees: list[Tree] = field(default_factory=list)

    def predict(self, values: np.ndarray) -> np.ndarray:
        codes = bin_codes(values, self.thresholds)
        total = np.zeros(len(values))
        for tree, weight in zip(self.trees, self.weights):
            total += weight * tree.mean[tree.places(codes, self.depth)]
        return total

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds PREDICTION from the vector column `features`."""
        k = len(self.thresholds)

        @F.arrow_udf("double")
        def predicted(x: pa.Array) -> pa.Array:
            return pa.array(self.predict(x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), k)))

        return df.withColumn("PREDICTION", predicted(vector_to_array("features")))

    @property
    def featureImportances(self) -> Importances:
        """Gains by feature; each tree of a forest counts the same."""
        total = np.zeros(len(self.thresholds))
        for tree in self.trees:
            inner = tree.feature >= 0
            one = np.bincount(tree.feature[inner], tree.gain[inner], len(total))
            total += one if self.boosted or not one.sum() else one / one.sum()
        return Importances(total / total.sum() if total.sum() else total)


def bin_codes(values: np.ndarray, thresholds: Sequence[np.ndarray]) -> np.ndarray:
    """A row per feature: the number of thresholds below each value, so a value up to a threshold goes left of it."""
    return np.stack([np.searchsorted(t, values[:, f]) for f, t in enumerate(thresholds)]).astype(np.uint8)


def thresholds_of(values: np.ndarray, rows: int, total: float) -> np.ndarray:
    """Split points of one feature: all midpoints if there are few values, else near-equal counts, as Spark ML has them.

    `values` are drawn from `rows` rows with `total` as their expected number; what the draw lacks counts as zeros.
    """
    distinct, counts = np.unique(values[values != 0], return_counts=True)
    counts = counts.astype(float)
    zeros = total - counts.sum()
    if zeros > 1e-9 * max(total, 1.0):
        at = np.searchsorted(distinct, 0.0)
        distinct, counts = np.insert(distinct, at, 0.0), np.insert(counts, at, zeros)
    splits = min(MAX_BINS, rows) - 1
    middles = (distinct[:-1] + distinct[1:]) / 2.0
    if len(middles) <= splits:
        return middles
    chosen, stride = [], total / (splits + 1)
    upto, target = np.cumsum(counts), stride
    for i in range(1, len(distinct)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            chosen.append(middles[i - 1])
            target += stride
    return np.array(chosen)


def _sampled(rows: DataFrame, n: int, seed: int) -> tuple[np.ndarray, float]:
    """Feature values that thresholds are chosen from, and their expected number.

    All of up to 10,000 rows, else Spark ML's own draw of about as many.
    """
    x = rows.select(vector_to_array("RAW").alias("x"))
    fraction = max(MAX_BINS * MAX_BINS, 10_000) / n
    if fraction < 1:
        spark = rows.sparkSession
        drawn = spark.sparkContext._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
        sample = x._jdf.toJavaRDD().sample(False, fraction, drawn)
        x = DataFrame(spark._jsparkSession.createDataFrame(sample, x._jdf.schema()), spark)
    return np.array([r["x"] for r in x.collect()]), min(fraction, 1.0) * n


# Poisson(1) by its cumulated shares of 2 ** 64.
_SHARES = np.cumsum([exp(-1) / factorial(k) for k in range(20)])
_LIMITS = np.array([min(int(p * 2.0**64), 2**64 - 1) for p in _SHARES if p < 1 - 2.0**-52], np.uint64)


def _poisson(hashes: np.ndarray, salt: int) -> np.ndarray:
    """How often each row is drawn for the tree of the salt (splitmix64)."""
    z = hashes + np.uint64((salt + 1) * 0x9E3779B97F4A7C15 % 2**64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    drawn = np.zeros(len(z))
    for limit in _LIMITS:
        more = z >= limit
        if not more.any():
            break
        drawn += more
    return drawn


@dataclass
class Block:
    """Rows of a task: row hash, label and fold; per training set the codes and boosted predictions of its own rows."""

    hashes: np.ndarray
    label: np.ndarray
    fold: np.ndarray
    codes: list[np.ndarray]
    score: list[np.ndarray]

    @classmethod
    def joined(cls, parts: Sequence[Block]) -> Block:
        flat = [np.concatenate([getattr(p, n) for p in parts]) for n in ("hashes", "label", "fold")]
        listed = [[np.concatenate(some, axis=-1) for some in zip(*[getattr(p, n) for p in parts])] for n in ("codes", "score")]
        return cls(*flat, *listed)

    def inside(self, folds: Sequence[int | None]) -> list[np.ndarray | slice]:
        """The rows of each training set."""
        return [slice(None) if f is None else np.flatnonzero(self.fold != f) for f in folds]


class TrainingSets:
    """The training rows as blocks of codes. `folds` lists the fold left out by each training set, None for none.

    Training sets without a row are left out.
    """

    def __init__(self, rows: DataFrame, folds: Sequence[int | None], seed: int = 42):
        self.spark, self.seed = rows.sparkSession, seed
        self.rows = rows.filter("IS_TRAIN")
        held = {r["FOLD"]: r["count"] for r in self.rows.groupBy("FOLD").count().collect()}
        self.sizes = {f: n for f in folds if (n := sum(held.values()) - (held.get(f, 0) if f is not None else 0))}
        self.folds = list(self.sizes)
        self.thresholds = [self._thresholds(f) for f in self.folds]
        self.bins = [np.array([len(t) + 1 for t in found]) for found in self.thresholds]
        self.tasks = max(1, min(self.spark.sparkContext.defaultParallelism, ceil(sum(held.values()) / LEAST_ROWS)))
        self.blocks = self._blocks().persist(StorageLevel.MEMORY_AND_DISK) if self.folds else None

    def _thresholds(self, fold: int | None) -> list[np.ndarray]:
        rows = self.rows if fold is None else self.rows.filter(F.col("FOLD") != fold)
        found, total = _sampled(rows, self.sizes[fold], self.seed)
        return [thresholds_of(found[:, f], self.sizes[fold], total) for f in range(found.shape[1])]

    def _blocks(self) -> RDD:
        thresholds, folds = self.thresholds, self.folds

        def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hashes, label, fold = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("hash", "label", "fold"))
                values = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                for at in range(0, batch.num_rows, BLOCK_ROWS):
                    cut = slice(at, at + BLOCK_ROWS)
                    made = Block(hashes[cut].view(np.uint64), label[cut], fold[cut].astype(np.int16), [], [])
                    for mine, t in zip(made.inside(folds), thresholds):
                        made.codes.append(bin_codes(values[cut][mine], t))
                        made.score.append(np.zeros(made.codes[-1].shape[1]))
                    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(made, 5)], pa.binary())], ["block"])

        wide = self.rows.select(F.xxhash64("CUSTOMER_ID").alias("hash"), F.col("TARGET").cast("double").alias("label"),
                                F.col("FOLD").cast("long").alias("fold"), vector_to_array("RAW").alias("x"))
        parts = wide.mapInArrow(code, "block BINARY").rdd.map(lambda r: bytes(r["block"])).repartition(self.tasks)

        def join(found: Iterator[bytes]) -> Iterator[Block]:
            some = [pickle.loads(b) for b in found]
            if some:
                yield Block.joined(some)

        return parts.mapPartitions(join)

    def release(self) -> None:
        if self.blocks is not None:
            self.blocks.unpersist()

    def _grown(self, blocks: RDD, due: list[tuple[int, int, Tree, np.ndarray]], level: int, boosted: bool, first: bool) -> None:
        """Split the frontier of each due tree: (training set, number, tree, frontier nodes)."""
        sets, bins, context = self.folds, self.bins, self.spark.sparkContext
        shipped = context.broadcast([(s, k, t.feature, t.bin, nodes) for s, k, t, nodes in due])

        def sums(found: Iterator[Block]) -> Iterator[tuple[int, tuple[np.ndarray, ...]]]:
            for block in found:
                inside = block.inside(sets)
                for i, (s, k, feature, cut, nodes) in enumerate(shipped.value):
                    codes, label, weight = block.codes[s], block.label[inside[s]], None
                    if boosted:
                        label = label if first else 2.0 * (label - block.score[s])
                    else:
                        weight = _poisson(block.hashes[inside[s]], k)
                        drawn = np.flatnonzero(weight)
                        codes, label, weight = codes[:, drawn], label[drawn], weight[drawn]
                    slots = np.full(2 << level, -1, np.int64)
                    slots[nodes] = np.arange(len(nodes))
                    at = slots[Tree(feature, cut, None, None).places(codes, level)]
                    if (at < 0).any():
                        here = np.flatnonzero(at >= 0)
                        codes, label, at = codes[:, here], label[here], at[here]
                        weight = None if weight is None else weight[here]
                    yield i, histograms(codes, label, weight, at, len(nodes), bins[s])

        def best(found: Iterator[tuple[int, tuple[np.ndarray, ...]]]) -> Iterator[tuple[int, tuple[np.ndarray, ...]]]:
            added: dict[int, list[np.ndarray]] = {}
            for i, parts in found:
                added[i] = [a + b for a, b in zip(added[i], parts)] if i in added else list(parts)
            for i, (count, total, square) in added.items():
                yield i, best_splits(count.astype(float), total, square, bins[shipped.value[i][0]])

        sent = blocks.mapPartitions(sums)
        size = sum(len(nodes) * int(bins[s].sum()) * 12 for s, _, _, nodes in due)
        if self.tasks == 1:
            results = sent.mapPartitions(best).collect()
        elif size * self.tasks <= DRIVER_BYTES:
            results = list(best(iter(sent.collect())))
        else:
            dealt = sent.partitionBy(min(len(due), self.tasks), lambda i: i).mapPartitions(best)
            results = dealt.collect()
            dealt._jrdd.rdd().cleanShuffleDependencies(False)
        for i, (feature, cut, gain, left, right, mean) in results:
            _, _, tree, nodes = due[i]
            tree.mean[nodes] = mean
            inner = feature >= 0
            at = nodes[inner]
            tree.feature[at], tree.bin[at], tree.gain[at] = feature[inner], cut[inner], gain[inner]
            tree.mean[2 * at], tree.mean[2 * at + 1] = left[inner], right[inner]
        shipped.destroy()

    def _grow(self, blocks: RDD, trees: list[tuple[int, int, Tree]], depth: int, boosted: bool = False, first: bool = False) -> None:
        """Grow all trees to the depth, each level in as few jobs as the memory of a task allows."""
        for level in range(depth):
            due: list[tuple[int, int, Tree, np.ndarray]] = []
            size = 0
            for s, k, tree in trees:
                above = np.arange(1 << level >> 1, 1 << level)
                nodes = np.array([1]) if not level else (2 * above[tree.feature[above] >= 0][:, None] + [0, 1]).ravel()
                own = len(nodes) * int(self.bins[s].sum()) * 12
                if due and size + own > HELD_BYTES:
                    self._grown(blocks, due, level, boosted, first)
                    due, size = [], 0
                if len(nodes):
                    due.append((s, k, tree, nodes))
                    size += own
            if due:
                self._grown(blocks, due, level, boosted, first)

    def forests(self, trees: int, depth: int, seed: int) -> dict[int | None, TreeEnsemble]:
        """A random forest for each training set."""
        made = {f: TreeEnsemble(self.thresholds[s], depth, [1.0 / trees] * trees, False, [Tree.empty(depth) for _ in range(trees)])
                for s, f in enumerate(self.folds)}
        if made:
            each = [(s, seed * 1_000_003 + k, t) for s, f in enumerate(self.folds) for k, t in enumerate(made[f].trees)]
            self._grow(self.blocks, each, depth)
        return made

    def boosted(self, rounds: int, depth: int, step: float) -> dict[int | None, TreeEnsemble]:
        """Boosted trees for each training set; the first tree counts whole, the others by the step."""
        weights = [1.0] + [step] * (rounds - 1)
        made = {f: TreeEnsemble(t, depth, weights, True) for f, t in zip(self.folds, self.thresholds)}
        former = blocks = self.blocks
        for k in range(rounds if made else 0):
            trees = [Tree.empty(depth) for _ in self.folds]
            self._grow(blocks, [(s, k, t) for s, t in enumerate(trees)], depth, True, k == 0)
            if former is not self.blocks:
                former.unpersist()  # its rows are in `blocks` since the first level
            for f, t in zip(self.folds, trees):
                made[f].trees.append(t)
            if k + 1 < rounds:
                former, blocks = blocks, blocks.mapPartitions(_scored_by(trees, weights[k], depth)).persist(StorageLevel.MEMORY_AND_DISK)
                if (k + 1) % CHECKPOINT_ROUNDS == 0:
                    blocks.checkpoint()
        if blocks is not self.blocks:
            blocks.unpersist()
        return made


def histograms(
    codes: np.ndarray, label: np.ndarray, weight: np.ndarray | None, at: np.ndarray, n: int, bins: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights and weighted labels per node and bin, the features' bins one after the other, and squares per node."""
    starts = {b: at * b for b in set(bins.tolist())}
    weighed = label if weight is None else weight * label
    count, total = [], []
    for f, b in enumerate(bins.tolist()):
        place = starts[b] + codes[f]
        count.append(np.bincount(place, weight, n * b).reshape(n, b).astype(np.uint32))
        total.append(np.bincount(place, weighed, n * b).reshape(n, b))
    return np.hstack(count), np.hstack(total), np.bincount(at, weighed * label, n)


def _scored_by(trees: Sequence[Tree], weight: float, depth: int):
    def run(found: Iterator[Block]) -> Iterator[Block]:
        for block in found:
            score = [old + weight * t.mean[t.places(c, depth)] for old, c, t in zip(block.score, block.codes, trees)]
            yield Block(block.hashes, block.label, block.fold, block.codes, score)

    return run


def best_splits(count: np.ndarray, total: np.ndarray, square: np.ndarray, bins: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per node: feature (-1 if no split gains), bin, gain * rows, mean left and right, mean. The first of equal gains wins.

    Rows are nodes, columns the bins of all features one after the other; `square` sums the squared labels of a node.
    """
    n, s = count[:, : bins[0]].sum(axis=1), total[:, : bins[0]].sum(axis=1)
    safe = np.maximum(n, 1.0)
    winner, gains = np.zeros(len(n), np.int64), np.full(len(n), -np.inf)
    owner, place, left = np.full(len(n), -1, np.int16), np.zeros(len(n), np.uint8), np.zeros((2, len(n)))
    for f, end in enumerate(np.cumsum(bins)):
        if bins[f] < 2:
            continue
        nl = np.cumsum(count[:, end - bins[f] : end - 1], axis=1)
        sl = np.cumsum(total[:, end - bins[f] : end - 1], axis=1)
        nr, sr = n[:, None] - nl, s[:, None] - sl
        score = np.where((nl >= 1) & (nr >= 1), sl * sl / np.maximum(nl, 1.0) + sr * sr / np.maximum(nr, 1.0), -np.inf)
        winner = score.argmax(axis=1)
        rows = np.arange(len(n))
        better = score[rows, winner] > gains
        gains = np.where(better, score[rows, winner], gains)
        owner, place = np.where(better, f, owner).astype(np.int16), np.where(better, winner, place).astype(np.uint8)
        left = np.where(better, np.stack([nl[rows, winner], sl[rows, winner]]), left)
    gain = gains - s * s / safe
    owner = np.where(gain > 1e-12 * square, owner, -1).astype(np.int16)
    right_n = np.maximum(n - left[0], 1.0)
    return owner, place, np.where(owner >= 0, gain, 0.0), left[1] / np.maximum(left[0], 1.0), (s - left[1]) / right_n, s / safe


@dataclass(frozen=True)
class Forest:
    """Random forest: the mean of trees on bootstrap draws, all features tried in every node."""

    trees: int
    depth: int
    seed: int = 42

    def fit(self, sets: TrainingSets) -> dict[int | None, TreeEnsemble]:
        return sets.forests(self.trees, self.depth, self.seed)


@dataclass(frozen=True)
class Boosted:
    """Gradient boosting of squared errors: each tree is fitted to twice the residuals, as in Spark ML."""

    trees: int
    depth: int
    step: float

    def fit(self, sets: TrainingSets) -> dict[int | None, TreeEnsemble]:
        return sets.boosted(self.trees, self.depth, self.step)
