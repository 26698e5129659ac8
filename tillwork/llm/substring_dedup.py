"""Removal of repeated passages: windows of words that also start earlier.

Suffixes (one per word) are partitioned by prefixes of two lengths. The short prefix is the window's smallest 8-word
gram, so that only one suffix in about seven is filed and every window still reaches the same group from all of its
occurrences. A group of one filed suffix has no internal node and ends there. Groups of several are split by the longer
prefix, the whole window; at that depth a group is one internal node of the suffix tree at window depth, of which only
the earliest start is wanted, so it is reduced by a minimum before and after the shuffle and no group, however large,
has to fit into memory. Consecutive nodes merge into maximal repeats when the words are removed.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.llm.common import map_texts, query, slices, table
from tillwork.session import stage

GRAM = 8
CACHE_SIZE = 1_000_000
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


class WordHashes(dict):
    """The 16 bytes of two 64-bit hashes of a word, remembered."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) > CACHE_SIZE:
            self.clear()
        self[word] = both = xxhash.xxh3_128_digest(word)
        return both


@lru_cache(maxsize=1)
def word_hashes() -> WordHashes:
    return WordHashes()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base: np.uint64, n: int) -> np.uint64:
    return np.uint64(pow(int(base), n, 1 << 64))


def _grams(x: np.ndarray, base: np.uint64, n: int) -> np.ndarray:
    """Polynomial hash of every run of n values, by doubling."""
    out, length, part, size = None, 0, x, 1
    while n:
        if n & 1:
            if out is None:
                out, length = part, size
            else:
                keep = len(x) - length - size + 1
                out = out[:keep] + _power(base, length) * part[length : length + keep]
                length += size
        n >>= 1
        if n:
            part = part[: len(part) - size] + _power(base, size) * part[size:]
            size *= 2
    return out


def split_words(text: str) -> list[bytes]:
    return text.encode().split()  # bytes: ASCII white space only


def _extremes(x: np.ndarray, width: int, pick) -> np.ndarray:
    """Minimum or maximum (`pick`) of every run of `width` values, by doubling."""
    size = 1
    while size < width:
        step = min(size, width - size)
        x, size = pick(x[: len(x) - step], x[step:]), size + step
    return x


def anchors(words: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(smallest gram of every window, all grams, word hashes); empty without a window."""
    if len(words) < window:
        empty = np.empty(0, dtype=np.uint64)
        return empty, empty, empty.reshape(0, 2)
    hashes = np.frombuffer(b"".join(map(word_hashes().__getitem__, words)), dtype="<u8").reshape(-1, 2)
    gram = min(GRAM, window)
    grams = _mix(_grams(hashes[:, 0], _BASES[0], gram))
    return _extremes(grams, window - gram + 1, np.minimum), grams, hashes


def filed_grams(words: list[bytes], window: int) -> np.ndarray:
    """Every gram that is the smallest of a window, once for each place it stands at."""
    lows, grams, _ = anchors(words, window)
    if not len(lows):
        return lows.view(np.int64)
    span = len(grams) - len(lows)
    edge = np.zeros(span, dtype=np.uint64)
    highest = _extremes(np.concatenate([edge, lows, edge]), span + 1, np.maximum)  # over the windows that hold a gram
    return grams[highest == grams].view(np.int64)


def shared_windows(words: list[bytes], window: int, shared) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the windows whose filed gram is in `shared`, and their 128-bit hashes."""
    lows, _, hashes = anchors(words, window)
    starts = np.flatnonzero(np.isin(lows.view(np.int64), shared))
    if not len(starts):
        return starts, np.empty((0, 2), dtype=np.int64)
    both = [_mix(_grams(hashes[:, k], _BASES[k], window))[starts].view(np.int64) for k in (0, 1)]
    return starts, np.stack(both, axis=1)


def _array(value) -> np.ndarray:
    return np.empty(0, dtype=np.int64) if value is None else np.asarray(value, dtype=np.int64)


def remove_repeats(
    df: DataFrame, key: str = "doc_id", text: str = "text", window: int = 20, carry: tuple[str, ...] = (), nulls_last: bool = False
) -> DataFrame:
    """(key, carry, n_words, n_removed, kept): every row without the words of windows that also start earlier.

    Earlier is a smaller key, or an earlier start in the same document; windows are judged on the input. Words are
    runs of characters other than ASCII white space; kept words are joined by one space. Null and empty texts
    have no words. A null key counts as the smallest, or as the largest. Different texts of one key are documents of
    their own, in the order of their row numbers; repeated rows, key and text alike, get the same result. Copies of a whole text are settled
    by a minimum over its hash before any window is cut. Every document gets a row number of its own, written with its
    grams, by which the later steps tell documents apart.
    """
    null = 2**63 - 1 if nulls_last else -(2**63)
    identity = [F.coalesce(key, F.lit(null)).alias("_doc"), *(F.xxhash64(F.lit(i), F.coalesce(text, F.lit(""))).alias(f"h{i}") for i in (1, 2))]

    def file(texts: list[str]) -> list[pa.Array]:
        return [pa.array([filed_grams(split_words(t), window) for t in texts], pa.list_(pa.int64()))]

    hashed = df.select(*identity, F.col(text).alias("_text"))
    filed = map_texts(hashed, "_text", ["_doc", "h1", "h2"], file, "grams array<long>").filter("size(grams) > 0")
    filed = stage(filed.withColumn("_row", F.monotonically_increasing_id()), "grams")
    single = filed.groupBy("h1", "h2", "_doc").agg(F.min("_row").alias("_row"))
    firsts = single.groupBy("h1", "h2").agg(F.min("_doc").alias("_first"))
    copies = single.join(firsts, ["h1", "h2"])
    copies = stage(copies.select("_row", "_doc", "h1", "h2", (F.col("_doc") > F.col("_first")).alias("_copy")), "copies")
    own = filed.select("_row", "grams").join(copies.filter("NOT _copy"), "_row", "left_semi")
    suffixes = own.select("_row", F.explode("grams").alias("gram"))
    # a table of its own, so that adaptive execution can split the join at a hot gram
    several = stage(suffixes.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1").select("gram"), "shared")
    shared = suffixes.join(several, "gram", "left_semi").groupBy("_row").agg(F.collect_set("gram").alias("shared"))
    notes = copies.join(shared, "_row", "left").filter("_copy OR shared IS NOT NULL")
    notes = stage(notes, "shared-grams")

    def windows(batches):
        for batch in slices(batches):
            lists = zip(*(batch.column(c).to_pylist() for c in ("_doc", "_row", "_text", "shared")))
            for doc, row, words, shared in lists:
                starts, both = shared_windows(split_words(words), window, _array(shared))
                if len(starts):
                    n = len(starts)
                    arrays = [both[:, 0], both[:, 1], np.full(n, doc), np.full(n, row), starts.astype(np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x)) for x in arrays], ["w1", "w2", "_doc", "_row", "start"])

    by = ["_doc", "h1", "h2"]
    whole = hashed.join(notes.filter("NOT _copy").select(*by, "_row", "shared"), by)
    cut = whole.select("_doc", "_row", "_text", "shared").mapInArrow(windows, "w1 long, w2 long, _doc long, _row long, start long")
    earliest = cut.groupBy("w1", "w2").agg(F.min(F.struct("_doc", "_row", "start")).alias("e")).select("e._row", "e.start")
    kept = stage(earliest.groupBy("_row").agg(F.collect_list("start").alias("kept")), "earliest")
    carried = [key, *carry]
    head = [f"_{i}" for i in range(len(carried))]

    def remove(batches):
        for batch in slices(batches):
            sizes, removed, texts = [], [], []
            for words, copy, shared, first in zip(*(batch.column(c).to_pylist() for c in ("_text", "_copy", "shared", "kept"))):
                words = split_words(words)
                gone = np.zeros(len(words) + 1, dtype=np.int64)
                if copy:
                    gone[0] = 1
                elif shared is not None:
                    starts, _ = shared_windows(words, window, _array(shared))
                    later = np.setdiff1d(starts, _array(first))
                    np.add.at(gone, later, 1)
                    np.add.at(gone, np.minimum(later + window, len(words)), -1)
                stay = np.cumsum(gone)[: len(words)] == 0
                left = [w for w, s in zip(words, stay.tolist()) if s]
                sizes.append(len(words))
                removed.append(len(words) - len(left))
                texts.append(b" ".join(left).decode())
            made = [pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays([*(batch.column(h) for h in head), *made], [*head, "n_words", "n_removed", "kept"])

    judged = notes.join(kept, "_row", "left").drop("_row")
    rows = df.select(*(F.col(c).alias(h) for c, h in zip(carried, head)), *identity, F.coalesce(text, F.lit("")).alias("_text"))
    rows = rows.join(judged, by, "left")
    rows = rows.select(*head, "_text", F.coalesce("_copy", F.lit(False)).alias("_copy"), "shared", "kept")
    kinds = dict(df.dtypes)
    fields = ", ".join(f"{h} {kinds[c]}" for c, h in zip(carried, head))
    return rows.mapInArrow(remove, f"{fields}, n_words long, n_removed long, kept string").toDF(*carried, "n_words", "n_removed", "kept")


@query("op10_substring_dedup")
def op10_substring_dedup(spark, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
