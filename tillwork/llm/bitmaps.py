"""Bloom filters of bounded size: what they drop is not in the set, what they let through is checked exactly later."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Largest filter, 2**28 bits = 32 MB; sets beyond some 30 million members let more strangers through, and lose none.
MOST_BITS = 28


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit values: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Bitmap:
    """Broadcast bits, two places per member."""

    def __init__(self, shared, bits: int):
        self.shared, self.bits = shared, bits

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        words = self.shared.value
        return _bit(words, hashes, self.bits) & _bit(words, hashes >> np.uint64(32), self.bits)


def _bit(words: np.ndarray, h: np.ndarray, bits: int) -> np.ndarray:
    at = h & np.uint64((1 << bits) - 1)
    return (words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def bitmap(hashed: DataFrame) -> Bitmap:
    """Filter of the long column `h`, whose values are mixed 64-bit hashes; about nine bits a member up to MOST_BITS.

    The words of the filter are put together by a grouped OR, so at most 2**MOST_BITS / 64 rows reach the driver.
    """
    spark = hashed.sparkSession
    bits = min(MOST_BITS, max(12, (9 * hashed.count()).bit_length()))
    mask = (1 << bits) - 1
    places = hashed.select(F.explode(F.expr(f"array(h & {mask}L, shiftrightunsigned(h, 32) & {mask}L)")).alias("at"))
    words = places.groupBy(F.expr("shiftrightunsigned(at, 6)").alias("slot")).agg(
        F.expr("bit_or(shiftleft(1L, cast(at & 63 AS int)))").alias("word")
    )
    found, out = words.toArrow(), np.zeros((1 << bits) >> 6, dtype=np.uint64)
    out[found.column("slot").to_numpy()] = found.column("word").to_numpy().astype(np.int64).view(np.uint64)
    return Bitmap(spark.sparkContext.broadcast(out), bits)
