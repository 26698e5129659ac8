"""Phrase collocations by best-first growth: counted prefixes bound the scores of everything that extends them.

Words come first, then pairs of frequent words, since a phrase is never more frequent than a part of it; both are
counted by hash before the frequent ones are counted as texts. From there on a prefix is grown only if its bound reaches
the language's threshold, best bounds first: with `a` the prefix's count and `l` that of its first word, the cut after
that word gives every extension at most 2000000 * a / (l + a). The threshold starts at a generous score of each language
and is lowered, round by round, in the languages where fewer than the wanted number of phrases survive at or above it; a
round counts only what lies between its threshold and the last.

Counting passes read the texts again. What a pass may skip is told by Bloom filters of bounded size; what it counts, it
counts exactly and under the phrase itself, so a stranger let through costs time and changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillwork.llm.bitmaps import Bitmap, bitmap, mix
from tillwork.llm.common import query, slices, table
from tillwork.session import stage

#: Stands between pieces of text; no UTF-8 text holds this byte.
BREAK = b"\xff"
#: A-Z in lower case, marks and line ends as BREAK, tabs as blanks.
PIECE_BYTES = bytes(255 if chr(b) in ".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256)).lower()
#: Text bytes that are cut into words together.
BLOCK_BYTES = 4_000_000
#: Bytes whose prefix sums are taken together, and the longest word that is hashed by them.
CHUNK, LONG_WORD = 1 << 19, 512
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


@lru_cache(maxsize=1)
def _powers() -> list[tuple[np.ndarray, np.ndarray]]:
    """Powers of each base and of its inverse, modulo 2**64."""
    out = []
    for base in _BASES:
        pair = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(CHUNK + 1, b, dtype=np.uint64)
            steps[0] = 1
            pair.append(np.cumprod(steps))
        out.append(tuple(pair))
    return out


class Words:
    """Words of a block of bytes: where they start and end, their piece, and two 64-bit hashes each.

    All words are hashed at once: a polynomial over the bytes between two prefix sums. Long words, where such
    polynomials are weak, get a hash of their own.
    """

    def __init__(self, raw: bytes):
        self.raw, data = raw, np.frombuffer(raw, dtype=np.uint8)
        broken = data == BREAK[0]
        inside = np.empty(len(data) + 2, dtype=np.int8)
        inside[0] = inside[-1] = 0
        inside[1:-1] = ~(broken | (data == 32))
        steps = np.diff(inside)
        self.starts, self.ends = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
        self.pieces = np.cumsum(broken, dtype=np.int64)[self.starts]
        self.hashes = self._hashed(data)

    def _hashed(self, data: np.ndarray) -> list[np.ndarray]:
        starts, ends, lengths = self.starts, self.ends, (self.ends - self.starts).astype(np.uint64)
        out, at = [np.empty(len(starts), dtype=np.uint64) for _ in _BASES], 0
        while at < len(starts):
            stop = max(int(np.searchsorted(ends, starts[at] + CHUNK, side="right")), at + 1)
            low = starts[at]
            size = int(min(ends[stop - 1] - low, CHUNK))
            x, s, e = data[low : low + size].astype(np.uint64) + np.uint64(1), starts[at:stop] - low, np.minimum(ends[at:stop] - low, size)
            for hashes, (powers, inverse) in zip(out, _powers()):
                sums = np.zeros(size + 1, dtype=np.uint64)
                np.cumsum(x * powers[:size], out=sums[1:])
                hashes[at:stop] = mix((sums[e] - sums[s]) * inverse[s] + lengths[at:stop])
            at = stop
        for i in np.flatnonzero(lengths > LONG_WORD).tolist():
            both = xxhash.xxh3_128_intdigest(self.raw[starts[i] : ends[i]])
            out[0][i], out[1][i] = both >> 64, both & (1 << 64) - 1
        return out

    def whole(self, n: int) -> np.ndarray:
        """For every run of n words, whether it lies in one piece."""
        return self.pieces[: max(0, len(self.pieces) - n + 1)] == self.pieces[n - 1 :]

    def phrase(self, start: int, n: int) -> bytes:
        whole = self.raw[self.starts[start] : self.ends[start + n - 1]]
        return whole if n == 1 else b" ".join(whole.split())  # only blanks are left of all ASCII white space


def gram_hashes(word_hashes: np.ndarray, n: int, lang: str) -> np.ndarray:
    """Hash of every run of n words under its language."""
    size = max(0, len(word_hashes) - n + 1)
    out = np.full(size, xxhash.xxh3_64_intdigest(lang.encode(), n), dtype=np.uint64)
    for j in range(n):
        out = out * np.uint64(_BASES[0]) + word_hashes[j : j + size]
    return mix(out)


@dataclass
class Rule:
    """The run of `width` words at `offset` of a phrase must be in `members`."""

    offset: int
    width: int
    members: Bitmap


def _selected(words: Words, n: int, lang: str, every: Sequence[Rule], some: Sequence[Rule]) -> np.ndarray:
    """Starts of the runs of n words inside a piece that keep every rule of `every` and, if there are any, one of `some`."""
    fits = words.whole(n)
    size, tested = len(fits), {}

    def holds(rule: Rule) -> np.ndarray:
        if (rule.width, id(rule.members)) not in tested:
            tested[rule.width, id(rule.members)] = rule.members.holds(gram_hashes(words.hashes[0], rule.width, lang))
        return tested[rule.width, id(rule.members)][rule.offset : rule.offset + size]

    for rule in every:
        fits = fits & holds(rule)
    if some:
        fits = fits & np.logical_or.reduce([holds(rule) for rule in some])
    return np.flatnonzero(fits)


def _tally(words: Words, starts: np.ndarray, n: int, lang: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a start of every distinct run of n words, its count, its hash); runs are told apart by 128 bits of hash."""
    one, two = (gram_hashes(h, n, lang)[starts] for h in words.hashes)
    order = np.argsort(one)
    same = one[order][1:] == one[order][:-1]
    if (two[order][1:] != two[order][:-1])[same].any():  # equal in the first half only
        order = np.lexsort((two, one))
        same = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
    first = np.flatnonzero(np.concatenate([[True], ~same])) if len(order) else np.empty(0, dtype=np.int64)
    return starts[order[first]], np.diff(np.append(first, len(order))), one[order[first]]


def _blocks(batch: pa.RecordBatch):
    """(lang, joined bytes) of about BLOCK_BYTES at most, texts of one language together."""
    held: dict = {}
    for part in slices([batch]):
        for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
            parts = held.setdefault(lang, [0, []])
            raw = text.encode().translate(PIECE_BYTES)
            parts[0] += len(raw)
            parts[1].append(raw)
            if parts[0] > BLOCK_BYTES:
                yield lang, BREAK.join(held.pop(lang)[1])
    for lang, (_, raws) in held.items():
        yield lang, BREAK.join(raws)


def _words(batches):
    """(lang, words) of every block."""
    for batch in batches:
        for lang, raw in _blocks(batch):
            yield lang, Words(raw)


def frequent_hashes(docs: DataFrame, n: int, every: list[Rule], least: int) -> Bitmap:
    """Filter of the phrases of n words that keep the rules and stand at `least` times in their language.

    Counted by hash: numbers in place of texts, most of which are rare. What shares a hash may get in too.
    """

    def run(batches):
        for lang, words in _words(batches):
            _, counts, found = _tally(words, _selected(words, n, lang, every, []), n, lang)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(counts.astype(np.int64))], ["h", "f"])

    counted = docs.mapInArrow(run, "h long, f long").groupBy("h").agg(F.sum("f").alias("f"))
    return bitmap(stage(counted.filter(F.col("f") >= least).select("h"), "frequent-hashes"))


@dataclass
class Wanted:
    """Phrases of n words that keep all rules of `every` and, if there are any, one of `some`."""

    n: int
    every: Sequence[Rule] = ()
    some: Sequence[Rule] = ()


def count_phrases(docs: DataFrame, *wanted: Wanted, least: int = 1) -> DataFrame:
    """(lang, phrase, f) of the wanted phrases that stand at `least` times; the phrase `` is all words of the language."""

    def run(batches):
        for lang, words in _words(batches):
            texts, counts = [""], [len(words.starts)]
            for w in wanted:
                starts, found, _ = _tally(words, _selected(words, w.n, lang, w.every, w.some), w.n, lang)
                texts += [words.phrase(s, w.n) for s in starts.tolist()]
                counts += found.tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(texts), pa.string()), pa.array(texts, pa.string()), pa.array(counts, pa.int64())], ["lang", "phrase", "f"]
            )

    counted = docs.mapInArrow(run, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    return counted.filter((F.col("f") >= least) | (F.col("phrase") == ""))


def members(phrases: DataFrame) -> Bitmap:
    """Filter of a table (lang, phrase) of phrases of one length."""

    def run(batches):
        for batch in batches:
            held: dict = {}
            for lang, phrase in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist()):
                held.setdefault((lang, phrase.count(" ") + 1), []).append(phrase.encode())
            for (lang, n), phrases in held.items():
                hashes = gram_hashes(Words(BREAK.join(phrases)).hashes[0], n, lang)[::n]
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64))], ["h"])

    return bitmap(stage(phrases.select("lang", "phrase").mapInArrow(run, "h long"), "members"))


def _ratio(a: str, left: str, right: str) -> Column:
    """floor(2000000 * a / (left + right)), exact: the product and the sum may pass 64 bits."""
    a, left, right = (f"cast({x} AS decimal(19, 0))" for x in (a, left, right))
    return F.expr(f"cast(2000000 AS decimal(7, 0)) * {a} div ({left} + {right})")


def _score(phrases: DataFrame, known: DataFrame, n: int) -> DataFrame:
    """Adds the lowest-scoring cut (score, k, l, r), the bound of all extensions, and parts that are not in `known`.

    A part that was not counted is at least as frequent as the phrase, so the phrase's own count bounds the score.
    """
    cuts = F.expr(
        f"transform(sequence(1, {n - 1}), k -> struct(cast(k AS int) AS k, substring_index(phrase, ' ', k) AS head,"
        f" substring_index(phrase, ' ', k - {n}) AS tail))"
    )
    rows = phrases.select("lang", "phrase", "f", F.explode(cuts).alias("c")).select("lang", "phrase", "f", "c.*")
    heads = known.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = known.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    rows = rows.join(heads, ["lang", "head"], "left").join(tails, ["lang", "tail"], "left")
    rows = rows.withColumn("head", F.when(F.col("l").isNull(), F.col("head"))).withColumn("tail", F.when(F.col("r").isNull(), F.col("tail")))
    rows = rows.withColumn("l", F.coalesce("l", "f")).withColumn("r", F.coalesce("r", "f"))
    rows = rows.withColumn("score", _ratio("f", "l", "r"))
    best = rows.groupBy("lang", "phrase", "f").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"),
        F.min(F.when(F.col("k") == 1, F.col("l"))).alias("first"),
        F.array_compact(F.flatten(F.collect_list(F.array("head", "tail")))).alias("missing"),
    )
    return best.select("lang", "phrase", "f", "cut.*", _ratio("f", "first", "f").alias("bound"), "missing")


def _band(phrases: DataFrame, by: str, bands: DataFrame) -> DataFrame:
    """Phrases whose `by` lies at or above their language's threshold, and below that of the last round."""
    return phrases.join(bands, "lang").filter(f"{by} >= low AND {by} < high").drop("low", "high", "stored")


def _surviving(phrases: DataFrame, longer: DataFrame, share: int) -> DataFrame:
    """Phrases without a phrase of one word more around them that is at least `share` percent as frequent.

    Longer ones need no look: the part of theirs with one word more is at least as frequent as they are.
    """
    blanks = "length(phrase) - length(replace(phrase, ' ', ''))"
    inner = F.expr(f"array(substring_index(phrase, ' ', -({blanks})), substring_index(phrase, ' ', {blanks}))")
    around = longer.select("lang", F.explode(inner).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("wide"))
    dropped = F.expr(f"cast(100 AS decimal(3, 0)) * cast(wide AS decimal(19, 0)) >= cast({share} AS decimal(3, 0)) * cast(f AS decimal(19, 0))")
    return phrases.join(around, ["lang", "phrase"], "left").filter(F.coalesce(~dropped, F.lit(True))).drop("wide")


RESULT = ["lang", "phrase", "f", "score", "k", "l", "r"]


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", top: int = 2000, least: int = 30, share: int = 80, reach: int | None = None
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's `top` phrases of two to four words.

    Null languages are `und`, null and empty texts have no words, every row counts, repeated ones each. Ties are ranked
    by count and then by phrase in byte order. Phrases with a count under `least` are no candidates; those inside a
    longer candidate with at least `share` percent of their count are dropped. `reach` is the place, among the pairs'
    scores of a language, of the first threshold; it changes the number of rounds, not the result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(lang, F.lit("und")).alias("lang"), F.coalesce(text, F.lit("")).alias("text"))
    single = frequent_hashes(rows, 1, [], least)
    frequent = frequent_hashes(rows, 2, [Rule(0, 1, single), Rule(1, 1, single)], least)
    counted = stage(count_phrases(rows, Wanted(1, [Rule(0, 1, single)]), Wanted(2, [Rule(0, 2, frequent)]), least=least), "counted")
    totals = counted.filter("phrase = ''").select("lang", F.col("f").alias("n"))
    is_pair = F.col("phrase").contains(" ")
    words = counted.filter((F.col("phrase") != "") & ~is_pair)
    pairs = stage(_score(counted.filter(is_pair), words, 2).drop("missing"), "scored-pairs")
    triples = spark.createDataFrame([], "lang string, phrase string, f long")
    quads = extra = triples
    bands, reach = None, reach or 2 * top
    while True:
        place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score")))
        best = pairs.select("lang", "score").withColumn("place", place).filter(F.col("place") <= reach)
        next_low = best.groupBy("lang").agg(F.when(F.max("place") == reach, F.min("score")).otherwise(F.lit(0).cast("long")).alias("next"))
        if bands is None:
            bands = next_low.select("lang", F.col("next").alias("low"), F.lit(2**62).alias("high"))
        else:  # a settled language gets an empty band
            low = F.when(F.col("settled"), F.col("low")).otherwise(F.col("next"))
            bands = bands.join(next_low, "lang").select("lang", low.alias("low"), F.col("low").alias("high"))
        bands = stage(bands, "thresholds")

        grown, judged = members(_band(pairs, "bound", bands)), members(_band(pairs, "score", bands))
        apriori = [Rule(0, 2, frequent), Rule(1, 2, frequent)]
        found = count_phrases(rows, Wanted(3, apriori, [Rule(0, 2, grown), Rule(1, 2, judged)]), least=least)
        triples = stage(triples.unionByName(found.filter("phrase <> ''")).dropDuplicates(["lang", "phrase"]), "triples")
        known = words.unionByName(pairs.select("lang", "phrase", "f"))
        scored = stage(_score(triples, known, 3).drop("missing"), "scored-triples")

        grown, judged = members(_band(scored, "bound", bands)), members(_band(scored, "score", bands))
        found = count_phrases(rows, Wanted(4, [*apriori, Rule(2, 2, frequent)], [Rule(0, 3, grown), Rule(1, 3, judged)]), least=least)
        quads = stage(quads.unionByName(found.filter("phrase <> ''")).dropDuplicates(["lang", "phrase"]), "quads")
        known = known.unionByName(triples).unionByName(extra)
        low = bands.select("lang", "low")
        hopeful = _score(quads, known, 4).join(low, "lang").filter("score >= low")
        missing = stage(hopeful.select("lang", F.explode("missing").alias("phrase")).distinct(), "missing-parts")
        if not missing.isEmpty():
            parts = count_phrases(rows, Wanted(3, [Rule(0, 3, members(missing))]), least=least).filter("phrase <> ''").join(triples, ["lang", "phrase"], "left_anti")
            extra = stage(extra.unionByName(parts).dropDuplicates(["lang", "phrase"]), "extra-parts")
            known = words.unionByName(pairs.select("lang", "phrase", "f")).unionByName(triples).unionByName(extra)
        kept = _surviving(pairs, triples, share).select(RESULT).unionByName(_surviving(scored, quads, share).select(RESULT))
        kept = kept.unionByName(_score(quads, known, 4).filter("size(missing) = 0").select(RESULT))
        kept = stage(kept.join(low, "lang").filter("score >= low").drop("low"), "surviving")
        counts = kept.groupBy("lang").agg(F.count("*").alias("kept"))
        bands = bands.join(counts, "lang", "left").withColumn("settled", F.expr("low = 0 OR coalesce(kept, 0) >= " + str(top)))
        bands = stage(bands.select("lang", "low", "settled"), "settled")
        if bands.filter("NOT settled").isEmpty():
            break
        reach *= 4
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("f"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", F.col("f").alias("a"), "l", "r", "n", "score")


ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY lang),
grams AS (
  SELECT lang, size, unnest(list_transform(range(1, greatest(len(w) - size + 2, 1)::BIGINT), lambda i: array_to_string(w[i : i + size - 1], ' '))) AS phrase
  FROM worded, (SELECT unnest([1, 2, 3, 4]) AS size)),
f AS (SELECT lang, size, phrase, count(*) AS a FROM grams GROUP BY ALL),
candidates AS (SELECT lang, size, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND a >= 30),
cuts AS (
  SELECT lang, phrase, a, size, k, array_to_string(w[1 : k], ' ') AS head, array_to_string(w[k + 1 : size], ' ') AS tail
  FROM candidates, (SELECT unnest([1, 2, 3]) AS k) WHERE k < size),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.size, k, x.a AS l, y.a AS r, ((2000000::HUGEINT * c.a) // (x.a::HUGEINT + y.a))::BIGINT AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.head JOIN f y ON y.lang = c.lang AND y.phrase = c.tail),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
parts AS (
  SELECT lang, a AS wide, array_to_string(w[i : i + s - 1], ' ') AS phrase
  FROM candidates, (SELECT unnest([1, 2, 3]) AS i), (SELECT unnest([2, 3]) AS s) WHERE s < size AND i + s - 1 <= size),
kept AS (
  SELECT * FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM parts p WHERE p.lang = b.lang AND p.phrase = b.phrase AND 100::HUGEINT * p.wide >= 80::HUGEINT * b.a)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


@query("op13_collocations", ORACLE)
def op13_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("text", "lang"))
