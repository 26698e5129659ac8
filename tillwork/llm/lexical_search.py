"""Ranked lexical search by the Best Position Algorithm over document-partitioned impact lists.

Corpus statistics (documents, words, document frequencies) come first, over all documents. Every task then cuts its
documents into cells of bounded size, sorts a cell's postings into one impact list per term and runs each query on
them: the lists are read from their best position on, every document met is completed by direct accesses to its other
lists, and a list's best position is the end of the run of positions seen from its top. No unseen document of the cell
can pass the sum of the impacts at the best positions; reading stops once that sum is strictly below the k-th score.
A document's score depends on its own row and the statistics alone, so the best k of all cells are the best k.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillwork.llm.bitmaps import bitmap
from tillwork.llm.common import query, slices, table
from tillwork.session import stage

#: Documents and postings of one cell.
CELL_DOCS = 16384
CELL_POSTINGS = 2_000_000
#: Query terms that one pass over the cells holds.
BLOCK_TERMS = 200_000
#: Entries read from each list in the first step; later steps double up to the second number.
FIRST_READ, MOST_READ = 16, 1024
CACHE_SIZE = 1_000_000
#: Letters, digits and all bytes beyond ASCII stay, A-Z in lower case; the rest becomes a blank.
TERM_BYTES = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(TERM_BYTES).split()


def term_hash(term: bytes) -> int:
    return xxhash.xxh3_64_intdigest(term)


class Impacts:
    """One cell: postings as impact lists by term (best first, then by document) and as rows by document."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, docs: int, terms: int):
        order = np.lexsort((doc, -impact, term))
        self.doc, self.term, self.impact = doc[order], term[order], impact[order]
        self.lists = np.searchsorted(self.term, np.arange(terms + 1))
        self.by_doc = np.argsort(self.doc, kind="stable")
        self.rows = np.searchsorted(self.doc[self.by_doc], np.arange(docs + 1))

    def complete(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Direct access: places of all postings of the given documents, and where each document's begin."""
        low, size = self.rows[docs], self.rows[docs + 1] - self.rows[docs]
        begins = np.cumsum(size) - size
        return self.by_doc[np.repeat(low - begins, size) + np.arange(size.sum())], begins

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int, first_read: int = FIRST_READ) -> tuple[list, int]:
        """([(score, document)] of the k best with a score above 0, ties to the smaller document; entries seen)."""
        weight = np.zeros(len(self.lists) - 1, dtype=np.int64)
        weight[terms] = weights
        runs = [(t, self.lists[t], self.lists[t + 1]) for t in terms.tolist() if weight[t] > 0]
        at = {t: low for t, low, _ in runs}  # best position: all entries before it are seen
        seen, met = np.zeros(len(self.doc), dtype=bool), np.zeros(len(self.rows) - 1, dtype=bool)
        scores, docs, step = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), first_read
        while True:
            read = [self.doc[at[t] : min(at[t] + step, high)] for t, _, high in runs if at[t] < high]
            if not read:
                break
            new = np.unique(np.concatenate(read))
            new = new[~met[new]]
            met[new] = True
            places, begins = self.complete(new)
            seen[places] = True
            gained = np.add.reduceat(weight[self.term[places]] * self.impact[places], begins)
            scores, docs = np.concatenate([scores, gained]), np.concatenate([docs, new])
            top = np.lexsort((docs, -scores))[:k]
            scores, docs = scores[top], docs[top]
            bound = 0
            for t, _, high in runs:
                if at[t] < high:
                    rest = seen[at[t] : high]
                    stop = int(rest.argmin())
                    at[t] = high if rest[stop] else at[t] + stop
                    if at[t] < high:  # a list that is seen whole holds no unseen document
                        bound += int(weight[t]) * int(self.impact[at[t] - 1])
            if len(scores) == k and bound < scores[-1]:
                break
            step = min(2 * step, MOST_READ)
        return [(s, d) for s, d in zip(scores.tolist(), docs.tolist()) if s > 0], int(seen.sum())


def _term_lists(df: DataFrame, text: str, keep: list[str], wanted=None) -> DataFrame:
    """(keep, n, terms, counts): number of terms with repeats, and the distinct terms that `wanted` may hold."""
    kinds = dict(df.dtypes)

    def run(batches):
        known: dict[bytes, bool] = {}
        for batch in slices(batches):
            sizes, terms, counts = [], [], []
            for text in batch.column("_text").to_pylist():
                found = terms_of(text)
                sizes.append(len(found))
                tally = Counter(found)
                if wanted is not None:
                    new = [t for t in tally if t not in known]
                    if new:
                        if len(known) > CACHE_SIZE:
                            known, new = {}, list(tally)
                        hashes = np.fromiter(map(term_hash, new), dtype=np.uint64, count=len(new))
                        known.update(zip(new, wanted.holds(hashes).tolist()))
                    tally = {t: c for t, c in tally.items() if known[t]}
                terms.append(list(tally))
                counts.append(list(tally.values()))
            lists = [pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.string())), pa.array(counts, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *lists], [*keep, "n", "terms", "counts"])

    rows = df.select(*keep, F.coalesce(text, F.lit("")).alias("_text"))
    head = "".join(f"`{c}` {kinds[c]}, " for c in keep)
    return rows.mapInArrow(run, f"{head}n long, terms array<string>, counts array<long>")


def _hashed(terms: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            hashes = [term_hash(t.encode()) for t in batch.column("term").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.array(hashes, dtype=np.uint64).view(np.int64))], ["h"])

    return terms.select("term").mapInArrow(run, "h long")


def _cells(postings: DataFrame, kind: str, queries, vocabulary: dict[str, int], total: int, words: int, k: int) -> DataFrame:
    """(query, key, score): the best k of every cell for every query (number, term ids, weights)."""

    def search(tables):
        cell = pa.concat_tables(tables)
        cell = cell.take(pc.sort_indices(cell, sort_keys=[("_key", "ascending")]))  # null keys last
        known, flat, sizes = vocabulary, cell.column("terms").to_pylist(), cell.column("n").to_pylist()
        ids = np.array([known.get(t, -1) for terms in flat for t in terms], dtype=np.int64)
        doc = np.repeat(np.arange(len(flat)), [len(terms) for terms in flat])
        # whole numbers of any size: 75 * n * N may pass 64 bits
        mean = np.array([25 + 75 * n * total // words for n in sizes], dtype=np.int64)
        tf = np.array([c for counts in cell.column("counts").to_pylist() for c in counts], dtype=np.int64)
        impact = 1_000_000_000 * tf // (1000 * tf + 8 * mean[doc])
        wanted = ids >= 0
        lists = Impacts(doc[wanted], ids[wanted], impact[wanted], len(flat), len(known))
        for number, terms, weights in queries:
            best, _ = lists.best(terms, weights, k)
            if best:
                score, row = (pa.array(x, pa.int64()) for x in zip(*best))
                key = cell.column("_key").take(row).combine_chunks()
                yield pa.RecordBatch.from_arrays([pa.array([number] * len(best), pa.int64()), key, score], ["query", "_key", "score"])

    def run(batches):
        held, docs, entries = [], 0, 0
        for batch in batches:
            rest = pa.Table.from_batches([batch])
            lengths = pc.list_value_length(rest.column("terms")).to_numpy().cumsum()
            at = 0
            while at < rest.num_rows:
                before = int(lengths[at - 1]) if at else 0
                fit = int(np.searchsorted(lengths, before + CELL_POSTINGS - entries, side="right"))
                take = min(max(fit, at + (docs == 0)), at + CELL_DOCS - docs, rest.num_rows) - at
                if take:
                    held.append(rest.slice(at, take))
                    docs, at = docs + take, at + take
                    entries += int(lengths[at - 1]) - before
                if at < rest.num_rows:
                    yield from search(held)
                    held, docs, entries = [], 0, 0
        if held:
            yield from search(held)

    return postings.mapInArrow(run, f"query long, _key {kind}, score long")


def rank_documents(
    docs: DataFrame, items: DataFrame, k: int = 10, key: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(item, rank, key, score): the k best documents of every item, scores above 0 only, ties to the smaller key.

    Terms, weights and scores follow the contract of `op11`. Every row of `items` is a query of its own and every row
    of `docs` a document of its own, so repeated rows are ranked each; a null key sorts last. Null and empty texts
    have no terms: such items find nothing, such documents are never found and do not count. A term of an item counts
    as often as it stands there. Queries are held by tasks in blocks of about BLOCK_TERMS terms.
    """
    spark = docs.sparkSession
    asked = items.select(F.monotonically_increasing_id().alias("query"), F.col(item).alias("_item"), F.col(item_text).alias("_text"))
    asked = stage(_term_lists(asked, "_text", ["query", "_item"]), "queries")
    pairs = asked.select("query", F.explode(F.arrays_zip("terms", "counts")).alias("t")).select("query", "t.terms", "t.counts")
    distinct = pairs.select(F.col("terms").alias("term")).distinct()
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    postings = stage(_term_lists(rows, "_text", ["_key"], bitmap(_hashed(distinct))), "postings")
    total, words = postings.filter("n > 0").agg(F.count("*"), F.sum("n")).first()
    found = postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weighed = stage(pairs.join(found.withColumnRenamed("term", "terms"), "terms"), "query-terms")
    blocks = max(1, -(-weighed.count() // BLOCK_TERMS))
    kind, parts = dict(docs.dtypes)[key], []
    for block in range(blocks):
        mine = weighed.filter(F.pmod(F.xxhash64("query"), F.lit(blocks)) == block).orderBy("query", "terms").collect()
        vocabulary, queries = {}, {}
        for r in mine:
            weight = r.counts * math.floor(1000 * math.log((2 * total + 2) / (2 * r.df + 1)))
            ids, weights = queries.setdefault(r.query, ([], []))
            ids.append(vocabulary.setdefault(r.terms, len(vocabulary)))
            weights.append(weight)
        listed = [(q, np.array(ids), np.array(weights)) for q, (ids, weights) in queries.items()]
        parts.append(stage(_cells(postings, kind, listed, vocabulary, total, words or 1, k), "cell-ranks"))
    best = parts[0]
    for part in parts[1:]:
        best = best.unionByName(part)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("_key").asc_nulls_last())
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(asked.select("query", "_item"), "query").select(
        F.col("_item").alias(item), "rank", F.col("_key").alias(key), "score"
    )


ORACLE = r"""
WITH terms AS (
  SELECT doc_id, rowid AS r, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT doc_id, text, row_number() OVER () AS rowid FROM documents)),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
wanted AS (SELECT item_id, term, count(*) AS times FROM asked GROUP BY ALL),
lengths AS (SELECT r, doc_id, count(*) AS n FROM terms GROUP BY ALL),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM lengths),
counts AS (SELECT r, term, count(*) AS tf FROM terms WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * max(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM counts, total GROUP BY term),
means AS (SELECT r, doc_id, 25 + (75 * n * docs) // words AS m FROM lengths, total),
scores AS (
  SELECT item_id, r, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM wanted JOIN weights USING (term) JOIN counts USING (term) JOIN means USING (r) GROUP BY ALL),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


@query("op11_lexical_search", ORACLE)
def op11_lexical_search(spark, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
