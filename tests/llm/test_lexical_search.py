"""Best-position search against scoring every document."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillwork.llm import lexical_search
from tillwork.llm.lexical_search import Impacts, rank_documents, terms_of
from tillwork.llm.queries import QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return [t for t in TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_terms(text):
    text = text.encode("utf-8", "ignore").decode()
    assert [t.decode() for t in terms_of(text)] == plain_terms(text)


def all_scored(docs, items, k=10):
    bags = [(key, Counter(plain_terms(t)), len(plain_terms(t))) for key, t in docs]
    total, words = sum(n > 0 for *_, n in bags), sum(n for *_, n in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    out = []
    for item, text in items:
        found = []
        for key, bag, n in bags:
            if n:
                m = 100 - 75 + (75 * n * total) // words
                score = sum(
                    math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((1000000000 * bag[t]) // (1000 * bag[t] + 8 * m))
                    for t in plain_terms(text) if t in bag
                )
                if score > 0:
                    found.append((-score, key is None, key or 0))
        out += [(item, i + 1, None if none else key, -s) for i, (s, none, key) in enumerate(sorted(found)[:k])]
    return Counter(out)


def test_query(spark, docs_dir, rows, items):
    got = QUERIES["op11_lexical_search"](spark, docs_dir)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert Counter(map(tuple, got.collect())) == all_scored([d[:2] for d in rows], [i[:2] for i in items])


@pytest.mark.parametrize("docs, postings, terms", [(3, 10**6, 5), (10**6, 25, 10**6), (1, 1, 1)])
def test_small_cells_and_blocks(spark, docs_dir, rows, items, monkeypatch, docs, postings, terms):
    monkeypatch.setattr(lexical_search, "CELL_DOCS", docs)
    monkeypatch.setattr(lexical_search, "CELL_POSTINGS", postings)
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", terms)
    items = items if terms > 1 else items[2:3]
    asked = spark.createDataFrame([i[:2] for i in items], "item_id long, text string")
    got = rank_documents(spark.read.parquet(f"{docs_dir}/documents.parquet"), asked, k=4)
    assert Counter(map(tuple, got.collect())) == all_scored([d[:2] for d in rows], [i[:2] for i in items], 4)


def test_large_ids_and_ties(spark):
    docs = [(2**60 + i, "tie word") for i in (5, 3, 1)] + [(None, "tie word"), (2**60 + 3, "other"), (7, "tie word"), (7, "tie word")]
    got = rank_documents(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, "tie tie")], "item_id long, text string"), k=6
    )
    assert [r.doc_id for r in got.orderBy("rank").collect()] == [7, 7, 2**60 + 1, 2**60 + 3, 2**60 + 5, None]


def test_cell_equals_full_scores_and_stops_early():
    rng = np.random.default_rng(3)
    for n, v, k in [(400, 12, 10), (50, 5, 3), (3000, 30, 10)]:
        for spread in (3, 1000):
            pairs = np.unique(rng.integers(0, n * v, n * v // 3))
            doc, term = pairs % n, pairs // n
            impact = rng.integers(1, spread, len(pairs)) * np.where(doc < 12, 1000, 1)
            cell = Impacts(doc, term, impact, n, v)
            terms = rng.permutation(v)[: v // 2 + 1]
            weights = rng.integers(0, 5, len(terms))
            each = np.zeros(n, dtype=np.int64)
            for t, w in zip(terms, weights):
                np.add.at(each, doc[term == t], w * impact[term == t])
            expect = [(int(each[d]), int(d)) for d in np.lexsort((np.arange(n), -each))[:k] if each[d] > 0]
            got, read = cell.best(terms, weights, k, first_read=2)
            assert got == expect
            if n == 3000 and spread == 1000:
                assert read < len(pairs) / 4
