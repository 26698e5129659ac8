"""Best-first growth against counting everything."""

import re
from collections import Counter, defaultdict

import pytest

from tillwork.llm import collocations as op
from tillwork.llm.queries import QUERIES


def everything(rows, top, least, share=80):
    n, f = Counter(), defaultdict(Counter)
    for lang, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for size in range(1, 5):
                f[lang or "und"].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if 2 <= len(p) <= 4 and a >= least}
        dropped = {
            p[i : i + s]
            for p, wide in candidates.items() for s in range(2, len(p)) for i in range(len(p) - s + 1)
            if 100 * wide >= share * candidates[p[i : i + s]]
        }
        found = []
        for p, a in candidates.items():
            if p not in dropped:
                cut = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
                found.append((-cut[0], -a, " ".join(p).encode(), counts[p[: cut[1]]], counts[p[cut[1] :]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(found)[:top])]
    return Counter(out)


@pytest.mark.parametrize("top, least, reach", [(2000, 2, None), (5, 2, 2), (12, 3, 1), (40, 2, 45)])
def test_against_everything(spark, docs_dir, rows, top, least, reach):
    df = spark.read.parquet(f"{docs_dir}/documents.parquet").filter("length(text) < 5000 OR text IS NULL")
    got = op.collocations(df, top=top, least=least, reach=reach)
    given = [(d[2], d[1]) for d in rows if len(d[1] or "") < 5000]
    assert Counter(map(tuple, got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())) == everything(given, top, least)


def test_small_blocks(spark, docs_dir, rows, monkeypatch):
    monkeypatch.setattr(op, "BLOCK_BYTES", 500)
    monkeypatch.setattr(op, "CHUNK", 64)
    got = op.collocations(spark.read.parquet(f"{docs_dir}/documents.parquet"), top=30, least=20)
    assert Counter(map(tuple, got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())) == everything(
        [(d[2], d[1]) for d in rows], 30, 20
    )


def test_odd_words_and_overlaps(spark):
    text = "a\u2028b c\x85 a\u2028b c\x85 x\x00y\xa0z w x\x00y\xa0z w\nda da da da da, DA  da\tda É é"
    rows = [("xx", text)] * 3 + [(None, text), ("und", text), (None, None)]
    got = op.collocations(spark.createDataFrame(rows, "lang string, text string"), least=2)
    assert Counter(map(tuple, got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())) == everything(rows, 2000, 2)


def test_scores_are_exact_beyond_64_bits(spark):
    big = 2**62
    pairs = spark.createDataFrame([("x", "a b", big - 1)], "lang string, phrase string, f long")
    known = spark.createDataFrame([("x", "a", big), ("x", "b", big + 1)], "lang string, phrase string, f long")
    r = op._score(pairs, known, 2).first()
    assert r.score == 2000000 * (big - 1) // (2 * big + 1) and r.k == 1
    longer = spark.createDataFrame([("x", "a b c", big - 1)], "lang string, phrase string, f long")
    assert op._surviving(pairs, longer, 80).count() == 0


def test_query_without_candidates(spark, docs_dir):
    assert QUERIES["op13_collocations"](spark, docs_dir).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
