import random

import pytest

ITEMS = "item_id long, text string, rank int, score long, query long"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, _row long, score string, words string, count int"


def _row(i, text, lang="en"):
    return (i, text, lang, "src", None, 1, "x", "y", 2)


@pytest.fixture(scope="session")
def rows():
    """Nulls, empty and long texts, copies, near copies, shared passages and a repeated row."""
    rng = random.Random(1)
    words = [f"{a}{b}" for a in ("ab", "Éc", "of", "the", "x9", "Q") for b in ("", "le", "ng", "né", "ous", "wh")]

    def prose(n):
        return "".join(rng.choice(words) + rng.choice([" ", " ", "\n", " \t", ", "]) for _ in range(n))

    passage, copy = prose(45), prose(120)
    texts = [None, "", "   \n", "1234 !!", "a", "cc by cc by x CC-BY", "general public license\nall rights reserved", "一二三 \U0001f600 é"]
    texts += [prose(rng.randint(1, 300)) for _ in range(40)] + [copy] * 5 + [copy + " tail", "head " + copy]
    texts += [prose(30) + passage + prose(30) for _ in range(6)] + [passage + " " + passage]
    texts += ["w " * 5000, "z" * 30000, prose(9000), "same words here " * 60, "it's we'll  <|endoftext|> x\u00a0y \u2003z"]
    texts += ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software\nfoo bar"]
    out = [_row(3 * i + 1, t, ("en", "fr", None)[i % 3]) for i, t in enumerate(texts)]
    return out + [out[20], _row(None, copy), _row(None, "null id text")]


@pytest.fixture(scope="session")
def items(rows):
    """Parts of texts, repeated terms, a repeated row, texts without terms and a null id."""
    texts = [rows[20][1][:200], rows[30][1], "the the ofwh THE", "nothing_of_this zzzzqqq", None, "", "!!", rows[8 + 40][1][:90]]
    out = [(2**60 + 2 * i + 1, t, 1, 2, 3) for i, t in enumerate(texts)]
    return out + [out[2], (None, "ab abng x9", None, None, None)]


@pytest.fixture(scope="session")
def docs_dir(spark, rows, items, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("docs"))
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, ITEMS).write.parquet(f"{folder}/benchmark.parquet")
    return folder


@pytest.fixture(scope="session")
def empty_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("none"))
    spark.createDataFrame([], DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], ITEMS).write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([], "page_id long, url string").write.parquet(f"{folder}/pages.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>").write.parquet(f"{folder}/embeddings.parquet")
    return folder
