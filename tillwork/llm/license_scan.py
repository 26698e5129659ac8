"""License phrases and license templates found in windows of words by an exact set-similarity join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.llm.common import lower_ascii, query, table
from tillwork.session import stage

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN_WORDS = WORD.replace("^", "", 1)
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
TEMPLATES = {
    "apache": "licensed under the apache license version 2 0",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted",
    "cc-by": "this work is licensed under a creative commons attribution license",
    "cc-by-sa": "this work is licensed under a creative commons attribution sharealike license",
    "gpl": "you can redistribute it and or modify it under the terms of the gnu general public license",
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software",
    "public-domain": "this work has been released into the public domain",
}


def words_of(lowered: Column) -> Column:
    """Words of a lower-cased text; splitting costs a small part of what extracting every match does."""
    return F.array_remove(F.split(lowered, BETWEEN_WORDS), "")


def _starts(words: Column, phrase: str) -> Column:
    """Word positions at which a phrase stands."""
    parts = phrase.split()

    def here(i):
        test = F.lit(True)
        for k, part in enumerate(parts):
            test = test & (F.get(words, i + k) == part)
        return test

    places = F.filter(F.sequence(F.lit(0), F.size(words)), lambda i: F.coalesce(here(i), F.lit(False)))
    return F.when(F.array_contains(words, parts[-1]) & F.array_contains(words, parts[0]), places).otherwise(
        F.array().cast("array<int>")
    )


def phrase_places(words: Column, phrases: dict[str, str] = PHRASES) -> Column:
    """Array of (start, label), one for every place of every phrase."""

    def labelled(phrase, label):
        return F.transform(
            _starts(words, phrase), lambda i: F.struct(i.cast("long").alias("start"), F.lit(label).alias("label"))
        )

    return F.concat(*(labelled(p, label) for p, label in phrases.items()))


def _token_sets(templates: dict[str, str]) -> tuple[dict[str, set[str]], list[str]]:
    """Distinct words of each template that has any, and the words of all of them."""
    sets = {label: set(t.split()) for label, t in templates.items() if t.split()}
    return sets, sorted(set().union(*sets.values()))


def _needed(words: set[str], threshold: float) -> int:
    """Words of a template that must be there."""
    return max(1, next(k for k in range(len(words) + 1) if k >= threshold * len(words) - 1e-9))


def _telling(sets: dict[str, set[str]], threshold: float) -> list[str]:
    """The longest words of each template, so many that whoever holds enough of the template holds one of them."""
    return sorted({w for s in sets.values() for w in sorted(s, key=lambda w: (-len(w), w))[: len(s) - _needed(s, threshold) + 1]})


def _spans(templates: dict[str, str]) -> dict[str, int]:
    """Length in words of the window in which a template is looked for: twice its own."""
    return {label: 2 * len(t.split()) for label, t in templates.items() if t.split()}


def _best_window(words: Column, template: str, span: int) -> Column:
    """The most distinct template words that any `span` words in a row hold."""
    known = F.array(*map(F.lit, sorted(set(template.split()))))
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(words) - F.lit(span - 1)))
    return F.array_max(F.transform(starts, lambda i: F.size(F.array_intersect(F.slice(words, i, span), known))))


def _shortest(sets: dict[str, set[str]], threshold: float) -> int:
    """Template words that a block must hold at least to reach the threshold of any template."""
    return min((max(1, int(threshold * len(s))) for s in sets.values()), default=1)


def containment_join(
    blocks: DataFrame, templates: dict[str, str], threshold: float = 0.8, keys: tuple[str, ...] = ("_row", "_block")
) -> DataFrame:
    """(keys, label, score) of every block that holds at least `threshold` of a template's distinct words.

    `blocks` has the keys and an array `words`. Words are ordered by how many blocks of the whole input hold them,
    rarest first. A template is filed under its prefix: a block that misses all of it cannot reach the threshold.
    Blocks keep only words of the templates (others cannot match), in the global order, and meet the index in an
    equality join; the length filter and the positional filter drop hopeless pairs before the exact check. The index
    has one row per template and prefix word, so it is broadcast, and hot words are not shuffled.
    """
    spark = blocks.sparkSession
    sets, vocabulary = _token_sets(templates)
    if not sets:
        return blocks.select(*keys, F.lit("").alias("label"), F.lit(0.0).alias("score")).limit(0)
    inside = blocks.withColumn("_set", F.array_intersect("words", F.array(*map(F.lit, vocabulary))))
    held = inside.select(F.explode("_set").alias("_token")).groupBy("_token").count()
    counts = {r["_token"]: r["count"] for r in held.collect()}  # at most one row per template word
    order = sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))
    place = {w: i for i, w in enumerate(order)}
    index = []
    for label, words in sets.items():
        ranked = sorted(words, key=place.__getitem__)
        need = _needed(words, threshold)
        index += [(w, label, i, len(ranked), need, ranked) for i, w in enumerate(ranked[: len(ranked) - need + 1])]
    index = spark.createDataFrame(
        index, "_token string, label string, _at int, _size int, _need int, _template array<string>"
    )
    shortest = _shortest(sets, threshold)
    pairs = (
        inside.withColumn("_set", F.array_intersect(F.array(*map(F.lit, order)), "words"))
        .filter(F.size("_set") >= shortest)
        .select(*keys, "_set", F.posexplode("_set").alias("_pos", "_token"))
        .join(F.broadcast(index), "_token")
        .filter("size(_set) >= _need AND least(_size - _at, size(_set) - _pos) >= _need - least(_at, _pos)")
    )
    shared = F.size(F.array_intersect("_set", "_template"))
    return (
        pairs.withColumn("_shared", shared)
        .filter("_shared >= _need")
        .groupBy(*keys, "label")
        .agg(F.max(F.col("_shared") / F.col("_size")).alias("score"))
    )


def scan_licenses(
    df: DataFrame, text: str = "text", phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES,
    threshold: float = 0.8, keep: tuple[str, ...] | None = None,
) -> DataFrame:
    """Adds n_words, places, template_labels and score to every row; the columns `keep` stay (all, if not given).

    A template is looked for in every window of twice its number of words, wherever lines break. Blocks are twice the
    longest window and start a window apart, so each window lies in one of them; blocks that hold enough of a template
    are found by the join, and their windows are then counted exactly. Null and empty texts have no words, no places
    and score 0. Rows are told apart by a row number, so repeated rows and repeated ids stay apart. Score is 1 where a
    phrase stands, else the best template containment of a window at or above the threshold, else 0. Words are cut
    once: that pass writes a table of word counts, places and the blocks that hold a long word of a template and enough
    template words for any; all else reads that table. The global word order counts these blocks.
    """
    df = df.drop("n_words", "places", "template_labels", "score")
    columns = list(df.columns if keep is None else keep)
    sets, vocabulary = _token_sets(templates)
    held = F.array(*map(F.lit, vocabulary)).cast("array<string>")
    telling = F.array(*map(F.lit, _telling(sets, threshold))).cast("array<string>")
    spans = _spans(templates)
    pace = max(spans.values(), default=1)
    blocks = F.transform(
        F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("_words") - F.lit(pace + 1)), F.lit(pace)),
        lambda i: F.struct(i.alias("_block"), F.slice("_words", i + 1, 2 * pace).alias("words")),
    )
    candidates = F.filter(
        blocks,
        lambda b: F.arrays_overlap(b["words"], telling)
        & (F.size(F.array_intersect(b["words"], held)) >= _shortest(sets, threshold)),
    )
    none = F.array().cast("array<struct<_block:int,words:array<string>>>")
    cut = df.withColumn("_row", F.monotonically_increasing_id())
    cut = cut.withColumn("_words", words_of(lower_ascii(F.coalesce(text, F.lit("")))))
    cut = cut.select(
        *columns, "_row", F.size("_words").cast("long").alias("n_words"),
        phrase_places(F.col("_words"), phrases).alias("places"),
        F.when(F.arrays_overlap("_words", telling), candidates).otherwise(none).alias("_blocks"),
    )
    cut = stage(cut, "licenses")
    within = cut.select("_row", F.inline("_blocks"))
    found = containment_join(within, templates, threshold).drop("score").join(within, ["_row", "_block"])
    part, enough = F.lit(0.0), F.lit(False)
    for label, words in sets.items():
        best, here = _best_window(F.col("words"), templates[label], spans[label]), F.col("label") == label
        part = F.when(here, best / len(words)).otherwise(part)
        enough = F.when(here, best >= _needed(words, threshold)).otherwise(enough)
    found = found.filter(enough).withColumn("_part", part)
    found = found.groupBy("_row").agg(F.collect_set("label").alias("_labels"), F.max("_part").alias("_score"))
    score = F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce("_score", F.lit(0.0)))
    return cut.drop("_blocks").join(found, "_row", "left").select(
        *columns, "n_words", "places",
        F.array_sort(F.coalesce("_labels", F.array().cast("array<string>"))).alias("template_labels"),
        score.alias("score"),
    )


@query("op3_license_scan")
def op3_license_scan(spark, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=("doc_id",))
    base = F.array_distinct(F.col("places.label"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places.start").alias("first_word"),
        F.array_max("places.start").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, "template_labels")), ",").alias("labels"),
        "score",
    )
