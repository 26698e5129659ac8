"""Language ID, near-dedup, substring dedup and packing over `documents`, each stage on what the last one kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.llm.language_id import UNKNOWN, identify, train_on
from tillwork.llm.packing import packed_digest
from tillwork.llm.simhash import near_duplicates
from tillwork.llm.substring_dedup import remove_repeats
from tillwork.session import stage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter; `lang` becomes the prediction of the network. Learns from `docs` alone.

    Without a label to learn from, `lang` stays as it is, or becomes `und` if there is none.
    """
    docs = docs.select(*COLUMNS)
    model = train_on(docs)
    if model is None:
        return docs.filter(F.col("text").rlike(r"\p{L}")).withColumn("lang", F.coalesce("lang", F.lit(UNKNOWN)))
    found = identify(docs, model).filter("score > 0")  # 0 is the score of texts without a letter, and of no other
    return found.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first row by doc_id of each group of SimHash fingerprints; rows without an id come last.

    Three-word shingles and two bits, as in the operator's own query. Rows are told apart by their own number, not by
    doc_id, so different texts of one id are documents of their own.
    """
    rows = stage(docs.select(*COLUMNS).withColumn("_row", F.monotonically_increasing_id()), "rows")
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "_row").alias("place")
    groups = near_duplicates(rows.select("_row", "text"), key="_row").join(rows.select("_row", place), "_row")
    kept = groups.groupBy("component").agg(F.min("place").alias("place")).select("place._row")
    return rows.join(kept, "_row", "left_semi").select(*COLUMNS)


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes words of repeated passages; documents of which nothing is left go, untouched texts stay as they are."""
    found = remove_repeats(docs.select(*COLUMNS), carry=COLUMNS[1:4], nulls_last=True)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    found = found.filter("n_removed = 0 OR n_removed < n_words").withColumn("text", text)
    return found.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    return packed_digest(docs)


STAGES = [
    ("language_id", language_stage),
    ("simhash_dedup", simhash_stage),
    ("substring_dedup", passage_stage),
    ("packing", packing_stage),
]

#: A trained network and a tokenizer are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage's result is written as Parquet to the shared folder and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
