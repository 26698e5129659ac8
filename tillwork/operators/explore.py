"""Checks on codes, descriptions, prices and countries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.functions.amounts import ratio
from tillwork.session import cut_lineage


def split_returns_sales(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Returns (negative quantity or a letter in the invoice) and the rest, each by invoice."""
    negative = F.coalesce(F.col("QUANTITY") < 0, F.lit(False))
    lettered = F.coalesce(F.col("INVOICE").rlike("[A-Za-z]"), F.lit(False))
    is_return = negative | lettered
    return _by_invoice(df.filter(is_return)), _by_invoice(df.filter(~is_return))


def _by_invoice(df: DataFrame) -> DataFrame:
    """Sorted by invoice. The row number breaks ties, so the range shuffle can split a hot invoice."""
    return df.withColumn("_row", F.monotonically_increasing_id()).orderBy("INVOICE", "_row").drop("_row")


def unique_values(df: DataFrame, name: str) -> DataFrame:
    return df.select(name).dropna().distinct().orderBy(name)


def unique_countries(df: DataFrame) -> DataFrame:
    return unique_values(df, "COUNTRY")


def unique_descriptions(df: DataFrame) -> DataFrame:
    return unique_values(df, "DESCRIPTION")


def descriptions_per_code(df: DataFrame) -> DataFrame:
    return df.select("STOCKCODE", "DESCRIPTION").distinct().orderBy("STOCKCODE", F.col("DESCRIPTION").asc_nulls_last())


def _distinct_counts(df: DataFrame, keys: Sequence[str], counted: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(*[F.count_distinct(c).alias(c) for c in counted])


def _stored_counts(df: DataFrame, keys: Sequence[str], counted: Sequence[str]) -> DataFrame:
    """The counts behind a checkpoint: they are compared with their own mean, and a row per key is
    far less than another pass over the lines."""
    return cut_lineage(_distinct_counts(df, keys, counted))


def _mean(df: DataFrame, c: Column) -> Column:
    """Mean over a frame as a scalar subquery: one value, no join."""
    return df.agg(ratio(F.sum(c), F.count(c))).scalar()


def description_count_per_code(df: DataFrame, flags: bool = True) -> DataFrame:
    """Distinct prices and descriptions per code, and what looks odd about them."""
    if not flags:
        return _distinct_counts(df, ["STOCKCODE"], ["PRICE", "DESCRIPTION"]).orderBy("STOCKCODE")
    counts = _stored_counts(df, ["STOCKCODE"], ["PRICE", "DESCRIPTION"])
    mean_length = _mean(counts, F.length("STOCKCODE"))
    mean_prices = _mean(counts, F.col("PRICE"))
    return counts.select(
        "STOCKCODE",
        "PRICE",
        "DESCRIPTION",
        F.when(F.col("DESCRIPTION") > 1, "1 code = X descri").otherwise("1 code = 1 descri").alias("ISSUE_COUNT_DESCRI"),
        F.length("STOCKCODE").alias("LENGTH_CODE"),
        F.when(F.length("STOCKCODE") < mean_length, "MAYBE").otherwise("MAYBE NO").alias("ISSUE_LENGTH_CODE"),
        F.when(F.col("PRICE") > mean_prices, "1 code = X prices")
        .otherwise("1 code = 1 price")
        .alias("ISSUE_COUNT_PRICE_CODE"),
    ).orderBy("STOCKCODE")


def description_count_per_code_country(df: DataFrame, flags: bool = True) -> DataFrame:
    """The same counts per code and country."""
    keys, counted = ["STOCKCODE", "COUNTRY"], ["PRICE", "DESCRIPTION"]
    if not flags:
        return _distinct_counts(df, keys, counted).orderBy(*keys)
    counts = _stored_counts(df, keys, counted)
    mean_prices = _mean(counts, F.col("PRICE"))
    return counts.select(
        "STOCKCODE",
        "COUNTRY",
        "PRICE",
        "DESCRIPTION",
        F.when(F.col("DESCRIPTION") > 1, "1 pair = X descri").otherwise("1 pair = 1 descri").alias("ISSUE_COUNT_DESCRI"),
        F.when(F.col("PRICE") > mean_prices, "1 pair = X prices").otherwise("1 pair = 1 price").alias("ISSUE_COUNT_PRICE"),
    ).orderBy("STOCKCODE", "COUNTRY")


def code_count_per_description(df: DataFrame) -> DataFrame:
    """Distinct codes and prices per description, and what looks odd about them."""
    counts = _stored_counts(df, ["DESCRIPTION"], ["STOCKCODE", "PRICE"])
    mean_length = _mean(counts, F.length("DESCRIPTION"))
    mean_prices = _mean(counts, F.col("PRICE"))
    return counts.select(
        "DESCRIPTION",
        "STOCKCODE",
        "PRICE",
        F.when(F.col("STOCKCODE") > 1, "1 descri = X codes").otherwise("1 descri = 1 code").alias("ISSUE_COUNT_CODE"),
        F.length("DESCRIPTION").alias("LENGTH_DESCRI"),
        F.when(F.length("DESCRIPTION") < mean_length, "MAYBE").otherwise("MAYBE NO").alias("ISSUE_LENGTH_DESCRI"),
        F.when(F.col("PRICE") > mean_prices, "1 descri = X prices")
        .otherwise("1 descri = 1 price")
        .alias("ISSUE_COUNT_PRICE_DESCRI"),
    ).orderBy("DESCRIPTION")


def faulty_descriptions(sales: DataFrame, per_code: DataFrame, per_description: DataFrame) -> DataFrame:
    """Sales lines with the flags of their code and description, and whether any flag says to look."""
    by_code = per_code.drop("PRICE", "DESCRIPTION")
    by_description = per_description.drop("PRICE", "STOCKCODE")
    joined = (
        sales.drop("INVOICE_DATE", "INVOICE_TIME")
        .join(by_code, "STOCKCODE", "left")
        .join(by_description, "DESCRIPTION", "left")
    )
    suspicious = {
        "ISSUE_COUNT_DESCRI": "MAYBE",
        "ISSUE_LENGTH_CODE": "MAYBE",
        "ISSUE_COUNT_PRICE_CODE": "1 code = X prices",
        "ISSUE_COUNT_CODE": "1 descri = X codes",
        "ISSUE_LENGTH_DESCRI": "MAYBE",
        "ISSUE_COUNT_PRICE_DESCRI": "1 descri = X prices",
    }
    any_flag = F.lit(False)
    for name, bad in suspicious.items():
        any_flag = any_flag | F.col(name).eqNullSafe(F.lit(bad))
    return joined.withColumn("TO_CHECK", F.when(any_flag, "YES").otherwise("NO"))


def multi_country_customers(df: DataFrame) -> DataFrame:
    """All (customer, country) pairs of customers seen in several countries."""
    pairs = df.select(F.col("CUSTOMER_ID").cast("string").alias("CUSTOMER_ID"), "COUNTRY").distinct()
    several = (
        pairs.filter(F.col("CUSTOMER_ID").isNotNull())
        .groupBy("CUSTOMER_ID")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
    )
    return pairs.join(several, "CUSTOMER_ID", "left_semi").orderBy("CUSTOMER_ID", "COUNTRY")
