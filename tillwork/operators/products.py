"""Product-name resolution.

Lines are first counted per (code, raw name). That frame is as small as the catalogue, holds no hot
key in proportion to sales, and carries the line counts the majority vote needs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.functions import fixed_values as fixed
from tillwork.functions import text
from tillwork.operators.cleaning import description_clean
from tillwork.session import cut_lineage


def _known_name(c: Column) -> Column:
    """The name itself, NULL when it says nothing."""
    return F.nullif(text.strip(F.nullif(c, F.lit(text.UNKNOWN))), F.lit(""))


def best_description(df: DataFrame, name: str, weight: Column | None = None, target: str = "BEST_NAME") -> DataFrame:
    """Per STOCKCODE the most frequent name, ties to the longest, then the alphabetically first.

    Two grouped aggregations with partial results on both, so a hot code stays spread out.
    """
    votes = df.filter(F.col("STOCKCODE").isNotNull()).select(
        "STOCKCODE", _known_name(F.col(name)).alias("_name"), (weight if weight is not None else F.lit(1)).alias("_w")
    )
    counted = votes.groupBy("STOCKCODE", "_name").agg(F.sum("_w").alias("_n"))
    ballot = F.struct((-F.col("_n")).alias("n"), (-F.length("_name")).alias("len"), F.col("_name").alias("name"))
    winner = F.min(F.when(F.col("_name").isNotNull(), ballot))
    return counted.groupBy("STOCKCODE").agg(F.coalesce(winner["name"], F.lit(text.UNKNOWN)).alias(target))


def fill_product_name(df: DataFrame, source: str, target: str, weight: Column | None = None) -> DataFrame:
    """Keep a row's own name, else the best name of its code, else UNKNOWN."""
    best = best_description(df, source, weight, "_best")
    filled = F.coalesce(_known_name(F.col(source)), F.col("_best"), F.lit(text.UNKNOWN))
    keep = [c for c in df.columns if c != target]
    return df.join(best, "STOCKCODE", "left").select(*keep, filled.alias(target))


def code_count_per_name(df: DataFrame) -> DataFrame:
    """Rows per PRODUCT_NAME over distinct (STOCKCODE, DESCRIPTION_CLEAN, PRODUCT_NAME)."""
    return (
        df.select("STOCKCODE", "DESCRIPTION_CLEAN", "PRODUCT_NAME")
        .distinct()
        .filter(F.col("PRODUCT_NAME").isNotNull())
        .groupBy("PRODUCT_NAME")
        .agg(F.count("STOCKCODE").alias("COUNT_CODE_PER_PRODUCT"))
    )


def null_out_names(
    df: DataFrame, name: str, keep: Sequence[str] | None = None, remove: Sequence[str] | None = None
) -> DataFrame:
    """NULL for names outside `keep` (when given) and for names in `remove` (when given)."""
    c = F.col(name)
    drop = F.lit(False)
    if keep is not None:
        drop = drop | ~c.isin(list(keep))
    if remove is not None:
        drop = drop | c.isin(list(remove))
    return df.withColumn(name, F.when(~F.coalesce(drop, F.lit(False)), c))


def name_length(df: DataFrame, name: str, target: str = "NAME_LENGTH") -> DataFrame:
    return df.withColumn(target, F.length(name))


def count_names(sales: DataFrame) -> DataFrame:
    """(STOCKCODE, DESCRIPTION_RAW, LINES): sales lines per raw name of a code."""
    return sales.groupBy("STOCKCODE", F.col("DESCRIPTION").alias("DESCRIPTION_RAW")).agg(F.count(F.lit(1)).alias("LINES"))


def product_mapping(
    sales: DataFrame,
    keep: Sequence[str] = fixed.PRODUCTS_TO_KEEP,
    remove: Sequence[str] = fixed.PRODUCTS_TO_REMOVE,
    min_codes: int = 1,
) -> DataFrame:
    """(STOCKCODE, DESCRIPTION_RAW) of the sales with its resolved PRODUCT_NAME; see `resolve_names`."""
    return resolve_names(count_names(sales), keep, remove, min_codes)


def resolve_names(
    counted: DataFrame,
    keep: Sequence[str] = fixed.PRODUCTS_TO_KEEP,
    remove: Sequence[str] = fixed.PRODUCTS_TO_REMOVE,
    min_codes: int = 1,
) -> DataFrame:
    """Names of counted (STOCKCODE, DESCRIPTION_RAW, LINES) pairs.

    `min_codes` is the number of catalogue rows from which a name outside `keep` is dropped: 1 drops
    all of them, 2 only repeated ones. The first two votes weigh a name by its sales lines, the
    third by its catalogue rows.
    """
    lines = F.col("LINES")
    base = cut_lineage(counted)
    named = fill_product_name(description_clean(base), "DESCRIPTION_CLEAN", "PRODUCT_NAME", lines)
    if min_codes > 1:
        named = cut_lineage(named)
        repeated = code_count_per_name(named).filter(F.col("COUNT_CODE_PER_PRODUCT") >= min_codes)
        marked = named.join(repeated.select("PRODUCT_NAME", F.lit(True).alias("_repeated")), "PRODUCT_NAME", "left")
        dropped = F.coalesce("_repeated", F.lit(False)) & ~F.col("PRODUCT_NAME").isin(list(keep))
        named = marked.withColumn("PRODUCT_NAME", F.when(~dropped, F.col("PRODUCT_NAME"))).drop("_repeated")
    else:
        named = null_out_names(named, "PRODUCT_NAME", keep=keep)
    second = cut_lineage(fill_product_name(cut_lineage(named), "PRODUCT_NAME", "PRODUCT_NAME_CLEAN_1", lines))
    second = null_out_names(name_length(second, "PRODUCT_NAME_CLEAN_1"), "PRODUCT_NAME_CLEAN_1", remove=remove)
    third = fill_product_name(second, "PRODUCT_NAME_CLEAN_1", "PRODUCT_NAME_CLEAN_2")
    return third.select("STOCKCODE", "DESCRIPTION_RAW", F.col("PRODUCT_NAME_CLEAN_2").alias("PRODUCT_NAME"))


def product_code_reports(mapping: DataFrame) -> dict[str, DataFrame]:
    """Names per code, codes with several names, names with several codes."""
    base = mapping.select("STOCKCODE", "PRODUCT_NAME").distinct()
    per_code = (
        base.filter(F.col("STOCKCODE").isNotNull())
        .groupBy("STOCKCODE")
        .agg(F.count("PRODUCT_NAME").alias("COUNT_PRODUCT_PER_CODE"))
    )
    several = per_code.filter(F.col("COUNT_PRODUCT_PER_CODE") > 1).join(base, "STOCKCODE").orderBy("STOCKCODE", "PRODUCT_NAME")
    per_name = (
        base.filter(F.col("PRODUCT_NAME").isNotNull())
        .groupBy("PRODUCT_NAME")
        .agg(F.count("STOCKCODE").alias("COUNT_CODE_PER_PRODUCT"))
        .filter(F.col("COUNT_CODE_PER_PRODUCT") > 1)
        .orderBy(F.desc("COUNT_CODE_PER_PRODUCT"), "PRODUCT_NAME")
    )
    return {
        "Count Product per Code": per_code,
        "Multi product per Code": several,
        "Multi code per product": per_name,
    }
