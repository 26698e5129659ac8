"""Data-quality profile of any table.

Wide per-column questions become one aggregation over the table; per-value questions go through one
unpivoted (column, value) count, which combines on the map side before any shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from tillwork.functions.amounts import ratio
from tillwork.operators.profile_scan import QUARTILES, Profile, correlations, fixed_size, numeric_columns
from tillwork.operators.ranking import exact_quantiles


def _as_rows(totals: DataFrame, per_column: Sequence[Sequence[Column]], names: Sequence[str]) -> DataFrame:
    """One wide row of totals to one row per profiled column."""
    structs = [F.struct(*[c.alias(n) for c, n in zip(cols, names)]) for cols in per_column]
    return totals.select(F.inline(F.array(*structs)))


def profile_head(df: DataFrame, size: int, order: Sequence[str]) -> DataFrame:
    return df.orderBy(*order).limit(size)


def profile_tail(df: DataFrame, size: int, order: Sequence[str]) -> DataFrame:
    """Last rows of the given order, in that order."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(size).orderBy(*order)


def profile_sample(df: DataFrame, size: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """Pseudo-random rows: the smallest hashes of key and seed, so the draw can be repeated."""
    draw = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.lit(str(seed))).cast("binary"))
    return df.withColumn("_draw", draw).orderBy("_draw", *key).limit(size).drop("_draw")


def profile_columns(df: DataFrame) -> list[str]:
    return df.columns


def _null_counts(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(c)).alias(c) for c in df.columns])


def profile_info(df: DataFrame) -> DataFrame:
    """Totals, then non-null count, null count and type per column. Memory is that of the values themselves."""
    blank = F.lit("")
    texts = [f.name for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    fixed = sum((F.count(c) * fixed_size(df.schema[c].dataType) for c in df.columns if c not in texts), F.lit(0))
    size = sum((F.coalesce(F.sum(F.octet_length(c)), F.lit(0)) for c in texts), fixed)
    totals = df.agg(F.count(F.lit(1)).alias("_rows"), size.alias("_bytes"), *[F.count(F.col(c)).alias(c) for c in df.columns])
    memory = F.concat(F.format_string("%.1f", F.col("_bytes") / 1024**2), F.lit(" MB"))
    rows = [
        (F.lit("Total Entries"), F.col("_rows").cast("string"), blank, blank),
        (F.lit("Total Columns"), F.lit(str(len(df.columns))), blank, blank),
        (F.lit("Memory Usage"), blank, blank, memory),
    ]
    for name, kind in df.dtypes:
        missing = (F.col("_rows") - F.col(name)).cast("string")
        rows.append((F.lit(name), F.col(name).cast("string"), missing, F.lit(kind)))
    return _as_rows(totals, rows, ["Column", "Non-Null Count", "Null Count", "Dtype"])


def profile_fill_rate(df: DataFrame) -> DataFrame:
    rows = [
        (F.lit(c), F.round((F.lit(1.0) - ratio(F.col("_rows") - F.col(c), F.col("_rows"))) * 100, 2)) for c in df.columns
    ]
    return _as_rows(_null_counts(df), rows, ["col", "fill_rate"])


def profile_missing_rate(df: DataFrame) -> DataFrame:
    rows = [(F.lit(c), F.round(ratio(F.col("_rows") - F.col(c), F.col("_rows")) * 100, 2)) for c in df.columns]
    return _as_rows(_null_counts(df), rows, ["col", "null_rate"])


def value_counts(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """(col, value, n) over non-NULL values, values as text."""
    names = list(names or df.columns)
    text = df.select(*[F.col(c).cast("string").alias(c) for c in names])
    long = text.unpivot([], names, "col", "value").filter(F.col("value").isNotNull())
    return long.groupBy("col", "value").agg(F.count(F.lit(1)).alias("n"))


def profile_value_share(df: DataFrame, top: int = 20) -> DataFrame:
    """Share of the most frequent values per column; every share above 5 % is among the top 20.

    The rank filter is pushed below the shuffle as a group limit, so each task sends at most `top`
    values per column.
    """
    counts = value_counts(df)
    totals = df.agg(F.create_map(*[x for c in df.columns for x in (F.lit(c), F.count(F.col(c)))])).scalar()
    order = Window.partitionBy("col").orderBy(F.desc("n"), "value")
    ranked = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("col", "value", (ratio(F.col("n"), F.element_at(totals, F.col("col"))) * 100).alias("share"))


def profile_need_trim(df: DataFrame) -> DataFrame:
    """Strings per column that start or end with a blank."""
    text = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    flags = [F.count_if(F.col(c).startswith(" ") | F.col(c).endswith(" ")).alias(c) for c in df.columns if c in text]
    totals = df.agg(F.count(F.lit(1)).alias("_rows"), *flags)
    rows = [(F.lit(c), F.col(c) if c in text else F.lit(0).cast("bigint")) for c in df.columns]
    return _as_rows(totals, rows, ["col", "needs_trim"])


def profile_describe(df: DataFrame, approx: bool = False) -> DataFrame:
    """Count, unique, top, freq of text columns; mean, std, min, quartiles, max of numeric ones.

    Quartiles are exact through one distributed sort, or a sketch with `approx`.
    """
    numbers = numeric_columns(df)
    others = [c for c in df.columns if c not in numbers]
    totals = df.agg(
        *[F.count(F.col(c)).alias(f"{c}|count") for c in df.columns],
        *[f(F.col(c).cast("double")).alias(f"{c}|{k}") for c in numbers for k, f in _MOMENTS.items()],
        *[F.percentile_approx(F.col(c).cast("double"), list(QUARTILES)).alias(f"{c}|q") for c in numbers if approx],
    )
    quartiles = {} if approx or not numbers else exact_quantiles(df, numbers, QUARTILES)
    null = F.lit(None)
    rows = []
    for c in df.columns:
        number = c in numbers
        if number and approx:
            qs = [F.element_at(F.col(f"`{c}|q`"), k + 1) for k in range(3)]
        else:
            qs = [F.lit(q).cast("double") for q in quartiles.get(c, [None] * 3)]
        part = {k: (F.col(f"`{c}|{k}`") if number else null.cast("double")) for k in _MOMENTS}
        rows.append((F.lit(c), F.col(f"`{c}|count`"), part["mean"], part["std"], part["min"], *qs, part["max"]))
    names = ["col", "count", "mean", "std", "min", "p25", "p50", "p75", "max"]
    table = _as_rows(totals, rows, names)
    if not others:
        return table.select("col", "count", *_tops_empty(), *names[2:])
    counts = value_counts(df, others)
    # Smallest value among the most frequent ones.
    winner = F.min(F.struct((-F.col("n")).alias("n"), F.col("value").alias("value")))
    tops = counts.groupBy("col").agg(F.count(F.lit(1)).alias("unique"), winner.alias("w"))
    tops = tops.select("col", "unique", F.col("w.value").alias("top"), (-F.col("w.n")).alias("freq"))
    return table.join(tops, "col", "left").select("col", "count", "unique", "top", "freq", *names[2:])


_MOMENTS = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}


def _tops_empty() -> list[Column]:
    return [
        F.lit(None).cast("bigint").alias("unique"),
        F.lit(None).cast("string").alias("top"),
        F.lit(None).cast("bigint").alias("freq"),
    ]


def profile_skewness(df: DataFrame) -> DataFrame:
    """Bias-adjusted skewness per numeric column; NULL under three values or without spread."""
    numbers = numeric_columns(df)
    totals = df.agg(
        *[F.count(F.col(c)).cast("double").alias(f"{c}|n") for c in numbers],
        *[F.var_pop(F.col(c)).alias(f"{c}|v") for c in numbers],
        *[F.skewness(F.col(c)).alias(f"{c}|s") for c in numbers],
    )
    rows = []
    for c in numbers:
        n, v, s = F.col(f"`{c}|n`"), F.col(f"`{c}|v`"), F.col(f"`{c}|s`")
        rows.append((F.lit(c), F.when((n > 2) & (v > 0), s * F.sqrt(n * (n - 1)) / (n - 2))))
    return _as_rows(totals, rows, ["col", "skewness"])


def profile_histogram(df: DataFrame, bins: int = 10) -> DataFrame:
    """Equal-width bins between the smallest and largest value of each numeric column."""
    numbers = numeric_columns(df)
    cast = df.select(*[F.col(c).cast("double").alias(c) for c in numbers])
    ends = cast.agg(
        F.create_map(*[x for c in numbers for x in (F.lit(c), F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")))])
    ).scalar()
    long = cast.unpivot([], numbers, "col", "value").filter(F.col("value").isNotNull())
    lo, hi = F.element_at(ends, F.col("col"))["lo"], F.element_at(ends, F.col("col"))["hi"]
    place = F.floor(ratio((F.col("value") - lo) * F.lit(bins), hi - lo)).cast("int") + 1
    binned = long.withColumn("bin", F.least(F.coalesce(place, F.lit(1)), F.lit(bins)))
    return binned.groupBy("col", "bin").agg(F.count(F.lit(1)).alias("n"))


def profile_distribution(df: DataFrame, bins: int = 10) -> dict[str, DataFrame]:
    return {"Skewness": profile_skewness(df), "Histogram": profile_histogram(df, bins)}


def pairs_of(rows: DataFrame, numbers: Sequence[str]) -> DataFrame:
    """(feature_1, feature_2, correlation) of every pair, the earlier column first, from rows (i, r) of the matrix."""
    names = F.array(*[F.lit(c) for c in numbers]) if numbers else F.array().cast("array<string>")
    long = rows.select("i", F.posexplode("r").alias("j", "correlation")).filter("i < j")
    return long.select(F.get(names, F.col("i")).alias("feature_1"), F.get(names, F.col("j")).alias("feature_2"), "correlation")


def profile_corr_pairs(df: DataFrame) -> DataFrame:
    """Pearson correlation of every pair of numeric columns over the rows where both have a value.

    One scan adds up pairwise sums in arrays, so the plan is the same for three columns and for hundreds. A column
    without spread over the common rows has no correlation.
    """
    numbers = numeric_columns(df)
    return pairs_of(correlations(df, numbers), numbers)


def corr_matrix(rows: DataFrame, numbers: Sequence[str]) -> DataFrame:
    """One row and one column per numeric column, from rows (i, r) of the matrix; 1 on the diagonal of a column with spread."""
    names = F.array(*[F.lit(c) for c in numbers]) if numbers else F.array().cast("array<string>")
    itself = F.when(F.get("r", F.col("i")).isNotNull(), F.lit(1.0))
    cells = [F.when(F.col("i") == k, itself).otherwise(F.get("r", F.lit(k))).alias(c) for k, c in enumerate(numbers)]
    return rows.select(F.get(names, F.col("i")).alias("feature"), *cells)


def profile_corr_matrix(df: DataFrame) -> DataFrame:
    """Square matrix: one row and one column per numeric column."""
    numbers = numeric_columns(df)
    return corr_matrix(correlations(df, numbers), numbers)


def corr_top(pairs: DataFrame, size: int = 10) -> tuple[DataFrame, DataFrame]:
    """Most positive and most negative pairs; pairs without a defined correlation are left out.

    As in an upper triangle read column by column, feature_1 is the later column of the table.
    """
    turned = pairs.select(F.col("feature_2").alias("feature_1"), F.col("feature_1").alias("feature_2"), "correlation")
    known = turned.filter(F.col("correlation").isNotNull())
    names = ["feature_1", "feature_2"]
    return (
        known.orderBy(F.desc("correlation"), *names).limit(size),
        known.orderBy(F.asc("correlation"), *names).limit(size),
    )


def profile_corr_top(df: DataFrame, size: int = 10) -> tuple[DataFrame, DataFrame]:
    return corr_top(profile_corr_pairs(df), size)


def profile_all(df: DataFrame, order: Sequence[str], size: int = 100) -> dict[str, DataFrame | list[str]]:
    """All profile results by name, cut from one scan of `df`."""
    return Profile(df, order, size).results()
