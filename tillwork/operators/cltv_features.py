"""Monthly revenue features and the future-revenue target per customer.

The features come from long-form monthly sums; the wide month table exists only as a report. Months
are those present in the data, found once as a scalar subquery (one short array).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwork.functions.amounts import ratio
from tillwork.functions.text import hash_percent
from tillwork.operators.ranking import exact_quantiles
from tillwork.session import cut_lineage

TIME_FEATURES = (
    "AVG_MONTHLY_REVENUE",
    "STD_MONTHLY_REVENUE",
    "MAX_MONTHLY_REVENUE",
    "FIRST_HALF_REVENUE",
    "SECOND_HALF_REVENUE",
    "RECENT_3M_REVENUE",
    "EARLY_3M_REVENUE",
    "REVENUE_TREND",
    "GROWTH_RATE",
    "MONTHS_ACTIVE",
    "ACTIVITY_RATE",
    "PURCHASE_CONSISTENCY",
)


def monthly_revenue(sales: DataFrame) -> DataFrame:
    """Long form: one row per customer and month with its revenue X."""
    return (
        sales.filter(F.col("CUSTOMER_ID").isNotNull() & F.col("YEAR_MONTH").isNotNull())
        .groupBy("CUSTOMER_ID", "YEAR_MONTH")
        .agg(F.sum("REVENUE").alias("X"))
        .filter(F.col("X").isNotNull())
    )


def month_list(sales: DataFrame) -> Column:
    """Sorted months present, as one array value."""
    present = sales.filter(F.col("REVENUE").isNotNull() & F.col("CUSTOMER_ID").isNotNull())
    return present.agg(F.array_sort(F.collect_set("YEAR_MONTH")).alias("m")).scalar()


def monthly_pivot(sales: DataFrame) -> DataFrame:
    """Customer by month revenue, 0 where nothing was bought."""
    long = monthly_revenue(sales)
    months = [r["YEAR_MONTH"] for r in sales.select("YEAR_MONTH").dropna().distinct().orderBy("YEAR_MONTH").collect()]
    wide = long.withColumnRenamed("X", "REVENUE").groupBy("CUSTOMER_ID").pivot("YEAR_MONTH", months)
    return wide.agg(F.sum("REVENUE")).na.fill(0.0, subset=months)


def _indexed(sales: DataFrame, feature_months: int | None = None) -> tuple[DataFrame, Column]:
    """Long form with the 1-based month index, and the number of months."""
    months = month_list(sales)
    if feature_months is not None:
        months = F.slice(months, 1, feature_months)
    long = monthly_revenue(sales).withColumn("I", F.array_position(months, F.col("YEAR_MONTH")))
    return long, F.size(months)


def time_features(sales: DataFrame, feature_months: int | None = None) -> DataFrame:
    """Twelve features of each customer's month vector, months without sales counting as 0.

    `feature_months` limits the vector to the first months; by default it covers all of them.
    The deviation adds that of the months with sales to what the other months, all zero, put between them; both parts
    are sums of squares, so nothing cancels.
    """
    long, n = _indexed(sales, feature_months)
    half = F.floor(n / F.lit(2)).cast("int")
    x, i = F.col("X"), F.col("I")
    seen = i > 0

    def total(when: Column) -> Column:
        return F.coalesce(F.sum(F.when(when & seen, x)), F.lit(0.0))

    sums = long.groupBy("CUSTOMER_ID").agg(
        total(seen).alias("s"),
        F.coalesce(F.var_pop(F.when(seen, x)), F.lit(0.0)).alias("spread"),
        F.max(F.when(seen, x)).alias("hi"),
        F.count_if(seen).alias("months"),
        F.count_if(seen & (x > 0)).alias("active"),
        total(i <= half).alias("first"),
        total(i > half).alias("second"),
        total(i > n - 3).alias("recent"),
        total(i <= 3).alias("early"),
    )
    months = F.col("months")
    between = F.coalesce(ratio(F.col("s") * F.col("s") * (n - months), months * n), F.lit(0.0))
    variance = ratio(F.col("spread") * months + between, n - 1)
    padded = F.when(months < n, F.greatest(F.coalesce("hi", F.lit(0.0)), F.lit(0.0))).otherwise(F.col("hi"))
    first, second = F.col("first"), F.col("second")
    return (
        sums.select(
            "CUSTOMER_ID",
            ratio(F.col("s"), n).alias("AVG_MONTHLY_REVENUE"),
            F.sqrt(variance).alias("STD_MONTHLY_REVENUE"),
            padded.alias("MAX_MONTHLY_REVENUE"),
            first.alias("FIRST_HALF_REVENUE"),
            second.alias("SECOND_HALF_REVENUE"),
            F.col("recent").alias("RECENT_3M_REVENUE"),
            F.col("early").alias("EARLY_3M_REVENUE"),
            (ratio(second, n - half) - ratio(first, half)).alias("REVENUE_TREND"),
            (ratio(second, first + 1) - 1).alias("GROWTH_RATE"),
            F.col("active").alias("MONTHS_ACTIVE"),
            ratio(F.col("active"), n).alias("ACTIVITY_RATE"),
        )
        .withColumn(
            "PURCHASE_CONSISTENCY",
            F.lit(1.0) - ratio(F.col("STD_MONTHLY_REVENUE"), F.col("AVG_MONTHLY_REVENUE") + 1),
        )
    )


def feature_join(features: DataFrame, rfm: DataFrame) -> DataFrame:
    """Time features with the RFM row of the customer."""
    known = rfm.filter(F.col("CUSTOMER_ID") != "UNKNOWN").withColumn("CUSTOMER_ID", F.col("CUSTOMER_ID").cast("string"))
    return features.join(known, "CUSTOMER_ID", "left")


def numeric_columns(features: DataFrame, key: str = "CUSTOMER_ID") -> list[str]:
    return [f.name for f in features.schema if f.name != key and isinstance(f.dataType, T.NumericType)]


def numeric_select(features: DataFrame, key: str = "CUSTOMER_ID") -> DataFrame:
    """The key and the numeric columns; numbers stored as text are not features."""
    return features.select(key, *numeric_columns(features, key))


def future_revenue(sales: DataFrame, train_months: int = 12) -> DataFrame:
    """Revenue after the first `train_months` months; fails when there are no later months."""
    long, n = _indexed(sales)
    message = F.lit(f"Not enough data: need more than {train_months} months.")
    later = F.when(n <= train_months, F.raise_error(message).cast("boolean")).otherwise(F.col("I") > train_months)
    summed = F.coalesce(F.sum(F.when(later, F.col("X"))), F.lit(0.0))
    return long.groupBy("CUSTOMER_ID").agg(summed.alias("TARGET"))


@dataclass(frozen=True)
class Capped:
    """Rows with the column cut at its quantile, the cut, and how many rows were above it."""

    rows: DataFrame
    cap: float
    count: int


def cap_quantile(df: DataFrame, name: str = "TARGET", q: float = 0.95) -> Capped:
    """The column cut at its exact quantile. `df` is read three times: pass a stored one."""
    cap = exact_quantiles(df, [name], [q])[name][0]
    if cap is None:
        return Capped(df, float("nan"), 0)
    above = df.filter(F.col(name) > F.lit(cap)).count()
    return Capped(df.withColumn(name, F.least(F.col(name), F.lit(cap))), cap, above)


def capped_target(sales: DataFrame, train_months: int = 12, q: float = 0.95) -> Capped:
    return cap_quantile(cut_lineage(future_revenue(sales, train_months)), "TARGET", q)


def future_revenue_target(sales: DataFrame, train_months: int = 12, q: float = 0.95) -> DataFrame:
    return capped_target(sales, train_months, q).rows


def fill_missing_features(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """NULL and NaN to 0 in the numeric columns."""
    names = list(names) if names is not None else numeric_columns(df)
    return df.na.fill(0, subset=names)


def train_test_split(df: DataFrame, key: str = "CUSTOMER_ID", seed: int = 42, train_percent: int = 80) -> DataFrame:
    """Adds IS_TRAIN from a hash of key and seed: the same under any partitioning."""
    return df.withColumn("IS_TRAIN", hash_percent(F.col(key), F.lit(str(seed))) < train_percent)


def assign_fold(df: DataFrame, key: str = "CUSTOMER_ID", folds: int = 5, seed: int = 42) -> DataFrame:
    return df.withColumn("FOLD", hash_percent(F.col(key), F.lit(f"fold-{seed}"), buckets=folds))


def fit_scaler(train: DataFrame, names: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of each column, in one aggregation."""
    row = train.agg(
        *[F.avg(n).alias(f"m{k}") for k, n in enumerate(names)],
        *[F.stddev_pop(n).alias(f"d{k}") for k, n in enumerate(names)],
    ).first()
    return {n: (row[f"m{k}"] or 0.0, row[f"d{k}"] or 1.0) for k, n in enumerate(names)}


def standard_scale(df: DataFrame, scaler: dict[str, tuple[float, float]]) -> DataFrame:
    """Columns shifted and scaled by a fitted scaler; a constant column becomes 0."""
    return df.withColumns({n: (F.col(n) - F.lit(m)) / F.lit(d) for n, (m, d) in scaler.items()})
