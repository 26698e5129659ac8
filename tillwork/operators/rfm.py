"""Recency, frequency and monetary metrics and scores per customer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.functions.amounts import ratio
from tillwork.operators.ranking import quintile_scores


def snapshot_date(sales: DataFrame) -> DataFrame:
    """One row: the day after the last invoice."""
    last = F.max(F.to_date("INVOICE_DATE"))
    return sales.agg(F.date_add(last, 1).cast("string").alias("SNAPSHOT_DATE"))


def rfm_metrics(sales: DataFrame) -> DataFrame:
    """Per-customer metrics in one grouped aggregation; the snapshot date is a scalar subquery."""
    day = F.to_date("INVOICE_DATE")
    snapshot = F.to_date(snapshot_date(sales).scalar())
    per_customer = (
        sales.filter(F.col("CUSTOMER_ID").isNotNull())
        .groupBy("CUSTOMER_ID")
        .agg(
            F.min(day).alias("first"),
            F.max(day).alias("last"),
            F.count_distinct("INVOICE").alias("FREQUENCY"),
            F.sum("QUANTITY").alias("SOLD_QUANTITY"),
            F.count("QUANTITY").alias("lines"),
            F.sum("REVENUE").alias("TOTAL_REVENUE"),
            F.count("REVENUE").alias("priced"),
            F.max("REVENUE").alias("MAX_ORDER_VALUE"),
            F.min("REVENUE").alias("MIN_ORDER_VALUE"),
        )
    )
    return per_customer.select(
        "CUSTOMER_ID",
        F.datediff(snapshot, F.col("last")).cast("bigint").alias("RECENCY"),
        F.datediff(F.col("last"), F.col("first")).cast("bigint").alias("TENURE"),
        F.col("first").cast("string").alias("DATE_FIRST_PURCHASE"),
        F.col("last").cast("string").alias("DATE_LAST_PURCHASE"),
        "FREQUENCY",
        F.col("SOLD_QUANTITY").cast("double").alias("SOLD_QUANTITY"),
        ratio(F.col("SOLD_QUANTITY"), F.col("lines")).alias("AVG_BASKET_SIZE"),
        "TOTAL_REVENUE",
        ratio(F.col("TOTAL_REVENUE"), F.col("priced")).alias("AVG_ORDER_VALUE"),
        "MAX_ORDER_VALUE",
        "MIN_ORDER_VALUE",
    )


def rfm_derived(rfm: DataFrame) -> DataFrame:
    days = F.col("TENURE") + 1
    return rfm.withColumns(
        {
            "PURCHASE_FREQUENCY_RATE": ratio(F.col("FREQUENCY"), days),
            "REVENUE_PER_DAY": ratio(F.col("TOTAL_REVENUE"), days),
            "IS_REPEAT_CUSTOMER": (F.col("FREQUENCY") > 1).cast("int"),
            "AVG_DAYS_BETWEEN_PURCHASES": ratio(F.col("TENURE"), F.col("FREQUENCY")),
        }
    ).withColumns(
        {
            "CHURN_RISK_SCORE": ratio(F.col("RECENCY"), F.col("AVG_DAYS_BETWEEN_PURCHASES") + 1),
            "IS_ACTIVE": (F.col("RECENCY") <= 90).cast("int"),
        }
    )


def rfm_rates(rfm: DataFrame) -> DataFrame:
    return rfm.agg(
        F.avg("IS_REPEAT_CUSTOMER").alias("REPEAT_CUSTOMER_RATE"), F.avg("IS_ACTIVE").alias("ACTIVE_CUSTOMER_RATE")
    )


def rfm_scores(rfm: DataFrame) -> DataFrame:
    """Scores 1..5 and their three-digit text.

    Three sorts run over the given frame, so pass one that is stored or checkpointed.
    """
    names = {"RECENCY": "RECENCY_SCORE", "FREQUENCY": "FREQUENCY_SCORE", "TOTAL_REVENUE": "MONETARY_SCORE"}
    scored = quintile_scores(rfm, names, "CUSTOMER_ID")
    scored = scored.withColumn("RECENCY_SCORE", F.lit(6) - F.col("RECENCY_SCORE"))
    digits = [F.col(c).cast("string") for c in ("RECENCY_SCORE", "FREQUENCY_SCORE", "MONETARY_SCORE")]
    return scored.withColumn("RFM_SCORE", F.concat(*digits))


def score_summary(rfm: DataFrame, score: str, metric: str, label: str) -> DataFrame:
    """Smallest and largest metric and customer count per score."""
    return (
        rfm.groupBy(score)
        .agg(
            F.min(metric).alias(f"MIN_{label}"), F.max(metric).alias(f"MAX_{label}"), F.count(metric).alias("COUNT")
        )
        .orderBy(score)
    )


def rfm_score_summaries(rfm: DataFrame) -> dict[str, DataFrame]:
    return {
        "Summary recency": score_summary(rfm, "RECENCY_SCORE", "RECENCY", "RECENCY"),
        "Summary frequency": score_summary(rfm, "FREQUENCY_SCORE", "FREQUENCY", "FREQUENCY"),
        "Summary monetary": score_summary(rfm, "MONETARY_SCORE", "TOTAL_REVENUE", "MONETARY"),
    }


def rfm_segment_join(rfm: DataFrame, mapping: DataFrame) -> DataFrame:
    """Segment texts by score; the score is text on one side and a number on the other.

    No broadcast hint: the mapping is normally a few hundred rows and its measured size decides.
    """
    keyed = mapping.select(
        F.col("RFM_SCORE").cast("string").alias("RFM_SCORE"), "RFM_SEGMENT", "RFM_NAME"
    ).dropDuplicates(["RFM_SCORE"])
    return rfm.join(keyed, "RFM_SCORE", "left")


def cltv_formula(sales: DataFrame, margin: float = 0.05) -> DataFrame:
    """Closed-form lifetime value from order value, purchase frequency and churn."""
    lines = sales.filter((F.col("QUANTITY") > 0) & (F.col("PRICE") > 0) & F.col("CUSTOMER_ID").isNotNull())
    day = F.to_date("INVOICE_DATE")
    last_day = lines.agg(F.date_add(F.max(day), 1)).scalar()
    base = lines.groupBy("CUSTOMER_ID").agg(
        F.datediff(last_day, F.max(day)).cast("bigint").alias("RECENCY"),
        F.count(F.lit(1)).alias("FREQUENCY"),
        F.sum("QUANTITY").alias("SOLD_QUANTITY"),
        F.sum("REVENUE").alias("REVENUE"),
        F.datediff(F.max(day), F.min(day)).cast("bigint").alias("TENURE"),
    )
    per_customer = base.select("FREQUENCY").agg(
        ratio(F.sum("FREQUENCY"), F.count(F.lit(1))).alias("pf"),
        (F.lit(1.0) - ratio(F.count_if(F.col("FREQUENCY") > 1), F.count(F.lit(1)))).alias("churn"),
    )
    frequency = per_customer.select("pf").scalar()
    churn = per_customer.select("churn").scalar()
    return base.withColumns(
        {
            "AOV": ratio(F.col("REVENUE"), F.col("FREQUENCY")),
            "PROFIT_MARGIN": F.col("REVENUE") * margin,
        }
    ).withColumn("CLV", ratio(F.col("AOV") * frequency, churn)).withColumn("CLTV", F.col("CLV") * F.col("PROFIT_MARGIN"))
