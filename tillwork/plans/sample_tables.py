"""The given tables read as raw invoice lines, and reference tables derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.sources.storage import set_age

CURRENCIES = ("GBP", "EUR", "USD")
ZONES = ("Europe/London", "America/New_York", "Asia/Kolkata", "Mars/Base")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def nation_country(key: Column, name: Column) -> Column:
    """Raw country text of a nation, with the special names planted."""
    return (
        F.when(key == 0, "EIRE").when(key == 1, "RSA").when(key == 2, "Unspecified").when(key == 3, "West Indies ").otherwise(name)
    )


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed raw lines: returns, NULL texts, blanks, unknown customers, special countries."""
    joined = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    )
    returned = F.col("l_returnflag") == "R"
    return joined.select(
        F.concat(F.when(returned, "c").otherwise(""), F.col("o_orderkey").cast("string")).alias("INVOICE"),
        F.concat(F.lower("p_brand"), F.lit(" ")).alias("STOCKCODE"),
        F.when(F.col("l_linenumber") % 7 != 0, F.concat(F.lit(" "), "p_name", F.lit("  "))).alias("DESCRIPTION"),
        F.when(returned, -F.col("l_quantity")).otherwise(F.col("l_quantity")).cast("bigint").alias("QUANTITY"),
        F.col("o_orderdate").alias("INVOICEDATE"),
        F.col("p_retailprice").alias("PRICE"),
        F.when(F.col("o_custkey") % 17 != 0, F.col("o_custkey").cast("string")).alias("CUSTOMER_ID"),
        nation_country(F.col("n_nationkey"), F.col("n_name")).alias("COUNTRY"),
    )


def text_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines as a text file would deliver them: every column text."""
    raw = raw_sales(spark, sf_dir)
    return raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])


def land(df: DataFrame, folder: str, name: str, days_old: int = 0) -> None:
    """Write a sheet of gzipped CSV parts into a landing folder, blanks kept; its files may look older than they are."""
    path = f"{folder}/{name}.csv"
    plain = {"header": True, "compression": "gzip", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "escape": '"'}
    df.write.options(**plain).csv(path)
    if days_old:
        set_age(df.sparkSession, path, days_old)


def country_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NAME, CONTINENT, CAPITAL, ISO3, CURRENCY, ZONE per nation."""
    key = F.col("n_nationkey")
    named = (
        F.when(key == 0, "Ireland")
        .when(key == 1, "Republic of South Africa")
        .when(key == 2, "United Kingdom")
        .when(key == 3, "Dominican Republic")
        .otherwise(F.concat(F.lit("Nation "), key.cast("string")))
    )
    pick = F.element_at(F.array(*[F.lit(c) for c in CURRENCIES], F.lit(None)), (key % 4 + 1).cast("int"))
    zone = F.element_at(F.array(*[F.lit(z) for z in ZONES], F.lit(None)), (key % 5 + 1).cast("int"))
    return (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            named.alias("NAME"),
            F.col("r_name").alias("CONTINENT"),
            F.concat(F.lit("Capital "), key.cast("string")).alias("CAPITAL"),
            F.concat(F.lit("N"), F.lpad(key.cast("string"), 2, "0")).alias("ISO3"),
            pick.alias("CURRENCY"),
            zone.alias("ZONE"),
        )
    )


def rate_references(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two rate sources over the order dates; each lacks some dates."""
    dates = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("RATE_DATE")).distinct()
    day = F.dayofyear("RATE_DATE")
    rates = dates.select(
        "RATE_DATE",
        F.explode(F.array(F.lit("EUR"), F.lit("USD"))).alias("CURRENCY"),
    ).withColumn("RATE", F.lit(1.0) + (F.dayofyear("RATE_DATE") % 10 + F.length("CURRENCY") - 3).cast("double") / 10)
    first = rates.filter(day % 7 != 0)
    second = rates.filter(day % 14 != 0).withColumn("RATE", F.col("RATE") + F.lit(0.5))
    return first, second


def score_mapping(scored: DataFrame) -> DataFrame:
    """A score mapping over the scores that occur."""
    total = sum((F.substring("RFM_SCORE", k, 1).cast("int") for k in (1, 2, 3)), F.lit(0))
    segment = F.when(total >= 12, "TOP").when(total >= 8, "MIDDLE").otherwise("LOW")
    return scored.select("RFM_SCORE").distinct().select(
        F.col("RFM_SCORE").cast("int").alias("RFM_SCORE"),
        segment.alias("RFM_SEGMENT"),
        F.concat(F.lit("Segment "), segment).alias("RFM_NAME"),
    )
