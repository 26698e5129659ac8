"""Silver-level cleaning of raw invoice lines."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwork.functions import amounts, text

SALES_TEXT_KEYS = ("INVOICE", "STOCKCODE", "DESCRIPTION")


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Exact duplicates over all columns, NULL equal to NULL."""
    return df.dropDuplicates()


def clean_text_key(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: text.text_key(F.col(n)) for n in names})


def clean_country(df: DataFrame, name: str = "COUNTRY") -> DataFrame:
    return df.withColumn(name, text.country_key(F.col(name)))


def clean_customer_id(df: DataFrame, name: str = "CUSTOMER_ID") -> DataFrame:
    fractional = isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType))
    return df.withColumn(name, text.customer_key(F.col(name), fractional))


def coerce_numeric(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Numbers where the text is one, NULL elsewhere; `types` maps column to target type.

    Columns that are numbers already are only cast.
    """
    numeric = {f.name for f in df.schema if isinstance(f.dataType, T.NumericType)}
    return df.withColumns(
        {n: (F.col(n) if n in numeric else text.to_number(F.col(n))).try_cast(t) for n, t in types.items()}
    )


def parse_timestamp(c: Column, fmt: str | None = None) -> Column:
    """Wall-clock timestamp, NULL where the text is not one; no time zone is involved."""
    if fmt is None:
        return c.try_cast("timestamp_ntz")
    return F.try_to_timestamp(c, F.lit(fmt)).cast("timestamp_ntz")


def coerce_timestamp_split(
    df: DataFrame, name: str = "INVOICEDATE", fmt: str | None = None, date: str = "INVOICE_DATE", time: str = "INVOICE_TIME"
) -> DataFrame:
    """Replace the event time by a text date and a text time."""
    ts = parse_timestamp(F.col(name), fmt)
    return df.withColumns({date: amounts.date_text(ts), time: amounts.time_text(ts)}).drop(name)


def classify_return_sale(df: DataFrame, name: str = "INVOICE_TYPE") -> DataFrame:
    """RETURN for a negative quantity or an invoice that is not all digits, else SALE."""
    negative = F.coalesce(F.col("QUANTITY") < 0, F.lit(False))
    is_return = negative | ~text.all_digits(F.col("INVOICE"))
    return df.withColumn(name, F.when(is_return, "RETURN").otherwise("SALE"))


def clean_sales(raw: DataFrame, fmt: str | None = None) -> DataFrame:
    """Raw invoice lines to the ten clean sales columns."""
    return clean_lines(dedupe_rows(raw), fmt)


def clean_lines(raw: DataFrame, fmt: str | None = None) -> DataFrame:
    """`clean_sales` for lines that hold no duplicates."""
    df = clean_text_key(raw, *SALES_TEXT_KEYS)
    df = coerce_numeric(df, {"QUANTITY": "bigint", "PRICE": "double"})
    df = coerce_timestamp_split(df, fmt=fmt)
    df = clean_customer_id(df)
    df = clean_country(df)
    return classify_return_sale(df)


def filter_valid_sales(sales: DataFrame, required: tuple[str, ...] = ()) -> DataFrame:
    """Lines with positive quantity and price and a known customer; `required` must be non-NULL."""
    kept = sales.filter((F.col("QUANTITY") > 0) & (F.col("PRICE") > 0) & (F.col("CUSTOMER_ID") != text.UNKNOWN))
    return kept.dropna(subset=list(required)) if required else kept


def extract_year_month(sales: DataFrame) -> DataFrame:
    return sales.withColumns(
        {
            "YEAR_MONTH": amounts.year_month(F.col("INVOICE_DATE")),
            "CUSTOMER_ID": F.col("CUSTOMER_ID").cast("string"),
        }
    )


def add_revenue(sales: DataFrame) -> DataFrame:
    return sales.withColumn("REVENUE", F.col("QUANTITY") * F.col("PRICE"))


def quality_report(sales: DataFrame) -> DataFrame:
    """Count and percentage of negative and zero quantities and prices, in one scan."""
    checks = {
        "Negative Quantities": F.col("QUANTITY") < 0,
        "Negative Prices": F.col("PRICE") < 0,
        "Zero Quantities": F.col("QUANTITY") == 0,
        "Zero Prices": F.col("PRICE") == 0,
    }
    totals = sales.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(k) for k, c in checks.items()])
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("Check"), F.col(k).alias("Count")) for k in checks]))
    return totals.select("n", rows.alias("r")).select(
        "r.Check", "r.Count", F.round(amounts.ratio(F.col("r.Count"), F.col("n")) * 100, 2).alias("Percentage")
    )


def clean_invoice_parts(df: DataFrame, name: str) -> DataFrame:
    """Key clean-up that keeps NULL, plus the first digit run and the first letter run."""
    cleaned = df.withColumn(name, text.bare_key(F.col(name)))
    return cleaned.withColumns(
        {
            f"{name}_NUM": text.first_match(F.col(name), r"(?U)(\d+)"),
            f"{name}_ALPHA": text.first_match(F.col(name), r"([A-Za-z]+)"),
        }
    )


def clean_plain_description(df: DataFrame, name: str = "DESCRIPTION") -> DataFrame:
    return df.withColumn(name, text.plain_words(F.col(name)))


def description_clean(df: DataFrame, source: str = "DESCRIPTION_RAW", target: str = "DESCRIPTION_CLEAN") -> DataFrame:
    return df.withColumn(target, text.product_words(F.col(source)))
