"""Country names and the facts joined to them."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.functions import fixed_values as fixed
from tillwork.functions import text
from tillwork.functions.zones import utc_offset

FACTS = ("CONTINENT", "CAPITAL", "ISO3", "CURRENCY", "TIMEZONE")


def _lookup(c: Column, pairs: dict[str, str]) -> Column:
    table = F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])
    return F.try_element_at(table, c)


def country_normalize(df: DataFrame, source: str = "COUNTRY_RAW", target: str = "COUNTRY_NORMALIZED") -> DataFrame:
    return df.withColumn(target, text.title_words(F.col(source)))


def country_resolve(df: DataFrame, source: str = "COUNTRY_RAW") -> DataFrame:
    """Standard name, and how it was found: INVALID, MAPPED or EXACT."""
    norm = text.title_words(F.col(source))
    mapped = _lookup(norm, fixed.COUNTRY_NAMES)
    return df.withColumns(
        {
            "COUNTRY_STANDARDIZED": F.coalesce(mapped, norm),
            "COUNTRY_CONFIDENCE": F.when(F.col(source).isNull(), "INVALID")
            .when(mapped.isNotNull(), "MAPPED")
            .otherwise("EXACT"),
        }
    )


def country_enrich(countries: DataFrame, reference: DataFrame, at: datetime | None = None) -> DataFrame:
    """Facts of each standard country, left-joined from a reference table.

    `reference` has NAME, CONTINENT, CAPITAL, ISO3, CURRENCY and ZONE, one row per name. `at` is the
    instant the UTC offset is taken for, now by default.
    """
    moment = F.timestamp_seconds(F.lit(int((at or datetime.now(timezone.utc)).timestamp())))
    facts = reference.dropDuplicates(["NAME"]).select(
        F.col("NAME").alias("_name"),
        "CONTINENT",
        "CAPITAL",
        "ISO3",
        "CURRENCY",
        utc_offset(moment, F.col("ZONE")).alias("TIMEZONE"),
    )
    standard = F.col("COUNTRY_STANDARDIZED")
    stand_in = F.coalesce(_lookup(standard, fixed.COUNTRY_PROXIES), standard)
    return countries.join(facts, stand_in == F.col("_name"), "left").drop("_name")


def new_country_metadata(countries: DataFrame, reference: DataFrame, at: datetime | None = None) -> DataFrame:
    """COUNTRY_RAW values to complete metadata rows."""
    return country_enrich(country_resolve(countries), reference, at)
