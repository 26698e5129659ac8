"""Queries on the exploration bundles: what was written is read back and compared row by row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork import schemas
from tillwork.plans import exploration
from tillwork.plans import sample_tables as given
from tillwork.plans import steps, views
from tillwork.plans.oracle_parts import bare, with_parts
from tillwork.plans.queries_silver import KEEP, LISTS, REMOVE
from tillwork.plans.registry import query
from tillwork.session import scratch_path
from tillwork.sources.files import read_csv
from tillwork.sources.warehouse import Warehouse


def _read_back(spark, paths: dict[str, str], columns: dict[str, str]) -> DataFrame:
    """(report, line): the named columns of the written reports, joined."""
    parts = [
        read_csv(spark, paths[name]).select(F.lit(name).alias("report"), F.concat_ws("|", *listed.split()).alias("line"))
        for name, listed in columns.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _lines(report: str, listed: str, source: str) -> str:
    return f"SELECT '{report}' AS report, concat_ws('|', {', '.join(listed.split())}) AS line FROM {source}"


_BRONZE = {
    "RETURN": "INVOICE INVOICE_NUM INVOICE_ALPHA STOCKCODE DESCRIPTION QUANTITY COUNTRY",
    "SALES": "INVOICE INVOICE_NUM INVOICE_ALPHA STOCKCODE DESCRIPTION QUANTITY COUNTRY",
    "DESC_COUNT_STOCKCODE": "STOCKCODE PRICE DESCRIPTION",
    "DESC_NAME_STOCKCODE": "STOCKCODE DESCRIPTION",
    "DESC_COUNT_PER_CODE_COUNTRY": "STOCKCODE COUNTRY PRICE DESCRIPTION",
    "MISSING_RATES": "COL NULL_RATE",
    "COL_LIST": "VALUES",
}
_CLEAN = f"""(SELECT {bare('INVOICE')} AS INVOICE, nullif(regexp_extract({bare('INVOICE')}, '([0-9]+)', 1), '') AS INVOICE_NUM,
  nullif(regexp_extract({bare('INVOICE')}, '([A-Za-z]+)', 1), '') AS INVOICE_ALPHA, {bare('STOCKCODE')} AS STOCKCODE,
  {bare("regexp_replace(DESCRIPTION, '[^0-9a-zA-Z ]+', ' ', 'g')")} AS DESCRIPTION, QUANTITY, COUNTRY, PRICE FROM raw)"""
_COUNTS = "count(DISTINCT PRICE) AS PRICE, count(DISTINCT DESCRIPTION) AS DESCRIPTION"
_IS_RETURN = "(QUANTITY < 0 OR regexp_matches(INVOICE, '[A-Za-z]'))"
_RAW_COLUMNS = ("INVOICE", "STOCKCODE", "DESCRIPTION", "QUANTITY", "INVOICEDATE", "PRICE", "CUSTOMER_ID", "COUNTRY")


@query(
    "bronze_exploration",
    with_parts(
        "raw",
        "\nUNION ALL ".join(
            [
                _lines("RETURN", _BRONZE["RETURN"], f"{_CLEAN} WHERE {_IS_RETURN}"),
                _lines("SALES", _BRONZE["SALES"], f"{_CLEAN} WHERE NOT {_IS_RETURN}"),
                _lines("DESC_COUNT_STOCKCODE", _BRONZE["DESC_COUNT_STOCKCODE"], f"(SELECT STOCKCODE, {_COUNTS} FROM {_CLEAN} GROUP BY STOCKCODE)"),
                _lines("DESC_NAME_STOCKCODE", _BRONZE["DESC_NAME_STOCKCODE"], f"(SELECT DISTINCT STOCKCODE, DESCRIPTION FROM {_CLEAN})"),
                _lines("DESC_COUNT_PER_CODE_COUNTRY", _BRONZE["DESC_COUNT_PER_CODE_COUNTRY"],
                       f"(SELECT STOCKCODE, COUNTRY, {_COUNTS} FROM {_CLEAN} GROUP BY STOCKCODE, COUNTRY)"),
                *(_lines("MISSING_RATES", f"'{c}' rate", f"(SELECT round(CAST(count(*) - count({c}) AS DOUBLE) / count(*) * 100, 2) AS rate FROM raw)") for c in _RAW_COLUMNS),
                *(f"SELECT 'COL_LIST', '{c}'" for c in _RAW_COLUMNS),
            ]
        ),
    ),
)
def bronze_exploration(spark, d):
    wh, landing = Warehouse(spark, scratch_path(spark, "wh")), scratch_path(spark, "landing")
    given.land(given.text_sales(spark, d), landing, "online retail")
    steps.load_bronze(wh, landing)
    return _read_back(spark, exploration.explore_bronze(wh, scratch_path(spark, "reports")), _BRONZE)


_SILVER = {
    "COUNTRIES": "COUNTRY",
    "DESC_UNIQUE": "DESCRIPTION",
    "DESC_PER_CODE": "STOCKCODE DESCRIPTION",
    "DESC_COUNT_PER_CODE": "STOCKCODE PRICE DESCRIPTION",
    "DESC_COUNT_PER_CODE_COUNTRY": "STOCKCODE COUNTRY PRICE DESCRIPTION",
    "CODE_COUNT_PER_DESC": "DESCRIPTION STOCKCODE PRICE",
    "CHECK_FAULTY_DESCRI_CODE": "INVOICE STOCKCODE DESCRIPTION QUANTITY CUSTOMER_ID",
    "CUSTOMER_MULTI_COUNTRIES": "CUSTOMER_ID COUNTRY",
    "FULLFILL_RATES": "COL FILL_RATE",
}
_SILVER_COLUMNS = [n for n, _ in schemas.columns(schemas.SILVER_SALES)]


@query(
    "silver_exploration",
    with_parts(
        "silver",
        "\nUNION ALL ".join(
            [
                _lines("COUNTRIES", "COUNTRY", "(SELECT DISTINCT COUNTRY FROM silver)"),
                _lines("DESC_UNIQUE", "DESCRIPTION", "(SELECT DISTINCT DESCRIPTION FROM silver)"),
                _lines("DESC_PER_CODE", _SILVER["DESC_PER_CODE"], "(SELECT DISTINCT STOCKCODE, DESCRIPTION FROM silver)"),
                _lines("DESC_COUNT_PER_CODE", _SILVER["DESC_COUNT_PER_CODE"], f"(SELECT STOCKCODE, {_COUNTS} FROM silver GROUP BY STOCKCODE)"),
                _lines("DESC_COUNT_PER_CODE_COUNTRY", _SILVER["DESC_COUNT_PER_CODE_COUNTRY"],
                       f"(SELECT STOCKCODE, COUNTRY, {_COUNTS} FROM silver GROUP BY STOCKCODE, COUNTRY)"),
                _lines("CODE_COUNT_PER_DESC", _SILVER["CODE_COUNT_PER_DESC"],
                       "(SELECT DESCRIPTION, count(DISTINCT STOCKCODE) AS STOCKCODE, count(DISTINCT PRICE) AS PRICE FROM silver GROUP BY DESCRIPTION)"),
                _lines("CHECK_FAULTY_DESCRI_CODE", _SILVER["CHECK_FAULTY_DESCRI_CODE"], "silver"),
                _lines("CUSTOMER_MULTI_COUNTRIES", _SILVER["CUSTOMER_MULTI_COUNTRIES"],
                       "(SELECT DISTINCT CUSTOMER_ID, COUNTRY FROM silver WHERE CUSTOMER_ID IN (SELECT CUSTOMER_ID FROM silver GROUP BY 1 HAVING count(DISTINCT COUNTRY) > 1))"),
                *(f"SELECT 'FULLFILL_RATES', '{c}|' || '100.0'" for c in _SILVER_COLUMNS),
            ]
        ),
    ),
)
def silver_exploration(spark, d):
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    wh.write_batch("SILVER", "SALES", views.silver(spark, d), "1", schemas.SILVER_SALES)
    return _read_back(spark, exploration.explore_silver(wh, scratch_path(spark, "reports")), _SILVER)


_STEP_REPORTS = {
    "silver_country_mapping": {"COUNTRY_MAPPING": "COUNTRY_RAW COUNTRY_STANDARDIZED COUNTRY_CONFIDENCE CONTINENT CAPITAL ISO3 CURRENCY TIMEZONE"},
    "silver_pair_currency_date": {"DATE_EXCHANGE_RATE": "INVOICE_DATE CURRENCY"},
    "silver_pair_code_product": {"PRODUCT_AND_CODE": "STOCKCODE DESCRIPTION_RAW PRODUCT_NAME", "COUNT_PRODUCT_PER_CODE": "STOCKCODE COUNT_PRODUCT_PER_CODE"},
}


@query(
    "silver_step_reports",
    with_parts(
        f"countries pair_rates {LISTS}",
        "\nUNION ALL ".join(
            [
                _lines("COUNTRY_MAPPING", _STEP_REPORTS["silver_country_mapping"]["COUNTRY_MAPPING"], "countries"),
                _lines("DATE_EXCHANGE_RATE", "INVOICE_DATE CURRENCY", "pair_rates"),
                _lines("PRODUCT_AND_CODE", "STOCKCODE DESCRIPTION_RAW PRODUCT_NAME", LISTS),
                _lines("COUNT_PRODUCT_PER_CODE", "STOCKCODE n", f"(SELECT STOCKCODE, count(DISTINCT PRODUCT_NAME) AS n FROM {LISTS} GROUP BY STOCKCODE)"),
            ]
        ),
    ),
)
def silver_step_reports(spark, d):
    """What the Silver steps export: the whole tables after two loads."""
    wh, reports = Warehouse(spark, scratch_path(spark, "wh")), scratch_path(spark, "reports")
    sales, (first, second) = views.silver(spark, d), given.rate_references(spark, d)
    early = F.coalesce(F.crc32("DESCRIPTION") % 10 != 0, F.lit(True))
    for batch, part in (("1", sales.filter(early)), ("2", sales.filter(~early))):
        wh.write_batch("SILVER", "SALES", part, batch, schemas.SILVER_SALES)
        steps.load_country(wh, given.country_reference(spark, d), views.AT, reports=reports)
        steps.load_rates(wh, first, second, reports=reports)
        steps.load_products(wh, reports=reports, keep=KEEP, remove=REMOVE)
    return reduce(
        DataFrame.unionByName,
        [_read_back(spark, {n: f"{reports}/{bundle}/{n}" for n in listed}, listed) for bundle, listed in _STEP_REPORTS.items()],
    )


@query(
    "gold_exploration",
    with_parts(
        "fact countries pair_rates customer_rfm",
        "\nUNION ALL ".join(
            [
                _lines("GOLD_SALES", "INVOICE STOCKCODE QUANTITY COUNTRY_ID PRODUCT_ID", "fact"),
                _lines("GOLD_COUNTRY_METADATA", "COUNTRY_STANDARDIZED CONTINENT ISO3", "countries"),
                _lines("GOLD_EXCHANGE_RATE", "INVOICE_DATE CURRENCY", "pair_rates"),
                _lines("GOLD_CUSTOMER_RFM", "CUSTOMER_ID RECENCY TENURE FREQUENCY", "customer_rfm"),
            ]
        ),
    ),
)
def gold_exploration(spark, d):
    wh, folder = Warehouse(spark, scratch_path(spark, "wh")), scratch_path(spark, "reports")
    wh.write_batch("SILVER", "SALES", views.silver(spark, d), "1", schemas.SILVER_SALES)
    steps.load_country(wh, given.country_reference(spark, d), views.AT)
    steps.load_rates(wh, *given.rate_references(spark, d))
    steps.load_products(wh)
    steps.load_gold(wh)
    steps.load_rfm(wh)
    listed = {
        "GOLD_SALES": "INVOICE STOCKCODE QUANTITY COUNTRY_ID PRODUCT_ID", "GOLD_COUNTRY_METADATA": "COUNTRY_STANDARDIZED CONTINENT ISO3",
        "GOLD_EXCHANGE_RATE": "INVOICE_DATE CURRENCY", "GOLD_CUSTOMER_RFM": "CUSTOMER_ID RECENCY TENURE FREQUENCY",
    }
    return _read_back(spark, exploration.explore_gold(wh, folder), listed)
