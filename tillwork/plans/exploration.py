"""Exploration bundles of the three layers, written as report folders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from tillwork.operators import cleaning, explore, profiling
from tillwork.plans.steps import BRONZE_SALES, EVENT_DATE, bronze_lines
from tillwork.session import stage
from tillwork.sources.files import SOURCE_FILE
from tillwork.sources.reports import export_reports
from tillwork.sources.warehouse import BATCH, Warehouse

#: Report names of the Gold tables.
GOLD_REPORTS = {
    "Gold sales": "GOLD_FACT_SALES",
    "Gold country metadata": "GOLD_DIM_COUNTRY",
    "Gold product mapping": "GOLD_DIM_PRODUCT",
    "Gold exchange rate": "GOLD_DIM_EXCHANGE_RATE",
    "Gold rfm mapping rate": "GOLD_DIM_RFM_MAPPING",
    "Gold customer rfm": "GOLD_DIM_CUSTOMER_RFM",
}


def explore_bronze(wh: Warehouse, folder: str) -> dict[str, str]:
    """Profile of the raw sales lines, and returns, sales and descriptions after a first clean-up."""
    parts = [bronze_lines(wh, name).drop(BATCH, SOURCE_FILE, EVENT_DATE) for name in wh.tables(BRONZE_SALES)]
    raw = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return export_reports(wh.spark, profiling.profile_all(raw, raw.columns) | bronze_details(raw), folder, "bronze_data_exploration")


def bronze_details(raw: DataFrame) -> dict[str, DataFrame]:
    cleaned = cleaning.clean_invoice_parts(cleaning.clean_invoice_parts(raw, "INVOICE"), "STOCKCODE")
    cleaned = cleaning.coerce_numeric(cleaning.clean_plain_description(cleaned), {"QUANTITY": "bigint"})
    cleaned = stage(cleaned, "bronze-clean")
    returns, sales = explore.split_returns_sales(cleaned)
    return {
        "Return": returns,
        "Sales": sales,
        "Desc_count_stockcode": explore.description_count_per_code(cleaned, flags=False),
        "Desc_name_stockcode": explore.descriptions_per_code(cleaned),
        "Desc_count_per_code_country": explore.description_count_per_code_country(cleaned, flags=False),
    }


def explore_silver(wh: Warehouse, folder: str) -> dict[str, str]:
    """Profile of the clean sales lines, and what looks odd in codes, descriptions, prices and countries."""
    sales = wh.read("SILVER_SALES")
    return export_reports(wh.spark, profiling.profile_all(sales, sales.columns) | silver_details(sales), folder, "silver_data_exploration")


def silver_details(sales: DataFrame) -> dict[str, DataFrame]:
    per_code, per_name = explore.description_count_per_code(sales), explore.code_count_per_description(sales)
    return {
        "Countries": explore.unique_countries(sales),
        "Desc unique": explore.unique_descriptions(sales),
        "Desc per code": explore.descriptions_per_code(sales),
        "Desc count per code": per_code,
        "Desc count per code country": explore.description_count_per_code_country(sales),
        "Code count per desc": per_name,
        "Check faulty descri code": explore.faulty_descriptions(sales, per_code, per_name),
        "Customer Multi Countries": explore.multi_country_customers(sales),
    }


def explore_gold(wh: Warehouse, folder: str) -> dict[str, str]:
    """The Gold tables that exist, whole."""
    tables = {name: wh.read(table) for name, table in GOLD_REPORTS.items() if wh.exists(table)}
    return export_reports(wh.spark, tables, folder, "gold_layers")
