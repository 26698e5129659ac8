"""Names of columns, tables and reports."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def clean_name(name: str) -> str:
    """Strip, upper-case, every run of non-word characters to one underscore."""
    return re.sub(r"\W+", "_", name.strip().upper())


def clean_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean_name(c) for c in df.columns])


def table_name(layer: str, table: str) -> str:
    return f"{clean_name(layer)}_{clean_name(table)}"


def report_name(name: str) -> str:
    return clean_name(name)
