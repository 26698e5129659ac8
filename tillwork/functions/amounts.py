"""Ratio and date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(top: Column, bottom: Column) -> Column:
    """Double division, NULL where the divisor is zero."""
    return top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))


def year_month(c: Column) -> Column:
    return F.substring(c, 1, 7)


def date_text(ts: Column) -> Column:
    return F.to_date(ts).cast("string")


def time_text(ts: Column) -> Column:
    return F.substring(ts.cast("string"), 12, 8)


def instant(ts: Column) -> Column:
    """Wall-clock time read as UTC, whatever the session time zone is."""
    wall = ts.cast("timestamp_ntz")
    days = F.unix_date(F.to_date(wall)).cast("bigint")
    return F.timestamp_seconds(days * 86_400 + F.hour(wall) * 3_600 + F.minute(wall) * 60 + F.second(wall))
