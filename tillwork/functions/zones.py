"""UTC offset of a named time zone at a given instant."""

from __future__ import annotations

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F


def utc_offset(at: Column, zone: Column) -> Column:
    """`+HHMM` of the zone at the timestamp `at`; NULL for an unknown or missing zone.

    Known are the zones of the Java runtime, which is what computes the offset; the system's own list plays no part.
    """
    zones = SparkContext._active_spark_context._jvm.java.time.ZoneId.getAvailableZoneIds()
    known = zone.isin(sorted(zones))
    seconds = F.when(known, F.unix_seconds(F.from_utc_timestamp(at, zone)) - F.unix_seconds(at))
    minutes = F.abs(seconds).cast("bigint") / F.lit(60)
    hours = F.floor(minutes / F.lit(60))
    rest = F.floor(minutes) % F.lit(60)
    sign = F.when(seconds < 0, F.lit("-")).otherwise(F.lit("+"))
    text = F.concat(sign, F.lpad(hours.cast("string"), 2, "0"), F.lpad(rest.cast("string"), 2, "0"))
    return F.when(known, text)
