"""High-water marks, change gates and key-wise increments."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def incr_timestamp_filter(df: DataFrame, name: str, last_value: str | None, date: str | None = None) -> DataFrame:
    """Rows whose event time is after the mark; NULL times never pass. No mark keeps everything.

    Parquet keeps no usable statistics for wall-clock timestamps, so a stored text date of the same
    event, when there is one, is compared as well: that comparison skips row groups.
    """
    if last_value is None:
        return df
    kind = df.schema[name].dataType.simpleString()
    later = F.col(name) > F.lit(last_value).cast(kind)
    if date is not None:
        later = (F.col(date) >= F.lit(last_value[:10])) & later
    return df.filter(later)


def incr_key_antijoin(new: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `new` whose key is not in `known`; NULL keys equal each other."""
    right = known.select(*[F.col(k).alias(f"_known_{k}") for k in keys]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_known_{k}")) for k in keys])
    return new.join(right, same, "left_anti")


def line_key(columns: Sequence[str]) -> Column:
    """128-bit key of a whole row, the same whatever the order of its columns; a missing column counts as NULL."""
    return F.unhex(F.md5(F.to_json(F.struct(*sorted(columns)))))


def month_ranges(months: Sequence[str], most: int = 64) -> list[tuple[str, str]]:
    """At most `most` ranges (first, last) of sorted month texts that hold all of them; the smallest gaps are closed.

    They only narrow what a scan opens: rows inside a range still have to match.
    """
    known = sorted(set(months))
    steps = [(_month_number(b) - _month_number(a), i) for i, (a, b) in enumerate(zip(known, known[1:]))]
    cuts = sorted(i for gap, i in sorted(steps, reverse=True)[: most - 1] if gap > 1)
    ends = [-1, *cuts, len(known) - 1]
    return [(known[a + 1], known[b]) for a, b in zip(ends, ends[1:])] if known else []


def _month_number(month: str) -> int:
    year, _, number = month.rpartition("-")
    return int(year) * 12 + int(number)


def unseen_lines(new: DataFrame, stored: DataFrame, date: str, key: str) -> DataFrame:
    """The rows of `new`, each once, that `stored` lacks; only the stored lines of the months in `new` are read.

    Both have a text date (empty if unknown) and a row key. Both sides are dealt by the same two columns, so a hot
    date is spread over its keys.
    """
    months = [r[0] for r in new.select(F.substring(date, 1, 7).alias("m")).distinct().collect()]  # at most the calendar
    usual = [m for m in months if re.fullmatch("[0-9]{4}-[0-9]{2}", m)]
    near = F.substring(date, 1, 7).isin(sorted(set(months) - set(usual)))
    for first, last in month_ranges(usual):
        near = near | F.col(date).between(F.lit(first), F.lit(f"{last}-99"))
    return new.dropDuplicates([date, key]).join(stored.filter(near).select(date, key), [date, key], "left_anti")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The row with the largest `order` per key, by a mergeable aggregate instead of a window."""
    rest = [c for c in df.columns if c not in keys and c != order]
    picked = df.groupBy(*keys).agg(F.max(F.struct(order, *rest)).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def append_merge(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Existing and new rows together; the new row wins where both have the key."""
    both = existing.withColumn("_age", F.lit(0)).unionByName(new.withColumn("_age", F.lit(1)), allowMissingColumns=True)
    return latest_per_key(both, keys, "_age").drop("_age")


def max_value(df: DataFrame, name: str) -> DataFrame:
    """Largest value and row count: the two things a change gate looks at."""
    return df.agg(F.max(name).cast("string").alias("MAX_VALUE"), F.count(F.lit(1)).alias("ROW_COUNT"))


def maxvalue_gate(df: DataFrame, name: str, last_value: str | None) -> DataFrame:
    """One row telling whether the input moved past the mark."""
    changed = F.lit(True) if last_value is None else F.coalesce(F.col("MAX_VALUE") > F.lit(last_value), F.lit(False))
    return max_value(df, name).withColumn("CHANGED", changed)


def fingerprint(df: DataFrame) -> DataFrame:
    """Order-independent content fingerprint: row count and the sum of 32-bit row hashes."""
    row = F.xxhash64(*[F.col(c) for c in df.columns])
    return df.agg(
        F.count(F.lit(1)).alias("ROW_COUNT"),
        F.coalesce(F.sum(F.pmod(row, F.lit(1 << 32))), F.lit(0)).alias("ROW_HASH_SUM"),
    )


def merge_watermarks(existing: DataFrame, updates: DataFrame) -> DataFrame:
    """Upsert of marks: per name the row with the highest version; the clock only settles equal versions."""
    both = existing.unionByName(updates)
    rest = [c for c in both.columns if c not in ("table_name", "updated_at", "version")]
    picked = both.groupBy("table_name").agg(F.max(F.struct("version", "updated_at", *rest)).alias("_row"))
    return picked.select(
        "table_name", *[F.col(f"_row.{c}").alias(c) for c in both.columns if c != "table_name"]
    )
