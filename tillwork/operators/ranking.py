"""Ranks, quintiles and quantiles over a whole table without a one-partition window.

Rows, or values with the number of rows that have them, are dealt by a range shuffle on a total order and checkpointed.
A position is then the sum of the partitions before, from a small table with one row per partition that is joined on
the partition's number, plus the place inside the partition. Nothing about single partitions is put into an
expression or brought to the driver, so plans and driver work are the same for ten partitions and for many thousands.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import Window

from tillwork.session import cut_lineage, stage

_PLACE_BITS = 33
_PART = "_part"


def offsets(sizes: DataFrame, *group: str) -> DataFrame:
    """(group, _part, before): what comes before a partition, from (group, _part, n). One row per partition."""
    earlier = Window.partitionBy(*group).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(*group, _PART, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))


def _dealt(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Sorted rows with the number of their partition; both stay as they are however often they are read."""
    return cut_lineage(df.orderBy(*order)).withColumn(_PART, F.spark_partition_id())


def positions(parts: DataFrame, before: DataFrame, name: str) -> DataFrame:
    """Adds the 1-based position over all partitions. The measured size of `before` decides how it is joined."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    numbered = parts.withColumn("_place", place)
    return numbered.join(before, _PART).withColumn(name, F.col("before") + F.col("_place") + 1).drop(_PART, "_place", "before")


def rank_first(df: DataFrame, value: str, tiebreak: str, name: str = "RANK") -> DataFrame:
    """Rank 1..n ascending by `value`, ties in order of the unique column `tiebreak`."""
    parts = _dealt(df, [value, tiebreak])
    before = stage(offsets(parts.groupBy(_PART).agg(F.count(F.lit(1)).alias("n"))), "offsets")
    return positions(parts, before, name)


def quintile_of_rank(rank: Column, n: Column) -> Column:
    """Quintile of a rank where the cuts interpolate between ranks; NULL for a single row."""
    steps = F.floor((F.lit(5) * (rank - 1) + (n - 1) - 1) / F.nullif(n - 1, F.lit(0)))
    return F.when(n > 1, F.greatest(F.lit(1).cast("bigint"), steps)).cast("int")


def at_ranks(counted: DataFrame, wanted: DataFrame) -> DataFrame:
    """(name, rank, value, within): the value at each wanted 0-based rank, and the rank among rows of that value.

    `counted` has one row (name, value, n) per distinct value, `wanted` is a small table (name, rank). The values are
    sorted once for all names; running sums are built only in the pieces that hold a wanted rank.
    """
    parts = _dealt(counted, ["name", "value"])
    sizes = parts.groupBy("name", _PART).agg(F.sum("n").alias("n"))
    pieces = sizes.join(offsets(sizes, "name"), ["name", _PART])
    inside = (F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("n"))
    pieces = stage(pieces.join(wanted, "name").filter(inside).select("name", _PART, "before", "rank"), "pieces")
    # Each window group is one name's share of one range partition.
    upto = Window.partitionBy("name", _PART).orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = parts.join(pieces.select("name", _PART).distinct(), ["name", _PART], "left_semi")
    held = held.withColumn("upto", F.sum("n").over(upto)).join(pieces, ["name", _PART])
    within = F.col("rank") - F.col("before") - F.col("upto") + F.col("n")
    return held.withColumn("within", within).filter("within >= 0 AND within < n").select("name", "rank", "value", "within")


def quintile_cuts(df: DataFrame, values: Sequence[str], tiebreak: str) -> dict[str, list[Row]]:
    """Last row (value, tiebreak) of quintiles 1 to 4 in rank order, per column; without columns that have no two rows.

    Counted values give the value of each cut and the place among its ties; only the rows that share such a value are
    sorted by the tiebreak. NULL comes first.
    """
    long = df.select(*[F.col(v).cast("double").alias(v) for v in values], F.col(tiebreak).alias("tiebreak"))
    long = long.unpivot(["tiebreak"], list(values), "name", "value")
    counted = long.groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))
    counted = stage(counted, "counted")
    total = counted.groupBy("name").agg(F.sum("n").alias("total")).filter("total > 1")
    quarter = F.explode(F.sequence(F.lit(1), F.lit(4))).alias("q")
    wanted = total.select("name", "total", quarter).selectExpr("name", "q", "q * (total - 1) div 5 AS rank")
    wanted = stage(wanted, "wanted-ranks")
    cuts = stage(at_ranks(counted, wanted.select("name", "rank").distinct()), "cuts")
    same = F.struct("name", "value")
    tied = long.join(cuts.select("name", "value").distinct().withColumnsRenamed({"name": "_n", "value": "_v"}),
                     (F.col("name") == F.col("_n")) & F.col("value").eqNullSafe(F.col("_v")), "left_semi")
    parts = _dealt(tied, ["name", "value", "tiebreak"]).withColumn("key", same)
    sizes = parts.groupBy("key", _PART).agg(F.count(F.lit(1)).alias("n"))
    pieces = sizes.join(offsets(sizes, "key"), ["key", _PART])
    pieces = pieces.join(cuts.select(same.alias("_key"), "rank", "within"), F.col("key").eqNullSafe(F.col("_key")))
    inside = (F.col("within") >= F.col("before")) & (F.col("within") < F.col("before") + F.col("n"))
    pieces = stage(pieces.filter(inside).select("key", _PART, "rank", (F.col("within") - F.col("before") + 1).alias("place")), "tied-pieces")
    inner = Window.partitionBy("name", "value", _PART).orderBy("tiebreak")
    pieces = pieces.select(F.col("key").alias("_key"), F.col(_PART).alias("_p"), "rank", "place")
    here = F.col("key").eqNullSafe(F.col("_key")) & (F.col(_PART) == F.col("_p"))
    held = parts.join(pieces.select("_key", "_p").distinct(), here, "left_semi").withColumn("at", F.row_number().over(inner))
    rows = held.join(pieces, here & (F.col("at") == F.col("place"))).join(wanted, ["name", "rank"]).select("name", "q", "value", "tiebreak")
    found: dict[str, list[Row]] = {}
    for r in rows.orderBy("name", "q").collect():  # four per column
        found.setdefault(r["name"], []).append(r)
    return found


def _score_by_cuts(cuts: list[Row] | None, value: str, tiebreak: str) -> Column:
    """1 plus the number of cut rows that come before this row."""
    if cuts is None:
        return F.lit(None).cast("int")
    v, t = F.col(value).cast("double"), F.col(tiebreak)
    score = F.lit(1)
    for c in cuts:
        after = (v > F.lit(c["value"])) | ((v == F.lit(c["value"])) & (t > F.lit(c["tiebreak"])))
        score = score + F.coalesce(after, F.lit(False)).cast("int")
    return score


def quintile_scores(df: DataFrame, scores: Mapping[str, str], tiebreak: str) -> DataFrame:
    """Quintiles 1..5 of several numeric columns, `scores` maps column to score name; values count as doubles.

    Four cut rows per column are compared in place. Finding them reads `df` twice, so pass a stored or checkpointed one.
    """
    cuts = quintile_cuts(df, list(scores), tiebreak)
    return df.withColumns({name: _score_by_cuts(cuts.get(v), v, tiebreak) for v, name in scores.items()})


def quintile_score(df: DataFrame, value: str, tiebreak: str, name: str) -> DataFrame:
    return quintile_scores(df, {value: name}, tiebreak)


def exact_quantiles(df: DataFrame, names: Sequence[str], probs: Sequence[float]) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of several numeric columns, exact, in one sort of distinct values.

    Equal values collapse to one counted row on the map side, so a value shared by many rows is one row, and hot values
    cost nothing. NULL and NaN do not count. The driver gets two values per quantile.
    """
    cast = df.select(*[F.nanvl(F.col(n).cast("double"), F.lit(None)).alias(n) for n in names])
    long = cast.unpivot([], list(names), "name", "value").filter(F.col("value").isNotNull())
    counted = stage(long.groupBy("name", "value").agg(F.count(F.lit(1)).alias("n")), "counted")
    ends = [F.struct(F.lit(k).alias("k"), F.lit(p).alias("p")) for k, p in enumerate(probs)]
    asked = counted.groupBy("name").agg(F.sum("n").alias("total")).select("name", "total", F.inline(F.array(*ends)))
    asked = asked.withColumn("at", (F.col("total") - 1) * F.col("p"))
    asked = stage(asked.select("name", "k", "at", F.floor("at").alias("low"), F.ceil("at").alias("high")), "asked")
    wanted = asked.select("name", F.explode(F.array("low", "high")).alias("rank")).distinct()
    found = stage(at_ranks(counted, wanted), "values")
    low = found.select("name", F.col("rank").alias("low"), F.col("value").alias("a"))
    high = found.select("name", F.col("rank").alias("high"), F.col("value").alias("b"))
    between = asked.join(low, ["name", "low"]).join(high, ["name", "high"])
    between = between.withColumn("value", F.expr("a + (b - a) * (at - low)"))
    result: dict[str, list[float | None]] = {n: [None] * len(probs) for n in names}
    for r in between.select("name", "k", "value").collect():
        result[r["name"]][r["k"]] = r["value"]
    return result
