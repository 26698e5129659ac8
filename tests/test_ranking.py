import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillwork.operators import ranking, rfm
from tillwork.session import stage


def pandas_quintile(values):
    s = pd.Series(values).rank(method="first")
    return [None if pd.isna(v) else int(v) + 1 for v in pd.qcut(s, q=5, labels=False, duplicates="drop")]


def test_rank_first_orders_ties_by_key(spark):
    rows = [(f"k{i:03d}", (i * 7) % 5) for i in range(200)]
    got = ranking.rank_first(spark.createDataFrame(rows, "k string, v int").repartition(7), "v", "k").collect()
    want = {k: r for r, (v, k) in enumerate(sorted((v, k) for k, v in rows), 1)}
    assert {r["k"]: r["RANK"] for r in got} == want


def test_rank_first_spreads_one_tied_value(spark):
    df = spark.range(20_000).select(F.lit(1).alias("v"), F.format_string("%06d", "id").alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = ranking.rank_first(df, "v", "k")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r["n"] for r in ranked.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) < 20_000
    assert ranked.filter(F.col("RANK") != F.col("k").cast("bigint") + 1).isEmpty()


@pytest.mark.parametrize("n", [2, 5, 6, 7, 11, 23])
def test_quintile_score_equals_pandas(spark, n):
    rng = np.random.default_rng(n)
    rows = [(f"k{i:03d}", int(v)) for i, v in enumerate(rng.integers(0, 4, n))]
    df = ranking.quintile_score(spark.createDataFrame(rows, "k string, v int"), "v", "k", "q")
    assert [r["q"] for r in df.orderBy("k").collect()] == pandas_quintile([v for _, v in rows])


def test_quintile_of_seven_ranks_and_of_one_row(spark):
    df = spark.range(1, 8).select(ranking.quintile_of_rank(F.col("id"), F.lit(7)).alias("q"))
    assert [r["q"] for r in df.collect()] == [1, 1, 2, 3, 4, 5, 5]
    one = spark.createDataFrame([("a", 1)], "k string, v int")
    assert ranking.quintile_score(one, "v", "k", "q").first()["q"] is None


def test_quintile_of_rank_equals_pandas_for_many_sizes(spark):
    sizes = range(2, 200)
    rows = [(n, r) for n in sizes for r in range(1, n + 1)]
    df = spark.createDataFrame(rows, "n bigint, r bigint").withColumn("q", ranking.quintile_of_rank(F.col("r"), F.col("n")))
    got = df.toPandas()
    for n in sizes:
        assert got[got.n == n].sort_values("r").q.tolist() == pandas_quintile(range(n))


@pytest.mark.parametrize("partitions", [1, 4, 60])
def test_exact_quantiles(spark, partitions):
    rng = np.random.default_rng(1)
    a = rng.normal(size=997).round(2).tolist()
    b = [0.0] * 600 + rng.exponential(size=397).tolist()
    rows = [(x, y if i % 10 else None) for i, (x, y) in enumerate(zip(a, b))]
    probs = [0.0, 0.25, 0.5, 0.95, 1.0]
    df = spark.createDataFrame(rows, "a double, b double").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        got = ranking.exact_quantiles(df, ["a", "b"], probs)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    frame = pd.DataFrame(rows, columns=["a", "b"])
    for c in ("a", "b"):
        assert got[c] == pytest.approx([frame[c].quantile(p) for p in probs], abs=1e-12)


def test_positions_do_not_depend_on_the_number_of_partitions(spark):
    """20,000 partitions before this one: the plan holds none of them."""
    sizes = spark.range(20_000).select(F.col("id").cast("int").alias("_part"), F.lit(3).alias("n"))
    before = stage(ranking.offsets(sizes))
    parts = spark.createDataFrame([("a",), ("b",)], "k string").coalesce(1).withColumn("_part", F.lit(19_999))
    start = time.monotonic()
    got = ranking.positions(parts, before, "RANK")
    assert len(got._jdf.queryExecution().optimizedPlan().toString()) < 3000
    assert [r["RANK"] for r in got.orderBy("k").collect()] == [3 * 19_999 + 1, 3 * 19_999 + 2]
    assert time.monotonic() - start < 10


def test_quintiles_of_ties_over_many_partitions(spark):
    rows = [(f"k{i:04d}", 1 if i % 3 else i % 7, float(i // 400)) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, v int, w double").repartition(9)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = ranking.quintile_scores(df, {"v": "a", "w": "b"}, "k").orderBy("k").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [r["a"] for r in got] == pandas_quintile([r[1] for r in rows])
    assert [r["b"] for r in got] == pandas_quintile([r[2] for r in rows])


def test_exact_quantiles_of_nothing(spark):
    assert ranking.exact_quantiles(spark.createDataFrame([(None,)], "a double"), ["a"], [0.5]) == {"a": [None]}


def test_rfm_against_pandas(spark):
    rng = np.random.default_rng(3)
    n = 400
    frame = pd.DataFrame(
        {
            "CUSTOMER_ID": rng.integers(0, 37, n).astype(str),
            "INVOICE": rng.integers(0, 90, n).astype(str),
            "INVOICE_DATE": pd.to_datetime("2010-01-01") + pd.to_timedelta(rng.integers(0, 300, n), unit="D"),
            "QUANTITY": rng.integers(1, 9, n),
            "PRICE": (rng.integers(50, 900, n) / 100.0),
        }
    )
    frame["REVENUE"] = frame.QUANTITY * frame.PRICE
    text = frame.assign(INVOICE_DATE=frame.INVOICE_DATE.dt.strftime("%Y-%m-%d"))
    got = rfm.rfm_scores(rfm.rfm_derived(rfm.rfm_metrics(spark.createDataFrame(text)))).toPandas()
    got = got.sort_values("CUSTOMER_ID").reset_index(drop=True)
    g = frame.groupby("CUSTOMER_ID")
    end = frame.INVOICE_DATE.max() + pd.Timedelta(days=1)
    want = pd.DataFrame(
        {
            "RECENCY": (end - g.INVOICE_DATE.max()).dt.days,
            "TENURE": (g.INVOICE_DATE.max() - g.INVOICE_DATE.min()).dt.days,
            "FREQUENCY": g.INVOICE.nunique(),
            "TOTAL_REVENUE": g.REVENUE.sum(),
            "AVG_ORDER_VALUE": g.REVENUE.mean(),
            "AVG_BASKET_SIZE": g.QUANTITY.mean(),
        }
    ).reset_index()
    for c in want.columns[1:]:
        assert got[c].tolist() == pytest.approx(want[c].tolist())
    r = [6 - q for q in pandas_quintile(want.RECENCY)]
    f, m = pandas_quintile(want.FREQUENCY), pandas_quintile(want.TOTAL_REVENUE.round(4))
    assert got.RFM_SCORE.tolist() == [f"{x}{y}{z}" for x, y, z in zip(r, f, m)]
