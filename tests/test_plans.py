"""What the physical plans look like where it matters at scale."""

import pytest
from pyspark.sql import functions as F

from tillwork.operators import cltv_features, explore, incremental, profiling, ranking, rfm, star
from tillwork.plans import sample_tables as given
from tillwork.plans import steps, views
from tillwork.session import scratch_path
from tillwork.sources.warehouse import BATCH, Warehouse

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark):
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    sales = views.silver(spark, SF)
    wh.overwrite("S", "SALES", sales)
    wh.overwrite("S", "COUNTRY", views.countries_of(spark, SF, wh.read("S_SALES")))
    wh.overwrite("S", "PRODUCT", wh.read("S_SALES").select("STOCKCODE", F.col("DESCRIPTION").alias("DESCRIPTION_RAW")).distinct())
    return wh


def test_small_stored_dimensions_are_broadcast_and_large_ones_are_not(spark, stored):
    parts = stored.read("S_SALES"), stored.read("S_COUNTRY"), stored.read("S_PRODUCT")
    text = plan(star.fact_sales(*parts))
    assert text.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in text
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(star.fact_sales(*parts))
        assert text.count("SortMergeJoin") == 2 and "BroadcastHashJoin" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64MB")


def test_fact_reads_only_the_key_columns_of_the_product_dimension(stored):
    text = plan(star.fact_sales(stored.read("S_SALES"), stored.read("S_COUNTRY"), stored.read("S_PRODUCT")))
    assert "ReadSchema: struct<COUNTRY_RAW:string>" in text


def test_no_cross_join_and_no_global_window(spark, stored):
    sales = stored.read("S_SALES").withColumn("REVENUE", F.col("QUANTITY") * F.col("PRICE"))
    sales = sales.withColumn("YEAR_MONTH", F.substring("INVOICE_DATE", 1, 7))
    frames = {
        "metrics": rfm.rfm_metrics(sales),
        "features": cltv_features.time_features(sales),
        "formula": rfm.cltv_formula(sales),
        "rank": ranking.rank_first(sales.select("PRICE", "INVOICE"), "PRICE", "INVOICE"),
        "faulty": explore.faulty_descriptions(sales, explore.description_count_per_code(sales), explore.code_count_per_description(sales)),
        "share": profiling.profile_value_share(sales),
        "histogram": profiling.profile_histogram(sales),
        "antijoin": incremental.incr_key_antijoin(sales.select("COUNTRY"), sales.select("COUNTRY"), ["COUNTRY"]),
    }
    for name, df in frames.items():
        text = plan(df)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
        assert "Window [" not in text or name == "share", name


def test_value_share_limits_groups_before_the_shuffle(stored):
    text = plan(profiling.profile_value_share(stored.read("S_SALES")))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_stored_lines_are_pruned_by_month_and_batch(spark):
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    lines = steps.keyed_lines(steps.with_event_date(given.text_sales(spark, SF))).select(steps.EVENT_DATE, steps.LINE)
    wh.write_batch("SILVER", "SALES_LINES", lines, "000000000001")
    few = lines.filter("EVENT_DATE BETWEEN '1995-02-03' AND '1995-03-09' OR EVENT_DATE LIKE '1997-11%'")
    stored = wh.read_batches("SILVER_SALES_LINES").filter(F.col(BATCH) < "b_000000000009")
    text = plan(incremental.unseen_lines(few, stored, steps.EVENT_DATE, steps.LINE))
    assert "GreaterThanOrEqual(EVENT_DATE,1995-02),LessThanOrEqual(EVENT_DATE,1995-03-99)" in text
    assert "PartitionFilters: [isnotnull(LOAD_BATCH" in text
    assert "ReadSchema: struct<EVENT_DATE:string,LINE:binary>" in text


def test_distinct_invoices_of_one_customer_are_spread(stored):
    sales = stored.read("S_SALES").withColumn("REVENUE", F.col("PRICE"))
    assert "hashpartitioning(CUSTOMER_ID" in plan(rfm.rfm_metrics(sales))
    assert any("hashpartitioning(CUSTOMER_ID" in line and "INVOICE#" in line for line in plan(rfm.rfm_metrics(sales)).splitlines())
