import pytest
from pyspark.sql import functions as F

from tillwork.operators import fxrates, incremental, star
from tillwork.session import scratch_path
from tillwork import session
from tillwork.sources import files, names, storage
from tillwork.sources.reports import export_reports, report_index
from tillwork.sources.warehouse import Warehouse
from tillwork.streaming.file_ingest import incr_file_ingest


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_antijoin_treats_null_as_a_value(spark):
    new = spark.createDataFrame([("d1", "EUR"), ("d1", None), ("d2", None)], "d string, c string")
    known = spark.createDataFrame([("d1", None), ("d3", "EUR")], "d string, c string")
    assert rows_of(incremental.incr_key_antijoin(new, known, ["d", "c"])) == [("d1", "EUR"), ("d2", None)]


def test_append_merge_new_wins_and_is_idempotent(spark):
    old = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    new = spark.createDataFrame([("b", 2), ("c", 2), (None, 3)], "k string, v int")
    once = incremental.append_merge(old, new, ["k"])
    assert rows_of(once) == rows_of(incremental.append_merge(once, new, ["k"]))
    assert rows_of(once) == [("a", 1), ("b", 2), ("c", 2), (None, 3)]


def test_timestamp_filter_drops_null_times(spark):
    df = spark.createDataFrame([("2010-01-01 00:00:00",), ("2010-01-01 00:00:01",), (None,)], "t string")
    df = df.select(F.col("t").cast("timestamp_ntz").alias("t"))
    assert incremental.incr_timestamp_filter(df, "t", "2010-01-01T00:00:00").count() == 1
    assert incremental.incr_timestamp_filter(df, "t", None).count() == 3


def test_gate_and_fingerprint(spark):
    df = spark.createDataFrame([("2010-01-01", 1), ("2010-01-05", 2)], "d string, v int")
    assert incremental.maxvalue_gate(df, "d", "2010-01-05").first()["CHANGED"] is False
    assert incremental.maxvalue_gate(df, "d", None).first()["CHANGED"] is True
    same = incremental.fingerprint(df.repartition(3)).first()
    assert same == incremental.fingerprint(df).first()
    assert same != incremental.fingerprint(df.withColumn("v", F.col("v") + 1)).first()


def test_watermarks(spark):
    wh = Warehouse(spark, scratch_path(spark, "t"))
    assert wh.get_watermark("a") is None
    wh.set_watermark("a", "1")
    wh.set_watermark("b", "x", "id")
    wh.set_watermark("a", "2")
    assert (wh.get_watermark("a"), wh.get_watermark("b")) == ("2", "x")
    assert rows_of(wh.watermarks().select("table_name", "watermark_type")) == [("a", "timestamp"), ("b", "id")]


def test_names(spark):
    assert names.clean_name(" Customer ID ") == "CUSTOMER_ID"
    assert names.table_name(" gold", "dim-country ") == "GOLD_DIM_COUNTRY"
    assert names.report_name("Desc count per code country and more") == "DESC_COUNT_PER_CODE_COUNTRY_AND_MORE"


def test_write_batch_replaces_only_its_batch(spark):
    wh = Warehouse(spark, scratch_path(spark, "t"))
    one = spark.createDataFrame([(1,)], "v int")
    assert not wh.exists("S_T")
    wh.write_batch("S", "T", one, "a")
    wh.write_batch("S", "T", one.union(one), "b")
    wh.write_batch("S", "T", one, "b")
    assert wh.exists("S_T") and wh.tables("S_") == ["S_T"]
    assert wh.batch_counts("S_T") == {"b_A": 1, "b_B": 1}


def test_infer_types(spark):
    rows = [("1", "1", "1.5", "a", None), ("2", None, "2", "1", None)]
    df = spark.createDataFrame(rows, "i string, inull string, f string, t string, e string")
    assert [r[1] for r in files.infer_types(df).collect()] == ["INTEGER", "REAL", "REAL", "TEXT", "REAL"]


def test_rates(spark):
    pairs = spark.createDataFrame([("2010-01-01", c) for c in ("GBP", "EUR", "USD", "JPY", None)], "INVOICE_DATE string, CURRENCY string")
    kind = "RATE_DATE string, CURRENCY string, RATE double"
    first = spark.createDataFrame([("2010-01-01", "EUR", 1.1)], kind)
    second = spark.createDataFrame([("2010-01-01", "EUR", 9.9), ("2010-01-01", "USD", 1.5)], kind)
    rates = fxrates.fx_rate_lookup(pairs, first, second)
    assert {r[1]: r[2] for r in rates.collect()} == {"GBP": 1.0, "EUR": 1.1, "USD": 1.5, "JPY": None, None: None}
    assert {r["CURRENCY"] for r in fxrates.fx_missing_report(rates).collect()} == {"JPY", None}


def test_fact_keeps_every_line_when_a_product_has_two_names(spark):
    sales = spark.createDataFrame(
        [("1", "S", "mug", 2, 1.5, "c", "FRANCE", "2010-01-01", "00:00:00", "SALE"), ("2", "S", "jar", 1, 1.0, "c", "MARS", "2010-01-01", "00:00:00", "SALE")],
        "INVOICE string, STOCKCODE string, DESCRIPTION string, QUANTITY bigint, PRICE double, CUSTOMER_ID string, COUNTRY string, INVOICE_DATE string, INVOICE_TIME string, INVOICE_TYPE string",
    )
    countries = spark.createDataFrame([("FRANCE",)], "COUNTRY_RAW string")
    products = spark.createDataFrame([("S", "mug", "OLD"), ("S", "mug", "NEW")], "STOCKCODE string, DESCRIPTION_RAW string, PRODUCT_NAME string")
    got = star.fact_sales(sales, countries, products).orderBy("INVOICE").collect()
    assert len(got) == 2 and got[0]["REVENUE"] == 3.0
    assert got[0]["PRODUCT_ID"] is not None and got[1]["PRODUCT_ID"] is None and got[1]["COUNTRY_ID"] is None


def test_reports(spark):
    df = spark.range(10).select(F.col("id").alias("v"))
    paths = export_reports(spark, {"All rows!": df.orderBy("v"), "List": ["a", "b"]}, scratch_path(spark, "r"), "My report")
    assert all("/my_report/" in p for p in paths.values())
    assert rows_of(report_index(spark, paths)) == [("ALL_ROWS_", 10), ("LIST", 2)]
    with pytest.raises(ValueError):
        export_reports(spark, {"a b": df, "A  B": df}, scratch_path(spark, "r"), "r")


def test_stream_reads_new_files_once(spark):
    folder, marks = scratch_path(spark, "in"), scratch_path(spark, "marks")
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    schema = "Order_Id bigint, name string"
    total = 0
    for k in range(3):
        spark.range(k * 5, k * 5 + 5).selectExpr("id as Order_Id", "concat('n', id) as name").write.mode("append").option("header", True).csv(folder)
        total += 5
        name = incr_file_ingest(wh, folder, "bronze", "arrivals", schema, marks, max_files=2)
        assert wh.read(name).count() == total
    incr_file_ingest(wh, folder, "bronze", "arrivals", schema, marks)
    assert sorted(r["ORDER_ID"] for r in wh.read(name).collect()) == list(range(15))


def test_modified_after_prunes_files(spark):
    from datetime import datetime, timedelta

    folder = scratch_path(spark, "in")
    spark.range(3).write.csv(folder)
    df = spark.read.csv(folder)
    now = datetime.now()
    assert files.modified_after(df, now + timedelta(days=1)).count() == 0
    assert files.modified_after(df, now - timedelta(days=1)).count() == 3
    assert files.modified_after(df, None).count() == 3


def test_half_written_replacement_leaves_the_old_table(spark):
    wh = Warehouse(spark, scratch_path(spark, "t"))
    wh.overwrite("S", "T", spark.range(3))
    broken = spark.range(100).select(F.when(F.col("id") < 99, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("bigint")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        wh.overwrite("S", "T", broken)
    assert rows_of(wh.read("S_T")) == [(0,), (1,), (2,)] and wh.tables("S_") == ["S_T"]
    wh.overwrite("S", "T", wh.read("S_T").filter("id > 0"))  # a table may be replaced by what is made of it
    wh.overwrite("S", "T", wh.read("S_T").filter("id > 1"))
    assert rows_of(wh.read("S_T")) == [(2,)]
    kept = storage.children(spark, f"{wh.path('S_T')}/versions")
    assert len(kept) == 2 and kept == storage.children(spark, f"{wh.path('S_T')}/current")


def test_fold_keeps_the_latest_rows_and_the_last_batch(spark):
    wh = Warehouse(spark, scratch_path(spark, "t"))
    for n in range(5):
        wh.write_batch("S", "T", spark.createDataFrame([("a", n), (f"k{n}", n)], "k string, v int"), f"{n:03d}")
    latest = lambda df: incremental.latest_per_key(df, ["k"], "LOAD_BATCH")
    assert not wh.fold("S", "T", latest, most=5) and wh.fold("S", "T", latest, most=4)
    assert wh.batches("S_T") == ["b_004"]
    assert rows_of(wh.read("S_T")) == [("a", 4), *((f"k{n}", n) for n in range(5))]
    wh.write_batch("S", "T", spark.createDataFrame([("a", 9)], "k string, v int"), "005")
    assert wh.batch_counts("S_T") == {"b_004": 6, "b_005": 1}


def test_scratch_is_cleared(spark):
    made, before = scratch_path(spark, "x"), list(session._scratch)
    session._scratch[:] = [made]
    spark.range(2).write.parquet(made)
    assert session.clear_scratch(spark) == 1 and not storage.exists(spark, made)
    session._scratch[:] = before[:-1]


def test_as_of_takes_the_last_earlier_value(spark):
    rows = spark.createDataFrame([("x", d) for d in ("2010-01-01", "2010-01-03", "2010-04-02", "2009-12-31")] + [("y", "2010-01-05"), (None, "2010-01-01")], "c string, d string")
    known = spark.createDataFrame([("x", "2010-01-02", 1.0), ("x", "2010-01-03", 2.0), ("x", "2010-02-01", None), ("x", "2010-04-03", 9.0), ("y", "2009-06-01", 5.0)], "c string, d string, v double")
    got = fxrates.last_earlier(rows, known, "c", "d", "v")
    assert {(r.c, r.d): r.v for r in got.collect()} == {
        ("x", "2010-01-01"): None, ("x", "2010-01-03"): 2.0, ("x", "2010-04-02"): 2.0, ("x", "2009-12-31"): None, ("y", "2010-01-05"): 5.0, (None, "2010-01-01"): None
    }


def test_month_ranges():
    months = [f"{y}-{m:02d}" for y in (2009, 2010) for m in (1, 2, 3)] + ["2020-12"]
    assert incremental.month_ranges(months) == [("2009-01", "2009-03"), ("2010-01", "2010-03"), ("2020-12", "2020-12")]
    assert incremental.month_ranges(months, 2) == [("2009-01", "2010-03"), ("2020-12", "2020-12")]
    assert incremental.month_ranges([]) == []
