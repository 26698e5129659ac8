"""The load steps on a small landing folder, run twice and in two halves."""

import datetime

import pytest
from pyspark.sql import functions as F

from tillwork.plans import sample_tables as given
from tillwork.plans import steps
from tillwork.session import scratch_path
from tillwork.sources import storage
from tillwork.sources.warehouse import Warehouse

SF = "/root/testdata/sf0.001"
AT = datetime.datetime(2024, 7, 1, tzinfo=datetime.timezone.utc)


def land(df, folder, name):
    df.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{folder}/{name}.csv")


def run(wh, landing, spark):
    steps.load_bronze(wh, landing)
    steps.load_silver_sales(wh)
    steps.load_country(wh, given.country_reference(spark, SF), AT)
    steps.load_rates(wh, *given.rate_references(spark, SF))
    steps.load_products(wh)
    steps.load_gold(wh)
    steps.load_rfm(wh)


def content(wh, name):
    """Rows as text; sums of doubles may differ in their last bits with the order of rows."""
    rows = wh.read(name).select(*sorted(wh.read(name).columns)).collect()
    return sorted(repr(tuple(round(v, 6) if isinstance(v, float) else v for v in r)) for r in rows)


GOLD = ("GOLD_FACT_SALES", "GOLD_DIM_COUNTRY", "GOLD_DIM_PRODUCT", "GOLD_DIM_EXCHANGE_RATE", "GOLD_DIM_CUSTOMER_RFM")


@pytest.fixture(scope="module")
def text(spark):
    frame = given.text_sales(spark, SF)
    bad = frame.limit(0).union(spark.createDataFrame([("1", "s", None, "1", "2010-13-99", "1", None, "x")], frame.schema))
    return frame.union(bad)


def test_two_halves_equal_one_load_and_rerun_changes_nothing(spark, text):
    early = F.coalesce(F.col("INVOICEDATE") < "1998-01-01", F.lit(False))
    whole_in, half_in = scratch_path(spark, "land"), scratch_path(spark, "land")
    whole, halves = Warehouse(spark, scratch_path(spark, "wh")), Warehouse(spark, scratch_path(spark, "wh"))

    land(text, whole_in, "online_retail_1")
    run(whole, whole_in, spark)
    land(text.filter(early), half_in, "online_retail_1")
    run(halves, half_in, spark)
    land(text.filter(~early), half_in, "online_retail_2")
    run(halves, half_in, spark)

    assert len(halves.batch_counts("SILVER_SALES")) == 2
    assert content(whole, "SILVER_SALES") == content(halves, "SILVER_SALES")
    for name in ("GOLD_FACT_SALES", "GOLD_DIM_COUNTRY", "GOLD_DIM_EXCHANGE_RATE", "GOLD_DIM_CUSTOMER_RFM"):
        assert content(whole, name) == content(halves, name), name
    assert whole.read("SILVER_SALES_REJECTS").count() == 1 == halves.read("SILVER_SALES_REJECTS").count()
    assert whole.read("GOLD_FACT_SALES").count() == whole.read("SILVER_SALES").count()
    assert whole.read("GOLD_FACT_SALES").filter("COUNTRY_ID is null or PRODUCT_ID is null").isEmpty()
    assert len(whole.read("GOLD_DIM_CUSTOMER_RFM").columns) == 22

    before = {name: content(whole, name) for name in GOLD}
    marks = sorted(tuple(r) for r in whole.watermarks().collect())
    run(whole, whole_in, spark)
    assert before == {name: content(whole, name) for name in GOLD}
    assert marks == sorted(tuple(r) for r in whole.watermarks().collect())


def test_interrupted_silver_load_is_repeated_without_doubles(spark, text):
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    wh.overwrite("BRONZE", "ONLINE_RETAIL_1", steps.with_event_date(text))
    steps.load_silver_sales(wh)
    rows = wh.read("SILVER_SALES").count()
    lost = Warehouse(spark, wh.root)
    lost.get_watermark = lambda name: None  # the data was written, the mark was not
    steps.load_silver_sales(lost)
    assert wh.read("SILVER_SALES").count() == rows


def test_late_country_fills_missing_keys(spark):
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    wh.overwrite("BRONZE", "ONLINE_RETAIL_1", given.text_sales(spark, SF))
    steps.load_silver_sales(wh)
    steps.load_products(wh)
    sales = wh.read("SILVER_SALES")
    some = sales.filter("COUNTRY <> 'NATION_5'").select(F.col("COUNTRY").alias("COUNTRY_RAW")).distinct()
    every = sales.select(F.col("COUNTRY").alias("COUNTRY_RAW")).distinct()
    steps.load_fact(wh, some, steps.product_table(wh))
    assert not wh.read("GOLD_FACT_SALES").filter("COUNTRY_ID is null").isEmpty()
    steps.load_fact(wh, every, steps.product_table(wh))
    assert wh.read("GOLD_FACT_SALES").filter("COUNTRY_ID is null").isEmpty()
    assert wh.read("GOLD_FACT_SALES").count() == sales.count()
    assert steps.load_fact(wh, every, steps.product_table(wh)) is None


def test_mapping_is_reloaded_only_when_it_changed(spark):
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    path = scratch_path(spark, "map")
    df = spark.createDataFrame([(555, "Champions", "Best"), (555, "Champions", "Best")], "`rfm score` int, `RFM Segment` string, rfm_name string")
    df.write.option("header", True).csv(path)
    assert steps.load_bronze_mapping(wh, path) and steps.load_bronze_mapping(wh, path) is None
    assert steps.load_silver_mapping(wh) and steps.load_silver_mapping(wh) is None
    assert wh.read("SILVER_RFM_MAPPING").count() == 1
    df.withColumn("rfm_name", F.lit("Very best")).write.mode("overwrite").option("header", True).csv(path)
    assert steps.load_bronze_mapping(wh, path) and steps.load_silver_mapping(wh)
    assert [r["RFM_NAME"] for r in wh.read("SILVER_RFM_MAPPING").collect()] == ["Very best"]


def test_arrival_counts_and_not_the_time_of_the_sale(spark, text):
    wh, landing = Warehouse(spark, scratch_path(spark, "wh")), scratch_path(spark, "land")
    good = text.filter("INVOICEDATE <> '2010-13-99'")
    given.land(good.filter("INVOICEDATE >= '1996-01-01'"), landing, "online_retail_1")
    steps.load_bronze(wh, landing)
    steps.load_silver_sales(wh)
    top = good.agg(F.max("INVOICEDATE")).first()[0]
    twin = good.filter(F.col("INVOICEDATE") == top).withColumn("INVOICE", F.concat(F.lit("77"), "INVOICE"))
    given.land(good.filter("INVOICEDATE < '1996-04-01'").union(twin), landing, "online_retail_2", days_old=9000)
    steps.load_bronze(wh, landing)
    steps.load_silver_sales(wh)
    whole = Warehouse(spark, scratch_path(spark, "wh"))
    whole.overwrite("BRONZE", "ONLINE_RETAIL_1", good.union(twin))
    steps.load_silver_sales(whole)
    assert content(wh, "SILVER_SALES") == content(whole, "SILVER_SALES")

    given.land(text.filter("INVOICEDATE = '2010-13-99'"), landing, "online_retail_3")
    assert steps.load_bronze(wh, landing) and steps.load_silver_sales(wh) is None
    assert steps.rejected_sales(wh).count() == 1
    assert steps.load_bronze(wh, landing) == [] and steps.load_silver_sales(wh) is None


def test_a_changed_file_replaces_its_rows_and_an_interrupted_load_is_repeated(spark):
    wh, landing = Warehouse(spark, scratch_path(spark, "wh")), scratch_path(spark, "land")
    line = "1,s,{},1,2010-01-0{},2,c,X\n"
    head = "INVOICE,STOCKCODE,DESCRIPTION,QUANTITY,INVOICEDATE,PRICE,CUSTOMER_ID,COUNTRY\n"

    def put(name, *rows):
        fs, p = storage._fs(spark, f"{landing}/{name}")
        out = fs.create(p, True)
        out.write(bytearray((head + "".join(rows)).encode()))
        out.close()

    put("online_retail.csv", line.format("a", 1), line.format("b", 1), "too,few\n")
    lost = Warehouse(spark, wh.root)
    lost.note_files = lambda rows: None  # the rows were written, the ledger was not
    steps.load_bronze(lost, landing)
    put("online_retail_2.csv", line.format("c", 2))
    steps.load_bronze(wh, landing)
    assert sorted(r.DESCRIPTION for t in wh.tables("BRONZE") for r in steps.bronze_lines(wh, t).collect()) == ["a", "b", "c"]
    assert wh.read("REJECTED_ONLINE_RETAIL").select("CORRUPT_ROW").collect()[0][0] == "too,few"
    put("online_retail.csv", line.format("a", 1), line.format("dd", 1))
    assert steps.load_bronze(wh, landing) == ["BRONZE_ONLINE_RETAIL"]
    assert sorted(r.DESCRIPTION for r in steps.bronze_lines(wh, "BRONZE_ONLINE_RETAIL").collect()) == ["a", "dd"]
    steps.load_silver_sales(wh)
    assert sorted(r.DESCRIPTION for r in wh.read("SILVER_SALES").collect()) == ["A", "C", "DD"]


def test_quoted_breaks_and_colliding_sheets(spark):
    wh, landing = Warehouse(spark, scratch_path(spark, "wh")), scratch_path(spark, "land")
    fs, p = storage._fs(spark, f"{landing}/notes.csv")
    out = fs.create(p, True)
    out.write(bytearray(b'id,note\n1,"two\nlines, ""quoted"""\n2,plain\n3,x,y\n'))
    out.close()
    assert steps.load_bronze(wh, landing, quoted_breaks=True) == ["BRONZE_NOTES"]
    assert sorted(tuple(r)[:2] for r in wh.read("BRONZE_NOTES").collect()) == [("1", 'two\nlines, "quoted"'), ("2", "plain")]
    assert wh.read("REJECTED_NOTES").count() == 1
    fs.create(storage._fs(spark, f"{landing}/Notes.CSV")[1], True).close()
    with pytest.raises(ValueError, match="NOTES"):
        steps.load_bronze(wh, landing)
