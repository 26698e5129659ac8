"""What loads and reports leave on disk."""

import os
import time

from pyspark.sql import functions as F

from tillwork import session
from tillwork.plans import sample_tables as given
from tillwork.plans import steps
from tillwork.session import scratch_path, staged
from tillwork.sources.files import read_csv
from tillwork.sources.reports import export_reports
from tillwork.sources.warehouse import Warehouse

SF = "/root/testdata/sf0.001"


def size(folder):
    return sum(os.path.getsize(f"{d}/{f}") for d, _, names in os.walk(folder) for f in names)


def test_reports_take_less_disk_than_their_text_and_read_back_whole(spark):
    lines = spark.range(20_000).select(F.col("id").cast("string").alias("ID"), F.lit(" a, \"b\" ").alias("TEXT"), F.lit("1 code = X descri").alias("FLAG"))
    path = export_reports(spark, {"Lines": lines}, scratch_path(spark, "reports"), "r")["LINES"]
    text = lines.agg(F.sum(F.length(F.concat_ws(",", *lines.columns)))).first()[0]
    assert size(path) < text / 4
    assert read_csv(spark, path).exceptAll(lines).isEmpty() and read_csv(spark, path).count() == 20_000


def test_a_silver_load_leaves_no_copy_of_its_lines(spark):
    wh, landing = Warehouse(spark, scratch_path(spark, "wh")), scratch_path(spark, "landing")
    given.land(given.text_sales(spark, SF), landing, "online retail")
    steps.load_bronze(wh, landing)
    before = list(session._scratch)
    steps.load_silver_sales(wh)
    assert wh.read("SILVER_SALES").count() > 5_000
    assert [p for p in session._scratch if p not in before and os.path.exists(p)] == []


def test_staged_files_go_with_the_block(spark):
    with staged(spark.range(10), "once") as df:
        path = session._scratch[-1]
        assert df.count() == 10 and os.path.isdir(path)
    assert not os.path.exists(path) and path not in session._scratch


def test_a_write_frees_its_shuffle_files(spark):
    folder = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()[0].getPath()

    def shuffled():
        return sum(os.path.getsize(f"{d}/{f}") for d, _, names in os.walk(folder) for f in names if f.startswith("shuffle_"))

    session.collect_garbage(spark)
    before = shuffled()
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    for k in range(3):
        wh.write_batch("S", "ROWS", spark.range(300_000).select(F.md5(F.col("id").cast("string")).alias("x")).repartition(4), str(k))
    deadline = time.time() + 10  # files go in the background; those of the last write may still be held
    while shuffled() > before + 16_000_000 and time.time() < deadline:
        time.sleep(0.2)
    assert shuffled() <= before + 16_000_000 and wh.read("S_ROWS").count() == 900_000
