import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tillwork.operators import products


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_best_description_ties(spark):
    rows = [("1", n) for n in ("A", "B", "CC", "DD")] + [("2", "x"), ("2", "x"), ("2", "yyyy"), ("3", None), ("4", " "), ("4", "UNKNOWN")]
    best = products.best_description(spark.createDataFrame(rows, "STOCKCODE string, NAME string"), "NAME")
    assert rows_of(best) == [("1", "CC"), ("2", "x"), ("3", "UNKNOWN"), ("4", "UNKNOWN")]


def test_best_description_weights(spark):
    df = spark.createDataFrame([("1", "a", 1), ("1", "b", 5), ("1", "a", 3)], "STOCKCODE string, NAME string, n bigint")
    assert rows_of(products.best_description(df, "NAME", F.col("n"))) == [("1", "b")]


def test_fill_and_null_out(spark):
    df = spark.createDataFrame([("1", "POSTAGE"), ("1", "MUG"), ("1", "MUG"), ("1", None)], "STOCKCODE string, NAME string")
    cleared = products.null_out_names(df, "NAME", keep=["POSTAGE", "MUG"], remove=["POSTAGE"])
    got = products.fill_product_name(cleared, "NAME", "PRODUCT").select("PRODUCT").collect()
    assert [r[0] for r in got] == ["MUG"] * 4


def brute_force(rows, keep, remove):
    """The three passes on plain lists of lines."""

    def resolve(frame, source, target):
        known = frame[source].where(frame[source] != "UNKNOWN")
        best = {}
        for code, names in known.groupby(frame.STOCKCODE):
            modes = names.dropna().mode()
            best[code] = max(modes, key=len) if len(modes) else "UNKNOWN"
        frame[target] = [k if isinstance(k, str) else best[c] for k, c in zip(known, frame.STOCKCODE)]

    frame = pd.DataFrame(rows, columns=["STOCKCODE", "DESCRIPTION_RAW"])
    frame["c"] = frame.DESCRIPTION_RAW
    resolve(frame, "c", "p0")
    frame["p0"] = frame.p0.where(frame.p0.isin(keep), None)
    resolve(frame, "p0", "p1")
    frame = frame.drop_duplicates().copy()
    frame["p1"] = frame.p1.where(~frame.p1.isin(remove), None)
    resolve(frame, "p1", "p2")
    return sorted(set(map(tuple, frame[["STOCKCODE", "DESCRIPTION_RAW", "p2"]].values.tolist())))


def test_product_mapping_against_brute_force(spark):
    rng = np.random.default_rng(5)
    names = ["RED_MUG", "BLUE_MUG", "TIN", "DAMAGED", "UNKNOWN", "POSTAGE", "BOX", "CAP"]
    rows = [(f"S{rng.integers(0, 12)}", names[rng.integers(0, len(names))]) for _ in range(300)]
    keep, remove = ["RED_MUG", "TIN", "DAMAGED", "POSTAGE", "BOX"], ["DAMAGED", "POSTAGE"]
    df = spark.createDataFrame(rows, "STOCKCODE string, DESCRIPTION string")
    assert rows_of(products.product_mapping(df, keep, remove)) == brute_force(rows, keep, remove)


def test_product_mapping_default_lists_and_hot_code(spark):
    rows = [("HOT", "POSTAGE")] * 50 + [("HOT", "BATHROOM METAL SIGN")] * 2 + [("X", "some mug")]
    got = rows_of(products.product_mapping(spark.createDataFrame(rows, "STOCKCODE string, DESCRIPTION string")))
    assert got == [
        ("HOT", "BATHROOM METAL SIGN", "BATHROOM_METAL_SIGN"),
        ("HOT", "POSTAGE", "BATHROOM_METAL_SIGN"),
        ("X", "some mug", "UNKNOWN"),
    ]


def test_reports(spark):
    rows = [("1", "r", "A"), ("1", "s", "B"), ("2", "t", "A"), ("3", "u", "C")]
    reports = products.product_code_reports(spark.createDataFrame(rows, "STOCKCODE string, DESCRIPTION_RAW string, PRODUCT_NAME string"))
    assert rows_of(reports["Count Product per Code"]) == [("1", 2), ("2", 1), ("3", 1)]
    assert rows_of(reports["Multi product per Code"]) == [("1", 2, "A"), ("1", 2, "B")]
    assert rows_of(reports["Multi code per product"]) == [("A", 2)]
