import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillwork.operators import explore, profiling


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(4)
    n = 200
    a = rng.exponential(size=n)
    f = pd.DataFrame({"a": a, "b": a * 2 + rng.normal(size=n), "c": rng.normal(size=n), "k": 0.1, "e": np.nan})
    f.loc[::7, "b"] = np.nan
    f["t"] = [f" x{i % 30}" if i % 3 else None for i in range(n)]
    return f


@pytest.fixture(scope="module")
def df(spark, frame):
    typed = spark.createDataFrame([tuple(None if isinstance(v, float) and np.isnan(v) else v for v in r) for r in frame.itertuples(index=False)],
                                  "a double, b double, c double, k double, e double, t string")
    return typed.repartition(3)


def by(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def test_rates(df):
    assert by(profiling.profile_missing_rate(df), "col", "null_rate") == {"a": 0.0, "b": 14.5, "c": 0.0, "k": 0.0, "e": 100.0, "t": 33.5}
    assert by(profiling.profile_fill_rate(df), "col", "fill_rate") == {"a": 100.0, "b": 85.5, "c": 100.0, "k": 100.0, "e": 0.0, "t": 66.5}


def test_skewness_equals_pandas(df, frame):
    got = by(profiling.profile_skewness(df), "col", "skewness")
    for c in "abc":
        assert got[c] == pytest.approx(frame[c].skew())
    assert got["k"] is None and got["e"] is None


def test_correlations_equal_pandas(df, frame):
    got = {(r["feature_1"], r["feature_2"]): r["correlation"] for r in profiling.profile_corr_pairs(df).collect()}
    want = frame[["a", "b", "c", "k", "e"]].corr()
    for (x, y), r in got.items():
        if x in "abc" and y in "abc":
            assert r == pytest.approx(want.loc[x, y])
        else:
            assert r is None
    positive, negative = profiling.profile_corr_top(df)
    pairs = [(r[0], r[1]) for r in positive.collect()]
    assert pairs[0] == ("b", "a") and len(pairs) == 3
    assert [r[2] for r in negative.collect()] == sorted(r for r in got.values() if r is not None)
    matrix = {r["feature"]: r for r in profiling.profile_corr_matrix(df).collect()}
    assert matrix["a"]["a"] == 1.0 and matrix["k"]["k"] is None and matrix["a"]["b"] == pytest.approx(want.loc["a", "b"])


@pytest.mark.parametrize("approx", [False, True])
def test_describe_equals_pandas(df, frame, approx):
    got = {r["col"]: r for r in profiling.profile_describe(df, approx).collect()}
    want = frame.describe()
    for c in "abc":
        for ours, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("max", "max")):
            assert got[c][ours] == pytest.approx(want.loc[theirs, c])
        tolerance = 0.2 if approx else 1e-12
        assert got[c]["p50"] == pytest.approx(want.loc["50%", c], abs=tolerance)
    assert got["e"]["count"] == 0 and got["e"]["p50"] is None
    counts = frame.t.value_counts()
    assert got["t"]["unique"] == len(counts) and got["t"]["freq"] == counts.iloc[0]
    assert got["t"]["top"] == min(counts[counts == counts.iloc[0]].index)


def test_value_share_and_trim(df, frame):
    shares = [r for r in profiling.profile_value_share(df).collect() if r["col"] == "t"]
    assert len(shares) == min(20, frame.t.nunique())
    want = frame.t.value_counts(normalize=True) * 100
    for r in shares:
        assert r["share"] == pytest.approx(want[r["value"]])
    assert by(profiling.profile_need_trim(df), "col", "needs_trim") == {"a": 0, "b": 0, "c": 0, "k": 0, "e": 0, "t": 133}


def test_histogram_counts_every_value(df, frame):
    hist = profiling.profile_histogram(df, 7).collect()
    per = {}
    for r in hist:
        per[r["col"]] = per.get(r["col"], 0) + r["n"]
    assert per == {"a": 200, "b": int(frame.b.notna().sum()), "c": 200, "k": 200}
    counts, _ = np.histogram(frame.c, bins=7)
    assert {r["bin"]: r["n"] for r in hist if r["col"] == "c"} == {i + 1: int(n) for i, n in enumerate(counts) if n}


def test_head_tail_sample(spark):
    df = spark.range(50).repartition(5)
    assert [r[0] for r in profiling.profile_head(df, 3, ["id"]).collect()] == [0, 1, 2]
    assert [r[0] for r in profiling.profile_tail(df, 3, ["id"]).collect()] == [47, 48, 49]
    one = {r[0] for r in profiling.profile_sample(df, 10, ["id"]).collect()}
    assert len(one) == 10 and one == {r[0] for r in profiling.profile_sample(df.repartition(2), 10, ["id"]).collect()}


def test_split_and_flags(spark):
    rows = [("1", 1), ("C2", 1), ("3", -1), (None, None), (None, -5)]
    returns, sales = explore.split_returns_sales(spark.createDataFrame(rows, "INVOICE string, QUANTITY int"))
    assert sorted(tuple(r) for r in returns.collect() if r[0]) == [("3", -1), ("C2", 1)] and returns.count() == 3
    assert sales.count() == 2


def test_multi_country_counts_missing_country_as_one(spark):
    rows = [("a", "X"), ("a", "Y"), ("a", "Y"), ("b", "X"), ("c", None), ("c", "X"), (None, "X"), (None, "Y")]
    got = explore.multi_country_customers(spark.createDataFrame(rows, "CUSTOMER_ID string, COUNTRY string"))
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, [("a", "X"), ("a", "Y"), ("c", None), ("c", "X")]))


def test_code_flags(spark):
    rows = [("A", "d1", 1.0, "X"), ("A", "d2", 2.0, "X"), ("LONG", "d1", 1.0, "Y"), ("LONG", None, 1.0, "Y")]
    df = spark.createDataFrame(rows, "STOCKCODE string, DESCRIPTION string, PRICE double, COUNTRY string")
    got = {r["STOCKCODE"]: r for r in explore.description_count_per_code(df).collect()}
    assert got["A"]["ISSUE_COUNT_DESCRI"] == "1 code = X descri" and got["A"]["ISSUE_LENGTH_CODE"] == "MAYBE"
    assert got["LONG"]["DESCRIPTION"] == 1 and got["LONG"]["ISSUE_COUNT_PRICE_CODE"] == "1 code = 1 price"
    sales = df.withColumns({"INVOICE_DATE": F.lit("d"), "INVOICE_TIME": F.lit("t")})
    checked = explore.faulty_descriptions(sales, explore.description_count_per_code(df), explore.code_count_per_description(df))
    assert checked.count() == 4 and "INVOICE_DATE" not in checked.columns
    assert {r["DESCRIPTION"]: r["TO_CHECK"] for r in checked.collect()}[None] == "NO"


def test_three_hundred_columns_in_one_scan(spark):
    rng = np.random.default_rng(5)
    values = rng.normal(size=(400, 300)) + rng.normal(size=(400, 1)) + 1e6
    values[::9, 7] = np.nan
    values[:, 11] = 0.1
    df = spark.createDataFrame(pd.DataFrame(values, columns=[f"c{i}" for i in range(300)])).repartition(5)
    got = {r["i"]: r["r"] for r in profiling.correlations(df, df.columns).collect()}
    want = pd.DataFrame(values).corr().to_numpy()
    for i in range(0, 300, 7):
        for j in range(300):
            if 11 in (i, j):
                assert got[i][j] is None
            else:
                assert got[i][j] == pytest.approx(want[i, j], abs=1e-7)


def test_profile_from_one_scan(spark, df, frame):
    found = profiling.profile_all(df, ["a"], 5)
    assert len(found) == 15
    assert [r["a"] for r in found["Head"].collect()] == sorted(frame.a)[:5]
    assert [r["a"] for r in found["Tail"].collect()] == sorted(frame.a)[-5:]
    assert found["Sample"].exceptAll(profiling.profile_sample(df, 5, ["a"])).isEmpty()
    plain = {
        "Describe": profiling.profile_describe(df), "Missing_rates": profiling.profile_missing_rate(df), "Info": profiling.profile_info(df),
        "Fullfill_rates": profiling.profile_fill_rate(df), "Trim_me": profiling.profile_need_trim(df),
        "Histogram": profiling.profile_histogram(df), "Variance": profiling.profile_skewness(df), "Share_value": profiling.profile_value_share(df),
    }
    for name, other in plain.items():
        key = "Column" if name == "Info" else "col"
        order = lambda rows: sorted((tuple(r) for r in rows), key=lambda t: repr(t[:2]))
        ours, theirs = order(found[name].select(other.columns).collect()), order(other.collect())
        assert len(ours) == len(theirs), (name, key)
        for a, b in zip(ours, theirs):
            for x, y in zip(a, b):
                assert x == y or (isinstance(x, float) and x == pytest.approx(y)), (name, a, b)


def test_profile_of_an_empty_table(spark):
    found = profiling.profile_all(spark.createDataFrame([], "a double, t string"), ["t"], 5)
    assert {n: (len(r) if isinstance(r, list) else r.count()) for n, r in found.items() if n in ("Head", "Info", "Describe", "Share_value")} == {
        "Head": 0, "Info": 5, "Describe": 2, "Share_value": 0
    }
