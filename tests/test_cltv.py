import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillwork.operators import cltv_features as cf
from tillwork.operators import cltv_models as cm


def sales_frame(months, customers=15, n=300, seed=2):
    rng = np.random.default_rng(seed)
    names = [str(p) for p in pd.period_range("2009-12", periods=months, freq="M")]
    frame = pd.DataFrame(
        {
            "CUSTOMER_ID": [f"c{v:02d}" for v in rng.integers(0, customers, n)],
            "YEAR_MONTH": [names[v] for v in rng.integers(0, months, n)],
            "REVENUE": rng.integers(100, 90_000, n) / 100.0,
        }
    )
    # One month in all, and every month present.
    extra = pd.DataFrame({"CUSTOMER_ID": "solo", "YEAR_MONTH": names[0], "REVENUE": [5.0, 6.25]})
    fill = pd.DataFrame({"CUSTOMER_ID": "full", "YEAR_MONTH": names, "REVENUE": 7.0})
    return pd.concat([frame, extra, fill], ignore_index=True)


def pandas_features(frame):
    wide = frame.pivot_table(index="CUSTOMER_ID", columns="YEAR_MONTH", values="REVENUE", aggfunc="sum", fill_value=0)
    n = wide.shape[1]
    a, b = wide.iloc[:, : n // 2], wide.iloc[:, n // 2 :]
    out = pd.DataFrame(index=wide.index)
    out["AVG_MONTHLY_REVENUE"] = wide.mean(axis=1)
    out["STD_MONTHLY_REVENUE"] = wide.std(axis=1)
    out["MAX_MONTHLY_REVENUE"] = wide.max(axis=1)
    out["FIRST_HALF_REVENUE"] = a.sum(axis=1)
    out["SECOND_HALF_REVENUE"] = b.sum(axis=1)
    out["RECENT_3M_REVENUE"] = wide.iloc[:, -3:].sum(axis=1)
    out["EARLY_3M_REVENUE"] = wide.iloc[:, :3].sum(axis=1)
    out["REVENUE_TREND"] = b.mean(axis=1) - a.mean(axis=1)
    out["GROWTH_RATE"] = out.SECOND_HALF_REVENUE / (out.FIRST_HALF_REVENUE + 1) - 1
    out["MONTHS_ACTIVE"] = (wide > 0).sum(axis=1)
    out["ACTIVITY_RATE"] = out.MONTHS_ACTIVE / n
    out["PURCHASE_CONSISTENCY"] = 1 - out.STD_MONTHLY_REVENUE / (out.AVG_MONTHLY_REVENUE + 1)
    return out, wide


@pytest.mark.parametrize("months", [1, 2, 13, 25])
def test_time_features_equal_pandas(spark, months):
    frame = sales_frame(months)
    want, _ = pandas_features(frame)
    got = cf.time_features(spark.createDataFrame(frame).repartition(3)).toPandas().set_index("CUSTOMER_ID").sort_index()
    assert list(got.columns) == list(cf.TIME_FEATURES)
    for c in cf.TIME_FEATURES:
        assert got[c].astype(float).tolist() == pytest.approx(want[c].tolist(), rel=1e-9, abs=1e-7, nan_ok=True), c


def test_feature_months_cut_the_vector(spark):
    frame = sales_frame(14)
    early = frame[frame.YEAR_MONTH <= "2010-11"]
    want, _ = pandas_features(early)
    got = cf.time_features(spark.createDataFrame(frame), feature_months=12).toPandas().set_index("CUSTOMER_ID").sort_index()
    assert got.loc[want.index, "AVG_MONTHLY_REVENUE"].tolist() == pytest.approx(want.AVG_MONTHLY_REVENUE.tolist())


def test_pivot_and_target_equal_pandas(spark):
    frame = sales_frame(15)
    _, wide = pandas_features(frame)
    df = spark.createDataFrame(frame)
    got = cf.monthly_pivot(df).toPandas().set_index("CUSTOMER_ID").sort_index()
    assert list(got.columns) == list(wide.columns)
    assert np.allclose(got.values, wide.values)
    y = wide.iloc[:, 12:].sum(axis=1)
    found = cf.capped_target(df)
    assert found.cap == pytest.approx(y.quantile(0.95)) and found.count == (y > y.quantile(0.95)).sum() > 0
    capped = found.rows.toPandas().set_index("CUSTOMER_ID").sort_index().TARGET
    assert capped.tolist() == pytest.approx(y.clip(upper=y.quantile(0.95)).tolist())


def test_target_needs_more_than_twelve_months(spark):
    with pytest.raises(Exception, match="Not enough data"):
        cf.future_revenue(spark.createDataFrame(sales_frame(12))).collect()
    assert cf.future_revenue(spark.createDataFrame(sales_frame(13))).count() == 17


def test_split_and_folds_do_not_depend_on_partitioning(spark):
    df = spark.range(2_000).select(F.col("id").cast("string").alias("CUSTOMER_ID"))
    one = cf.assign_fold(cf.train_test_split(df))
    two = cf.assign_fold(cf.train_test_split(df.repartition(9)))
    assert one.exceptAll(two).isEmpty()
    share = one.agg(F.avg(F.col("IS_TRAIN").cast("int"))).first()[0]
    assert 0.77 < share < 0.83
    folds = {r["FOLD"]: r["count"] for r in one.groupBy("FOLD").count().collect()}
    assert sorted(folds) == [0, 1, 2, 3, 4] and min(folds.values()) > 300


def test_numeric_select_leaves_out_text_numbers(spark):
    df = spark.createDataFrame([("a", "5", 1, 2.0)], "CUSTOMER_ID string, RECENCY string, F1 int, F2 double")
    assert cf.numeric_select(df).columns == ["CUSTOMER_ID", "F1", "F2"]


def test_scaler_uses_population_deviation_and_keeps_constants(spark):
    df = spark.createDataFrame([(1.0, 4.0), (2.0, 4.0), (6.0, 4.0)], "a double, b double")
    scaled = cf.standard_scale(df, cf.fit_scaler(df, ["a", "b"])).toPandas()
    a = np.array([1.0, 2.0, 6.0])
    assert scaled.a.tolist() == pytest.approx(((a - a.mean()) / a.std()).tolist())
    assert scaled.b.tolist() == [0.0, 0.0, 0.0]


@pytest.fixture(scope="module")
def linear_data(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(300, 4)) * [1.0, 5.0, 0.2, 3.0] + [0.0, 10.0, 1.0, -2.0]
    y = x @ [30.0, -4.0, 100.0, 0.0] + 500 + rng.normal(size=300) * 5
    frame = pd.DataFrame(x, columns=list("abcd"))
    frame["TARGET"] = y
    frame["CUSTOMER_ID"] = [f"c{i}" for i in range(300)]
    return spark.createDataFrame(frame)


def test_linear_models_equal_closed_forms(spark, linear_data):
    prepared = cm.prepare(linear_data, list("abcd"))
    rows = prepared.side("Ridge").filter("IS_TRAIN").select("features", "TARGET").collect()
    x = np.array([r["features"].toArray() for r in rows])
    y = np.array([r["TARGET"] for r in rows])
    models = cm.fit_models(prepared, ["Linear Regression", "Ridge", "Lasso"])
    xc, yc = x - x.mean(0), y - y.mean()
    ols = np.linalg.solve(xc.T @ xc, xc.T @ yc)
    ridge = np.linalg.solve(xc.T @ xc + np.eye(4), xc.T @ yc)
    lasso = np.zeros(4)
    for _ in range(500):
        for j in range(4):
            r = yc - xc @ lasso + xc[:, j] * lasso[j]
            rho = xc[:, j] @ r / len(y)
            lasso[j] = np.sign(rho) * max(abs(rho) - 1.0, 0) / (xc[:, j] @ xc[:, j] / len(y))
    for name, want in (("Linear Regression", ols), ("Ridge", ridge), ("Lasso", lasso)):
        assert models[name].coefficients.toArray() == pytest.approx(want, rel=1e-4, abs=1e-4), name
    prepared.release()


def test_train_models_end_to_end(spark, linear_data):
    prepared = cm.prepare(linear_data, list("abcd"))
    trained = cm.train_models(spark, prepared, folds=2, trees=3)
    results = trained.results.collect()
    assert {r["MODEL"] for r in results} == set(cm.estimators())
    assert [r["R2"] for r in results] == sorted((r["R2"] for r in results), reverse=True)
    assert trained.best == results[0]["MODEL"] and results[0]["R2"] > 0.95
    assert all(r["CV_MAE"] > 0 for r in results)
    test_rows = prepared.rows.filter("NOT IS_TRAIN").count()
    assert trained.predictions.count() == test_rows
    top = cm.feature_importance(spark, trained.models["Lasso"], prepared.features).first()
    assert top["FEATURE"] == "a"
    forest = cm.feature_importance(spark, trained.models["Random Forest"], prepared.features).collect()
    assert sum(r["IMPORTANCE"] for r in forest) == pytest.approx(1.0)
    prepared.release()


def test_model_metrics_equal_numpy(spark):
    y, p = np.array([1.0, 2.0, 4.0, 0.0]), np.array([1.5, 1.0, 4.0, 0.5])
    df = spark.createDataFrame(list(zip(map(float, y), map(float, p))), "TARGET double, PREDICTION double")
    m = cm.model_metrics(df).first()
    assert m["R2"] == round(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum(), 4)
    assert m["MAE"] == round(abs(y - p).mean(), 2)
    assert m["RMSE"] == round(((y - p) ** 2).mean() ** 0.5, 2)
    assert m["MAPE"] == round((abs((y - p) / (y + 1))).mean() * 100, 2)
