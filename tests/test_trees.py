import numpy as np
import pandas as pd
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.sql import functions as F

from tillwork.operators import cltv_models as cm
from tillwork.operators import trees

NAMES = list("abc")
COLUMNS = {"featuresCol": "features", "labelCol": "TARGET", "predictionCol": "PREDICTION"}


@pytest.fixture(scope="module")
def prepared(spark):
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.normal(size=700), rng.integers(0, 9, 700), rng.exponential(size=700) * (rng.random(700) < 0.6)])
    frame = pd.DataFrame(x, columns=NAMES)
    frame["TARGET"] = 3 * x[:, 0] + np.sin(x[:, 1]) * 5 + x[:, 2] ** 2 + rng.normal(size=700) * 0.3
    frame["CUSTOMER_ID"] = [f"c{i}" for i in range(700)]
    found = cm.prepare(spark.createDataFrame(frame).repartition(3), NAMES)
    yield found
    found.release()


def predictions(model, rows):
    return {r["CUSTOMER_ID"]: r["PREDICTION"] for r in model.transform(rows).select("CUSTOMER_ID", "PREDICTION").collect()}


def test_boosted_trees_of_every_fold_equal_spark_ml(prepared, monkeypatch):
    monkeypatch.setattr(trees, "LEAST_ROWS", 100)  # more than one task
    monkeypatch.setattr(trees, "CHECKPOINT_ROUNDS", 4)
    sets = trees.TrainingSets(prepared.rows, [None, 0, 3])
    assert sets.tasks > 1
    made = trees.Boosted(12, 4, 0.1).fit(sets)
    sets.release()
    rows = prepared.side("Gradient Boosting")
    for fold in (None, 0, 3):
        mine = rows.filter("IS_TRAIN") if fold is None else rows.filter("IS_TRAIN").filter(F.col("FOLD") != fold)
        theirs = GBTRegressor(**COLUMNS, maxIter=12, maxDepth=4, seed=42, stepSize=0.1).fit(mine)
        # Splits that part the training rows alike have equal gains; rounding picks one, and other rows may part otherwise.
        want, got = predictions(theirs, mine), predictions(made[fold], mine)
        assert [got[c] for c in want] == pytest.approx(list(want.values()), rel=1e-6, abs=1e-6), fold
        want, got = predictions(theirs, rows), predictions(made[fold], rows)
        assert sum(abs(got[c] - v) > 1e-6 for c, v in want.items()) <= 0.02 * len(want), fold
        assert made[fold].featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), abs=0.02)


@pytest.mark.parametrize("held", [64 << 20, 2_000])
def test_a_tree_of_the_forest_is_a_tree_on_its_bootstrap(spark, prepared, monkeypatch, held):
    monkeypatch.setattr(trees, "LEAST_ROWS", 100)
    monkeypatch.setattr(trees, "HELD_BYTES", held)  # one tree a job, or all of them
    monkeypatch.setattr(trees, "DRIVER_BYTES", 0)  # sums are added up by tasks
    whole = prepared.rows.withColumn("TARGET", F.round("TARGET", 2))
    sets = trees.TrainingSets(whole, [None, 2])
    made = trees.Forest(3, 5).fit(sets)
    sets.release()
    for fold, k in ((None, 0), (2, 1)):
        mine = whole.filter("IS_TRAIN") if fold is None else whole.filter("IS_TRAIN").filter(F.col("FOLD") != fold)
        rows = mine.select("TARGET", "RAW", F.xxhash64("CUSTOMER_ID").alias("h")).collect()
        drawn = trees._poisson(np.array([r["h"] for r in rows], np.int64).view(np.uint64), 42 * 1_000_003 + k).astype(int)
        assert 0.8 < drawn.mean() < 1.2 and drawn.max() > 2
        x = np.array([r["RAW"].toArray() for r in rows])
        codes = trees.bin_codes(x, made[fold].thresholds)  # the same bins for both
        bag = [(float(r["TARGET"]), Vectors.dense(codes[:, i].astype(float))) for i, r in enumerate(rows) for _ in range(drawn[i])]
        theirs = DecisionTreeRegressor(**COLUMNS, maxDepth=5).fit(spark.createDataFrame(bag, ["TARGET", "features"]))
        want = [theirs.predict(Vectors.dense(codes[:, i].astype(float))) for i in np.flatnonzero(drawn)[:200]]
        tree = made[fold].trees[k]
        got = tree.mean[tree.places(codes, 5)][np.flatnonzero(drawn)[:200]]
        assert got.tolist() == pytest.approx(want, rel=1e-9), fold


def test_folds_share_their_jobs(spark, prepared):
    scheduler = spark.sparkContext._jsc.sc().dagScheduler()

    def jobs(folds):
        before = scheduler.numTotalJobs()
        scores = cm.cross_validate(prepared, ["Gradient Boosting"], folds=folds, trees=12)
        assert len(scores["Gradient Boosting"]) == folds
        return scheduler.numTotalJobs() - before

    assert jobs(5) < 2 * jobs(1)


def test_the_draw_is_poisson_and_does_not_depend_on_partitions(spark):
    hashes = np.random.default_rng(1).integers(0, 2**63, 200_000, np.int64).view(np.uint64)
    drawn = trees._poisson(hashes, 11)
    assert drawn.mean() == pytest.approx(1, abs=0.02) and drawn.var() == pytest.approx(1, abs=0.03)
    assert np.corrcoef(drawn, trees._poisson(hashes, 12))[0, 1] == pytest.approx(0, abs=0.02)
    assert trees._poisson(hashes[::-1], 11)[::-1].tolist() == drawn.tolist()


def test_a_training_set_without_rows_has_no_model(spark, prepared):
    one = cm.Prepared(NAMES, prepared.rows.filter("FOLD = 1 OR NOT IS_TRAIN"))
    models = cm.fit_all(one, ["Random Forest", "Gradient Boosting", "Ridge"], [None, 1, 2], trees=2)
    assert set(models) == {(n, f) for n in ("Random Forest", "Gradient Boosting", "Ridge") for f in (None, 2)}
    with pytest.raises(ValueError, match="no training rows"):
        cm.fit_models(cm.Prepared(NAMES, prepared.rows.filter("NOT IS_TRAIN")), ["Random Forest"], trees=2)
    flat = cm.prepare(prepared.rows.select("CUSTOMER_ID", F.lit(2.0).alias("TARGET"), F.lit(1.0).alias("a")), ["a"])
    same = cm.fit_models(flat, ["Random Forest", "Gradient Boosting"], trees=2)
    assert {round(v, 9) for m in same.values() for v in predictions(m, flat.side("Random Forest")).values()} == {2.0}
    flat.release()
