"""Lifetime-value models on Spark ML, their metrics, importances and predictions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tillwork import schemas
from tillwork.functions.amounts import ratio
from tillwork.operators.cltv_features import assign_fold, fit_scaler, train_test_split
from tillwork.operators.trees import Boosted, Forest, TrainingSets

TREES = ("Random Forest", "Gradient Boosting")


def estimators(n: int = 1, label_deviation: float = 1.0, seed: int = 42, trees: int = 100) -> dict[str, Callable]:
    """Estimator factories for a training set of `n` rows with the given deviation of the label.

    The linear ones fit one training set, those of TREES all training sets at once.

    The ridge penalty weighs alpha against a sum over rows. Spark weighs against the mean, and after
    dividing the label by its deviation, hence alpha * deviation / n. The lasso penalty needs neither.
    """
    common = {"featuresCol": "features", "labelCol": "TARGET", "predictionCol": "PREDICTION"}
    # The features are collinear, so the solver iterates; it needs room to converge.
    linear = {**common, "standardization": False, "maxIter": 1000, "tol": 1e-8}
    return {
        "Linear Regression": lambda: LinearRegression(**linear),
        "Ridge": lambda: LinearRegression(**linear, regParam=label_deviation / max(n, 1), elasticNetParam=0.0),
        "Lasso": lambda: LinearRegression(**linear, regParam=1.0, elasticNetParam=1.0),
        "Random Forest": lambda: Forest(trees, depth=10, seed=seed),
        "Gradient Boosting": lambda: Boosted(trees, depth=5, step=0.1),
    }


def model_metrics(df: DataFrame, actual: str = "TARGET", predicted: str = "PREDICTION") -> DataFrame:
    """R2, MAE, RMSE and MAPE of two columns, rounded, in one aggregation."""
    y, e = F.col(actual), F.col(actual) - F.col(predicted)
    m = df.agg(
        F.avg(e * e).alias("mse"),
        F.var_pop(y).alias("var"),
        F.avg(F.abs(e)).alias("mae"),
        (F.avg(F.abs(ratio(e, y + 1))) * 100).alias("mape"),
    )
    return m.select(
        F.round(F.lit(1.0) - ratio(F.col("mse"), F.col("var")), 4).alias("R2"),
        F.round("mae", 2).alias("MAE"),
        F.round(F.sqrt("mse"), 2).alias("RMSE"),
        F.round("mape", 2).alias("MAPE"),
    )


def prediction_table(df: DataFrame, actual: str = "TARGET", predicted: str = "PREDICTION") -> DataFrame:
    a, p = F.col(actual), F.col(predicted)
    return df.select(
        "CUSTOMER_ID",
        a.alias("ACTUAL_CLV"),
        p.alias("PREDICTED_CLV"),
        (a - p).alias("ERROR"),
        (ratio(a - p, a + 1) * 100).alias("ERROR_PCT"),
    )


@dataclass
class Prepared:
    """Training and test rows with their fold and both feature vectors, in one kept frame."""

    features: list[str]
    rows: DataFrame

    def side(self, model: str) -> DataFrame:
        """Rows with the vector that the model takes as `features`."""
        return self.rows.withColumn("features", F.col("RAW" if model in TREES else "SCALED"))

    def release(self) -> None:
        self.rows.unpersist()


def prepare(data: DataFrame, features: Sequence[str], seed: int = 42, folds: int = 5) -> Prepared:
    """Split, scale on the training side, assemble vectors; one frame is kept for the many fits.

    `data` has CUSTOMER_ID, TARGET and the numeric features.
    """
    split = assign_fold(train_test_split(data, seed=seed), folds=folds, seed=seed)
    scaler = fit_scaler(split.filter("IS_TRAIN"), features)
    both = VectorAssembler(inputCols=list(features), outputCol="RAW").transform(split)
    scaled = {f"_scaled_{k}": (F.col(n) - F.lit(scaler[n][0])) / F.lit(scaler[n][1]) for k, n in enumerate(features)}
    both = VectorAssembler(inputCols=list(scaled), outputCol="SCALED").transform(both.withColumns(scaled))
    rows = both.select("CUSTOMER_ID", "TARGET", "IS_TRAIN", "FOLD", "RAW", "SCALED")
    return Prepared(list(features), rows.persist(StorageLevel.MEMORY_AND_DISK))


def _estimators_for(rows: DataFrame, **kw) -> dict[str, Callable] | None:
    """Estimators sized to a training set; None when it is empty."""
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop("TARGET").alias("d")).first()
    return estimators(seen["n"], seen["d"] or 1.0, **kw) if seen["n"] else None


def _mae(model, rows: DataFrame) -> float | None:
    scored = model.transform(rows)
    return scored.agg(F.avg(F.abs(F.col("TARGET") - F.col("PREDICTION")))).first()[0]


def fit_all(
    prepared: Prepared, names: Sequence[str], folds: Sequence[int | None], parallelism: int = 6, **kw
) -> dict[tuple[str, int | None], object]:
    """Each model on each training set: the training rows without the given fold, or all of them for None.

    Training sets without a row have no model. Linear fits are independent Spark jobs submitted from a few driver
    threads; the trees of all training sets grow together.
    """
    grown = [n for n in reversed(names) if n in TREES]
    tasks = [(name, fold) for name in names if name not in TREES for fold in folds]

    def one(task: tuple[str, int | None]) -> object | None:
        name, fold = task
        rows = prepared.side(name).filter("IS_TRAIN")
        rows = rows if fold is None else rows.filter(F.col("FOLD") != fold)
        make = _estimators_for(rows, **kw)
        return None if make is None else make[name]().fit(rows)

    with ThreadPoolExecutor(parallelism) as pool:
        sets = TrainingSets(prepared.rows, folds, kw.get("seed", 42)) if grown else None
        forests = {n: pool.submit(estimators(**kw)[n]().fit, sets) for n in grown}
        fitted = dict(zip(tasks, pool.map(one, tasks)))
        for name, found in forests.items():
            fitted |= {(name, fold): model for fold, model in found.result().items()}
    if sets:
        sets.release()
    return {task: model for task, model in fitted.items() if model is not None}


def cross_validate(
    prepared: Prepared, names: Sequence[str], folds: int = 5, parallelism: int = 6, fitted: dict | None = None, **kw
) -> dict[str, list[float]]:
    """Mean absolute error of each model on each held-out fold of the training rows. `fitted` has the models, if known."""
    fitted = fitted if fitted is not None else fit_all(prepared, names, range(folds), parallelism, **kw)

    def one(task: tuple[str, int]) -> float | None:
        name, fold = task
        rows = prepared.side(name).filter("IS_TRAIN").filter(F.col("FOLD") == fold)
        return _mae(fitted[task], rows) if task in fitted else None

    tasks = [(name, fold) for name in names for fold in range(folds)]
    with ThreadPoolExecutor(parallelism) as pool:
        scores = dict(zip(tasks, pool.map(one, tasks)))
    return {name: [scores[name, f] for f in range(folds) if scores[name, f] is not None] for name in names}


@dataclass
class Trained:
    """Fitted models, their result table (best first) and the best model's test predictions."""

    models: dict[str, object]
    results: DataFrame
    best: str
    predictions: DataFrame


def fit_models(prepared: Prepared, names: Sequence[str], parallelism: int = 4, fitted: dict | None = None, **kw) -> dict[str, object]:
    """Each model on all training rows. `fitted` has the models, if known."""
    fitted = fitted if fitted is not None else fit_all(prepared, names, [None], parallelism, **kw)
    if any((name, None) not in fitted for name in names):
        raise ValueError("no training rows")
    return {name: fitted[name, None] for name in names}


def train_models(
    spark: SparkSession, prepared: Prepared, names: Sequence[str] | None = None, folds: int = 5, **kw
) -> Trained:
    """Fit every model on the training rows, score it on the test rows and by cross-validation."""
    names = list(names or estimators())
    fitted = fit_all(prepared, names, [None, *range(folds)], **kw)
    models = fit_models(prepared, names, fitted=fitted)
    cv = cross_validate(prepared, names, folds, fitted=fitted)
    rows = []
    for name in names:
        test = prepared.side(name).filter("NOT IS_TRAIN")
        m = model_metrics(models[name].transform(test)).first()
        cv_mae = round(sum(cv[name]) / len(cv[name]), 2) if cv[name] else None
        rows.append((name, m["R2"], m["MAE"], m["RMSE"], m["MAPE"], cv_mae))
    rows.sort(key=lambda r: (r[1] is None, -(r[1] or 0.0)))
    results = spark.createDataFrame(rows, schemas.CLTV_MODEL_RESULTS)
    best = rows[0][0]
    scored = models[best].transform(prepared.side(best).filter("NOT IS_TRAIN"))
    return Trained(models, results, best, prediction_table(scored))


def feature_importance(spark: SparkSession, model: object, features: Sequence[str]) -> DataFrame:
    """Absolute coefficients, or tree importances, largest first."""
    weights = model.coefficients if hasattr(model, "coefficients") else model.featureImportances
    rows = sorted(((f, abs(float(w))) for f, w in zip(features, weights.toArray())), key=lambda r: -r[1])
    return spark.createDataFrame(rows, "FEATURE STRING, IMPORTANCE DOUBLE")
