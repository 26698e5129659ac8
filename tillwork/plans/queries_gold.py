"""Queries on the star schema, RFM scores and lifetime value."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork import schemas
from tillwork.operators import cltv_features, cltv_models, fxrates, ranking, rfm, star
from tillwork.operators.cleaning import add_revenue
from tillwork.plans import sample_tables as given
from tillwork.plans import steps, views
from tillwork.plans.oracle_parts import product_key, rounded, stable_id, with_parts
from tillwork.plans.queries_silver import KEEP, LISTS, REMOVE
from tillwork.plans.registry import query
from tillwork.session import cut_lineage, scratch_path, stage, staged
from tillwork.sources.warehouse import Warehouse

_FACT = ", ".join(n for n, _ in schemas.columns(schemas.FACT_SALES))


@query("fact_sales", with_parts("fact", f"SELECT {_FACT} FROM fact"))
def fact_sales(spark, d):
    return views.fact(spark, d)


@query("country_id", with_parts("resolved", f"SELECT COUNTRY_RAW, {stable_id('COUNTRY_RAW')} AS COUNTRY_ID FROM resolved"))
def country_id(spark, d):
    return star.country_id(views.countries(spark, d)).select("COUNTRY_RAW", "COUNTRY_ID")


@query(
    "product_id",
    with_parts(
        "silver",
        f"SELECT DISTINCT STOCKCODE, DESCRIPTION AS DESCRIPTION_RAW, {product_key("STOCKCODE", "DESCRIPTION")} AS PRODUCT_ID FROM silver",
    ),
)
def product_id(spark, d):
    return star.product_id(views.catalogue(spark, d))


@query(
    "dim_country",
    with_parts(
        "countries",
        f"""SELECT COUNTRY_STANDARDIZED, CONTINENT, CAPITAL, ISO3, CURRENCY, TIMEZONE, {stable_id('COUNTRY_RAW')} AS COUNTRY_ID
FROM countries""",
    ),
)
def dim_country(spark, d):
    return star.dim_country(views.countries(spark, d))


@query(
    "dim_product",
    with_parts(
        "named1",
        f"""SELECT STOCKCODE, DESCRIPTION_RAW, PRODUCT_NAME, {product_key("STOCKCODE", "DESCRIPTION_RAW")} AS PRODUCT_ID FROM named1""",
    ),
)
def dim_product(spark, d):
    from tillwork.plans.queries_silver import fill_product_name

    return star.dim_product(fill_product_name(spark, d))


@query("dim_exchange_rate", with_parts("pair_rates", "SELECT INVOICE_DATE, CURRENCY, EXCHANGE_RATE_TO_GBP FROM pair_rates"))
def dim_exchange_rate(spark, d):
    from tillwork.plans.queries_silver import fx_rate_lookup

    return star.dim_exchange_rate(fx_rate_lookup(spark, d))


@query("dim_rfm_mapping", with_parts("mapping", "SELECT RFM_SCORE, RFM_SEGMENT, RFM_NAME FROM mapping"))
def dim_rfm_mapping(spark, d):
    return star.dim_rfm_mapping(given.score_mapping(views.scored(spark, d)))


def _loads(spark, d, mapping) -> Warehouse:
    """Two runs of every step up to the Gold tables: the second finds late rates, a late mapping and late sales."""
    wh, landing, maps = Warehouse(spark, scratch_path(spark, "wh")), scratch_path(spark, "landing"), scratch_path(spark, "map")
    reference, (first, second) = given.country_reference(spark, d), given.rate_references(spark, d)
    late = F.coalesce(F.crc32("DESCRIPTION") % 10 == 0, F.lit(False))  # whole names of known codes

    def run(second_rates):
        steps.load_bronze(wh, landing)
        steps.load_bronze_mapping(wh, maps)
        steps.load_silver_sales(wh)
        steps.load_silver_mapping(wh)
        steps.load_country(wh, reference, views.AT)
        steps.load_rates(wh, first, second_rates)
        steps.load_products(wh, keep=KEEP, remove=REMOVE)
        return steps.load_gold(wh)

    with staged(given.text_sales(spark, d), "text-sales") as text:
        given.land(text.filter(~late), landing, "online retail 1")
        mapping.filter("RFM_SCORE % 2 = 0").write.option("header", True).csv(maps)
        run(second.filter("false"))
        mapping.write.mode("overwrite").option("header", True).csv(maps)
        given.land(text.filter(late), landing, "online retail 2")
    run(second)
    if run(second):
        raise AssertionError("a run without input has built Gold tables")
    return wh


#: A row of any Gold table: its table, texts, two keys and a number.
_GOLD = {
    "GOLD_FACT_SALES": ("concat_ws('|', INVOICE, STOCKCODE, QUANTITY, CUSTOMER_ID, INVOICE_DATE, INVOICE_TIME, INVOICE_TYPE)", "COUNTRY_ID", "PRODUCT_ID", "REVENUE"),
    "GOLD_DIM_COUNTRY": ("concat_ws('|', COUNTRY_STANDARDIZED, CONTINENT, CAPITAL, ISO3, CURRENCY, TIMEZONE)", "COUNTRY_ID", "NULL", "NULL"),
    "GOLD_DIM_PRODUCT": ("concat_ws('|', STOCKCODE, DESCRIPTION_RAW, PRODUCT_NAME)", "PRODUCT_ID", "NULL", "NULL"),
    "GOLD_DIM_EXCHANGE_RATE": ("concat_ws('|', INVOICE_DATE, CURRENCY)", "NULL", "NULL", "EXCHANGE_RATE_TO_GBP"),
    "GOLD_DIM_RFM_MAPPING": ("concat_ws('|', RFM_SEGMENT, RFM_NAME)", "RFM_SCORE", "NULL", "NULL"),
}


def _gold_row(table: str) -> list[str]:
    text, one, two, number = _GOLD[table]
    keys = [f"CAST({one} AS BIGINT) AS key_1", f"CAST({two} AS BIGINT) AS key_2"]
    return [f"'{table}' AS table_name", f"{text} AS texts", *keys, f"CAST({number} AS DOUBLE) AS number"]


_GOLD_SOURCE = {
    "GOLD_FACT_SALES": "fact",
    "GOLD_DIM_COUNTRY": f"(SELECT *, {stable_id('COUNTRY_RAW')} AS COUNTRY_ID FROM countries)",
    "GOLD_DIM_PRODUCT": f"(SELECT *, {product_key('STOCKCODE', 'DESCRIPTION_RAW')} AS PRODUCT_ID FROM {LISTS})",
    "GOLD_DIM_EXCHANGE_RATE": "pair_rates",
    "GOLD_DIM_RFM_MAPPING": "mapping",
}


@query(
    "gold_layer",
    with_parts(
        f"fact countries pair_rates mapping {LISTS}",
        " UNION ALL ".join(f"SELECT {', '.join(_gold_row(t))} FROM {_GOLD_SOURCE[t]}" for t in _GOLD),
    ),
)
def gold_layer(spark, d):
    """The rows of all five Gold tables after a second run with late input, and a third without."""
    wh = _loads(spark, d, given.score_mapping(views.scored(spark, d)))
    return reduce(DataFrame.unionByName, [wh.read(name).selectExpr(*_gold_row(name)) for name in _GOLD])


@query("rfm_segment_join", with_parts("scored mapping", "SELECT CUSTOMER_ID, s.RFM_SCORE, RFM_SEGMENT, RFM_NAME FROM scored s LEFT JOIN mapping m ON CAST(m.RFM_SCORE AS VARCHAR) = s.RFM_SCORE"))
def rfm_segment_join(spark, d):
    scored = cut_lineage(views.scored(spark, d))
    joined = rfm.rfm_segment_join(scored, given.score_mapping(scored))
    return joined.select("CUSTOMER_ID", "RFM_SCORE", "RFM_SEGMENT", "RFM_NAME")


@query(
    "revenue_converted",
    with_parts(
        "lines countries pair_rates",
        f"""SELECT INVOICE, l.INVOICE_DATE, {stable_id('COUNTRY')} AS COUNTRY_ID, c.CURRENCY, REVENUE,
       REVENUE * EXCHANGE_RATE_TO_GBP AS REVENUE_CONVERTED
FROM lines l LEFT JOIN countries c ON COUNTRY = COUNTRY_RAW
LEFT JOIN pair_rates p ON p.INVOICE_DATE = l.INVOICE_DATE AND p.CURRENCY = c.CURRENCY""",
    ),
)
def revenue_converted(spark, d):
    sales = stage(views.silver(spark, d))
    countries = views.countries_of(spark, d, sales)
    pairs = fxrates.currency_date_pairs(sales, countries)
    rates = fxrates.fx_rate_lookup(pairs, *given.rate_references(spark, d))
    converted = star.revenue_converted(views.fact_of(spark, d, sales), star.dim_country(countries), star.dim_exchange_rate(rates))
    return converted.select("INVOICE", "INVOICE_DATE", "COUNTRY_ID", "CURRENCY", "REVENUE", "REVENUE_CONVERTED")


@query("snapshot_date", with_parts("valid", "SELECT CAST(max(CAST(INVOICE_DATE AS DATE)) + 1 AS VARCHAR) AS SNAPSHOT_DATE FROM valid"))
def snapshot_date(spark, d):
    return rfm.snapshot_date(views.valid(spark, d))


# Sums of doubles differ in their last bits with the order of rows, so queries round them.
_METRICS = "SOLD_QUANTITY AVG_BASKET_SIZE TOTAL_REVENUE AVG_ORDER_VALUE MAX_ORDER_VALUE MIN_ORDER_VALUE"
_DERIVED = f"{_METRICS} PURCHASE_FREQUENCY_RATE REVENUE_PER_DAY AVG_DAYS_BETWEEN_PURCHASES CHURN_RISK_SCORE"


def _round(df: DataFrame, columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.round(c, digits + 3), digits) for c in columns.split()})


@query("rfm_metrics", with_parts("metrics", rounded(_METRICS, "metrics")))
def rfm_metrics(spark, d):
    return _round(rfm.rfm_metrics(views.stored_valid(spark, d)), _METRICS)


_SMALL = "TOTAL_REVENUE AVG_ORDER_VALUE MAX_ORDER_VALUE MIN_ORDER_VALUE"


@query(
    "rfm_metrics_small_prices",
    with_parts(
        "valid",
        rounded(
            _SMALL,
            """(SELECT CUSTOMER_ID, sum(r) * 1e7 AS TOTAL_REVENUE, avg(r) * 1e7 AS AVG_ORDER_VALUE, max(r) * 1e7 AS MAX_ORDER_VALUE,
       min(r) * 1e7 AS MIN_ORDER_VALUE FROM (SELECT CUSTOMER_ID, REVENUE * 1e-7 AS r FROM valid) GROUP BY CUSTOMER_ID)""",
        ),
    ),
)
def rfm_metrics_small_prices(spark, d):
    """Amounts far below a ten-thousandth are summed as they are; the result is scaled back."""
    sales = views.stored_valid(spark, d).withColumn("REVENUE", F.col("REVENUE") * 1e-7)
    found = rfm.rfm_metrics(sales).withColumns({c: F.col(c) * 1e7 for c in _SMALL.split()})
    return _round(found, _SMALL).select("CUSTOMER_ID", *_SMALL.split())


@query("rfm_derived", with_parts("derived", rounded(_DERIVED, "derived")))
def rfm_derived(spark, d):
    return _round(views.metrics(spark, d), _DERIVED)


@query("rfm_rates", with_parts("derived", "SELECT avg(IS_REPEAT_CUSTOMER) AS REPEAT_CUSTOMER_RATE, avg(IS_ACTIVE) AS ACTIVE_CUSTOMER_RATE FROM derived"))
def rfm_rates(spark, d):
    return rfm.rfm_rates(views.metrics(spark, d))


@query(
    "rank_first",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity,
       row_number() OVER (ORDER BY l_quantity, k) AS RANK
FROM (SELECT *, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS k FROM lineitem)""",
)
def rank_first(spark, d):
    """Fifty distinct quantities over all lines: mostly ties."""
    keyed = given.table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_quantity",
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("k"),
    )
    return ranking.rank_first(keyed, "l_quantity", "k").drop("k")


@query(
    "quintile_score",
    """SELECT c_custkey, CAST(greatest(1, (5 * (row_number() OVER (ORDER BY c_acctbal, c_custkey) - 1) + (count(*) OVER () - 1) - 1)
         // (count(*) OVER () - 1)) AS INTEGER) AS SCORE FROM customer""",
)
def quintile_score(spark, d):
    customers = given.table(spark, d, "customer").select("c_custkey", "c_acctbal")
    return ranking.quintile_score(customers, "c_acctbal", "c_custkey", "SCORE").select("c_custkey", "SCORE")


_SCORES = "CUSTOMER_ID, RECENCY_SCORE, FREQUENCY_SCORE, MONETARY_SCORE, RFM_SCORE"


@query("rfm_scores", with_parts("scored", f"SELECT {_SCORES} FROM scored"))
def rfm_scores(spark, d):
    return views.scored(spark, d).select(*_SCORES.split(", "))


def _summary(score: str, metric: str, label: str) -> str:
    return with_parts(
        "scored",
        f"SELECT {score}, round(round(min({metric}), 9), 6) AS MIN_{label}, round(round(max({metric}), 9), 6) AS MAX_{label}, count({metric}) AS COUNT FROM scored GROUP BY {score}"
        if label == "MONETARY"
        else f"SELECT {score}, min({metric}) AS MIN_{label}, max({metric}) AS MAX_{label}, count({metric}) AS COUNT FROM scored GROUP BY {score}",
    )


@query("rfm_score_summary_recency", _summary("RECENCY_SCORE", "RECENCY", "RECENCY"))
def summary_recency(spark, d):
    return rfm.rfm_score_summaries(views.scored(spark, d))["Summary recency"]


@query("rfm_score_summary_frequency", _summary("FREQUENCY_SCORE", "FREQUENCY", "FREQUENCY"))
def summary_frequency(spark, d):
    return rfm.rfm_score_summaries(views.scored(spark, d))["Summary frequency"]


@query("rfm_score_summary_monetary", _summary("MONETARY_SCORE", "TOTAL_REVENUE", "MONETARY"))
def summary_monetary(spark, d):
    return _round(rfm.rfm_score_summaries(views.scored(spark, d))["Summary monetary"], "MIN_MONETARY MAX_MONETARY")


@query("rfm_scoring", with_parts("customer_rfm", rounded(_DERIVED, "customer_rfm")))
def rfm_scoring(spark, d):
    """From stored fact lines to the stored customer table."""
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    wh.write_batch("GOLD", "FACT_SALES", views.fact(spark, d), "first", schemas.FACT_SALES)
    return _round(wh.read(steps.load_rfm(wh)), _DERIVED)


_PURCHASES = """WITH p AS (SELECT CAST(user_id AS VARCHAR) AS CUSTOMER_ID, CAST(ts AS DATE) AS day, 1 AS QUANTITY, value AS REVENUE
  FROM events WHERE event_type = 'purchase' AND value > 0),
c AS (SELECT CUSTOMER_ID, date_diff('day', max(day), (SELECT max(day) + 1 FROM p)) AS RECENCY, count(*) AS FREQUENCY,
  CAST(sum(QUANTITY) AS BIGINT) AS SOLD_QUANTITY, sum(REVENUE) AS REVENUE,
  date_diff('day', min(day), max(day)) AS TENURE FROM p GROUP BY CUSTOMER_ID),
s AS (SELECT CAST(sum(FREQUENCY) AS DOUBLE) / count(*) AS pf, 1.0::DOUBLE - CAST(count(*) FILTER (FREQUENCY > 1) AS DOUBLE) / count(*) AS churn FROM c),
v AS (SELECT *, REVENUE / FREQUENCY AS AOV, REVENUE * 0.05::DOUBLE AS PROFIT_MARGIN,
  REVENUE / FREQUENCY * (SELECT pf FROM s) / (SELECT nullif(churn, 0) FROM s) AS CLV FROM c)
SELECT CUSTOMER_ID, RECENCY, FREQUENCY, SOLD_QUANTITY, round(round(REVENUE, 9), 6) AS REVENUE, TENURE, round(round(AOV, 9), 6) AS AOV,
  round(round(PROFIT_MARGIN, 9), 6) AS PROFIT_MARGIN, round(round(CLV, 7), 4) AS CLV,
  round(round(CLV * PROFIT_MARGIN, 7), 4) AS CLTV FROM v"""


@query("cltv_formula", _PURCHASES)
def cltv_formula(spark, d):
    """Purchase events as sales lines: here some customers bought once, so churn is not zero."""
    purchases = (
        given.table(spark, d, "events")
        .filter("event_type = 'purchase'")
        .select(
            F.col("user_id").cast("string").alias("CUSTOMER_ID"),
            F.to_date("ts").cast("string").alias("INVOICE_DATE"),
            F.lit(1).cast("bigint").alias("QUANTITY"),
            F.col("value").alias("PRICE"),
        )
    )
    result = rfm.cltv_formula(add_revenue(purchases))
    return _round(_round(result, "REVENUE AOV PROFIT_MARGIN"), "CLV CLTV", 4)


_MONTHS = [f"{y}-{m:02d}" for y in range(1995, 2002) for m in range(1, 13) if f"{y}-{m:02d}" <= "2001-08"]


@query(
    "monthly_pivot",
    with_parts(
        "monthly",
        "SELECT CUSTOMER_ID, "
        + ", ".join(f"coalesce(round(round(sum(X) FILTER (YEAR_MONTH = '{m}'), 9), 6), 0) AS \"{m}\"" for m in _MONTHS)
        + " FROM monthly GROUP BY CUSTOMER_ID",
    ),
)
def monthly_pivot(spark, d):
    wide = cltv_features.monthly_pivot(views.stored_valid(spark, d))
    return wide.withColumns({m: F.round(F.round(m, 9), 6) for m in wide.columns if m != "CUSTOMER_ID"})


_TIMES = " ".join(c for c in cltv_features.TIME_FEATURES if c != "MONTHS_ACTIVE")


@query("time_features", with_parts("features", rounded(_TIMES, "features")))
def time_features(spark, d):
    return _round(cltv_features.time_features(views.stored_valid(spark, d)), _TIMES)


_RFM_NUMBERS = (
    "FREQUENCY SOLD_QUANTITY AVG_BASKET_SIZE TOTAL_REVENUE AVG_ORDER_VALUE MAX_ORDER_VALUE MIN_ORDER_VALUE "
    "PURCHASE_FREQUENCY_RATE REVENUE_PER_DAY IS_REPEAT_CUSTOMER AVG_DAYS_BETWEEN_PURCHASES CHURN_RISK_SCORE IS_ACTIVE "
    "RECENCY_SCORE FREQUENCY_SCORE MONETARY_SCORE"
)
_FEATURES = " ".join(cltv_features.TIME_FEATURES) + " " + _RFM_NUMBERS
_ALL_RFM = ", ".join(n for n, _ in schemas.columns(schemas.CUSTOMER_RFM) if n != "CUSTOMER_ID")


@query("feature_join", with_parts("features customer_rfm", rounded(f"{_TIMES} {_DERIVED}", f"(SELECT f.*, {_ALL_RFM} FROM features f LEFT JOIN customer_rfm USING (CUSTOMER_ID))")))
def feature_join(spark, d):
    return _round(_joined(spark, d), f"{_TIMES} {_DERIVED}")


def _joined(spark, d):
    return cltv_features.feature_join(cltv_features.time_features(views.stored_valid(spark, d)), views.stored_rfm(spark, d))


@query(
    "numeric_select",
    with_parts(
        "features customer_rfm",
        rounded(f"{_TIMES} {_DERIVED}", f"(SELECT CUSTOMER_ID, {', '.join(_FEATURES.split())} FROM features LEFT JOIN customer_rfm USING (CUSTOMER_ID))"),
    ),
)
def numeric_select(spark, d):
    return _round(cltv_features.numeric_select(_joined(spark, d)), f"{_TIMES} {_DERIVED}")


@query("future_revenue_target", with_parts("future", "SELECT CUSTOMER_ID, round(round(TARGET, 9), 6) AS TARGET FROM future"))
def future_revenue_target(spark, d):
    return _round(cltv_features.future_revenue(views.stored_valid(spark, d)), "TARGET")


@query("cap_quantile", with_parts("capped", "SELECT CUSTOMER_ID, round(TARGET, 6) AS TARGET FROM capped"))
def cap_quantile(spark, d):
    target = cltv_features.future_revenue_target(views.stored_valid(spark, d))
    return target.withColumn("TARGET", F.round("TARGET", 6))


@query(
    "fill_missing_features",
    """SELECT d.doc_id, coalesce(quality, 0) AS quality, coalesce(toxic, 0) AS toxic, n_chars
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
)
def fill_missing_features(spark, d):
    joined = given.table(spark, d, "documents").select("doc_id", "n_chars").join(given.table(spark, d, "labels"), "doc_id", "left")
    return cltv_features.fill_missing_features(joined, ["quality", "toxic"])


_BUCKET = "('0x' || substr(md5(CUSTOMER_ID || '|' || '{seed}'), 1, 15))::BIGINT % {n}"


@query(
    "train_test_split",
    f"""SELECT CUSTOMER_ID, {_BUCKET.format(seed=42, n=100)} < 80 AS IS_TRAIN, CAST({_BUCKET.format(seed='fold-42', n=5)} AS INTEGER) AS FOLD
FROM (SELECT CAST(c_custkey AS VARCHAR) AS CUSTOMER_ID FROM customer)""",
)
def train_test_split(spark, d):
    keys = given.table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("CUSTOMER_ID"))
    return cltv_features.assign_fold(cltv_features.train_test_split(keys))


@query(
    "standard_scale",
    """SELECT l_orderkey, l_linenumber, l_partkey, round((l_quantity - mq) / dq, 6) AS l_quantity, round((l_extendedprice - mp) / dp, 6) AS l_extendedprice
FROM lineitem, (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS dq, avg(l_extendedprice) AS mp, stddev_pop(l_extendedprice) AS dp
                FROM lineitem WHERE l_returnflag <> 'R')""",
)
def standard_scale(spark, d):
    """Fitted on the lines that were kept, applied to all of them."""
    names = ["l_quantity", "l_extendedprice"]
    rows = given.table(spark, d, "lineitem")
    scaler = cltv_features.fit_scaler(rows.filter("l_returnflag <> 'R'"), names)
    scaled = cltv_features.standard_scale(rows, scaler)
    return scaled.select("l_orderkey", "l_linenumber", "l_partkey", *[F.round(n, 6).alias(n) for n in names])


def _naive(spark, d):
    """Target next to the early revenue carried forward: a prediction SQL can repeat."""
    sales = views.stored_valid(spark, d)
    early = cltv_features.time_features(sales).select("CUSTOMER_ID", (F.col("AVG_MONTHLY_REVENUE") * 60).alias("PREDICTION"))
    return cltv_features.future_revenue(sales).join(early, "CUSTOMER_ID")


_NAIVE_SQL = "(SELECT CUSTOMER_ID, TARGET, AVG_MONTHLY_REVENUE * 60 AS PREDICTION FROM future JOIN features USING (CUSTOMER_ID))"


@query(
    "model_metrics",
    with_parts(
        "future features",
        f"""SELECT round(1 - avg(e * e) / var_pop(TARGET), 4) AS R2, round(avg(abs(e)), 2) AS MAE, round(sqrt(avg(e * e)), 2) AS RMSE,
       round(avg(abs(e / (TARGET + 1))) * 100, 2) AS MAPE FROM (SELECT *, TARGET - PREDICTION AS e FROM {_NAIVE_SQL})""",
    ),
)
def model_metrics(spark, d):
    return cltv_models.model_metrics(_naive(spark, d))


@query(
    "prediction_table",
    with_parts(
        "future features",
        f"""SELECT CUSTOMER_ID, round(round(TARGET, 9), 6) AS ACTUAL_CLV, round(round(PREDICTION, 9), 6) AS PREDICTED_CLV,
       round(round(TARGET - PREDICTION, 9), 6) AS ERROR, round(round((TARGET - PREDICTION) / (TARGET + 1) * 100, 9), 6) AS ERROR_PCT FROM {_NAIVE_SQL}""",
    ),
)
def prediction_table(spark, d):
    return _round(cltv_models.prediction_table(_naive(spark, d)), "ACTUAL_CLV PREDICTED_CLV ERROR ERROR_PCT")


@query(
    "cap_quantile_count",
    with_parts(
        "future",
        """SELECT round(q, 6) AS CAP, (SELECT count(*) FROM future WHERE TARGET > q) AS CAPPED
FROM (SELECT quantile_cont(TARGET, 0.95) AS q FROM future)""",
    ),
)
def cap_quantile_count(spark, d):
    found = cltv_features.capped_target(views.stored_valid(spark, d))
    return spark.createDataFrame([(round(found.cap, 6), found.count)], "CAP DOUBLE, CAPPED BIGINT")


def _prepared(spark, d):
    data = views.model_frame(spark, d)
    return cltv_models.prepare(data, [c for c in data.columns if c not in ("CUSTOMER_ID", "TARGET")])


@query("train_models")
def train_models(spark, d):
    """All five models with hold-out and five-fold scores."""
    prepared = _prepared(spark, d)
    results = cltv_models.train_models(spark, prepared).results
    prepared.release()
    return results


@query("cross_validate")
def cross_validate(spark, d):
    """Scores of all five models on the five folds."""
    prepared = _prepared(spark, d)
    scores = cltv_models.cross_validate(prepared, list(cltv_models.estimators()))
    prepared.release()
    rows = [(m, f, float(v)) for m, folds in scores.items() for f, v in enumerate(folds)]
    return spark.createDataFrame(rows, "MODEL STRING, FOLD INT, MAE DOUBLE")


@query("feature_importance")
def feature_importance(spark, d):
    """Weights of every feature in all five models."""
    prepared = _prepared(spark, d)
    models = cltv_models.fit_models(prepared, list(cltv_models.estimators()))
    prepared.release()
    parts = [
        cltv_models.feature_importance(spark, m, prepared.features).withColumn("MODEL", F.lit(n)) for n, m in models.items()
    ]
    return reduce(DataFrame.unionByName, parts)


_LINE = "SELECT CUSTOMER_ID, AVG_MONTHLY_REVENUE AS x, TARGET AS y, {split} AS IS_TRAIN FROM features JOIN capped USING (CUSTOMER_ID)"


@query(
    "linear_fit",
    with_parts(
        "features capped",
        f"""SELECT CUSTOMER_ID, round(y, 4) AS TARGET, round(my + slope * (x - mx), 4) AS PREDICTION, round(my + ridge * (x - mx), 4) AS RIDGE
FROM ({_LINE.format(split=_BUCKET.format(seed=42, n=100) + ' < 80')}),
 (SELECT avg(x) AS mx, avg(y) AS my, covar_pop(x, y) / var_pop(x) AS slope,
    covar_pop(x, y) / stddev_pop(x) * count(*) / (count(*) + 1.0::DOUBLE) / stddev_pop(x) AS ridge
  FROM ({_LINE.format(split=_BUCKET.format(seed=42, n=100) + ' < 80')}) WHERE IS_TRAIN)
WHERE NOT IS_TRAIN""",
    ),
)
def linear_fit(spark, d):
    """Least squares and ridge on one feature: test predictions against their closed forms."""
    sales = views.stored_valid(spark, d)
    one = cltv_features.time_features(sales).select("CUSTOMER_ID", "AVG_MONTHLY_REVENUE")
    prepared = cltv_models.prepare(cut_lineage(one.join(cltv_features.future_revenue_target(sales), "CUSTOMER_ID")), ["AVG_MONTHLY_REVENUE"])
    models = cltv_models.fit_models(prepared, ["Linear Regression", "Ridge"])
    scored = {n: m.transform(prepared.side(n).filter("NOT IS_TRAIN")) for n, m in models.items()}
    ridge = scored["Ridge"].select("CUSTOMER_ID", F.round("PREDICTION", 4).alias("RIDGE"))
    plain = scored["Linear Regression"].select("CUSTOMER_ID", F.round("TARGET", 4).alias("TARGET"), F.round("PREDICTION", 4).alias("PREDICTION"))
    return plain.join(ridge, "CUSTOMER_ID")


def _cltv_warehouse(spark, d) -> Warehouse:
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    wh.write_batch("GOLD", "FACT_SALES", views.fact(spark, d), "first", schemas.FACT_SALES)
    steps.load_rfm(wh)
    steps.load_cltv(wh)
    return wh


@query("cltv_tables")
def cltv_tables(spark, d):
    """Rows of both stored tables, from all five models and five folds: the predictions of the best, the scores of all."""
    wh = _cltv_warehouse(spark, d)
    customers = wh.read("GOLD_DIM_CUSTOMER_CLTV").select(F.lit("GOLD_DIM_CUSTOMER_CLTV").alias("table_name"), F.col("CUSTOMER_ID").alias("key"),
                                                         F.array("ACTUAL_CLV", "PREDICTED_CLV", "ERROR", "ERROR_PCT").alias("numbers"))
    models = wh.read("GOLD_DIM_CLTV_MODEL_RESULTS").select(F.lit("GOLD_DIM_CLTV_MODEL_RESULTS").alias("table_name"), F.col("MODEL").alias("key"),
                                                           F.array("R2", "MAE", "RMSE", "MAPE", "CV_MAE").alias("numbers"))
    return customers.unionByName(models)
