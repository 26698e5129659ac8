"""Queries on profiling and exploration."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.operators import explore, profiling
from tillwork.plans import sample_tables as given
from tillwork.plans import views
from tillwork.plans.oracle_parts import with_parts
from tillwork.plans.registry import query
from tillwork.session import stage

_RAW = ("INVOICE", "STOCKCODE", "DESCRIPTION", "QUANTITY", "PRICE", "CUSTOMER_ID", "COUNTRY")
_ORDERS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
_LINE_NUMBERS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")

_RAW_BYTES = " + ".join(f"8 * count({c})" if c in ("QUANTITY", "PRICE") else f"coalesce(sum(strlen({c})), 0)" for c in _RAW)


def _raw(spark, d):
    return given.raw_sales(spark, d).select(*_RAW)


def _orders(spark, d):
    return given.table(spark, d, "orders").select(*_ORDERS)


def _numbers(spark, d):
    return given.table(spark, d, "lineitem").select(*_LINE_NUMBERS)


@query("profile_head", f"SELECT {', '.join(_ORDERS)} FROM orders ORDER BY o_orderkey LIMIT 100")
def profile_head(spark, d):
    return profiling.profile_head(_orders(spark, d), 100, ["o_orderkey"])


@query("profile_tail", f"SELECT {', '.join(_ORDERS)} FROM orders ORDER BY o_orderkey DESC LIMIT 100")
def profile_tail(spark, d):
    return profiling.profile_tail(_orders(spark, d), 100, ["o_orderkey"])


@query("profile_sample", f"SELECT {', '.join(_ORDERS)} FROM orders ORDER BY md5(o_orderkey || '|' || '42') LIMIT 100")
def profile_sample(spark, d):
    return profiling.profile_sample(_orders(spark, d), 100, ["o_orderkey"])


@query(
    "profile_info",
    with_parts(
        "raw",
        "SELECT 'Total Entries' AS \"Column\", CAST(count(*) AS VARCHAR) AS \"Non-Null Count\", '' AS \"Null Count\", '' AS \"Dtype\" FROM raw\n"
        f"UNION ALL SELECT 'Total Columns', '{len(_RAW)}', '', ''\n"
        f"UNION ALL SELECT 'Memory Usage', '', '', printf('%.1f', ({_RAW_BYTES}) / 1048576.0) || ' MB' FROM raw\n"
        + "\n".join(
            f"UNION ALL SELECT '{c}', CAST(count({c}) AS VARCHAR), CAST(count(*) - count({c}) AS VARCHAR), "
            f"'{ {'QUANTITY': 'bigint', 'PRICE': 'double'}.get(c, 'string') }' FROM raw"
            for c in _RAW
        ),
    ),
)
def profile_info(spark, d):
    return profiling.profile_info(_raw(spark, d))


def _describe(c: str) -> str:
    if c in ("QUANTITY", "PRICE"):
        return f"""SELECT '{c}' AS col, count({c}) AS "count", NULL::BIGINT AS "unique", NULL::VARCHAR AS top, NULL::BIGINT AS freq,
  round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS min, round(CAST(quantile_cont({c}, 0.25) AS DOUBLE), 6) AS p25,
  round(CAST(quantile_cont({c}, 0.5) AS DOUBLE), 6) AS p50, round(CAST(quantile_cont({c}, 0.75) AS DOUBLE), 6) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM raw"""
    return f"""SELECT '{c}' AS col, CAST(sum(n) AS BIGINT) AS "count", count(*) AS "unique", arg_min({c}, (-n, {c})) AS top, max(n) AS freq,
  NULL::DOUBLE AS mean, NULL::DOUBLE AS std, NULL::DOUBLE AS min, NULL::DOUBLE AS p25, NULL::DOUBLE AS p50, NULL::DOUBLE AS p75, NULL::DOUBLE AS max
FROM (SELECT {c}, count(*) AS n FROM raw WHERE {c} IS NOT NULL GROUP BY {c})"""


@query("profile_describe", with_parts("raw", "\nUNION ALL ".join(_describe(c) for c in _RAW)))
def profile_describe(spark, d):
    table = profiling.profile_describe(_raw(spark, d))
    return table.withColumns({c: F.round(c, 6) for c in ("mean", "std", "p25", "p50", "p75")})


def _rate(name: str, expression: str) -> str:
    return with_parts("raw", "\nUNION ALL ".join(f"SELECT '{c}' AS col, {expression.format(c=c)} AS {name} FROM raw" for c in _RAW))


@query("profile_fill_rate", _rate("fill_rate", "round((1 - CAST(count(*) - count({c}) AS DOUBLE) / count(*)) * 100, 2)"))
def profile_fill_rate(spark, d):
    return profiling.profile_fill_rate(_raw(spark, d))


@query("profile_missing_rate", _rate("null_rate", "round(CAST(count(*) - count({c}) AS DOUBLE) / count(*) * 100, 2)"))
def profile_missing_rate(spark, d):
    return profiling.profile_missing_rate(_raw(spark, d))


@query(
    "profile_value_share",
    with_parts(
        "raw",
        "SELECT col, value, CAST(n AS DOUBLE) / total * 100 AS share FROM (SELECT *, row_number() OVER (PARTITION BY col ORDER BY n DESC, value) AS r, "
        "sum(n) OVER (PARTITION BY col) AS total FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS col, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM raw WHERE {c} IS NOT NULL GROUP BY {c}" for c in _RAW
        )
        + ")) WHERE r <= 20",
    ),
)
def profile_value_share(spark, d):
    return profiling.profile_value_share(_raw(spark, d))


@query(
    "profile_need_trim",
    """SELECT 'doc_id' AS col, 0::BIGINT AS needs_trim
UNION ALL SELECT 'text', count(*) FILTER (text LIKE ' %' OR text LIKE '% ') FROM documents
UNION ALL SELECT 'lang', count(*) FILTER (lang LIKE ' %' OR lang LIKE '% ') FROM documents""",
)
def profile_need_trim(spark, d):
    return profiling.profile_need_trim(given.table(spark, d, "documents").select("doc_id", "text", "lang"))


@query(
    "profile_need_trim_sales",
    with_parts(
        "raw",
        "\nUNION ALL ".join(
            f"SELECT '{c}' AS col, " + ("0::BIGINT" if c in ("QUANTITY", "PRICE") else f"count(*) FILTER ({c} LIKE ' %' OR {c} LIKE '% ')") + " AS needs_trim" + ("" if c in ("QUANTITY", "PRICE") else " FROM raw")
            for c in _RAW
        ),
    ),
)
def profile_need_trim_sales(spark, d):
    return profiling.profile_need_trim(_raw(spark, d))


@query(
    "profile_distribution_skewness",
    "\nUNION ALL ".join(f"SELECT '{c}' AS col, round(skewness({c}), 5) AS skewness FROM lineitem" for c in _LINE_NUMBERS),
)
def profile_distribution_skewness(spark, d):
    return profiling.profile_distribution(_numbers(spark, d))["Skewness"].withColumn("skewness", F.round("skewness", 5))


@query(
    "profile_distribution_histogram",
    "\nUNION ALL ".join(
        f"""SELECT '{c}' AS col, CAST(least(floor((v - lo) * 10 / (hi - lo)) + 1, 10) AS INTEGER) AS bin, count(*) AS n
FROM (SELECT CAST({c} AS DOUBLE) AS v, CAST(min({c}) OVER () AS DOUBLE) AS lo, CAST(max({c}) OVER () AS DOUBLE) AS hi FROM lineitem) GROUP BY 2"""
        for c in _LINE_NUMBERS
    ),
)
def profile_distribution_histogram(spark, d):
    return profiling.profile_distribution(_numbers(spark, d))["Histogram"]


@query(
    "profile_corr_matrix",
    "\nUNION ALL ".join(
        f"SELECT '{a}' AS feature, "
        + ", ".join("1.0::DOUBLE" + f" AS {b}" if a == b else f"round(corr({a}, {b}), 6) AS {b}" for b in _LINE_NUMBERS)
        + " FROM lineitem"
        for a in _LINE_NUMBERS
    ),
)
def profile_corr_matrix(spark, d):
    matrix = profiling.profile_corr_matrix(_numbers(spark, d))
    return matrix.withColumns({c: F.round(c, 6) for c in _LINE_NUMBERS})


_PAIRS = "(" + " UNION ALL ".join(
    f"SELECT '{b}' AS feature_1, '{a}' AS feature_2, corr({a}, {b}) AS c FROM lineitem"
    for i, a in enumerate(_LINE_NUMBERS)
    for b in _LINE_NUMBERS[i + 1 :]
) + ")"


@query("profile_corr_top_positive", f"SELECT feature_1, feature_2, round(c, 6) AS correlation FROM {_PAIRS} ORDER BY c DESC LIMIT 10")
def profile_corr_top_positive(spark, d):
    return profiling.profile_corr_top(_numbers(spark, d))[0].withColumn("correlation", F.round("correlation", 6))


@query("profile_corr_top_negative", f"SELECT feature_1, feature_2, round(c, 6) AS correlation FROM {_PAIRS} ORDER BY c LIMIT 10")
def profile_corr_top_negative(spark, d):
    return profiling.profile_corr_top(_numbers(spark, d))[1].withColumn("correlation", F.round("correlation", 6))


_ALL_TYPES = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double"}
_ALL_NUMBERS = list(_ALL_TYPES)
_BYTES = " + ".join(f"sum({'8' if c in _ALL_TYPES else f'strlen({c})'})" for c in _ORDERS)


def _cell(result: str, key: str, text: str, number: str, source: str) -> str:
    return f"SELECT '{result}' AS result, {key} AS key, {text} AS text, CAST({number} AS DOUBLE) AS number FROM {source}"


def _all_parts() -> list[str]:
    line = "concat_ws('|', o_custkey, o_orderstatus, o_orderpriority)"
    parts = [
        _cell("Head", "CAST(o_orderkey AS VARCHAR)", line, "o_totalprice", "(SELECT * FROM orders ORDER BY o_orderkey LIMIT 100)"),
        _cell("Tail", "CAST(o_orderkey AS VARCHAR)", line, "o_totalprice", "(SELECT * FROM orders ORDER BY o_orderkey DESC LIMIT 100)"),
        _cell("Sample", "CAST(o_orderkey AS VARCHAR)", line, "o_totalprice", "(SELECT * FROM orders ORDER BY md5(o_orderkey || '|' || '42') LIMIT 100)"),
        _cell("Info", "'Total Entries'", "CAST(count(*) AS VARCHAR) || '||'", "NULL", "orders"),
        _cell("Info", "'Total Columns'", f"'{len(_ORDERS)}||'", "NULL", "(SELECT 1)"),
        _cell("Info", "'Memory Usage'", f"'||' || printf('%.1f', ({_BYTES}) / 1048576.0) || ' MB'", "NULL", "orders"),
    ]
    for k, c in enumerate(_ORDERS):
        kind = _ALL_TYPES.get(c, "string")
        parts += [
            _cell("Info", f"'{c}'", f"count({c}) || '|' || (count(*) - count({c})) || '|{kind}'", "NULL", "orders"),
            _cell("Col_list", f"'{c}'", "NULL", str(k), "(SELECT 1)"),
            _cell("Missing_rates", f"'{c}'", "NULL", f"round(CAST(count(*) - count({c}) AS DOUBLE) / count(*) * 100, 2)", "orders"),
            _cell("Fullfill_rates", f"'{c}'", "NULL", f"round((1 - CAST(count(*) - count({c}) AS DOUBLE) / count(*)) * 100, 2)", "orders"),
            _cell("Trim_me", f"'{c}'", "NULL", "0", "(SELECT 1)") if c in _ALL_TYPES
            else _cell("Trim_me", f"'{c}'", "NULL", f"count(*) FILTER ({c} LIKE ' %' OR {c} LIKE '% ')", "orders"),
            _cell("Describe", f"'{c}:count'", "NULL", f"count({c})", "orders"),
            _cell(
                "Share_value", f"'{c}:' || value" if c != "o_totalprice" else f"'{c}:' || printf('%.6f', value)", "NULL", "round(share, 6)",
                f"(SELECT {c} AS value, count(*) * 100.0::DOUBLE / sum(count(*)) OVER () AS share FROM orders GROUP BY {c}"
                f" ORDER BY count(*) DESC, {_as_text(c)} LIMIT 20)",
            ),
        ]
        if c not in _ALL_TYPES:
            counts = f"(SELECT {c}, count(*) AS n FROM orders GROUP BY {c})"
            parts += [
                _cell("Describe", f"'{c}:unique'", "NULL", "count(*)", counts),
                _cell("Describe", f"'{c}:top'", f"arg_min({c}, (-n, {c}))", "max(n)", counts),
            ]
            continue
        for name, value in {
            "mean": f"avg({c})", "std": f"stddev_samp({c})", "min": f"min({c})", "p25": f"quantile_cont({c}, 0.25)",
            "p50": f"quantile_cont({c}, 0.5)", "p75": f"quantile_cont({c}, 0.75)", "max": f"max({c})",
        }.items():
            parts.append(_cell("Describe", f"'{c}:{name}'", "NULL", f"round(CAST({value} AS DOUBLE), 4)", "orders"))
        binned = f"""(SELECT CAST(least(floor((v - lo) * 10 / (hi - lo)) + 1, 10) AS INTEGER) AS bin, count(*) AS n FROM (SELECT CAST({c} AS DOUBLE) AS v,
 CAST(min({c}) OVER () AS DOUBLE) AS lo, CAST(max({c}) OVER () AS DOUBLE) AS hi FROM orders) GROUP BY 1)"""
        parts += [
            _cell("Variance", f"'{c}'", "NULL", f"round(skewness({c}), 5)", "orders"),
            _cell("Histogram", f"'{c}:' || bin", "NULL", "n", binned),
        ]
        for other in _ALL_NUMBERS:
            diagonal = c == other
            value, source = ("1", "(SELECT 1)") if diagonal else (f"round(corr({c}, {other}), 6)", "orders")
            parts.append(_cell("Corr_Matrix", f"'{c}:{other}'", "NULL", value, source))
    pairs = [(b, a) for i, a in enumerate(_ALL_NUMBERS) for b in _ALL_NUMBERS[i + 1 :]]
    for result in ("Corr_Series_Pos", "Corr_Series_Neg"):
        parts += [_cell(result, f"'{b}:{a}'", "NULL", f"round(corr({a}, {b}), 6)", "orders") for b, a in pairs]
    return parts


def _as_text(c: str) -> str:
    """Order of a value's text among equals; whole numbers have the same text in both engines."""
    return f"CAST({c} AS VARCHAR)"


@query("profile_all", "\nUNION ALL ".join(_all_parts()))
def profile_all(spark, d):
    """The rows of all fifteen results, as (result, key, text, number)."""
    found = profiling.profile_all(_orders(spark, d), ["o_orderkey"])

    def rows(name, df, key, text=None, number=None):
        return df.select(
            F.lit(name).alias("result"), key.alias("key"), (F.lit(None) if text is None else text).cast("string").alias("text"),
            (F.lit(None) if number is None else number).cast("double").alias("number"),
        )

    col, line = F.col("col"), F.concat_ws("|", "o_custkey", "o_orderstatus", "o_orderpriority")
    parts = [rows(n, found[n], F.col("o_orderkey").cast("string"), line, F.col("o_totalprice")) for n in ("Head", "Tail", "Sample")]
    parts.append(rows("Info", found["Info"], F.col("Column"), F.concat_ws("|", "Non-Null Count", "Null Count", "Dtype")))
    names = spark.createDataFrame(list(enumerate(found["Col_list"])), "k INT, col STRING")
    parts.append(rows("Col_list", names, col, None, F.col("k")))
    parts += [
        rows("Missing_rates", found["Missing_rates"], col, None, F.col("null_rate")),
        rows("Fullfill_rates", found["Fullfill_rates"], col, None, F.col("fill_rate")),
        rows("Trim_me", found["Trim_me"], col, None, F.col("needs_trim")),
        rows("Variance", found["Variance"], col, None, F.round("skewness", 5)),
        rows("Histogram", found["Histogram"], F.concat_ws(":", "col", "bin"), None, F.col("n")),
    ]
    price = F.format_string("%.6f", F.col("value").cast("double"))
    shown = F.when(col == "o_totalprice", price).otherwise(F.col("value"))
    parts.append(rows("Share_value", found["Share_value"], F.concat_ws(":", col, shown), None, F.round("share", 6)))
    table = stage(found["Describe"], "describe")
    parts.append(rows("Describe", table, F.concat(col, F.lit(":count")), None, F.col("count")))
    texts = table.filter("top IS NOT NULL")
    parts.append(rows("Describe", texts, F.concat(col, F.lit(":unique")), None, F.col("unique")))
    parts.append(rows("Describe", texts, F.concat(col, F.lit(":top")), F.col("top"), F.col("freq")))
    stats = ["mean", "std", "min", "p25", "p50", "p75", "max"]
    long = table.filter("mean IS NOT NULL").unpivot(["col"], stats, "k", "v")
    parts.append(rows("Describe", long, F.concat_ws(":", "col", "k"), None, F.round("v", 4)))
    matrix = found["Corr_Matrix"].unpivot(["feature"], _ALL_NUMBERS, "k", "v")
    parts.append(rows("Corr_Matrix", matrix, F.concat_ws(":", "feature", "k"), None, F.round("v", 6)))
    for name in ("Corr_Series_Pos", "Corr_Series_Neg"):
        parts.append(rows(name, found[name], F.concat_ws(":", "feature_1", "feature_2"), None, F.round("correlation", 6)))
    return reduce(DataFrame.unionByName, parts)


_RETURN = "QUANTITY < 0 OR regexp_matches(coalesce(INVOICE, ''), '[A-Za-z]')"


@query("split_returns", with_parts("raw", f"SELECT INVOICE, STOCKCODE, QUANTITY FROM raw WHERE {_RETURN}"))
def split_returns(spark, d):
    return explore.split_returns_sales(_raw(spark, d))[0].select("INVOICE", "STOCKCODE", "QUANTITY")


@query("split_sales", with_parts("raw", f"SELECT INVOICE, STOCKCODE, QUANTITY FROM raw WHERE NOT ({_RETURN})"))
def split_sales(spark, d):
    return explore.split_returns_sales(_raw(spark, d))[1].select("INVOICE", "STOCKCODE", "QUANTITY")


@query("unique_countries", with_parts("silver", "SELECT DISTINCT COUNTRY FROM silver"))
def unique_countries(spark, d):
    return explore.unique_countries(views.silver(spark, d))


@query("unique_descriptions", with_parts("raw", "SELECT DISTINCT DESCRIPTION FROM raw WHERE DESCRIPTION IS NOT NULL"))
def unique_descriptions(spark, d):
    return explore.unique_descriptions(_raw(spark, d))


@query("descriptions_per_code", with_parts("raw", "SELECT DISTINCT STOCKCODE, DESCRIPTION FROM raw"))
def descriptions_per_code(spark, d):
    return explore.descriptions_per_code(_raw(spark, d))


_CODE = """SELECT STOCKCODE, PRICE, DESCRIPTION,
  CASE WHEN DESCRIPTION > 1 THEN '1 code = X descri' ELSE '1 code = 1 descri' END AS ISSUE_COUNT_DESCRI,
  CAST(length(STOCKCODE) AS INTEGER) AS LENGTH_CODE,
  CASE WHEN length(STOCKCODE) < avg(length(STOCKCODE)) OVER () THEN 'MAYBE' ELSE 'MAYBE NO' END AS ISSUE_LENGTH_CODE,
  CASE WHEN PRICE > avg(PRICE) OVER () THEN '1 code = X prices' ELSE '1 code = 1 price' END AS ISSUE_COUNT_PRICE_CODE
FROM (SELECT STOCKCODE, count(DISTINCT PRICE) AS PRICE, count(DISTINCT DESCRIPTION) AS DESCRIPTION FROM silver GROUP BY STOCKCODE)"""
_DESCRIPTION = """SELECT DESCRIPTION, STOCKCODE, PRICE,
  CASE WHEN STOCKCODE > 1 THEN '1 descri = X codes' ELSE '1 descri = 1 code' END AS ISSUE_COUNT_CODE,
  CAST(length(DESCRIPTION) AS INTEGER) AS LENGTH_DESCRI,
  CASE WHEN length(DESCRIPTION) < avg(length(DESCRIPTION)) OVER () THEN 'MAYBE' ELSE 'MAYBE NO' END AS ISSUE_LENGTH_DESCRI,
  CASE WHEN PRICE > avg(PRICE) OVER () THEN '1 descri = X prices' ELSE '1 descri = 1 price' END AS ISSUE_COUNT_PRICE_DESCRI
FROM (SELECT DESCRIPTION, count(DISTINCT STOCKCODE) AS STOCKCODE, count(DISTINCT PRICE) AS PRICE FROM silver GROUP BY DESCRIPTION)"""


@query("description_count_per_code", with_parts("silver", _CODE))
def description_count_per_code(spark, d):
    return explore.description_count_per_code(views.silver(spark, d))


@query(
    "description_count_per_code_raw",
    with_parts("raw", "SELECT STOCKCODE, count(DISTINCT PRICE) AS PRICE, count(DISTINCT DESCRIPTION) AS DESCRIPTION FROM raw GROUP BY STOCKCODE"),
)
def description_count_per_code_raw(spark, d):
    return explore.description_count_per_code(_raw(spark, d), flags=False)


@query(
    "description_count_per_code_country",
    with_parts(
        "silver",
        """SELECT STOCKCODE, COUNTRY, PRICE, DESCRIPTION,
  CASE WHEN DESCRIPTION > 1 THEN '1 pair = X descri' ELSE '1 pair = 1 descri' END AS ISSUE_COUNT_DESCRI,
  CASE WHEN PRICE > avg(PRICE) OVER () THEN '1 pair = X prices' ELSE '1 pair = 1 price' END AS ISSUE_COUNT_PRICE
FROM (SELECT STOCKCODE, COUNTRY, count(DISTINCT PRICE) AS PRICE, count(DISTINCT DESCRIPTION) AS DESCRIPTION FROM silver GROUP BY ALL)""",
    ),
)
def description_count_per_code_country(spark, d):
    return explore.description_count_per_code_country(views.silver(spark, d))


@query("code_count_per_description", with_parts("silver", _DESCRIPTION))
def code_count_per_description(spark, d):
    return explore.code_count_per_description(views.silver(spark, d))


@query(
    "faulty_descriptions",
    with_parts(
        "silver",
        f""", pc AS ({_CODE}), pd AS ({_DESCRIPTION})
SELECT s.INVOICE, s.STOCKCODE, s.DESCRIPTION, s.QUANTITY, s.PRICE, s.CUSTOMER_ID, s.COUNTRY, s.INVOICE_TYPE,
  pc.ISSUE_COUNT_DESCRI, pc.LENGTH_CODE, pc.ISSUE_LENGTH_CODE, pc.ISSUE_COUNT_PRICE_CODE,
  pd.ISSUE_COUNT_CODE, pd.LENGTH_DESCRI, pd.ISSUE_LENGTH_DESCRI, pd.ISSUE_COUNT_PRICE_DESCRI,
  CASE WHEN pc.ISSUE_COUNT_DESCRI = 'MAYBE' OR pc.ISSUE_LENGTH_CODE = 'MAYBE' OR pc.ISSUE_COUNT_PRICE_CODE = '1 code = X prices'
    OR pd.ISSUE_COUNT_CODE = '1 descri = X codes' OR pd.ISSUE_LENGTH_DESCRI = 'MAYBE' OR pd.ISSUE_COUNT_PRICE_DESCRI = '1 descri = X prices'
    THEN 'YES' ELSE 'NO' END AS TO_CHECK
FROM silver s LEFT JOIN pc ON pc.STOCKCODE = s.STOCKCODE LEFT JOIN pd ON pd.DESCRIPTION = s.DESCRIPTION""",
    ),
)
def faulty_descriptions(spark, d):
    sales = stage(views.silver(spark, d))
    return explore.faulty_descriptions(
        sales, explore.description_count_per_code(sales), explore.code_count_per_description(sales)
    )


@query(
    "multi_country_customers",
    """WITH p AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS CUSTOMER_ID, n_name AS COUNTRY
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey)
SELECT CUSTOMER_ID, COUNTRY FROM (SELECT *, count(*) OVER (PARTITION BY CUSTOMER_ID) AS n FROM p) WHERE n > 1""",
)
def multi_country_customers(spark, d):
    """Customers against the countries they bought from."""
    bought = (
        given.table(spark, d, "orders")
        .join(given.table(spark, d, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(given.table(spark, d, "supplier"), F.col("s_suppkey") == F.col("l_suppkey"))
        .join(given.table(spark, d, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
        .select(F.col("o_custkey").alias("CUSTOMER_ID"), F.col("n_name").alias("COUNTRY"))
    )
    return explore.multi_country_customers(bought)
