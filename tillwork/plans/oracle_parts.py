"""SQL fragments the oracle queries are put together from."""

from __future__ import annotations

from tillwork.functions import fixed_values as fixed

_PARTS: dict[str, tuple[tuple[str, ...], str]] = {}


def part(name: str, needs: tuple[str, ...], sql: str) -> None:
    _PARTS[name] = (needs, sql)


def _needed(names: tuple[str, ...], seen: list[str]) -> list[str]:
    for n in names:
        if n not in seen:
            _needed(_PARTS[n][0], seen)
            if n not in seen:
                seen.append(n)
    return seen


def with_parts(names: str, select: str) -> str:
    """WITH clause holding the named fragments and all they need, then the query."""
    order = _needed(tuple(names.split()), [])
    return "WITH " + ",\n".join(f"{n} AS ({_PARTS[n][1]})" for n in order) + "\n" + select


def bare(c: str) -> str:
    return f"regexp_replace(upper(trim({c})), '\\s+', '_', 'g')"


def key(c: str) -> str:
    return f"coalesce({bare(c)}, 'UNKNOWN')"


def words(c: str) -> str:
    joined = f"regexp_replace(regexp_replace(regexp_replace({c}, '[^0-9A-Za-z_]', '_', 'g'), '^_+|_+$', '', 'g'), '_+', '_', 'g')"
    return f"coalesce(upper(nullif({joined}, '')), 'UNKNOWN')"


def title(c: str) -> str:
    pieces = f"string_split(lower(replace({c}, '_', ' ')), ' ')"
    return f"trim(array_to_string(list_transform({pieces}, lambda w: upper(w[1:1]) || w[2:]), ' '))"


def stable_id(c: str) -> str:
    return f"('0x' || substr(md5({c}), 1, 15))::BIGINT"


def product_key(code: str, name: str) -> str:
    return stable_id(f"length({code}) || ':' || {code} || {name}")


def rounded(columns: str, source: str, digits: int = 6) -> str:
    """All columns of a fragment, the named ones rounded twice, so that noise in the last bits does not decide a half."""
    return f"SELECT * REPLACE ({', '.join(f'round(round({c}, {digits + 3}), {digits}) AS {c}' for c in columns.split())}) FROM {source}"


def case_map(c: str, pairs: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs.items())
    return f"CASE {c} {whens} ELSE NULL END"


def text_list(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def offset(zone: str, at: str) -> str:
    """+HHMM of a zone at a UTC wall-clock time."""
    minutes = f"date_diff('minute', {at}, timezone({zone}, timezone('UTC', {at})))"
    text = (
        f"CASE WHEN {minutes} < 0 THEN '-' ELSE '+' END || lpad(CAST(abs({minutes}) // 60 AS VARCHAR), 2, '0')"
        f" || lpad(CAST(abs({minutes}) % 60 AS VARCHAR), 2, '0')"
    )
    return f"CASE WHEN {zone} IN ('Europe/London', 'America/New_York', 'Asia/Kolkata') THEN {text} END"


part(
    "raw",
    (),
    """SELECT CASE WHEN l_returnflag = 'R' THEN 'c' ELSE '' END || CAST(o_orderkey AS VARCHAR) AS INVOICE,
       lower(p_brand) || ' ' AS STOCKCODE,
       CASE WHEN l_linenumber % 7 = 0 THEN NULL ELSE ' ' || p_name || '  ' END AS DESCRIPTION,
       CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS BIGINT) AS QUANTITY,
       o_orderdate AS INVOICEDATE,
       p_retailprice AS PRICE,
       CASE WHEN o_custkey % 17 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS CUSTOMER_ID,
       CASE n_nationkey WHEN 0 THEN 'EIRE' WHEN 1 THEN 'RSA' WHEN 2 THEN 'Unspecified'
                        WHEN 3 THEN 'West Indies ' ELSE n_name END AS COUNTRY
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
     JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey""",
)
part(
    "silver",
    ("raw",),
    f"""SELECT {key('INVOICE')} AS INVOICE, {key('STOCKCODE')} AS STOCKCODE, {key('DESCRIPTION')} AS DESCRIPTION,
       QUANTITY, PRICE, coalesce(CUSTOMER_ID, 'UNKNOWN') AS CUSTOMER_ID,
       replace({key('COUNTRY')}, 'UNSPECIFIED', 'UNKNOWN') AS COUNTRY,
       strftime(INVOICEDATE, '%Y-%m-%d') AS INVOICE_DATE, strftime(INVOICEDATE, '%H:%M:%S') AS INVOICE_TIME,
       CASE WHEN QUANTITY < 0 OR NOT regexp_full_match({key('INVOICE')}, '[0-9]+') THEN 'RETURN' ELSE 'SALE' END
         AS INVOICE_TYPE
FROM (SELECT DISTINCT * FROM raw)""",
)
part("lines", ("silver",), "SELECT *, QUANTITY * PRICE AS REVENUE FROM silver")
part(
    "valid",
    ("lines",),
    "SELECT *, substr(INVOICE_DATE, 1, 7) AS YEAR_MONTH FROM lines WHERE QUANTITY > 0 AND PRICE > 0 AND CUSTOMER_ID <> 'UNKNOWN'",
)
part(
    "metrics",
    ("valid",),
    f"""SELECT CUSTOMER_ID,
       date_diff('day', max(CAST(INVOICE_DATE AS DATE)), (SELECT max(CAST(INVOICE_DATE AS DATE)) + 1 FROM valid)) AS RECENCY,
       date_diff('day', min(CAST(INVOICE_DATE AS DATE)), max(CAST(INVOICE_DATE AS DATE))) AS TENURE,
       min(INVOICE_DATE) AS DATE_FIRST_PURCHASE, max(INVOICE_DATE) AS DATE_LAST_PURCHASE,
       count(DISTINCT INVOICE) AS FREQUENCY, CAST(sum(QUANTITY) AS DOUBLE) AS SOLD_QUANTITY,
       CAST(sum(QUANTITY) AS DOUBLE) / count(QUANTITY) AS AVG_BASKET_SIZE,
       sum(REVENUE) AS TOTAL_REVENUE, sum(REVENUE) / count(REVENUE) AS AVG_ORDER_VALUE,
       max(REVENUE) AS MAX_ORDER_VALUE, min(REVENUE) AS MIN_ORDER_VALUE
FROM valid GROUP BY CUSTOMER_ID""",
)
part(
    "derived",
    ("metrics",),
    """SELECT *, RECENCY / (AVG_DAYS_BETWEEN_PURCHASES + 1) AS CHURN_RISK_SCORE,
       CASE WHEN RECENCY <= 90 THEN 1 ELSE 0 END AS IS_ACTIVE
FROM (SELECT *, CAST(FREQUENCY AS DOUBLE) / (TENURE + 1) AS PURCHASE_FREQUENCY_RATE,
             TOTAL_REVENUE / (TENURE + 1) AS REVENUE_PER_DAY,
             CASE WHEN FREQUENCY > 1 THEN 1 ELSE 0 END AS IS_REPEAT_CUSTOMER,
             CAST(TENURE AS DOUBLE) / FREQUENCY AS AVG_DAYS_BETWEEN_PURCHASES FROM metrics)""",
)


def bucket(value: str) -> str:
    r, n = f"row_number() OVER (ORDER BY {value}, CUSTOMER_ID)", "count(*) OVER ()"
    return f"CAST(greatest(1, (5 * ({r} - 1) + ({n} - 1) - 1) // ({n} - 1)) AS INTEGER)"


part(
    "scored",
    ("derived",),
    f"""SELECT *, CAST(RECENCY_SCORE AS VARCHAR) || CAST(FREQUENCY_SCORE AS VARCHAR) || CAST(MONETARY_SCORE AS VARCHAR)
         AS RFM_SCORE
FROM (SELECT *, 6 - {bucket('RECENCY')} AS RECENCY_SCORE, {bucket('FREQUENCY')} AS FREQUENCY_SCORE,
             {bucket('TOTAL_REVENUE')} AS MONETARY_SCORE FROM derived)""",
)
part(
    "customer_rfm",
    ("scored",),
    "SELECT * REPLACE (CAST(RECENCY AS VARCHAR) AS RECENCY, CAST(TENURE AS VARCHAR) AS TENURE) FROM scored",
)
part(
    "mapping",
    ("scored",),
    """SELECT DISTINCT CAST(RFM_SCORE AS INTEGER) AS RFM_SCORE, seg AS RFM_SEGMENT, 'Segment ' || seg AS RFM_NAME
FROM (SELECT RFM_SCORE, CASE WHEN t >= 12 THEN 'TOP' WHEN t >= 8 THEN 'MIDDLE' ELSE 'LOW' END AS seg
      FROM (SELECT RFM_SCORE, RECENCY_SCORE + FREQUENCY_SCORE + MONETARY_SCORE AS t FROM scored))""",
)
part(
    "reference",
    (),
    """SELECT CASE n_nationkey WHEN 0 THEN 'Ireland' WHEN 1 THEN 'Republic of South Africa' WHEN 2 THEN 'United Kingdom'
            WHEN 3 THEN 'Dominican Republic' ELSE 'Nation ' || n_nationkey END AS NAME,
       r_name AS CONTINENT, 'Capital ' || n_nationkey AS CAPITAL, 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS ISO3,
       CASE n_nationkey % 4 WHEN 0 THEN 'GBP' WHEN 1 THEN 'EUR' WHEN 2 THEN 'USD' END AS CURRENCY,
       CASE n_nationkey % 5 WHEN 0 THEN 'Europe/London' WHEN 1 THEN 'America/New_York' WHEN 2 THEN 'Asia/Kolkata'
            WHEN 3 THEN 'Mars/Base' END AS ZONE
FROM nation JOIN region ON n_regionkey = r_regionkey""",
)
part(
    "resolved",
    ("silver",),
    f"""SELECT COUNTRY_RAW, coalesce(mapped, norm) AS COUNTRY_STANDARDIZED,
       CASE WHEN COUNTRY_RAW IS NULL THEN 'INVALID' WHEN mapped IS NOT NULL THEN 'MAPPED' ELSE 'EXACT' END
         AS COUNTRY_CONFIDENCE
FROM (SELECT COUNTRY_RAW, norm, {case_map('norm', fixed.COUNTRY_NAMES)} AS mapped
      FROM (SELECT DISTINCT COUNTRY AS COUNTRY_RAW, {title('COUNTRY')} AS norm FROM silver))""",
)
part(
    "countries",
    ("resolved", "reference"),
    f"""SELECT COUNTRY_RAW, COUNTRY_STANDARDIZED, COUNTRY_CONFIDENCE, CONTINENT, CAPITAL, ISO3, CURRENCY,
       {offset('ZONE', "TIMESTAMP '2024-07-01 00:00:00'")} AS TIMEZONE
FROM resolved LEFT JOIN reference
  ON NAME = coalesce({case_map('COUNTRY_STANDARDIZED', fixed.COUNTRY_PROXIES)}, COUNTRY_STANDARDIZED)""",
)
part(
    "rates",
    (),
    """SELECT d, CURRENCY, 1.0::DOUBLE + CAST(dayofyear(d) % 10 AS DOUBLE) / 10 AS RATE
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders), (VALUES ('EUR'), ('USD')) c(CURRENCY)""",
)
part(
    "pairs",
    ("silver", "countries"),
    """SELECT DISTINCT INVOICE_DATE, CURRENCY FROM silver LEFT JOIN countries ON COUNTRY = COUNTRY_RAW""",
)
part(
    "pair_rates",
    ("pairs", "rates"),
    """SELECT p.INVOICE_DATE, p.CURRENCY,
       CASE WHEN p.CURRENCY = 'GBP' THEN 1.0::DOUBLE ELSE coalesce(a.RATE, b.RATE + 0.5) END AS EXCHANGE_RATE_TO_GBP
FROM pairs p
LEFT JOIN (SELECT * FROM rates WHERE dayofyear(d) % 7 <> 0) a ON CAST(a.d AS VARCHAR) = p.INVOICE_DATE AND a.CURRENCY = p.CURRENCY
LEFT JOIN (SELECT * FROM rates WHERE dayofyear(d) % 14 <> 0) b ON CAST(b.d AS VARCHAR) = p.INVOICE_DATE AND b.CURRENCY = p.CURRENCY""",
)
part(
    "fact",
    ("lines", "countries"),
    f"""SELECT INVOICE, l.STOCKCODE, QUANTITY, PRICE, CUSTOMER_ID, INVOICE_DATE, INVOICE_TIME, INVOICE_TYPE,
       {stable_id('c.COUNTRY_RAW')} AS COUNTRY_ID, {product_key("p.STOCKCODE", "p.DESCRIPTION")} AS PRODUCT_ID, REVENUE
FROM lines l LEFT JOIN countries c ON COUNTRY = COUNTRY_RAW
LEFT JOIN (SELECT DISTINCT STOCKCODE, DESCRIPTION FROM silver) p
  ON p.STOCKCODE = l.STOCKCODE AND p.DESCRIPTION = l.DESCRIPTION""",
)


def known(c: str) -> str:
    return f"nullif(trim(nullif({c}, 'UNKNOWN')), '')"


def best(source: str, name: str, weight: str) -> str:
    """Most frequent, longest, alphabetically first name per code."""
    return f"""SELECT STOCKCODE, coalesce(arg_min(nm, rk) FILTER (WHERE nm IS NOT NULL), 'UNKNOWN') AS BEST_NAME
FROM (SELECT STOCKCODE, nm, row_number() OVER (PARTITION BY STOCKCODE ORDER BY nm IS NULL, c DESC, length(nm) DESC, nm) AS rk
      FROM (SELECT STOCKCODE, {known(name)} AS nm, sum({weight}) AS c FROM {source} GROUP BY ALL)) GROUP BY STOCKCODE"""


def filled(source: str, name: str, target: str, votes: str) -> str:
    return f"""SELECT s.*, coalesce({known('s.' + name)}, b.BEST_NAME, 'UNKNOWN') AS {target}
FROM {source} s LEFT JOIN {votes} b ON b.STOCKCODE = s.STOCKCODE"""


part(
    "catalogue",
    ("silver",),
    f"""SELECT STOCKCODE, DESCRIPTION AS DESCRIPTION_RAW, {words('DESCRIPTION')} AS DESCRIPTION_CLEAN, count(*) AS n
FROM silver GROUP BY ALL""",
)
part("best1", ("catalogue",), best("catalogue", "DESCRIPTION_CLEAN", "n"))
part("named1", ("catalogue", "best1"), filled("catalogue", "DESCRIPTION_CLEAN", "PRODUCT_NAME", "best1"))
part(
    "name_codes",
    ("named1",),
    """SELECT PRODUCT_NAME, count(STOCKCODE) AS COUNT_CODE_PER_PRODUCT
FROM (SELECT DISTINCT STOCKCODE, DESCRIPTION_CLEAN, PRODUCT_NAME FROM named1) GROUP BY PRODUCT_NAME""",
)


def product_parts(tag: str, keep, remove, min_codes: int = 1) -> str:
    """Fragments of the three naming passes; returns the name of the last one."""
    t = tag
    part(
        f"kept_{t}",
        ("named1", "name_codes"),
        f"""SELECT STOCKCODE, DESCRIPTION_RAW, n, CASE WHEN PRODUCT_NAME NOT IN {text_list(keep)}
  AND PRODUCT_NAME IN (SELECT PRODUCT_NAME FROM name_codes WHERE COUNT_CODE_PER_PRODUCT >= {min_codes})
  THEN NULL ELSE PRODUCT_NAME END AS P1 FROM named1""",
    )
    part(f"best2_{t}", (f"kept_{t}",), best(f"kept_{t}", "P1", "n"))
    part(f"named2_{t}", (f"kept_{t}", f"best2_{t}"), filled(f"kept_{t}", "P1", "P2", f"best2_{t}"))
    part(
        f"removed_{t}",
        (f"named2_{t}",),
        f"""SELECT STOCKCODE, DESCRIPTION_RAW, CASE WHEN P2 IN {text_list(remove)} THEN NULL ELSE P2 END AS P2 FROM named2_{t}""",
    )
    part(f"best3_{t}", (f"removed_{t}",), best(f"removed_{t}", "P2", "1"))
    part(f"named3_{t}", (f"removed_{t}", f"best3_{t}"), filled(f"removed_{t}", "P2", "PRODUCT_NAME", f"best3_{t}"))
    part(f"mapping_{t}", (f"named3_{t}",), f"SELECT STOCKCODE, DESCRIPTION_RAW, PRODUCT_NAME FROM named3_{t}")
    return f"mapping_{t}"


part(
    "months",
    ("valid",),
    "SELECT YEAR_MONTH, row_number() OVER (ORDER BY YEAR_MONTH) AS I, count(*) OVER () AS N FROM (SELECT DISTINCT YEAR_MONTH FROM valid)",
)
part(
    "monthly",
    ("valid", "months"),
    f"""SELECT CUSTOMER_ID, v.YEAR_MONTH, any_value(I) AS I, any_value(N) AS N, sum(REVENUE) AS X
FROM valid v JOIN months m ON m.YEAR_MONTH = v.YEAR_MONTH GROUP BY CUSTOMER_ID, v.YEAR_MONTH""",
)
part(
    "month_sums",
    ("monthly",),
    """SELECT CUSTOMER_ID, any_value(N) AS N, any_value(N) // 2 AS H, sum(X) AS S, var_pop(X) AS V, max(X) AS HI,
       count(*) AS M, count(*) FILTER (X > 0) AS A,
       coalesce(sum(X) FILTER (I <= N // 2), 0) AS F1, coalesce(sum(X) FILTER (I > N // 2), 0) AS F2,
       coalesce(sum(X) FILTER (I > N - 3), 0) AS R3, coalesce(sum(X) FILTER (I <= 3), 0) AS E3
FROM monthly GROUP BY CUSTOMER_ID""",
)
part(
    "features",
    ("month_sums",),
    """SELECT *, 1.0::DOUBLE - STD_MONTHLY_REVENUE / (AVG_MONTHLY_REVENUE + 1) AS PURCHASE_CONSISTENCY FROM (
SELECT CUSTOMER_ID, S / N AS AVG_MONTHLY_REVENUE,
       sqrt((V * M + S * S * (N - M) / (CAST(M AS DOUBLE) * N)) / (N - 1)) AS STD_MONTHLY_REVENUE,
       CASE WHEN M < N THEN greatest(HI, 0) ELSE HI END AS MAX_MONTHLY_REVENUE,
       CAST(F1 AS DOUBLE) AS FIRST_HALF_REVENUE, CAST(F2 AS DOUBLE) AS SECOND_HALF_REVENUE,
       CAST(R3 AS DOUBLE) AS RECENT_3M_REVENUE, CAST(E3 AS DOUBLE) AS EARLY_3M_REVENUE,
       F2 / (N - H) - F1 / H AS REVENUE_TREND, F2 / (F1 + 1) - 1 AS GROWTH_RATE,
       A AS MONTHS_ACTIVE, CAST(A AS DOUBLE) / N AS ACTIVITY_RATE
FROM month_sums)""",
)
part(
    "future",
    ("monthly",),
    """SELECT CUSTOMER_ID, CAST(coalesce(sum(X) FILTER (I > 12), 0) AS DOUBLE) AS TARGET FROM monthly GROUP BY CUSTOMER_ID""",
)
part(
    "capped",
    ("future",),
    "SELECT CUSTOMER_ID, least(TARGET, (SELECT quantile_cont(TARGET, 0.95) FROM future)) AS TARGET FROM future",
)
