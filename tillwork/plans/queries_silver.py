"""Queries on cleaning, countries, rates and product names."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwork.functions import amounts, fixed_values as fixed, zones
from tillwork.operators import cleaning, country, fxrates, products
from tillwork.plans import sample_tables as given
from tillwork.plans import views
from tillwork.plans.oracle_parts import bare, key, offset, product_parts, title, with_parts, words
from tillwork.plans.registry import query
from tillwork.session import scratch_path, stage
from tillwork.sources.warehouse import BATCH, Warehouse


@query(
    "dedupe_rows",
    with_parts("raw", "SELECT DISTINCT INVOICE, STOCKCODE, DESCRIPTION, QUANTITY, PRICE, CUSTOMER_ID, COUNTRY FROM raw"),
)
def dedupe_rows(spark, d):
    raw = given.raw_sales(spark, d).drop("INVOICEDATE")
    return cleaning.dedupe_rows(raw.unionByName(raw.filter("QUANTITY < 0")))


@query(
    "clean_text_key",
    with_parts("raw", f"SELECT {key('INVOICE')} AS INVOICE, {key('STOCKCODE')} AS STOCKCODE, {key('DESCRIPTION')} AS DESCRIPTION FROM raw"),
)
def clean_text_key(spark, d):
    keys = cleaning.SALES_TEXT_KEYS
    return cleaning.clean_text_key(given.raw_sales(spark, d).select(*keys), *keys)


@query(
    "clean_country",
    with_parts("raw", f"SELECT INVOICE, QUANTITY, replace({key('COUNTRY')}, 'UNSPECIFIED', 'UNKNOWN') AS COUNTRY FROM raw"),
)
def clean_country(spark, d):
    return cleaning.clean_country(given.raw_sales(spark, d).select("INVOICE", "QUANTITY", "COUNTRY"))


@query(
    "clean_customer_id",
    with_parts("raw", "SELECT INVOICE, coalesce(CUSTOMER_ID, 'UNKNOWN') AS CUSTOMER_ID FROM raw"),
)
def clean_customer_id(spark, d):
    raw = given.raw_sales(spark, d).select("INVOICE", F.concat("CUSTOMER_ID", F.lit(".0")).alias("CUSTOMER_ID"))
    return cleaning.clean_customer_id(raw)


@query("clean_customer_id_double", "SELECT o_orderkey, coalesce(CAST(o_custkey + 12000000 AS VARCHAR), 'UNKNOWN') AS CUSTOMER_ID FROM orders")
def clean_customer_id_double(spark, d):
    """Ids from a float column, beyond the size at which a double's text takes an exponent."""
    ids = given.table(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") + 12_000_000).cast("double").alias("CUSTOMER_ID"))
    return cleaning.clean_customer_id(ids)


@query(
    "coerce_numeric",
    """SELECT l_orderkey, CASE WHEN l_linenumber % 5 = 0 THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS QUANTITY,
       CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_extendedprice END AS PRICE FROM lineitem""",
)
def coerce_numeric(spark, d):
    line = F.col("l_linenumber")
    text = given.table(spark, d, "lineitem").select(
        "l_orderkey",
        F.when(line % 5 == 0, "n/a").otherwise(F.concat(F.lit(" "), F.col("l_quantity").cast("string"))).alias("QUANTITY"),
        F.when(line % 3 == 0, "1.2.3").otherwise(F.col("l_extendedprice").cast("string")).alias("PRICE"),
    )
    return cleaning.coerce_numeric(text, {"QUANTITY": "bigint", "PRICE": "double"})


@query(
    "coerce_timestamp_split",
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d') END AS INVOICE_DATE,
       CASE WHEN event_type <> 'error' THEN strftime(ts, '%H:%M:%S') END AS INVOICE_TIME FROM events""",
)
def coerce_timestamp_split(spark, d):
    text = F.when(F.col("event_type") == "error", "2010-13-99").otherwise(F.col("ts").cast("string"))
    events = given.table(spark, d, "events").select("event_id", text.alias("INVOICEDATE"))
    return cleaning.coerce_timestamp_split(events)


@query(
    "classify_return_sale",
    with_parts(
        "raw",
        f"""SELECT {key('INVOICE')} AS INVOICE, abs(QUANTITY) AS QUANTITY,
       CASE WHEN NOT regexp_full_match({key('INVOICE')}, '[0-9]+') THEN 'RETURN' ELSE 'SALE' END AS INVOICE_TYPE FROM raw""",
    ),
)
def classify_return_sale(spark, d):
    raw = given.raw_sales(spark, d).select("INVOICE", F.abs("QUANTITY").alias("QUANTITY"))
    return cleaning.classify_return_sale(cleaning.clean_text_key(raw, "INVOICE"))


@query("silver_sales", with_parts("silver", "SELECT * FROM silver"))
def silver_sales(spark, d):
    """Two loads with a mark between them give the same table as one load."""
    from tillwork.plans import steps

    wh = Warehouse(spark, scratch_path(spark, "wh"))
    text = steps.with_event_date(given.text_sales(spark, d))
    early = F.col("INVOICEDATE") < "1998-01-01"
    wh.overwrite("BRONZE", "ONLINE_RETAIL_1", text.filter(early))
    steps.load_silver_sales(wh)
    wh.overwrite("BRONZE", "ONLINE_RETAIL_2", text.filter(~early))
    return wh.read(steps.load_silver_sales(wh))


@query("silver_sales_late", with_parts("silver", "SELECT * FROM silver"))
def silver_sales_late(spark, d):
    """What counts is arrival: a second landing brings older lines, equal times, lines already stored and an old file."""
    from tillwork.plans import steps

    wh, landing = Warehouse(spark, scratch_path(spark, "wh")), scratch_path(spark, "landing")
    text = stage(given.text_sales(spark, d), "text-sales")
    day, number = F.col("INVOICEDATE"), F.regexp_extract("INVOICE", "[0-9]+", 0).cast("long")
    unreadable = text.filter(number % 50 == 1).withColumn("INVOICEDATE", F.lit("2010-13-99"))
    given.land(text.filter((day >= "1997-01-01") & (number % 3 != 0)), landing, "online retail 1")
    steps.load_bronze(wh, landing)
    steps.load_silver_sales(wh)
    given.land(text.filter(day < "1997-06-01"), landing, "online retail 2")  # older, and stored ones of half a year
    given.land(text.filter((day >= "1997-06-01") & (number % 3 == 0)), landing, "online retail 3", days_old=3000)
    given.land(unreadable, landing, "online retail 4")
    steps.load_bronze(wh, landing)
    steps.load_silver_sales(wh)
    given.land(unreadable.withColumn("INVOICEDATE", F.lit("?")), landing, "online retail 5")  # rejects only
    steps.load_bronze(wh, landing)
    if steps.load_silver_sales(wh) is not None or steps.rejected_sales(wh).select(BATCH).distinct().count() != 2:
        raise AssertionError("rejects are stored by arrival, and are no sales")
    return wh.read("SILVER_SALES")


@query(
    "silver_rfm_mapping",
    """SELECT DISTINCT CAST(111 + c_custkey % 5 AS INTEGER) AS RFM_SCORE, c_mktsegment AS RFM_SEGMENT, 'x' AS RFM_NAME FROM customer""",
)
def silver_rfm_mapping(spark, d):
    from tillwork.plans import steps

    wh = Warehouse(spark, scratch_path(spark, "wh"))
    mapping = given.table(spark, d, "customer").select(
        (F.lit(111) + F.col("c_custkey") % 5).cast("int").alias("RFM_SCORE"),
        F.col("c_mktsegment").alias("RFM_SEGMENT"),
        F.lit("x").alias("RFM_NAME"),
    )
    wh.overwrite("BRONZE", "RFM_MAPPING", mapping)
    name = steps.load_silver_mapping(wh)
    if steps.load_silver_mapping(wh) is not None:
        raise AssertionError("unchanged mapping was loaded again")
    return wh.read(name)


@query(
    "filter_valid_sales",
    with_parts("valid", "SELECT INVOICE, STOCKCODE, QUANTITY, PRICE, CUSTOMER_ID, INVOICE_DATE FROM valid"),
)
def filter_valid_sales(spark, d):
    kept = cleaning.filter_valid_sales(views.silver(spark, d))
    return kept.select("INVOICE", "STOCKCODE", "QUANTITY", "PRICE", "CUSTOMER_ID", "INVOICE_DATE")


@query(
    "quality_report",
    with_parts(
        "silver",
        """, q AS (SELECT 'Negative Quantities' AS "Check", count(*) FILTER (QUANTITY < 0) AS "Count", count(*) AS n FROM silver
UNION ALL SELECT 'Negative Prices', count(*) FILTER (PRICE < 0), count(*) FROM silver
UNION ALL SELECT 'Zero Quantities', count(*) FILTER (QUANTITY = 0), count(*) FROM silver
UNION ALL SELECT 'Zero Prices', count(*) FILTER (PRICE = 0), count(*) FROM silver)
SELECT "Check", "Count", round("Count" / n * 100, 2) AS "Percentage" FROM q""",
    ),
)
def quality_report(spark, d):
    return cleaning.quality_report(views.silver(spark, d))


@query("extract_year_month", with_parts("silver", "SELECT INVOICE, CUSTOMER_ID, substr(INVOICE_DATE, 1, 7) AS YEAR_MONTH FROM silver"))
def extract_year_month(spark, d):
    return cleaning.extract_year_month(views.silver(spark, d)).select("INVOICE", "CUSTOMER_ID", "YEAR_MONTH")


@query("revenue", with_parts("silver", "SELECT INVOICE, QUANTITY, PRICE, QUANTITY * PRICE AS REVENUE FROM silver"))
def revenue(spark, d):
    return views.lines(spark, d).select("INVOICE", "QUANTITY", "PRICE", "REVENUE")


@query(
    "description_clean",
    with_parts("raw", f"SELECT DESCRIPTION AS DESCRIPTION_RAW, {words('DESCRIPTION')} AS DESCRIPTION_CLEAN, count(*) AS n FROM raw GROUP BY ALL"),
)
def description_clean(spark, d):
    counted = given.raw_sales(spark, d).groupBy(F.col("DESCRIPTION").alias("DESCRIPTION_RAW")).agg(F.count(F.lit(1)).alias("n"))
    return cleaning.description_clean(counted)


@query("description_clean_documents")
def description_clean_documents(spark, d):
    """Whole texts in four languages, so the decomposition runs."""
    texts = given.table(spark, d, "documents").select("doc_id", F.col("text").alias("DESCRIPTION_RAW"))
    return cleaning.description_clean(texts).select("doc_id", "DESCRIPTION_CLEAN")


def _parts_sql(c: str) -> str:
    return with_parts(
        "raw",
        f"""SELECT {bare(c)} AS {c}, nullif(regexp_extract({bare(c)}, '(\\d+)', 1), '') AS {c}_NUM,
       nullif(regexp_extract({bare(c)}, '([A-Za-z]+)', 1), '') AS {c}_ALPHA FROM raw""",
    )


@query("bronze_clean_invoice", _parts_sql("INVOICE"))
def bronze_clean_invoice(spark, d):
    return cleaning.clean_invoice_parts(given.raw_sales(spark, d).select("INVOICE"), "INVOICE")


@query("bronze_clean_stockcode", _parts_sql("STOCKCODE"))
def bronze_clean_stockcode(spark, d):
    return cleaning.clean_invoice_parts(given.raw_sales(spark, d).select("STOCKCODE"), "STOCKCODE")


@query(
    "bronze_clean_description",
    """SELECT page_id, regexp_replace(upper(trim(regexp_replace(url, '[^0-9a-zA-Z\\s]+', ' ', 'g'))), '\\s+', '_', 'g') AS DESCRIPTION
FROM pages""",
)
def bronze_clean_description(spark, d):
    pages = given.table(spark, d, "pages").select("page_id", F.col("url").alias("DESCRIPTION"))
    return cleaning.clean_plain_description(pages)


@query(
    "country_normalize",
    with_parts("silver", f"SELECT COUNTRY AS COUNTRY_RAW, {title('COUNTRY')} AS COUNTRY_NORMALIZED, count(*) AS n FROM silver GROUP BY ALL"),
)
def country_normalize(spark, d):
    raw = views.silver(spark, d).groupBy(F.col("COUNTRY").alias("COUNTRY_RAW")).agg(F.count(F.lit(1)).alias("n"))
    return country.country_normalize(raw)


@query("country_resolve", with_parts("resolved", "SELECT * FROM resolved"))
def country_resolve(spark, d):
    return country.country_resolve(views.silver(spark, d).select(F.col("COUNTRY").alias("COUNTRY_RAW")).distinct())


@query("distinct_keys", with_parts("silver", "SELECT DISTINCT COUNTRY, INVOICE_DATE FROM silver"))
def distinct_keys(spark, d):
    return views.silver(spark, d).select("COUNTRY", "INVOICE_DATE").distinct()


_COUNTRY_COLUMNS = "COUNTRY_RAW, COUNTRY_STANDARDIZED, COUNTRY_CONFIDENCE, CONTINENT, CAPITAL, ISO3, CURRENCY, TIMEZONE"


@query("country_enrich", with_parts("countries", f"SELECT {_COUNTRY_COLUMNS} FROM countries"))
def country_enrich(spark, d):
    resolved = country.country_resolve(views.silver(spark, d).select(F.col("COUNTRY").alias("COUNTRY_RAW")).distinct())
    return country.country_enrich(resolved, given.country_reference(spark, d), views.AT)


@query(
    "utc_offset",
    with_parts(
        "reference",
        f"""SELECT DISTINCT CAST(o_orderdate AS DATE)::VARCHAR AS ORDER_DATE, ZONE, {offset('ZONE', 'o_orderdate')} AS TIMEZONE
FROM orders JOIN customer ON o_custkey = c_custkey JOIN reference ON ISO3 = 'N' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0')""",
    ),
)
def utc_offset(spark, d):
    """Offset of each customer zone at each order date, over a year's daylight-saving changes."""
    customer = given.table(spark, d, "customer").withColumn("ISO3", F.concat(F.lit("N"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0")))
    used = (
        given.table(spark, d, "orders")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(given.country_reference(spark, d), "ISO3")
        .select("o_orderdate", "ZONE")
        .distinct()
    )
    offset_text = zones.utc_offset(amounts.instant(F.col("o_orderdate")), F.col("ZONE"))
    return used.select(amounts.date_text(F.col("o_orderdate")).alias("ORDER_DATE"), "ZONE", offset_text.alias("TIMEZONE"))


@query("country_metadata", with_parts("countries", f"SELECT {_COUNTRY_COLUMNS} FROM countries"))
def country_metadata(spark, d):
    """First load from the early sales, second from all: the second only adds what is new."""
    from tillwork.plans import steps

    wh = Warehouse(spark, scratch_path(spark, "wh"))
    sales = stage(views.silver(spark, d).select("COUNTRY"))
    reference = given.country_reference(spark, d)
    wh.overwrite("SILVER", "SALES", sales.filter("COUNTRY < 'NATION_2'"))
    steps.load_country(wh, reference, views.AT)
    wh.overwrite("SILVER", "SALES", sales)
    steps.load_country(wh, reference, views.AT)
    return steps.country_table(wh)


@query(
    "currency_date_pairs",
    with_parts("pairs", "SELECT INVOICE_DATE, CURRENCY FROM pairs WHERE NOT (INVOICE_DATE < '1997-01-01' AND CURRENCY IS NULL)"),
)
def currency_date_pairs(spark, d):
    sales = stage(views.silver(spark, d).select("COUNTRY", "INVOICE_DATE"))
    countries = views.countries_of(spark, d, sales)
    known = sales.filter("INVOICE_DATE < '1997-01-01'").select("INVOICE_DATE", F.lit(None).cast("string").alias("CURRENCY"))
    return fxrates.currency_date_pairs(sales, countries, known)


def _rates(spark, d):
    sales = stage(views.silver(spark, d).select("COUNTRY", "INVOICE_DATE"))
    pairs = fxrates.currency_date_pairs(sales, views.countries_of(spark, d, sales))
    return fxrates.fx_rate_lookup(pairs, *given.rate_references(spark, d))


_RATE_COLUMNS = "INVOICE_DATE, CURRENCY, EXCHANGE_RATE_TO_GBP"


@query("fx_rate_lookup", with_parts("pair_rates", f"SELECT {_RATE_COLUMNS} FROM pair_rates"))
def fx_rate_lookup(spark, d):
    return _rates(spark, d)


@query(
    "fx_rate_asof",
    with_parts(
        "pair_rates",
        """SELECT p.INVOICE_DATE, p.CURRENCY, coalesce(p.EXCHANGE_RATE_TO_GBP, (
  SELECT arg_max(RATE, d) FROM (
    SELECT d, CURRENCY, RATE FROM rates WHERE dayofyear(d) % 7 <> 0
    UNION ALL SELECT d, CURRENCY, RATE + 0.5 FROM rates WHERE dayofyear(d) % 7 = 0 AND dayofyear(d) % 14 <> 0) r
  WHERE r.CURRENCY = p.CURRENCY AND CAST(r.d AS VARCHAR) <= p.INVOICE_DATE)) AS EXCHANGE_RATE_TO_GBP FROM pair_rates p""",
    ),
)
def fx_rate_asof(spark, d):
    """Dates without a rate take the last earlier one of the currency."""
    sales = stage(views.silver(spark, d).select("COUNTRY", "INVOICE_DATE"))
    pairs = fxrates.currency_date_pairs(sales, views.countries_of(spark, d, sales))
    return fxrates.fx_rate_lookup(pairs, *given.rate_references(spark, d), as_of=True)


@query(
    "fx_missing_report",
    with_parts("pair_rates", 'SELECT INVOICE_DATE AS "DATE", CURRENCY FROM pair_rates WHERE EXCHANGE_RATE_TO_GBP IS NULL'),
)
def fx_missing_report(spark, d):
    return fxrates.fx_missing_report(_rates(spark, d))


@query("exchange_rate", with_parts("pair_rates", f"SELECT {_RATE_COLUMNS} FROM pair_rates"))
def exchange_rate(spark, d):
    """Early sales with only the first source, then all sales with both: missing rates are retried."""
    from tillwork.plans import steps

    wh = Warehouse(spark, scratch_path(spark, "wh"))
    sales = stage(views.silver(spark, d).select("COUNTRY", "INVOICE_DATE"))
    first, second = given.rate_references(spark, d)
    wh.write_batch("SILVER", "COUNTRY_METADATA", views.countries_of(spark, d, sales), "1")
    wh.overwrite("SILVER", "SALES", sales.filter("INVOICE_DATE < '1998-01-01'"))
    steps.load_rates(wh, first, second.filter("false"))
    wh.overwrite("SILVER", "SALES", sales)
    steps.load_rates(wh, first, second)
    return steps.rate_table(wh)


KEEP = [f"{a}_{b}" for a in ("RED", "BLUE", "HOT") for b in ("RING", "BOLT", "PLATE", "ROD", "ANVIL", "WIDGET", "GEAR", "GIZMO")]
REMOVE = ["RED_RING", "RED_BOLT", "HOT_GEAR", "BLUE_ROD", "RED_WIDGET", "HOT_PLATE"]
_FIXED = product_parts("fixed", fixed.PRODUCTS_TO_KEEP, fixed.PRODUCTS_TO_REMOVE)
LISTS = product_parts("lists", KEEP, REMOVE)
_REPEATED = product_parts("repeated", KEEP, REMOVE, 2)


def _catalogue(spark, d):
    counted = views.silver(spark, d).groupBy("STOCKCODE", F.col("DESCRIPTION").alias("DESCRIPTION_RAW")).agg(F.count(F.lit(1)).alias("n"))
    return cleaning.description_clean(counted)


@query("best_description", with_parts("best1", "SELECT STOCKCODE, BEST_NAME FROM best1"))
def best_description(spark, d):
    return products.best_description(_catalogue(spark, d), "DESCRIPTION_CLEAN", F.col("n"))


@query("fill_product_name", with_parts("named1", "SELECT STOCKCODE, DESCRIPTION_RAW, PRODUCT_NAME FROM named1"))
def fill_product_name(spark, d):
    filled = products.fill_product_name(_catalogue(spark, d), "DESCRIPTION_CLEAN", "PRODUCT_NAME", F.col("n"))
    return filled.select("STOCKCODE", "DESCRIPTION_RAW", "PRODUCT_NAME")


@query(
    "null_out_names",
    with_parts(
        "named1",
        f"""SELECT STOCKCODE, DESCRIPTION_RAW,
       CASE WHEN PRODUCT_NAME IN ({', '.join(repr(k) for k in KEEP)}) AND PRODUCT_NAME NOT IN ({', '.join(repr(k) for k in REMOVE)})
            THEN PRODUCT_NAME END AS PRODUCT_NAME FROM named1""",
    ),
)
def null_out_names(spark, d):
    named = fill_product_name(spark, d)
    return products.null_out_names(named, "PRODUCT_NAME", keep=KEEP, remove=REMOVE)


@query("code_count_per_name", with_parts("name_codes", "SELECT * FROM name_codes"))
def code_count_per_name(spark, d):
    filled = products.fill_product_name(_catalogue(spark, d), "DESCRIPTION_CLEAN", "PRODUCT_NAME", F.col("n"))
    return products.code_count_per_name(filled)


@query("product_mapping", with_parts(_FIXED, f"SELECT * FROM {_FIXED}"))
def product_mapping(spark, d):
    return products.product_mapping(views.silver(spark, d))


@query("product_mapping_lists", with_parts(LISTS, f"SELECT * FROM {LISTS}"))
def product_mapping_lists(spark, d):
    return products.product_mapping(views.silver(spark, d), KEEP, REMOVE)


@query("product_mapping_repeated", with_parts(_REPEATED, f"SELECT * FROM {_REPEATED}"))
def product_mapping_repeated(spark, d):
    return products.product_mapping(views.silver(spark, d), KEEP, REMOVE, min_codes=2)


@query("name_length", with_parts("named1", "SELECT STOCKCODE, PRODUCT_NAME, CAST(length(PRODUCT_NAME) AS INTEGER) AS NAME_LENGTH FROM named1"))
def name_length(spark, d):
    return products.name_length(fill_product_name(spark, d).select("STOCKCODE", "PRODUCT_NAME"), "PRODUCT_NAME")


_NAME_PAIRS = f"(SELECT DISTINCT STOCKCODE, PRODUCT_NAME FROM {_REPEATED})"


def _reports(spark, d):
    return products.product_code_reports(product_mapping_repeated(spark, d))


@query(
    "product_code_reports_per_code",
    with_parts(_REPEATED, f"SELECT STOCKCODE, count(PRODUCT_NAME) AS COUNT_PRODUCT_PER_CODE FROM {_NAME_PAIRS} GROUP BY 1"),
)
def reports_per_code(spark, d):
    return _reports(spark, d)["Count Product per Code"]


@query(
    "product_code_reports_multi_product",
    with_parts(
        _REPEATED,
        f"""SELECT STOCKCODE, COUNT_PRODUCT_PER_CODE, PRODUCT_NAME FROM
(SELECT *, count(*) OVER (PARTITION BY STOCKCODE) AS COUNT_PRODUCT_PER_CODE FROM {_NAME_PAIRS}) WHERE COUNT_PRODUCT_PER_CODE > 1""",
    ),
)
def reports_multi_product(spark, d):
    return _reports(spark, d)["Multi product per Code"]


@query(
    "product_code_reports_multi_code",
    with_parts(
        _REPEATED,
        f"SELECT PRODUCT_NAME, count(STOCKCODE) AS COUNT_CODE_PER_PRODUCT FROM {_NAME_PAIRS} GROUP BY 1 HAVING count(STOCKCODE) > 1",
    ),
)
def reports_multi_code(spark, d):
    return _reports(spark, d)["Multi code per product"]
