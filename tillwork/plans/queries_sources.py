"""Queries on sources, sinks and incremental loading."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwork.operators import incremental
from tillwork.plans import sample_tables as given
from tillwork.plans.oracle_parts import with_parts
from tillwork.plans.registry import query
from tillwork.session import scratch_path
from tillwork.sources import files, names
from tillwork.sources.reports import export_reports
from tillwork.sources.warehouse import Warehouse
from tillwork.streaming.file_ingest import incr_file_ingest

HEADERS = {"INVOICEDATE": "InvoiceDate", "CUSTOMER_ID": "Customer ID", "STOCKCODE": " StockCode"}


def write_landing(spark, d):
    """The raw lines as two CSV sheets in a landing folder, with untidy headers."""
    folder = scratch_path(spark, "landing")
    raw = given.text_sales(spark, d)
    sheets = raw.select(*[F.col(c).alias(HEADERS.get(c, c.title())) for c in raw.columns])
    is_return = F.col("Quantity").startswith("-")
    for name, part in (("sales", sheets.filter(~is_return)), ("returns", sheets.filter(is_return))):
        (
            part.write.option("header", True)
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .option("escape", '"')
            .csv(f"{folder}/online retail {name}.csv")
        )
    return folder


@query(
    "csv_scan",
    with_parts(
        "raw",
        """SELECT CASE WHEN QUANTITY < 0 THEN 'ONLINE_RETAIL_RETURNS' ELSE 'ONLINE_RETAIL_SALES' END AS table_name,
       count(*) AS row_count, count(DESCRIPTION) AS described, CAST(sum(length(DESCRIPTION)) AS BIGINT) AS text_length,
       count(DISTINCT STOCKCODE) AS codes FROM raw GROUP BY 1""",
    ),
)
def csv_scan(spark, d):
    parts = [
        df.agg(
            F.lit(table).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.count("DESCRIPTION").alias("described"),
            F.sum(F.length("DESCRIPTION")).alias("text_length"),
            F.count_distinct("STOCKCODE").alias("codes"),
        )
        for table, (_, df) in files.csv_scan(spark, write_landing(spark, d)).items()
    ]
    return parts[0].unionByName(parts[1])


@query(
    "clean_column_names",
    "SELECT o_orderkey AS ORDER_KEY, o_custkey AS CUST_KEY, o_totalprice AS TOTAL_PRICE_GBP_ FROM orders",
)
def clean_column_names(spark, d):
    untidy = given.table(spark, d, "orders").select(
        F.col("o_orderkey").alias(" order key"),
        F.col("o_custkey").alias("Cust-Key "),
        F.col("o_totalprice").alias("total price (gbp)"),
    )
    return names.clean_column_names(untidy)


def _inferred(column: str) -> str:
    v = f"CAST({column} AS VARCHAR)"
    return f"""SELECT '{column}' AS column_name,
  CASE WHEN count(*) FILTER (WHERE {v} IS NOT NULL AND TRY_CAST({v} AS DOUBLE) IS NULL) > 0 THEN 'TEXT'
       WHEN count(*) FILTER (WHERE {v} IS NULL) > 0 THEN 'REAL'
       WHEN count(*) FILTER (WHERE NOT regexp_full_match({v}, '[+-]?[0-9]+')) > 0 THEN 'REAL'
       ELSE 'INTEGER' END AS column_type FROM raw"""


@query(
    "infer_types",
    with_parts(
        "raw",
        " UNION ALL ".join(
            _inferred(c)
            for c in ("INVOICE", "STOCKCODE", "DESCRIPTION", "QUANTITY", "INVOICEDATE", "PRICE", "CUSTOMER_ID", "COUNTRY")
        ),
    ),
)
def infer_types(spark, d):
    return files.infer_types(given.text_sales(spark, d))


@query(
    "mapping_scan",
    """SELECT CAST(111 + (c_custkey % 5) * 100 + (c_nationkey % 5) * 10 AS INTEGER) AS RFM_SCORE,
       c_mktsegment AS RFM_SEGMENT, 'Segment ' || lower(c_mktsegment) AS RFM_NAME FROM customer GROUP BY ALL""",
)
def mapping_scan(spark, d):
    path = scratch_path(spark, "mapping")
    score = F.lit(111) + (F.col("c_custkey") % 5) * 100 + (F.col("c_nationkey") % 5) * 10
    given.table(spark, d, "customer").select(
        score.alias("rfm score"),
        F.col("c_mktsegment").alias("RFM Segment "),
        F.concat(F.lit("Segment "), F.lower("c_mktsegment")).alias("rfm-name"),
    ).distinct().write.option("header", True).csv(path)
    return files.mapping_scan(spark, path)


@query("table_scan", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def table_scan(spark, d):
    return Warehouse(spark, d).read("lineitem.parquet", "l_orderkey", "l_linenumber", "l_quantity")


@query(
    "prefix_union_scan",
    """SELECT o_orderkey AS ORDERKEY, o_orderstatus AS STATUS, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS PRIORITY
FROM orders""",
)
def prefix_union_scan(spark, d):
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    orders = given.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("ORDERKEY"), F.col("o_orderstatus").alias("STATUS"), F.col("o_orderpriority").alias("PRIORITY")
    )
    wh.overwrite("BRONZE", "ONLINE RETAIL 1", orders.filter("STATUS = 'F'"))
    wh.overwrite("BRONZE", "ONLINE RETAIL 2", orders.filter("STATUS <> 'F'").select("STATUS", "ORDERKEY"))
    wh.overwrite("BRONZE", "RFM MAPPING", orders.filter("STATUS = 'P'"))
    return wh.prefix_union_scan("BRONZE_ONLINE_RETAIL")


@query(
    "table_overwrite",
    """SELECT CAST(o_orderkey AS VARCHAR) AS ORDERKEY, o_custkey AS CUSTKEY, o_totalprice AS TOTAL FROM orders
WHERE o_orderstatus <> 'P'""",
)
def table_overwrite(spark, d):
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    orders = given.table(spark, d, "orders").select(
        F.col("o_custkey").alias("CUSTKEY"),
        F.col("o_orderkey").alias("ORDERKEY"),
        F.col("o_totalprice").alias("TOTAL"),
        F.col("o_orderstatus").alias("STATUS"),
    )
    ddl = "ORDERKEY STRING, CUSTKEY BIGINT, TOTAL DOUBLE"
    wh.overwrite(" test", "order-list", orders, ddl)
    return wh.read(wh.overwrite(" test", "order-list", orders.filter("STATUS <> 'P'"), ddl))


@query(
    "append_merge",
    """SELECT user_id, CASE WHEN count(*) FILTER (event_type = 'purchase') > 0 THEN 'new' ELSE 'old' END AS origin,
       coalesce(max(value) FILTER (event_type = 'purchase'), min(value)) AS value FROM events GROUP BY user_id""",
)
def append_merge(spark, d):
    events = given.table(spark, d, "events")
    existing = events.groupBy("user_id").agg(F.lit("old").alias("origin"), F.min("value").alias("value"))
    new = (
        events.filter("event_type = 'purchase'")
        .groupBy("user_id")
        .agg(F.lit("new").alias("origin"), F.max("value").alias("value"))
    )
    return incremental.append_merge(existing, new, ["user_id"])


def _marks(spark, d, value, stamp, version):
    return (
        given.table(spark, d, "events")
        .groupBy(F.col("event_type").alias("table_name"))
        .agg(
            value.cast("string").alias("last_value"),
            F.lit("id").alias("watermark_type"),
            F.lit(stamp).alias("updated_at"),
            F.lit(version).cast("bigint").alias("version"),
        )
    )


@query(
    "watermark_set",
    """SELECT event_type AS table_name, CAST(max(event_id) AS VARCHAR) AS last_value, 'id' AS watermark_type,
       '2023-12-31T00:00:00' AS updated_at, 2::BIGINT AS version FROM events GROUP BY event_type""",
)
def watermark_set(spark, d):
    """The second mark wins by its version, although the clock that set it was behind."""
    before = _marks(spark, d, F.min("event_id"), "2024-01-01T00:00:00", 1)
    after = _marks(spark, d, F.max("event_id"), "2023-12-31T00:00:00", 2)
    return incremental.merge_watermarks(before, after)


@query(
    "watermark_get",
    "SELECT event_type AS table_name, CAST(max(event_id) AS VARCHAR) AS last_value FROM events GROUP BY event_type",
)
def watermark_get(spark, d):
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    wh.append_watermarks(_marks(spark, d, F.min("event_id"), "2024-01-01T00:00:00", 1))
    wh.append_watermarks(_marks(spark, d, F.max("event_id"), "2024-02-01T00:00:00", 2))
    return wh.watermarks().select("table_name", "last_value")


@query(
    "incr_timestamp_filter",
    "SELECT event_id, event_type, value FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'",
)
def incr_timestamp_filter(spark, d):
    events = given.table(spark, d, "events")
    return incremental.incr_timestamp_filter(events, "ts", "2024-01-15T00:00:00").select("event_id", "event_type", "value")


@query(
    "incr_key_antijoin",
    """WITH p AS (SELECT DISTINCT user_id, nullif(event_type, 'error') AS event_type, ts < TIMESTAMP '2024-01-10 00:00:00' AS early FROM events)
SELECT DISTINCT user_id, event_type FROM p n
WHERE NOT EXISTS (SELECT 1 FROM p k WHERE k.early AND k.user_id = n.user_id AND k.event_type IS NOT DISTINCT FROM n.event_type)""",
)
def incr_key_antijoin(spark, d):
    events = given.table(spark, d, "events").withColumn("event_type", F.nullif("event_type", F.lit("error")))
    pairs = events.select("user_id", "event_type").distinct()
    early = events.filter(F.col("ts") < F.lit("2024-01-10 00:00:00").cast("timestamp_ntz"))
    return incremental.incr_key_antijoin(pairs, early, ["user_id", "event_type"])


@query(
    "incr_maxvalue_gate",
    with_parts(
        "silver",
        """SELECT max(INVOICE_DATE) AS MAX_VALUE, count(*) AS ROW_COUNT, max(INVOICE_DATE) > '1999-12-31' AS CHANGED FROM silver""",
    ),
)
def incr_maxvalue_gate(spark, d):
    from tillwork.plans.views import silver

    return incremental.maxvalue_gate(silver(spark, d), "INVOICE_DATE", "1999-12-31")


@query("incr_file_ingest", "SELECT event_id AS EVENT_ID, event_type AS EVENT_TYPE, value AS VALUE FROM events")
def incr_file_ingest_query(spark, d):
    """Two arrivals of files in one folder; the second call reads only the new ones."""
    folder, marks = scratch_path(spark, "arrivals"), scratch_path(spark, "stream")
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    events = given.table(spark, d, "events").select("event_id", "event_type", "value")
    early = F.col("event_type").isin("view", "click")
    name = ""
    for part in (events.filter(early), events.filter(~early)):
        part.write.mode("append").option("header", True).csv(folder)
        name = incr_file_ingest(
            wh, folder, "BRONZE", "EVENTS", "event_id BIGINT, event_type STRING, value DOUBLE", marks
        )
    return wh.read(name)


@query(
    "report_bundle_export",
    """SELECT 'ORDERS_PER_STATUS' AS report, o_orderstatus AS first, CAST(count(*) AS VARCHAR) AS second FROM orders GROUP BY o_orderstatus
UNION ALL SELECT 'ALL_ORDERS_SORTED_BY_KEY_AND_STATUS', CAST(o_orderkey AS VARCHAR), o_orderstatus FROM orders
UNION ALL SELECT DISTINCT 'PRIORITIES', o_orderpriority, NULL FROM orders""",
)
def report_bundle_export(spark, d):
    """The rows of the written reports, read back."""
    orders = given.table(spark, d, "orders")
    priorities = [r[0] for r in orders.select("o_orderpriority").distinct().orderBy("o_orderpriority").collect()]
    paths = export_reports(
        spark,
        {
            "Orders per status": orders.groupBy("o_orderstatus").count(),
            "All orders, sorted by key and status": orders.select("o_orderkey", "o_orderstatus").orderBy("o_orderkey"),
            "Priorities": priorities,
        },
        scratch_path(spark, "reports"),
        "order report",
    )
    written = [(name, files.read_csv(spark, path)) for name, path in paths.items()]
    parts = [
        df.select(F.lit(name).alias("report"), F.col(df.columns[0]).alias("first"),
                  (F.col(df.columns[1]) if len(df.columns) > 1 else F.lit(None).cast("string")).alias("second"))
        for name, df in written
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
