"""The load steps, from landing folder to value models.

Each step reads stored tables, writes stored tables, and moves its mark last; running a step again
without new input changes nothing.
"""

from __future__ import annotations

import json
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tillwork import schemas
from tillwork.functions import amounts
from tillwork.operators import (
    cleaning,
    cltv_features,
    cltv_models,
    country,
    fxrates,
    incremental,
    products,
    rfm,
    star,
)
from tillwork.session import cut_lineage, stage, staged
from tillwork.sources import files
from tillwork.sources.reports import export_reports
from tillwork.sources.storage import children, modified
from tillwork.sources.warehouse import BATCH, Warehouse, batch_key, conform

BRONZE_SALES = "BRONZE_ONLINE_RETAIL"
BRONZE_FILES = "bronze_csv_files"
EVENT_DATE, LINE = "EVENT_DATE", "LINE"


def load_bronze(wh: Warehouse, landing: str, fmt: str | None = None, quoted_breaks: bool = False) -> list[str]:
    """The files of the landing folder that have not been loaded become one batch of their sheet's Bronze table.

    A file is new if the ledger lacks its path, time and size, whatever its time is; a changed file replaces its
    former rows. All columns stay text; the parsed date is stored beside the raw one for the increments to prune by.
    Rows with a wrong number of fields go to REJECTED_ tables. The list of new files is what the reader itself holds.
    """
    ledger = wh.seen_files(BRONZE_FILES)
    known = ["file_path", "modified", "size"]
    arrived = incremental.incr_key_antijoin(files.landed_files(wh.spark, landing), ledger, known)
    rows = arrived.filter(F.lower("entry").endswith(".csv")).collect()
    tables = files.sheets(children(wh.spark, landing))
    if not rows:
        return []
    load = f"{int(ledger.agg(F.max('load')).first()[0] or 0) + 1:012d}"
    names = []
    for table, entry in tables.items():
        paths = sorted(r.path for r in rows if r.entry == entry)
        if paths:
            sheet = files.read_csv_checked(wh.spark, paths, quoted_breaks)
            broken = F.col(files.CORRUPT).isNotNull()
            noted = Observation(f"broken rows of {table}")
            good = sheet.observe(noted, F.count_if(broken).alias("n")).filter(~broken).drop(files.CORRUPT)
            names.append(wh.write_batch("BRONZE", table, with_event_date(good, fmt), load))
            if noted.get["n"]:
                wh.write_batch("REJECTED", table, sheet.filter(broken), load)
    seen = [(BRONZE_FILES, r.file_path, r.modified, r.size, load) for r in rows]
    wh.note_files(wh.spark.createDataFrame(seen, schemas.FILES))
    return names


def bronze_lines(wh: Warehouse, name: str) -> DataFrame:
    """Rows of a Bronze table with their batch, without those of files that were loaded again later."""
    df = wh.read_batches(name)
    if files.SOURCE_FILE not in df.columns:
        return df
    ledger = wh.seen_files(BRONZE_FILES)
    last = ledger.groupBy("file_path").agg(F.max("load").alias("last"))
    former = ledger.join(last, "file_path").filter("load < last")
    former = former.select(F.col("file_path").alias(files.SOURCE_FILE), F.concat(F.lit(batch_key("")), "load").alias(BATCH))
    return df.join(former, [files.SOURCE_FILE, BATCH], "left_anti")


def with_event_date(df: DataFrame, fmt: str | None = None) -> DataFrame:
    if "INVOICEDATE" not in df.columns:
        return df
    return df.withColumn(EVENT_DATE, amounts.date_text(cleaning.parse_timestamp(F.col("INVOICEDATE"), fmt)))


def load_bronze_mapping(wh: Warehouse, path: str) -> str | None:
    """Reload the score mapping when its file changed."""
    changed = modified(wh.spark, path) or ""
    if changed <= (wh.get_watermark("bronze_rfm_mapping") or ""):
        return None
    name = wh.overwrite("BRONZE", "RFM_MAPPING", files.mapping_scan(wh.spark, path), schemas.RFM_MAPPING)
    wh.set_watermark("bronze_rfm_mapping", changed)
    return name


def _arrived_sales(wh: Warehouse, seen: dict[str, str]) -> tuple[DataFrame | None, dict[str, str]]:
    """Raw lines of the Bronze sales batches after each table's mark, and the marks after them.

    A table without batches has arrived whole if it was written since.
    """
    parts, marks = [], dict(seen)
    for name in wh.tables(BRONZE_SALES):
        df = bronze_lines(wh, name)
        if BATCH in df.columns:
            last = max(wh.batches(name))
            fresh = df.filter(F.col(BATCH) > F.lit(seen.get(name, "")))
        else:
            last, fresh = modified(wh.spark, wh.path(name)) or "", df
        if last != seen.get(name):
            marks[name] = last
            parts.append(fresh.drop(BATCH, files.SOURCE_FILE))
    if not parts:
        return None, marks
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), marks


def keyed_lines(raw: DataFrame, fmt: str | None = None) -> DataFrame:
    """Raw lines with their date (empty if unreadable) and the key of the whole raw line."""
    columns = [c for c in raw.columns if c != EVENT_DATE]
    dated = raw if EVENT_DATE in raw.columns else with_event_date(raw, fmt)
    return dated.withColumns({EVENT_DATE: F.coalesce(EVENT_DATE, F.lit("")), LINE: incremental.line_key(columns)})


def load_silver_sales(wh: Warehouse, fmt: str | None = None) -> str | None:
    """Clean the Bronze lines that arrived since the last load into a new batch of SILVER_SALES.

    What counts is arrival, not the time of the sale: late lines, equal times and lines without a readable time are
    taken. A line that was stored before, as a whole raw line, is not stored again; to tell, only the keys of the
    months touched are read. The wide lines are read once and staged.
    """
    state = json.loads(wh.get_watermark("silver_sales") or "{}")
    raw, seen = _arrived_sales(wh, state.get("seen", {}))
    if raw is None:
        return None
    batch = f"{state.get('batch', 0) + 1:012d}"
    lines = keyed_lines(raw, fmt)
    if wh.exists("SILVER_SALES_LINES"):
        stored = wh.read_batches("SILVER_SALES_LINES").filter(F.col(BATCH) < F.lit(batch_key(batch)))
        lines = incremental.unseen_lines(lines, stored, EVENT_DATE, LINE)
    else:
        lines = lines.dropDuplicates([EVENT_DATE, LINE])
    name = None
    with staged(lines.sortWithinPartitions(EVENT_DATE), "arrived") as lines:
        rejects = lines.filter(F.col(EVENT_DATE) == "").drop(EVENT_DATE, LINE)
        if not rejects.isEmpty():
            wh.write_batch("SILVER", "SALES_REJECTS", rejects, batch)
        if not lines.isEmpty():
            fresh = lines.filter(F.col(EVENT_DATE) != "").drop(EVENT_DATE, LINE)
            if not fresh.isEmpty():
                name = wh.write_batch("SILVER", "SALES", cleaning.clean_lines(fresh, fmt), batch, schemas.SILVER_SALES)
            wh.write_batch("SILVER", "SALES_LINES", lines, batch, schemas.SALES_LINES)
    wh.set_watermark("silver_sales", json.dumps({"batch": int(batch), "seen": seen}, sort_keys=True), "state")
    return name


def rejected_sales(wh: Warehouse) -> DataFrame:
    """All raw lines whose time cannot be read, with their batch; columns of all loads."""
    return wh.spark.read.option("mergeSchema", True).parquet(wh.path("SILVER_SALES_REJECTS"))


def load_silver_mapping(wh: Warehouse) -> str | None:
    """Copy the mapping when its content fingerprint changed."""
    source = wh.read("BRONZE_RFM_MAPPING")
    seen = incremental.fingerprint(source).first()
    mark = f"{seen['ROW_COUNT']}:{seen['ROW_HASH_SUM']}"
    if wh.get_watermark("silver_rfm_mapping") == mark:
        return None
    name = wh.overwrite("SILVER", "RFM_MAPPING", cleaning.dedupe_rows(source), schemas.RFM_MAPPING)
    wh.set_watermark("silver_rfm_mapping", mark, "id")
    return name


def stored_latest(wh: Warehouse, name: str, keys: list[str]) -> DataFrame:
    """Batches of a keyed table reduced to the latest row per key."""
    return incremental.latest_per_key(wh.read_batches(name), keys, BATCH).drop(BATCH)


def _news(fresh: DataFrame, stored: DataFrame | None, keys: list[str], found: str) -> DataFrame:
    """Looked-up rows worth storing: all that were found, and failures not yet on record."""
    if stored is None:
        return fresh
    failed = fresh.filter(F.col(found).isNull())
    return fresh.filter(F.col(found).isNotNull()).unionByName(incremental.incr_key_antijoin(failed, stored, keys))


def _state(wh: Warehouse, step: str) -> dict:
    """What a step has done: the number of its last batch and the last Silver sales batch it has read."""
    return json.loads(wh.get_watermark(step) or '{"batch": 0, "sales": ""}')


def _set_state(wh: Warehouse, step: str, batch: int, sales: str) -> None:
    wh.set_watermark(step, json.dumps({"batch": batch, "sales": sales}, sort_keys=True), "state")


def _sales_after(wh: Warehouse, mark: str) -> tuple[DataFrame, str]:
    """Silver sales of the batches after the mark, a partition filter, and the last batch. Without batches, all sales."""
    sales, batches = wh.read_batches("SILVER_SALES"), wh.batches("SILVER_SALES")
    return (sales.filter(F.col(BATCH) > F.lit(mark)), batches[-1]) if batches else (sales, "")


def _batch_number(n: int) -> str:
    return f"{n:012d}"


def load_country(wh: Warehouse, reference: DataFrame, at: datetime | None = None, reports: str | None = None) -> str | None:
    """Metadata of the countries of new sales batches that have none yet; names whose lookup failed are tried again."""
    state = _state(wh, "silver_country_mapping")
    sales, last = _sales_after(wh, state["sales"])
    current = sales.select(F.col("COUNTRY").alias("COUNTRY_RAW")).distinct()
    stored = country_table(wh) if wh.exists("SILVER_COUNTRY_METADATA") else None
    if stored is not None:
        current = incremental.incr_key_antijoin(current, stored, ["COUNTRY_RAW"])
        current = current.unionByName(stored.filter(F.col("ISO3").isNull()).select("COUNTRY_RAW"))
    fresh = stage(country.new_country_metadata(current, reference, at), "countries")
    fresh = _news(fresh, stored, ["COUNTRY_RAW"], "ISO3")
    name, batch = None, state["batch"]
    if not fresh.isEmpty():
        batch += 1
        name = wh.write_batch("SILVER", "COUNTRY_METADATA", fresh, _batch_number(batch), schemas.COUNTRY_METADATA)
    if (batch, last) != (state["batch"], state["sales"]):
        _set_state(wh, "silver_country_mapping", batch, last)
        wh.fold("SILVER", "COUNTRY_METADATA", _latest("COUNTRY_RAW"))
    if name and reports:
        export_reports(wh.spark, {"Country Mapping": country_table(wh)}, reports, "silver_country_mapping")
    return name


def _latest(*keys: str):
    return lambda df: incremental.latest_per_key(df, keys, BATCH)


def country_table(wh: Warehouse) -> DataFrame:
    return stored_latest(wh, "SILVER_COUNTRY_METADATA", ["COUNTRY_RAW"])


def load_rates(wh: Warehouse, first: DataFrame, second: DataFrame, reports: str | None = None) -> str | None:
    """Rates of (date, currency) pairs that have none yet; missing rates are tried again.

    The sales are reduced, batch by batch, to a table of countries and days, which the calendar bounds. All else reads
    that table, so a country that gets its currency late has its old days looked up without a look at old sales.
    """
    state = _state(wh, "silver_exchange_rate")
    sales, last = _sales_after(wh, state["sales"])
    keys, batch = ["COUNTRY", "INVOICE_DATE"], state["batch"] + 1
    days = sales.select(*keys).distinct()
    if wh.exists("SILVER_COUNTRY_DAYS"):
        before = wh.read_batches("SILVER_COUNTRY_DAYS").filter(F.col(BATCH) < F.lit(batch_key(_batch_number(batch))))
        days = incremental.incr_key_antijoin(days, before, keys)
    days = stage(days, "country-days")
    if not days.isEmpty():
        wh.write_batch("SILVER", "COUNTRY_DAYS", days, _batch_number(batch))
    stored = rate_table(wh) if wh.exists("SILVER_EXCHANGE_RATE") else None
    known = None if stored is None else stored.filter(F.col("EXCHANGE_RATE_TO_GBP").isNotNull())
    pairs = fxrates.currency_date_pairs(wh.read("SILVER_COUNTRY_DAYS"), country_table(wh), known)
    fresh = stage(fxrates.fx_rate_lookup(pairs, first, second), "rates")
    fresh = _news(fresh, stored, list(fxrates.PAIR), "EXCHANGE_RATE_TO_GBP")
    name = None
    if not fresh.isEmpty():
        name = wh.write_batch("SILVER", "EXCHANGE_RATE", fresh, _batch_number(batch), schemas.EXCHANGE_RATE)
    if name or last != state["sales"]:
        _set_state(wh, "silver_exchange_rate", batch, last)
        wh.fold("SILVER", "EXCHANGE_RATE", _latest(*fxrates.PAIR))
        wh.fold("SILVER", "COUNTRY_DAYS", _latest(*keys))
    if name and reports:
        rates = {"Date Exchange Rate": rate_table(wh), "Missing rates": fxrates.fx_missing_report(rate_table(wh))}
        export_reports(wh.spark, rates, reports, "silver_pair_currency_date")
    return name


def rate_table(wh: Warehouse) -> DataFrame:
    return stored_latest(wh, "SILVER_EXCHANGE_RATE", ["INVOICE_DATE", "CURRENCY"])


def load_products(wh: Warehouse, reports: str | None = None, **options) -> str | None:
    """Resolve the names of the codes for which new sales batches brought a raw name that has no mapping.

    Lines per (code, raw name) are kept as a table that each load adds its new batches to. All names of a touched
    code are voted on again, from all its lines; other codes stay as they are.
    """
    state = _state(wh, "silver_product_mapping")
    sales, last = _sales_after(wh, state["sales"])
    if last and last == state["sales"]:
        return None
    pair, batch = ["STOCKCODE", "DESCRIPTION_RAW"], state["batch"] + 1
    number = _batch_number(batch)
    counted = stage(products.count_names(sales), "names")
    if not last:  # sales without batches are counted whole each time
        wh.overwrite("SILVER", "PRODUCT_COUNTS", counted.withColumn(BATCH, F.lit(batch_key(number))), by=BATCH)
    elif not counted.isEmpty():
        wh.write_batch("SILVER", "PRODUCT_COUNTS", counted, number)
    fresh = counted.select(*pair)
    if wh.exists("SILVER_PRODUCT_MAPPING"):
        before = wh.read_batches("SILVER_PRODUCT_MAPPING").filter(F.col(BATCH) < F.lit(batch_key(number)))
        fresh = incremental.incr_key_antijoin(fresh, before, pair)
    codes = stage(fresh.select(F.col("STOCKCODE").alias("_code")).distinct(), "touched-codes")
    name = None
    if not codes.isEmpty():
        all_lines = wh.read("SILVER_PRODUCT_COUNTS").join(codes, F.col("STOCKCODE").eqNullSafe(F.col("_code")), "left_semi")
        all_lines = all_lines.groupBy(*pair).agg(F.sum("LINES").alias("LINES"))
        mapping = products.resolve_names(all_lines, **options)
        name = wh.write_batch("SILVER", "PRODUCT_MAPPING", mapping, number, schemas.PRODUCT_MAPPING)
    if name or last:
        _set_state(wh, "silver_product_mapping", batch, last)
        wh.fold("SILVER", "PRODUCT_MAPPING", _latest(*pair))
        wh.fold("SILVER", "PRODUCT_COUNTS", lambda df: df.groupBy(*pair).agg(F.sum("LINES").alias("LINES")))
    if name and reports:
        mapping = product_table(wh)
        bundle = {"Product and code": mapping, **products.product_code_reports(mapping)}
        export_reports(wh.spark, bundle, reports, "silver_pair_code_product")
    return name


def product_table(wh: Warehouse) -> DataFrame:
    return stored_latest(wh, "SILVER_PRODUCT_MAPPING", ["STOCKCODE", "DESCRIPTION_RAW"])


def _gate(wh: Warehouse, step: str, df: DataFrame) -> str | None:
    """New mark when the largest invoice date or the row count moved, else None."""
    seen = incremental.max_value(df, "INVOICE_DATE").first()
    mark = f"{seen['MAX_VALUE']}/{seen['ROW_COUNT']}"
    return None if wh.get_watermark(step) == mark else mark


def load_fact(wh: Warehouse, countries: DataFrame, product_names: DataFrame, recheck: bool = True) -> str | None:
    """Build the fact batches that are missing or incomplete and, on `recheck`, those that have lines without a key.

    Keys are a function of the line, so a finished batch can only change where a key was missing, and only after a
    dimension changed.
    """
    sales = wh.read_batches("SILVER_SALES")
    source, done = wh.batch_counts("SILVER_SALES"), wh.batch_counts("GOLD_FACT_SALES")
    stale = {b for b, n in source.items() if done.get(b) != n}
    if done and recheck:
        keyless = F.col("COUNTRY_ID").isNull() | F.col("PRODUCT_ID").isNull()
        stale |= {r[0] for r in wh.read_batches("GOLD_FACT_SALES").filter(keyless).select(BATCH).distinct().collect()}
    if not stale:
        return None
    part = sales.filter(F.col(BATCH).isin(sorted(stale)))
    fact = star.fact_sales(part, countries, product_names, BATCH)
    return wh.write_batches("GOLD", "FACT_SALES", conform(fact, f"{schemas.FACT_SALES}, {BATCH} STRING"))


#: The Silver tables that each Gold table is made from.
GOLD_SOURCES = {
    "GOLD_DIM_COUNTRY": ("SILVER_COUNTRY_METADATA",),
    "GOLD_DIM_PRODUCT": ("SILVER_PRODUCT_MAPPING",),
    "GOLD_DIM_EXCHANGE_RATE": ("SILVER_EXCHANGE_RATE",),
    "GOLD_DIM_RFM_MAPPING": ("SILVER_RFM_MAPPING",),
    "GOLD_FACT_SALES": ("SILVER_SALES", "SILVER_COUNTRY_METADATA", "SILVER_PRODUCT_MAPPING"),
}


def source_mark(wh: Warehouse, name: str) -> str:
    """Changes whenever a table does: its last batch and when that was written."""
    batches = wh.batches(name)
    folder = f"{wh.current(name)}/{BATCH}={batches[-1]}" if batches else wh.current(name)
    return f"{batches[-1] if batches else ''}@{modified(wh.spark, folder)}"


def load_gold(wh: Warehouse) -> list[str]:
    """The sales fact and its four dimensions, each rebuilt when one of the tables it is made from has changed.

    The marks of the inputs are stored per Gold table, so a late rate or a new mapping rebuilds its dimension alone.
    """
    seen = json.loads(wh.get_watermark("gold_layer") or "{}")
    present = {n for sources in GOLD_SOURCES.values() for n in sources if wh.exists(n)}
    marks = {n: source_mark(wh, n) for n in present}
    now = {g: {n: marks.get(n) for n in sources} for g, sources in GOLD_SOURCES.items()}
    due = [g for g, sources in GOLD_SOURCES.items() if present.issuperset(sources) and seen.get(g) != now[g]]
    names = []
    for gold in due:
        table = gold.removeprefix("GOLD_")
        if gold == "GOLD_DIM_COUNTRY":
            made = wh.overwrite("GOLD", table, star.dim_country(country_table(wh)), schemas.DIM_COUNTRY)
        elif gold == "GOLD_DIM_PRODUCT":
            made = wh.overwrite("GOLD", table, star.dim_product(product_table(wh)), schemas.DIM_PRODUCT)
        elif gold == "GOLD_DIM_EXCHANGE_RATE":
            made = wh.overwrite("GOLD", table, star.dim_exchange_rate(rate_table(wh)), schemas.EXCHANGE_RATE)
        elif gold == "GOLD_DIM_RFM_MAPPING":
            made = wh.overwrite("GOLD", table, star.dim_rfm_mapping(wh.read("SILVER_RFM_MAPPING")), schemas.RFM_MAPPING)
        else:
            before = seen.get(gold, {})
            recheck = any(before.get(n) != marks[n] for n in GOLD_SOURCES[gold][1:])
            made = load_fact(wh, country_table(wh), product_table(wh), recheck)
        names += [made] if made else []
    if due:
        wh.set_watermark("gold_layer", json.dumps(seen | {g: now[g] for g in due}, sort_keys=True), "marks")
    return names


def customer_rfm(fact: DataFrame) -> DataFrame:
    """Metrics and scores per customer from fact lines."""
    sales = cleaning.filter_valid_sales(fact)
    return rfm.rfm_scores(cut_lineage(rfm.rfm_derived(rfm.rfm_metrics(sales))))


def load_rfm(wh: Warehouse, reports: str | None = None) -> str | None:
    fact = wh.read("GOLD_FACT_SALES")
    mark = _gate(wh, "gold_rfm_scoring", fact)
    if mark is None:
        return None
    scored = customer_rfm(fact)
    name = wh.overwrite("GOLD", "DIM_CUSTOMER_RFM", scored, schemas.CUSTOMER_RFM)
    if reports:
        export_reports(
            wh.spark, {"Customer RFM score": scored, **rfm.rfm_score_summaries(scored)}, reports, "gold_customer_rfm"
        )
    wh.set_watermark("gold_rfm_scoring", mark)
    return name


def model_input(fact: DataFrame, customers: DataFrame, train_months: int = 12) -> DataFrame:
    """CUSTOMER_ID, TARGET and the numeric features."""
    sales = cleaning.filter_valid_sales(fact, ("CUSTOMER_ID", "INVOICE_DATE", "REVENUE"))
    sales = cleaning.extract_year_month(sales)
    features = cltv_features.feature_join(cltv_features.time_features(sales), customers)
    numbers = cltv_features.fill_missing_features(cltv_features.numeric_select(features))
    target = cltv_features.future_revenue_target(sales, train_months)
    return numbers.join(target, "CUSTOMER_ID")


def fit_value_models(fact: DataFrame, customers: DataFrame, **kw) -> tuple[cltv_models.Trained, cltv_models.Prepared]:
    data = cut_lineage(model_input(fact, customers))
    names = [c for c in data.columns if c not in ("CUSTOMER_ID", "TARGET")]
    prepared = cltv_models.prepare(data, names)
    return cltv_models.train_models(data.sparkSession, prepared, **kw), prepared


def load_cltv(wh: Warehouse, reports: str | None = None, **kw) -> list[str]:
    fact = wh.read("GOLD_FACT_SALES")
    mark = _gate(wh, "gold_cltv", fact)
    if mark is None:
        return []
    trained, prepared = fit_value_models(fact, wh.read("GOLD_DIM_CUSTOMER_RFM"), **kw)
    names = [
        wh.overwrite("GOLD", "DIM_CUSTOMER_CLTV", trained.predictions, schemas.CUSTOMER_CLTV),
        wh.overwrite("GOLD", "DIM_CLTV_MODEL_RESULTS", trained.results.coalesce(1), schemas.CLTV_MODEL_RESULTS),
    ]
    if reports:
        importance = cltv_models.feature_importance(wh.spark, trained.models[trained.best], prepared.features)
        sales = cleaning.extract_year_month(cleaning.filter_valid_sales(fact, ("CUSTOMER_ID", "INVOICE_DATE", "REVENUE")))
        target = cltv_features.capped_target(sales)
        export_reports(
            wh.spark,
            {
                "Customer CLTV": wh.read("GOLD_DIM_CUSTOMER_CLTV"),
                "Model Results": trained.results,
                "Feature Importance": importance,
                "Capped targets": wh.spark.createDataFrame([(target.cap, target.count)], "CAP DOUBLE, CAPPED BIGINT"),
            },
            reports,
            "cltv_exploration",
        )
    prepared.release()
    wh.set_watermark("gold_cltv", mark)
    return names


def run_all(
    wh: Warehouse,
    landing: str,
    mapping: str,
    reference: DataFrame,
    first_rates: DataFrame,
    second_rates: DataFrame,
    reports: str | None = None,
) -> None:
    """All steps in order."""
    load_bronze(wh, landing)
    load_bronze_mapping(wh, mapping)
    load_silver_sales(wh)
    load_silver_mapping(wh)
    load_country(wh, reference, reports=reports)
    load_rates(wh, first_rates, second_rates, reports)
    load_products(wh, reports)
    load_gold(wh)
    load_rfm(wh, reports)
    load_cltv(wh, reports)
