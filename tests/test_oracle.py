"""Queries against their oracle SQL. TILLWORK_ALL=1 runs every query that has one."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry_point
from check_oracle import TABLES, rows_of

SF = "/root/testdata/sf0.001"
QUICK = (
    "clean_column_names infer_types append_merge incr_key_antijoin silver_sales clean_country coerce_numeric description_clean country_enrich "
    "fx_rate_lookup product_mapping_lists product_mapping_repeated fact_sales rfm_scores time_features cap_quantile profile_value_share "
    "profile_corr_matrix faulty_descriptions silver_sales_late report_bundle_export table_overwrite watermark_set rank_first "
    "quintile_score rfm_metrics rfm_metrics_small_prices linear_fit fx_rate_asof clean_customer_id_double utc_offset profile_all "
    "gold_layer csv_scan table_scan prefix_union_scan mapping_scan incr_timestamp_filter incr_file_ingest fx_missing_report "
    "dim_product monthly_pivot future_revenue_target profile_info profile_need_trim unique_countries split_returns"
).split()
NAMES = sorted(entry_point.oracle_sql()) if os.environ.get("TILLWORK_ALL") else QUICK


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_oracle(spark, db, name):
    df = entry_point.queries()[name](spark, SF)
    want = db.sql(entry_point.oracle_sql()[name]).to_arrow_table()
    got = df.toArrow()
    assert {f.name: str(f.type) for f in got.schema} == {f.name: str(f.type) for f in want.schema}
    ours = [tuple(r.values()) for r in got.to_pylist()]
    theirs = [tuple(r.values()) for r in want.to_pylist()]
    assert rows_of(df.columns, ours) == rows_of(want.column_names, theirs)


def test_entry(spark):
    df = entry_point.entry(spark)
    assert len(df.columns) == 22 and df.count() > 100


def test_every_oracle_has_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
