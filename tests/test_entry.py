"""Driver contract: entry smoke and every oracle key against DuckDB at sf0.001."""

import pytest

from conftest import SF001


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and "total_revenue" in df.columns


def test_every_query_has_oracle_or_is_rows_only():
    import __spark_entry__ as E
    missing = set(E.lake_queries()) - set(E.oracle_sql())
    assert missing == {"new_files", "dq_sample"}


@pytest.mark.parametrize("key", [
    "kpi_revenue_by_product", "kpi_top_products", "monthly_category_revenue", "mom_growth", "region_vs_average",
    "amount_outliers", "store_volume_drop", "dq_gate", "dq_error_counts", "silver_roundtrip", "dead_letter",
    "retention_expired", "customer_patterns", "late_data_rebuild", "win_daily_avg", "late_data_retry", "rebuild_moved_day",
    "dead_letter_written", "dq_first_errors", "schema_discovery", "gold_after_failure", "gold_after_retry", "metrics_history",
    "cleaning_counters", "lake_after_expiry", "catalog_bronze", "catalog_gold", "catalog_partitions", "sql_growth", "sql_landed",
    "landing_stream", "win_hourly_sum", "silver_with_new_column",
])
def test_oracle_match_small(spark, key):
    from oracle_check import compare
    r = compare(spark, SF001, [key], verbose=False)[key]
    assert r["status"] == "MATCH", r
