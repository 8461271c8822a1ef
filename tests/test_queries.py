"""Registered queries against DuckDB on the smallest sample; ``verify_queries.py`` runs them all."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from ledgermart.registry.compare import compare, connect

SAMPLED = [
    "silver_ledger", "bad_rate_by_month_on_book", "silver_financials", "feature_store_one_snapshot",
    "clickstream_aggregates_all_snapshots", "numeric_summary_of_financials", "iqr_outliers",
    "customer_overlaps", "performance_over_time", "population_stability_index", "score_shift",
    "ordered_split_of_all_labels", "prediction_store_summary", "inference_section",
]


@pytest.fixture(scope="module")
def connection(small_dir):
    return connect(small_dir)


@pytest.mark.parametrize("name", SAMPLED)
def test_query_equals_sql(spark, connection, small_dir, name):
    same, note = compare(spark, connection, small_dir, queries()[name], oracle_sql()[name])
    assert same, note


def test_every_sql_text_has_a_query():
    assert oracle_sql().keys() <= queries().keys()
    assert len(queries()) > 140


def test_entry(spark):
    assert entry(spark).columns == ["mob", "loans", "bads", "bad_rate"]
