"""A cross-section of the registered queries against their SQL; all of them: python -m registry.check."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from registry.check import compare, connect
from tests.conftest import SF_DIR

SAMPLE = [
    "enriched_order_items", "fact_orders", "daily_business_metrics", "customer_segmentation", "product_recommendations",
    "product_performance", "monthly_cohorts", "support_analytics", "segment_revenue_having", "latency_summary",
    "verified_weekday_weekend", "semantic_two_grains", "merge_orders_counts", "state_as_of", "duplicate_rows",
    "interpolate_linear", "daily_orders_filled", "dq_expectations", "recommendation_training_set", "candidate_matrix",
    "pairwise_similarity", "search_documents", "redact_pii", "stream_ingest_orders",
]


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", SAMPLE)
def test_matches_sql(spark, duck, name):
    assert compare(queries()[name](spark, SF_DIR), duck, oracle_sql()[name]) is None


def test_every_oracle_belongs_to_a_query_and_parses(duck):
    assert set(oracle_sql()) <= set(queries())
    for name, sql in oracle_sql().items():
        duck.execute("EXPLAIN " + sql).fetchall()


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
