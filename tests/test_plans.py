"""Physical plans: what is pushed down, pruned, pre-aggregated, and never used."""

import pytest
from pyspark.sql import functions as F

from registry.base import QUERIES
import registry.load  # noqa: F401
from tests.conftest import SF_DIR
from tillwise.functions.semantics import first_per_key
from tillwise.operators import enrich, serving

LAZY = [
    "enriched_orders", "fact_orders", "daily_business_metrics", "product_performance_metrics", "stg_orders",
    "stg_order_items", "int_customer_orders", "int_customer_support", "int_product_metrics", "customer_lifetime_value",
    "customer_segmentation", "product_pairs", "product_affinity", "product_recommendations", "monthly_cohorts",
    "support_analytics", "customer_order_analytics", "order_lookup", "headline_kpis", "recent_volume", "state_revenue",
    "dedupe_latest", "duplicate_rows", "merge_orders", "mirror_sync", "reconcile_stats", "resample", "interpolate_linear",
    "dq_results", "daily_performance_summary", "latency_summary", "semantic_two_grains", "semantic_totals",
    "recommendation_training_set", "unbought_pairs", "candidate_matrix", "repurchase_candidates", "assign_ids",
    "recent_relative_to_max", "entity_product_reviews", "search_filtered", "sentiment",
]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, name):
    plan = _plan(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan and "InPandas" not in plan


def test_filters_and_columns_reach_the_scan(spark, tables):
    plan = _plan(serving.lookup(tables.customers, "customer_id", 5).select("email"))
    assert "PushedFilters: [IsNotNull(c_custkey), EqualTo(c_custkey,5)]" in plan
    assert "ReadSchema: struct<c_custkey:bigint>" in plan
    daily = _plan(QUERIES["orders_by_status"](spark, SF_DIR))
    assert "o_totalprice" not in daily


def test_top_n_per_key_is_limited_before_the_shuffle(tables):
    df = first_per_key(tables.orders, ["customer_id"], [F.desc("order_date"), F.desc("order_id")], 2)
    plan = _plan(df)
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_top_k_keeps_k_rows_per_task(tables):
    plan = _plan(serving.recent_orders(tables.orders, 5))
    assert "TakeOrderedAndProject" in plan and "EqualTo(o_custkey,5)" in plan


def test_aggregates_combine_before_the_shuffle(tables):
    plan = _plan(serving.customer_order_analytics(tables.customers, tables.orders))
    assert "partial_sum" in plan


def test_fact_uses_no_window(tables):
    plan = _plan(enrich.fact_orders(enrich.enriched_orders(tables.orders), enrich.enriched_order_items(tables.order_items)))
    assert "Window" not in plan


def test_serving_table_is_ordered(spark, tables, folder):
    serving.write_serving(serving.order_lookup(tables.orders, tables.customers), folder, "order_id", 4)
    plan = _plan(serving.lookup(spark.read.parquet(folder), "order_id", "77"))
    assert "EqualTo(order_id,77)" in plan
    assert serving.lookup(spark.read.parquet(folder), "order_id", "77").count() == 1
