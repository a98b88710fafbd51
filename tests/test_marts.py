import pytest
from pyspark.sql import functions as F

from tillwise.operators import enrich, marts, staging


def _segment(spark, r, f, m):
    df = spark.createDataFrame([(1, "n", "s", None, r, f, m, 0.0, 0, 0, 0.0, "t", "c")],
                               "customer_id int, customer_name string, customer_segment string, signup_date date, "
                               "recency_score int, frequency_score int, monetary_score int, rfm_score double, "
                               "total_revenue int, total_orders int, avg_order_value double, value_tier string, "
                               "customer_status string")
    row = marts.customer_segmentation(df).first()
    return row["behavioral_segment"], row["segment_priority"]


@pytest.mark.parametrize("scores, expected", [
    ((10, 10, 10), ("champions", 1)), ((6, 6, 6), ("loyal_customers", 1)), ((10, 4, 10), ("potential_loyalists", 3)),
    ((6, 2, 2), ("promising", 4)), ((4, 6, 6), ("at_risk", 2)), ((0, 10, 10), ("at_risk", 2)),
    ((4, 4, 6), ("hibernating_high_value", 3)), ((2, 2, 2), ("lost", 5)), ((4, 2, 2), ("needs_attention", 5)),
    ((6, 4, 6), ("needs_attention", 5)),
])
def test_segments(spark, scores, expected):
    assert _segment(spark, *scores) == expected


def _items(spark, baskets):
    ids = {"ski": 1, "boot": 2, "pole": 3}
    rows = [(f"{o}-{i}", str(o), ids[p], p, p.upper()) for o, b in enumerate(baskets) for i, p in enumerate(b)]
    return spark.createDataFrame(rows, "order_item_id string, order_id string, product_id long, product_name string, product_category string")


def test_affinity_counts_orders_not_rows(spark):
    items = _items(spark, [["ski", "ski", "boot", "boot"], ["ski", "boot"], ["pole"], ["pole", "ski"]])
    pairs = {(r["product_a_name"], r["product_b_name"]): r for r in marts.product_affinity(items, min_lift=0).collect()}
    assert set(pairs) == {("boot", "ski"), ("pole", "ski")}
    best = pairs["boot", "ski"]
    assert best["times_bought_together"] == 2
    assert best["confidence_a_to_b"] == 1.0 and best["confidence_b_to_a"] == pytest.approx(2 / 3)
    assert best["lift"] == pytest.approx(2 * 4 / (2 * 3)) and best["support"] == 0.5
    assert best["confidence_a_to_b"] * best["product_a_total_orders"] == best["times_bought_together"]


@pytest.mark.parametrize("lift, conf, pairs, strength, priority", [
    (3.0, 0.5, 100, "very_strong", 1), (3.0, 0.4, 50, "strong", 2), (1.5, 0.2, 25, "moderate", 3),
    (1.5, 0.1, 1, "weak", 4), (1.0, 0.9, 500, "very_weak", 4),
])
def test_affinity_ladders(spark, lift, conf, pairs, strength, priority):
    row = spark.range(1).select(
        marts.ladder([((F.lit(lift) >= l) & (F.lit(conf) >= c), s) for s, l, c in marts.STRENGTHS], marts.WEAKEST).alias("s"),
        marts.ladder([((F.lit(lift) >= l) & (F.lit(pairs) >= n), p) for p, l, n in marts.PAIR_PRIORITIES],
                     marts.LOWEST_PAIR_PRIORITY).alias("p")).first()
    assert (row["s"], row["p"]) == (strength, priority)


def test_recommendations_go_both_ways(spark):
    items = _items(spark, [["ski", "boot"], ["ski", "boot"], ["pole"], ["pole"], ["pole"], ["pole"]])
    recs = marts.product_recommendations(marts.product_affinity(items), n=1).collect()
    assert {(r["source_product_name"], r["recommended_product_name"]) for r in recs} == {("ski", "boot"), ("boot", "ski")}
    assert all(r["recommendation_rank"] == 1 and r["confidence_level"] == "high" and r["is_cross_category"] for r in recs)
    assert recs[0]["recommendation_message"].startswith("Customers who bought ")


def test_invariants_on_test_tables(tables):
    customers = staging.stg_customers(tables.customers, "2001-08-02")
    orders = staging.stg_orders(tables.orders, tables.order_items)
    assert orders.count() == tables.orders.count()
    cohorts = marts.monthly_cohorts(customers, orders)
    assert cohorts.filter("retention_rate > 1 OR active_customers > cohort_size").count() == 0
    upper = marts.monthly_cohorts(customers, orders, ["COMPLETED", "Shipped"])
    assert upper.count() == cohorts.count()
    clv = marts.customer_lifetime_value(customers, orders, "2001-08-02")
    assert clv.count() == tables.customers.count()
    assert clv.filter("total_orders = 0 AND customer_status <> 'never_purchased'").count() == 0


def test_daily_grains(tables):
    fact = enrich.fact_orders(enrich.enriched_orders(tables.orders), enrich.enriched_order_items(tables.order_items))
    total = fact.select("order_id", "total_amount").distinct().agg(F.sum("total_amount")).first()[0]
    by_order = enrich.daily_business_metrics(fact, "order").agg(F.sum("total_revenue")).first()[0]
    by_item = enrich.daily_business_metrics(fact).agg(F.sum("total_revenue")).first()[0]
    assert by_order == total and by_item == fact.agg(F.sum("total_amount")).first()[0]
    with pytest.raises(ValueError):
        enrich.daily_business_metrics(fact, "week")


def test_zero_quantity_does_not_fail(spark):
    item = spark.createDataFrame([("i", "o", 1, "n", "Skis", 0, 1.0, 1.0)],
                                 "order_item_id string, order_id string, product_id long, product_name string, "
                                 "product_category string, quantity int, unit_price double, line_total double")
    row = enrich.enriched_order_items(item).first()
    assert row["actual_unit_price"] is None and row["is_skis"] is True
