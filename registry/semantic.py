"""Semantic layer and verified queries."""

from pyspark.sql import functions as F

from registry.base import query
from registry.enrich import daily
from registry.marts import affinity, clv, segments
from tillwise.plans import verified as vq
from tillwise.plans.semantic import business_model, order_model
from tillwise.sources.fixtures import AS_OF

TODAY = f"DATE '{AS_OF}'"
MONTH_END = "2001-07-31"
_NET = "(total_amount * (1 - discount_percent * 0.01::DECIMAL(3,2)))"
_GIVEN = "(total_amount * discount_percent * 0.01::DECIMAL(3,2))"


def _orders_model(t):
    return order_model(t.customers, t.orders, t.order_items)


def _business(t):
    return business_model(t.customers, t.orders, t.product_catalog, clv(t), segments(t), daily(t), affinity(t), AS_OF)


@query("semantic_segment_revenue", f"""
    SELECT customer_segment, SUM(total_amount)::DOUBLE AS total_revenue, SUM({_NET})::DOUBLE AS net_revenue,
           COUNT(DISTINCT order_id) AS order_count, SUM(total_amount)::DOUBLE / COUNT(*) AS average_order_value
    FROM ord JOIN cust USING (customer_id) GROUP BY 1""")
def _(t):
    return _orders_model(t).query(["revenue", "net_sales", "order_count", "aov"], ["segment"])


@query("semantic_year_month_segment", """
    SELECT year(order_date) AS order_year, month(order_date) AS order_month, customer_segment,
           SUM(total_amount)::DOUBLE AS total_revenue, COUNT(DISTINCT order_id) AS order_count
    FROM ord JOIN cust USING (customer_id) WHERE year(order_date) = 2000 GROUP BY 1, 2, 3""")
def _(t):
    return _orders_model(t).query(["total_revenue", "order_count"], ["order_year", "order_month", "customer_segment"],
                                  having=F.col("order_year") == 2000)


@query("semantic_two_grains", """
    SELECT customer_segment, a.total_revenue, b.total_items_revenue, c.customer_count
    FROM (SELECT customer_segment, SUM(total_amount)::DOUBLE AS total_revenue FROM ord JOIN cust USING (customer_id) GROUP BY 1) a
    JOIN (SELECT customer_segment, SUM(line_total)::DOUBLE AS total_items_revenue
          FROM item JOIN ord USING (order_id) JOIN cust USING (customer_id) GROUP BY 1) b USING (customer_segment)
    JOIN (SELECT customer_segment, COUNT(*) AS customer_count FROM cust GROUP BY 1) c USING (customer_segment)""")
def _(t):
    return _orders_model(t).query(["total_revenue", "total_items_revenue", "customer_count"], ["customer_segment"])


@query("semantic_items_by_status", """
    SELECT order_status, product_category, SUM(line_total)::DOUBLE AS total_items_revenue, SUM(quantity)::BIGINT AS quantity
    FROM item JOIN ord USING (order_id) GROUP BY 1, 2 HAVING SUM(line_total) > 100""")
def _(t):
    return _orders_model(t).query(["total_items_revenue", "units"], ["order_status", "product_category"],
                                  having=F.col("total_items_revenue") > 100)


@query("semantic_totals", """
    SELECT SUM(total_amount)::DOUBLE AS total_revenue, (SELECT COUNT(*) FROM cust) AS customer_count FROM ord""")
def _(t):
    return _orders_model(t).query(["total_revenue", "customer_count"])


@query("semantic_discount_metrics", f"""
    SELECT customer_segment, 100.0::DOUBLE * COUNT(*) FILTER (discount_percent > 0) / COUNT(*) AS discount_order_penetration_percentage,
           SUM({_GIVEN})::DOUBLE / SUM(total_amount)::DOUBLE * 100 AS discount_penetration_percentage,
           SUM({_GIVEN})::DOUBLE / SUM(total_amount)::DOUBLE AS discount_penetration_ratio,
           SUM(total_amount)::DOUBLE AS gross_revenue_before_discounts, SUM({_NET})::DOUBLE AS net_revenue_before_shipping,
           SUM({_GIVEN})::DOUBLE AS total_discounts_given, SUM({_NET} + shipping_cost)::DOUBLE AS total_revenue_with_shipping,
           SUM({_NET} + shipping_cost)::DOUBLE / COUNT(*) AS segment_aov
    FROM ord JOIN cust USING (customer_id) GROUP BY 1""")
def _(t):
    return _business(t).query(
        ["discount_order_penetration_percentage", "discount_penetration_percentage", "discount_penetration_ratio",
         "gross_revenue_before_discounts", "net_revenue_before_shipping", "total_discounts_given",
         "total_revenue_with_shipping", "segment_aov"], ["customers.customer_segment"])


@query("semantic_daily_metrics", """
    SELECT order_day_name, SUM(total_orders)::DOUBLE / COUNT(*) AS avg_daily_orders,
           SUM(total_net_revenue)::DOUBLE / COUNT(*) AS avg_daily_revenue,
           SUM(total_discounts)::DOUBLE / SUM(total_discounts + total_net_revenue)::DOUBLE AS daily_discount_penetration_ratio,
           SUM(large_orders)::BIGINT AS large_orders_count
    FROM daily GROUP BY 1""")
def _(t):
    return _business(t).query(["avg_daily_orders", "avg_daily_revenue", "daily_discount_penetration_ratio",
                               "large_orders_count"], ["order_day_name"])


@query("semantic_free_condition", f"""
    SELECT customer_segment, SUM(total_amount)::DOUBLE AS total_revenue, COUNT(DISTINCT order_id) AS order_count, SUM({_NET})::DOUBLE AS net_revenue
    FROM ord JOIN cust USING (customer_id)
    WHERE (order_status = 'Completed' AND state IN ('CO', 'UT', 'CA') OR order_status = 'Shipped') AND total_amount > 500 GROUP BY 1""")
def _(t):
    """Rows filtered on dimensions and facts that are not in the result."""
    return _orders_model(t).query(
        ["total_revenue", "order_count", "net_revenue"], ["segment"],
        condition=lambda of: ((of("status") == "Completed") & of("region").isin("CO", "UT", "CA") | (of("status") == "Shipped"))
        & (of("order_value") > 500))


@query("semantic_condition_across_tables", """
    SELECT order_status, SUM(line_total)::DOUBLE AS total_items_revenue
    FROM item JOIN ord USING (order_id) JOIN cust USING (customer_id)
    WHERE customer_segment = 'Premium' AND year(order_date) = 2000 GROUP BY 1""")
def _(t):
    return _orders_model(t).query(["total_items_revenue"], ["order_status"],
                                  condition=lambda of: (of("segment") == "Premium") & (of("year") == 2000))


@query("semantic_customer_averages", """
    SELECT value_tier, SUM(total_revenue)::DOUBLE / COUNT(total_revenue) AS average_customer_revenue,
           SUM(recency_score + frequency_score + monetary_score)::DOUBLE / (COUNT(recency_score + frequency_score + monetary_score) * 3) AS average_rfm_score
    FROM clv GROUP BY 1""")
def _(t):
    return _business(t).query(["average_customer_revenue", "average_rfm_score"], ["value_tier"])


@query("semantic_daily_discounts", """
    SELECT order_day_name, SUM(avg_order_value::DECIMAL(20,6))::DOUBLE / COUNT(avg_order_value) AS avg_order_value_by_day,
           SUM(total_discounts)::DOUBLE / SUM(total_discounts + total_net_revenue)::DOUBLE * 100 AS daily_discount_penetration_percentage,
           (SUM(total_discounts) + SUM(total_net_revenue))::DOUBLE AS daily_gross_revenue_before_discounts,
           SUM(total_discounts)::DOUBLE AS daily_total_discounts_given
    FROM daily GROUP BY 1""")
def _(t):
    return _business(t).query(["avg_order_value_by_day", "daily_discount_penetration_percentage",
                               "daily_gross_revenue_before_discounts", "daily_total_discounts_given"], ["order_day_name"])


@query("semantic_shipping_average", f"""
    SELECT order_status, SUM({_NET} + shipping_cost)::DOUBLE / COUNT(*) AS average_order_value_with_shipping FROM ord GROUP BY 1""")
def _(t):
    return _business(t).query(["average_order_value_with_shipping"], ["order_status"])


# Named filters, each with the metric it is usually read with.
_FILTERED = {
    "valid_customer_segments": ("order_count", "SELECT COUNT(*) AS order_count FROM ord JOIN cust USING (customer_id) "
                                "WHERE customer_segment IN ('Premium', 'Standard')"),
    "at_risk_customers": ("customer_count", "SELECT COUNT(*) AS customer_count FROM clv WHERE customer_status = 'at_risk'"),
    "high_value_customers": ("total_customer_revenue", "SELECT SUM(total_revenue)::DOUBLE AS total_customer_revenue "
                             "FROM clv WHERE value_tier = 'high_value'"),
    "current_month_data": ("total_net_revenue_sum", "SELECT SUM(total_net_revenue)::DOUBLE AS total_net_revenue_sum "
                           "FROM daily WHERE order_year = 2001 AND order_month = 8"),
    "days_with_large_orders": ("avg_daily_orders", "SELECT SUM(total_orders)::DOUBLE / COUNT(*) AS avg_daily_orders "
                               "FROM daily WHERE large_orders > 0"),
    "last_30_days": ("total_net_revenue_sum", "SELECT SUM(total_net_revenue)::DOUBLE AS total_net_revenue_sum "
                     f"FROM daily WHERE order_date_only >= {TODAY} - 30"),
    "last_90_days": ("total_net_revenue_sum", "SELECT SUM(total_net_revenue)::DOUBLE AS total_net_revenue_sum "
                     f"FROM daily WHERE order_date_only >= {TODAY} - 90"),
    "weekend_days": ("avg_daily_revenue", "SELECT SUM(total_net_revenue)::DOUBLE / COUNT(*) AS avg_daily_revenue "
                     "FROM daily WHERE order_day_name IN ('Sat', 'Sun')"),
    "strong_product_affinities": ("times_bought_together", "SELECT SUM(times_bought_together)::BIGINT AS times_bought_together "
                                  "FROM aff WHERE affinity_strength IN ('strong', 'very_strong')"),
}
for _name, (_metric, _sql) in _FILTERED.items():
    @query(f"filter_{_name}", _sql)
    def _(t, name=_name, metric=_metric):
        return _business(t).query([metric], where=[name])


# --- verified queries --------------------------------------------------------------------

@query("verified_revenue_trend", f"""SELECT order_date_only::VARCHAR AS order_date_only, total_net_revenue::DOUBLE AS total_revenue,
       total_net_revenue::DOUBLE AS net_revenue FROM daily WHERE daily.order_date_only >= {TODAY} - 7""")
def _(t):
    return vq.revenue_trend(daily(t), AS_OF)


@query("verified_top_revenue_days", """SELECT order_date_only::VARCHAR AS order_date_only, total_net_revenue::DOUBLE AS total_revenue
       FROM daily WHERE order_year = 2001 AND order_month = 7 ORDER BY total_net_revenue DESC, daily.order_date_only LIMIT 5""")
def _(t):
    return vq.top_revenue_days(daily(t), MONTH_END)


@query("verified_weekday_weekend", f"""SELECT CASE WHEN isodow(order_date_only) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS period_type,
       SUM(total_net_revenue)::DOUBLE AS total_revenue, COUNT(*) AS num_days,
       SUM(total_net_revenue)::DOUBLE / COUNT(*) AS avg_daily_revenue FROM daily WHERE order_date_only >= {TODAY} - 30 GROUP BY 1""")
def _(t):
    return vq.weekday_weekend(daily(t), AS_OF)


@query("verified_discount_impact", f"""SELECT SUM({_GIVEN})::DOUBLE / SUM(total_amount)::DOUBLE * 100 AS discount_penetration_pct,
       SUM({_GIVEN})::DOUBLE AS total_discounts_given, SUM({_NET})::DOUBLE AS net_revenue, SUM(total_amount)::DOUBLE AS gross_revenue
       FROM ord WHERE order_date >= {TODAY} - 30""")
def _(t):
    return vq.discount_impact(t.orders, AS_OF)


@query("verified_segment_revenue", f"""SELECT customer_segment, SUM({_NET} + shipping_cost)::DOUBLE AS total_revenue,
       COUNT(DISTINCT order_id) AS total_orders, SUM({_NET} + shipping_cost)::DOUBLE / COUNT(*) AS avg_order_value
       FROM ord JOIN cust USING (customer_id) WHERE order_date >= {TODAY} - 30 GROUP BY 1""")
def _(t):
    return vq.segment_revenue_with_shipping(t.orders, t.customers, AS_OF)


@query("verified_best_days_of_week", f"""SELECT order_day_name, SUM(total_net_revenue)::DOUBLE AS total_revenue,
       SUM(total_orders)::DOUBLE / COUNT(*) AS avg_orders_per_day,
       SUM(avg_order_value::DECIMAL(20,6))::DOUBLE / COUNT(*) AS avg_order_value
       FROM daily WHERE order_date_only >= {TODAY} - 90 GROUP BY 1""")
def _(t):
    return vq.best_days_of_week(daily(t), AS_OF)


@query("verified_large_order_trend", f"""SELECT order_date_only::VARCHAR AS order_date_only, large_orders, extra_large_orders, total_orders
       FROM daily WHERE daily.order_date_only >= {TODAY} - 30""")
def _(t):
    return vq.large_order_trend(daily(t), AS_OF)


@query("verified_order_size_distribution", f"""SELECT order_date_only::VARCHAR AS order_date_only, small_orders, medium_orders,
       large_orders, extra_large_orders, total_orders FROM daily WHERE daily.order_date_only >= {TODAY} - 30""")
def _(t):
    return vq.order_size_distribution(daily(t), AS_OF)


_RFM = "SUM(recency_score + frequency_score + monetary_score)::DOUBLE / (3 * COUNT(*)) AS avg_rfm_score"


@query("verified_value_tiers", f"""SELECT value_tier, COUNT(*) AS num_customers, SUM(total_revenue)::DOUBLE AS total_revenue,
       SUM(total_revenue)::DOUBLE / COUNT(*) AS avg_revenue_per_customer, SUM(total_orders)::DOUBLE / COUNT(*) AS avg_orders_per_customer,
       {_RFM} FROM clv GROUP BY 1""")
def _(t):
    return vq.by_value_tier(vq.value_tier_analysis(clv(t)))


@query("verified_at_risk_high_value", """SELECT customer_id, customer_name, customer_segment, value_tier, total_revenue::DOUBLE AS total_revenue,
       total_orders, days_since_last_order, estimated_annual_value FROM clv
       WHERE customer_status = 'at_risk' AND value_tier = 'high_value' ORDER BY estimated_annual_value DESC, customer_id LIMIT 20""")
def _(t):
    return vq.at_risk_high_value(clv(t))


@query("verified_behavioral_segments", f"""SELECT behavioral_segment, recommended_action, segment_priority, COUNT(*) AS num_customers,
       SUM(total_revenue)::DOUBLE AS segment_revenue, {_RFM} FROM seg GROUP BY 1, 2, 3""")
def _(t):
    return vq.behavioral_segments(segments(t))


@query("verified_top_product_pairs", """SELECT product_a_name, product_b_name, times_bought_together, confidence_a_to_b, lift, affinity_strength
       FROM aff WHERE affinity_strength IN ('very_strong', 'strong')
       ORDER BY times_bought_together DESC, product_a_name, product_b_name LIMIT 15""")
def _(t):
    return vq.top_product_pairs(affinity(t))


@query("verified_cross_category", """SELECT product_a_name, product_a_category, product_b_name, product_b_category, times_bought_together, lift,
       affinity_strength FROM aff WHERE product_a_category <> product_b_category AND recommendation_priority = 1
       ORDER BY lift DESC, product_a_name, product_b_name LIMIT 10""")
def _(t):
    return vq.cross_category_pairs(affinity(t))


@query("verified_discount_analysis", f"""
    SELECT MIN(order_date)::DATE::VARCHAR AS data_start_date, MAX(order_date)::DATE::VARCHAR AS data_end_date,
           COUNT(DISTINCT order_date::DATE) AS total_days_with_data, SUM(total_amount)::DOUBLE AS revenue_before_discounts,
           SUM({_GIVEN})::DOUBLE AS total_discount_amounts, SUM({_NET})::DOUBLE AS revenue_after_discounts,
           (SUM(total_amount) - SUM({_NET}))::DOUBLE AS discount_impact_amount,
           SUM({_GIVEN})::DOUBLE / SUM(total_amount)::DOUBLE AS discount_rate, COUNT(*) AS total_orders,
           COUNT(*) FILTER (discount_percent > 0) AS orders_with_discounts,
           (COUNT(*) FILTER (discount_percent > 0))::DOUBLE / COUNT(*) AS discount_penetration
    FROM ord WHERE order_date::DATE <= {TODAY}""")
def _(t):
    return vq.discount_analysis(t.orders, AS_OF)
