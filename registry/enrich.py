"""Enrichment, fact and aggregate queries."""

from pyspark.sql import functions as F

from registry.base import SHARED_SQL, query
from tillwise.operators import additive as ad
from tillwise.operators import enrich as op
from tillwise.sources.files import scratch_dir

SHARED_SQL["eord"] = """
    SELECT order_id, customer_id, order_date, order_status, order_date::DATE AS order_date_only,
           year(order_date) AS order_year, quarter(order_date) AS order_quarter, month(order_date) AS order_month,
           dayofweek(order_date) AS order_day_of_week, left(dayname(order_date), 3) AS order_day_name,
           weekofyear(order_date) AS order_week, total_amount, discount_percent, shipping_cost,
           round(total_amount * discount_percent * 0.01::DECIMAL(3,2), 2)::DECIMAL(12,2) AS discount_amount,
           round(total_amount - total_amount * discount_percent * 0.01::DECIMAL(3,2), 2)::DECIMAL(12,2) AS net_amount,
           round(total_amount - total_amount * discount_percent * 0.01::DECIMAL(3,2) + shipping_cost, 2)::DECIMAL(12,2) AS final_amount,
           coalesce(discount_percent > 0, false) AS has_discount,
           CASE WHEN discount_percent > 20 THEN 'High Discount' WHEN discount_percent > 10 THEN 'Medium Discount'
                WHEN discount_percent > 0 THEN 'Low Discount' ELSE 'No Discount' END AS discount_tier,
           CASE WHEN total_amount >= 2000 THEN 'Extra Large' WHEN total_amount >= 500 THEN 'Large'
                WHEN total_amount >= 100 THEN 'Medium' ELSE 'Small' END AS order_size_category
    FROM ord"""

SHARED_SQL["eitem"] = """
    SELECT order_item_id, order_id, product_id, product_name, product_category, quantity, unit_price, line_total,
           (((2 * (line_total * 100)::BIGINT + quantity) // (2 * quantity))::DECIMAL(14,0) * 0.01::DECIMAL(3,2))::DECIMAL(12,2) AS actual_unit_price,
           (sign(gap) * ((2 * abs(gap) + quantity) // (2 * quantity)))::DECIMAL(14,0) * 0.01::DECIMAL(3,2) AS unit_price_variance,
           product_category = 'SMALL' AS is_skis, product_category = 'ECONOMY' AS is_snowboards,
           CASE WHEN quantity > 3 THEN 'Bulk' WHEN quantity = 1 THEN 'Single' ELSE 'Few' END AS quantity_tier
    FROM (SELECT *, (unit_price * 100)::BIGINT * quantity - (line_total * 100)::BIGINT AS gap FROM item)"""

SHARED_SQL["fact"] = """
    SELECT eord.*, eitem.* EXCLUDE (order_id), t.items_per_order, t.order_items_total
    FROM eord JOIN eitem USING (order_id)
    JOIN (SELECT order_id, COUNT(order_item_id) AS items_per_order, SUM(line_total) AS order_items_total
          FROM eitem GROUP BY order_id) t USING (order_id)"""

# The test catalogue has other categories than the default flags name.
FLAGS = {"is_skis": "SMALL", "is_snowboards": "ECONOMY"}


def fact(t):
    return op.fact_orders(op.enriched_orders(t.orders), op.enriched_order_items(t.order_items, FLAGS))


def daily(t, grain="item"):
    return op.daily_business_metrics(fact(t), grain)


def _num(cols):
    return ", ".join(f"{c}::DOUBLE AS {c}" for c in cols.split())


@query("enriched_orders", f"""
    SELECT * REPLACE (order_date::VARCHAR AS order_date, order_date_only::VARCHAR AS order_date_only,
        {_num("total_amount discount_percent shipping_cost discount_amount net_amount final_amount")}) FROM eord""")
def _(t):
    return op.enriched_orders(t.orders)


@query("enriched_order_items", f"""
    SELECT * REPLACE ({_num("unit_price line_total actual_unit_price unit_price_variance")}) FROM eitem""")
def _(t):
    return op.enriched_order_items(t.order_items, FLAGS)


@query("fact_orders", f"""
    SELECT * REPLACE (order_date::VARCHAR AS order_date, order_date_only::VARCHAR AS order_date_only,
        {_num("total_amount discount_percent shipping_cost discount_amount net_amount final_amount")},
        {_num("unit_price line_total actual_unit_price unit_price_variance order_items_total")}) FROM fact""")
def _(t):
    return fact(t)


SHARED_SQL["daily"] = """
    SELECT order_date_only, order_year, order_quarter, order_month, order_week, order_day_name,
           COUNT(DISTINCT order_id) AS total_orders, COUNT(DISTINCT customer_id) AS unique_customers,
           SUM(items_per_order)::DOUBLE / COUNT(*) AS avg_items_per_order,
           SUM(total_amount) AS total_revenue, SUM(net_amount) AS total_net_revenue,
           SUM(discount_amount) AS total_discounts, SUM(shipping_cost) AS total_shipping,
           SUM(final_amount) AS total_final_revenue, SUM(final_amount)::DOUBLE / COUNT(*) AS avg_order_value,
           COUNT(DISTINCT order_id) FILTER (has_discount) AS orders_with_discount,
           ((2 * 10000 * COUNT(DISTINCT order_id) FILTER (has_discount) + COUNT(DISTINCT order_id))
             // (2 * COUNT(DISTINCT order_id)))::DECIMAL(14,0) * 0.01::DECIMAL(3,2) AS discount_penetration_pct,
           (SUM(discount_percent) FILTER (has_discount))::DOUBLE / nullif(COUNT(*) FILTER (has_discount), 0) AS avg_discount_percent,
           COUNT(DISTINCT order_id) FILTER (order_size_category = 'Small') AS small_orders,
           COUNT(DISTINCT order_id) FILTER (order_size_category = 'Medium') AS medium_orders,
           COUNT(DISTINCT order_id) FILTER (order_size_category = 'Large') AS large_orders,
           COUNT(DISTINCT order_id) FILTER (order_size_category = 'Extra Large') AS extra_large_orders
    FROM fact GROUP BY ALL"""

DAILY_MONEY = "total_revenue total_net_revenue total_discounts total_shipping total_final_revenue discount_penetration_pct"


@query("daily_business_metrics", f"""
    SELECT * REPLACE (order_date_only::VARCHAR AS order_date_only, {_num(DAILY_MONEY)}) FROM daily""")
def _(t):
    return daily(t)


@query("daily_business_metrics_order_grain", """
    SELECT order_date_only::VARCHAR AS order_date_only, COUNT(*) AS total_orders,
           SUM(total_amount)::DOUBLE AS total_revenue, SUM(net_amount)::DOUBLE AS total_net_revenue,
           SUM(final_amount)::DOUBLE / COUNT(*) AS avg_order_value
    FROM eord WHERE order_id IN (SELECT order_id FROM item) GROUP BY order_date_only""")
def _(t):
    return daily(t, "order").select(
        "order_date_only", "total_orders", "total_revenue", "total_net_revenue", "avg_order_value")


@query("product_performance_metrics", """
    SELECT product_category, COUNT(DISTINCT order_id) AS orders_count, COUNT(*) AS items_sold,
           SUM(quantity)::BIGINT AS total_quantity_sold, SUM(line_total)::DOUBLE AS total_revenue,
           SUM(unit_price)::DOUBLE / COUNT(*) AS avg_unit_price,
           SUM(quantity)::DOUBLE / COUNT(*) AS avg_quantity_per_order,
           SUM(line_total)::DOUBLE / COUNT(*) AS avg_line_total,
           MIN(unit_price)::DOUBLE AS min_unit_price, MAX(unit_price)::DOUBLE AS max_unit_price,
           COUNT(*) FILTER (is_skis) AS ski_items, COUNT(*) FILTER (is_snowboards) AS snowboard_items,
           COUNT(*) FILTER (quantity = 1) AS single_item_orders,
           COUNT(*) FILTER (quantity IN (2, 3)) AS few_item_orders,
           COUNT(*) FILTER (quantity > 3) AS bulk_orders
    FROM fact GROUP BY product_category""")
def _(t):
    return op.product_performance_metrics(fact(t), FLAGS)


@query("order_facts", """
    SELECT order_id, CASE WHEN discount_percent > 0 THEN discount_percent::DOUBLE END AS applied_discount_percent,
           (discount_percent * 0.01::DECIMAL(3,2))::DOUBLE AS discount_rate_decimal,
           (1 - discount_percent * 0.01::DECIMAL(3,2))::DOUBLE AS discount_multiplier,
           (total_amount * discount_percent * 0.01::DECIMAL(3,2))::DOUBLE AS discount_amount,
           (total_amount - total_amount * discount_percent * 0.01::DECIMAL(3,2))::DOUBLE AS discounted_order_amount,
           (total_amount - total_amount * discount_percent * 0.01::DECIMAL(3,2) + shipping_cost)::DOUBLE AS final_amount,
           CASE WHEN discount_percent > 0 THEN 1 END AS has_discount_flag, total_amount::DOUBLE AS order_total
    FROM ord""")
def _(t):
    return op.order_facts(t.orders).select(
        "order_id", "applied_discount_percent", "discount_rate_decimal", "discount_multiplier",
        "discount_amount", "discounted_order_amount", "final_amount", "has_discount_flag", "order_total")


@query("entity_customers", "SELECT * REPLACE (registration_date::VARCHAR AS registration_date) FROM cust")
def _(t):
    return t.customers


@query("entity_orders", f"""
    SELECT * REPLACE (order_date::VARCHAR AS order_date, {_num("total_amount discount_percent shipping_cost")}) FROM ord""")
def _(t):
    return t.orders


@query("entity_order_items", f"SELECT * REPLACE ({_num('unit_price line_total')}) FROM item")
def _(t):
    return t.order_items


@query("entity_product_catalog", "SELECT * REPLACE (price::DOUBLE AS price) FROM cat")
def _(t):
    return t.product_catalog


@query("entity_product_reviews", "SELECT * REPLACE (review_date::VARCHAR AS review_date) FROM rev")
def _(t):
    return t.product_reviews


@query("entity_support_tickets", "SELECT * REPLACE (ticket_date::VARCHAR AS ticket_date) FROM tick")
def _(t):
    return t.support_tickets


def stored_days(t):
    """Bitmaps of each day's customers by status, written and read again."""
    path = scratch_dir(t.spark, "bitmaps")
    orders = t.orders.select("customer_id", "order_status", F.to_date("order_date").alias("day"))
    ad.distinct_bitmaps(orders, "day", "customer_id", ["order_status"]).write.mode("overwrite").parquet(path)
    return t.spark.read.parquet(path)


@query("monthly_customers_from_days", """
    SELECT date_trunc('month', order_date)::DATE::VARCHAR AS month, COUNT(DISTINCT customer_id) AS customers FROM ord GROUP BY 1""")
def _(t):
    return ad.distinct_over(stored_days(t), F.trunc("day", "month"), "month").withColumnRenamed("ids", "customers")


@query("weekly_customers_by_status_from_days", """
    SELECT date_trunc('week', order_date)::DATE::VARCHAR AS week, order_status, COUNT(DISTINCT customer_id) AS customers
    FROM ord GROUP BY 1, 2""")
def _(t):
    return ad.distinct_over(stored_days(t), F.trunc("day", "week"), "week", ["order_status"]).withColumnRenamed("ids", "customers")
