"""Staging, intermediate and mart queries."""

from registry.base import SHARED_SQL, query
from registry.enrich import _num
from tillwise.operators import marts as op
from tillwise.operators import staging as stg
from tillwise.session import cut_lineage
from tillwise.sources.fixtures import AS_OF

TODAY = f"DATE '{AS_OF}'"

SHARED_SQL["scust"] = f"""
    SELECT customer_id, first_name || ' ' || last_name AS customer_name, email, phone, address, city, state, zip_code,
           registration_date AS signup_date, customer_segment,
           date_diff('day', registration_date, {TODAY}) AS days_since_signup,
           date_trunc('month', registration_date)::DATE AS signup_month,
           date_trunc('year', registration_date)::DATE AS signup_year
    FROM cust"""

SHARED_SQL["sord"] = """
    SELECT o.*, COUNT(i.order_item_id) AS item_count, SUM(i.quantity)::BIGINT AS total_quantity,
           SUM(i.line_total) AS calculated_total, date_trunc('day', order_date)::TIMESTAMP AS order_date_only,
           date_trunc('month', order_date)::TIMESTAMP AS order_month,
           date_trunc('year', order_date)::TIMESTAMP AS order_year,
           left(dayname(order_date), 3) AS order_day_of_week, hour(order_date) AS order_hour
    FROM ord o LEFT JOIN item i ON i.order_id = o.order_id GROUP BY ALL"""

SHARED_SQL["sitem"] = """
    SELECT i.order_item_id, i.order_id, i.product_id, i.product_name,
           coalesce(c.product_category, i.product_category) AS product_category, i.quantity, i.unit_price, i.line_total,
           c.price AS catalog_price, c.description AS product_description, c.features AS product_features,
           i.unit_price - c.price AS price_difference,
           CASE sign(i.unit_price - c.price) WHEN -1 THEN 'discounted' WHEN 1 THEN 'premium' ELSE 'standard' END AS pricing_type,
           i.line_total::DOUBLE / nullif(i.quantity, 0) AS calculated_unit_price
    FROM item i LEFT JOIN cat c USING (product_name)"""

SHARED_SQL["sprod"] = f"""
    SELECT product_id, product_name, description, product_category AS category, product_category AS subcategory,
           'Unknown' AS brand, price, price * 0.6::DECIMAL(2,1) AS cost, stock_quantity, 100 AS reorder_level,
           NULL::BIGINT AS supplier_id, {TODAY} AS created_date, {TODAY} AS last_updated,
           price * 0.4::DECIMAL(2,1) AS margin, (price * 0.4::DECIMAL(2,1))::DOUBLE / nullif(price::DOUBLE, 0) AS margin_percent,
           CASE WHEN stock_quantity > 200 THEN 'adequate' WHEN stock_quantity > 100 THEN 'medium' ELSE 'low' END AS stock_status
    FROM cat"""

SHARED_SQL["srev"] = """
    SELECT review_id, customer_id, product_id, rating, review_title, review_text, review_date, verified_purchase,
           ['negative','negative','neutral','positive','positive'][rating] AS sentiment_bucket,
           date_trunc('month', review_date)::DATE AS review_month FROM rev"""

SHARED_SQL["stick"] = """
    SELECT ticket_id, customer_id, subject, category, description, status, priority, resolution, ticket_date,
           coalesce(status = 'Resolved', false) AS is_resolved, date_trunc('month', ticket_date)::TIMESTAMP AS ticket_month
    FROM tick"""

SHARED_SQL["icord"] = f"""
    SELECT c.customer_id, c.customer_name, c.email, c.customer_segment, c.signup_date, c.days_since_signup,
           COUNT(o.order_id) AS total_orders, SUM(o.total_amount) AS lifetime_revenue,
           SUM(o.total_amount)::DOUBLE / COUNT(o.total_amount) AS avg_order_value,
           SUM(o.total_quantity)::BIGINT AS lifetime_units, MIN(o.order_date) AS first_order_date,
           MAX(o.order_date) AS last_order_date, date_diff('day', MAX(o.order_date)::DATE, {TODAY}) AS days_since_last_order
    FROM scust c LEFT JOIN sord o ON o.customer_id = c.customer_id GROUP BY ALL"""

SHARED_SQL["icsup"] = """
    SELECT c.customer_id, c.customer_name, c.customer_segment, COUNT(t.ticket_id) AS total_tickets,
           COUNT(*) FILTER (t.is_resolved) AS resolved_tickets, COUNT(*) FILTER (NOT t.is_resolved) AS open_tickets,
           COUNT(*) FILTER (t.priority = 'High') AS high_priority_tickets,
           MIN(t.ticket_date) AS first_ticket_date, MAX(t.ticket_date) AS last_ticket_date,
           CASE WHEN COUNT(t.ticket_id) = 0 THEN 'no_tickets' WHEN COUNT(t.ticket_id) <= 2 THEN 'low_contact'
                WHEN COUNT(t.ticket_id) <= 5 THEN 'medium_contact' ELSE 'high_contact' END AS support_tier
    FROM scust c LEFT JOIN stick t ON t.customer_id = c.customer_id GROUP BY c.customer_id, c.customer_name, c.customer_segment"""

SHARED_SQL["ipm"] = """
    SELECT p.product_id, p.product_name, p.category, p.price AS base_price, p.stock_quantity,
           coalesce(s.order_count, 0) AS order_count, coalesce(s.units_sold, 0)::BIGINT AS units_sold,
           coalesce(s.total_revenue, 0) AS total_revenue, s.avg_selling_price,
           coalesce(r.review_count, 0) AS review_count, r.avg_rating,
           coalesce(r.pos, 0) AS positive_reviews, coalesce(r.neg, 0) AS negative_reviews
    FROM sprod p
    LEFT JOIN (SELECT product_id, COUNT(DISTINCT order_id) AS order_count, SUM(quantity) AS units_sold,
                      SUM(line_total) AS total_revenue, SUM(unit_price)::DOUBLE / COUNT(*) AS avg_selling_price
               FROM sitem GROUP BY product_id) s USING (product_id)
    LEFT JOIN (SELECT product_id, COUNT(*) AS review_count, SUM(rating)::DOUBLE / COUNT(*) AS avg_rating,
                      COUNT(*) FILTER (sentiment_bucket = 'positive') AS pos,
                      COUNT(*) FILTER (sentiment_bucket = 'negative') AS neg
               FROM srev GROUP BY product_id) r USING (product_id)"""

SHARED_SQL["clv"] = f"""
    SELECT *, (recency_score + frequency_score + monetary_score)::DOUBLE / 3 AS rfm_score,
           CASE WHEN total_revenue = 0 THEN 'no_purchases' WHEN total_revenue < 8750 THEN 'low_value'
                WHEN total_revenue < 17500 THEN 'medium_value' ELSE 'high_value' END AS value_tier,
           CASE WHEN days_since_last_order > 42 THEN 'churned' WHEN days_since_last_order > 21 THEN 'at_risk'
                WHEN days_since_last_order IS NOT NULL THEN 'active' ELSE 'never_purchased' END AS customer_status
    FROM (SELECT *, total_revenue::DOUBLE / nullif(days_since_signup, 0) * 365 AS estimated_annual_value,
                 total_revenue::DOUBLE / CASE WHEN customer_lifespan_days > 0 THEN customer_lifespan_days
                                              ELSE nullif(days_since_signup, 0) END * 365 AS historical_annual_value,
                 total_orders::DOUBLE / nullif(customer_lifespan_days, 0) * 30 AS orders_per_month,
                 CASE WHEN days_since_last_order > 365 OR days_since_last_order IS NULL THEN 0
                      WHEN days_since_last_order > 180 THEN 2 WHEN days_since_last_order > 90 THEN 4
                      WHEN days_since_last_order > 60 THEN 6 WHEN days_since_last_order > 30 THEN 8 ELSE 10 END AS recency_score,
                 2 * ((total_orders >= 1)::INT + (total_orders >= 5)::INT + (total_orders >= 10)::INT
                      + (total_orders >= 15)::INT + (total_orders >= 20)::INT) AS frequency_score,
                 2 * ((total_revenue >= 100)::INT + (total_revenue >= 500)::INT + (total_revenue >= 1000)::INT
                      + (total_revenue >= 2000)::INT + (total_revenue >= 5000)::INT) AS monetary_score
          FROM (SELECT c.customer_id, c.customer_name, c.customer_segment, c.signup_date, c.days_since_signup,
                       COUNT(o.order_id) AS total_orders, coalesce(SUM(o.total_amount), 0) AS total_revenue,
                       coalesce(SUM(o.total_amount)::DOUBLE / COUNT(o.total_amount), 0) AS avg_order_value,
                       coalesce(SUM(o.total_quantity), 0)::BIGINT AS total_items_purchased,
                       MIN(o.order_date) AS first_order_date, MAX(o.order_date) AS last_order_date,
                       date_diff('day', MIN(o.order_date)::DATE, MAX(o.order_date)::DATE) AS customer_lifespan_days,
                       date_diff('day', MAX(o.order_date)::DATE, {TODAY}) AS days_since_last_order
                FROM scust c LEFT JOIN (SELECT * FROM sord WHERE order_status IN ('Completed', 'Shipped')) o
                  ON o.customer_id = c.customer_id GROUP BY ALL))"""

# Written out, so that a wrong bound in the library shows. Two later rules can never be reached.
_SEG_CASE = """
    WHEN recency_score >= 8 AND frequency_score >= 8 AND monetary_score >= 8 THEN 'champions'
    WHEN recency_score >= 6 AND frequency_score >= 6 AND monetary_score >= 6 THEN 'loyal_customers'
    WHEN recency_score >= 8 AND frequency_score <= 4 AND monetary_score >= 6 THEN 'potential_loyalists'
    WHEN recency_score >= 6 AND frequency_score <= 4 AND monetary_score <= 4 THEN 'promising'
    WHEN recency_score <= 4 AND frequency_score >= 6 AND monetary_score >= 6 THEN 'at_risk'
    WHEN recency_score <= 4 AND frequency_score <= 4 AND monetary_score >= 6 THEN 'hibernating_high_value'
    WHEN recency_score <= 2 AND frequency_score <= 4 AND monetary_score <= 4 THEN 'lost'"""
_ACTIONS = """'champions': 'Reward and retain with VIP benefits', 'loyal_customers': 'Upsell and cross-sell opportunities',
    'potential_loyalists': 'Engage with loyalty program', 'promising': 'Nurture with targeted offers',
    'at_risk': 'Win back with personalized campaigns', 'hibernating_high_value': 'Reactivation campaign',
    'lost': 'Low priority - minimal investment'"""

SHARED_SQL["seg"] = f"""
    SELECT customer_id, customer_name, customer_segment, signup_date, recency_score, frequency_score, monetary_score,
           rfm_score, total_revenue, total_orders, avg_order_value, value_tier, customer_status, behavioral_segment,
           coalesce(MAP {{{_ACTIONS}}}[behavioral_segment], 'Analyze and segment further') AS recommended_action,
           coalesce(MAP {{'champions': 1, 'loyal_customers': 1, 'at_risk': 2, 'cant_lose_them': 2,
                         'potential_loyalists': 3, 'hibernating_high_value': 3, 'promising': 4,
                         'new_customers': 4}}[behavioral_segment], 5) AS segment_priority
    FROM (SELECT *, CASE {_SEG_CASE} ELSE 'needs_attention' END AS behavioral_segment FROM clv)"""

# Lower limits than the defaults: the test tables hold no pair with a lift above 1.5.
STRENGTHS = [("very_strong", 1.35, 0.09), ("strong", 1.2, 0.08), ("moderate", 1.1, 0.05), ("weak", 1.05, 0.0)]
PRIORITIES = [(1, 1.2, 25), (2, 1.1, 20), (3, 1.05, 10)]

SHARED_SQL["aff"] = """
    SELECT *, CASE WHEN lift >= 1.35 AND confidence_a_to_b >= 0.09 THEN 'very_strong'
                   WHEN lift >= 1.2 AND confidence_a_to_b >= 0.08 THEN 'strong'
                   WHEN lift >= 1.1 AND confidence_a_to_b >= 0.05 THEN 'moderate'
                   WHEN lift >= 1.05 THEN 'weak' ELSE 'very_weak' END AS affinity_strength,
           CASE WHEN lift >= 1.2 AND times_bought_together >= 25 THEN 1 WHEN lift >= 1.1 AND times_bought_together >= 20 THEN 2
                WHEN lift >= 1.05 AND times_bought_together >= 10 THEN 3 ELSE 4 END AS recommendation_priority
    FROM (SELECT p.*, p.times_bought_together::DOUBLE AS pair_frequency,
                 na.n AS product_a_total_orders, nb.n AS product_b_total_orders,
                 p.times_bought_together::DOUBLE / na.n AS confidence_a_to_b,
                 p.times_bought_together::DOUBLE / nb.n AS confidence_b_to_a,
                 (p.times_bought_together * (SELECT COUNT(DISTINCT order_id) FROM sitem))::DOUBLE / (na.n * nb.n) AS lift,
                 p.times_bought_together::DOUBLE / (SELECT COUNT(DISTINCT order_id) FROM sitem) AS support
          FROM (SELECT x.product_id AS product_a_id, x.product_name AS product_a_name, x.product_category AS product_a_category,
                       y.product_id AS product_b_id, y.product_name AS product_b_name, y.product_category AS product_b_category,
                       COUNT(DISTINCT x.order_id) AS times_bought_together
                FROM sitem x, sitem y WHERE x.order_id = y.order_id AND x.product_name < y.product_name GROUP BY ALL) p
          JOIN (SELECT product_name, COUNT(DISTINCT order_id) AS n FROM sitem GROUP BY 1) na ON na.product_name = p.product_a_name
          JOIN (SELECT product_name, COUNT(DISTINCT order_id) AS n FROM sitem GROUP BY 1) nb ON nb.product_name = p.product_b_name)
    WHERE lift >= 1.0"""

SHARED_SQL["recs"] = """
    SELECT *, CASE affinity_strength
                 WHEN 'very_strong' THEN concat('Customers who bought ', source_product_name, ' almost always buy ', recommended_product_name)
                 WHEN 'strong' THEN concat('Customers who bought ', source_product_name, ' frequently buy ', recommended_product_name)
                 WHEN 'moderate' THEN concat('Customers who bought ', source_product_name, ' often buy ', recommended_product_name)
              END AS recommendation_message,
           source_category IS DISTINCT FROM recommended_category AS is_cross_category,
           CASE WHEN confidence < 0.3 THEN 'low' WHEN confidence < 0.5 THEN 'medium' ELSE 'high' END AS confidence_level
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY source_product_id ORDER BY lift DESC, confidence DESC,
                                       times_bought_together DESC, recommended_product_id) AS recommendation_rank
          FROM (SELECT product_a_id AS source_product_id, product_a_name AS source_product_name,
                       product_a_category AS source_category, product_b_id AS recommended_product_id,
                       product_b_name AS recommended_product_name, product_b_category AS recommended_category,
                       confidence_a_to_b AS confidence, lift, times_bought_together, affinity_strength, recommendation_priority
                FROM aff
                UNION ALL
                SELECT product_b_id, product_b_name, product_b_category, product_a_id, product_a_name, product_a_category,
                       confidence_b_to_a, lift, times_bought_together, affinity_strength, recommendation_priority FROM aff)
          WHERE affinity_strength IN ('very_strong', 'strong', 'moderate'))
    WHERE recommendation_rank <= 10"""


# --- relations shared by other modules ---------------------------------------

def s_customers(t):
    return stg.stg_customers(t.customers, AS_OF)


def s_orders(t):
    return stg.stg_orders(t.orders, t.order_items)


def s_items(t):
    return stg.stg_order_items(t.order_items, t.product_catalog)


def clv(t):
    return op.customer_lifetime_value(s_customers(t), s_orders(t), AS_OF)


def segments(t):
    return op.customer_segmentation(clv(t))


def affinity(t):
    return op.product_affinity(s_items(t), strengths=STRENGTHS, priorities=PRIORITIES)


def recommendations(t):
    return op.product_recommendations(affinity(t))


def customer_orders(t):
    return stg.int_customer_orders(s_customers(t), s_orders(t), AS_OF)


def customer_support(t):
    return stg.int_customer_support(s_customers(t), stg.stg_support_tickets(t.support_tickets))


def product_metrics(t):
    return stg.int_product_metrics(
        stg.stg_products(t.product_catalog, AS_OF), s_items(t), stg.stg_product_reviews(t.product_reviews))


def _text(cols):
    return ", ".join(f"{c}::VARCHAR AS {c}" for c in cols.split())


# --- staging -------------------------------------------------------------------

@query("stg_customers", f"SELECT * REPLACE ({_text('signup_date signup_month signup_year')}) FROM scust")
def _(t):
    return s_customers(t)


@query("stg_orders", f"""SELECT * REPLACE ({_num('total_amount discount_percent shipping_cost calculated_total')},
       {_text('order_date order_date_only order_month order_year')}) FROM sord""")
def _(t):
    return s_orders(t)


@query("stg_order_items", f"SELECT * REPLACE ({_num('unit_price line_total catalog_price price_difference')}) FROM sitem")
def _(t):
    return s_items(t)


@query("stg_products", f"SELECT * REPLACE ({_num('price cost margin')}, {_text('created_date last_updated')}) FROM sprod")
def _(t):
    return stg.stg_products(t.product_catalog, AS_OF)


@query("stg_product_reviews", f"SELECT * REPLACE ({_text('review_date review_month')}) FROM srev")
def _(t):
    return stg.stg_product_reviews(t.product_reviews)


@query("stg_support_tickets", f"SELECT * REPLACE ({_text('ticket_date ticket_month')}) FROM stick")
def _(t):
    return stg.stg_support_tickets(t.support_tickets)


# --- intermediate ------------------------------------------------------------------

@query("int_customer_orders", f"""SELECT * REPLACE (lifetime_revenue::DOUBLE AS lifetime_revenue,
       {_text('signup_date first_order_date last_order_date')}) FROM icord""")
def _(t):
    return customer_orders(t)


@query("int_customer_support", f"SELECT * REPLACE ({_text('first_ticket_date last_ticket_date')}) FROM icsup")
def _(t):
    return customer_support(t)


@query("int_product_metrics", f"SELECT * REPLACE ({_num('base_price total_revenue')}) FROM ipm")
def _(t):
    return product_metrics(t)


# --- marts -----------------------------------------------------------------------

@query("customer_lifetime_value", f"""SELECT * REPLACE (total_revenue::DOUBLE AS total_revenue,
       {_text('signup_date first_order_date last_order_date')}) FROM clv""")
def _(t):
    return clv(t)


@query("customer_segmentation", """SELECT * REPLACE (total_revenue::DOUBLE AS total_revenue,
       signup_date::VARCHAR AS signup_date) FROM seg""")
def _(t):
    return segments(t)


@query("product_pairs", """
    SELECT x.product_id AS product_a_id, x.product_name AS product_a_name, x.product_category AS product_a_category,
           y.product_id AS product_b_id, y.product_name AS product_b_name, y.product_category AS product_b_category,
           COUNT(DISTINCT x.order_id) AS times_bought_together
    FROM item x JOIN item y ON x.order_id = y.order_id AND x.product_name < y.product_name GROUP BY ALL""")
def _(t):
    return op.product_pairs(t.order_items)


@query("frequent_product_pairs", """
    SELECT x.product_id AS product_a_id, x.product_name AS product_a_name, x.product_category AS product_a_category,
           y.product_id AS product_b_id, y.product_name AS product_b_name, y.product_category AS product_b_category,
           COUNT(DISTINCT x.order_id) AS times_bought_together
    FROM item x JOIN item y ON x.order_id = y.order_id AND x.product_name < y.product_name GROUP BY ALL
    HAVING COUNT(DISTINCT x.order_id) >= 2""")
def _(t):
    return op.supported_pairs(t.order_items, 2)


@query("product_affinity_by_support", "SELECT * FROM aff WHERE pair_frequency >= 2")
def _(t):
    return op.product_affinity(s_items(t), support=2, strengths=STRENGTHS, priorities=PRIORITIES)


@query("product_affinity", "SELECT * FROM aff")
def _(t):
    return affinity(t)


@query("product_recommendations", "SELECT * FROM recs")
def _(t):
    return recommendations(t)


@query("product_performance", f"""
    SELECT * EXCLUDE (pr) REPLACE ({_num('base_price total_revenue')}),
           CASE WHEN total_revenue = 0 THEN 'no_sales' WHEN pr < 0.5 THEN 'bottom_50_pct' WHEN pr < 0.75 THEN 'top_50_pct'
                WHEN pr < 0.9 THEN 'top_25_pct' ELSE 'top_10_pct' END AS revenue_tier,
           CASE WHEN avg_rating < 3 THEN 'poor' WHEN avg_rating < 4 THEN 'average' WHEN avg_rating < 4.5 THEN 'good'
                WHEN avg_rating IS NOT NULL THEN 'excellent' ELSE 'no_reviews' END AS rating_tier,
           CASE WHEN stock_quantity >= 50 THEN 'high_stock' WHEN stock_quantity >= 10 THEN 'normal_stock'
                WHEN stock_quantity <> 0 THEN 'low_stock' ELSE 'out_of_stock' END AS inventory_status
    FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY total_revenue DESC, product_id) AS revenue_rank,
                 ROW_NUMBER() OVER (PARTITION BY category ORDER BY total_revenue DESC, product_id) AS category_revenue_rank,
                 ROW_NUMBER() OVER (ORDER BY units_sold DESC, product_id) AS volume_rank,
                 PERCENT_RANK() OVER (ORDER BY total_revenue) AS pr FROM ipm)""")
def _(t):
    # Ranked from a stored copy: the ranks read the metrics more than once.
    metrics = cut_lineage(t.spark, product_metrics(t))
    return op.product_performance(metrics)


@query("monthly_cohorts", """
    WITH act AS (
        SELECT c.customer_id, c.signup_month AS cohort_month, date_diff('month', c.signup_month, o.order_month::DATE) AS months_since_signup,
               COUNT(DISTINCT o.order_date) AS n, SUM(o.total_amount) AS r
        FROM scust c JOIN sord o ON o.customer_id = c.customer_id
        WHERE o.order_status IN ('Completed', 'Shipped') GROUP BY ALL),
    per AS (
        SELECT cohort_month, months_since_signup,
               (SELECT COUNT(*) FROM scust s WHERE s.signup_month = act.cohort_month) AS cohort_size,
               COUNT(DISTINCT customer_id) AS active_customers, SUM(r) AS cohort_revenue, SUM(n)::BIGINT AS total_orders
        FROM act GROUP BY ALL),
    win AS (
        SELECT *, SUM(cohort_revenue) OVER w AS cumulative_revenue, active_customers::DOUBLE / cohort_size AS retention_rate,
               lag(active_customers::DOUBLE / cohort_size) OVER w AS prev
        FROM per WINDOW w AS (PARTITION BY cohort_month ORDER BY months_since_signup))
    SELECT cohort_month::VARCHAR AS cohort_month, months_since_signup, cohort_size, active_customers, retention_rate,
           cohort_revenue::DOUBLE AS cohort_revenue, cohort_revenue::DOUBLE / active_customers AS revenue_per_active_customer,
           cohort_revenue::DOUBLE / cohort_size AS revenue_per_cohort_member, total_orders,
           total_orders::DOUBLE / active_customers AS orders_per_active_customer,
           cumulative_revenue::DOUBLE AS cumulative_revenue, prev - retention_rate AS monthly_churn_rate,
           CASE WHEN retention_rate < 0.1 THEN 'poor' WHEN retention_rate < 0.3 THEN 'at_risk'
                WHEN retention_rate < 0.5 THEN 'moderate' ELSE 'healthy' END AS cohort_health,
           cumulative_revenue::DOUBLE / cohort_size AS estimated_ltv_to_date
    FROM win""")
def _(t):
    return op.monthly_cohorts(s_customers(t), s_orders(t))


@query("support_analytics", f"""
    SELECT *, CASE WHEN customer_health_score < 50 THEN 'critical' WHEN customer_health_score < 80 THEN 'at_risk' ELSE 'healthy' END AS health_status
    FROM (SELECT s.* REPLACE ({_text('first_ticket_date last_ticket_date')}), o.total_orders,
                 o.lifetime_revenue::DOUBLE AS lifetime_revenue, o.avg_order_value,
                 CASE WHEN total_tickets > 0 THEN ((2000 * resolved_tickets + total_tickets) // (2 * total_tickets))::DOUBLE / 10 END AS resolution_rate_pct,
                 CASE WHEN total_tickets > 0 AND lifetime_revenue > 0 THEN
                      (((2 * (lifetime_revenue * 100)::BIGINT + total_tickets) // (2 * total_tickets))::DECIMAL(18,0)
                       * 0.01::DECIMAL(3,2))::DOUBLE END AS revenue_per_ticket,
                 CASE WHEN o.total_orders = 0 THEN 0 ELSE greatest(0, least(100,
                      50 + CASE WHEN lifetime_revenue > 1000 THEN 20 ELSE lifetime_revenue::DOUBLE / 50 END
                      - 5 * total_tickets - 10 * open_tickets
                      + CASE WHEN total_tickets > 0 THEN resolved_tickets::DOUBLE / total_tickets * 20 ELSE 0 END))
                 END::DOUBLE AS customer_health_score
          FROM icsup s JOIN icord o USING (customer_id))""")
def _(t):
    return op.support_analytics(customer_support(t), customer_orders(t))
