"""Serving, report, dashboard and workload queries."""

from pyspark.sql import functions as F

from registry.base import SHARED_SQL, query
from registry.marts import affinity, clv, segments
from tillwise.functions.semantics import rounded_ratio
from tillwise.operators import additive as ad
from tillwise.operators import reports as rp
from tillwise.operators import serving as sv
from tillwise.sources.files import scratch_dir
from tillwise.sources.fixtures import AS_OF

TODAY = f"DATE '{AS_OF}'"
LOG_DAY = "2024-01-31"


def half_up(num, den, digits):
    """Exact half-up quotient of non-negative whole numbers, as double."""
    f = 10 ** digits
    return f"((2 * {f} * ({num}) + ({den})) // (2 * ({den})))::DOUBLE / {f}"


SHARED_SQL["coa"] = """
    SELECT c.customer_id, c.first_name, c.last_name, c.email, c.customer_segment, COUNT(DISTINCT o.order_id) AS total_orders,
           SUM(o.total_amount) AS total_spent, SUM(o.total_amount)::DOUBLE / COUNT(*) AS avg_order_value,
           MIN(o.order_date) AS first_order_date, MAX(o.order_date) AS last_order_date
    FROM cust c JOIN ord o ON c.customer_id = o.customer_id GROUP BY ALL"""


def coa(t):
    return sv.customer_order_analytics(t.customers, t.orders)


def lookup_table(t):
    return sv.order_lookup(t.orders, t.customers)


@query("customer_order_analytics", """SELECT * REPLACE (total_spent::DOUBLE AS total_spent,
       first_order_date::VARCHAR AS first_order_date, last_order_date::VARCHAR AS last_order_date) FROM coa""")
def _(t):
    return coa(t)


@query("order_lookup", """
    SELECT o.order_id, o.customer_id, o.order_date::VARCHAR AS order_date, o.order_status,
           o.total_amount::DOUBLE AS total_amount, c.first_name, c.last_name, c.email
    FROM ord o JOIN cust c USING (customer_id)""")
def _(t):
    return lookup_table(t)


@query("lookup_customer", "SELECT customer_id, first_name, last_name, customer_segment, state FROM cust WHERE customer_id = 42")
def _(t):
    return sv.lookup(t.customers, "customer_id", 42).select(
        "customer_id", "first_name", "last_name", "customer_segment", "state")


@query("lookup_order", """SELECT order_id, customer_id, order_date::VARCHAR AS order_date, order_status,
       total_amount::DOUBLE AS total_amount FROM ord WHERE order_id = '77'""")
def _(t):
    return sv.lookup(lookup_table(t), "order_id", "77").select(
        "order_id", "customer_id", "order_date", "order_status", "total_amount")


@query("lookup_many_customers", """SELECT order_id, customer_id, total_amount::DOUBLE AS total_amount FROM ord
       WHERE customer_id IN (10, 11, 12, 13, 14)""")
def _(t):
    return sv.lookup_many(t.orders, "customer_id", [10, 11, 12, 13, 14]).select("order_id", "customer_id", "total_amount")


@query("lookup_first_customer", """SELECT order_id, customer_id, total_amount::DOUBLE AS total_amount FROM ord
       WHERE customer_id = (SELECT MIN(customer_id) FROM ord)""")
def _(t):
    return sv.lookup_first(t.orders, "customer_id").select("order_id", "customer_id", "total_amount")


@query("recent_relative_to_max", """SELECT order_date::DATE::VARCHAR AS day, COUNT(*) AS order_count FROM ord
       WHERE order_date >= (SELECT MAX(order_date) FROM ord) - INTERVAL 30 DAYS GROUP BY 1""")
def _(t):
    return sv.recent_relative_to_max(t.orders, "order_date", 30).groupBy(
        F.to_date("order_date").alias("day")).agg(F.count("*").alias("order_count"))


for _days in (7, 30, 90):
    @query(f"orders_last_{_days}_days", f"""SELECT COUNT(*) AS order_count, SUM(total_amount)::DOUBLE AS total_revenue
           FROM ord WHERE order_date >= {TODAY} - {_days}""")
    def _(t, days=_days):
        return sv.since(t.orders, "order_date", days, AS_OF).agg(
            F.count("*").alias("order_count"), F.sum("total_amount").alias("total_revenue"))


@query("match_like", "SELECT product_id, product_name FROM cat WHERE product_name LIKE 'red%'")
def _(t):
    return sv.match(t.product_catalog, "product_name", "red%").select("product_id", "product_name")


@query("match_not_like", "SELECT product_id, product_name FROM cat WHERE product_name NOT LIKE '%ring'")
def _(t):
    return sv.match(t.product_catalog, "product_name", "%ring", negate=True).select("product_id", "product_name")


@query("match_ilike", "SELECT doc_id FROM documents WHERE text ILIKE '%THE%'")
def _(t):
    return sv.match(t.documents, "text", "%THE%", ignore_case=True).select("doc_id")


@query("prefiltered_reviews", """SELECT review_id FROM rev WHERE review_text IS NOT NULL AND length(review_text) > 10
       AND rating >= 4 AND lower(review_text) LIKE '%thing%'""")
def _(t):
    cheap = F.col("review_text").isNotNull() & (F.length("review_text") > 10) & (F.col("rating") >= 4)
    return sv.prefiltered(t.product_reviews, cheap,
                          lambda df: df.filter(F.lower("review_text").like("%thing%"))).select("review_id")


@query("recent_orders", """SELECT customer_id, order_id, order_date::VARCHAR AS order_date, order_status,
       total_amount::DOUBLE AS total_amount FROM ord WHERE customer_id = 7 ORDER BY ord.order_date DESC, order_id LIMIT 20""")
def _(t):
    return sv.recent_orders(t.orders, 7, 20)


@query("high_value_recent", f"""SELECT order_id, customer_id, order_date::VARCHAR AS order_date, total_amount::DOUBLE AS total_amount
       FROM ord WHERE total_amount > 500 AND order_date >= {TODAY} - 30 ORDER BY ord.total_amount DESC, order_id LIMIT 10""")
def _(t):
    return sv.high_value_recent(lookup_table(t), 500, 30, AS_OF)


@query("status_last_7_days", f"""SELECT order_status, COUNT(*) AS order_count, SUM(total_amount)::DOUBLE AS total_revenue
       FROM ord WHERE order_date >= {TODAY} - 7 GROUP BY 1""")
def _(t):
    return sv.status_recent(t.orders, 7, AS_OF)


@query("customer_summary", """SELECT c.customer_id, COUNT(o.order_id) AS order_count, SUM(o.total_amount)::DOUBLE AS total_spent
       FROM cust c LEFT JOIN ord o USING (customer_id) WHERE c.customer_id = 5 GROUP BY 1""")
def _(t):
    return sv.customer_summary(t.customers, t.orders, 5)


@query("serving_summary", """SELECT round(SUM(total_orders)::DOUBLE / COUNT(*), 2) AS avg_orders_per_customer,
       SUM(total_spent)::DOUBLE AS total_revenue, COUNT(*) AS total_customers FROM coa""")
def _(t):
    return sv.serving_summary(coa(t))


@query("semi_join", """SELECT customer_id, customer_segment FROM cust
       WHERE customer_id IN (SELECT customer_id FROM ord WHERE order_status = 'Cancelled')""")
def _(t):
    return sv.semi(t.customers, t.orders.filter("order_status = 'Cancelled'"), "customer_id").select(
        "customer_id", "customer_segment")


# --- reviews and tickets -----------------------------------------------------------

@query("rating_breakdown", f"""SELECT rating, COUNT(*) AS count,
       {half_up('100 * COUNT(*) FILTER (verified_purchase)', 'COUNT(*)', 1)} AS verified_pct FROM rev GROUP BY rating""")
def _(t):
    return rp.rating_breakdown(t.product_reviews)


@query("verified_pct", f"""SELECT {half_up('100 * COUNT(*) FILTER (verified_purchase)', 'COUNT(*)', 1)} AS verified_pct FROM rev""")
def _(t):
    return rp.verified_pct(t.product_reviews)


@query("product_ratings", f"""SELECT product_id, COUNT(*) AS review_count,
       {half_up('SUM(rating)', 'COUNT(*)', 2)} AS avg_rating FROM rev GROUP BY 1""")
def _(t):
    return rp.product_ratings(t.product_reviews)


@query("ticket_status", """SELECT status, COUNT(*) AS count, COUNT(*) FILTER (priority IN ('High','Urgent')) AS high_priority
       FROM tick GROUP BY 1""")
def _(t):
    return rp.ticket_status(t.support_tickets)


@query("ticket_breakdown", """SELECT category, priority, COUNT(*) AS ticket_count,
       coalesce(list_position(['Urgent','High','Medium'], priority), 4) AS priority_rank FROM tick GROUP BY 1, 2""")
def _(t):
    return rp.order_by_ladder(rp.ticket_breakdown(t.support_tickets), [F.asc("category")], "priority", rp.URGENCY)


@query("daily_reviews", f"""SELECT review_date::VARCHAR AS day, COUNT(*) AS rows, {half_up('SUM(rating)', 'COUNT(*)', 2)} AS avg_rating
       FROM rev GROUP BY review_date ORDER BY review_date DESC LIMIT 14""")
def _(t):
    return rp.daily_counts(t.product_reviews, "review_date", 14,
                           avg_rating=rounded_ratio(F.sum("rating"), F.count("rating"), 2))


@query("daily_tickets", """SELECT ticket_date::DATE::VARCHAR AS day, COUNT(*) AS rows FROM tick
       GROUP BY ticket_date::DATE ORDER BY ticket_date::DATE DESC LIMIT 14""")
def _(t):
    return rp.daily_counts(t.support_tickets, "ticket_date", 14)


@query("review_preview", """SELECT review_id, rating, substring(review_text, 1, 100) || '...' AS preview FROM rev WHERE rating >= 4""")
def _(t):
    return rp.review_preview(t.product_reviews, 100, 4)


@query("recent_reviews", """SELECT review_id, review_date::VARCHAR AS review_date, rating, review_title,
       ['Negative','Negative','Neutral','Positive','Positive'][rating] AS sentiment
       FROM rev ORDER BY rev.review_date DESC, review_id LIMIT 10""")
def _(t):
    return rp.recent_reviews(t.product_reviews)


@query("low_ratings", """SELECT review_id, product_id, customer_id, rating, review_title, review_date::VARCHAR AS review_date
       FROM rev WHERE rating <= 2 ORDER BY rev.review_date DESC, review_id LIMIT 10""")
def _(t):
    return rp.low_ratings(t.product_reviews)


@query("open_high_priority", """SELECT ticket_id, category, priority, subject, ticket_date::VARCHAR AS ticket_date
       FROM tick WHERE status = 'Open' AND priority IN ('High','Urgent') ORDER BY tick.ticket_date DESC, ticket_id LIMIT 10""")
def _(t):
    return rp.open_high_priority(t.support_tickets)


@query("unhappy_customers", """SELECT r.customer_id, COUNT(DISTINCT r.review_id) AS negative_reviews,
       COUNT(DISTINCT s.ticket_id) AS support_tickets FROM rev r JOIN tick s ON r.customer_id = s.customer_id
       WHERE r.rating <= 2 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def _(t):
    return rp.unhappy_customers(t.product_reviews, t.support_tickets)


# --- orders and dashboards ---------------------------------------------------------

@query("headline_kpis", """SELECT (SELECT COUNT(*) FROM ord) AS total_orders, (SELECT SUM(total_amount)::DOUBLE FROM ord) AS total_revenue,
       (SELECT COUNT(*) FROM item) AS total_items, (SELECT COUNT(DISTINCT product_id) FROM item) AS total_products,
       (SELECT COUNT(*) FROM cust) AS total_customers""")
def _(t):
    return rp.headline_kpis(t.customers, t.orders, t.order_items)


@query("orders_by_status", "SELECT order_status, COUNT(*) AS order_count FROM ord GROUP BY 1")
def _(t):
    return rp.orders_by_status(t.orders)


@query("revenue_by_category", "SELECT product_category, SUM(line_total)::DOUBLE AS total_revenue FROM item GROUP BY 1")
def _(t):
    return rp.revenue_by_category(t.order_items)


@query("revenue_by_size_and_category", """
    SELECT ['Small (<$100)', 'Medium ($100-$500)', 'Large ($500-$2K)', 'Extra Large (>$2K)'][size_rank] AS order_size,
           product_category, revenue, size_rank
    FROM (SELECT 1 + (total_amount >= 100)::INT + (total_amount >= 500)::INT + (total_amount >= 2000)::INT AS size_rank,
                 product_category, SUM(line_total)::DOUBLE AS revenue FROM ord JOIN item USING (order_id) GROUP BY 1, 2)""")
def _(t):
    return rp.revenue_by_size_and_category(t.orders, t.order_items)


@query("order_trend_daily", "SELECT date_trunc('day', order_date)::TIMESTAMP::VARCHAR AS day, COUNT(*) AS order_count FROM ord GROUP BY 1")
def _(t):
    return rp.order_trend(t.orders, "day")


@query("event_trend_hourly", "SELECT date_trunc('hour', ts)::TIMESTAMP::VARCHAR AS hour, COUNT(*) AS order_count FROM events GROUP BY 1")
def _(t):
    return rp.order_trend(t.raw("events").withColumnRenamed("ts", "order_date"), "hour")


@query("recent_volume", f"""SELECT COUNT(DISTINCT o.order_id) AS total_orders, COUNT(i.order_id) AS total_items
       FROM ord o LEFT JOIN item i ON i.order_id = o.order_id WHERE o.order_date >= {TODAY} - 30""")
def _(t):
    return rp.recent_volume(t.orders, t.order_items, 30, AS_OF)


@query("segment_state_customers", "SELECT customer_segment, state, COUNT(*) AS customer_count FROM cust GROUP BY 1, 2")
def _(t):
    return rp.segment_state_customers(t.customers)


@query("state_revenue", """SELECT c.state, COUNT(DISTINCT c.customer_id) AS customer_count, COUNT(DISTINCT o.order_id) AS order_count,
       SUM(o.total_amount)::DOUBLE AS total_revenue FROM cust c LEFT JOIN ord o USING (customer_id) GROUP BY 1""")
def _(t):
    return rp.state_revenue(t.customers, t.orders)


@query("state_tickets", """SELECT c.state, COUNT(DISTINCT s.ticket_id) AS ticket_count,
       COUNT(DISTINCT s.ticket_id) FILTER (s.status = 'Open') AS open_tickets,
       COUNT(DISTINCT s.ticket_id) FILTER (s.priority = 'High') AS high_priority
       FROM cust c LEFT JOIN tick s USING (customer_id) GROUP BY 1""")
def _(t):
    return rp.state_tickets(t.customers, t.support_tickets)


@query("segment_revenue_having", """SELECT customer_segment, SUM(total_amount)::DOUBLE AS segment_revenue, COUNT(DISTINCT order_id) AS total_orders
       FROM ord JOIN cust USING (customer_id) WHERE order_status = 'Completed' GROUP BY 1 HAVING SUM(total_amount) > 10000""")
def _(t):
    return rp.segment_revenue(t.orders, t.customers)


@query("revenue_by_month_and_segment", """SELECT year(order_date) AS order_year, month(order_date) AS order_month, customer_segment,
       SUM(total_amount)::DOUBLE AS total_revenue, COUNT(DISTINCT order_id) AS order_count,
       SUM(total_amount)::DOUBLE / COUNT(*) AS avg_order_value FROM ord JOIN cust USING (customer_id) GROUP BY 1, 2, 3""")
def _(t):
    return rp.revenue_by_month_and_segment(t.orders, t.customers)


# --- marts --------------------------------------------------------------------------

_RFM = "SUM(recency_score + frequency_score + monetary_score)::DOUBLE / (3 * COUNT(*)) AS avg_rfm_score"


@query("clv_summary", f"""SELECT value_tier, customer_status, COUNT(*) AS customer_count,
       SUM(total_revenue)::DOUBLE / COUNT(*) AS avg_revenue, SUM(total_orders)::DOUBLE / COUNT(*) AS avg_orders, {_RFM},
       SUM(total_revenue)::DOUBLE AS total_revenue_sum FROM clv GROUP BY 1, 2""")
def _(t):
    return rp.clv_summary(clv(t))


@query("segment_summary", f"""SELECT behavioral_segment, recommended_action, segment_priority, COUNT(*) AS num_customers,
       SUM(total_revenue)::DOUBLE AS segment_revenue, {_RFM} FROM seg GROUP BY 1, 2, 3""")
def _(t):
    return rp.segment_summary(segments(t))


@query("top_customers", """SELECT customer_id, customer_name, total_revenue::DOUBLE AS total_revenue, total_orders, rfm_score,
       value_tier, customer_status, days_since_last_order FROM clv ORDER BY clv.total_revenue DESC, customer_id LIMIT 20""")
def _(t):
    return rp.top_customers(clv(t))


@query("top_pairs", """SELECT product_a_name, product_a_category, product_b_name, product_b_category, times_bought_together, lift,
       confidence_a_to_b, affinity_strength, recommendation_priority FROM aff
       ORDER BY lift DESC, times_bought_together DESC, product_a_name, product_b_name LIMIT 100""")
def _(t):
    return rp.top_pairs(affinity(t))


@query("strength_histogram", "SELECT affinity_strength, COUNT(*) AS pairs FROM aff GROUP BY 1")
def _(t):
    return rp.strength_histogram(affinity(t))


# --- counts ------------------------------------------------------------------------------

@query("layer_counts", """SELECT 'customers' AS table_name, COUNT(*) AS row_count FROM cust UNION ALL SELECT 'orders', COUNT(*) FROM ord
       UNION ALL SELECT 'order_items', COUNT(*) FROM item UNION ALL SELECT 'product_catalog', COUNT(*) FROM cat
       UNION ALL SELECT 'product_reviews', COUNT(*) FROM rev UNION ALL SELECT 'support_tickets', COUNT(*) FROM tick""")
def _(t):
    return rp.layer_counts(t.all())


@query("layer_max", """SELECT 'orders' AS layer, MAX(order_date)::VARCHAR AS newest FROM ord
       UNION ALL SELECT 'order_lookup', MAX(order_date)::VARCHAR FROM ord JOIN cust USING (customer_id)
       UNION ALL SELECT 'support_tickets', MAX(ticket_date)::VARCHAR FROM tick""")
def _(t):
    return rp.layer_max({"orders": (t.orders, "order_date"), "order_lookup": (lookup_table(t), "order_date"),
                         "support_tickets": (t.support_tickets, "ticket_date")})


@query("propagation_report", """SELECT 'orders' AS table_name, COUNT(*) FILTER (order_date < DATE '2001-07-01') AS rows_before,
       COUNT(*) AS rows_after, COUNT(*) FILTER (order_date >= DATE '2001-07-01') AS rows_added FROM ord
       UNION ALL SELECT 'order_items', COUNT(*), COUNT(*), 0 FROM item""")
def _(t):
    before = rp.layer_counts({"orders": t.orders.filter("order_date < DATE '2001-07-01'"), "order_items": t.order_items})
    after = rp.layer_counts({"orders": t.orders, "order_items": t.order_items})
    return rp.propagation_report(before, after)


@query("duplicate_count", "SELECT COUNT(*) - COUNT(DISTINCT order_item_id) AS duplicate_count FROM item_stage")
def _(t):
    return rp.duplicate_count(t.order_items_staging, "order_item_id")


@query("class_balance", """SELECT quality, COUNT(*) AS rows, COUNT(*)::DOUBLE / (SELECT COUNT(*) FROM labels) AS share
       FROM labels GROUP BY quality""")
def _(t):
    return rp.class_balance(t.raw("labels"), "quality")


@query("score_summary", """SELECT lang AS metric, SUM(n_chars)::DOUBLE / COUNT(*) AS avg_score, MIN(n_chars) AS min_score,
       MAX(n_chars) AS max_score, COUNT(n_chars) AS evaluations FROM documents GROUP BY 1""")
def _(t):
    return rp.score_summary(t.documents, "lang", "n_chars").withColumnRenamed("lang", "metric")


# --- workload log ---------------------------------------------------------------------------

@query("daily_performance_summary", f"""
    SELECT date_trunc('day', start_time)::TIMESTAMP::VARCHAR AS report_date, source, COUNT(*) AS total_queries,
           COUNT(*) FILTER (execution_status = 'SUCCESS') AS successful_queries,
           COUNT(*) FILTER (execution_status = 'FAIL') AS failed_queries,
           SUM(execution_time)::DOUBLE / COUNT(*) / 1000 AS avg_execution_seconds,
           round(quantile_cont(execution_time::DOUBLE, 0.95) / 1000, 9) AS p95_execution_seconds
    FROM qlog WHERE start_time >= DATE '{LOG_DAY}' - 30 GROUP BY 1, 2""")
def _(t):
    return rp.daily_performance_summary(t.query_log, LOG_DAY)


@query("monthly_quantiles_from_days", """
    SELECT date_trunc('month', start_time)::DATE::VARCHAR AS month, source, COUNT(*) AS n, true AS p50_within, true AS p95_within
    FROM qlog GROUP BY 1, 2""")
def _(t):
    """Quantiles of months from stored daily sketches; their exact ranks among the raw rows are within the stated error."""
    log = t.query_log.select("source", F.col("execution_time").cast("double").alias("ms"), F.to_date("start_time").alias("day"))
    path = scratch_dir(t.spark, "sketches")
    ad.quantile_sketches(log, F.col("day"), "ms", ["source"]).write.mode("overwrite").parquet(path)
    found = ad.quantiles_over(t.spark.read.parquet(path), F.trunc("day", "month"), [0.5, 0.95], "month", ["source"])
    rows = log.withColumn("month", F.trunc("day", "month")).join(found, ["month", "source"])

    def within(q, r):
        below, upto = F.count_if(F.col("ms") < F.col(q)), F.count_if(F.col("ms") <= F.col(q))
        n = F.count("*")
        return ((below <= (r + ad.RANK_ERROR) * n) & (upto >= (r - ad.RANK_ERROR) * n))

    return rows.groupBy("month", "source", "n").agg(within("q50", 0.5).alias("p50_within"), within("q95", 0.95).alias("p95_within"))


@query("hourly_profile", """SELECT date_trunc('hour', start_time)::TIMESTAMP::VARCHAR AS hour, source, COUNT(*) AS query_count,
       SUM(execution_time)::DOUBLE / COUNT(*) / 1000 AS avg_execution_seconds, MAX(execution_time)::DOUBLE AS peak_ms
       FROM qlog GROUP BY 1, 2""")
def _(t):
    return rp.hourly_profile(t.query_log)


@query("slowest_queries", f"""SELECT query_id, source, execution_time::DOUBLE AS execution_time, partitions_scanned, partitions_total,
       partitions_scanned::DOUBLE AS partition_scan_pct FROM qlog
       WHERE start_time >= DATE '{LOG_DAY}' - 1 AND execution_status = 'SUCCESS' ORDER BY qlog.execution_time DESC, query_id LIMIT 10""")
def _(t):
    return rp.slowest(t.query_log, 10, LOG_DAY)


@query("clustering_candidates", f"""SELECT query_id, partitions_scanned, partitions_total, execution_time::DOUBLE AS execution_time,
       partitions_scanned::DOUBLE AS scan_efficiency_pct FROM qlog WHERE start_time >= DATE '{LOG_DAY}' - 7
       AND partitions_total > 50 AND partitions_scanned > 50 AND execution_time > 20 ORDER BY partitions_scanned DESC, query_id LIMIT 20""")
def _(t):
    return rp.clustering_candidates(t.query_log, 20, LOG_DAY, min_partitions=50, min_time=20)


@query("wait_summary", f"""SELECT source, COUNT(*) AS queued_query_count, SUM(queued_time)::DOUBLE / COUNT(*) / 1000 AS avg_queue_seconds,
       MAX(queued_time)::DOUBLE / 1000 AS max_queue_seconds FROM qlog WHERE start_time >= DATE '{LOG_DAY}' - 7 AND queued_time > 0 GROUP BY 1""")
def _(t):
    return rp.wait_summary(t.query_log, LOG_DAY)


@query("latency_summary", """
    SELECT source, vs[1] AS min_ms, total::DOUBLE / n AS avg_ms, vs[n] AS max_ms, vs[(n // 2) + 1] AS median_ms,
           vs[floor(n::DOUBLE * 0.95)::INT + 1] AS p95_ms, vs[floor(n::DOUBLE * 0.99)::INT + 1] AS p99_ms
    FROM (SELECT source, list_sort(list(execution_time::DOUBLE)) AS vs, COUNT(*) AS n, SUM(execution_time) AS total
          FROM qlog GROUP BY 1)""")
def _(t):
    return rp.latency_summary(t.query_log)


@query("refresh_stats", """SELECT event_type AS name, CASE WHEN value >= 5 THEN 'FULL' ELSE 'INCREMENTAL' END AS refresh_action,
       COUNT(*) AS refreshes, SUM(event_id % 60)::DOUBLE / COUNT(*) AS avg_seconds, SUM(event_id % 11)::BIGINT AS rows_inserted,
       SUM(event_id % 5)::BIGINT AS rows_deleted FROM events GROUP BY 1, 2""")
def _(t):
    """Events read as a refresh log."""
    e = F.col("event_id")
    start = F.date_trunc("second", F.col("ts").cast("timestamp"))
    return rp.refresh_stats(t.raw("events").select(
        F.col("event_type").alias("name"), F.when(F.col("value") >= 5, "FULL").otherwise("INCREMENTAL").alias("refresh_action"),
        start.alias("refresh_start_time"), (start + F.make_interval(secs=e % 60)).alias("refresh_end_time"),
        (e % 11).alias("inserted"), (e % 5).alias("deleted")))
