"""Reports over orders, reviews, tickets, marts and workload logs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.functions.ranking import exact_quantiles
from tillwise.functions.semantics import (
    distinct_if, ladder, mean, rank_of, ratio, rounded_ratio)
from tillwise.operators.enrich import SIZE_CLASSES
from tillwise.operators.serving import since, top

# Labels of order sizes on dashboards, ticket priorities by urgency.
SIZE_LABELS = ["Small (<$100)", "Medium ($100-$500)", "Large ($500-$2K)", "Extra Large (>$2K)"]
URGENCY = ["Urgent", "High", "Medium"]


# --- reviews and tickets -----------------------------------------------------------

def rating_breakdown(reviews: DataFrame) -> DataFrame:
    """Reviews and share of verified purchases per rating."""
    return reviews.groupBy("rating").agg(
        F.count("*").alias("count"),
        rounded_ratio(F.count_if("verified_purchase") * 100, F.count("*"), 1).alias("verified_pct"))


def verified_pct(reviews: DataFrame) -> DataFrame:
    return reviews.agg(
        rounded_ratio(F.count_if("verified_purchase") * 100, F.count("*"), 1).alias("verified_pct"))


def product_ratings(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("product_id").agg(
        F.count("*").alias("review_count"),
        rounded_ratio(F.sum("rating"), F.count("rating"), 2).alias("avg_rating"))


def ticket_status(tickets: DataFrame) -> DataFrame:
    """Tickets and urgent ones per status."""
    return tickets.groupBy("status").agg(
        F.count("*").alias("count"),
        F.count_if(F.col("priority").isin("High", "Urgent")).alias("high_priority"))


def ticket_breakdown(tickets: DataFrame) -> DataFrame:
    """Tickets per category and priority, with the urgency rank used for sorting."""
    return tickets.groupBy("category", "priority").agg(F.count("*").alias("ticket_count")).withColumn(
        "priority_rank", rank_of("priority", URGENCY))


def order_by_ladder(df: DataFrame, lead: Sequence[Column], column: str, labels: Sequence[str]) -> DataFrame:
    """Sort by columns, then by the position of a label in a fixed list."""
    return df.orderBy(*lead, rank_of(column, labels))


def daily_counts(df: DataFrame, ts: str, n: int = 14, **aggs: Column) -> DataFrame:
    """Rows (and further aggregates) per day, latest ``n`` days that have rows."""
    per_day = df.groupBy(F.to_date(ts).alias("day")).agg(
        F.count("*").alias("rows"), *[a.alias(k) for k, a in aggs.items()])
    return top(per_day, [F.desc("day")], n)


def review_preview(reviews: DataFrame, n: int = 100, min_rating: int = 1) -> DataFrame:
    """Start of each review for display."""
    return reviews.filter(F.col("rating") >= min_rating).select(
        "review_id", "rating", F.concat(F.substring("review_text", 1, n), F.lit("...")).alias("preview"))


def recent_reviews(reviews: DataFrame, n: int = 10) -> DataFrame:
    sentiment = ladder([(F.col("rating") >= 4, "Positive"), (F.col("rating") == 3, "Neutral")], "Negative")
    return top(reviews.select("review_id", "review_date", "rating", "review_title", sentiment.alias("sentiment")),
               [F.desc("review_date"), F.asc("review_id")], n)


def low_ratings(reviews: DataFrame, max_rating: int = 2, n: int = 10) -> DataFrame:
    return top(reviews.filter(F.col("rating") <= max_rating).select(
        "review_id", "product_id", "customer_id", "rating", "review_title", "review_date"),
        [F.desc("review_date"), F.asc("review_id")], n)


def open_high_priority(tickets: DataFrame, n: int = 10) -> DataFrame:
    return top(tickets.filter((F.col("status") == "Open") & F.col("priority").isin("High", "Urgent")).select(
        "ticket_id", "category", "priority", "subject", "ticket_date"),
        [F.desc("ticket_date"), F.asc("ticket_id")], n)


def unhappy_customers(reviews: DataFrame, tickets: DataFrame, n: int = 10, max_rating: int = 2) -> DataFrame:
    """Customers with low ratings and tickets; both sides are counted before they meet."""
    bad = reviews.filter(F.col("rating") <= max_rating).groupBy("customer_id").agg(
        F.count_distinct("review_id").alias("negative_reviews"))
    asked = tickets.groupBy("customer_id").agg(F.count_distinct("ticket_id").alias("support_tickets"))
    return top(bad.join(asked, "customer_id"), [F.desc("negative_reviews"), F.asc("customer_id")], n)


# --- orders and dashboards ---------------------------------------------------------

def headline_kpis(customers: DataFrame, orders: DataFrame, items: DataFrame) -> DataFrame:
    """One row of totals; every total is a scalar subquery of one plan."""
    return orders.agg(F.count("*").alias("total_orders"), F.round(F.sum("total_amount"), 2).alias("total_revenue")) \
        .withColumns({
            "total_items": items.agg(F.count("*")).scalar(),
            "total_products": items.agg(F.count_distinct("product_id")).scalar(),
            "total_customers": customers.agg(F.count("*")).scalar(),
        })


def orders_by_status(orders: DataFrame) -> DataFrame:
    return orders.groupBy("order_status").agg(F.count("*").alias("order_count"))


def revenue_by_category(items: DataFrame) -> DataFrame:
    return items.groupBy("product_category").agg(F.sum("line_total").alias("total_revenue"))


def revenue_by_size_and_category(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Item revenue per order size and category, with the size rank for sorting."""
    amount = F.col("total_amount")
    size = ladder([(amount < F.lit(limit), label) for (limit, _), label in zip(SIZE_CLASSES, SIZE_LABELS)],
                  SIZE_LABELS[-1])
    per_line = items.groupBy("order_id", "product_category").agg(F.sum("line_total").alias("line_total"))
    return orders.select("order_id", size.alias("order_size")).join(per_line, "order_id").groupBy(
        "order_size", "product_category").agg(F.sum("line_total").alias("revenue")).withColumn(
        "size_rank", rank_of("order_size", SIZE_LABELS))


def order_trend(orders: DataFrame, unit: str = "day") -> DataFrame:
    """Orders per hour or day."""
    return orders.groupBy(F.date_trunc(unit, "order_date").alias(unit)).agg(F.count("*").alias("order_count"))


def recent_volume(orders: DataFrame, items: DataFrame, days: int, as_of: date | str) -> DataFrame:
    """Orders of the last days and the items that belong to them."""
    fresh = since(orders, "order_date", days, as_of).select("order_id")
    per_order = items.groupBy("order_id").agg(F.count("*").alias("n"))
    return fresh.join(per_order, "order_id", "left").agg(
        F.count("*").alias("total_orders"), F.coalesce(F.sum("n"), F.lit(0)).alias("total_items"))


def segment_state_customers(customers: DataFrame) -> DataFrame:
    return customers.groupBy("customer_segment", "state").agg(F.count("*").alias("customer_count"))


def state_revenue(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers, orders and revenue per state; orders are summed per customer first."""
    spent = orders.groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("n"), F.sum("total_amount").alias("amount"))
    return customers.select("customer_id", "state").join(spent, "customer_id", "left").groupBy("state").agg(
        F.count_distinct("customer_id").alias("customer_count"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("order_count"),
        F.round(F.sum("amount"), 2).alias("total_revenue"))


def state_tickets(customers: DataFrame, tickets: DataFrame) -> DataFrame:
    """Tickets, open and high-priority ones per state."""
    asked = tickets.groupBy("customer_id").agg(
        F.count_distinct("ticket_id").alias("n"),
        distinct_if(F.col("status") == "Open", "ticket_id").alias("o"),
        distinct_if(F.col("priority") == "High", "ticket_id").alias("h"))
    return customers.select("customer_id", "state").join(asked, "customer_id", "left").groupBy("state").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("ticket_count"),
        F.coalesce(F.sum("o"), F.lit(0)).alias("open_tickets"),
        F.coalesce(F.sum("h"), F.lit(0)).alias("high_priority"))


def segment_revenue(orders: DataFrame, customers: DataFrame, min_revenue: float = 10000,
                    status: str = "completed") -> DataFrame:
    """Revenue per segment for one status, kept where it exceeds a minimum."""
    per_customer = orders.filter(F.lower("order_status") == status.lower()).groupBy("customer_id").agg(
        F.sum("total_amount").alias("amount"), F.count_distinct("order_id").alias("n"))
    return per_customer.join(customers.select("customer_id", "customer_segment"), "customer_id").groupBy(
        "customer_segment").agg(F.sum("amount").alias("segment_revenue"), F.sum("n").alias("total_orders")).filter(
        F.col("segment_revenue") > F.lit(min_revenue))


def revenue_by_month_and_segment(orders: DataFrame, customers: DataFrame, year: int | None = None) -> DataFrame:
    """Revenue, orders and order value by year, month and segment."""
    picked = orders.withColumns({"order_year": F.year("order_date"), "order_month": F.month("order_date")})
    if year is not None:
        picked = picked.filter(F.col("order_year") == year)
    per_customer = picked.groupBy("customer_id", "order_year", "order_month").agg(
        F.sum("total_amount").alias("amount"), F.count("total_amount").alias("n"),
        F.count_distinct("order_id").alias("orders"))
    return per_customer.join(customers.select("customer_id", "customer_segment"), "customer_id").groupBy(
        "order_year", "order_month", "customer_segment").agg(
        F.sum("amount").alias("total_revenue"), F.sum("orders").alias("order_count"),
        ratio(F.sum("amount"), F.sum("n")).alias("avg_order_value"))


# --- marts ---------------------------------------------------------------------------

def clv_summary(clv: DataFrame, by: Sequence[str] = ("value_tier", "customer_status")) -> DataFrame:
    score = F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score")
    return clv.groupBy(*by).agg(
        F.count("customer_id").alias("customer_count"),
        mean("total_revenue").alias("avg_revenue"),
        mean("total_orders").alias("avg_orders"),
        ratio(F.sum(score), F.count(score) * 3).alias("avg_rfm_score"),
        F.sum("total_revenue").alias("total_revenue_sum"))


def segment_summary(segments: DataFrame) -> DataFrame:
    score = F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score")
    return segments.groupBy("behavioral_segment", "recommended_action", "segment_priority").agg(
        F.count("customer_id").alias("num_customers"),
        F.sum("total_revenue").alias("segment_revenue"),
        ratio(F.sum(score), F.count(score) * 3).alias("avg_rfm_score"))


def top_customers(clv: DataFrame, n: int = 20) -> DataFrame:
    return top(clv.select("customer_id", "customer_name", "total_revenue", "total_orders", "rfm_score",
                          "value_tier", "customer_status", "days_since_last_order"),
               [F.desc_nulls_first("total_revenue"), F.asc("customer_id")], n)


def top_pairs(affinity: DataFrame, n: int = 100) -> DataFrame:
    return top(affinity.select(
        "product_a_name", "product_a_category", "product_b_name", "product_b_category",
        "times_bought_together", "lift", "confidence_a_to_b", "affinity_strength", "recommendation_priority"),
        [F.desc("lift"), F.desc("times_bought_together"), F.asc("product_a_name"), F.asc("product_b_name")], n)


def strength_histogram(affinity: DataFrame) -> DataFrame:
    return affinity.groupBy("affinity_strength").agg(F.count("*").alias("pairs"))


def recommendation_counts(recommendations: DataFrame, n: int = 15) -> DataFrame:
    """How often each product is recommended, and its average score."""
    per_product = recommendations.groupBy("product_id", "product_name", "product_category").agg(
        F.count("customer_id").alias("recommendation_count"),
        mean(F.col("recommendation_score").cast("decimal(18,2)")).alias("avg_score"))
    return top(per_product, [F.desc("recommendation_count"), F.asc("product_id")], n)


# --- counts and profiles ---------------------------------------------------------------

def layer_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per named table, as one plan."""
    counts = [df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
              for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def layer_max(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Newest value of one column per layer."""
    newest = [df.agg(F.max(column).cast("string").alias("newest")).select(F.lit(name).alias("layer"), "newest")
              for name, (df, column) in tables.items()]
    return reduce(DataFrame.unionByName, newest)


def propagation_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Row counts before and after a refresh."""
    b = before.select("table_name", F.col("row_count").alias("rows_before"))
    a = after.select("table_name", F.col("row_count").alias("rows_after"))
    return b.join(a, "table_name", "full_outer").withColumn(
        "rows_added", F.coalesce("rows_after", F.lit(0)) - F.coalesce("rows_before", F.lit(0)))


def duplicate_count(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first of each key: per-key counts, then one sum."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_count"))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Rows per class and their share of all rows."""
    total = df.agg(F.count("*")).scalar()
    return df.groupBy(label).agg(F.count("*").alias("rows")).withColumn("share", ratio(F.col("rows"), total))


def score_summary(scores: DataFrame, by: str = "metric", value: str = "score") -> DataFrame:
    return scores.groupBy(by).agg(
        mean(value).alias("avg_score"), F.min(value).alias("min_score"), F.max(value).alias("max_score"),
        F.count(value).alias("evaluations"))


# --- workload logs ---------------------------------------------------------------------

def daily_performance_summary(log: DataFrame, as_of: date | str, days: int = 30) -> DataFrame:
    """Queries, failures, mean and exact 95th percentile per day and source."""
    keys = ["report_date", "source"]
    recent = since(log, "start_time", days, as_of).withColumn("report_date", F.date_trunc("day", "start_time"))
    counts = recent.groupBy(*keys).agg(
        F.count("*").alias("total_queries"),
        F.count_if(F.col("execution_status") == "SUCCESS").alias("successful_queries"),
        F.count_if(F.col("execution_status") == "FAIL").alias("failed_queries"),
        (mean("execution_time") / F.lit(1000)).alias("avg_execution_seconds"))
    p95 = exact_quantiles(recent, keys, "execution_time", {"p95_ms": 0.95})
    return counts.join(p95, keys, "left").withColumn(
        "p95_execution_seconds", F.round(F.col("p95_ms") / F.lit(1000), 9)).drop("p95_ms")


def hourly_profile(log: DataFrame) -> DataFrame:
    return log.groupBy(F.date_trunc("hour", "start_time").alias("hour"), "source").agg(
        F.count("*").alias("query_count"),
        (mean("execution_time") / F.lit(1000)).alias("avg_execution_seconds"),
        F.max("execution_time").alias("peak_ms"))


def slowest(log: DataFrame, n: int, as_of: date | str, days: int = 1) -> DataFrame:
    """Slowest successful queries of the last days, with the share of partitions read."""
    return top(since(log, "start_time", days, as_of).filter(F.col("execution_status") == "SUCCESS").select(
        "query_id", "source", "execution_time", "partitions_scanned", "partitions_total",
        rounded_ratio(F.col("partitions_scanned") * 100, F.col("partitions_total"), 2).alias("partition_scan_pct")),
        [F.desc("execution_time"), F.asc("query_id")], n)


def clustering_candidates(log: DataFrame, n: int, as_of: date | str, days: int = 7, min_partitions: int = 100,
                          min_share: float = 0.5, min_time: float = 10000) -> DataFrame:
    """Slow queries that read most of the partitions of a large table."""
    share = ratio("partitions_scanned", "partitions_total")
    return top(since(log, "start_time", days, as_of).filter(
        (F.col("partitions_total") > min_partitions) & (share > min_share) & (F.col("execution_time") > min_time))
        .select("query_id", "partitions_scanned", "partitions_total", "execution_time",
                rounded_ratio(F.col("partitions_scanned") * 100, F.col("partitions_total"), 2)
                .alias("scan_efficiency_pct")),
        [F.desc("partitions_scanned"), F.asc("query_id")], n)


def wait_summary(log: DataFrame, as_of: date | str, days: int = 7) -> DataFrame:
    """Queries that had to wait, per source."""
    return since(log, "start_time", days, as_of).filter(F.col("queued_time") > 0).groupBy("source").agg(
        F.count("*").alias("queued_query_count"),
        (mean("queued_time") / F.lit(1000)).alias("avg_queue_seconds"),
        (F.max("queued_time").cast("double") / F.lit(1000)).alias("max_queue_seconds"))


def latency_summary(log: DataFrame, by: Sequence[str] = ("source",)) -> DataFrame:
    """Minimum, mean, median, p95, p99 and maximum; quantiles are values at floor(n * p)."""
    keys = list(by)
    quantiles = exact_quantiles(
        log, keys, "execution_time", {"median_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99}, method="lower_index")
    return log.groupBy(*keys).agg(
        F.min("execution_time").alias("min_ms"), mean("execution_time").alias("avg_ms"),
        F.max("execution_time").alias("max_ms")).join(quantiles, keys)


def refresh_stats(log: DataFrame) -> DataFrame:
    """Refreshes, mean duration and changed rows per table and action."""
    seconds = F.unix_timestamp("refresh_end_time") - F.unix_timestamp("refresh_start_time")
    return log.groupBy("name", "refresh_action").agg(
        F.count("*").alias("refreshes"), mean(seconds).alias("avg_seconds"),
        F.sum("inserted").alias("rows_inserted"), F.sum("deleted").alias("rows_deleted"))
