"""Keyed serving tables and the lookups, recency filters and top-k reads on them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.functions.semantics import days_before, mean


def customer_order_analytics(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Order totals per customer with at least one order."""
    # One row per (customer, order) first, so a repeated order id counts once
    # and a customer with very many orders is combined before the shuffle.
    per_order = orders.groupBy("customer_id", "order_id").agg(
        F.sum("total_amount").alias("amount"), F.count("total_amount").alias("n"),
        F.min("order_date").alias("first"), F.max("order_date").alias("last"))
    spent = per_order.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("amount").alias("total_spent"),
        F.try_divide(F.sum("amount").cast("double"), F.sum("n").cast("double")).alias("avg_order_value"),
        F.min("first").alias("first_order_date"),
        F.max("last").alias("last_order_date"))
    return customers.select("customer_id", "first_name", "last_name", "email", "customer_segment").join(
        spent, "customer_id")


def order_lookup(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with the name and mail of their customer."""
    return orders.select("order_id", "customer_id", "order_date", "order_status", "total_amount").join(
        customers.select("customer_id", "first_name", "last_name", "email"), "customer_id")


def lookup(df: DataFrame, key: str, value) -> DataFrame:
    """Point lookup; on a table sorted by ``key`` the scan skips row groups."""
    return df.filter(F.col(key) == F.lit(value))


def lookup_many(df: DataFrame, key: str, values: Sequence) -> DataFrame:
    return df.filter(F.col(key).isin(*values))


def lookup_first(df: DataFrame, key: str) -> DataFrame:
    """All rows of the smallest key, found by a scalar subquery."""
    return df.filter(F.col(key) == df.agg(F.min(key)).scalar())


def since(df: DataFrame, ts: str, days: int, as_of: date | str) -> DataFrame:
    """Rows of the last ``days`` days before a given date."""
    return df.filter(F.col(ts) >= days_before(as_of, days))


def recent_relative_to_max(df: DataFrame, ts: str, days: int) -> DataFrame:
    """Rows of the last ``days`` days before the newest row."""
    newest = df.agg(F.max(ts)).scalar()
    return df.filter(F.col(ts) >= newest - F.expr(f"INTERVAL {int(days)} DAYS"))


def match(df: DataFrame, column: str, pattern: str, ignore_case: bool = False, negate: bool = False) -> DataFrame:
    """LIKE / ILIKE and their negations."""
    test = F.col(column).ilike(pattern) if ignore_case else F.col(column).like(pattern)
    return df.filter(~test if negate else test)


def prefiltered(df: DataFrame, cheap: Column, expensive) -> DataFrame:
    """Apply a cheap predicate, then an expensive step (a model, a UDF) on what is left."""
    return expensive(df.filter(cheap))


def top(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows; Spark keeps ``n`` rows per task and merges them."""
    return df.orderBy(*order).limit(n)


def recent_orders(orders: DataFrame, customer_id: int, k: int = 20) -> DataFrame:
    """Latest orders of one customer."""
    return top(lookup(orders, "customer_id", customer_id).select(
        "customer_id", "order_id", "order_date", "order_status", "total_amount"),
        [F.desc("order_date"), F.asc("order_id")], k)


def high_value_recent(orders: DataFrame, minimum: float, days: int, as_of: date | str, k: int = 10) -> DataFrame:
    """Largest recent orders above an amount."""
    return top(since(orders, "order_date", days, as_of).filter(F.col("total_amount") > F.lit(minimum)).select(
        "order_id", "customer_id", "order_date", "total_amount"),
        [F.desc("total_amount"), F.asc("order_id")], k)


def status_recent(orders: DataFrame, days: int, as_of: date | str) -> DataFrame:
    """Orders and revenue per status over recent days."""
    return since(orders, "order_date", days, as_of).groupBy("order_status").agg(
        F.count("*").alias("order_count"), F.sum("total_amount").alias("total_revenue"))


def customer_summary(customers: DataFrame, orders: DataFrame, customer_id: int) -> DataFrame:
    """Order count and spend of one customer; the key filter reaches both scans."""
    spent = lookup(orders, "customer_id", customer_id).groupBy("customer_id").agg(
        F.count("order_id").alias("order_count"), F.sum("total_amount").alias("total_spent"))
    return lookup(customers, "customer_id", customer_id).select("customer_id").join(
        spent, "customer_id", "left").withColumn("order_count", F.coalesce("order_count", F.lit(0)))


def serving_summary(analytics: DataFrame) -> DataFrame:
    """Average orders per customer, revenue and customers of the serving table."""
    return analytics.agg(
        F.round(mean("total_orders"), 2).alias("avg_orders_per_customer"),
        F.round(F.sum("total_spent"), 2).alias("total_revenue"),
        F.count_distinct("customer_id").alias("total_customers"))


def semi(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in the other relation."""
    return df.join(other.select(key), key, "left_semi")


def write_serving(df: DataFrame, path: str, key: str, partitions: int | None = None) -> None:
    """Write a table ordered by key, so min/max statistics answer point lookups."""
    spread = df.repartitionByRange(partitions, key) if partitions else df.repartitionByRange(key)
    spread.sortWithinPartitions(key).write.mode("overwrite").option(
        f"parquet.bloom.filter.enabled#{key}", "true").parquet(path)
