"""Business questions with known answers, over the marts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.functions.semantics import day_lit, ladder, mean, ratio
from tillwise.operators.reports import clv_summary, segment_summary
from tillwise.operators.serving import since, top


def revenue_trend(daily: DataFrame, as_of: date | str, days: int = 7) -> DataFrame:
    return since(daily, "order_date_only", days, as_of).select(
        "order_date_only", F.col("total_net_revenue").alias("total_revenue"),
        F.col("total_net_revenue").alias("net_revenue"))


def top_revenue_days(daily: DataFrame, as_of: date | str, n: int = 5) -> DataFrame:
    """Best days of the calendar month of ``as_of``."""
    this_month = F.trunc("order_date_only", "month") == F.trunc(day_lit(as_of), "month")
    return top(daily.filter(this_month).select("order_date_only", F.col("total_net_revenue").alias("total_revenue")),
               [F.desc("total_revenue"), F.asc("order_date_only")], n)


def weekday_weekend(daily: DataFrame, as_of: date | str, days: int = 30) -> DataFrame:
    period = F.when(F.col("order_day_name").isin("Sat", "Sun"), "Weekend").otherwise("Weekday")
    return since(daily, "order_date_only", days, as_of).groupBy(period.alias("period_type")).agg(
        F.sum("total_net_revenue").alias("total_revenue"), F.count("*").alias("num_days"),
        mean("total_net_revenue").alias("avg_daily_revenue"))


def discount_impact(orders: DataFrame, as_of: date | str, days: int = 30) -> DataFrame:
    rate = F.col("discount_percent") / F.lit(100)
    amount = F.col("total_amount")
    return since(orders, "order_date", days, as_of).filter(F.col("discount_percent").isNotNull()).agg(
        (ratio(F.sum(amount * rate), F.sum(amount)) * F.lit(100)).alias("discount_penetration_pct"),
        F.sum(amount * rate).alias("total_discounts_given"),
        F.sum(amount * (F.lit(1) - rate)).alias("net_revenue"),
        F.sum(amount).alias("gross_revenue"))


def segment_revenue_with_shipping(orders: DataFrame, customers: DataFrame, as_of: date | str,
                                  days: int = 30) -> DataFrame:
    final = F.col("total_amount") * (F.lit(1) - F.col("discount_percent") / F.lit(100)) + F.col("shipping_cost")
    per_customer = since(orders, "order_date", days, as_of).groupBy("customer_id").agg(
        F.sum(final).alias("amount"), F.count(final).alias("n"), F.count_distinct("order_id").alias("orders"))
    return per_customer.join(customers.select("customer_id", "customer_segment"), "customer_id").groupBy(
        "customer_segment").agg(
        F.sum("amount").alias("total_revenue"), F.sum("orders").alias("total_orders"),
        ratio(F.sum("amount"), F.sum("n")).alias("avg_order_value"))


def best_days_of_week(daily: DataFrame, as_of: date | str, days: int = 90) -> DataFrame:
    return since(daily, "order_date_only", days, as_of).groupBy("order_day_name").agg(
        F.sum("total_net_revenue").alias("total_revenue"), mean("total_orders").alias("avg_orders_per_day"),
        mean(F.col("avg_order_value").cast("decimal(20,6)")).alias("avg_order_value"))


def large_order_trend(daily: DataFrame, as_of: date | str, days: int = 30) -> DataFrame:
    return since(daily, "order_date_only", days, as_of).select(
        "order_date_only", "large_orders", "extra_large_orders", "total_orders")


def order_size_distribution(daily: DataFrame, as_of: date | str, days: int = 30) -> DataFrame:
    return since(daily, "order_date_only", days, as_of).select(
        "order_date_only", "small_orders", "medium_orders", "large_orders", "extra_large_orders", "total_orders")


def value_tier_analysis(clv: DataFrame) -> DataFrame:
    return clv_summary(clv, ["value_tier"]).select(
        "value_tier", F.col("customer_count").alias("num_customers"),
        F.col("total_revenue_sum").alias("total_revenue"), F.col("avg_revenue").alias("avg_revenue_per_customer"),
        F.col("avg_orders").alias("avg_orders_per_customer"), "avg_rfm_score")


def at_risk_high_value(clv: DataFrame, n: int = 20) -> DataFrame:
    return top(clv.filter((F.col("customer_status") == "at_risk") & (F.col("value_tier") == "high_value")).select(
        "customer_id", "customer_name", "customer_segment", "value_tier", "total_revenue", "total_orders",
        "days_since_last_order", "estimated_annual_value"),
        [F.desc_nulls_first("estimated_annual_value"), F.asc("customer_id")], n)


def behavioral_segments(segments: DataFrame) -> DataFrame:
    return segment_summary(segments)


def top_product_pairs(affinity: DataFrame, n: int = 15) -> DataFrame:
    return top(affinity.filter(F.col("affinity_strength").isin("very_strong", "strong")).select(
        "product_a_name", "product_b_name", "times_bought_together", "confidence_a_to_b", "lift", "affinity_strength"),
        [F.desc("times_bought_together"), F.asc("product_a_name"), F.asc("product_b_name")], n)


def cross_category_pairs(affinity: DataFrame, n: int = 10, priority: int = 1) -> DataFrame:
    return top(affinity.filter((F.col("product_a_category") != F.col("product_b_category"))
                               & (F.col("recommendation_priority") == priority)).select(
        "product_a_name", "product_a_category", "product_b_name", "product_b_category",
        "times_bought_together", "lift", "affinity_strength"),
        [F.desc("lift"), F.asc("product_a_name"), F.asc("product_b_name")], n)


def discount_analysis(orders: DataFrame, as_of: date | str) -> DataFrame:
    """Revenue before and after discounts, discount rate and share of discounted orders."""
    amount, rate = F.col("total_amount"), F.col("discount_percent") / F.lit(100)
    day = F.to_date("order_date")
    return orders.filter(day <= day_lit(as_of)).agg(
        F.min(day).alias("data_start_date"), F.max(day).alias("data_end_date"),
        F.count_distinct(day).alias("total_days_with_data"),
        F.sum(amount).alias("revenue_before_discounts"),
        F.sum(amount * rate).alias("total_discount_amounts"),
        F.sum(amount * (F.lit(1) - rate)).alias("revenue_after_discounts"),
        F.count("order_id").alias("total_orders"),
        F.count_if(amount * rate > 0).alias("orders_with_discounts"),
    ).withColumns({
        "discount_impact_amount": F.col("revenue_before_discounts") - F.col("revenue_after_discounts"),
        "discount_rate": ratio("total_discount_amounts", "revenue_before_discounts"),
        "discount_penetration": ratio("orders_with_discounts", "total_orders"),
    })


VALUE_TIER_ORDER = ["high_value", "medium_value", "low_value", "no_purchases"]


def by_value_tier(df: DataFrame) -> DataFrame:
    """Sort tiers from the most to the least valuable."""
    return df.orderBy(ladder([(F.col("value_tier") == t, i) for i, t in enumerate(VALUE_TIER_ORDER)], 9))
