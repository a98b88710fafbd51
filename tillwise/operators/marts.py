"""Customer, product, cohort and support marts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.ranking import number_rows
from tillwise.functions.semantics import (
    at_least, at_most, day_lit, days_between, first_per_key, ladder, mean, month_steps, ratio,
    rounded_ratio, strict_greatest, strict_least)
from tillwise.operators.frequent_pairs import frequent_pairs
from tillwise.session import cut_lineage

# Thresholds, scores and labels of the customer value model.
HIGH_VALUE = 17500
ACTIVE_DAYS = 21
CLV_STATUSES = ("Completed", "Shipped")
RECENCY_SCORES = [(30, 10), (60, 8), (90, 6), (180, 4), (365, 2)]
FREQUENCY_SCORES = [(20, 10), (15, 8), (10, 6), (5, 4), (1, 2)]
MONETARY_SCORES = [(5000, 10), (2000, 8), (1000, 6), (500, 4), (100, 2)]

# Behavioural segments in order of precedence, with the recommended
# action. Bounds are (recency, frequency, monetary) as (low, high), both inclusive.
SEGMENTS = [
    ("champions", (8, 10), (8, 10), (8, 10), "Reward and retain with VIP benefits"),
    ("loyal_customers", (6, 10), (6, 10), (6, 10), "Upsell and cross-sell opportunities"),
    ("potential_loyalists", (8, 10), (0, 4), (6, 10), "Engage with loyalty program"),
    ("promising", (6, 10), (0, 4), (0, 4), "Nurture with targeted offers"),
    ("at_risk", (0, 4), (6, 10), (6, 10), "Win back with personalized campaigns"),
    ("cant_lose_them", (0, 2), (6, 10), (6, 10), "Aggressive retention strategy required"),
    ("hibernating_high_value", (0, 4), (0, 4), (6, 10), "Reactivation campaign"),
    ("lost", (0, 2), (0, 4), (0, 4), "Low priority - minimal investment"),
    ("new_customers", (6, 10), (0, 2), (0, 4), "Onboarding and education"),
]
OTHER_SEGMENT = ("needs_attention", "Analyze and segment further")
SEGMENT_PRIORITY = [
    (("champions", "loyal_customers"), 1),
    (("at_risk", "cant_lose_them"), 2),
    (("potential_loyalists", "hibernating_high_value"), 3),
    (("promising", "new_customers"), 4),
]
LOWEST_SEGMENT_PRIORITY = 5

# Affinity strength (lift, confidence), recommendation priority (lift, pairs).
STRENGTHS = [("very_strong", 3.0, 0.5), ("strong", 2.0, 0.3), ("moderate", 1.5, 0.2), ("weak", 1.2, 0.0)]
WEAKEST = "very_weak"
PAIR_PRIORITIES = [(1, 2.0, 100), (2, 1.5, 50), (3, 1.2, 25)]
LOWEST_PAIR_PRIORITY = 4
RECOMMENDED_STRENGTHS = ("very_strong", "strong", "moderate")
MESSAGE_VERBS = [("very_strong", "almost always"), ("strong", "frequently"), ("moderate", "often")]

# Cohort and support labels.
COHORT_STATUSES = ("completed", "shipped", "delivered")
COHORT_HEALTH = [(0.5, "healthy"), (0.3, "moderate"), (0.1, "at_risk")]
REVENUE_TIERS = [(0.9, "top_10_pct"), (0.75, "top_25_pct"), (0.5, "top_50_pct")]
RATING_TIERS = [(4.5, "excellent"), (4.0, "good"), (3.0, "average")]


def customer_lifetime_value(customers: DataFrame, orders: DataFrame, as_of: date | str,
                            high_value: int = HIGH_VALUE, active_days: int = ACTIVE_DAYS,
                            statuses: Sequence[str] = CLV_STATUSES) -> DataFrame:
    """Value, recency/frequency/monetary scores, tier and status per staged customer.

    Only orders in ``statuses`` count, and customers without any still appear.
    """
    spent = orders.filter(F.col("order_status").isin(*statuses)).groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("total_amount").alias("total_revenue"),
        mean("total_amount").alias("avg_order_value"),
        F.sum("total_quantity").alias("total_items_purchased"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"))
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("total_orders", "total_revenue", "total_items_purchased")}
    base = (
        customers.select("customer_id", "customer_name", "customer_segment", "signup_date", "days_since_signup")
        .join(spent, "customer_id", "left")
        .withColumns({
            **zero,
            "avg_order_value": F.coalesce("avg_order_value", F.lit(0.0)),
            "customer_lifespan_days": days_between("first_order_date", "last_order_date"),
            "days_since_last_order": days_between("last_order_date", day_lit(as_of)),
        })
    )
    revenue, orders_n = F.col("total_revenue"), F.col("total_orders")
    life, idle = F.col("customer_lifespan_days"), F.col("days_since_last_order")
    by_signup = ratio(revenue, F.col("days_since_signup")) * F.lit(365)
    scored = base.withColumns({
        "estimated_annual_value": by_signup,
        "historical_annual_value": F.when(life > 0, ratio(revenue, life) * F.lit(365)).otherwise(by_signup),
        "orders_per_month": ratio(orders_n, life) * F.lit(30),
        "recency_score": F.when(idle.isNull(), 0).otherwise(at_most(idle, RECENCY_SCORES, 0)),
        "frequency_score": at_least(orders_n, FREQUENCY_SCORES, 0),
        "monetary_score": at_least(revenue, MONETARY_SCORES, 0),
    })
    half = Decimal(high_value) / 2
    return scored.withColumns({
        "rfm_score": ratio(F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score"), F.lit(3)),
        "value_tier": ladder([(revenue >= F.lit(high_value), "high_value"),
                              (revenue >= F.lit(half), "medium_value"),
                              (revenue > 0, "low_value")], "no_purchases"),
        "customer_status": ladder([(idle.isNull(), "never_purchased"),
                                   (idle <= F.lit(active_days), "active"),
                                   (idle <= F.lit(active_days * 2), "at_risk")], "churned"),
    })


def customer_segmentation(clv: DataFrame) -> DataFrame:
    """Behavioural segment, recommended action and priority per customer."""

    def inside(column, bounds):
        return F.col(column).between(*bounds)

    tests = [inside("recency_score", r) & inside("frequency_score", f) & inside("monetary_score", m)
             for _, r, f, m, _ in SEGMENTS]
    segment = ladder(zip(tests, [s[0] for s in SEGMENTS]), OTHER_SEGMENT[0])
    action = ladder(zip(tests, [s[4] for s in SEGMENTS]), OTHER_SEGMENT[1])
    return (
        clv.select("customer_id", "customer_name", "customer_segment", "signup_date", "recency_score",
                   "frequency_score", "monetary_score", "rfm_score", "total_revenue", "total_orders",
                   "avg_order_value", "value_tier", "customer_status")
        .withColumn("behavioral_segment", segment)
        .withColumn("recommended_action", action)
        .withColumn("segment_priority", ladder(
            [(F.col("behavioral_segment").isin(*names), n) for names, n in SEGMENT_PRIORITY],
            LOWEST_SEGMENT_PRIORITY))
    )


def _baskets(items: DataFrame) -> DataFrame:
    """Distinct (order, product); one shuffle serves every use in a plan."""
    return items.select("order_id", "product_id", "product_name", "product_category").distinct()


def product_pairs(items: DataFrame) -> DataFrame:
    """Pairs of differently named products in one order, and in how many orders they meet.

    Items are first reduced to distinct (order, product), so an order contributes
    products and not rows, however often a line repeats. Both sides of the self-join
    read one shuffle by order; the join feeds a map-side count, and AQE splits an order
    that is far larger than the rest.
    """
    lines = _baskets(items)

    def side(s):
        return lines.select("order_id", *[
            F.col(c).alias(c.replace("product_", f"product_{s}_"))
            for c in ("product_id", "product_name", "product_category")])

    a, b = side("a"), side("b")
    met = a.join(b, "order_id").filter(F.col("product_a_name") < F.col("product_b_name"))
    return met.groupBy(*a.columns[1:], *b.columns[1:]).agg(
        F.count("*").alias("times_bought_together"))


def supported_pairs(items: DataFrame, support: int) -> DataFrame:
    """:func:`product_pairs` of at least ``support`` common orders; pairs that meet less often are never emitted.

    Products are told apart by name, as there, and each name has one id and category.
    """
    products = _baskets(items).select("product_id", "product_name", "product_category").distinct()

    def side(s, on):
        return products.select(*[F.col(c).alias(c.replace("product_", f"product_{s}_")) for c in products.columns]).withColumn(
            on, F.col(f"product_{s}_name"))

    pairs = frequent_pairs(items, support, "order_id", "product_name").withColumnRenamed("n", "times_bought_together")
    named = pairs.join(side("a", "a"), "a").join(side("b", "b"), "b").drop("a", "b")
    return named.select(*[c for c in named.columns if c != "times_bought_together"], "times_bought_together")


def product_affinity(items: DataFrame, min_lift: float = 1.0, support: int = 1,
                     strengths: Sequence[tuple] = STRENGTHS,
                     priorities: Sequence[tuple] = PAIR_PRIORITIES) -> DataFrame:
    """Confidence both ways, lift, support, strength and priority of product pairs.

    With ``support`` above 1, only pairs of that many common orders are made at all.
    """
    lines = _baskets(items)
    if support > 1:  # read by the totals, the names and the pairs
        lines = cut_lineage(items.sparkSession, lines)
    totals = lines.groupBy("product_name").agg(F.count_distinct("order_id").alias("n"))
    all_orders = lines.agg(F.count_distinct("order_id")).scalar()
    pairs = F.col("times_bought_together")
    a, b = F.col("product_a_total_orders"), F.col("product_b_total_orders")
    scored = (
        (product_pairs(items) if support <= 1 else supported_pairs(lines, support))
        .join(totals.select(F.col("product_name").alias("product_a_name"),
                            F.col("n").alias("product_a_total_orders")), "product_a_name")
        .join(totals.select(F.col("product_name").alias("product_b_name"),
                            F.col("n").alias("product_b_total_orders")), "product_b_name")
        .withColumns({
            "pair_frequency": pairs.cast("double"),
            "confidence_a_to_b": ratio(pairs, a),
            "confidence_b_to_a": ratio(pairs, b),
            "lift": ratio(pairs * all_orders, a * b),
            "support": ratio(pairs, all_orders),
        })
        .filter(F.col("lift") >= F.lit(min_lift))
    )
    lift, conf = F.col("lift"), F.col("confidence_a_to_b")
    return scored.withColumns({
        "affinity_strength": ladder(
            [((lift >= F.lit(l)) & (conf >= F.lit(c)), label) for label, l, c in strengths], WEAKEST),
        "recommendation_priority": ladder(
            [((lift >= F.lit(l)) & (pairs >= F.lit(n)), p) for p, l, n in priorities], LOWEST_PAIR_PRIORITY),
    })


def product_recommendations(affinity: DataFrame, n: int = 10,
                            keep: Sequence[str] = RECOMMENDED_STRENGTHS) -> DataFrame:
    """The ``n`` best partners of each product, with message and confidence level."""
    strong = affinity.filter(F.col("affinity_strength").isin(*keep))

    def direction(src, dst):
        return strong.select(
            F.col(f"product_{src}_id").alias("source_product_id"),
            F.col(f"product_{src}_name").alias("source_product_name"),
            F.col(f"product_{src}_category").alias("source_category"),
            F.col(f"product_{dst}_id").alias("recommended_product_id"),
            F.col(f"product_{dst}_name").alias("recommended_product_name"),
            F.col(f"product_{dst}_category").alias("recommended_category"),
            F.col(f"confidence_{src}_to_{dst}").alias("confidence"),
            "lift", "times_bought_together", "affinity_strength", "recommendation_priority")

    both = direction("a", "b").unionByName(direction("b", "a"))
    best = first_per_key(
        both, ["source_product_id"],
        [F.desc("lift"), F.desc("confidence"), F.desc("times_bought_together"),
         F.asc("recommended_product_id")], n, rank="recommendation_rank")
    src, dst = F.col("source_product_name"), F.col("recommended_product_name")
    message = ladder(
        [(F.col("affinity_strength") == F.lit(s),
          F.concat(F.lit("Customers who bought "), src, F.lit(f" {verb} buy "), dst))
         for s, verb in MESSAGE_VERBS],
        F.concat(F.lit("Consider "), dst, F.lit(" with "), src))
    return best.withColumns({
        "recommendation_message": message,
        "is_cross_category": F.coalesce(
            F.col("source_category") != F.col("recommended_category"), F.lit(False)),
        "confidence_level": at_least(F.col("confidence"), [(0.5, "high"), (0.3, "medium")], "low"),
    })


def product_performance(metrics: DataFrame) -> DataFrame:
    """Revenue and volume ranks, revenue tier, rating tier and inventory status.

    The three ranks and the percent rank are numbered together: each product becomes
    one row per ranking, the rankings are cut into value buckets, and the rows fold
    back by product. No ranking sorts all products in one task.
    """
    payload = F.struct(*[F.col(c) for c in metrics.columns])

    def ranking(name, value, group, sign):
        return F.struct(F.lit(name).alias("r"), group.alias("g"),
                        (value.cast("decimal(28,2)") * F.lit(sign)).alias("v"))

    nothing = F.lit(None).cast("string")
    long = (
        metrics.select(F.col("product_id"), payload.alias("p"), F.explode(F.array(
            ranking("revenue", F.col("total_revenue"), nothing, 1),
            ranking("category", F.col("total_revenue"), F.col("category"), 1),
            ranking("volume", F.col("units_sold"), nothing, 1),
            ranking("percent", F.col("total_revenue"), nothing, -1))).alias("k"))
        .select("product_id", F.col("k.r").alias("r"), F.col("k.g").alias("g"), F.col("k.v").alias("v"),
                F.when(F.col("k.r") == "revenue", F.col("p")).alias("p"))
    )
    placed = number_rows(long, "v", "product_id", ["r", "g"], "pos", rank="rk", size="n")

    def of(name, value):
        return F.max(F.when(F.col("r") == F.lit(name), F.col(value)))

    folded = placed.groupBy("product_id").agg(
        F.any_value("p", True).alias("p"),
        of("revenue", "pos").alias("revenue_rank"),
        of("category", "pos").alias("category_revenue_rank"),
        of("volume", "pos").alias("volume_rank"),
        of("percent", "rk").alias("rk"), of("percent", "n").alias("n"))
    share = F.coalesce(ratio(F.col("rk") - 1, F.col("n") - 1), F.lit(0.0))
    stock = F.col("stock_quantity")
    return folded.select("p.*", "revenue_rank", "category_revenue_rank", "volume_rank", share.alias("share")).select(
        *metrics.columns, "revenue_rank", "category_revenue_rank", "volume_rank",
        F.when(F.col("total_revenue") == 0, "no_sales")
        .otherwise(at_least(F.col("share"), REVENUE_TIERS, "bottom_50_pct")).alias("revenue_tier"),
        F.when(F.col("avg_rating").isNull(), "no_reviews")
        .otherwise(at_least(F.col("avg_rating"), RATING_TIERS, "poor")).alias("rating_tier"),
        ladder([(stock == 0, "out_of_stock"), (stock < 10, "low_stock"), (stock < 50, "normal_stock")],
               "high_stock").alias("inventory_status"),
    )


def monthly_cohorts(customers: DataFrame, orders: DataFrame,
                    statuses: Sequence[str] = COHORT_STATUSES) -> DataFrame:
    """Retention, revenue and churn per signup month and months since signup.

    Statuses are compared without regard to case.
    """
    wanted = [s.lower() for s in statuses]
    members = customers.groupBy(F.col("signup_month").alias("cohort_month")).agg(
        F.count("customer_id").alias("cohort_size"))
    # One row per customer and instant first, so counting instants is a plain count.
    moments = (
        orders.filter(F.lower("order_status").isin(*wanted))
        .groupBy("customer_id", "order_month", "order_date").agg(F.sum("total_amount").alias("amount")))
    activity = moments.groupBy("customer_id", "order_month").agg(
        F.count("order_date").alias("orders_in_month"), F.sum("amount").alias("revenue_in_month"))
    periods = (
        activity.join(customers.select("customer_id", F.col("signup_month").alias("cohort_month")), "customer_id")
        .groupBy("cohort_month", month_steps("cohort_month", "order_month").alias("months_since_signup"))
        .agg(F.count("customer_id").alias("active_customers"),
             F.sum("revenue_in_month").alias("cohort_revenue"),
             F.sum("orders_in_month").alias("total_orders"))
        .join(members, "cohort_month")
    )
    # At most one row per month of history and cohort.
    history = Window.partitionBy("cohort_month").orderBy("months_since_signup")
    active, size, revenue = F.col("active_customers"), F.col("cohort_size"), F.col("cohort_revenue")
    return periods.withColumns({
        "retention_rate": ratio(active, size),
        "revenue_per_active_customer": ratio(revenue, active),
        "revenue_per_cohort_member": ratio(revenue, size),
        "orders_per_active_customer": ratio("total_orders", active),
        "cumulative_revenue": F.sum(revenue).over(history),
    }).withColumns({
        "monthly_churn_rate": F.lag("retention_rate").over(history) - F.col("retention_rate"),
        "cohort_health": at_least(F.col("retention_rate"), COHORT_HEALTH, "poor"),
        "estimated_ltv_to_date": ratio("cumulative_revenue", size),
    })


def support_analytics(support: DataFrame, orders: DataFrame) -> DataFrame:
    """Resolution rate, revenue per ticket and a 0-100 health score per customer."""
    joined = support.join(
        orders.select("customer_id", "total_orders", "lifetime_revenue", "avg_order_value"),
        "customer_id", "left")
    tickets, solved = F.col("total_tickets"), F.col("resolved_tickets")
    revenue = F.col("lifetime_revenue")
    spending = F.when(revenue > 1000, F.lit(20.0)).otherwise(ratio(revenue, F.lit(50)))
    effort = F.when(tickets > 0, ratio(solved, tickets) * F.lit(20)).otherwise(F.lit(0.0))
    raw = (F.lit(50) + spending - tickets * F.lit(5) - F.col("open_tickets") * F.lit(10) + effort)
    clamped = strict_greatest(F.lit(0.0), strict_least(F.lit(100.0), raw))
    return joined.select(
        "customer_id", "customer_name", "customer_segment", "total_tickets", "resolved_tickets",
        "open_tickets", "high_priority_tickets", "support_tier", "first_ticket_date", "last_ticket_date",
        "total_orders", "lifetime_revenue", "avg_order_value",
        F.when(tickets > 0, rounded_ratio(solved * 100, tickets, 1)).alias("resolution_rate_pct"),
        F.when((revenue > 0) & (tickets > 0), rounded_ratio(revenue, tickets, 2)).alias("revenue_per_ticket"),
        F.when(F.coalesce("total_orders", F.lit(0)) == 0, F.lit(0.0)).otherwise(clamped)
        .alias("customer_health_score"),
    ).withColumn("health_status", at_least(
        F.col("customer_health_score"), [(80, "healthy"), (50, "at_risk")], "critical"))
