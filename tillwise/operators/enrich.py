"""Enrichment, order fact and business aggregates."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.functions.semantics import at_most, day_of_week, ladder, ratio

# Tier labels and limits.
DISCOUNT_TIERS = [(0, "No Discount"), (10, "Low Discount"), (20, "Medium Discount")]
TOP_DISCOUNT_TIER = "High Discount"
SIZE_CLASSES = [(100, "Small"), (500, "Medium"), (2000, "Large")]
TOP_SIZE_CLASS = "Extra Large"
QUANTITY_TIERS = [(1, "Single"), (3, "Few")]
TOP_QUANTITY_TIER = "Bulk"
FLAG_CATEGORIES = {"is_skis": "Skis", "is_snowboards": "Snowboards"}

CALENDAR = ["order_date_only", "order_year", "order_quarter", "order_month", "order_week", "order_day_name"]


def size_class(amount):
    return ladder([(amount < F.lit(limit), label) for limit, label in SIZE_CLASSES], TOP_SIZE_CLASS)


def quantity_tier(quantity):
    (single, single_label), (few, few_label) = QUANTITY_TIERS
    return ladder([(quantity == F.lit(single), single_label), (quantity <= F.lit(few), few_label)],
                  TOP_QUANTITY_TIER)


def order_columns() -> list[Column]:
    """Calendar parts, discount amounts, discount tier and size class beside an order's own columns."""
    ts, amount, pct = F.col("order_date"), F.col("total_amount"), F.col("discount_percent")
    discount = amount * (pct / F.lit(100))
    return [
        *map(F.col, ("order_id", "customer_id", "order_date", "order_status")),
        F.to_date(ts).alias("order_date_only"),
        F.year(ts).alias("order_year"),
        F.quarter(ts).alias("order_quarter"),
        F.month(ts).alias("order_month"),
        day_of_week(ts).alias("order_day_of_week"),
        F.dayname(F.to_date(ts)).alias("order_day_name"),
        F.weekofyear(ts).alias("order_week"),
        *map(F.col, ("total_amount", "discount_percent", "shipping_cost")),
        F.round(discount, 2).cast("decimal(12,2)").alias("discount_amount"),
        F.round(amount - discount, 2).cast("decimal(12,2)").alias("net_amount"),
        F.round(amount - discount + F.col("shipping_cost"), 2).cast("decimal(12,2)").alias("final_amount"),
        F.coalesce(pct > 0, F.lit(False)).alias("has_discount"),
        at_most(pct, [(Decimal(n), label) for n, label in DISCOUNT_TIERS], TOP_DISCOUNT_TIER)
        .alias("discount_tier"),
        size_class(amount).alias("order_size_category"),
    ]


def enriched_orders(orders: DataFrame) -> DataFrame:
    """Calendar parts, discount amounts, discount tier and size class of each order."""
    return orders.select(*order_columns())


def item_columns(flag_categories: Mapping[str, str] = FLAG_CATEGORIES) -> list[Column]:
    """Effective unit price, its variance, category flags and quantity tier beside an item's own columns."""
    unit = F.try_divide(F.col("line_total"), F.col("quantity"))
    return [
        *map(F.col, ("order_item_id", "order_id", "product_id", "product_name", "product_category",
                     "quantity", "unit_price", "line_total")),
        F.round(unit, 2).cast("decimal(12,2)").alias("actual_unit_price"),
        F.round(F.col("unit_price") - unit, 2).cast("decimal(12,2)").alias("unit_price_variance"),
        *[F.coalesce(F.col("product_category") == F.lit(label), F.lit(False)).alias(flag)
          for flag, label in flag_categories.items()],
        quantity_tier(F.col("quantity")).alias("quantity_tier"),
    ]


def enriched_order_items(items: DataFrame, flag_categories: Mapping[str, str] = FLAG_CATEGORIES) -> DataFrame:
    """Effective unit price, its variance, category flags and quantity tier of each item."""
    return items.select(*item_columns(flag_categories))


def fact_orders(orders: DataFrame, items: DataFrame) -> DataFrame:
    """One row per item with its order, and the order's item count and item total.

    The per-order totals come from an aggregate with map-side combine joined back by
    key, not from a window, so an order that owns a large share of the items is never
    gathered in one task: the join is split by AQE.
    """
    per_order = items.groupBy("order_id").agg(
        F.count("order_item_id").alias("items_per_order"),
        F.sum("line_total").alias("order_items_total"))
    return orders.join(items, "order_id").join(per_order, "order_id").select(
        *[c for c in orders.columns],
        *[c for c in items.columns if c != "order_id"],
        "items_per_order", "order_items_total",
    )


def daily_business_metrics(fact: DataFrame, grain: str = "item") -> DataFrame:
    """Daily orders, customers, revenue, discount and size metrics.

    ``grain="item"`` sums order amounts once per item row of the fact, as the daily
    aggregate has always done; ``grain="order"`` counts each order once. Either way the
    fact collapses to one row per order first, so the many distinct counts become
    plain sums and only customers need a distinct count.
    """
    if grain not in ("item", "order"):
        raise ValueError(f"unknown grain {grain!r}")
    order_cols = ["total_amount", "net_amount", "discount_amount", "shipping_cost", "final_amount",
                  "has_discount", "discount_percent", "order_size_category", "items_per_order"]
    per_order = fact.groupBy("order_id", "customer_id", *CALENDAR, *order_cols).agg(
        F.count("*").alias("rows"))
    weight = F.col("rows") if grain == "item" else F.lit(1).cast("bigint")
    one = F.lit(1).cast("bigint")

    def total(name):
        return F.sum(F.col(name) * weight)

    def size(label):
        return F.count_if(F.col("order_size_category") == F.lit(label))

    weighted = F.sum(weight)
    discounted = F.sum(F.when(F.col("has_discount"), weight))
    return per_order.groupBy(*CALENDAR).agg(
        F.sum(one).alias("total_orders"),
        F.count_distinct("customer_id").alias("unique_customers"),
        ratio(F.sum(F.col("items_per_order") * weight), weighted).alias("avg_items_per_order"),
        total("total_amount").alias("total_revenue"),
        total("net_amount").alias("total_net_revenue"),
        total("discount_amount").alias("total_discounts"),
        total("shipping_cost").alias("total_shipping"),
        total("final_amount").alias("total_final_revenue"),
        ratio(total("final_amount"), weighted).alias("avg_order_value"),
        F.count_if("has_discount").alias("orders_with_discount"),
        F.round(F.try_divide(F.count_if("has_discount").cast("decimal(20,0)") * 100, F.sum(one)), 2)
        .cast("decimal(9,2)").alias("discount_penetration_pct"),
        ratio(F.sum(F.when(F.col("has_discount"), F.col("discount_percent") * weight)), discounted)
        .alias("avg_discount_percent"),
        size("Small").alias("small_orders"),
        size("Medium").alias("medium_orders"),
        size("Large").alias("large_orders"),
        size("Extra Large").alias("extra_large_orders"),
    )


def product_performance_metrics(fact: DataFrame, flag_categories: Mapping[str, str] = FLAG_CATEGORIES) -> DataFrame:
    """Sales, price and quantity metrics per product category."""
    flags = {"is_skis": "ski_items", "is_snowboards": "snowboard_items"}
    # Collapse to (category, order) first: the distinct order count becomes a plain count.
    per_order = fact.groupBy("product_category", "order_id").agg(
        F.count("order_item_id").alias("items"),
        F.sum("quantity").alias("quantity"),
        F.count("quantity").alias("n_quantity"),
        F.sum("line_total").alias("revenue"),
        F.count("line_total").alias("n_revenue"),
        F.sum("unit_price").alias("price"),
        F.count("unit_price").alias("n_price"),
        F.min("unit_price").alias("low"),
        F.max("unit_price").alias("high"),
        *[F.count_if(F.col(flag)).alias(flag) for flag in flag_categories],
        *[F.count_if(F.col("quantity_tier") == F.lit(t)).alias(t) for t in ("Single", "Few", "Bulk")],
    )
    return per_order.groupBy("product_category").agg(
        F.count("order_id").alias("orders_count"),
        F.sum("items").alias("items_sold"),
        F.sum(F.col("quantity")).alias("total_quantity_sold"),
        F.sum("revenue").alias("total_revenue"),
        ratio(F.sum("price"), F.sum("n_price")).alias("avg_unit_price"),
        ratio(F.sum("quantity"), F.sum("n_quantity")).alias("avg_quantity_per_order"),
        ratio(F.sum("revenue"), F.sum("n_revenue")).alias("avg_line_total"),
        F.min("low").alias("min_unit_price"),
        F.max("high").alias("max_unit_price"),
        *[F.sum(flag).alias(flags.get(flag, flag + "_items")) for flag in flag_categories],
        F.sum("Single").alias("single_item_orders"),
        F.sum("Few").alias("few_item_orders"),
        F.sum("Bulk").alias("bulk_orders"),
    )


def order_facts(orders: DataFrame) -> DataFrame:
    """Discount and final amounts of an order, unrounded."""
    amount, pct = F.col("total_amount"), F.col("discount_percent")
    rate = pct / F.lit(100)
    net = (F.lit(1) - rate) * amount
    return orders.withColumns({
        "applied_discount_percent": F.when(pct > 0, pct),
        "discount_rate_decimal": rate,
        "discount_multiplier": F.lit(1) - rate,
        "discount_amount": amount * rate,
        "discounted_order_amount": net,
        "final_amount": net + F.col("shipping_cost"),
        "has_discount_flag": F.when(pct > 0, F.lit(1)),
        "order_total": amount,
    })


