"""Staging and intermediate models: lazily composed, pruned by Catalyst."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.functions.semantics import day_lit, days_between, ladder, mean, ratio


def stg_customers(customers: DataFrame, as_of: date | str) -> DataFrame:
    signup = F.col("registration_date")
    return customers.select(
        "customer_id",
        F.concat("first_name", F.lit(" "), "last_name").alias("customer_name"),
        "email", "phone", "address", "city", "state", "zip_code",
        signup.alias("signup_date"),
        "customer_segment",
        days_between(signup, day_lit(as_of)).alias("days_since_signup"),
        F.trunc(signup, "month").alias("signup_month"),
        F.trunc(signup, "year").alias("signup_year"),
    )


def stg_orders(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with item totals; orders without items stay, with zero items.

    Items are aggregated before the join, so the join is one row per order.
    """
    per_order = items.groupBy("order_id").agg(
        F.count("order_item_id").alias("item_count"),
        F.sum("quantity").alias("total_quantity"),
        F.sum("line_total").alias("calculated_total"))
    ts = F.col("order_date")
    return orders.join(per_order, "order_id", "left").select(
        "order_id", "customer_id", "order_date", "order_status", "total_amount",
        "discount_percent", "shipping_cost",
        F.coalesce("item_count", F.lit(0)).alias("item_count"),
        "total_quantity", "calculated_total",
        F.date_trunc("day", ts).alias("order_date_only"),
        F.date_trunc("month", ts).alias("order_month"),
        F.date_trunc("year", ts).alias("order_year"),
        F.dayname(F.to_date(ts)).alias("order_day_of_week"),
        F.hour(ts).alias("order_hour"),
    )


def stg_order_items(items: DataFrame, catalog: DataFrame) -> DataFrame:
    """Items with catalogue attributes looked up by product name."""
    c = catalog.select(
        F.col("product_name"), F.col("product_category").alias("catalog_category"),
        F.col("price").alias("catalog_price"), F.col("description").alias("product_description"),
        F.col("features").alias("product_features"))
    sold, listed = F.col("unit_price"), F.col("catalog_price")
    return items.join(c, "product_name", "left").select(
        "order_item_id", "order_id", "product_id", "product_name",
        F.coalesce("catalog_category", "product_category").alias("product_category"),
        "quantity", "unit_price", "line_total",
        "catalog_price", "product_description", "product_features",
        (sold - listed).alias("price_difference"),
        ladder([(sold < listed, "discounted"), (sold > listed, "premium")], "standard").alias("pricing_type"),
        ratio("line_total", "quantity").alias("calculated_unit_price"),
    )


def stg_products(catalog: DataFrame, as_of: date | str) -> DataFrame:
    price = F.col("price")
    cost = price * F.lit(0.6).cast("decimal(2,1)")
    today = day_lit(as_of)
    return catalog.select(
        "product_id", "product_name", "description",
        F.col("product_category").alias("category"),
        F.col("product_category").alias("subcategory"),
        F.lit("Unknown").alias("brand"),
        "price", cost.alias("cost"), "stock_quantity",
        F.lit(100).alias("reorder_level"),
        F.lit(None).cast("bigint").alias("supplier_id"),
        today.alias("created_date"), today.alias("last_updated"),
        (price - cost).alias("margin"),
        ratio(price - cost, price).alias("margin_percent"),
        ladder([(F.col("stock_quantity") <= 100, "low"), (F.col("stock_quantity") <= 200, "medium")],
               "adequate").alias("stock_status"),
    )


def stg_product_reviews(reviews: DataFrame) -> DataFrame:
    return reviews.select(
        "review_id", "customer_id", "product_id", "rating", "review_title", "review_text",
        "review_date", "verified_purchase",
        ladder([(F.col("rating") >= 4, "positive"), (F.col("rating") == 3, "neutral")], "negative")
        .alias("sentiment_bucket"),
        F.trunc("review_date", "month").alias("review_month"),
    )


def stg_support_tickets(tickets: DataFrame) -> DataFrame:
    return tickets.select(
        "ticket_id", "customer_id", "subject", "category", "description", "status", "priority",
        "resolution", "ticket_date",
        F.coalesce(F.col("status") == F.lit("Resolved"), F.lit(False)).alias("is_resolved"),
        F.date_trunc("month", "ticket_date").alias("ticket_month"),
    )


def int_customer_orders(customers: DataFrame, orders: DataFrame, as_of: date | str) -> DataFrame:
    """Order history per customer, from staged customers and staged orders."""
    per_customer = orders.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("total_amount").alias("lifetime_revenue"),
        mean("total_amount").alias("avg_order_value"),
        F.sum("total_quantity").alias("lifetime_units"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"))
    return customers.join(per_customer, "customer_id", "left").select(
        "customer_id", "customer_name", "email", "customer_segment", "signup_date", "days_since_signup",
        F.coalesce("total_orders", F.lit(0)).alias("total_orders"),
        "lifetime_revenue", "avg_order_value", "lifetime_units", "first_order_date", "last_order_date",
        days_between("last_order_date", day_lit(as_of)).alias("days_since_last_order"),
    )


def int_customer_support(customers: DataFrame, tickets: DataFrame) -> DataFrame:
    """Ticket counts per customer, from staged customers and staged tickets."""
    counts = ["total_tickets", "resolved_tickets", "open_tickets", "high_priority_tickets"]
    per_customer = tickets.groupBy("customer_id").agg(
        F.count("*").alias("total_tickets"),
        F.count_if("is_resolved").alias("resolved_tickets"),
        F.count_if(~F.col("is_resolved")).alias("open_tickets"),
        F.count_if(F.col("priority") == F.lit("High")).alias("high_priority_tickets"),
        F.min("ticket_date").alias("first_ticket_date"),
        F.max("ticket_date").alias("last_ticket_date"))
    n = F.col("total_tickets")
    return (
        customers.select("customer_id", "customer_name", "customer_segment")
        .join(per_customer, "customer_id", "left")
        .withColumn("support_tier", ladder(
            [(n.isNull(), "no_tickets"), (n > 5, "high_contact"), (n > 2, "medium_contact")], "low_contact"))
        .withColumns({c: F.coalesce(c, F.lit(0)) for c in counts})
    )


def int_product_metrics(products: DataFrame, items: DataFrame, reviews: DataFrame) -> DataFrame:
    """Sales and review metrics per staged product."""
    # (product, order) first: the distinct order count becomes a plain count.
    per_order = items.groupBy("product_id", "order_id").agg(
        F.sum("quantity").alias("q"), F.sum("line_total").alias("r"),
        F.sum("unit_price").alias("p"), F.count("unit_price").alias("n"))
    sales = per_order.groupBy("product_id").agg(
        F.count("order_id").alias("order_count"),
        F.sum("q").alias("units_sold"),
        F.sum("r").alias("total_revenue"),
        ratio(F.sum("p"), F.sum("n")).alias("avg_selling_price"))
    rated = reviews.groupBy("product_id").agg(
        F.count("*").alias("review_count"),
        mean("rating").alias("avg_rating"),
        F.count_if(F.col("sentiment_bucket") == "positive").alias("positive_reviews"),
        F.count_if(F.col("sentiment_bucket") == "negative").alias("negative_reviews"))

    def zero(name):
        return F.coalesce(name, F.lit(0)).alias(name)

    return products.join(sales, "product_id", "left").join(rated, "product_id", "left").select(
        "product_id", "product_name", "category", F.col("price").alias("base_price"), "stock_quantity",
        zero("order_count"), zero("units_sold"), zero("total_revenue"), "avg_selling_price",
        zero("review_count"), "avg_rating", zero("positive_reviews"), zero("negative_reviews"),
    )
