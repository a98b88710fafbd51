"""Declared schemas of the retail entities."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "BIGINT": T.LongType(), "INT": T.IntegerType(), "STRING": T.StringType(),
    "DATE": T.DateType(), "TIMESTAMP": T.TimestampType(), "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
}


def _schema(ddl: str) -> T.StructType:
    """Build a schema from ``name TYPE`` pairs without needing a session."""
    fields = []
    for part in ddl.split(", "):
        name, kind = part.split(" ")
        if kind.startswith("DECIMAL"):
            precision, scale = kind[8:-1].split(",")
            fields.append(T.StructField(name, T.DecimalType(int(precision), int(scale))))
        else:
            fields.append(T.StructField(name, _TYPES[kind]))
    return T.StructType(fields)


CUSTOMERS = _schema(
    "customer_id BIGINT, first_name STRING, last_name STRING, email STRING, phone STRING, "
    "address STRING, city STRING, state STRING, zip_code STRING, registration_date DATE, "
    "customer_segment STRING")

ORDERS = _schema(
    "order_id STRING, customer_id BIGINT, order_date TIMESTAMP, order_status STRING, "
    "total_amount DECIMAL(10,2), discount_percent DECIMAL(5,2), shipping_cost DECIMAL(8,2)")

ORDER_ITEMS = _schema(
    "order_item_id STRING, order_id STRING, product_id BIGINT, product_name STRING, "
    "product_category STRING, quantity INT, unit_price DECIMAL(10,2), line_total DECIMAL(12,2)")

# Staging twins arrive with floating-point money and no key.
ORDERS_STAGING = _schema(
    "order_id STRING, customer_id BIGINT, order_date TIMESTAMP, order_status STRING, "
    "total_amount DOUBLE, discount_percent DOUBLE, shipping_cost DOUBLE")

ORDER_ITEMS_STAGING = _schema(
    "order_item_id STRING, order_id STRING, product_id BIGINT, product_name STRING, "
    "product_category STRING, quantity INT, unit_price DOUBLE, line_total DOUBLE")

DISCOUNT_SNAPSHOT = _schema("order_id STRING, discount_percent DOUBLE")

PRODUCT_CATALOG = _schema(
    "product_id BIGINT, product_name STRING, product_category STRING, description STRING, "
    "features STRING, price DECIMAL(10,2), stock_quantity INT")

PRODUCT_REVIEWS = _schema(
    "review_id BIGINT, product_id BIGINT, customer_id BIGINT, review_date DATE, rating INT, "
    "review_title STRING, review_text STRING, verified_purchase BOOLEAN")

SUPPORT_TICKETS = _schema(
    "ticket_id BIGINT, customer_id BIGINT, ticket_date TIMESTAMP, category STRING, "
    "priority STRING, subject STRING, description STRING, resolution STRING, status STRING")

CUSTOMER_VALUE_MART = _schema(
    "customer_id BIGINT, customer_name STRING, customer_segment STRING, signup_date DATE, "
    "days_since_signup INT, total_orders BIGINT, total_revenue DECIMAL(22,2), "
    "avg_order_value DECIMAL(28,8), total_items_purchased BIGINT, first_order_date TIMESTAMP, "
    "last_order_date TIMESTAMP, customer_lifespan_days INT, days_since_last_order INT, "
    "estimated_annual_value DECIMAL(31,8), historical_annual_value DECIMAL(31,8), "
    "orders_per_month DECIMAL(26,6), recency_score INT, frequency_score INT, "
    "monetary_score INT, rfm_score DECIMAL(10,6), value_tier STRING, customer_status STRING")


def conform(df, schema: T.StructType):
    """Select and cast to a declared schema."""
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema])
