"""Set operations by column name, and chained queries."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.operators.serving import top


def union_by_name(*dfs: DataFrame, distinct: bool = False) -> DataFrame:
    """UNION [ALL] BY NAME: columns match by name, missing ones become NULL."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
    return out.distinct() if distinct else out


def _aligned(a: DataFrame, b: DataFrame) -> DataFrame:
    if set(a.columns) != set(b.columns):
        raise ValueError(f"columns differ: {sorted(set(a.columns) ^ set(b.columns))}")
    return b.select(*a.columns)


def except_by_name(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` that ``b`` does not hold.

    Both sides are made distinct first, so repeated rows never meet in one task.
    """
    return a.distinct().subtract(_aligned(a, b).distinct())


def intersect_by_name(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows both sides hold."""
    return a.distinct().intersect(_aligned(a, b).distinct())


def chain(first: DataFrame, *steps: Callable[[list[DataFrame]], DataFrame]) -> DataFrame:
    """Run steps in order; each gets all earlier results, the newest first."""
    results = [first]
    for step in steps:
        results.insert(0, step(results))
    return results[0]


def table_summaries(orders: DataFrame, customers: DataFrame, catalog: DataFrame) -> DataFrame:
    """One row per table, each with its own extra metric."""
    def base(df, name, total=None):
        value = F.sum(total).cast("decimal(38,2)") if total else F.lit(None).cast("decimal(38,2)")
        return df, [F.count("*").alias("record_count"), value.alias("total_value")], F.lit(name).alias("table_name")

    rows = []
    for (df, aggs, name), extra in [
        (base(orders, "orders", "total_amount"), []),
        (base(customers, "customers"), [F.count_distinct("state").alias("unique_states")]),
        (base(catalog, "products", "price"), [F.count_distinct("product_category").alias("unique_categories")]),
    ]:
        rows.append(df.agg(*aggs, *extra).withColumn("table_name", name))
    return union_by_name(*rows)


def state_customer_count(customers: DataFrame, state: str) -> DataFrame:
    """Filter, project, count as a chain."""
    return chain(
        customers.filter(F.col("state") == state),
        lambda r: r[0].select("customer_id", "first_name", "last_name", "customer_segment"),
        lambda r: r[0].agg(F.count("*").alias("customer_count")))


def high_value_stats(orders: DataFrame, minimum: float = 500, n: int = 100) -> DataFrame:
    """Statistics over the ``n`` smallest-id orders above an amount."""
    return chain(
        top(orders.filter(F.col("total_amount") > minimum).select("order_id", "customer_id", "total_amount"),
            [F.asc("order_id")], n),
        lambda r: r[0].agg(
            F.try_divide(F.sum("total_amount").cast("double"), F.count("total_amount").cast("double")).alias("avg_amount"),
            F.min("total_amount").alias("min_amount"), F.max("total_amount").alias("max_amount")),
        lambda r: r[0].withColumn("metric_type", F.lit(f"orders above {minimum:g}")))


def counts_for_customers(customers: DataFrame, orders: DataFrame, segment: str = "Premium", n: int = 10) -> DataFrame:
    """Order counts of the first ``n`` customers of a segment, as one join instead of a loop."""
    picked = top(customers.filter(F.col("customer_segment") == segment).select("customer_id"),
                 [F.asc("customer_id")], n)
    counted = orders.join(picked, "customer_id", "left_semi").groupBy("customer_id").agg(
        F.count("*").alias("order_count"))
    return picked.join(counted, "customer_id", "left").withColumn(
        "order_count", F.coalesce("order_count", F.lit(0)))


def orders_by_month(orders: DataFrame) -> DataFrame:
    return orders.groupBy(F.date_trunc("month", "order_date").alias("month")).agg(F.count("*").alias("orders"))


def customers_by_segment(customers: DataFrame) -> DataFrame:
    return customers.groupBy("customer_segment").agg(F.count("*").alias("customers"))
