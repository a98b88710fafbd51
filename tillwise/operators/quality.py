"""Data-quality metrics, expectations, alerts and schema tests."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.functions.semantics import mean
from tillwise.operators.reports import duplicate_count

RESULT_COLUMNS = ["table_name", "column_name", "metric", "value", "measured_at"]

# Columns watched for NULLs, and the text of the alert.
WATCHED = {
    "orders": ["order_id", "customer_id", "order_date", "total_amount"],
    "order_items": ["order_item_id", "order_id", "product_id", "quantity", "unit_price"],
}
ALERT_TEXT = "Data Quality Issue: NULL values detected"


class QualityError(RuntimeError):
    """A blocking expectation failed."""


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column in one pass over the table."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).unpivot(
        [], list(columns), "column_name", "value")


def freshness(df: DataFrame, ts: str, as_of: str) -> DataFrame:
    """Seconds between the newest row and an instant."""
    now = F.unix_timestamp(F.lit(as_of).cast("timestamp"))
    return df.agg((now - F.unix_timestamp(F.max(F.col(ts).cast("timestamp")))).alias("value"))


def custom_metric(df: DataFrame, name: str, failing: Column) -> DataFrame:
    """Rows that break a business rule."""
    return df.agg(F.count_if(failing).alias("value")).withColumn("metric", F.lit(name))


def _result(df: DataFrame, table: str, metric: str, at: str, column: str | None = None) -> DataFrame:
    name = F.col("column_name") if column is None else F.lit(column)
    return df.select(
        F.lit(table).alias("table_name"), name.alias("column_name"), F.lit(metric).alias("metric"),
        F.col("value").cast("double").alias("value"), F.lit(at).cast("timestamp").alias("measured_at"))


def dq_results(tables: Mapping[str, DataFrame], at: str, watched: Mapping[str, Sequence[str]] = WATCHED,
               keys: Mapping[str, str] | None = None, fresh: Mapping[str, str] | None = None,
               rules: Mapping[str, tuple[str, str, Column]] | None = None) -> DataFrame:
    """All metrics of all tables in one monitoring schema.

    ``keys`` names key columns to check for duplicates, ``fresh`` timestamp columns,
    ``rules`` maps a metric name to (table, column, failing condition).
    """
    parts = [_result(null_counts(tables[t], cols), t, "NULL_COUNT", at) for t, cols in watched.items()]
    for t, key in (keys or {}).items():
        dup = duplicate_count(tables[t], key).withColumnRenamed("duplicate_count", "value")
        parts.append(_result(dup, t, "DUPLICATE_COUNT", at, key))
    for t, ts in (fresh or {}).items():
        parts.append(_result(freshness(tables[t], ts, at), t, "FRESHNESS", at, ts))
    for name, (t, column, failing) in (rules or {}).items():
        parts.append(_result(custom_metric(tables[t], name, failing), t, name, at, column))
    return reduce(DataFrame.unionByName, parts)


@dataclass(frozen=True)
class Expectation:
    """``value <op> limit`` for one metric; ``tier`` says what a failure causes."""

    name: str
    table: str
    column: str
    metric: str
    op: str
    limit: float
    tier: str = "log"


def evaluate_expectations(results: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """One pass/fail row per rule and matching metric."""
    spark = results.sparkSession
    table = spark.createDataFrame(
        [(r.name, r.table, r.column, r.metric, r.op, float(r.limit), r.tier) for r in rules],
        "expectation string, table_name string, column_name string, metric string, op string, limit double, tier string")
    value, limit, op = F.col("value"), F.col("limit"), F.col("op")
    passed = (
        F.when(op == "=", value == limit).when(op == "<", value < limit).when(op == "<=", value <= limit)
        .when(op == ">", value > limit).when(op == ">=", value >= limit)
    )
    return results.join(table, ["table_name", "column_name", "metric"]).withColumn(
        "passed", F.coalesce(passed, F.lit(False)))


def dq_gate(evaluated: DataFrame) -> DataFrame:
    """What each evaluated rule asks for: ``none`` when it passed, else its tier."""
    return evaluated.withColumn("action", F.when(F.col("passed"), "none").otherwise(F.col("tier")))


def enforce(gated: DataFrame) -> DataFrame:
    """Raise when a rule asks to block; return the rules that ask for an alert."""
    # One row per rule, and the rules come from the caller.
    blocked = gated.filter(F.col("action") == "block").select("expectation").distinct().collect()
    if blocked:
        raise QualityError("blocked by " + ", ".join(sorted(r[0] for r in blocked)))
    return gated.filter(F.col("action") == "alert")


def dq_alert(results: DataFrame, at: str, minutes: int = 10, tables: Sequence[str] = tuple(WATCHED)) -> DataFrame:
    """One alert row when a watched column had NULLs in the last minutes, else no row."""
    now = F.lit(at).cast("timestamp")
    bad = results.filter(
        (F.col("metric") == "NULL_COUNT") & (F.col("value") > 0) & F.col("table_name").isin(*tables)
        & (F.col("measured_at") >= now - F.expr(f"INTERVAL {int(minutes)} MINUTES")))
    return bad.agg(F.count("*").alias("issues")).filter(F.col("issues") > 0).select(
        now.alias("alert_time"), F.lit(ALERT_TEXT).alias("issue_summary"))


def dq_severity(results: DataFrame) -> DataFrame:
    """Issue count and severity per check."""
    return results.select(
        F.col("metric").alias("check_name"), "table_name", "column_name",
        F.col("value").cast("bigint").alias("issue_count"),
        F.when(F.col("value") > 0, "HIGH").otherwise("OK").alias("severity"))


def schema_tests(df: DataFrame, spec: Mapping[str, Mapping]) -> DataFrame:
    """Failures of ``unique``, ``not_null`` and ``accepted_values`` tests per column.

    ``not_null`` and ``accepted_values`` of all columns share one pass; each ``unique``
    test is a count per key.
    """
    simple = {}
    unique = []
    for column, tests in spec.items():
        if tests.get("not_null"):
            simple[column, "not_null"] = F.count_if(F.col(column).isNull())
        if "accepted_values" in tests:
            simple[column, "accepted_values"] = F.count_if(
                F.col(column).isNotNull() & ~F.col(column).isin(*tests["accepted_values"]))
        if tests.get("unique"):
            unique.append(column)
    parts = []
    if simple:
        row = df.agg(*[a.alias(f"{c}|{t}") for (c, t), a in simple.items()])
        parts.append(row.unpivot([], row.columns, "k", "failures").select(
            F.split_part("k", F.lit("|"), F.lit(1)).alias("column_name"),
            F.split_part("k", F.lit("|"), F.lit(2)).alias("test"), "failures"))
    for column in unique:
        repeated = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
        parts.append(repeated.agg(F.count_if(F.col("n") > 1).alias("failures")).select(
            F.lit(column).alias("column_name"), F.lit("unique").alias("test"), "failures"))
    return reduce(DataFrame.unionByName, parts)


def consistency_check(serving: DataFrame, customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Serving totals against totals recomputed from the base tables, per customer."""
    base = orders.join(customers.select("customer_id"), "customer_id", "left_semi").groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("base_orders"), F.sum("total_amount").alias("base_spent"))
    joined = serving.select("customer_id", "total_orders", "total_spent").join(base, "customer_id", "full_outer")
    same = F.col("total_orders").eqNullSafe(F.col("base_orders")) & F.col("total_spent").eqNullSafe(F.col("base_spent"))
    return joined.withColumn("consistent", same)


def consistency_summary(checked: DataFrame) -> DataFrame:
    return checked.agg(F.count("*").alias("customers"), F.count_if("consistent").alias("consistent"),
                       mean(F.col("consistent").cast("int")).alias("share"))
