from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tillwise.operators import quality
from tillwise.plans.semantic import order_model

AT = "2024-01-01 12:00:00"


@pytest.fixture
def seeded(spark):
    orders = spark.createDataFrame([
        ("999990", 1, datetime(2024, 1, 1), 10.0), ("999991", 2, datetime(2024, 1, 1, 11), 20.0),
        ("999992", None, datetime(2024, 1, 1), -5.0), ("999993", None, None, 5.0)],
        "order_id string, customer_id int, order_date timestamp, total_amount double")
    items = spark.createDataFrame([
        ("i1", "999990", 1, 1, 1.0), ("i2", "999991", None, None, None), ("i2", "999991", 3, 1, 2.0)],
        "order_item_id string, order_id string, product_id int, quantity int, unit_price double")
    return {"orders": orders, "order_items": items}


def _value(results, table, column, metric):
    return results.filter((F.col("table_name") == table) & (F.col("column_name") == column)
                          & (F.col("metric") == metric)).first()["value"]


def test_metrics_alerts_and_gate(seeded):
    results = quality.dq_results(seeded, AT, keys={"order_items": "order_item_id"}, fresh={"orders": "order_date"},
                                 rules={"negative": ("orders", "total_amount", F.col("total_amount") < 0)})
    assert _value(results, "orders", "customer_id", "NULL_COUNT") == 2
    assert _value(results, "orders", "order_id", "NULL_COUNT") == 0
    assert _value(results, "order_items", "unit_price", "NULL_COUNT") == 1
    assert _value(results, "order_items", "order_item_id", "DUPLICATE_COUNT") == 1
    assert _value(results, "orders", "order_date", "FRESHNESS") == 3600
    assert _value(results, "orders", "total_amount", "negative") == 1
    assert quality.dq_alert(results, "2024-01-01 12:09:00").count() == 1
    assert quality.dq_alert(results, "2024-01-01 12:11:00").count() == 0
    assert quality.dq_severity(results).filter("severity = 'HIGH'").filter("issue_count = 0").count() == 0
    rules = [quality.Expectation("ids", "orders", "order_id", "NULL_COUNT", "=", 0, "block"),
             quality.Expectation("few", "orders", "total_amount", "negative", "<", 1, "alert"),
             quality.Expectation("fresh", "orders", "order_date", "FRESHNESS", "<", 1800, "log")]
    gated = quality.dq_gate(quality.evaluate_expectations(results, rules))
    assert {r["expectation"]: r["action"] for r in gated.collect()} == {"ids": "none", "few": "alert", "fresh": "log"}
    assert [r["expectation"] for r in quality.enforce(gated).collect()] == ["few"]
    strict = [quality.Expectation("customers", "orders", "customer_id", "NULL_COUNT", "=", 0, "block")]
    with pytest.raises(quality.QualityError, match="customers"):
        quality.enforce(quality.dq_gate(quality.evaluate_expectations(results, strict)))


def test_clean_rows_raise_no_alert(seeded):
    clean = {"orders": seeded["orders"].filter("customer_id IS NOT NULL"),
             "order_items": seeded["order_items"].filter("product_id IS NOT NULL")}
    assert quality.dq_alert(quality.dq_results(clean, AT), AT).count() == 0


def test_schema_tests(seeded):
    got = {(r["column_name"], r["test"]): r["failures"] for r in quality.schema_tests(seeded["order_items"], {
        "order_item_id": {"unique": True, "not_null": True}, "quantity": {"not_null": True, "accepted_values": [2]}}).collect()}
    assert got == {("order_item_id", "unique"): 1, ("order_item_id", "not_null"): 0,
                   ("quantity", "not_null"): 1, ("quantity", "accepted_values"): 2}


def test_consistency_finds_a_stale_row(tables):
    from tillwise.operators.serving import customer_order_analytics

    serving = customer_order_analytics(tables.customers, tables.orders)
    first = serving.agg(F.min("customer_id")).first()[0]
    stale = serving.withColumn("total_orders", F.col("total_orders") + F.when(F.col("customer_id") == first, 1).otherwise(0))
    row = quality.consistency_summary(quality.consistency_check(stale, tables.customers, tables.orders)).first()
    assert row["customers"] - row["consistent"] == 1


def test_semantic_names_and_grain(tables):
    model = order_model(tables.customers, tables.orders, tables.order_items)
    assert model.query(["aov"], ["segment"]).columns == ["customer_segment", "average_order_value"]
    joined = model.query(["revenue", "item_revenue"], ["segment"]).agg(F.sum("total_revenue")).first()[0]
    assert joined == tables.orders.agg(F.sum("total_amount")).first()[0]
    with pytest.raises(ValueError, match="cannot be reached"):
        model.query(["revenue"], ["product_category"])
    with pytest.raises(KeyError):
        model.query(["nothing"])


def test_semantic_reads_only_needed_tables(tables):
    model = order_model(tables.customers, tables.orders, tables.order_items)
    plan = model.query(["order_count"], ["order_status"])._jdf.queryExecution().executedPlan().toString()
    assert "customer.parquet" not in plan and "lineitem.parquet" not in plan
