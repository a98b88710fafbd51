from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.operators import table_state as ts

SCHEMA = "id string, name string, n int"


@pytest.fixture
def target(spark):
    return spark.createDataFrame([("a", "old", 1), ("b", None, 2), ("c", "same", 3)], SCHEMA)


@pytest.fixture
def source(spark):
    return spark.createDataFrame([("b", "new", 2), ("c", "same", 3), ("d", "add", 4), ("d", "add", 3), (None, "x", 0)], SCHEMA)


def test_merge_upsert(target, source, rows):
    result = ts.merge_upsert(target, source, "id", [F.desc("n")])
    assert rows(result.table) == [("a", "old", 1), ("b", "new", 2), ("c", "same", 3), ("d", "add", 4)]
    assert result.counts().first().asDict() == {
        "inserted": 1, "updated": 2, "deleted": 0, "unchanged": 1, "records_merged": 3}
    again = ts.merge_upsert(result.table, source, "id", [F.desc("n")])
    assert rows(again.table) == rows(result.table)


def test_small_merge_does_not_shuffle_the_target(spark, tables, folder):
    tables.orders.unionByName(tables.orders.withColumn("order_id", F.concat("order_id", F.lit("x")))).write.parquet(f"{folder}/big")
    tables.orders.limit(5).withColumn("order_status", F.lit("Changed")).unionByName(
        tables.orders.limit(1).withColumn("order_id", F.lit("new"))).write.parquet(f"{folder}/few")
    big = spark.read.parquet(f"{folder}/big")
    result = ts.merge_upsert(big, spark.read.parquet(f"{folder}/few"), "order_id")
    assert "FullOuter" not in result.classified._jdf.queryExecution().optimizedPlan().toString()
    counts = result.counts().first()
    assert (counts["inserted"], counts["updated"], counts["unchanged"]) == (1, 5, big.count() - 5)
    assert result.table.filter("order_status = 'Changed'").count() == 5


def test_merge_changed_sees_null_transitions(target, source):
    counts = ts.merge_changed(target, source, "id", ["name"]).counts().first()
    assert (counts["updated"], counts["inserted"], counts["unchanged"]) == (1, 1, 2)


def test_merge_updates_only_named_columns(target, source, rows):
    out = ts.merge_upsert(target, source.withColumn("n", F.lit(9)), "id", update=["name"]).table
    assert ("b", "new", 2) in rows(out) and ("d", "add", 9) in rows(out)


def test_mirror_deletes_what_the_source_lost(target, source, rows):
    result = ts.mirror_sync(target, source, "id")
    assert [r[0] for r in rows(result.table)] == ["b", "c", "d"]
    assert result.counts().first()["deleted"] == 1
    assert [r[0] for r in rows(ts.missing_in_source(target, source, "id"))] == ["a"]


def test_write_merge_reports(target, source, folder, spark):
    report = ts.write_merge(ts.merge_upsert(target, source, "id"), folder)
    assert report["records_merged"] == 3 and report["duration_ms"] >= 0
    assert spark.read.parquet(report["path"]).count() == 4


def test_duplicates_keep_one_copy_of_equal_rows(spark, rows):
    df = spark.createDataFrame([("k", "x", 1)] * 4 + [("k", "y", 2), ("z", "x", 1)], SCHEMA)
    extra = {(r["id"], r["name"]): r["extra_copies"] for r in ts.duplicate_rows(df, ["id"], [F.desc("n")]).collect()}
    assert extra == {("k", "x"): 4}
    assert rows(ts.dedupe_latest(df, ["id"], [F.desc("n")])) == [("k", "y", 2), ("z", "x", 1)]


def test_reconcile_is_idempotent(spark, rows):
    orders = spark.createDataFrame(
        [("1", datetime(2024, 1, 1)), ("1", datetime(2024, 1, 1)), ("2", datetime(2024, 1, 2)), ("3", datetime(2024, 1, 3))],
        "order_id string, order_date timestamp")
    items = spark.createDataFrame([("i1", "1"), ("i2", "3"), ("i9", "9")], "order_item_id string, order_id string")
    done = ts.reconcile(orders, items)
    assert [r[0] for r in rows(done.orders)] == ["1", "3"]
    assert [r[0] for r in rows(done.items)] == ["i1", "i2"]
    assert tuple(done.stats.first()) == (1, 1, 1, 1, 1, 1, 2, 2)
    assert tuple(ts.reconcile(done.orders, done.items).stats.first()) == (0, 0, 0, 0, 0, 0, 2, 2)


def _orders(spark, values):
    rows = [(str(i), datetime(2024, 3, 1), float(a), d) for i, (a, d) in enumerate(values)]
    return spark.createDataFrame(rows, "order_id string, order_date timestamp, total_amount double, discount_percent double")


def test_discount_rule(spark):
    df = _orders(spark, [(1000, 0.0), (500, 0.0), (499, 0.0), (1000, 48.0), (1000, 50.0), (1000, None)])
    result = ts.apply_discounts(df, "2024-03-02")
    got = [r[0] for r in result.table.orderBy("order_id").select("discount_percent").collect()]
    assert got == [5.0, 2.5, 0.0, 50.0, 50.0, None]
    assert result.counts().first()["updated"] == 4
    late = ts.apply_discounts(df, "2024-06-01")
    assert late.counts().first()["updated"] == 0
    back = ts.restore_discounts(result.table, ts.snapshot(df, "2024-03-02"))
    assert [r[0] for r in back.orderBy("order_id").select("discount_percent").collect()] == [0, 0, 0, 48, 50, None]


CHECKED = [
    (1, 249.99, "PENDING", 3), (2, 89.5, "SHIPPED", 1), (3, 1500.0, "PROCESSING", 5), (4, -50.0, "PENDING", 2),
    (5, 100.0, "UNKNOWN", 1), (6, 75.0, "PENDING", 0), (7, 1500000.0, "PENDING", 1), (8, None, None, None),
]


def test_check_constraints(spark):
    df = spark.createDataFrame(CHECKED, "order_id int, total_amount double, order_status string, quantity int")
    rules = ts.CheckRules({
        "amount": "total_amount >= 0",
        "status": "order_status IN ('PENDING','PROCESSING','SHIPPED','DELIVERED','CANCELLED')",
        "quantity": F.col("quantity") > 0}).add("chk_reasonable_total", "total_amount < 1000000")
    good, bad = ts.check_constraints(df, rules)
    assert sorted(r["order_id"] for r in good.collect()) == [1, 2, 3, 8]
    assert {r["order_id"]: r["violated"] for r in bad.collect()} == {
        4: ["amount"], 5: ["status"], 6: ["quantity"], 7: ["chk_reasonable_total"]}
    assert ts.check_constraints(df, rules.drop("chk_reasonable_total"))[0].count() == 5
    with pytest.raises(ValueError):
        rules.add("amount", "true")


def test_length_rules(spark):
    df = spark.createDataFrame([("ab",), ("abc",), (None,)], "name string")
    good, bad = ts.check_constraints(df, ts.CheckRules(ts.length_rules({"name": 2})))
    assert good.count() == 2 and bad.first()["violated"] == ["name_length"]


def test_evolve_schema(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    more = T.StructType([*df.schema.fields, T.StructField("c", T.StringType())])
    assert ts.evolve_schema(df, more).first().asDict() == {"a": 1, "b": "x", "c": None}
    assert ts.evolve_schema(df, df.schema).columns == ["a", "b"]
    assert ts.evolve_schema(None, more, spark).count() == 0
    with pytest.raises(ValueError, match="removed"):
        ts.evolve_schema(df, T.StructType(df.schema.fields[:1]))
    with pytest.raises(ValueError, match="type"):
        ts.evolve_schema(df, T.StructType([T.StructField("a", T.StringType()), df.schema["b"]]))


def test_updates_deletes_and_partitions(spark, rows):
    df = spark.createDataFrame([(1, 100), (2, 200), (3, 300)], "partition_id int, value int")
    assert rows(ts.update_partitions(df, "partition_id", [1, 2, 3], "value", F.col("value") * 2)) == [
        (1, 200), (2, 400), (3, 600)]
    keys = spark.createDataFrame([(1,), (1,), (3,)], "partition_id int")
    assert rows(ts.update_where_in(df, "partition_id", keys, {"value": F.lit(0)})) == [(1, 0), (2, 200), (3, 0)]
    assert rows(ts.delete_where_in(df, "partition_id", keys, F.col("value") > 100)) == [(1, 100), (2, 200)]


def test_incremental_append_into_empty(spark):
    df = spark.createDataFrame([(1, date(2024, 1, 1)), (2, date(2024, 1, 2))], "id int, d date")
    assert ts.incremental_append(ts.truncate(df), df, "d").count() == 2
    assert ts.incremental_append(df, df, "d").count() == 2


def test_change_log(spark, rows):
    log = spark.createDataFrame([
        ("a", 1, datetime(2024, 1, 1), "INSERT", 10), ("b", 1, datetime(2024, 1, 1), "INSERT", 20),
        ("a", 2, datetime(2024, 1, 2), "UPDATE", 11), ("b", 3, datetime(2024, 1, 3), "DELETE", 20)],
        "k string, commit_seq long, ts timestamp, op string, v int")
    assert rows(ts.as_of(log, "k", "ts", "2024-01-01 12:00:00")) == [("a", 10), ("b", 20)]
    assert rows(ts.as_of(log, "k", "ts", "2024-01-05")) == [("a", 11)]
    lineage = ts.row_lineage(log, "k")
    assert rows(lineage) == [("a", 1, 2)]
    assert ts.changed_after(lineage, 2).count() == 0
