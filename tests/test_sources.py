import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise import schemas
from tillwise.sources import external, files

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()),
                       T.StructField("price", T.DecimalType(10, 2)), T.StructField("day", T.DateType())])


def test_lenient_csv(spark, folder, rows):
    with open(os.path.join(folder, "a.csv"), "w") as f:
        f.write('id,name,price,day\n1,"Smith, J",2.50,2024-01-01\n2,NULL,,2024-01-02\n3,short\n'
                '4,extra,1.00,2024-01-03,surplus\nx,bad,1.00,2024-01-03\n6,None,abc,2024-13-01\n')
    good, bad = files.load_csv(spark, folder, SCHEMA)
    got = {r["id"]: (r["name"], None if r["price"] is None else float(r["price"]), str(r["day"])) for r in good.collect()}
    assert got == {1: ("Smith, J", 2.5, "2024-01-01"), 2: (None, None, "2024-01-02"), 3: ("short", None, "None"),
                   4: ("extra", 1.0, "2024-01-03")}
    assert {r["id"]: r["broken_columns"] for r in bad.collect()} == {"x": ["id"], "6": ["price", "day"]}


def test_partitioned_write_prunes(spark, tables, folder):
    path = f"{folder}/orders"
    files.write_partitioned(tables.orders, path, "order_date")
    df = files.partition_revenue(spark, path, 1998, 3)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    want = tables.orders.filter("year(order_date) = 1998 AND month(order_date) = 3").count()
    assert df.first()["order_count"] == want
    assert os.path.isdir(f"{path}/year=1998/month=3")


def test_versions_switch_only_when_complete(spark, folder):
    root = f"{folder}/t"
    assert files.read_current(spark, root) is None
    files.write_version(spark.range(3), root)
    files.write_version(spark.range(5), root)
    os.makedirs(f"{root}/version=3")  # an unfinished write
    assert files.read_current(spark, root).count() == 5
    assert files.read_version(spark, root, 1).count() == 3


def test_lake_keeps_microseconds(spark, folder):
    df = spark.sql("SELECT timestamp'2024-01-01 00:00:00.123456' AS t")
    files.export_lake(df, f"{folder}/lake")
    assert files.read_lake(spark, f"{folder}/lake").first()["t"].microsecond == 123456


def test_samples(tables):
    a = {r[0] for r in files.sample_n(tables.customers, 10, "customer_id").select("customer_id").collect()}
    b = {r[0] for r in files.sample_n(tables.customers.repartition(7), 10, "customer_id").select("customer_id").collect()}
    assert a == b and len(a) == 10
    s = files.consistent_sample(tables.customers, tables.orders, tables.order_items, 10)
    assert s["orders"].count() == tables.orders.filter(F.col("customer_id").isin(*a)).count()
    shards = files.range_partition(tables.customers.filter("customer_id > 0"), 7).groupBy("shard").count()
    assert shards.count() == 7


def test_external_rows(spark, rows):
    df = spark.sql("SELECT 1 AS id, date'2024-01-02' AS d, cast(1.50 AS decimal(5,2)) AS p, cast(null AS string) AS n")
    spec = {"id": ("$.id", "int"), "d": ("$.d", "string"), "p": ("$.p", "double"), "n": ("$.n", "string")}
    assert rows(external.project_variant(external.rows_as_variant(df), "result", spec)) == [(1, "2024-01-02", 1.5, None)]
    assert rows(external.project_variant(external.rows_as_json(df), "result", spec, parse=True)) == [(1, "2024-01-02", 1.5, None)]
    with pytest.raises(ValueError, match="partitionColumn"):
        external.read_external(spark, "jdbc", {"url": "jdbc:x", "dbtable": "t"})


def test_inline_values_and_rows(spark):
    assert files.values(spark, [(1, "a")], "id int, name string").count() == 1
