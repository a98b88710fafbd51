import pytest
from pyspark.sql import functions as F

from tillwise.sources import layout


@pytest.mark.parametrize(("axes", "bits"), [(2, 4), (3, 2)])
def test_curve_visits_every_point_step_by_step(spark, axes, bits):
    side = 1 << bits
    df = spark.range(side ** axes).select(*[
        (F.floor(F.col("id") / side ** i) % side).alias(f"x{i}") for i in range(axes)])
    points = df.withColumn("at", layout.hilbert_index([F.col(f"x{i}") for i in range(axes)], bits)).orderBy("at").collect()
    assert [p["at"] for p in points] == list(range(side ** axes))
    for p, q in zip(points, points[1:]):
        assert sum(abs(p[i] - q[i]) for i in range(axes)) == 1


def test_either_key_reads_few_files(spark, folder):
    df = spark.range(20_000).select(
        "id", (F.xxhash64("id") % 5000).alias("customer"), F.timestamp_seconds(F.pmod(F.xxhash64(F.col("id") + 7), F.lit(10 ** 8))).alias("at"))
    # One customer owns a third of all rows.
    df = df.withColumn("customer", F.when(F.col("id") % 3 == 0, 17).otherwise(F.col("customer"))).cache()
    layout.write_layout(df, ["customer", "at"], folder, 64)
    ranges = spark.read.parquet(f"{folder}/ranges")
    assert ranges.count() > 50 and ranges.agg(F.sum("rows")).first()[0] == 20_000
    moment = df.filter("customer = 1234").select("at").first()[0] if df.filter("customer = 1234").count() else df.first()["at"]
    for col, low in (("customer", 1234), ("customer", -3000), ("at", moment)):
        got = layout.read_between(spark, folder, col, low, low)
        want = df.filter(F.col(col) == F.lit(low))
        assert got.count() == want.count() and got.exceptAll(want).count() == 0
        assert layout.files_between(spark, folder, col, low, low).count() <= 64 / 4
        assert len(got.inputFiles()) <= 64 / 4


def test_odd_tables(spark, folder):
    df = spark.createDataFrame([(1, None), (None, 2.0), (3, float("nan")), (3, 4.0)], "a int, b double")
    layout.write_layout(df, ["a", "b"], folder, 2)
    assert spark.read.parquet(f"{folder}/rows").count() == 4
    assert layout.read_between(spark, folder, "a", 3, 3).count() == 2
    assert layout.read_between(spark, folder, "a", 50, 60).count() == 0
    layout.write_layout(df.limit(0), ["a", "b"], f"{folder}/empty", 2)
    assert layout.read_between(spark, f"{folder}/empty", "a", 1, 3).count() == 0
