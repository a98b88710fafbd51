import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillwise.functions.ranking import dense_position, exact_quantiles, number_rows


def _skewed(spark, n=3000):
    """A third of the rows in one group, many equal values, zeros, negatives and NULLs."""
    rng = np.random.default_rng(3)
    group = np.where(np.arange(n) % 3 == 0, "hot", np.char.add("g", rng.integers(0, 5, n).astype(str)))
    value = np.round(rng.normal(0, 50, n), 2)
    value[rng.random(n) < 0.3] = 0.0
    pdf = pd.DataFrame({"id": rng.permutation(n).astype("int64") * 97, "g": group, "v": value})
    rows = [(int(i), str(g), None if k % 50 == 0 else float(v)) for k, (i, g, v) in
            enumerate(pdf.itertuples(index=False, name=None))]
    df = spark.createDataFrame(rows, "id long, g string, v double").withColumn("v", F.col("v").cast("decimal(12,2)"))
    return df, pd.DataFrame(rows, columns=["id", "g", "v"])


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("grouped", [True, False])
def test_number_rows_matches_a_window(spark, descending, grouped):
    df, _ = _skewed(spark)
    groups = ["g"] if grouped else []
    got = number_rows(df, "v", "id", groups, "pos", rank="rk", size="n", descending=descending)
    df.createOrReplaceTempView("skewed")
    part = "PARTITION BY g" if grouped else ""
    order = "v DESC NULLS FIRST" if descending else "v ASC NULLS LAST"
    want = spark.sql(f"""SELECT id, row_number() OVER ({part} ORDER BY {order}, id) AS pos,
        rank() OVER ({part} ORDER BY {order}) AS rk, count(*) OVER ({part}) AS n FROM skewed""")
    assert got.select("id", "pos", "rk", "n").exceptAll(want.select(
        "id", F.col("pos").cast("long"), F.col("rk").cast("long"), "n")).count() == 0
    assert got.count() == df.count()


def test_dense_position_has_no_gaps(spark):
    df = spark.range(0, 500).select((F.col("id") * 1009).alias("k"))
    got = [tuple(r) for r in dense_position(df, "k").orderBy("k").collect()]
    assert [p for _, p in got] == list(range(500))


def test_quantiles_match_numpy(spark):
    df, pdf = _skewed(spark)
    got = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", {"p50": 0.5, "p95": 0.95, "p0": 0.0, "p1": 1.0}, bins=16).collect()}
    for g, part in pdf.dropna().groupby("g"):
        for name, p in (("p50", 0.5), ("p95", 0.95), ("p0", 0.0), ("p1", 1.0)):
            assert got[g][name] == pytest.approx(np.quantile(part["v"], p), abs=1e-9)


def test_quantile_by_position_without_groups(spark):
    df, pdf = _skewed(spark)
    values = sorted(pdf["v"].dropna())
    row = exact_quantiles(df, [], "v", {"m": 0.5, "p99": 0.99}, method="lower_index", bins=8).first()
    assert row["m"] == pytest.approx(values[int(len(values) * 0.5)])
    assert row["p99"] == pytest.approx(values[int(len(values) * 0.99)])


def _largest(df, *keys):
    return df.groupBy(*keys).count().agg(F.max("count")).first()[0]


def test_one_outlier_does_not_fill_one_bin(spark):
    df = spark.range(20_000).select(
        F.lit("g").alias("g"), F.when(F.col("id") == 0, F.lit(1e9)).otherwise(F.col("id") / 1000).alias("v"))
    want = sorted([1e9] + [i / 1000 for i in range(1, 20_000)])
    got = exact_quantiles(df, ["g"], "v", {"p50": 0.5, "p99": 0.99}, method="lower_index", bins=64)
    row = got.first()
    assert row["p50"] == want[10_000] and row["p99"] == want[19_800]
    known = df.groupBy("g").agg(F.percentile_approx("v", F.array(*[F.lit(i / 64) for i in range(1, 64)]), F.lit(512)).alias("b"))
    binned = df.join(known, "g").select(F.size(F.filter("b", lambda x: x < F.col("v"))).alias("bin"))
    assert _largest(binned, "bin") < 20_000 / 64 * 3


@pytest.mark.parametrize("sparse", [1, 10**12])
def test_one_shared_value_and_sparse_ids_are_many_ranges(spark, sparse):
    df = spark.range(8000).select((F.col("id") * sparse).alias("id"), F.lit(1).alias("v")).repartition(4)
    ranged = df.repartitionByRange(4, F.desc_nulls_first("v"), F.asc("id")).withColumn("p", F.spark_partition_id())
    assert _largest(ranged, "p") < 3000
    out = number_rows(df, "v", "id", position="pos", rank="rk").agg(
        F.count_distinct("pos"), F.max("pos"), F.max("rk"), F.count_if(F.col("pos") != F.col("id") / F.lit(sparse) + 1)).first()
    assert tuple(out) == (8000, 8000, 1, 0)
