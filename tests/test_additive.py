from datetime import date, timedelta

import numpy as np
from pyspark.sql import functions as F

from tillwise.operators import additive as ad


def test_distinct_ids_from_days(spark, folder):
    rng = np.random.default_rng(2)
    rows = [(date(2020, 1, 1) + timedelta(int(d)), int(i), g) for d, i, g in zip(
        rng.integers(0, 90, 4000), rng.integers(-40_000, 70_000, 4000) // 37, rng.choice(["a", "b"], 4000))]
    rows += rows[:500] + [(None, 1, "a"), (date(2020, 1, 1), None, "a")]
    df = spark.createDataFrame(rows, "day date, id long, g string")
    ad.distinct_bitmaps(df, "day", "id", ["g"]).write.parquet(f"{folder}/days")
    days = spark.read.parquet(f"{folder}/days")
    want = {}
    for d, i, g in rows:
        if d and i is not None:
            want.setdefault((d.month, g), set()).add(i)
    got = {(r["m"], r["g"]): r["ids"] for r in ad.distinct_over(days, F.month("day"), "m", ["g"]).collect()}
    assert got == {k: len(v) for k, v in want.items()}
    whole = ad.distinct_over(days, F.month("day"), "m")
    assert {r["m"]: r["ids"] for r in whole.collect()} == {m: len(want[m, "a"] | want[m, "b"]) for m in (1, 2, 3)}
    assert folder in str(whole.inputFiles()) and len(whole.inputFiles()) == len(days.inputFiles())
    assert ad.distinct_over(days.limit(0), F.month("day"), "m").count() == 0


def test_days_with_few_ids_take_few_bytes(spark):
    """Ids far apart, and the ends of their range: a bitmap is no larger than the id."""
    ids = [(i * 40_000, i % 3) for i in range(-300, 300)] + [(2**63 - 1, 0), (-2**63, 0), (-1, 0), (-64, 0), (-65, 0)]
    df = spark.createDataFrame(ids, "id long, d int").selectExpr("id", "date_add(DATE '2020-01-01', d) AS day")
    days = ad.distinct_bitmaps(df, "day", "id")
    assert dict(days.dtypes)["bitmap"] == "bigint" and days.count() == len(ids) - 1  # -1 and -64 share one
    assert ad.distinct_over(days, F.lit(1)).first()["ids"] == len(ids)
    assert "SortAggregate" not in days._jdf.queryExecution().toString()


def test_quantiles_from_days_are_within_the_rank_error(spark):
    df = spark.range(200_000).select(F.expr("date_add(DATE '2020-01-01', cast(id % 60 AS int))").alias("day"),
                                     (F.pmod(F.xxhash64("id"), F.lit(1_000_000)) / 7).alias("v"))
    odd = df.unionByName(spark.createDataFrame([(date(2020, 1, 1), None), (None, 1.0)], "day date, v double"))
    sketches = ad.quantile_sketches(odd, F.col("day"), "v")
    assert sketches.count() == 60 and sketches.agg(F.max(F.length("sketch"))).first()[0] < 40_000
    r = ad.quantiles_over(sketches, F.lit(1), [0.05, 0.5, 0.95]).first()
    assert r["n"] == 200_000
    for q, rank in (("q5", 0.05), ("q50", 0.5), ("q95", 0.95)):
        assert abs(df.filter(F.col("v") <= r[q]).count() / 200_000 - rank) <= ad.RANK_ERROR
