from datetime import date

from pyspark.sql import functions as F

from tillwise.functions import semantics as sem


def _one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def _d(text):
    return F.lit(text).cast("timestamp")


def test_dates(spark):
    assert _one(spark, sem.day_of_week(_d("2024-01-07")), sem.day_of_week(_d("2024-01-06"))) == (0, 6)
    assert _one(spark, sem.month_steps(_d("2024-01-31"), _d("2024-02-01")), sem.month_steps(_d("2024-03-01"), _d("2023-12-31"))) == (1, -3)
    assert _one(spark, sem.days_between(_d("2024-01-01 23:00:00"), _d("2024-01-02 01:00:00"))) == (1,)
    assert _one(spark, sem.days_before("2024-03-01", 1)) == (date(2024, 2, 29),)


def test_nulls_and_division(spark):
    null = F.lit(None).cast("int")
    assert _one(spark, sem.strict_greatest(F.lit(1), null), sem.strict_least(F.lit(1), F.lit(2))) == (None, 1)
    assert _one(spark, sem.ratio(F.lit(1), F.lit(0)), sem.ratio(F.lit(1), F.lit(4))) == (None, 0.25)
    assert [float(x) for x in _one(spark, sem.rounded_ratio(F.lit(5), F.lit(2), 0), sem.rounded_ratio(F.lit(-1), F.lit(8), 2))] == [3.0, -0.13]


def test_ladders_and_ranks(spark):
    v = F.lit(15)
    assert _one(spark, sem.at_least(v, [(20, "a"), (10, "b")], "c"), sem.at_most(v, [(10, "x"), (20, "y")], "z")) == ("b", "y")
    assert _one(spark, sem.rank_of(F.lit("High"), ["Urgent", "High"]), sem.rank_of(F.lit("?"), ["Urgent", "High"])) == (2, 3)


def test_mean_ignores_nulls_and_empty(spark):
    df = spark.createDataFrame([(1.0,), (None,), (2.0,)], "v double")
    assert df.agg(sem.mean("v")).first()[0] == 1.5
    assert df.filter("false").agg(sem.mean("v")).first()[0] is None
