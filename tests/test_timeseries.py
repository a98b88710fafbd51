from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tillwise.operators import timeseries as ts

READINGS = [
    ("2025-01-15 09:00:00", 68.0, 45.0, "A"), ("2025-01-15 09:17:00", 70.2, 44.5, "A"),
    ("2025-01-15 09:30:00", 72.5, 43.0, "A"), ("2025-01-15 10:00:00", 75.0, 41.0, "A"),
    ("2025-01-15 09:00:00", 65.0, 50.0, "B"), ("2025-01-15 09:30:00", 66.5, 48.0, "B"),
    ("2025-01-15 09:45:00", 67.0, 47.0, "B"),
]
# (sensor, time, generated, ffill, bfill, linear)
GOLDEN = [
    ("A", "09:00", False, 68.0, 68.0, 68.0), ("A", "09:15", True, 68.0, 70.2, 68 + 2.2 * 15 / 17),
    ("A", "09:17", False, 70.2, 70.2, 70.2), ("A", "09:30", False, 72.5, 72.5, 72.5),
    ("A", "09:45", True, 72.5, 75.0, 73.75), ("A", "10:00", False, 75.0, 75.0, 75.0),
    ("B", "09:00", False, 65.0, 65.0, 65.0), ("B", "09:15", True, 65.0, 66.5, 65.75),
    ("B", "09:30", False, 66.5, 66.5, 66.5), ("B", "09:45", False, 67.0, 67.0, 67.0),
]
STEP = timedelta(minutes=15)


@pytest.fixture
def sensors(spark):
    rows = [(datetime.fromisoformat(t), a, b, s) for t, a, b, s in READINGS]
    return spark.createDataFrame(rows, "observed timestamp, temperature double, humidity double, sensor string")


@pytest.mark.parametrize("chunk", [timedelta(days=1), timedelta(minutes=20), timedelta(minutes=1)])
def test_sensor_golden(sensors, chunk):
    """Results do not depend on how a series is cut into chunks."""
    grid = ts.resample(sensors, "observed", STEP, ["sensor"], metadata=True)
    for place, method in ((3, "ffill"), (4, "bfill"), (5, "linear")):
        got = ts.interpolate(grid, "observed", ["sensor"], ["temperature"], method, "x", chunk).orderBy(
            "sensor", "observed").collect()
        assert [(r["sensor"], r["observed"].strftime("%H:%M"), r["is_generated"]) for r in got] == [g[:3] for g in GOLDEN]
        assert [r["temperature_x"] for r in got] == pytest.approx([g[place] for g in GOLDEN])


def test_originals_are_kept_and_uniform_rows_filtered(sensors):
    grid = ts.resample(sensors, "observed", STEP, ["sensor"], metadata=True)
    assert grid.filter("not is_generated").count() == len(READINGS)
    uniform = ts.uniform_rows(grid, "observed").collect()
    assert datetime(2025, 1, 15, 9, 17) not in [r["observed"] for r in uniform]
    assert len(uniform) == len(GOLDEN) - 1
    assert ts.generated_rows(grid).count() == 3


def test_long_series_uses_short_arrays(spark, monkeypatch):
    """A series of many chunks has every step exactly once."""
    monkeypatch.setattr(ts, "STEPS_PER_CHUNK", 16)
    ends = [(datetime(2024, 1, 1), 1.0), (datetime(2024, 1, 3, 0, 7), 2.0)]
    df = spark.createDataFrame(ends, "t timestamp, v double")
    grid = ts.resample(df, "t", STEP)
    # 193 steps, the first of which is an original row, and the irregular last row.
    assert grid.count() == 194
    assert grid.select("t").distinct().count() == 194


def test_two_columns_and_daily_fill(sensors, spark):
    filled = ts.resample_fill(sensors, "observed", STEP, ["sensor"], ["temperature", "humidity"])
    assert filled.filter("temperature IS NULL OR humidity IS NULL").count() == 0
    orders = spark.createDataFrame(
        [(datetime(2025, 1, 1, 5), 10), (datetime(2025, 1, 3, 9), 20), (datetime(2025, 2, 3), 99)],
        "order_date timestamp, total_amount int")
    days = ts.daily_orders_filled(orders, "2025-01-01", "2025-02-01").orderBy("order_day").collect()
    assert [(r["orders_filled"], r["is_generated"]) for r in days] == [(1, False), (0, True), (1, False)]


@pytest.mark.parametrize("method", ["bfill", "linear"])
def test_looking_ahead_walks_no_frame_anew_for_every_row(sensors, method):
    """A frame open at its end takes time with the square of a chunk's rows."""
    filled = ts.interpolate(sensors, "observed", ["sensor"], ["temperature"], method)
    plan = filled._jdf.queryExecution().optimizedPlan().toString()
    assert "unboundedpreceding" in plan and "unboundedfollowing" not in plan


def test_rows_of_one_time_and_gaps_longer_than_a_chunk(spark):
    """Known and unknown values at one time, and borders no chunk between which has a value."""
    at = [datetime(2025, 1, d) for d in (1, 2, 2, 2, 3, 4, 9)]
    df = spark.createDataFrame(list(zip("aaaaaaa", at, [None, 5.0, None, 3.0, None, None, 7.0])), "k string, t timestamp, v double")

    def got(method):
        out = ts.interpolate(df, "t", ["k"], ["v"], method, "x").orderBy("t", F.col("v").asc_nulls_first())
        return [r["v_x"] for r in out.collect()]

    assert got("ffill") == [None, None, 3.0, 5.0, 5.0, 5.0, 7.0]
    assert got("bfill") == [3.0, 3.0, 3.0, 5.0, 7.0, 7.0, 7.0]
    assert got("linear") == pytest.approx([None, None, 3.0, 5.0, 5 + 2 / 7, 5 + 4 / 7, 7.0])
