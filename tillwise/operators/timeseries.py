"""Gap filling and interpolation of irregular time series.

A series key may own a large share of all rows, so no step orders a whole series in
one task: rows are ordered inside (key, chunk of time) only, and values cross a chunk
border through a summary of one row per chunk.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.semantics import day_lit

_MICROS = 1_000_000
STEPS_PER_CHUNK = 1024


def _micros(step: timedelta) -> int:
    return int(step / timedelta(microseconds=1))


def bucket_start(ts: str, step: timedelta) -> Column:
    """Start of the step a timestamp falls in, aligned to the epoch."""
    n = F.lit(_micros(step))
    return F.timestamp_micros(F.floor(F.unix_micros(ts) / n).cast("long") * n)


def resample(df: DataFrame, ts: str, step: timedelta, keys: Sequence[str] = (), metadata: bool = False) -> DataFrame:
    """Original rows plus a row at every step of a series that has no row there.

    Steps run from the first to the last bucket of each key. Generated rows hold NULL
    values. With ``metadata`` the result carries ``is_generated`` and ``bucket_start``.
    """
    keys = list(keys)
    width = _micros(step)
    chunk = width * STEPS_PER_CHUNK
    first = F.floor(F.unix_micros(F.min(ts)) / F.lit(width)).cast("long") * width
    last = F.floor(F.unix_micros(F.max(ts)) / F.lit(width)).cast("long") * width
    ranges = df.filter(F.col(ts).isNotNull()).groupBy(*keys).agg(first.alias("__lo"), last.alias("__hi"))
    # Two levels of sequences keep every array short, however long a series is.
    grid = (
        ranges.filter(F.col("__lo").isNotNull())
        .select(*keys, "__hi", F.explode(F.sequence("__lo", "__hi", F.lit(chunk))).alias("__from"))
        .select(*keys, F.explode(F.sequence(
            "__from", F.least(F.col("__hi"), F.col("__from") + F.lit(chunk - width)), F.lit(width))).alias("__at"))
        .select(*keys, F.timestamp_micros("__at").alias(ts))
    )
    missing = grid.join(df.select(*keys, ts).distinct(), [*keys, ts], "left_anti")
    generated = missing.select(*[
        F.col(f.name) if f.name in (*keys, ts) else F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema])
    out = df.withColumn("is_generated", F.lit(False)).unionByName(generated.withColumn("is_generated", F.lit(True)))
    if not metadata:
        return out.drop("is_generated")
    return out.withColumn("bucket_start", bucket_start(ts, step))


def interpolate(df: DataFrame, ts: str, keys: Sequence[str], columns: Sequence[str], method: str,
                suffix: str | None = None, chunk: timedelta = timedelta(days=1)) -> DataFrame:
    """Fill NULLs of a series: ``ffill``, ``bfill`` or ``linear`` (weighted by time)."""
    if method not in ("ffill", "bfill", "linear"):
        raise ValueError(f"unknown method {method!r}")
    keys = list(keys)
    size = F.lit(_micros(chunk))
    marked = df.withColumn("__chunk", F.floor(F.unix_micros(ts) / size).cast("long"))
    # Looking ahead is looking back in the reverse order: a frame that starts at the current row and
    # is open at its end is walked anew for every row, one that is open at its start only once.
    inside = Window.partitionBy(*keys, "__chunk").orderBy(F.col(ts).asc(), *[F.col(c).asc_nulls_first() for c in columns])
    inside_back = Window.partitionBy(*keys, "__chunk").orderBy(
        F.col(ts).desc(), *[F.col(c).desc_nulls_last() for c in columns])
    across = Window.partitionBy(*keys).orderBy(F.col("__chunk").asc())
    across_back = Window.partitionBy(*keys).orderBy(F.col("__chunk").desc())
    need_prev, need_next = method != "bfill", method != "ffill"

    def known(c):
        return F.when(F.col(c).isNotNull(), F.struct(F.col(ts).alias("t"), F.col(c).alias("v")))

    summary = marked.groupBy(*keys, "__chunk").agg(
        *[F.max(known(c)).alias(f"__last_{c}") for c in columns if need_prev],
        *[F.min(known(c)).alias(f"__first_{c}") for c in columns if need_next])
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    after = across_back.rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.select(
        *keys, "__chunk",
        *[F.last(f"__last_{c}", True).over(before).alias(f"__in_{c}") for c in columns if need_prev],
        *[F.last(f"__first_{c}", True).over(after).alias(f"__out_{c}") for c in columns if need_next])
    joined = marked.join(carried, [*keys, "__chunk"])
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    onward = inside_back.rowsBetween(Window.unboundedPreceding, 0)
    filled = {}
    for c in columns:
        prev = F.coalesce(F.last(known(c), True).over(upto), F.col(f"__in_{c}")) if need_prev else None
        nxt = F.coalesce(F.last(known(c), True).over(onward), F.col(f"__out_{c}")) if need_next else None
        if need_prev:
            joined = joined.withColumn(f"__p_{c}", prev)
        if need_next:
            joined = joined.withColumn(f"__n_{c}", nxt)
        filled[c] = _value(c, ts, method)
    names = {c: f"{c}_{suffix}" if suffix else c for c in columns}
    out = joined.select(
        *[F.col(c) for c in df.columns if c not in names.values()],
        *[filled[c].alias(names[c]) for c in columns])
    return out.select(*df.columns, *[n for n in names.values() if n not in df.columns])


def _value(c: str, ts: str, method: str) -> Column:
    if method == "ffill":
        return F.col(f"__p_{c}.v")
    if method == "bfill":
        return F.col(f"__n_{c}.v")
    p, n = f"__p_{c}", f"__n_{c}"
    t0, t1 = F.unix_micros(f"{p}.t"), F.unix_micros(f"{n}.t")
    weight = (F.unix_micros(ts) - t0).cast("double") / (t1 - t0).cast("double")
    # The original value ends the CASE first, so a zero time span is never divided.
    return F.when(F.col(c).isNotNull(), F.col(c).cast("double")).when(
        t1 > t0, F.col(f"{p}.v").cast("double")
        + (F.col(f"{n}.v").cast("double") - F.col(f"{p}.v").cast("double")) * weight)


def resample_fill(df: DataFrame, ts: str, step: timedelta, keys: Sequence[str], columns: Sequence[str],
                  method: str = "linear") -> DataFrame:
    """Gap-filled series with interpolated values and the ``is_generated`` flag."""
    grid = resample(df, ts, step, keys, metadata=True).drop("bucket_start")
    return interpolate(grid, ts, keys, columns, method)


def uniform_rows(resampled: DataFrame, ts: str) -> DataFrame:
    """Rows that lie exactly on a step."""
    return resampled.filter(F.col(ts) == F.col("bucket_start"))


def generated_rows(resampled: DataFrame) -> DataFrame:
    return resampled.filter("is_generated")


def daily_orders_filled(orders: DataFrame, start: date | str | None = None, end: date | str | None = None) -> DataFrame:
    """Orders and revenue per day, with a zero row for days without orders."""
    picked = orders
    if start is not None:
        picked = picked.filter(F.col("order_date") >= day_lit(start))
    if end is not None:
        picked = picked.filter(F.col("order_date") < day_lit(end))
    per_day = picked.groupBy(F.date_trunc("day", "order_date").alias("order_day")).agg(
        F.count("*").alias("order_count"), F.sum("total_amount").alias("daily_revenue"))
    return resample(per_day, "order_day", timedelta(days=1), metadata=True).drop("bucket_start").withColumn(
        "orders_filled", F.coalesce("order_count", F.lit(0)))
