"""Positions, ranks and quantiles over groups too large for one task.

A window without a partition key, or with one that a third of the rows share,
would sort the whole group in a single task. These helpers cut each group into
ordered buckets first, number rows inside the buckets, and add the count of the
buckets before; only the short list of buckets is ever ordered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.session import cut_lineage


def number_rows(df: DataFrame, value: str, tie: str, groups: Sequence[str] = (),
                position: str = "position", rank: str | None = None,
                size: str | None = None, descending: bool = True) -> DataFrame:
    """``row_number`` (and optionally ``rank`` and group size) by value, then ``tie``.

    ``tie`` is unique and always ascends. NULL counts as the largest value. Rows are dealt
    to ranges of (groups, value, tie), whose bounds Spark draws from the data: a group, or one
    value that many rows share, is as many ranges as it needs. The ranged rows are
    written once, so that counts and positions see the same ranges.
    """
    part, n, before, first = "__part", "__n", "__before", "__first"
    order = [F.col(value).desc_nulls_first() if descending else F.col(value).asc_nulls_last(), F.col(tie).asc()]
    ranged = df.repartitionByRange(*[F.asc_nulls_first(g) for g in groups], *order).withColumn(part, F.spark_partition_id())
    ranged = cut_lineage(df.sparkSession, ranged)
    counts = ranged.groupBy(*groups, part).agg(F.count("*").alias(n))
    run = Window.partitionBy(*groups).orderBy(part).rowsBetween(Window.unboundedPreceding, 0)
    kept = [part, (F.sum(n).over(run) - F.col(n)).alias(before)]
    if size:
        kept.append(F.sum(n).over(Window.partitionBy(*groups)).alias(size))
    joined = _join_null_safe(ranged, counts.select(*groups, *kept), [*groups, part])
    inside = Window.partitionBy(*groups, part).orderBy(*order)
    out = joined.withColumn(position, F.row_number().over(inside) + F.col(before)).drop(before, part)
    if rank:
        ties = out.groupBy(*groups, value).agg(F.min(position).alias(first))
        out = _join_null_safe(out, ties, [*groups, value]).withColumnRenamed(first, rank)
    return out


def _join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    names = {k: f"__r_{k}" for k in keys}
    r = right.withColumnsRenamed(names)
    cond = None
    for k, rk in names.items():
        test = F.col(k).eqNullSafe(F.col(rk))
        cond = test if cond is None else cond & test
    return left.join(r, cond).drop(*names.values())


def dense_position(df: DataFrame, key: str, position: str = "position") -> DataFrame:
    """0-based position of each row by a unique key of any type, however sparse its values."""
    out = number_rows(df, key, key, position=position, descending=False)
    return out.withColumn(position, F.col(position) - F.lit(1))


def exact_quantiles(df: DataFrame, groups: Sequence[str], value: str, probs: dict[str, float],
                    method: str = "linear", bins: int = 1024) -> DataFrame:
    """Exact quantiles per group without sorting a group in one task.

    1. equal values collapse to (value, count) before any wide step;
    2. up to ``bins`` approximate quantiles per group cut the values into bins of like
       numbers of rows, wherever outliers lie, and locate for every wanted rank the
       one bin it falls in;
    3. only the rows of those bins are ordered.

    ``method`` is ``linear`` (interpolated) or ``lower_index`` (the value at the
    0-based position ``floor(n * p)``).
    """
    g = list(groups)
    known = df.filter(F.col(value).isNotNull())
    counts = known.groupBy(*g, value).agg(F.count("*").alias("__c"))
    steps = max(1, bins.bit_length() - 1)
    cuts = F.array(*[F.lit((i + 1) / (1 << steps)) for i in range((1 << steps) - 1)])
    bounds = known.groupBy(*g).agg(
        F.percentile_approx(value, cuts, F.lit(8 << steps)).alias("__bounds"), F.count("*").alias("__total"))

    # How many bounds lie below the value, by halving.
    halves = F.array(*[F.lit(1 << i) for i in reversed(range(steps))])
    at = F.aggregate(halves, F.lit(0), lambda low, half: F.when(
        F.get("__bounds", low + half - F.lit(1)) < F.col(value), low + half).otherwise(low))
    binned = _with_bounds(counts, bounds, g).withColumn("__bin", at).drop("__bounds")
    hist = binned.groupBy(*g, "__bin").agg(F.sum("__c").alias("__bc"))
    run = Window.partitionBy(*g).orderBy("__bin").rowsBetween(Window.unboundedPreceding, 0)
    hist = (
        _with_bounds(hist, bounds.select(*g, "__total"), g)
        .withColumn("__upto", F.sum("__bc").over(run))
        .withColumn("__before", F.col("__upto") - F.col("__bc"))
    )
    wanted = []
    for name, p in probs.items():
        if method == "linear":
            pos = F.lit(p) * (F.col("__total") - F.lit(1)).cast("double")
            lo, hi = F.floor(pos), F.ceil(pos)
            frac = pos - lo
        else:
            lo = F.least(F.floor(F.col("__total").cast("double") * F.lit(p)), F.col("__total") - F.lit(1))
            hi, frac = lo, F.lit(0.0)
        wanted.append(F.struct(
            F.lit(name).alias("q"), lo.cast("long").alias("lo"), hi.cast("long").alias("hi"),
            frac.alias("frac")))
    # One row per group, wanted quantile and bin that holds one of its two ranks.
    targets = (
        hist.withColumn("__w", F.explode(F.array(*wanted)))
        .filter(((F.col("__w.lo") >= F.col("__before")) & (F.col("__w.lo") < F.col("__upto")))
                | ((F.col("__w.hi") >= F.col("__before")) & (F.col("__w.hi") < F.col("__upto"))))
        .select(*g, "__bin", "__before", "__w")
    )
    needed = targets.groupBy(*g, "__bin").agg(
        F.first("__before").alias("__before"), F.collect_list("__w").alias("__ws"))
    inside = Window.partitionBy(*g, "__bin").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    rows = (
        binned.select(*g, "__bin", value, "__c").join(needed, [*g, "__bin"])
        .withColumn("__end", F.sum("__c").over(inside) + F.col("__before"))
        .withColumn("__start", F.col("__end") - F.col("__c"))
        .withColumn("__w", F.explode("__ws"))
    )
    has_lo = (F.col("__w.lo") >= F.col("__start")) & (F.col("__w.lo") < F.col("__end"))
    has_hi = (F.col("__w.hi") >= F.col("__start")) & (F.col("__w.hi") < F.col("__end"))
    picked = rows.filter(has_lo | has_hi).groupBy(*g, F.col("__w.q").alias("__q")).agg(
        F.max(F.when(has_lo, F.col(value))).cast("double").alias("__vlo"),
        F.max(F.when(has_hi, F.col(value))).cast("double").alias("__vhi"),
        F.first("__w.frac").alias("__frac"))
    final = picked.withColumn("__v", F.col("__vlo") + (F.col("__vhi") - F.col("__vlo")) * F.col("__frac"))
    return final.groupBy(*g).agg(
        *[F.max(F.when(F.col("__q") == F.lit(name), F.col("__v"))).alias(name) for name in probs])


def _with_bounds(df: DataFrame, bounds: DataFrame, groups: list[str]) -> DataFrame:
    if groups:
        return df.join(bounds, groups)
    # No group: the bounds are one row, read through scalar subqueries.
    for name in bounds.columns:
        df = df.withColumn(name, bounds.select(name).scalar())
    return df
