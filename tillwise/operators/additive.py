"""Daily figures that add up: exact distinct counts as bitmaps, quantiles as sketches.

A distinct count of a month is no sum of daily counts, and a month's p95 no mean of daily
ones. Stored per day as bitmaps and mergeable sketches, both come from the days alone,
without reading the facts again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size parameter of the quantile sketch; a quantile's rank is off by less than 0.4 % in 99 of 100 sketches.
SKETCH_K = 800
#: Stated bound of the rank error.
RANK_ERROR = 0.01


# --- distinct counts ------------------------------------------------------------------------

def distinct_bitmaps(facts: DataFrame, day: str, ident: str, by: Sequence[str] = ()) -> DataFrame:
    """(day, *by, block, bitmap): ids of a day in bitmaps of 64 consecutive ids each, a 64-bit number.

    ``ident`` is an integer id, negative ones included; a null day or id is left out. Only
    a bitmap per (day, group, block) crosses the shuffle, however often an id occurs. Blocks
    are narrow since a day holds few of all ids: there are never more bitmaps than ids.
    """
    rows = facts.filter(F.col(ident).isNotNull() & F.col(day).isNotNull())
    number = F.col(ident).cast("long")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), number.bitwiseAND(63).cast("int"))
    return rows.groupBy(F.col(day).alias("day"), *by, F.shiftright(number, 6).alias("block")).agg(
        F.bit_or(bit).alias("bitmap"))


def distinct_over(bitmaps: DataFrame, period: Column, name: str = "period", by: Sequence[str] = ()) -> DataFrame:
    """(period, *by, ids): exact distinct ids per period of stored days, such as a week or month.

    ``by`` may name fewer groups than the bitmaps are stored for: they are merged.
    """
    merged = bitmaps.groupBy(period.alias(name), *by, "block").agg(F.bit_or("bitmap").alias("bitmap"))
    return merged.groupBy(name, *by).agg(F.sum(F.bit_count("bitmap")).alias("ids"))


# --- quantiles ------------------------------------------------------------------------------

def quantile_sketches(facts: DataFrame, day: Column, value: str, by: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """(day, *by, n, sketch): a sketch of each day's values, of bounded size; null values and days are left out."""
    rows = facts.filter(F.col(value).isNotNull()).withColumn("day", day).filter(F.col("day").isNotNull())
    number = F.col(value).cast("double")
    return rows.groupBy("day", *by).agg(F.count("*").alias("n"), F.kll_sketch_agg_double(number, F.lit(k)).alias("sketch"))


def quantiles_over(sketches: DataFrame, period: Column, ranks: Sequence[float], name: str = "period",
                   by: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """(period, *by, n, q<rank in percent>): quantiles per period from stored days, within ``RANK_ERROR`` of the rank."""
    merged = sketches.groupBy(period.alias(name), *by).agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))
    return merged.select(name, *by, "n", *[
        F.kll_sketch_get_quantile_double("sketch", F.lit(float(r))).alias(f"q{round(r * 100)}") for r in ranks])
