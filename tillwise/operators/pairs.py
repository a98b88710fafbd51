"""Customer x product combinations without a cross join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 1024


def combinations_not_in(left: DataFrame, left_key: str, right: DataFrame, right_key: str,
                        known: DataFrame, block: int = BLOCK) -> DataFrame:
    """Rows of ``left`` with every right key that ``known`` does not hold for them.

    Right keys are spread over blocks of about ``block`` keys, and the known pairs are
    packed per (left key, block). A left row visits the blocks by number and drops the
    known keys inside the row, so what is shuffled is one row per visit and not one per
    pair, and no array grows with the data. ``left`` must hold each key once; its other
    columns are carried along.
    """
    keys = right.select(right_key).distinct()
    blocks = keys.agg(F.greatest(F.ceil(F.count("*") / F.lit(block)), F.lit(1)).cast("long")).scalar()

    def block_of(key: Column) -> Column:
        return F.pmod(F.xxhash64(key), blocks)

    packed = keys.groupBy(block_of(F.col(right_key)).alias("__b")).agg(F.collect_list(right_key).alias("__ks"))
    held = known.select(left_key, right_key).groupBy(
        left_key, block_of(F.col(right_key)).alias("__b")).agg(F.collect_set(right_key).alias("__held"))
    visits = left.withColumn("__b", F.explode(F.sequence(F.lit(0).cast("long"), blocks - F.lit(1))))
    kept = F.when(F.col("__held").isNull(), F.col("__ks")).otherwise(F.array_except("__ks", "__held"))
    return visits.join(held, [left_key, "__b"], "left").join(packed, "__b").select(
        *left.columns, F.explode(kept).alias(right_key))
