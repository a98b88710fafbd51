"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word: a longest run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of these operators: small Arrow batches, hot join keys split."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1024")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


@functools.cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="tillwise-")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share; a local one only in a session on one machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _own_folder()


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here.

    Lost executors cost no recomputation of what came before.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucket_of(h: Column, bits: int) -> Column:
    """Monotone bucket of a 64-bit hash."""
    return F.shiftright(h, 64 - bits).cast("int")


def running(df: DataFrame, keys: Sequence[str], h: str, ties: Sequence[str] = (),
            value: str | None = None, out: str = "before", bits: int = 12) -> DataFrame:
    """Add the number of rows (or the sum of ``value``) before each row of its group.

    A group is ordered by the 64-bit hash ``h``, then ``ties``; ``keys`` must not be
    null. No task orders a whole group: rows are ordered inside ``2**bits`` ranges of
    the hash, and only one row per range is ordered to add what lies before.
    """
    keys = list(keys)
    v = F.lit(1).cast("long") if value is None else F.col(value)
    b, s, start = "__b", "__s", "__start"
    marked = df.withColumn(b, bucket_of(F.col(h), bits))
    sums = marked.groupBy(*keys, b).agg(F.sum(v).alias(s))
    ahead = Window.partitionBy(*keys).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*keys, b, F.coalesce(F.sum(s).over(ahead), F.lit(0)).alias(start))
    inside = (Window.partitionBy(*keys, b).orderBy(h, *ties)
              .rowsBetween(Window.unboundedPreceding, -1))
    return (
        marked.join(starts, [*keys, b])
        .withColumn(out, F.col(start) + F.coalesce(F.sum(v).over(inside), F.lit(0)))
        .drop(b, start)
    )


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))
