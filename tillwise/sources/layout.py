"""Files ordered along a Hilbert curve over several columns, with the range of each file.

A table sorted by one key answers look-ups by that key only. Here each column is replaced by its
place among quantiles, the places are read as a point of a Hilbert curve, and files take stretches
of the curve, so a file covers a small range of every column: of ``n`` files a look-up by one of
``d`` columns reads about ``n ** ((d - 1) / d)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Places per column, as a power of two.
BITS = 8


def _number(df: DataFrame, name: str) -> Column:
    kind = dict(df.dtypes)[name]
    c = F.col(name)
    if kind == "date":
        return F.unix_date(c).cast("double")
    return (F.unix_micros(c) if kind == "timestamp" else c).cast("double")


def hilbert_index(places: Sequence[Column], bits: int) -> Column:
    """Position on the Hilbert curve of a point of whole numbers below ``2 ** bits``; NULL counts as 0.

    The point's axes are turned into the curve's bits from the highest bit down (inverse rotations,
    then a Gray code); the bits of all axes, interleaved, are the position. All of it are folds
    over short arrays inside the row.
    """
    n = len(places)
    if not 0 < n * bits <= 62:
        raise ValueError("a position has 62 bits at most")
    masks = [1 << b for b in range(bits - 1, -1, -1)]

    def has(value, mask):
        return value.bitwiseAND(mask) != 0

    zero = F.lit(0).cast("long")
    turns = F.array(*[F.struct(F.lit(q).cast("long").alias("q"), F.lit(i).alias("i")) for q in masks[:-1] for i in range(n)])
    axes = F.array(*[F.coalesce(p.cast("long"), F.lit(0).cast("long")) for p in places])

    def turn(x, t):
        first, own, low = F.get(x, F.lit(0)), F.get(x, t["i"]), t["q"] - 1
        swap = F.when(has(own, t["q"]), F.lit(0).cast("long")).otherwise(first.bitwiseXOR(own).bitwiseAND(low))
        head = F.when(has(own, t["q"]), first.bitwiseXOR(low)).otherwise(first.bitwiseXOR(swap))
        return F.transform(x, lambda v, j: F.when(j == 0, head).when(j == t["i"], v.bitwiseXOR(swap)).otherwise(v))

    zero = F.lit(0).cast("long")
    turned = axes if bits == 1 else F.aggregate(turns, axes, turn)
    each = F.array(*[F.lit(q).cast("long") for q in masks])

    def gray(x):
        return F.transform(x, lambda _, j: F.aggregate(F.slice(x, F.lit(1), j + 1), zero, lambda s, v: s.bitwiseXOR(v)))

    def tail(g):
        return F.aggregate(each, zero, lambda s, q: F.when(has(F.element_at(g, -1), q), s.bitwiseXOR(q - 1)).otherwise(s))

    def interleaved(x):
        return F.aggregate(each, zero, lambda s, q: F.aggregate(x, s, lambda d, v: d * 2 + F.when(has(v, q), 1).otherwise(0)))

    return _bound(turned, lambda x: _bound(gray(x), lambda g: _bound(tail(g), lambda t: _bound(
        F.transform(g, lambda v: v.bitwiseXOR(t)), interleaved))))


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def write_layout(df: DataFrame, cols: Sequence[str], path: str, files: int, bits: int = BITS) -> None:
    """Write ``df`` in ``files`` stretches of the curve over ``cols``, and each file's ranges beside them.

    Columns are numbers, dates or timestamps; NULL goes with the smallest place. A value that many rows
    share takes one place of its column, and the other columns still spread its rows over files.
    Quantiles of all columns come from one aggregate.
    """
    cols = list(cols)
    bits = min(bits, 62 // len(cols))
    wanted = [i / (1 << bits) for i in range(1, 1 << bits)]
    row = df.agg(*[F.percentile_approx(_number(df, c), wanted, 10_000) for c in cols]).first()
    rest, placed = df.columns, df
    for i, c in enumerate(cols):
        cuts = sorted(set(row[i] or [0.0]))
        placed = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol=f"_number{i}", outputCol=f"_place{i}",
                            handleInvalid="keep").transform(placed.withColumn(f"_number{i}", _number(df, c)))
        # Where the value is unknown the bucketizer gives one place more.
        placed = placed.withColumn(f"_place{i}", F.when(F.col(f"_number{i}").isNotNull(), F.col(f"_place{i}")))
    curve = hilbert_index([F.col(f"_place{i}") for i in range(len(cols))], bits)
    placed.withColumn("_curve", curve).repartitionByRange(files, "_curve").sortWithinPartitions("_curve").select(
        *rest).write.mode("overwrite").parquet(f"{path}/rows")
    spark = df.sparkSession
    written = spark.read.schema(df.schema).parquet(f"{path}/rows")
    ranges = written.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("rows"), *[f(c).alias(f"{side}_{c}") for c in cols for side, f in (("min", F.min), ("max", F.max))])
    ranges.write.mode("overwrite").parquet(f"{path}/ranges")


def files_between(spark: SparkSession, path: str, col: str, low, high) -> DataFrame:
    """Files that may hold values from ``low`` to ``high``."""
    return spark.read.parquet(f"{path}/ranges").filter(
        (F.col(f"min_{col}") <= F.lit(high)) & (F.col(f"max_{col}") >= F.lit(low)))


def read_between(spark: SparkSession, path: str, col: str, low, high) -> DataFrame:
    """Rows with a value of ``col`` from ``low`` to ``high``; other files than theirs are not opened.

    The names of these files come to the driver, as for any scan of files.
    """
    schema = spark.read.parquet(f"{path}/rows").schema
    names = [r["file"] for r in files_between(spark, path, col, low, high).select("file").collect()]
    rows = spark.read.schema(schema).parquet(*names) if names else spark.createDataFrame([], schema)
    return rows.filter(F.col(col).between(F.lit(low), F.lit(high)))
