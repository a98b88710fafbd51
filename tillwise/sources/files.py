"""File sources and sinks: delimited text, lake tables, partitioned and versioned writes."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.session import cut_lineage, work_dir

# Texts read as NULL in delimited files.
NULL_TOKENS = ("", "NULL", "None")
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared folder."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


# --- delimited text ------------------------------------------------------------------

def load_csv(spark: SparkSession, path: str, schema: T.StructType, null_tokens: Sequence[str] = NULL_TOKENS,
             sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """Lenient load: ``(good, bad)``.

    The header line is skipped, fields may be quoted, short lines are filled with NULL
    and surplus fields dropped. A line with a field that is neither a NULL token nor a
    value of the declared type goes to ``bad`` with the names of those columns.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    raw = spark.read.schema(text).csv(path, header=True, sep=sep, quote='"', escape='"', mode="PERMISSIVE",
                                      enforceSchema=True, nullValue="\u0000")
    clean = raw.select(*[
        F.when(F.trim(F.col(f.name)).isin(*null_tokens), None).otherwise(F.col(f.name)).alias(f.name) for f in schema])
    typed = {f.name: F.col(f.name) if isinstance(f.dataType, T.StringType)
             else F.trim(F.col(f.name)).try_cast(f.dataType) for f in schema}
    broken = F.array_compact(F.array(*[
        F.when(F.col(n).isNotNull() & value.isNull(), F.lit(n)) for n, value in typed.items()]))
    marked = clean.withColumn("__broken", broken)
    good = marked.filter(F.size("__broken") == 0).select(*[v.alias(n) for n, v in typed.items()])
    bad = marked.filter(F.size("__broken") > 0).withColumnRenamed("__broken", "broken_columns")
    return good, bad


def export_csv(df: DataFrame, path: str, order_by: Sequence[str], max_records: int = 1_000_000) -> None:
    """Ordered delimited export in several files with a header each."""
    df.orderBy(*order_by).write.mode("overwrite").option("header", True).option(
        "maxRecordsPerFile", max_records).csv(path)


# --- lake tables -------------------------------------------------------------------------

def read_lake(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def export_lake(df: DataFrame, path: str) -> None:
    """Full copy as Parquet; timestamps carry microseconds."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def with_year_month(df: DataFrame, date_col: str) -> DataFrame:
    return df.withColumns({"year": F.year(date_col), "month": F.month(date_col)})


def write_partitioned(df: DataFrame, path: str, date_col: str, max_records_per_file: int = 2_000_000,
                      mode: str = "overwrite") -> None:
    """Write by year and month.

    The rebalance hint gathers each month into few files, and AQE splits a month that is
    far larger than the others instead of writing it in one task.
    """
    with_year_month(df, date_col).hint("rebalance", "year", "month").write.mode(mode).option(
        "maxRecordsPerFile", max_records_per_file).partitionBy("year", "month").parquet(path)


def append_partitioned(df: DataFrame, path: str, date_col: str) -> None:
    write_partitioned(df, path, date_col, mode="append")


def write_clustered(df: DataFrame, cols: Sequence[str], path: str, partitions: int | None = None) -> None:
    """Range-ordered files, so a filter on the leading columns skips most of them."""
    spread = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    spread.sortWithinPartitions(*cols).write.mode("overwrite").parquet(path)


def partition_revenue(spark: SparkSession, path: str, year: int, month: int) -> DataFrame:
    """Orders and revenue of one month; only that month's files are read."""
    return spark.read.parquet(path).filter((F.col("year") == year) & (F.col("month") == month)).groupBy(
        "year", "month").agg(F.count("*").alias("order_count"), F.sum("total_amount").alias("total_revenue"))


def materialize(df: DataFrame, name: str, temporary: bool = True) -> DataFrame:
    """Name a result: a view by default, else a saved table."""
    if temporary:
        df.createOrReplaceTempView(name)
    else:
        df.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def values(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """Inline rows."""
    return spark.createDataFrame(list(rows), schema)


# --- versions -----------------------------------------------------------------------------------

def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, name: str) -> bool:
    """Whether a path is there, on any file system Spark can reach."""
    fs, path = _path(spark, name)
    return fs.exists(path)


def remove(spark: SparkSession, name: str) -> None:
    """Take a partition's folder away."""
    fs, path = _path(spark, name)
    fs.delete(path, True)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Writes inside the block drop their shuffles' files when they are done, not when the driver next collects garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


@contextmanager
def cuts(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Cut lineages inside a block; the tables written for it go when the block ends, their shuffles as soon as they are written."""
    folder = scratch_dir(spark, "cuts")

    def cut(df: DataFrame) -> DataFrame:
        with released(df.sparkSession):
            return cut_lineage(spark, df, folder, compression="zstd")

    try:
        yield cut
    finally:
        remove(spark, folder)


def replace_partitions(df: DataFrame, root: str, partition: str, columns: Sequence[Column | str] = ("*",)) -> list[str]:
    """Replace the partitions that ``df`` has rows of; returns the names of their folders.

    They are written apart and then moved, so the rows may come from the partitions they replace.
    A large partition is split by AQE. ``columns`` are what is written, made of the rows after their shuffle.
    """
    spark = df.sparkSession
    staged = f"{root}/.staged-{uuid.uuid4().hex}"
    with released(spark):
        df.hint("rebalance", partition).select(*columns).write.partitionBy(partition).option("compression", "zstd").parquet(staged)
    fs, path = _path(spark, staged)
    names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
    for name in names:
        target = _path(spark, f"{root}/{name}")[1]
        fs.delete(target, True)
        if not fs.rename(_path(spark, f"{staged}/{name}")[1], target):
            raise OSError(f"could not move {name} to {root}")
    fs.delete(path, True)
    return names


def _versions(spark: SparkSession, root: str) -> list[tuple[int, int]]:
    """(version, last batch folded in) of the finished versions below ``root``."""
    fs, path = _path(spark, root)
    if not fs.exists(path):
        return []
    found = []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if name.startswith("version=") and exists(spark, f"{status.getPath()}/_SUCCESS"):
            version, _, folded_to = name.split("=")[1].partition("-")
            found.append((int(version), int(folded_to or -1)))
    return sorted(found)


def folded(spark: SparkSession, root: str) -> int:
    """The last batch of a change log that the newest version holds, -1 if none."""
    done = _versions(spark, root)
    return done[-1][1] if done else -1


def _folder(root: str, version: int, folded_to: int) -> str:
    return f"{root}/version={version}" + (f"-{folded_to}" if folded_to >= 0 else "")


def write_version(df: DataFrame, root: str, folded_to: int | None = None) -> str:
    """Write a table state next to the earlier ones; readers switch when it is complete."""
    spark = df.sparkSession
    done = _versions(spark, root)
    last, batch = done[-1] if done else (0, -1)
    path = _folder(root, last + 1, batch if folded_to is None else folded_to)
    df.write.mode("overwrite").parquet(path)
    return path


def read_current(spark: SparkSession, root: str) -> DataFrame | None:
    """Newest complete table state, None before the first."""
    done = _versions(spark, root)
    return spark.read.parquet(_folder(root, *done[-1])) if done else None


def read_version(spark: SparkSession, root: str, version: int) -> DataFrame:
    batch = dict(_versions(spark, root))[version]
    return spark.read.parquet(_folder(root, version, batch))


# --- samples ------------------------------------------------------------------

def sample_n(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows, the same ones every time: the smallest hashes of a unique key."""
    return df.orderBy(F.xxhash64(F.lit(seed), F.col(key)), F.col(key)).limit(n)


def consistent_sample(customers: DataFrame, orders: DataFrame, items: DataFrame, n: int, seed: int = 42,
                      **by_customer: DataFrame) -> Mapping[str, DataFrame]:
    """Sampled customers with all their orders, items and further per-customer rows."""
    picked = sample_n(customers, n, "customer_id", seed)
    ids = picked.select("customer_id")
    own_orders = orders.join(ids, "customer_id", "left_semi")
    out = {"customers": picked, "orders": own_orders,
           "order_items": items.join(own_orders.select("order_id"), "order_id", "left_semi")}
    for name, df in by_customer.items():
        out[name] = df.join(ids, "customer_id", "left_semi")
    return out


def shard_of(key: Column, highest: Column, n: int) -> Column:
    """Contiguous id range a key falls in; the last range takes the remainder."""
    size = F.greatest(F.floor(highest / F.lit(n)), F.lit(1))
    return F.greatest(F.least(F.floor((key - F.lit(1)) / size), F.lit(n - 1)), F.lit(0)).cast("int")


def range_partition(customers: DataFrame, n: int) -> DataFrame:
    """Customers with the shard of the id range they belong to."""
    highest = customers.agg(F.max("customer_id")).scalar()
    return customers.withColumn("shard", shard_of(F.col("customer_id"), highest, n))
