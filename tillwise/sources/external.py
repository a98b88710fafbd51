"""Rows of other stores as JSON or variant values, and typed reads of them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_external(spark: SparkSession, fmt: str, options: Mapping[str, str], path: str | None = None) -> DataFrame:
    """Read a foreign table.

    For ``jdbc`` give ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions``; without them one task reads the whole table.
    """
    if fmt == "jdbc" and "query" not in options and "numPartitions" not in options:
        raise ValueError("a jdbc table needs partitionColumn, lowerBound, upperBound and numPartitions")
    reader = spark.read.format(fmt).options(**options)
    return reader.load(path) if path else reader.load()


def _plain(f: T.StructField) -> Column:
    """Dates as ISO text, decimals as double, the rest as is."""
    c = F.col(f.name)
    if isinstance(f.dataType, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    if isinstance(f.dataType, T.DecimalType):
        return c.cast("double")
    return c


def rows_as_json(df: DataFrame, column: str = "result") -> DataFrame:
    """One JSON object per row."""
    return df.select(F.to_json(F.struct(*[_plain(f).alias(f.name) for f in df.schema])).alias(column))


def rows_as_variant(df: DataFrame, column: str = "result") -> DataFrame:
    """One variant value per row."""
    return df.select(F.to_variant_object(F.struct(*[_plain(f).alias(f.name) for f in df.schema])).alias(column))


def project_variant(df: DataFrame, column: str, spec: Mapping[str, tuple[str, str]], parse: bool = False) -> DataFrame:
    """Typed columns out of a variant (or, with ``parse``, JSON text) column.

    ``spec`` maps a column name to ``(path, type)``; a value of another type reads as NULL.
    """
    value = F.try_parse_json(F.col(column)) if parse else F.col(column)
    marked = df.withColumn("__v", value)
    keep = [c for c in df.columns if c != column]
    return marked.select(*keep, *[
        F.try_variant_get("__v", path, kind).alias(name) for name, (path, kind) in spec.items()])
