"""User-defined functions: SQL scalar, vectorised model inference, stateful table function."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def register_sql_functions(spark: SparkSession) -> None:
    """``double_it(x)`` as a SQL function; Spark inlines it into the plan."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION double_it(x DOUBLE) RETURNS DOUBLE RETURN x * 2")


def logistic_udf(weights: Sequence[float], bias: float):
    """Vectorised inference of a fitted linear model over Arrow batches."""
    w = np.asarray(weights, dtype="float64")

    @F.pandas_udf("double")
    def infer(features: pd.Series) -> pd.Series:
        z = np.stack(features.to_numpy()) @ w + bias if len(features) else np.empty(0)
        return pd.Series(1.0 / (1.0 + np.exp(-z)))

    return infer


@F.udtf(returnType="group string, rows bigint, total double, low double, high double")
class PartitionSummary:
    """Consumes the rows of one partition and reports once, at its end."""

    def __init__(self):
        self.group, self.rows, self.total = None, 0, 0.0
        self.low, self.high = None, None

    def eval(self, row):
        value = row["value"]
        self.group = row["grp"]
        self.rows += 1
        if value is not None:
            self.total += value
            self.low = value if self.low is None else min(self.low, value)
            self.high = value if self.high is None else max(self.high, value)

    def terminate(self):
        yield self.group, self.rows, self.total, self.low, self.high


def partition_summaries(df: DataFrame, group: str, value: str, salts: int = 32) -> DataFrame:
    """Per-group summary through the table function.

    Each group is split over ``salts`` calls whose reports are then combined, so a group
    with very many rows does not go through a single call.
    """
    spark = df.sparkSession
    spark.udtf.register("partition_summary", PartitionSummary)
    df.select(F.col(group).cast("string").alias("grp"), F.col(value).cast("double").alias("value"),
              F.pmod(F.xxhash64(*df.columns), F.lit(salts)).alias("salt")).createOrReplaceTempView("__summary_input")
    parts = spark.sql(
        "SELECT * FROM partition_summary(TABLE(SELECT grp, value, salt FROM __summary_input) PARTITION BY (grp, salt))")
    return parts.groupBy("group").agg(
        F.sum("rows").alias("rows"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high"))


def table_metric(df: DataFrame, aggregate: Column, name: str = "value") -> DataFrame:
    """An aggregate that takes a whole table and returns one row."""
    return df.agg(aggregate.alias(name))
