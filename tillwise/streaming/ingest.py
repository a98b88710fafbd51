"""Streaming ingest, replay-safe dedupe, live counts and stream-static lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillwise.functions.semantics import first_per_key


def json_stream(spark: SparkSession, src: str, schema: T.StructType, max_files: int = 100) -> DataFrame:
    """Records arriving as JSON files; every field is read as text and cast on the way out.

    ``max_files`` bounds a micro-batch, and with it memory and the work lost on a failure.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    raw = spark.readStream.schema(text).option("maxFilesPerTrigger", max_files).json(src)
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])


def append_stream(stream: DataFrame, sink: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Append a stream to Parquet, exactly once per checkpoint.

    With an ``interval`` it keeps running; otherwise it stops when the input is read.
    """
    writer = stream.writeStream.format("parquet").outputMode("append").option("compression", "zstd").option(
        "checkpointLocation", checkpoint).option("path", sink)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def ingest_stream(spark: SparkSession, src: str, schema: T.StructType, sink: str, checkpoint: str,
                  max_files: int = 100) -> StreamingQuery:
    """Typed ingest of one record kind; a restart resumes after the last finished file."""
    return append_stream(json_stream(spark, src, schema, max_files), sink, checkpoint)


def ingest_orders_and_items(spark: SparkSession, src: str, sink: str, checkpoint: str, order_schema: T.StructType,
                            item_schema: T.StructType, max_files: int = 100) -> None:
    """Orders before items, so an item rarely waits for its order."""
    ingest_stream(spark, f"{src}/orders", order_schema, f"{sink}/orders", f"{checkpoint}/orders", max_files).awaitTermination()
    ingest_stream(spark, f"{src}/items", item_schema, f"{sink}/items", f"{checkpoint}/items", max_files).awaitTermination()


def dedupe_stream(stream: DataFrame, key: str, ts: str, watermark: str = "1 hour") -> DataFrame:
    """Drop records a producer sent again; state is kept for the watermark only."""
    return stream.withWatermark(ts, watermark).dropDuplicatesWithinWatermark([key])


def live_hourly(stream: DataFrame, ts: str, watermark: str = "2 hours", by: str | None = None) -> DataFrame:
    """Row counts per tumbling hour, and per value of a column if given."""
    keys = [F.window(ts, "1 hour")] + ([F.col(by)] if by else [])
    return stream.withWatermark(ts, watermark).groupBy(*keys).agg(F.count("*").alias("rows")).select(
        F.col("window.start").alias("hour"), *([by] if by else []), "rows")


def upsert_log(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append every changed window with the batch that changed it.

    Each batch writes its own directory, so a replayed batch replaces itself.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(
        availableNow=True).foreachBatch(write).start()


def latest_of_log(spark: SparkSession, path: str, keys: list[str], schema: T.StructType | str | None = None) -> DataFrame:
    """Current value per key of an upsert log; with a ``schema``, also of one without any rows."""
    log = spark.read if schema is None else spark.read.schema(schema).option("basePath", path)
    return first_per_key(log.parquet(path), keys, [F.desc("epoch")]).drop("epoch")


def enrich_stream(stream: DataFrame, customers: DataFrame) -> DataFrame:
    """Stream-static join that adds customer attributes to arriving orders."""
    return stream.join(customers.select("customer_id", "first_name", "last_name", "email"), "customer_id")
