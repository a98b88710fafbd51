"""Source, sink and streaming queries."""

from datetime import datetime

from pyspark.sql import functions as F

from registry.base import query
from registry.enrich import DAILY_MONEY, FLAGS, _num
from registry.marts import clv
from tillwise import schemas
from tillwise.operators import enrich, table_state
from tillwise.sources import external, files, layout
from tillwise.sources.fixtures import AS_OF
from tillwise.streaming import incremental, ingest, stateful

_ORD = f"order_date::VARCHAR AS order_date, {_num('total_amount discount_percent shipping_cost')}"


# --- files ----------------------------------------------------------------------------

def _scratch(t, name):
    return files.scratch_dir(t.spark, name)


@query("load_csv_good", f"SELECT * REPLACE ({_ORD}) FROM ord WHERE order_status <> 'Cancelled'")
def _(t):
    """Orders written as text with unreadable amounts for cancelled ones, then loaded."""
    return _csv(t)[0]


@query("load_csv_bad", "SELECT order_id, 'total_amount' AS broken FROM ord WHERE order_status = 'Cancelled'")
def _(t):
    return _csv(t)[1].select("order_id", F.array_join("broken_columns", ",").alias("broken"))


def _csv(t):
    path = _scratch(t, "csv")
    text = t.orders.withColumn("total_amount", F.when(F.col("order_status") == "Cancelled", "n/a").otherwise(
        F.col("total_amount").cast("string")))
    files.export_csv(text, path, ["order_id"])
    return files.load_csv(t.spark, path, schemas.ORDERS)


@query("load_csv_mart", f"""SELECT customer_id, signup_date::VARCHAR AS signup_date, total_orders, total_revenue::DOUBLE AS total_revenue,
       value_tier, customer_status FROM clv""")
def _(t):
    path = _scratch(t, "mart")
    files.export_csv(clv(t), path, ["customer_id"])
    good, _bad = files.load_csv(t.spark, path, clv(t).schema)
    return good.select("customer_id", "signup_date", "total_orders", "total_revenue", "value_tier", "customer_status")


@query("lake_round_trip", "SELECT ticket_id, customer_id, ticket_date::VARCHAR AS ticket_date, status FROM tick")
def _(t):
    path = _scratch(t, "lake")
    files.export_lake(t.support_tickets, path)
    return files.read_lake(t.spark, path).select("ticket_id", "customer_id", "ticket_date", "status")


@query("partitioned_revenue", """SELECT year(order_date) AS year, month(order_date) AS month, COUNT(*) AS order_count,
       SUM(total_amount)::DOUBLE AS total_revenue FROM ord WHERE year(order_date) = 1998 AND month(order_date) = 3 GROUP BY 1, 2""")
def _(t):
    path = _scratch(t, "orders")
    files.write_partitioned(t.orders.filter("order_date < DATE '2001-01-01'"), path, "order_date")
    files.append_partitioned(t.orders.filter("order_date >= DATE '2001-01-01'"), path, "order_date")
    return files.partition_revenue(t.spark, path, 1998, 3)


@query("clustered_table", f"SELECT * REPLACE ({_ORD}) FROM ord")
def _(t):
    path = _scratch(t, "clustered")
    files.write_clustered(t.orders, ["order_status", "order_date"], path)
    return t.spark.read.parquet(path)


@query("versioned_table", "SELECT order_status, COUNT(*) AS n FROM ord WHERE order_date >= DATE '2001-01-01' GROUP BY 1")
def _(t):
    root = _scratch(t, "versions")
    files.write_version(t.orders, root)
    files.write_version(t.orders.filter("order_date >= DATE '2001-01-01'"), root)
    return files.read_current(t.spark, root).groupBy("order_status").agg(F.count("*").alias("n"))


@query("materialized_counts", "SELECT customer_segment, COUNT(*) AS n FROM cust GROUP BY 1")
def _(t):
    return files.materialize(t.customers, "customers_view").groupBy("customer_segment").agg(F.count("*").alias("n"))


@query("merge_report", """SELECT COUNT(*) FILTER (NOT known) AS inserted, COUNT(*) FILTER (known) AS updated, COUNT(*) AS records_merged,
       true AS timed FROM (SELECT order_id IN (SELECT order_id FROM ord WHERE order_date < DATE '2001-01-01') AS known FROM stage_one)""")
def _(t):
    """Counts and duration of an upsert that was written."""
    result = table_state.merge_upsert(t.orders.filter("order_date < DATE '2001-01-01'"), t.orders_staging, "order_id",
                                      [F.desc("order_date")])
    report = table_state.write_merge(result, _scratch(t, "merged"))
    row = (report["inserted"], report["updated"], report["records_merged"], report["duration_ms"] >= 0)
    return files.values(t.spark, [row], "inserted bigint, updated bigint, records_merged bigint, timed boolean")


@query("sample_n", "SELECT 100 AS rows, 100 AS different, 0 AS outside")
def _(t):
    """Properties of an exact sample; which rows are drawn depends on the hash."""
    drawn = files.sample_n(t.orders, 100, "order_id", 1)
    outside = drawn.join(t.orders.select("order_id"), "order_id", "left_anti").agg(F.count("*")).scalar()
    return drawn.agg(F.count("*").alias("rows"), F.count_distinct("order_id").alias("different")).withColumn(
        "outside", outside)


@query("consistent_sample", """SELECT 'customers' AS name, 50 AS rows, 0 AS dangling UNION ALL SELECT 'orders', NULL, 0
       UNION ALL SELECT 'order_items', NULL, 0 UNION ALL SELECT 'clv', 50, 0""")
def _(t):
    """Every sampled row refers to a sampled row above it."""
    s = files.consistent_sample(t.customers, t.orders, t.order_items, 50, clv=clv(t))
    known = {"customers": (t.customers, "customer_id"), "orders": (s["customers"], "customer_id"),
             "order_items": (s["orders"], "order_id"), "clv": (s["customers"], "customer_id")}
    out = None
    for name, (parent, key) in known.items():
        dangling = s[name].join(parent.select(key), key, "left_anti").agg(F.count("*")).scalar()
        row = s[name].agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("name"),
            (F.col("rows") if name in ("customers", "clv") else F.lit(None).cast("bigint")).alias("rows"),
            dangling.alias("dangling"))
        out = row if out is None else out.unionByName(row)
    return out


@query("range_shards", """SELECT greatest(least((customer_id - 1) // ((SELECT MAX(customer_id) FROM cust) // 4), 3), 0) AS shard,
       COUNT(*) AS customers, MIN(customer_id) AS first_id, MAX(customer_id) AS last_id FROM cust GROUP BY 1""")
def _(t):
    return files.range_partition(t.customers, 4).groupBy("shard").agg(
        F.count("*").alias("customers"), F.min("customer_id").alias("first_id"), F.max("customer_id").alias("last_id"))


@query("event_properties", "SELECT event_id, event_type, (props->>'k')::BIGINT AS k, NULL::VARCHAR AS missing FROM events")
def _(t):
    return external.project_variant(t.raw("events").select("event_id", "event_type", "props"), "props",
                                    {"k": ("$.k", "bigint"), "missing": ("$.nothing", "string")}, parse=True)


@query("external_rows", """SELECT ticket_id, customer_id, category, strftime(ticket_date, '%Y-%m-%dT%H:%M:%S') AS ticket_date FROM tick""")
def _(t):
    """Tickets read back from another store's JSON rows."""
    path = _scratch(t, "store")
    external.rows_as_json(t.support_tickets).write.text(path)
    remote = external.read_external(t.spark, "text", {}, path)
    return external.project_variant(remote, "value", {
        "ticket_id": ("$.ticket_id", "bigint"), "customer_id": ("$.customer_id", "bigint"),
        "category": ("$.category", "string"), "ticket_date": ("$.ticket_date", "string")}, parse=True)


@query("variant_rows", "SELECT order_id, total_amount::DOUBLE AS total_amount, strftime(order_date, '%Y-%m-%dT%H:%M:%S') AS order_date FROM ord")
def _(t):
    return external.project_variant(external.rows_as_variant(t.orders), "result", {
        "order_id": ("$.order_id", "string"), "total_amount": ("$.total_amount", "double"),
        "order_date": ("$.order_date", "string")})


# --- streaming ------------------------------------------------------------------------------------------

def _as_json(df, path, parts=4, compression="none"):
    """Files of the given number, or without one, of a size that does not grow with the table.

    These are cut where tasks write them, so rows are not shuffled for it.
    """
    if parts:
        df.repartition(parts).write.json(path)
        return
    advised = df.sparkSession.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    rows = max(df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(advised) // 64, 1)
    with files.released(df.sparkSession):
        df.write.option("maxRecordsPerFile", rows).option("compression", compression).json(path)


@query("stream_ingest_orders", f"SELECT * REPLACE ({_ORD}) FROM ord")
def _(t):
    """Orders through JSON files, two files per micro-batch, and a restart that adds nothing."""
    root = _scratch(t, "ingest")
    _as_json(t.orders, f"{root}/in")
    for _round in range(2):
        ingest.ingest_stream(t.spark, f"{root}/in", schemas.ORDERS, f"{root}/out", f"{root}/cp", 2).awaitTermination()
    return t.spark.read.parquet(f"{root}/out")


@query("stream_orders_and_items", "SELECT 'orders' AS kind, COUNT(*) AS rows FROM ord UNION ALL SELECT 'items', COUNT(*) FROM item")
def _(t):
    root = _scratch(t, "pair")
    _as_json(t.orders, f"{root}/in/orders", None, "gzip")
    _as_json(t.order_items, f"{root}/in/items", None, "gzip")
    ingest.ingest_orders_and_items(t.spark, f"{root}/in", f"{root}/out", f"{root}/cp", schemas.ORDERS, schemas.ORDER_ITEMS)
    count = [F.count("*").alias("rows")]
    return t.spark.read.parquet(f"{root}/out/orders").agg(*count).withColumn("kind", F.lit("orders")).unionByName(
        t.spark.read.parquet(f"{root}/out/items").agg(*count).withColumn("kind", F.lit("items")))


@query("stream_enriched_orders", """SELECT order_id, order_date_only::VARCHAR AS order_date_only, final_amount::DOUBLE AS final_amount,
       discount_tier, order_size_category FROM eord""")
def _(t):
    root = _scratch(t, "tier1")
    _as_json(t.orders, f"{root}/in")
    stream = enrich.enriched_orders(ingest.json_stream(t.spark, f"{root}/in", schemas.ORDERS))
    ingest.append_stream(stream, f"{root}/out", f"{root}/cp").awaitTermination()
    return t.spark.read.parquet(f"{root}/out").select(
        "order_id", "order_date_only", "final_amount", "discount_tier", "order_size_category")


@query("stream_dedupe", "SELECT event_id, user_id, event_type FROM events")
def _(t):
    """Events sent twice come out once."""
    root = _scratch(t, "twice")
    events = t.raw("events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    events.unionByName(events).repartition(4).write.parquet(f"{root}/in")
    # A file at a time: copies come in different micro-batches, so the kept state must tell.
    stream = t.spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    ingest.append_stream(ingest.dedupe_stream(stream, "event_id", "ts", "40 days"), f"{root}/out", f"{root}/cp").awaitTermination()
    return t.spark.read.parquet(f"{root}/out").select("event_id", "user_id", "event_type")


@query("stream_live_hourly", "SELECT date_trunc('hour', ts)::TIMESTAMP::VARCHAR AS hour, event_type, COUNT(*) AS rows FROM events GROUP BY 1, 2")
def _(t):
    root = _scratch(t, "live")
    events = t.raw("events").select("event_type", F.col("ts").cast("timestamp").alias("ts"))
    events.repartitionByRange(4, "ts").write.parquet(f"{root}/in")
    stream = t.spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/in")
    ingest.upsert_log(ingest.live_hourly(stream, "ts", "40 days", "event_type"), f"{root}/log", f"{root}/cp").awaitTermination()
    return ingest.latest_of_log(t.spark, f"{root}/log", ["hour", "event_type"])


@query("stream_order_lookup", """SELECT o.order_id, o.customer_id, o.total_amount::DOUBLE AS total_amount, c.email FROM ord o JOIN cust c USING (customer_id)""")
def _(t):
    root = _scratch(t, "lookup")
    _as_json(t.orders, f"{root}/in")
    stream = ingest.enrich_stream(ingest.json_stream(t.spark, f"{root}/in", schemas.ORDERS), t.customers)
    ingest.append_stream(stream, f"{root}/out", f"{root}/cp").awaitTermination()
    return t.spark.read.parquet(f"{root}/out").select("order_id", "customer_id", "total_amount", "email")


@query("stream_merge", f"SELECT * REPLACE ({_ORD}) FROM stage_one")
def _(t):
    """Earlier orders, then all staging rows through the streaming upsert."""
    root = _scratch(t, "upsert")
    files.write_version(t.orders.filter("order_date < DATE '2001-01-01'"), f"{root}/target")
    staged = schemas.conform(t.orders_staging, schemas.ORDERS)
    _as_json(staged, f"{root}/in")
    stream = ingest.json_stream(t.spark, f"{root}/in", schemas.ORDERS, 2)
    return incremental.merge_stream(stream, t.spark, f"{root}/target", f"{root}/log", f"{root}/cp", "order_id", "order_date")


def _stream_marts(t):
    root = _scratch(t, "marts")
    with files.released(t.spark):
        t.orders.repartitionByRange(2, "order_date").write.option("compression", "zstd").parquet(f"{root}/in/orders")
        t.order_items.repartition(2, "order_id").write.option("compression", "zstd").parquet(f"{root}/in/items")
    marts = incremental.IncrementalMarts(t.spark, f"{root}/out", "year")

    def read(name, schema):
        return t.spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in/{name}")

    marts.run(read("orders", schemas.ORDERS), read("items", schemas.ORDER_ITEMS), f"{root}/cp")
    return marts


@query("stream_resent_orders", f"""
    SELECT * REPLACE (order_date_only::VARCHAR AS order_date_only, {_num(DAILY_MONEY)}) FROM daily""")
def _(t):
    """Orders first come with another status and day, then as they are: the metrics equal the batch aggregate."""
    root = _scratch(t, "resent")
    marts = incremental.IncrementalMarts(t.spark, f"{root}/out", "year")
    early = t.orders.filter(F.crc32(F.col("order_id").cast("binary")) % 3 == 0).withColumns({
        "order_status": F.lit("Pending"), "order_date": F.col("order_date") - F.expr("INTERVAL 400 DAYS")})
    marts.add_orders(early, 0)
    marts.add_items(t.order_items, 0)
    marts.add_orders(t.orders, 1)
    return marts.daily()


@query("stream_daily_metrics", f"""
    SELECT * REPLACE (order_date_only::VARCHAR AS order_date_only, {_num(DAILY_MONEY)}) FROM daily""")
def _(t):
    """Daily metrics kept by micro-batches equal the batch aggregate."""
    return _stream_marts(t).daily()


def _stateful_marts(t):
    """A third of the orders comes early with another status and day, then all items, then all orders."""
    root = _scratch(t, "stateful")
    early = t.orders.filter(F.crc32(F.col("order_id").cast("binary")) % 3 == 0).withColumns({
        "order_status": F.lit("Pending"), "order_date": F.col("order_date") - F.expr("INTERVAL 400 DAYS")})
    marts = stateful.StatefulMarts(t.spark, f"{root}/out")
    for at, (orders, items) in enumerate(((early, t.order_items), (t.orders, t.order_items.limit(0)))):
        streams = []
        for name, df in (("orders", orders), ("items", items)):
            arrived = df.withColumn("arrived", F.lit(at).cast("long"))
            arrived.write.mode("append").parquet(f"{root}/in/{name}")
            streams.append(t.spark.readStream.schema(arrived.schema).parquet(f"{root}/in/{name}"))
        marts.run(*streams, f"{root}/cp")
    return marts


@query("stream_stateful_metrics", f"""
    SELECT * REPLACE (order_date_only::VARCHAR AS order_date_only, {_num(DAILY_MONEY)}) FROM daily""")
def _(t):
    """Daily metrics over the fact that keyed state joins equal the batch aggregate."""
    return enrich.daily_business_metrics(_stateful_marts(t).fact())


@query("stream_stateful_sums", """
    SELECT order_date::DATE::VARCHAR AS order_date_only, COUNT(*) AS total_orders, SUM(n) AS item_rows,
           SUM(total_amount * n)::DOUBLE AS total_revenue, SUM(total)::DOUBLE AS items_total
    FROM ord JOIN (SELECT order_id, COUNT(*) AS n, SUM(line_total) AS total FROM item GROUP BY 1) USING (order_id) GROUP BY 1""")
def _(t):
    """Orders and amounts of each day by adding the signs of the log: an order that moved leaves its first day."""
    return _stateful_marts(t).daily_sums()


@query("layout_lookups", """
    SELECT 'day' AS looked_up, order_id, customer_id, order_date::VARCHAR AS order_date FROM ord
    WHERE order_date BETWEEN TIMESTAMP '1998-03-02' AND TIMESTAMP '1998-03-20'
    UNION ALL SELECT 'customer', order_id, customer_id, order_date::VARCHAR FROM ord WHERE customer_id BETWEEN 20 AND 40""")
def _(t):
    """All orders along a curve over customer and time, then looked up by either."""
    path = _scratch(t, "layout")
    layout.write_layout(t.orders, ["customer_id", "order_date"], path, 16)
    own = ["order_id", "customer_id", "order_date"]
    days = layout.read_between(t.spark, path, "order_date", datetime(1998, 3, 2), datetime(1998, 3, 20))
    customers = layout.read_between(t.spark, path, "customer_id", 20, 40)
    return days.select(F.lit("day").alias("looked_up"), *own).unionByName(
        customers.select(F.lit("customer").alias("looked_up"), *own))
