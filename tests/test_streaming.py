import os
import time

import pytest
from pyspark.sql import functions as F

from registry.sources import _as_json
from tillwise import schemas
from tillwise.operators import enrich
from tillwise.session import work_dir
from tillwise.sources import files
from tillwise.streaming import incremental, ingest


def test_restart_adds_nothing(spark, tables, folder):
    tables.orders.limit(300).repartition(3).write.json(f"{folder}/in")
    for _ in range(2):
        ingest.ingest_stream(spark, f"{folder}/in", schemas.ORDERS, f"{folder}/out", f"{folder}/cp", 1).awaitTermination()
    assert spark.read.parquet(f"{folder}/out").count() == 300
    tables.orders.limit(50).coalesce(1).write.mode("append").json(f"{folder}/in")
    ingest.ingest_stream(spark, f"{folder}/in", schemas.ORDERS, f"{folder}/out", f"{folder}/cp", 1).awaitTermination()
    assert spark.read.parquet(f"{folder}/out").count() == 350


@pytest.mark.parametrize("items_first", [False, True])
def test_incremental_equals_rebuild(spark, tables, folder, items_first):
    """Three increments with a restart between them, in either order of arrival."""
    day = F.col("order_date")
    orders = tables.orders.filter(day >= "2001-06-01").cache()
    items = tables.order_items.join(orders.select("order_id"), "order_id", "left_semi").select(*tables.order_items.columns)
    cuts = ["2001-06-01", "2001-06-20", "2001-07-10", "2002-01-01"]
    for i in range(3):
        # A restart: nothing is kept but the folders.
        marts = incremental.IncrementalMarts(spark, f"{folder}/out", "month")
        part = orders.filter((day >= cuts[i]) & (day < cuts[i + 1]))
        own = items.join(part.select("order_id"), "order_id", "left_semi").select(*items.columns)
        part.coalesce(1).write.mode("append").parquet(f"{folder}/in/orders")
        own.coalesce(1).write.mode("append").parquet(f"{folder}/in/items")

        def read(name, schema):
            return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in/{name}")

        o, it = read("orders", schemas.ORDERS), read("items", schemas.ORDER_ITEMS)
        steps = [(o, marts.add_orders, "orders"), (it, marts.add_items, "items")]
        for stream, handle, name in (reversed(steps) if items_first else steps):
            stream.writeStream.option("checkpointLocation", f"{folder}/cp/{name}").trigger(
                availableNow=True).foreachBatch(handle).start().awaitTermination()
    full = enrich.fact_orders(enrich.enriched_orders(orders), enrich.enriched_order_items(items))
    daily = enrich.daily_business_metrics(full)
    got = marts.daily().select(*daily.columns)
    assert got.count() == daily.count()
    assert got.exceptAll(daily).count() == 0
    assert marts.fact().select("order_item_id", "items_per_order").exceptAll(
        full.select("order_item_id", "items_per_order")).count() == 0


def test_replayed_batch_replaces_itself(spark, tables, folder):
    marts = incremental.IncrementalMarts(spark, folder, "year")
    batch = tables.orders.filter("order_date >= DATE '2001-06-01'")
    items = tables.order_items.join(batch.select("order_id"), "order_id", "left_semi").select(*tables.order_items.columns)
    for _ in range(2):
        marts.add_orders(batch, 0)
        marts.add_items(items, 0)
    assert marts.fact().count() == items.count()


def test_stream_upsert_in_two_rounds(spark, tables, folder, rows):
    orders = tables.orders.limit(200).cache()
    changed = orders.limit(20).withColumns({"order_status": F.lit("Changed"), "order_date": F.col("order_date") + F.expr("INTERVAL 1 DAY")})
    for batch in (orders, changed):
        batch.coalesce(1).write.mode("append").json(f"{folder}/in")
        stream = ingest.json_stream(spark, f"{folder}/in", schemas.ORDERS)
        state = incremental.merge_stream(stream, spark, f"{folder}/t", f"{folder}/log", f"{folder}/cp", "order_id", "order_date")
    assert state.count() == 200 and state.filter("order_status = 'Changed'").count() == 20


def test_live_counts_and_dedupe(spark, folder):
    df = spark.range(100).select("id", (F.timestamp_seconds(F.col("id") * 600 + 1704067200)).alias("ts"))
    df.unionByName(df).repartition(3).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    unique = ingest.dedupe_stream(stream, "id", "ts", "2 days")
    ingest.append_stream(unique, f"{folder}/once", f"{folder}/cp1").awaitTermination()
    assert spark.read.parquet(f"{folder}/once").count() == 100
    ingest.upsert_log(ingest.live_hourly(stream, "ts", "2 days"), f"{folder}/log", f"{folder}/cp2").awaitTermination()
    live = ingest.latest_of_log(spark, f"{folder}/log", ["hour"])
    assert live.agg(F.sum("rows")).first()[0] == 200 and live.count() == 17


def test_resent_and_moved_orders(spark, tables, folder):
    """An order that comes again replaces the old one; a period it leaves is corrected or goes."""
    marts = incremental.IncrementalMarts(spark, folder, "day")
    orders = tables.orders.orderBy("order_date", "order_id").limit(3).cache()
    items = tables.order_items.join(orders.select("order_id"), "order_id", "left_semi").select(*tables.order_items.columns)
    marts.add_items(items, 0)
    marts.add_orders(orders, 0)
    first = orders.orderBy("order_id").limit(1)
    moved = first.withColumns({"order_date": F.col("order_date") + F.expr("INTERVAL 40 DAYS"), "order_status": F.lit("Changed")})
    marts.add_orders(moved, 1)
    now = orders.join(first.select("order_id"), "order_id", "left_anti").select(*orders.columns).unionByName(
        moved.select(*orders.columns))
    full = enrich.fact_orders(enrich.enriched_orders(now), enrich.enriched_order_items(items))
    got = marts.fact().select(*full.columns)
    assert got.count() == full.count() and got.exceptAll(full).count() == 0
    daily = enrich.daily_business_metrics(full)
    assert marts.daily().select(*daily.columns).exceptAll(daily).count() == 0 and marts.daily().count() == daily.count()
    one = items.limit(1).withColumn("quantity", F.lit(99))
    marts.add_items(one, 1)
    assert marts.fact().filter("quantity = 99").count() == 1 and marts.fact().count() == full.count()


def test_items_without_orders_and_empty_batches(spark, tables, folder):
    marts = incremental.IncrementalMarts(spark, folder, "day")
    assert marts.fact().count() == 0 and marts.daily().count() == 0
    marts.add_items(tables.order_items.limit(5), 0)
    marts.add_orders(tables.orders.limit(0), 0)
    assert marts.fact().count() == 0
    other = tables.orders.filter("order_id = '-1'")
    marts.add_orders(other, 1)
    assert marts.daily().count() == 0


def test_log_is_folded_once(spark, tables, folder):
    orders = tables.orders.limit(50).cache()
    root = f"{folder}/t"
    orders.withColumn("epoch", F.lit(0)).write.partitionBy("epoch").parquet(f"{folder}/log")
    args = (spark, root, f"{folder}/log", "order_id", "order_date", schemas.ORDERS)
    assert incremental.merge_log(*args).count() == 50
    assert incremental.merge_log(*args).count() == 50 and len(files._versions(spark, root)) == 1
    assert incremental.merge_log(spark, f"{folder}/none", f"{folder}/nolog", "order_id", "order_date", schemas.ORDERS).count() == 0


def test_micro_batches_leave_nothing_but_the_tables(spark, tables, folder):
    """No copy of a batch or of a partition stays beside the tables, and orders without a date leave their period."""
    before = set(os.listdir(work_dir(spark)))
    marts = incremental.IncrementalMarts(spark, folder, "year")
    orders = tables.orders.limit(20).cache()
    items = tables.order_items.join(orders.select("order_id"), "order_id", "left_semi").select(*tables.order_items.columns)
    undated = orders.withColumn("order_date", F.lit(None).cast("timestamp"))
    for epoch, (batch, now) in enumerate(((orders, orders), (undated, undated), (undated.limit(3), undated), (orders, orders))):
        marts.add_orders(batch, epoch)
        marts.add_items(items, epoch)
        full = enrich.fact_orders(enrich.enriched_orders(now), enrich.enriched_order_items(items))
        daily = enrich.daily_business_metrics(full)
        for got, wanted in ((marts.fact(), full), (marts.daily(), daily)):
            assert got.count() == wanted.count() and got.select(*wanted.columns).exceptAll(wanted).count() == 0
    assert set(os.listdir(work_dir(spark))) == before
    assert sorted(os.listdir(folder)) == ["daily_business_metrics", "enriched_items", "enriched_orders", "fact_orders"]
    kept = spark.read.parquet(f"{folder}/enriched_orders")
    assert kept.count() == 20


def test_json_files_grow_in_number_and_not_in_size(spark, folder):
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    least = spark.conf.get("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1k")
    try:
        _as_json(spark.range(40000).select("id", F.md5(F.col("id").cast("string")).alias("x")), f"{folder}/in", None)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", least)
    assert len([f for f in os.listdir(f"{folder}/in") if f.endswith(".json")]) > 4
    assert spark.read.json(f"{folder}/in").select("id").distinct().count() == 40000


def test_ingest_of_a_pair_takes_little_disk(spark, folder, monkeypatch):
    """JSON input is compressed, in files of a bounded number of rows, and no shuffle stays behind."""
    from registry import sources
    from registry.base import QUERIES

    monkeypatch.setattr(sources, "_scratch", lambda t, name: folder)
    got = {r["kind"]: r["rows"] for r in QUERIES["stream_orders_and_items"](spark, "/root/testdata/sf0.001").collect()}
    size = {}
    for name in ("orders", "items"):
        there = [os.path.join(f"{folder}/in/{name}", f) for f in os.listdir(f"{folder}/in/{name}") if f.startswith("part-")]
        size[name] = sum(map(os.path.getsize, there))
        assert got[name] == spark.read.json(there).count() and size[name] / got[name] < 60


def test_released_writes_leave_no_shuffle_files(spark, folder):
    def shuffled():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return sum(blocks.apply(i).isShuffle() for i in range(blocks.size()))

    before, known = spark.conf.get(files._CLEANUP, None), shuffled()
    with files.released(spark):
        spark.range(1000).repartition(5).write.parquet(f"{folder}/t")
    for _ in range(50):  # files go in the background
        if shuffled() <= known:
            break
        time.sleep(0.1)
    assert shuffled() <= known and spark.read.parquet(f"{folder}/t").count() == 1000
    with pytest.raises(ValueError), files.released(spark):
        raise ValueError
    assert spark.conf.get(files._CLEANUP, None) == before


def test_columns_that_can_be_made_are_not_shuffled(spark, tables, folder, monkeypatch):
    seen, real = {}, incremental.replace_partitions

    def spy(df, root, *rest):
        seen.setdefault(os.path.basename(root), set()).update(df.columns)
        return real(df, root, *rest)

    monkeypatch.setattr(incremental, "replace_partitions", spy)
    marts = incremental.IncrementalMarts(spark, folder, "year")
    orders = tables.orders.limit(20).cache()
    marts.add_orders(orders, 0)
    marts.add_items(tables.order_items.join(orders.select("order_id"), "order_id", "left_semi"), 0)
    made = {"order_day_name", "final_amount", "discount_tier", "quantity_tier", "actual_unit_price"}
    for name in ("enriched_orders", "enriched_items", "fact_orders"):
        assert not made & seen[name], name
        assert made & set(spark.read.parquet(f"{folder}/{name}").columns)
