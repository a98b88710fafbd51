"""Table-state, set, time-series, quality and policy queries."""

from datetime import timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from registry.base import SHARED_SQL, query
from registry.enrich import _num
from tillwise.functions.ranking import dense_position
from tillwise.operators import policy, quality, sets
from tillwise.operators import table_state as ts
from tillwise.operators import timeseries as tm
from tillwise.operators.reports import layer_counts
from tillwise.operators.serving import customer_order_analytics
from tillwise.sources.files import values
from tillwise.sources.fixtures import AS_OF

TODAY = f"DATE '{AS_OF}'"
LOADED = "order_date < DATE '2001-01-01'"  # what an earlier load had already brought in
_ORD = f"order_date::VARCHAR AS order_date, {_num('total_amount discount_percent shipping_cost')}"


def _loaded(t):
    return t.orders.filter(LOADED)


# Staging rows as they are merged: latest version per order, money as decimals.
SHARED_SQL["stage_one"] = """
    SELECT order_id, customer_id, order_date, order_status, total_amount::DECIMAL(10,2) AS total_amount,
           discount_percent::DECIMAL(5,2) AS discount_percent, shipping_cost::DECIMAL(8,2) AS shipping_cost
    FROM ord_stage QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY order_date DESC) = 1"""

SHARED_SQL["item_one"] = """
    SELECT * FROM item_stage QUALIFY ROW_NUMBER() OVER (PARTITION BY order_item_id ORDER BY order_id DESC, product_id DESC,
        product_name DESC, product_category DESC, quantity DESC, unit_price DESC, line_total DESC) = 1"""


# --- windows over keys ---------------------------------------------------------------

@query("dedupe_latest", f"SELECT * REPLACE ({_ORD}) FROM stage_one")
def _(t):
    return ts.dedupe_latest(t.orders_staging, ["order_id"], [F.desc("order_date")])


@query("dedupe_any", "SELECT * FROM item_one")
def _(t):
    return ts.dedupe_any(t.order_items_staging, ["order_item_id"])


@query("duplicate_rows", """
    SELECT order_item_id, order_id, product_id, quantity, line_total, unit_price, product_name, product_category, COUNT(*) AS extra_copies
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_item_id ORDER BY order_id DESC, product_id DESC, product_name DESC,
          product_category DESC, quantity DESC, unit_price DESC, line_total DESC) AS rn FROM item_stage)
    WHERE rn > 1 GROUP BY ALL""")
def _(t):
    return ts.duplicate_rows(t.order_items_staging, ["order_item_id"], [])


@query("qualify_latest_order", f"""SELECT * REPLACE ({_ORD}) FROM (SELECT * FROM ord
       QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY order_date DESC, order_id DESC) = 1)""")
def _(t):
    return ts.dedupe_latest(t.orders, ["customer_id"], [F.desc("order_date"), F.desc("order_id")])


@query("assign_ids", """SELECT event_id, ROW_NUMBER() OVER (ORDER BY event_id) + (SELECT MAX(customer_id) FROM cust) AS new_id
       FROM events WHERE event_type = 'error'""")
def _(t):
    start = t.customers.agg(F.max("customer_id") + 1).scalar()
    errors = t.raw("events").filter("event_type = 'error'").select("event_id")
    return dense_position(errors, "event_id", "pos").select("event_id", (F.col("pos") + start).alias("new_id"))


@query("orphan_orders", "SELECT order_id FROM ord WHERE order_id NOT IN (SELECT order_id FROM item)")
def _(t):
    return ts.orphan_orders(t.orders, t.order_items).select("order_id")


@query("orphan_items", """SELECT order_item_id, order_id FROM item
       WHERE order_id NOT IN (SELECT order_id FROM ord WHERE order_date < DATE '2001-01-01')""")
def _(t):
    return ts.orphan_items(t.order_items, _loaded(t)).select("order_item_id", "order_id")


@query("missing_in_source", """SELECT order_id FROM ord WHERE order_date >= DATE '2001-01-01'""")
def _(t):
    return ts.missing_in_source(t.orders, _loaded(t), "order_id").select("order_id")


# --- merge and mirror ------------------------------------------------------------------

def _merge(t):
    return ts.merge_upsert(_loaded(t), t.orders_staging, "order_id", [F.desc("order_date")])


@query("merge_orders", f"SELECT * REPLACE ({_ORD}) FROM stage_one")
def _(t):
    return _merge(t).table


@query("merge_orders_counts", """SELECT COUNT(*) FILTER (NOT known) AS inserted, COUNT(*) FILTER (known) AS updated, 0 AS deleted,
       0 AS unchanged, COUNT(*) AS records_merged
       FROM (SELECT order_id IN (SELECT order_id FROM ord WHERE order_date < DATE '2001-01-01') AS known FROM stage_one)""")
def _(t):
    return _merge(t).counts()


@query("merge_items", f"SELECT * REPLACE ({_num('unit_price line_total')}) FROM item_one")
def _(t):
    target = ts.truncate(t.order_items)
    return ts.merge_upsert(target, t.order_items_staging, "order_item_id").table


@query("merge_seed_values", """
    SELECT region, coalesce(s.label, r.r_name) AS label, s.label IS NULL AS kept
    FROM (SELECT coalesce(r_regionkey, k) AS region, * FROM region r
          FULL JOIN (VALUES (1, 'seed one'), (3, 'seed three'), (90, 'seed ninety')) s(k, label) ON r_regionkey = k) r
    LEFT JOIN (VALUES (1, 'seed one'), (3, 'seed three'), (90, 'seed ninety')) s(k, label) ON region = s.k""")
def _(t):
    """Inline seed rows merged into a stored table: known keys updated, new ones inserted."""
    target = t.raw("region").select(F.col("r_regionkey").cast("long").alias("region"), F.col("r_name").alias("label"))
    seed = values(t.spark, [(1, "seed one"), (3, "seed three"), (90, "seed ninety")], "region long, label string")
    return ts.merge_upsert(target, seed, "region").table.withColumn("kept", ~F.col("label").startswith("seed"))


@query("mirror_insert_update_delete", """
    SELECT c_custkey AS id, CASE WHEN c_custkey % 7 = 0 THEN 'changed' ELSE c_name END AS name FROM customer WHERE c_custkey % 5 <> 1""")
def _(t):
    """One sync that inserts, updates and deletes."""
    rows = t.raw("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    target = rows.filter("id % 3 <> 2")
    source = rows.filter("id % 5 <> 1").withColumn("name", F.when(F.col("id") % 7 == 0, "changed").otherwise(F.col("name")))
    return ts.mirror_sync(target, source, "id").table


@query("merge_scaled", f"""SELECT order_id, customer_id, order_date::VARCHAR AS order_date,
       CASE WHEN order_date >= DATE '2001-01-01' THEN 'MERGED' ELSE order_status END AS order_status,
       CASE WHEN order_date >= DATE '2001-01-01' THEN round(total_amount * 1.05::DECIMAL(3,2), 2) ELSE total_amount END::DOUBLE AS total_amount,
       {_num('discount_percent shipping_cost')} FROM ord""")
def _(t):
    source = t.orders.filter("order_date >= DATE '2001-01-01'").withColumns({
        "total_amount": F.round(F.col("total_amount") * F.lit(1.05).cast("decimal(3,2)"), 2),
        "order_status": F.lit("MERGED")})
    return ts.merge_upsert(t.orders, source, "order_id", update=["total_amount", "order_status"]).table


@query("merge_changed_counts", """
    SELECT COUNT(*) FILTER (NOT known) AS inserted, COUNT(*) FILTER (known AND changed) AS updated, 0 AS deleted,
           COUNT(*) FILTER (known AND NOT changed) AS unchanged,
           COUNT(*) FILTER (NOT known OR changed) AS records_merged
    FROM (SELECT o.order_date < DATE '2001-01-01' AS known,
                 o.order_status <> s.order_status OR o.order_date <> s.order_date AS changed
          FROM stage_one s JOIN ord o USING (order_id))""")
def _(t):
    source = ts.dedupe_latest(t.orders_staging, ["order_id"], [F.desc("order_date")])
    return ts.merge_changed(_loaded(t), source, "order_id", ["order_status", "order_date"]).counts()


def _mirror(t):
    return ts.mirror_sync(t.orders, t.orders.filter("order_status <> 'Cancelled'").withColumn(
        "shipping_cost", F.lit(0).cast("decimal(8,2)")), "order_id")


@query("mirror_sync", f"""SELECT * REPLACE ({_ORD}) FROM (SELECT * REPLACE (0::DECIMAL(8,2) AS shipping_cost) FROM ord
       WHERE order_status <> 'Cancelled')""")
def _(t):
    return _mirror(t).table


@query("mirror_sync_counts", """SELECT 0 AS inserted, COUNT(*) FILTER (order_status <> 'Cancelled') AS updated,
       COUNT(*) FILTER (order_status = 'Cancelled') AS deleted, 0 AS unchanged,
       COUNT(*) FILTER (order_status <> 'Cancelled') AS records_merged FROM ord""")
def _(t):
    return _mirror(t).counts()


# --- conditional updates ------------------------------------------------------------------

@query("apply_discounts", f"""SELECT * REPLACE ({_ORD}) FROM (SELECT * REPLACE (
       CASE WHEN order_date >= {TODAY} - 30 AND discount_percent < 50 THEN
            least(50, discount_percent + CASE WHEN total_amount >= 1000 THEN 5 WHEN total_amount >= 500 THEN 2.5 ELSE 0 END)
            ELSE discount_percent END AS discount_percent) FROM ord)""")
def _(t):
    return ts.apply_discounts(t.orders, AS_OF).table


@query("apply_discounts_count", f"""SELECT COUNT(*) AS updated FROM ord WHERE order_date >= {TODAY} - 30 AND discount_percent < 50""")
def _(t):
    return ts.apply_discounts(t.orders, AS_OF).counts().select("updated")


@query("discount_snapshot", f"""SELECT order_id, discount_percent::DOUBLE AS discount_percent FROM ord WHERE order_date >= {TODAY} - 30""")
def _(t):
    return ts.snapshot(t.orders, AS_OF)


@query("restore_discounts", f"SELECT * REPLACE ({_ORD}) FROM ord")
def _(t):
    return ts.restore_discounts(ts.apply_discounts(t.orders, AS_OF).table, ts.snapshot(t.orders, AS_OF))


@query("update_where_in", f"""SELECT * REPLACE ({_ORD}) FROM (SELECT * REPLACE (
       CASE WHEN order_id IN (SELECT order_id FROM item WHERE quantity >= 50) THEN 'Checked' ELSE order_status END AS order_status) FROM ord)""")
def _(t):
    return ts.update_where_in(t.orders, "order_id", t.order_items.filter("quantity >= 50"),
                              {"order_status": F.lit("Checked")})


@query("delete_where_in", f"""SELECT * REPLACE ({_ORD}) FROM ord WHERE NOT (order_status = 'Cancelled'
       AND order_id IN (SELECT order_id FROM item WHERE quantity >= 50))""")
def _(t):
    return ts.delete_where_in(t.orders, "order_id", t.order_items.filter("quantity >= 50"),
                              F.col("order_status") == "Cancelled")


@query("update_partitions", """SELECT event_id, event_type, CASE WHEN event_type IN ('click', 'view') THEN value * 2 ELSE value END AS value FROM events""")
def _(t):
    return ts.update_partitions(t.raw("events").select("event_id", "event_type", "value"),
                                "event_type", ["click", "view"], "value", F.col("value") * 2)


@query("incremental_append", f"SELECT * REPLACE ({_ORD}) FROM ord")
def _(t):
    return ts.incremental_append(_loaded(t), t.orders, "order_date")


@query("append_counts", "SELECT 3 AS batches, COUNT(*) AS total_rows_inserted FROM ord")
def _(t):
    day = F.to_date("order_date")
    return ts.append_counts([
        t.orders.filter(day < "1997-01-01"),
        t.orders.filter((day >= "1997-01-01") & (day < "2001-01-01")),
        t.orders.filter(day >= "2001-01-01")])


@query("staging_counts", """SELECT (SELECT COUNT(*) FROM ord_stage) AS orders_staging, (SELECT COUNT(*) FROM item_stage) AS order_items_staging,
       (SELECT COUNT(*) FROM ord_stage) + (SELECT COUNT(*) FROM item_stage) AS total_pending""")
def _(t):
    return ts.staging_counts(t.orders_staging, t.order_items_staging)


# --- reconcile, constraints, schema ----------------------------------------------------------

@query("reconcile_stats", """
    WITH k AS (SELECT DISTINCT order_id FROM ord_stage),
    s AS (SELECT (SELECT COUNT(*) FROM k WHERE order_id NOT IN (SELECT order_id FROM item)) AS oo,
                 (SELECT COUNT(*) FROM item WHERE order_id NOT IN (SELECT order_id FROM k)) AS oi,
                 (SELECT COUNT(*) FROM ord_stage) - (SELECT COUNT(*) FROM k) AS dup,
                 (SELECT COUNT(*) FROM k WHERE order_id IN (SELECT order_id FROM item)) AS fo,
                 (SELECT COUNT(*) FROM item WHERE order_id IN (SELECT order_id FROM k)) AS fi)
    SELECT oo AS orphaned_orders_found, oo AS orphaned_orders_deleted, oi AS orphaned_items_found, oi AS orphaned_items_deleted,
           dup AS duplicate_orders_found, dup AS duplicate_orders_deleted, fo AS final_orders_count, fi AS final_items_count FROM s""")
def _(t):
    return ts.reconcile(t.orders_staging, t.order_items).stats


@query("reconcile_orders", """SELECT order_id, MIN(order_date)::VARCHAR AS order_date FROM ord_stage
       WHERE order_id IN (SELECT order_id FROM item) GROUP BY 1""")
def _(t):
    return ts.reconcile(t.orders_staging, t.order_items).orders.select("order_id", "order_date")


RULES = ts.CheckRules({
    "amount_positive": "total_amount >= 0",
    "discount_range": "discount_percent BETWEEN 0 AND 25",
    "known_status": "order_status IN ('Pending', 'Processing', 'Shipped', 'Completed')",
}).add("reasonable_total", "total_amount < 4500")


@query("check_constraints_valid", """SELECT order_id FROM ord WHERE discount_percent <= 25 AND order_status <> 'Cancelled' AND total_amount < 4500""")
def _(t):
    return ts.check_constraints(t.orders, RULES)[0].select("order_id")


@query("check_constraints_rejected", """
    SELECT order_id, concat_ws(',', CASE WHEN discount_percent > 25 THEN 'discount_range' END,
           CASE WHEN order_status = 'Cancelled' THEN 'known_status' END,
           CASE WHEN total_amount >= 4500 THEN 'reasonable_total' END) AS violated
    FROM ord WHERE discount_percent > 25 OR order_status = 'Cancelled' OR total_amount >= 4500""")
def _(t):
    return ts.check_constraints(t.orders, RULES)[1].select("order_id", F.array_join("violated", ",").alias("violated"))


@query("evolve_schema", """SELECT event_id, user_id, NULL::VARCHAR AS session_id, event_type, NULL::VARCHAR AS event_properties,
       ts::VARCHAR AS event_time FROM events""")
def _(t):
    v1 = t.raw("events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("event_time"))
    v2 = T.StructType([*v1.schema.fields[:2], T.StructField("event_type", T.StringType()),
                       T.StructField("event_properties", T.StringType()), T.StructField("event_time", T.TimestampType())])
    v3 = T.StructType([*v2.fields[:2], T.StructField("session_id", T.StringType()), *v2.fields[2:]])
    return ts.evolve_schema(ts.evolve_schema(v1, v2), v3)


@query("add_column_default", """SELECT order_id, CASE WHEN order_date >= DATE '2001-01-01' THEN 'NEW' ELSE 'STANDARD' END AS priority FROM ord""")
def _(t):
    new = t.orders.filter("order_date >= DATE '2001-01-01'").select("order_id", F.lit("NEW").alias("priority"))
    both = sets.union_by_name(_loaded(t).select("order_id"), new)
    return ts.add_column_default(both, "priority", "string", "STANDARD")


# --- change log --------------------------------------------------------------------------------

@query("state_as_of", """SELECT order_id, order_status, total_amount::DOUBLE AS total_amount FROM (SELECT * FROM chg
       WHERE committed_at <= TIMESTAMP '2001-08-01 01:30:00'
       QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY commit_seq DESC) = 1) WHERE op <> 'DELETE'""")
def _(t):
    return ts.as_of(t.order_changes, "order_id", "committed_at", "2001-08-01 01:30:00").select(
        "order_id", "order_status", "total_amount")


@query("state_latest", """SELECT order_id, order_status FROM (SELECT * FROM chg
       QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY commit_seq DESC) = 1) WHERE op <> 'DELETE'""")
def _(t):
    return ts.as_of(t.order_changes, "order_id", "committed_at", "2001-08-02").select("order_id", "order_status")


@query("snapshot_history", """SELECT commit_seq, committed_at::VARCHAR AS committed_at, COUNT(*) AS changes,
       COUNT(*) FILTER (op = 'INSERT') AS inserted, COUNT(*) FILTER (op = 'UPDATE') AS updated,
       COUNT(*) FILTER (op = 'DELETE') AS deleted FROM chg GROUP BY commit_seq, chg.committed_at""")
def _(t):
    return ts.snapshot_history(t.order_changes)


SHARED_SQL["lin"] = """
    SELECT order_id, MIN(commit_seq) AS created_seq, MAX(commit_seq) AS last_updated_seq FROM chg
    GROUP BY order_id HAVING arg_max(op, commit_seq) <> 'DELETE'"""


@query("row_lineage", "SELECT * FROM lin")
def _(t):
    return ts.row_lineage(t.order_changes, "order_id")


@query("rows_per_commit", "SELECT last_updated_seq AS commit_seq, COUNT(*) AS rows_touched FROM lin GROUP BY 1")
def _(t):
    return ts.rows_per_commit(ts.row_lineage(t.order_changes, "order_id"))


@query("changed_after_commit", "SELECT * FROM lin WHERE last_updated_seq > 1")
def _(t):
    return ts.changed_after(ts.row_lineage(t.order_changes, "order_id"), 1)


# --- sets and chains -----------------------------------------------------------------------------

@query("union_by_name", """
    SELECT customer_id, first_name, last_name, state, NULL AS customer_segment, NULL AS registration_date FROM cust WHERE customer_segment = 'Premium'
    UNION ALL SELECT customer_id, first_name, last_name, state, customer_segment, registration_date::VARCHAR FROM cust WHERE customer_segment = 'Basic'""")
def _(t):
    old = t.customers.filter("customer_segment = 'Premium'").select("last_name", "customer_id", "first_name", "state")
    new = t.customers.filter("customer_segment = 'Basic'").select(
        "registration_date", "customer_id", "first_name", "last_name", "state", "customer_segment")
    return sets.union_by_name(old, new)


@query("union_distinct_by_name", "SELECT state, customer_segment FROM cust UNION SELECT state, customer_segment FROM cust")
def _(t):
    return sets.union_by_name(t.customers.select("state", "customer_segment"),
                              t.customers.select("customer_segment", "state"), distinct=True)


@query("except_by_name", """SELECT customer_id, order_status FROM ord EXCEPT SELECT customer_id, order_status FROM ord WHERE order_date < DATE '2001-01-01'""")
def _(t):
    return sets.except_by_name(t.orders.select("customer_id", "order_status"), _loaded(t).select("order_status", "customer_id"))


@query("intersect_by_name", """SELECT customer_id, order_status FROM ord WHERE order_date >= DATE '2001-01-01'
       INTERSECT SELECT customer_id, order_status FROM ord WHERE order_date < DATE '2001-01-01'""")
def _(t):
    return sets.intersect_by_name(t.orders.filter("order_date >= DATE '2001-01-01'").select("customer_id", "order_status"),
                                  _loaded(t).select("order_status", "customer_id"))


@query("distinct_rows", "SELECT DISTINCT customer_segment, state FROM cust")
def _(t):
    return t.customers.select("customer_segment", "state").distinct()


@query("table_summaries", """
    SELECT 'orders' AS table_name, COUNT(*) AS record_count, SUM(total_amount)::DOUBLE AS total_value, NULL::BIGINT AS unique_states, NULL::BIGINT AS unique_categories FROM ord
    UNION ALL SELECT 'customers', COUNT(*), NULL, COUNT(DISTINCT state), NULL FROM cust
    UNION ALL SELECT 'products', COUNT(*), SUM(price)::DOUBLE, NULL, COUNT(DISTINCT product_category) FROM cat""")
def _(t):
    return sets.table_summaries(t.orders, t.customers, t.product_catalog)


@query("state_customer_count", "SELECT COUNT(*) AS customer_count FROM cust WHERE state = 'CO'")
def _(t):
    return sets.state_customer_count(t.customers, "CO")


@query("high_value_stats", """SELECT 'orders above 500' AS metric_type, SUM(total_amount)::DOUBLE / COUNT(*) AS avg_amount,
       MIN(total_amount)::DOUBLE AS min_amount, MAX(total_amount)::DOUBLE AS max_amount
       FROM (SELECT total_amount FROM ord WHERE total_amount > 500 ORDER BY order_id LIMIT 100)""")
def _(t):
    return sets.high_value_stats(t.orders)


@query("counts_for_customers", """SELECT c.customer_id, COUNT(o.order_id) AS order_count
       FROM (SELECT customer_id FROM cust WHERE customer_segment = 'Premium' ORDER BY customer_id LIMIT 10) c
       LEFT JOIN ord o USING (customer_id) GROUP BY 1""")
def _(t):
    return sets.counts_for_customers(t.customers, t.orders)


@query("multi_table_counts", """SELECT 'customers' AS table_name, COUNT(*) AS row_count FROM cust
       UNION ALL SELECT 'orders', COUNT(*) FROM ord UNION ALL SELECT 'order_items', COUNT(*) FROM item""")
def _(t):
    return layer_counts({"customers": t.customers, "orders": t.orders, "order_items": t.order_items})


@query("orders_by_month", "SELECT date_trunc('month', order_date)::TIMESTAMP::VARCHAR AS month, COUNT(*) AS orders FROM ord GROUP BY 1")
def _(t):
    return sets.orders_by_month(t.orders)


@query("customers_by_segment", "SELECT customer_segment, COUNT(*) AS customers FROM cust GROUP BY 1")
def _(t):
    return sets.customers_by_segment(t.customers)


# --- time series -------------------------------------------------------------------------------------

HOUR = timedelta(hours=1)

SHARED_SQL["grid"] = """
    SELECT * FROM (
        SELECT ts::TIMESTAMP AS ts, event_type, value, false AS is_generated FROM events
        UNION ALL
        SELECT g.ts, g.event_type, NULL, true
        FROM (SELECT event_type, unnest(generate_series(date_trunc('hour', MIN(ts)::TIMESTAMP), date_trunc('hour', MAX(ts)::TIMESTAMP), INTERVAL 1 HOUR)) AS ts
              FROM events GROUP BY event_type) g
        WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.event_type = g.event_type AND e.ts::TIMESTAMP = g.ts))"""

SHARED_SQL["walk"] = """
    SELECT *, LAST_VALUE(value IGNORE NULLS) OVER w AS pv, LAST_VALUE(CASE WHEN value IS NOT NULL THEN ts END IGNORE NULLS) OVER w AS pt,
           FIRST_VALUE(value IGNORE NULLS) OVER v AS nv, FIRST_VALUE(CASE WHEN value IS NOT NULL THEN ts END IGNORE NULLS) OVER v AS nt
    FROM grid
    WINDOW w AS (PARTITION BY event_type ORDER BY ts, value NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
           v AS (PARTITION BY event_type ORDER BY ts, value NULLS FIRST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""

_LINEAR = """coalesce(value, pv + (nv - pv) * ((epoch_us(ts) - epoch_us(pt))::DOUBLE / (epoch_us(nt) - epoch_us(pt))::DOUBLE))"""


def _series(t):
    return t.raw("events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")


def _hours(t):
    return tm.resample(_series(t), "ts", HOUR, ["event_type"], metadata=True)


@query("resample", "SELECT ts::VARCHAR AS ts, event_type, value FROM grid")
def _(t):
    return tm.resample(_series(t), "ts", HOUR, ["event_type"])


@query("resample_metadata", """SELECT ts::VARCHAR AS ts, event_type, value, is_generated,
       date_trunc('hour', grid.ts)::TIMESTAMP::VARCHAR AS bucket_start FROM grid""")
def _(t):
    return _hours(t)


@query("resample_generated", "SELECT ts::VARCHAR AS ts, event_type FROM grid WHERE is_generated")
def _(t):
    return tm.generated_rows(_hours(t)).select("ts", "event_type")


@query("resample_uniform", "SELECT ts::VARCHAR AS ts, event_type, value, is_generated FROM grid WHERE grid.ts = date_trunc('hour', grid.ts)")
def _(t):
    return tm.uniform_rows(_hours(t), "ts").drop("bucket_start")


@query("interpolate_ffill", "SELECT ts::VARCHAR AS ts, event_type, value, pv AS value_ffill FROM walk")
def _(t):
    return tm.interpolate(_hours(t).select("ts", "event_type", "value"), "ts", ["event_type"], ["value"], "ffill", "ffill")


@query("interpolate_bfill", "SELECT ts::VARCHAR AS ts, event_type, value, nv AS value_bfill FROM walk")
def _(t):
    return tm.interpolate(_hours(t).select("ts", "event_type", "value"), "ts", ["event_type"], ["value"], "bfill", "bfill")


@query("interpolate_linear", f"SELECT ts::VARCHAR AS ts, event_type, value, round({_LINEAR}, 6) AS value_linear FROM walk")
def _(t):
    return tm.interpolate(_hours(t).select("ts", "event_type", "value"), "ts", ["event_type"], ["value"], "linear", "linear") \
        .withColumn("value_linear", F.round("value_linear", 6))


@query("resample_fill", f"SELECT ts::VARCHAR AS ts, event_type, round({_LINEAR}, 6) AS value, is_generated FROM walk")
def _(t):
    return tm.resample_fill(_series(t), "ts", HOUR, ["event_type"], ["value"]).withColumn("value", F.round("value", 6))


@query("daily_orders_filled", """
    WITH d AS (SELECT date_trunc('day', order_date)::TIMESTAMP AS order_day, COUNT(*) AS order_count, SUM(total_amount)::DOUBLE AS daily_revenue FROM ord GROUP BY 1),
    g AS (SELECT unnest(generate_series((SELECT MIN(order_day) FROM d), (SELECT MAX(order_day) FROM d), INTERVAL 1 DAY)) AS order_day)
    SELECT g.order_day::VARCHAR AS order_day, order_count, daily_revenue, coalesce(order_count, 0) AS orders_filled, order_count IS NULL AS is_generated
    FROM g LEFT JOIN d USING (order_day)""")
def _(t):
    return tm.daily_orders_filled(t.orders)


# --- data quality ------------------------------------------------------------------------------------------

AT = "2001-08-02 00:00:00"


def _seeded(t):
    """Orders joined to their ticket customer: unmatched customers leave NULLs to find."""
    known = t.support_tickets.select("customer_id").distinct().withColumn("seen", F.lit(True))
    orders = t.orders.join(known, "customer_id", "left").withColumn(
        "customer_id", F.when(F.col("seen"), F.col("customer_id"))).drop("seen")
    return {"orders": orders, "order_items": t.order_items, "staging_items": t.order_items_staging}


SHARED_SQL["dq"] = """
    SELECT 'orders' AS table_name, column_name, 'NULL_COUNT' AS metric,
           CASE column_name WHEN 'customer_id' THEN (SELECT COUNT(*) FROM ord WHERE customer_id NOT IN (SELECT customer_id FROM tick)) ELSE 0 END::DOUBLE AS value
    FROM (SELECT unnest(['order_id', 'customer_id', 'order_date', 'total_amount']) AS column_name)
    UNION ALL SELECT 'order_items', unnest(['order_item_id', 'order_id', 'product_id', 'quantity', 'unit_price']), 'NULL_COUNT', 0
    UNION ALL SELECT 'staging_items', 'order_item_id', 'DUPLICATE_COUNT', COUNT(*) - COUNT(DISTINCT order_item_id) FROM item_stage
    UNION ALL SELECT 'orders', 'order_date', 'FRESHNESS', epoch(TIMESTAMP '2001-08-02') - epoch(MAX(order_date)) FROM ord
    UNION ALL SELECT 'orders', 'total_amount', 'SMALL_TOTAL', COUNT(*) FROM ord WHERE total_amount < 50"""


def _results(t):
    return quality.dq_results(
        _seeded(t), AT, keys={"staging_items": "order_item_id"}, fresh={"orders": "order_date"},
        rules={"SMALL_TOTAL": ("orders", "total_amount", F.col("total_amount") < 50)})


EXPECTATIONS = [
    quality.Expectation("zero_nulls", "orders", "customer_id", "NULL_COUNT", "=", 0, "block"),
    quality.Expectation("zero_null_ids", "orders", "order_id", "NULL_COUNT", "=", 0, "block"),
    quality.Expectation("few_small", "orders", "total_amount", "SMALL_TOTAL", "<", 5, "alert"),
    quality.Expectation("fresh_day", "orders", "order_date", "FRESHNESS", "<", 90000, "alert"),
    quality.Expectation("fresh_30min", "orders", "order_date", "FRESHNESS", "<", 1800, "log"),
]

_RULES_SQL = """(VALUES
    ('zero_nulls', 'orders', 'customer_id', 'NULL_COUNT', '=', 0, 'block'),
    ('zero_null_ids', 'orders', 'order_id', 'NULL_COUNT', '=', 0, 'block'),
    ('few_small', 'orders', 'total_amount', 'SMALL_TOTAL', '<', 5, 'alert'),
    ('fresh_day', 'orders', 'order_date', 'FRESHNESS', '<', 90000, 'alert'),
    ('fresh_30min', 'orders', 'order_date', 'FRESHNESS', '<', 1800, 'log')) r(expectation, table_name, column_name, metric, op, lim, tier)"""


@query("dq_blocking", f"""SELECT 'blocked' AS outcome, string_agg(expectation, ', ' ORDER BY expectation) AS rules
       FROM dq JOIN {_RULES_SQL} USING (table_name, column_name, metric) WHERE tier = 'block' AND value <> lim HAVING COUNT(*) > 0
       UNION ALL SELECT 'alert', string_agg(expectation, ', ' ORDER BY expectation)
       FROM dq JOIN {_RULES_SQL} USING (table_name, column_name, metric) WHERE tier = 'alert' AND value >= lim HAVING COUNT(*) > 0""")
def _(t):
    """What the blocking tier stops, and what is only reported once it is left out."""
    gated = quality.dq_gate(quality.evaluate_expectations(_results(t), EXPECTATIONS))
    out = []
    try:
        quality.enforce(gated)
    except quality.QualityError as stop:
        out.append(("blocked", str(stop).removeprefix("blocked by ")))
    alerts = quality.enforce(gated.filter(F.col("tier") != "block")).select("expectation").distinct().collect()
    if alerts:
        out.append(("alert", ", ".join(sorted(r[0] for r in alerts))))
    return t.spark.createDataFrame(out, "outcome string, rules string")


@query("null_counts", "SELECT column_name, value FROM (SELECT column_name, value::BIGINT AS value FROM dq WHERE table_name = 'orders' AND metric = 'NULL_COUNT')")
def _(t):
    return quality.null_counts(_seeded(t)["orders"], quality.WATCHED["orders"])


@query("freshness", "SELECT (epoch(TIMESTAMP '2001-08-02') - epoch(MAX(order_date)))::BIGINT AS value FROM ord")
def _(t):
    return quality.freshness(t.orders, "order_date", AT)


@query("custom_metric", "SELECT 'SMALL_TOTAL' AS metric, COUNT(*) AS value FROM ord WHERE total_amount < 50")
def _(t):
    return quality.custom_metric(t.orders, "SMALL_TOTAL", F.col("total_amount") < 50)


@query("dq_results", "SELECT *, '2001-08-02 00:00:00' AS measured_at FROM dq")
def _(t):
    return _results(t)


@query("dq_expectations", f"""SELECT expectation, dq.table_name, dq.column_name, dq.metric, value,
       CASE op WHEN '=' THEN value = lim ELSE value < lim END AS passed,
       CASE WHEN CASE op WHEN '=' THEN value = lim ELSE value < lim END THEN 'none' ELSE tier END AS action
       FROM dq JOIN {_RULES_SQL} USING (table_name, column_name, metric)""")
def _(t):
    return quality.dq_gate(quality.evaluate_expectations(_results(t), EXPECTATIONS)).select(
        "expectation", "table_name", "column_name", "metric", "value", "passed", "action")


@query("dq_alert", """SELECT '2001-08-02 00:05:00' AS alert_time, 'Data Quality Issue: NULL values detected' AS issue_summary
       WHERE EXISTS (SELECT 1 FROM dq WHERE metric = 'NULL_COUNT' AND value > 0)""")
def _(t):
    return quality.dq_alert(_results(t), "2001-08-02 00:05:00", 10)


@query("dq_severity", """SELECT metric AS check_name, table_name, column_name, value::BIGINT AS issue_count,
       CASE WHEN value > 0 THEN 'HIGH' ELSE 'OK' END AS severity FROM dq""")
def _(t):
    return quality.dq_severity(_results(t))


@query("schema_tests", """
    SELECT 'order_item_id' AS column_name, 'unique' AS test,
           (SELECT COUNT(*) FROM (SELECT 1 FROM item_stage GROUP BY order_item_id HAVING COUNT(*) > 1)) AS failures
    UNION ALL SELECT 'order_item_id', 'not_null', COUNT(*) FILTER (order_item_id IS NULL) FROM item_stage
    UNION ALL SELECT 'product_category', 'accepted_values', COUNT(*) FILTER (product_category NOT IN ('SMALL', 'ECONOMY')) FROM item_stage
    UNION ALL SELECT 'quantity', 'not_null', COUNT(*) FILTER (quantity IS NULL) FROM item_stage""")
def _(t):
    return quality.schema_tests(t.order_items_staging, {
        "order_item_id": {"unique": True, "not_null": True},
        "product_category": {"accepted_values": ["SMALL", "ECONOMY"]},
        "quantity": {"not_null": True}})


@query("consistency_check", """SELECT customer_id, COUNT(*) AS total_orders, SUM(total_amount)::DOUBLE AS total_spent, COUNT(*) AS base_orders,
       SUM(total_amount)::DOUBLE AS base_spent, true AS consistent FROM ord JOIN cust USING (customer_id) GROUP BY 1""")
def _(t):
    return quality.consistency_check(customer_order_analytics(t.customers, t.orders), t.customers, t.orders)


# --- row policy ----------------------------------------------------------------------------------------------

@query("policy_manager", "SELECT state, COUNT(*) AS customers FROM cust WHERE state IN ('CA', 'OR', 'WA') GROUP BY 1")
def _(t):
    return policy.apply_row_policy(t.customers, ["WEST_COAST_MANAGER"]).groupBy("state").agg(F.count("*").alias("customers"))


@query("policy_admin", "SELECT state, COUNT(*) AS customers FROM cust GROUP BY 1")
def _(t):
    return policy.apply_row_policy(t.customers, ["ADMIN", "WEST_COAST_MANAGER"]).groupBy("state").agg(
        F.count("*").alias("customers"))


@query("policy_guarded_revenue", """SELECT c.state, SUM(o.total_amount)::DOUBLE AS revenue FROM cust c JOIN ord o USING (customer_id)
       WHERE c.state IN ('CA', 'OR', 'WA') GROUP BY 1""")
def _(t):
    guarded = policy.GuardedTables({"customers": t.customers, "orders": t.orders}, ["WEST_COAST_MANAGER"],
                                   {"customers": policy.CUSTOMER_REGION})
    return guarded["customers"].join(guarded["orders"], "customer_id").groupBy("state").agg(
        F.sum("total_amount").alias("revenue"))
