"""Registration of queries with their oracle SQL.

Results are presented in types every engine prints the same way: decimals as
double, dates and timestamps as text, integers as 64 bit.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.session import apply_runtime_conf
from tillwise.sources.fixtures import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Entities as DuckDB SQL over the raw tables; see tillwise.sources.fixtures.
ENTITY_SQL = {
    "cust": """
        SELECT c_custkey AS customer_id, 'Customer' AS first_name, c_custkey::VARCHAR AS last_name,
               'customer' || c_custkey || '@email.com' AS email,
               '555-' || (c_custkey % 900 + 100) || '-' || (c_custkey % 9000 + 1000) AS phone,
               (c_custkey % 9900 + 100) || ' Main St' AS address, 'City ' || c_nationkey AS city,
               ['CO','UT','WY','CA','WA','OR','MT','ID','NV','BC'][c_nationkey % 10 + 1] AS state,
               (c_custkey % 90000 + 10000)::VARCHAR AS zip_code,
               DATE '1995-01-01' + (c_custkey * 37 % 1825)::INT AS registration_date,
               CASE WHEN c_mktsegment IN ('AUTOMOBILE','BUILDING') THEN 'Premium'
                    WHEN c_mktsegment IN ('FURNITURE','MACHINERY') THEN 'Standard' ELSE 'Basic' END AS customer_segment
        FROM customer""",
    "ord": """
        SELECT o_orderkey::VARCHAR AS order_id, o_custkey AS customer_id, o_orderdate::TIMESTAMP AS order_date,
               CASE WHEN o_orderstatus = 'F' THEN 'Completed'
                    WHEN o_orderstatus = 'O' AND o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'Shipped'
                    WHEN o_orderstatus = 'O' THEN 'Processing'
                    WHEN o_orderpriority = '5-LOW' THEN 'Cancelled' ELSE 'Pending' END AS order_status,
               ROUND(o_totalprice::DECIMAL(14,2) * 0.01::DECIMAL(3,2), 2)::DECIMAL(10,2) AS total_amount,
               ((o_orderkey % 7) * 5)::DECIMAL(5,2) AS discount_percent,
               (o_orderkey % 46 + 5)::DECIMAL(8,2) AS shipping_cost
        FROM orders""",
    "cat": """
        SELECT p_partkey AS product_id, p_name AS product_name, p_type AS product_category,
               p_name || ' ' || p_brand AS description, p_brand AS features,
               ROUND(p_retailprice::DECIMAL(14,2) * 0.1::DECIMAL(3,1), 2)::DECIMAL(10,2) AS price,
               (p_partkey * 7 % 300)::INT AS stock_quantity
        FROM part WHERE p_partkey IN (SELECT MIN(p_partkey) FROM part GROUP BY p_name)""",
    "item_base": """
        SELECT l.*, (l_extendedprice::DECIMAL(14,2) * 100)::BIGINT AS cents, l_quantity::INT AS qty,
               cat.product_id, cat.product_name, cat.product_category
        FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN cat ON cat.product_name = p.p_name""",
    "item": """
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, qty,
                         l_extendedprice::DECIMAL(14,2), strftime(l_shipdate, '%Y%m%d')) AS order_item_id,
               l_orderkey::VARCHAR AS order_id, product_id, product_name, product_category, qty AS quantity,
               (((2 * cents + 100 * qty) // (200 * qty))::DECIMAL(14,0) * 0.01::DECIMAL(3,2))::DECIMAL(10,2) AS unit_price,
               (((cents + 50) // 100)::DECIMAL(14,0) * 0.01::DECIMAL(3,2))::DECIMAL(12,2) AS line_total
        FROM item_base""",
    "item_stage": """
        SELECT concat_ws('-', l_orderkey, l_linenumber) AS order_item_id,
               l_orderkey::VARCHAR AS order_id, product_id, product_name, product_category, qty AS quantity,
               (((2 * cents + 100 * qty) // (200 * qty))::DECIMAL(14,0) * 0.01::DECIMAL(3,2))::DOUBLE AS unit_price,
               (((cents + 50) // 100)::DECIMAL(14,0) * 0.01::DECIMAL(3,2))::DOUBLE AS line_total
        FROM item_base""",
    "ord_stage": """
        SELECT order_id, customer_id, order_date, order_status, total_amount::DOUBLE AS total_amount,
               discount_percent::DOUBLE AS discount_percent, shipping_cost::DOUBLE AS shipping_cost FROM ord
        UNION ALL
        SELECT order_id, customer_id, order_date + INTERVAL 1 HOUR, 'Completed', total_amount::DOUBLE,
               discount_percent::DOUBLE, shipping_cost::DOUBLE FROM ord WHERE order_id::BIGINT % 10 = 0""",
    "rev": """
        SELECT doc_id AS review_id, p.product_id, doc_id % (SELECT COUNT(*) FROM customer) AS customer_id,
               DATE '2001-07-03' + (doc_id % 30)::INT AS review_date, (doc_id % 5 + 1)::INT AS rating,
               split_part(text, chr(10), 1) AS review_title, text AS review_text, doc_id % 4 <> 3 AS verified_purchase
        FROM documents JOIN (SELECT product_id, ROW_NUMBER() OVER (ORDER BY product_id) - 1 AS pos FROM cat) p
          ON p.pos = doc_id % (SELECT COUNT(*) FROM cat)""",
    "tick": """
        SELECT event_id AS ticket_id, user_id AS customer_id, ts::TIMESTAMP AS ticket_date, category,
               ['Low','Medium','High','Urgent'][event_id % 4 + 1] AS priority,
               category || ' issue' AS subject, category || ' issue ' || props AS description,
               CASE WHEN status IN ('Resolved','Closed') THEN 'Handled' END AS resolution, status
        FROM (SELECT *, ['Shipping','Product Quality','Billing','Returns','General Inquiry','Account Issues',
                         'Order Status','Technical Support'][event_id % 8 + 1] AS category,
                     ['Open','In Progress','Resolved','Closed'][(event_id + event_id // 4) % 4 + 1] AS status
              FROM events WHERE event_type = 'error')""",
    "qlog": """
        SELECT event_id AS query_id, ts::TIMESTAMP AS start_time, event_type AS source, value::DECIMAL(12,2) AS execution_time,
               CASE WHEN event_type = 'error' THEN 'FAIL' ELSE 'SUCCESS' END AS execution_status,
               event_id % 97 + 1 AS partitions_scanned, 100::BIGINT AS partitions_total,
               (event_id % 13)::DECIMAL(12,2) AS queued_time
        FROM events""",
    "chg": """
        SELECT *, 1 AS commit_seq, 'INSERT' AS op, TIMESTAMP '2001-08-01' AS committed_at FROM ord
        UNION ALL
        SELECT * REPLACE ('Completed' AS order_status), 2, 'UPDATE', TIMESTAMP '2001-08-01 01:00:00'
        FROM ord WHERE order_id::BIGINT % 10 = 0
        UNION ALL
        SELECT *, 3, 'DELETE', TIMESTAMP '2001-08-01 02:00:00' FROM ord WHERE order_id::BIGINT % 50 = 0""",
}

# Derived relations that several oracles share; filled by the modules.
SHARED_SQL: dict[str, str] = {}


def _needed(sql: str, names: dict[str, str]) -> list[str]:
    order: list[str] = []

    def visit(text: str) -> None:
        for name in names:
            if name not in order and re.search(rf"(?:FROM|JOIN)\s+\(?{name}\b", text):
                visit(names[name])
                if name not in order:
                    order.append(name)

    visit(sql)
    return order


def with_entities(sql: str) -> str:
    """Prefix a query with the relations it reads."""
    names = {**ENTITY_SQL, **SHARED_SQL}
    ctes = [f"{n} AS ({names[n]})" for n in _needed(sql, names)]
    if not ctes:
        return sql
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def oracles() -> dict[str, str]:
    """All oracle statements, complete with the relations they read."""
    return {name: with_entities(sql) for name, sql in ORACLES.items()}


def present(df: DataFrame) -> DataFrame:
    """Plain, engine-neutral types for comparison."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(name: str, sql: str | None = None):
    """Register a function of :class:`Tables` under ``name``."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_runtime_conf(spark)
            return present(fn(Tables(spark, sf_dir)))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
