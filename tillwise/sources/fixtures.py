"""Retail entities derived from the TPC-H-like test tables.

The mapping is deterministic and integer- or decimal-based, so another SQL engine
can reproduce every value exactly. ``Tables`` builds each entity lazily; a query
that needs only orders never plans a scan of the items.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise import schemas
from tillwise.functions.ranking import dense_position

AS_OF = "2001-08-02"

# Label lists the mapping indexes with a modulo.
STATES = ["CO", "UT", "WY", "CA", "WA", "OR", "MT", "ID", "NV", "BC"]
TICKET_CATEGORIES = ["Shipping", "Product Quality", "Billing", "Returns", "General Inquiry",
                     "Account Issues", "Order Status", "Technical Support"]
PRIORITIES = ["Low", "Medium", "High", "Urgent"]
TICKET_STATES = ["Open", "In Progress", "Resolved", "Closed"]


def _pick(labels: list[str], index):
    return F.element_at(F.array(*[F.lit(x) for x in labels]), (index + F.lit(1)).cast("int"))


def _cents(c: str):
    """Two-decimal double as an exact count of cents."""
    return (F.col(c).cast("decimal(14,2)") * F.lit(100)).cast("bigint")


class Tables:
    """Entities over one directory of test tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def customers(self) -> DataFrame:
        k = F.col("c_custkey")
        df = self.raw("customer").select(
            k.alias("customer_id"),
            F.lit("Customer").alias("first_name"),
            k.cast("string").alias("last_name"),
            F.concat(F.lit("customer"), k.cast("string"), F.lit("@email.com")).alias("email"),
            F.concat(F.lit("555-"), (k % 900 + 100).cast("string"), F.lit("-"),
                     (k % 9000 + 1000).cast("string")).alias("phone"),
            F.concat((k % 9900 + 100).cast("string"), F.lit(" Main St")).alias("address"),
            F.concat(F.lit("City "), F.col("c_nationkey").cast("string")).alias("city"),
            _pick(STATES, F.col("c_nationkey") % 10).alias("state"),
            (k % 90000 + 10000).cast("string").alias("zip_code"),
            F.date_add(F.lit("1995-01-01").cast("date"), (k * 37 % 1825).cast("int")).alias("registration_date"),
            F.when(F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING"), "Premium")
            .when(F.col("c_mktsegment").isin("FURNITURE", "MACHINERY"), "Standard")
            .otherwise("Basic").alias("customer_segment"),
        )
        return schemas.conform(df, schemas.CUSTOMERS)

    @cached_property
    def orders(self) -> DataFrame:
        k, status, prio = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderpriority")
        df = self.raw("orders").select(
            k.cast("string").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("timestamp").alias("order_date"),
            F.when(status == "F", "Completed")
            .when((status == "O") & prio.isin("1-URGENT", "2-HIGH"), "Shipped")
            .when(status == "O", "Processing")
            .when(prio == "5-LOW", "Cancelled")
            .otherwise("Pending").alias("order_status"),
            F.round(F.col("o_totalprice").cast("decimal(14,2)") / 100, 2).alias("total_amount"),
            ((k % 7) * 5).alias("discount_percent"),
            (k % 46 + 5).alias("shipping_cost"),
        )
        return schemas.conform(df, schemas.ORDERS)

    @cached_property
    def product_catalog(self) -> DataFrame:
        part = self.raw("part")
        df = (
            part.groupBy("p_name").agg(F.min_by(
                F.struct("p_partkey", "p_brand", "p_type", "p_retailprice"), "p_partkey").alias("p"))
            .select(
                F.col("p.p_partkey").alias("product_id"),
                F.col("p_name").alias("product_name"),
                F.col("p.p_type").alias("product_category"),
                F.concat_ws(" ", "p_name", "p.p_brand").alias("description"),
                F.col("p.p_brand").alias("features"),
                F.round(F.col("p.p_retailprice").cast("decimal(14,2)") / 10, 2).alias("price"),
                (F.col("p.p_partkey") * 7 % 300).alias("stock_quantity"),
            )
        )
        return schemas.conform(df, schemas.PRODUCT_CATALOG)

    def _items(self, key) -> DataFrame:
        cents = _cents("l_extendedprice")
        qty = F.col("l_quantity").cast("int")
        # Joined one after the other: each small side then has a size Spark knows, while
        # the estimate for part joined to catalogue would be the product of both.
        names = self.raw("part").select("p_partkey", "p_name")
        products = self.product_catalog.select("product_id", "product_category", "product_name")
        df = (
            self.raw("lineitem")
            .withColumns({"__cents": cents, "__qty": qty})
            .join(names, F.col("l_partkey") == F.col("p_partkey"))
            .join(products, F.col("p_name") == F.col("product_name"))
            .select(
                key.alias("order_item_id"),
                F.col("l_orderkey").cast("string").alias("order_id"),
                "product_id", "product_name", "product_category",
                F.col("__qty").alias("quantity"),
                # Half-up on whole numbers: cents / 100 / quantity.
                (F.expr("(2 * __cents + 100 * __qty) div (200 * __qty)").cast("decimal(14,0)")
                 / F.lit(100)).alias("unit_price"),
                (F.expr("(__cents + 50) div 100").cast("decimal(14,0)") / F.lit(100)).alias("line_total"),
            )
        )
        return schemas.conform(df, schemas.ORDER_ITEMS)

    @cached_property
    def order_items(self) -> DataFrame:
        return self._items(F.concat_ws(
            "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
            F.col("l_quantity").cast("int"), F.col("l_extendedprice").cast("decimal(14,2)"),
            F.date_format("l_shipdate", "yyyyMMdd")))

    @cached_property
    def order_items_staging(self) -> DataFrame:
        """Items keyed by order and line only, which repeat."""
        items = self._items(F.concat_ws("-", "l_orderkey", "l_linenumber"))
        return schemas.conform(items, schemas.ORDER_ITEMS_STAGING)

    @cached_property
    def orders_staging(self) -> DataFrame:
        """Every order, and a second, later version of each tenth one."""
        later = self.orders.filter(F.col("order_id").cast("bigint") % 10 == 0).withColumns({
            "order_date": F.col("order_date") + F.expr("INTERVAL 1 HOUR"),
            "order_status": F.lit("Completed"),
        })
        return schemas.conform(self.orders.unionByName(later), schemas.ORDERS_STAGING)

    @cached_property
    def product_reviews(self) -> DataFrame:
        products = dense_position(self.product_catalog.select("product_id"), "product_id", "__pos")
        docs = self.documents
        n_products = self.product_catalog.agg(F.count("*")).scalar()
        n_customers = self.raw("customer").agg(F.count("*")).scalar()
        df = (
            docs.withColumn("__slot", F.col("doc_id") % n_products)
            .join(products, F.col("__slot") == F.col("__pos"))
            .select(
                F.col("doc_id").alias("review_id"),
                "product_id",
                (F.col("doc_id") % n_customers).alias("customer_id"),
                F.date_add(F.lit("2001-07-03").cast("date"), (F.col("doc_id") % 30).cast("int")).alias("review_date"),
                (F.col("doc_id") % 5 + 1).alias("rating"),
                F.substring_index("text", "\n", 1).alias("review_title"),
                F.col("text").alias("review_text"),
                (F.col("doc_id") % 4 != 3).alias("verified_purchase"),
            )
        )
        return schemas.conform(df, schemas.PRODUCT_REVIEWS)

    @cached_property
    def documents(self) -> DataFrame:
        return self.raw("documents")

    @cached_property
    def support_tickets(self) -> DataFrame:
        e = F.col("event_id")
        status = _pick(TICKET_STATES, (e + F.floor(e / 4)) % 4)
        category = _pick(TICKET_CATEGORIES, e % 8)
        df = self.raw("events").filter(F.col("event_type") == "error").select(
            e.alias("ticket_id"),
            F.col("user_id").alias("customer_id"),
            F.col("ts").alias("ticket_date"),
            category.alias("category"),
            _pick(PRIORITIES, e % 4).alias("priority"),
            F.concat(category, F.lit(" issue")).alias("subject"),
            F.concat(category, F.lit(" issue "), F.col("props")).alias("description"),
            F.when(status.isin("Resolved", "Closed"), F.lit("Handled")).alias("resolution"),
            status.alias("status"),
        )
        return schemas.conform(df, schemas.SUPPORT_TICKETS)

    @cached_property
    def query_log(self) -> DataFrame:
        """Events read as a workload log."""
        return self.raw("events").select(
            F.col("event_id").alias("query_id"),
            F.col("ts").cast("timestamp").alias("start_time"),
            F.col("event_type").alias("source"),
            F.col("value").cast("decimal(12,2)").alias("execution_time"),
            F.when(F.col("event_type") == "error", "FAIL").otherwise("SUCCESS").alias("execution_status"),
            (F.col("event_id") % 97 + 1).alias("partitions_scanned"),
            F.lit(100).cast("bigint").alias("partitions_total"),
            (F.col("event_id") % 13).cast("decimal(12,2)").alias("queued_time"),
        )

    @cached_property
    def order_changes(self) -> DataFrame:
        """Change log: every order at commit 1, each tenth changed at 2, each 50th deleted at 3."""
        k = F.col("order_id").cast("bigint")
        day = F.lit("2001-08-01").cast("timestamp")
        first = self.orders.withColumns({
            "commit_seq": F.lit(1).cast("bigint"), "op": F.lit("INSERT"), "committed_at": day})
        second = self.orders.filter(k % 10 == 0).withColumns({
            "order_status": F.lit("Completed"), "commit_seq": F.lit(2).cast("bigint"),
            "op": F.lit("UPDATE"), "committed_at": day + F.expr("INTERVAL 1 HOUR")})
        third = self.orders.filter(k % 50 == 0).withColumns({
            "commit_seq": F.lit(3).cast("bigint"), "op": F.lit("DELETE"),
            "committed_at": day + F.expr("INTERVAL 2 HOUR")})
        return first.unionByName(second).unionByName(third)

    def all(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in (
            "customers", "orders", "order_items", "product_catalog", "product_reviews",
            "support_tickets")}


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All typed base entities by name."""
    return Tables(spark, sf_dir).all()
