"""Governed metrics: a catalogue of named dimensions and metrics over a join graph.

``SemanticModel.query`` turns names into one DataFrame plan. Every metric is
aggregated at the grain of its own table, so a join can never count an order once
per item; a dimension that is not reachable by many-to-one steps from the metric's
table is an error.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.functions.semantics import days_before, mean, ratio


@dataclass(frozen=True)
class Named:
    """A dimension, fact, metric or filter of one table."""

    name: str
    table: str
    expr: Callable[[], Column]
    synonyms: tuple[str, ...] = ()
    default: str | None = None  # default aggregation of a fact


@dataclass(frozen=True)
class Link:
    """A many-to-one relationship by equal keys."""

    many: str
    one: str
    key: str


@dataclass
class SemanticModel:
    tables: dict[str, DataFrame]
    primary_keys: dict[str, str]
    links: list[Link] = field(default_factory=list)
    facts: list[Named] = field(default_factory=list)
    dimensions: list[Named] = field(default_factory=list)
    metrics: list[Named] = field(default_factory=list)
    filters: dict[str, Named] = field(default_factory=dict)

    def _find(self, kind: Sequence[Named], wanted: str) -> Named:
        """By ``table.name``, by name, or by synonym, in that order."""
        w = wanted.lower()
        for test in (lambda n: f"{n.table}.{n.name}" == w, lambda n: n.name == w, lambda n: w in n.synonyms):
            found = [n for n in kind if test(n)]
            if len(found) == 1:
                return found[0]
            if found:
                raise ValueError(f"{wanted!r} is ambiguous: {[n.table + '.' + n.name for n in found]}")
        raise KeyError(wanted)

    def metric(self, name: str) -> Named:
        """A metric, or a fact under its default aggregation."""
        try:
            return self._find(self.metrics, name)
        except KeyError:
            fact = self._find(self.facts, name)
            if fact.default is None:
                raise
            agg = {"sum": F.sum, "avg": mean}[fact.default]
            return Named(fact.name, fact.table, lambda: agg(fact.expr()))

    def _steps(self, start: str, goal: str) -> list[Link]:
        """Many-to-one steps from one table to another."""
        paths = {start: []}
        todo = [start]
        while todo:
            here = todo.pop(0)
            for link in self.links:
                if link.many == here and link.one not in paths:
                    paths[link.one] = [*paths[here], link]
                    todo.append(link.one)
        if goal not in paths:
            raise ValueError(f"{goal!r} cannot be reached from {start!r} without repeating rows")
        return paths[goal]

    def _joined(self, start: str, needed: Sequence[Named]) -> DataFrame:
        df = self.tables[start]
        df = df.withColumns({f"__{n.table}_{n.name}": n.expr() for n in needed if n.table == start})
        done = {start}
        for goal in [n.table for n in needed]:
            for link in self._steps(start, goal):
                if link.one in done:
                    continue
                here = [n for n in needed if n.table == link.one]
                onward = [x.key for x in self.links if x.many == link.one]
                side = self.tables[link.one].select(
                    F.col(link.key).alias("__key"),
                    *[n.expr().alias(f"__{n.table}_{n.name}") for n in here],
                    *[F.col(k).alias(f"__{link.one}_{k}") for k in onward])
                left = F.col(link.key) if link.many == start else F.col(f"__{link.many}_{link.key}")
                df = df.join(side, left == F.col("__key"), "left").drop("__key")
                done.add(link.one)
        return df

    def query(self, metrics: Sequence[str], dimensions: Sequence[str] = (), where: Sequence[str] = (),
              having: Column | None = None, order: Sequence[Column] = (),
              condition: Callable[[Callable[[str], Column]], Column] | None = None) -> DataFrame:
        """Metrics by dimensions, under named filters, with optional having and order.

        ``condition`` filters rows before they are aggregated, on any dimension or fact:
        ``lambda of: (of("order_status") == "Completed") & (of("segment") != "Basic")``.
        """
        dims = [self._find(self.dimensions, d) for d in dimensions]
        picked = [self.metric(m) for m in metrics]
        tests = [self.filters[w] for w in where]
        used: list[Named] = []

        def of(name: str) -> Column:
            try:
                n = self._find(self.dimensions, name)
            except KeyError:
                n = self._find(self.facts, name)
            used.append(n)
            return F.col(f"__{n.table}_{n.name}")

        free = None if condition is None else condition(of)
        names = [d.name for d in dims]
        parts = []
        for table in dict.fromkeys(m.table for m in picked):
            df = self._joined(table, [*dims, *tests, *used])
            if free is not None:
                df = df.filter(free)
            for t in tests:
                df = df.filter(F.col(f"__{t.table}_{t.name}"))
            parts.append(df.groupBy(*[F.col(f"__{d.table}_{d.name}").alias(d.name) for d in dims]).agg(
                *[m.expr().alias(m.name) for m in picked if m.table == table]))
        out = reduce(lambda a, b: _align(a, b, names), parts).select(*names, *[m.name for m in picked])
        if having is not None:
            out = out.filter(having)
        return out.orderBy(*order) if order else out


def _align(a: DataFrame, b: DataFrame, names: Sequence[str]) -> DataFrame:
    """Put two aggregates over the same dimensions side by side."""
    if not names:
        for c in b.columns:
            a = a.withColumn(c, b.select(c).scalar())
        return a
    right = b.withColumnsRenamed({n: f"__{n}" for n in names})
    cond = reduce(lambda x, y: x & y, [F.col(n).eqNullSafe(F.col(f"__{n}")) for n in names])
    joined = a.join(right, cond, "full_outer")
    return joined.withColumns({n: F.coalesce(n, f"__{n}") for n in names}).drop(*[f"__{n}" for n in names])


def _dim(table: str, *names: str, **synonyms: Sequence[str]) -> list[Named]:
    plain = [Named(n, table, lambda n=n: F.col(n)) for n in names]
    return plain + [Named(n, table, lambda n=n: F.col(n), tuple(s)) for n, s in synonyms.items()]


# Names, synonyms and named filters of both models.

def order_model(customers: DataFrame, orders: DataFrame, items: DataFrame) -> SemanticModel:
    """Orders, customers and items: revenue, counts and order value."""
    net = lambda: F.col("total_amount") * (F.lit(1) - F.col("discount_percent") / F.lit(100))
    return SemanticModel(
        tables={"orders": orders, "customers": customers, "items": items},
        primary_keys={"orders": "order_id", "customers": "customer_id", "items": "order_item_id"},
        links=[Link("orders", "customers", "customer_id"), Link("items", "orders", "order_id")],
        facts=[
            Named("total_amount", "orders", lambda: F.col("total_amount"), ("order_value", "sale_amount"), "sum"),
            Named("quantity", "items", lambda: F.col("quantity"), ("qty", "units"), "sum"),
            Named("unit_price", "items", lambda: F.col("unit_price"), ("price", "item_price"), "avg"),
            Named("line_total", "items", lambda: F.col("line_total"), ("item_total", "line_amount"), "sum"),
        ],
        dimensions=[
            Named("order_status", "orders", lambda: F.col("order_status"), ("status",)),
            Named("order_date", "orders", lambda: F.col("order_date"), ("date", "purchase_date", "transaction_date")),
            Named("order_year", "orders", lambda: F.year("order_date"), ("year",)),
            Named("order_month", "orders", lambda: F.month("order_date"), ("month",)),
            Named("customer_segment", "customers", lambda: F.col("customer_segment"), ("segment", "tier")),
            Named("customer_name", "customers", lambda: F.concat_ws(" ", "first_name", "last_name"), ("customer",)),
            Named("customer_state", "customers", lambda: F.col("state"), ("location", "region")),
            *_dim("customers", "first_name", "last_name"),
            Named("product_category", "items", lambda: F.col("product_category"),
                  ("category", "product_type", "item_category")),
        ],
        metrics=[
            Named("total_revenue", "orders", lambda: F.sum("total_amount"), ("revenue", "sales", "total_sales")),
            Named("net_revenue", "orders", lambda: F.sum(net()), ("net_sales",)),
            Named("order_count", "orders", lambda: F.count_distinct("order_id"), ("number_of_orders", "total_orders")),
            Named("average_order_value", "orders", lambda: mean("total_amount"),
                  ("aov", "avg_order", "mean_order_value", "avg_order_value")),
            Named("customer_count", "customers", lambda: F.count_distinct("customer_id"),
                  ("number_of_customers", "total_customers")),
            Named("total_items_revenue", "items", lambda: F.sum("line_total"),
                  ("item_revenue", "product_revenue", "line_item_sales")),
        ],
    )


def business_model(customers: DataFrame, orders: DataFrame, catalog: DataFrame, clv: DataFrame,
                   segments: DataFrame, daily: DataFrame, affinity: DataFrame, as_of: str) -> SemanticModel:
    """Seven logical tables with default aggregations, discount metrics and named filters."""
    c = F.col
    rate = lambda: c("discount_percent") / F.lit(100)
    given = lambda: c("total_amount") * rate()
    net = lambda: c("total_amount") * (F.lit(1) - rate())
    shipped = lambda: net() + c("shipping_cost")
    gross = lambda: F.sum("total_discounts") + F.sum("total_net_revenue")
    has = lambda: F.when(c("discount_percent") > 0, c("order_id"))
    score = lambda: c("recency_score") + c("frequency_score") + c("monetary_score")

    def facts(table, avg=(), total=()):
        return ([Named(n, table, lambda n=n: c(n), (), "avg") for n in avg]
                + [Named(n, table, lambda n=n: c(n), (), "sum") for n in total])

    def keep(name, table, expr):
        return name, Named(name, table, expr)

    scores = ("avg_order_value", "frequency_score", "monetary_score", "recency_score", "rfm_score")
    return SemanticModel(
        tables={"customers": customers, "orders": orders, "product_catalog": catalog,
                "customer_lifetime_value": clv, "customer_segmentation": segments,
                "daily_business_metrics": daily, "product_affinity": affinity},
        primary_keys={"customers": "customer_id", "orders": "order_id", "product_catalog": "product_id",
                      "customer_lifetime_value": "customer_id", "customer_segmentation": "customer_id"},
        links=[Link("customer_lifetime_value", "customers", "customer_id"),
               Link("customer_segmentation", "customers", "customer_id"),
               Link("orders", "customers", "customer_id")],
        facts=[
            *facts("customer_lifetime_value",
                   (*scores, "customer_lifespan_days", "days_since_last_order", "days_since_signup", "orders_per_month"),
                   ("estimated_annual_value", "total_items_purchased", "total_orders", "total_revenue")),
            *facts("customer_segmentation", scores, ("total_orders", "total_revenue")),
            *facts("daily_business_metrics", ("avg_discount_percent", "avg_order_value"),
                   ("total_discounts", "total_orders")),
            Named("extra_large_orders_count", "daily_business_metrics", lambda: c("extra_large_orders"), (), "sum"),
            Named("large_orders_count", "daily_business_metrics", lambda: c("large_orders"), (), "sum"),
            Named("net_revenue", "daily_business_metrics", lambda: c("total_net_revenue"), (), "sum"),
            Named("total_revenue", "daily_business_metrics", lambda: c("total_net_revenue"),
                  ("gross revenue", "revenue", "sales"), "sum"),
            Named("applied_discount_percent", "orders", lambda: F.when(c("discount_percent") > 0, c("discount_percent"))),
            Named("discount_rate_decimal", "orders", rate),
            Named("discount_multiplier", "orders", lambda: F.lit(1) - rate()),
            Named("discounted_order_amount", "orders", net),
            Named("has_discount_flag", "orders", lambda: F.when(c("discount_percent") > 0, F.lit(1))),
            Named("discount_amount", "orders", given, ("discount",), "sum"),
            Named("final_amount", "orders", shipped, ("amount after discount", "net amount"), "sum"),
            Named("order_total", "orders", lambda: c("total_amount"), ("order amount", "total"), "sum"),
            *facts("product_affinity", ("confidence_a_to_b", "confidence_b_to_a", "lift", "support"),
                   ("times_bought_together",)),
            *facts("product_catalog", ("price",), ("stock_quantity",)),
        ],
        dimensions=[
            *_dim("customers", "customer_id", customer_segment=("segment", "customer tier"),
                  registration_date=("signup date", "joined date")),
            Named("customer_name", "customers", lambda: F.concat_ws(" ", "first_name", "last_name"), ("customer", "name")),
            Named("customer_state", "customers", lambda: c("state"), ("state", "location")),
            *_dim("customer_lifetime_value", "customer_status", "value_tier", "signup_date"),
            *_dim("customer_segmentation", "behavioral_segment", "recommended_action", "segment_priority"),
            *_dim("daily_business_metrics", "order_date_only", "order_day_name", "order_month", "order_quarter",
                  "order_week", "order_year"),
            *_dim("orders", "order_date", "order_id", "order_status"),
            Named("discount_percentage", "orders", lambda: c("discount_percent"), ("discount rate",)),
            *_dim("product_affinity", "affinity_strength", "product_a_category", "product_a_name",
                  "product_b_category", "product_b_name", "recommendation_priority"),
            *_dim("product_catalog", "product_category", "product_id", "product_name", "description"),
        ],
        metrics=[
            Named("average_customer_revenue", "customer_lifetime_value", lambda: mean("total_revenue")),
            Named("average_rfm_score", "customer_lifetime_value", lambda: ratio(F.sum(score()), F.count(score()) * 3)),
            Named("customer_count", "customer_lifetime_value", lambda: F.count("customer_id")),
            Named("total_customer_revenue", "customer_lifetime_value", lambda: F.sum("total_revenue")),
            Named("avg_daily_orders", "daily_business_metrics", lambda: mean("total_orders"), ("orders_per_day",)),
            Named("avg_daily_revenue", "daily_business_metrics", lambda: mean("total_net_revenue")),
            Named("avg_order_value_by_day", "daily_business_metrics",
                  lambda: mean(c("avg_order_value").cast("decimal(20,6)")), ("aov_by_day",)),
            Named("daily_discount_penetration_percentage", "daily_business_metrics",
                  lambda: ratio(F.sum("total_discounts"), gross()) * F.lit(100)),
            Named("daily_discount_penetration_ratio", "daily_business_metrics",
                  lambda: ratio(F.sum("total_discounts"), gross())),
            Named("daily_gross_revenue_before_discounts", "daily_business_metrics", gross),
            Named("daily_total_discounts_given", "daily_business_metrics", lambda: F.sum("total_discounts")),
            Named("total_net_revenue_sum", "daily_business_metrics", lambda: F.sum("total_net_revenue")),
            Named("average_order_value_with_shipping", "orders", lambda: mean(shipped())),
            Named("discount_order_penetration_percentage", "orders",
                  lambda: ratio(F.count_distinct(has()) * 100, F.count_distinct("order_id"))),
            Named("discount_penetration_percentage", "orders",
                  lambda: ratio(F.sum(given()), F.sum("total_amount")) * F.lit(100)),
            Named("discount_penetration_ratio", "orders", lambda: ratio(F.sum(given()), F.sum("total_amount"))),
            Named("gross_revenue_before_discounts", "orders", lambda: F.sum("total_amount")),
            Named("net_revenue_before_shipping", "orders", lambda: F.sum(net())),
            Named("order_count", "orders", lambda: F.count_distinct("order_id"), ("order_volume", "transaction_count")),
            Named("segment_aov", "orders", lambda: mean(shipped()), ("average_segment_order",)),
            Named("total_discounts_given", "orders", lambda: F.sum(given())),
            Named("total_revenue_with_shipping", "orders", lambda: F.sum(shipped())),
        ],
        filters=dict([
            keep("valid_customer_segments", "customers", lambda: c("customer_segment").isin("Premium", "Standard")),
            keep("at_risk_customers", "customer_lifetime_value", lambda: c("customer_status") == "at_risk"),
            keep("high_value_customers", "customer_lifetime_value", lambda: c("value_tier") == "high_value"),
            keep("current_month_data", "daily_business_metrics",
                 lambda: F.trunc("order_date_only", "month") == F.trunc(F.lit(as_of).cast("date"), "month")),
            keep("days_with_large_orders", "daily_business_metrics", lambda: c("large_orders") > 0),
            keep("last_30_days", "daily_business_metrics", lambda: c("order_date_only") >= days_before(as_of, 30)),
            keep("last_90_days", "daily_business_metrics", lambda: c("order_date_only") >= days_before(as_of, 90)),
            keep("weekend_days", "daily_business_metrics", lambda: c("order_day_name").isin("Sat", "Sun")),
            keep("strong_product_affinities", "product_affinity",
                 lambda: c("affinity_strength").isin("strong", "very_strong")),
        ]),
    )
