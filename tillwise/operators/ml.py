"""Features, training, evaluation, scoring and recommendation on MLlib."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.functions.ranking import dense_position
from tillwise.functions.semantics import day_lit, days_between, first_per_key, ladder, ratio
from tillwise.operators.pairs import combinations_not_in
from tillwise.operators.serving import top
from tillwise.session import cut_lineage
from tillwise.sources.files import read_current, write_version

# Feature lists, label threshold, engagement segments.
CHURN_DAYS = 7
CHURN_FEATURES = ["total_orders", "total_spent", "avg_order_value", "customer_tenure_days", "order_frequency",
                  "revenue_per_order"]
PURCHASE_FEATURES = ["customer_id_encoded", "product_id_encoded", "total_past_orders", "total_spent", "avg_item_spend",
                     "unique_products_bought", "days_since_last_order", "product_popularity", "product_price",
                     "product_volume", "product_price_variance"]
IDLE_DAYS = 180
ID_MODULUS = 10000
# Rows of a task while a model is fitted, about.
ROWS_A_TASK = 500_000


# --- features ------------------------------------------------------------------------

def churn_features(analytics: DataFrame, as_of: date | str, threshold: int = CHURN_DAYS) -> DataFrame:
    """Tenure, frequency and revenue features with the churn label.

    Recency decides the label, so it is not among the features.
    """
    idle = days_between("last_order_date", day_lit(as_of))
    tenure = days_between("first_order_date", "last_order_date")
    return analytics.filter(F.col("total_orders") > 0).select(
        "customer_id", "total_orders", F.col("total_spent").cast("double").alias("total_spent"),
        F.col("avg_order_value").cast("double").alias("avg_order_value"),
        tenure.alias("customer_tenure_days"),
        ratio("total_orders", tenure + 1).alias("order_frequency"),
        ratio("total_spent", "total_orders").alias("revenue_per_order"),
        idle.alias("days_since_last_order"),
        (idle > threshold).cast("int").alias("is_churned"))


def _purchases(orders: DataFrame, items: DataFrame) -> DataFrame:
    return orders.select("order_id", "customer_id", "order_date").join(items, "order_id")


def _bought(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Distinct (customer, product); one shuffle serves every use in a plan."""
    return _purchases(orders, items).select("customer_id", "product_id").distinct()


def customer_history(orders: DataFrame, items: DataFrame, as_of: date | str, bought: DataFrame | None = None) -> DataFrame:
    """Orders, spend, products and recency per customer that bought something.

    ``bought`` are the distinct (customer, product) where they are at hand.
    """
    lines = _purchases(orders, items)
    # One row per (customer, order) and per (customer, product) keeps distinct counts plain.
    spent = lines.groupBy("customer_id", "order_id").agg(
        F.sum("line_total").alias("s"), F.count("line_total").alias("n"), F.max("order_date").alias("d"))
    per_customer = spent.groupBy("customer_id").agg(
        F.count("order_id").alias("total_past_orders"), F.sum("s").alias("total_spent"),
        ratio(F.sum("s"), F.sum("n")).alias("avg_item_spend"), F.max("d").alias("last_order_date"))
    products = (_bought(orders, items) if bought is None else bought).groupBy("customer_id").agg(
        F.count("product_id").alias("unique_products_bought"))
    return per_customer.join(products, "customer_id").withColumn(
        "days_since_last_order", days_between("last_order_date", day_lit(as_of)))


def purchased_products(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Ordered list of the distinct products of each customer, as text."""
    return _bought(orders, items).groupBy("customer_id").agg(
        F.array_join(F.array_sort(F.collect_list("product_id")).cast("array<string>"), ",").alias("purchased_products"))


def customer_products(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Purchases, quantity and last purchase per customer and product."""
    return _purchases(orders, items).groupBy("customer_id", "product_id").agg(
        F.count("*").alias("purchase_count"), F.sum("quantity").alias("total_quantity"),
        F.max("order_date").alias("last_product_purchase"))


def product_popularity(items: DataFrame) -> DataFrame:
    """Orders, price, volume and price spread per product."""
    price = F.col("unit_price").cast("decimal(12,2)")
    per_order = items.groupBy("product_id", "order_id").agg(
        F.sum("quantity").alias("q"), F.count(price).alias("n"), F.sum(price).alias("s"), F.sum(price * price).alias("ss"))
    n, s, ss = F.sum("n"), F.sum("s"), F.sum("ss")
    # Sample variance from exact sums; NULL for a single price, which counts as no spread.
    variance = F.try_divide((ss * n - s * s).cast("double"), (n * (n - F.lit(1))).cast("double"))
    return per_order.groupBy("product_id").agg(
        F.count("order_id").alias("times_ordered"), ratio(s, n).alias("avg_price"),
        F.sum("q").alias("total_quantity_sold"),
        F.coalesce(F.sqrt(F.greatest(variance, F.lit(0.0))), F.lit(0.0)).alias("price_variance"))


def _features(pairs: DataFrame, popularity: DataFrame) -> DataFrame:
    return pairs.join(popularity, "product_id").select(
        "customer_id", "product_id", "total_past_orders", F.col("total_spent").cast("double").alias("total_spent"),
        "avg_item_spend", "unique_products_bought", "days_since_last_order",
        F.col("times_ordered").alias("product_popularity"), F.col("avg_price").alias("product_price"),
        F.col("total_quantity_sold").alias("product_volume"),
        F.col("price_variance").alias("product_price_variance"), "purchased")


def drawn(*parts: Column, below: Column) -> Column:
    """A number from 0 to below - 1 that any engine draws alike: the first digits of an MD5 sum."""
    digits = F.substring(F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]).cast("binary")), 1, 8)
    return F.conv(digits, 16, 10).cast("long") % below


def labelled_pairs(popularity: DataFrame, bought: DataFrame, negatives: int = 4) -> DataFrame:
    """Bought pairs and pairs that were never bought, ``negatives`` draws for each bought pair: one row each, with ``purchased``.

    A draw names a product by its place among the sold ones. Draws that hit a bought pair
    or repeat another one are left out, so a customer who has bought all has no negatives.
    Bought and drawn pairs are told apart while their copies are put together, in one shuffle.
    """
    places = label_encode(popularity.select("product_id"), "product_id").withColumnRenamed("product_id_encoded", "__place")
    count = popularity.agg(F.count("*")).scalar()
    draws = bought.select("customer_id", "product_id").withColumn(
        "__draw", F.explode(F.sequence(F.lit(1), F.lit(negatives))))
    place = drawn(F.col("customer_id"), F.col("product_id"), F.col("__draw"), below=count)
    pairs = draws.select("customer_id", place.alias("__place")).join(places, "__place")
    return bought.select("customer_id", "product_id", F.lit(1).alias("purchased")).unionByName(
        pairs.select("customer_id", "product_id", F.lit(0).alias("purchased"))).groupBy("customer_id", "product_id").agg(
        F.max("purchased").alias("purchased"))


def recommendation_training_set(orders: DataFrame, items: DataFrame, as_of: date | str, negatives: int = 4) -> DataFrame:
    """Bought pairs, and ``negatives`` times as many never-bought ones at most, with the same features.

    The bought pairs and the figures of products are written once, since several steps read them.
    """
    spark = items.sparkSession
    bought, popularity = cut_lineage(spark, _bought(orders, items)), cut_lineage(spark, product_popularity(items))
    history = customer_history(orders, items, as_of, bought)
    return _features(labelled_pairs(popularity, bought, negatives).join(history, "customer_id"), popularity)


def encode_ids(df: DataFrame, columns: Sequence[str], modulus: int = ID_MODULUS) -> DataFrame:
    return df.withColumns({f"{c}_encoded": F.pmod(F.col(c), F.lit(modulus)) for c in columns})


def label_encode(df: DataFrame, column: str) -> DataFrame:
    """Index of each id among the sorted distinct ids."""
    index = dense_position(df.select(column).distinct(), column, f"{column}_encoded")
    return df.join(index, column)


# --- training and evaluation ----------------------------------------------------------------

def stratified_split(df: DataFrame, label: str, key: str, share: float = 0.8, seed: int = 42):
    """Train and test rows drawn by label and key: the share holds within each class."""
    part = drawn(F.lit(seed), F.col(label), F.col(key), below=F.lit(10000))
    return df.filter(part < int(share * 10000)), df.filter(part >= int(share * 10000))


def with_class_weight(df: DataFrame, label: str) -> DataFrame:
    """Weight positive rows by the ratio of negative to positive ones."""
    balance = df.agg(ratio(F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1))).scalar()
    return df.withColumn("class_weight", F.when(F.col(label) == 1, F.coalesce(balance, F.lit(1.0))).otherwise(1.0))


def train_boosted(train: DataFrame, features: Sequence[str], label: str, trees: int = 100, depth: int = 6,
                  rate: float = 0.1, subsample: float = 1.0, scale: bool = True, weight: bool = True,
                  seed: int = 42) -> PipelineModel:
    """Boosted trees over (optionally standardised) features."""
    stages = [VectorAssembler(inputCols=list(features), outputCol="raw_features")]
    column = "raw_features"
    if scale:
        stages.append(StandardScaler(inputCol=column, outputCol="features", withMean=True, withStd=True))
        column = "features"
    tree = GBTClassifier(featuresCol=column, labelCol=label, maxIter=trees, maxDepth=depth, stepSize=rate,
                         subsamplingRate=subsample, seed=seed)
    data = train.withColumn(label, F.col(label).cast("double"))
    if weight:
        data = with_class_weight(data, label)
        tree = tree.setWeightCol("class_weight")
    return Pipeline(stages=[*stages, tree]).fit(data)


def bounded(labelled: DataFrame, key: Sequence[str], most: int) -> DataFrame:
    """At most ``most`` labelled rows, the same ones every time; models are fitted on all rows and don't use it.

    Rows are counted by the first digits of their draw, so only those of one such group are put in
    order: a limit over all of them would leave the rows, and the fitting, in a single task.
    """
    draws = labelled.withColumn("__draw", drawn(*[F.col(k) for k in key], below=F.lit(2**32)))
    group = F.shiftright("__draw", 20)
    counts = draws.groupBy(group.alias("group")).agg(F.count("*").alias("rows")).orderBy("group").collect()  # 4096 at most
    left = most
    for edge, rows in counts:
        if rows > left:
            last = draws.filter(group == edge).orderBy("__draw", *key).limit(left)
            return draws.filter(group < edge).unionByName(last).drop("__draw")
        left -= rows
    return labelled


def _spread(train: DataFrame) -> DataFrame:
    """Rows computed once and dealt to all cores, since fitting passes over them for every level of a tree.

    All of them are kept; their number sets the number of tasks, so a task holds about as many however large the table is.
    """
    spark = train.sparkSession
    rows = cut_lineage(spark, train)
    return rows.repartition(max(spark.sparkContext.defaultParallelism, -(-rows.count() // ROWS_A_TASK)))


def train_churn(features: DataFrame, trees: int = 100, depth: int = 6, rate: float = 0.1) -> tuple[PipelineModel, DataFrame]:
    """Churn model and the rows kept back for testing."""
    train, test = stratified_split(features, "is_churned", "customer_id")
    return train_boosted(_spread(train), CHURN_FEATURES, "is_churned", trees, depth, rate), test


def train_purchase(examples: DataFrame, trees: int = 100, depth: int = 10, rate: float = 0.03,
                   subsample: float = 0.8) -> tuple[PipelineModel, DataFrame]:
    """Purchase model and the rows kept back for testing."""
    keyed = encode_ids(examples, ["customer_id", "product_id"]).withColumn(
        "__key", F.concat_ws("|", F.col("customer_id").cast("string"), F.col("product_id").cast("string")))
    train, test = stratified_split(keyed, "purchased", "__key")
    model = train_boosted(_spread(train), PURCHASE_FEATURES, "purchased", trees, depth, rate, subsample, scale=False, weight=False)
    return model, test.drop("__key")


def score(model: PipelineModel, df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Probability of the positive class and the label at a threshold."""
    p = vector_to_array("probability")[1]
    out = model.transform(df).withColumn("score", p).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    return out.select(*df.columns, "score", "predicted")


def confusion(scored: DataFrame, label: str) -> DataFrame:
    return scored.groupBy(F.col(label).cast("int").alias("label"), "predicted").agg(F.count("*").alias("rows"))


def classification_report(scored: DataFrame, label: str) -> DataFrame:
    """Accuracy, precision, recall and F1 in one pass."""
    y, p = F.col(label) == 1, F.col("predicted") == 1
    counts = scored.agg(F.count("*").alias("rows"), F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
                        F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))
    return counts.select(
        "rows", ratio(F.col("tp") + F.col("tn"), F.col("rows")).alias("accuracy"),
        ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
        ratio(F.col("tp") * 2, F.col("tp") * 2 + F.col("fp") + F.col("fn")).alias("f1"))


def roc_auc(scored: DataFrame, label: str) -> float:
    return BinaryClassificationEvaluator(rawPredictionCol="score", labelCol=label).evaluate(
        scored.withColumn(label, F.col(label).cast("double")))


def evaluate(scored: DataFrame, label: str) -> DataFrame:
    """Classification report with the area under the ROC curve."""
    return classification_report(scored, label).withColumn("roc_auc", F.lit(roc_auc(scored, label)))


def feature_importance(spark: SparkSession, model: PipelineModel, names: Sequence[str]) -> DataFrame:
    """Importance per feature, highest first."""
    values = model.stages[-1].featureImportances.toArray().tolist()
    ranked = sorted(zip(names, values), key=lambda x: (-x[1], x[0]))
    rows = [(i, n, float(v)) for i, (n, v) in enumerate(ranked, 1)]
    return spark.createDataFrame(rows, "rank int, feature string, importance double")


def save_model(model: PipelineModel, root: str, metrics: Mapping[str, float], spark: SparkSession) -> int:
    """Store a model as the next version, with its metrics in a table beside it."""
    known = read_current(spark, f"{root}/metrics")
    version = 1 if known is None else known.agg(F.max("version")).first()[0] + 1
    model.write().save(f"{root}/model={version}")
    rows = spark.createDataFrame([(version, k, float(v)) for k, v in metrics.items()],
                                 "version int, metric string, value double")
    write_version(rows if known is None else known.unionByName(rows), f"{root}/metrics")
    return version


def load_latest(spark: SparkSession, root: str) -> tuple[PipelineModel, DataFrame]:
    """Newest stored model and the metrics of that version."""
    metrics = read_current(spark, f"{root}/metrics")
    version = metrics.agg(F.max("version")).first()[0]
    return PipelineModel.load(f"{root}/model={version}"), metrics.filter(F.col("version") == version)


# --- targeting and recommendation --------------------------------------------------------------

def engagement_segments(orders: DataFrame, items: DataFrame, as_of: date | str) -> DataFrame:
    """Rule-based segment per customer with orders."""
    per_order = items.groupBy("order_id").agg(F.sum("line_total").alias("s"))
    stats = orders.join(per_order, "order_id", "left").groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("total_orders"), F.sum("s").alias("total_spent"),
        F.max("order_date").alias("last_order_date"))
    idle, spent, n = F.col("days_since_last_order"), F.col("total_spent"), F.col("total_orders")
    return stats.withColumn("days_since_last_order", days_between("last_order_date", day_lit(as_of))).withColumn(
        "segment", ladder([
            ((idle > IDLE_DAYS) & (spent > 500), "HIGH_VALUE_INACTIVE"), (idle > IDLE_DAYS, "AT_RISK"),
            (n <= 2, "NEW_CUSTOMERS"), (n <= 5, "LOW_ENGAGEMENT"), (spent > 1000, "HIGH_VALUE_ACTIVE")], "REGULAR"))


def target_customers(segments: DataFrame, segment: str, n: int) -> DataFrame:
    """Customers of a segment that were inactive longest."""
    return top(segments.filter(F.col("segment") == segment).select("customer_id", "segment", "days_since_last_order"),
               [F.desc_nulls_first("days_since_last_order"), F.asc("customer_id")], n)


def candidate_matrix(targets: DataFrame, orders: DataFrame, items: DataFrame, catalog: DataFrame,
                     as_of: date | str) -> DataFrame:
    """Features of every product a target customer has not bought yet."""
    own = orders.join(targets.select("customer_id"), "customer_id", "left_semi")
    lines = own.select("order_id", "customer_id", "order_date").join(items, "order_id", "left")
    per_customer = lines.groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("total_past_orders"),
        F.coalesce(F.sum("line_total").cast("double"), F.lit(0.0)).alias("total_spent"),
        F.coalesce(ratio(F.sum("line_total"), F.count("line_total")), F.lit(0.0)).alias("avg_item_spend"),
        F.count_distinct("product_id").alias("unique_products_bought"),
        F.coalesce(days_between(F.max("order_date"), day_lit(as_of)), F.lit(9999)).alias("days_since_last_order"))
    sold = product_popularity(items)
    zero = F.lit(0)
    products = catalog.select("product_id", "product_name", "product_category", "price").join(
        sold, "product_id", "left").select(
        "product_id", "product_name", "product_category",
        F.coalesce("times_ordered", zero).alias("product_popularity"),
        F.col("price").cast("double").alias("product_price"),
        F.coalesce("total_quantity_sold", zero).alias("product_volume"),
        F.coalesce("price_variance", F.lit(0.0)).alias("product_price_variance"))
    bought = lines.filter(F.col("product_id").isNotNull()).select("customer_id", "product_id").distinct()
    known = targets.select("customer_id", "segment").join(per_customer, "customer_id")
    joined = combinations_not_in(known, "customer_id", catalog, "product_id", bought).join(products, "product_id")
    return encode_ids(joined, ["customer_id", "product_id"])


def recommend(model: PipelineModel, orders: DataFrame, items: DataFrame, catalog: DataFrame, as_of: date | str,
              segment: str = "LOW_ENGAGEMENT", n_customers: int = 3, n_products: int = 3) -> DataFrame:
    """Best products for the longest inactive customers of a segment."""
    targets = target_customers(engagement_segments(orders, items, as_of), segment, n_customers)
    scored = score(model, candidate_matrix(targets, orders, items, catalog, as_of))
    best = first_per_key(scored, ["customer_id"], [F.desc("score"), F.asc("product_id")], n_products,
                         rank="rank_within_customer")
    return best.select("customer_id", "segment", "product_id", "product_name", "product_category",
                       F.col("score").alias("purchase_probability"), "rank_within_customer").orderBy(
        "customer_id", "rank_within_customer")


def customer_product_recency(customers: DataFrame, orders: DataFrame, items: DataFrame, catalog: DataFrame,
                             as_of: date | str, statuses: Sequence[str] = ("Completed", "Shipped")) -> DataFrame:
    """When and how often the given customers bought each catalogue product."""
    own = orders.filter(F.col("order_status").isin(*statuses)).join(
        customers.select("customer_id"), "customer_id", "left_semi")
    per_pair = own.select("order_id", "customer_id", "order_date").join(items, "order_id").groupBy(
        "customer_id", "product_id").agg(
        F.max("order_date").alias("last_purchase_date"), F.count("*").alias("times_purchased"),
        F.sum(F.col("unit_price") * F.col("quantity")).alias("total_spent_on_product"))
    return per_pair.join(catalog.select("product_id", "product_name", "product_category"), "product_id").withColumn(
        "days_since_purchase", days_between("last_purchase_date", day_lit(as_of)))


def repurchase_candidates(analytics: DataFrame, orders: DataFrame, items: DataFrame, catalog: DataFrame,
                          as_of: date | str, n_customers: int = 50, min_days: int = 30, n: int = 100) -> DataFrame:
    """Products the best customers bought before but not recently."""
    best = top(analytics.select("customer_id", "total_orders", "total_spent", "avg_order_value"),
               [F.desc("total_spent"), F.asc("customer_id")], n_customers)
    seen = customer_product_recency(best, orders, items, catalog, as_of).filter(F.col("days_since_purchase") > min_days)
    popular = items.groupBy("product_id").agg(F.count_distinct("order_id").alias("product_popularity"))
    joined = best.join(seen, "customer_id").join(popular, "product_id").withColumn(
        "recommendation_score", F.col("days_since_purchase") * F.lit(0.5) + F.col("times_purchased") * F.lit(10))
    return top(joined.select(
        "customer_id", "total_orders", "total_spent", "avg_order_value", "product_id", "product_name",
        "product_category", "days_since_purchase", "times_purchased", "total_spent_on_product",
        "product_popularity", "recommendation_score"),
        [F.desc("total_spent"), F.desc("recommendation_score"), F.asc("customer_id"), F.asc("product_id")], n)
