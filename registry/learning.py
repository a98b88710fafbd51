"""Feature, model, recommendation, similarity and text queries."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from registry.base import SHARED_SQL, query
from registry.reports import coa, half_up
from tillwise.functions import udf
from tillwise.operators import boosting, closest_pairs, ml, opinion, similarity, text
from tillwise.operators.pairs import combinations_not_in
from tillwise.operators.reports import recommendation_counts
from tillwise.operators.search_index import SegmentedIndex
from tillwise.session import cut_lineage
from tillwise.sources.external import project_variant
from tillwise.sources.files import scratch_dir
from tillwise.sources.fixtures import AS_OF

TODAY = f"DATE '{AS_OF}'"
CHURN_AFTER = 120  # days; balances the classes of the test tables
TREES, DEPTH = 100, 6


# --- features ------------------------------------------------------------------------------

SHARED_SQL["hist"] = f"""
    SELECT customer_id, COUNT(DISTINCT order_id) AS total_past_orders, SUM(line_total)::DOUBLE AS total_spent,
           SUM(line_total)::DOUBLE / COUNT(*) AS avg_item_spend, COUNT(DISTINCT product_id) AS unique_products_bought,
           MAX(order_date) AS last_order_date, date_diff('day', MAX(order_date)::DATE, {TODAY}) AS days_since_last_order
    FROM ord JOIN item USING (order_id) GROUP BY 1"""

SHARED_SQL["popu"] = """
    SELECT product_id, COUNT(DISTINCT order_id) AS times_ordered, SUM(unit_price)::DOUBLE / COUNT(*) AS avg_price,
           SUM(quantity)::BIGINT AS total_quantity_sold,
           coalesce(sqrt(greatest(((SUM(unit_price * unit_price) * COUNT(*) - SUM(unit_price) * SUM(unit_price))::DOUBLE
                    / nullif(COUNT(*) * (COUNT(*) - 1), 0)), 0)), 0) AS price_variance
    FROM item GROUP BY 1"""


@query("churn_features", f"""
    SELECT customer_id, total_orders, total_spent::DOUBLE AS total_spent, avg_order_value,
           date_diff('day', first_order_date::DATE, last_order_date::DATE) AS customer_tenure_days,
           total_orders::DOUBLE / (date_diff('day', first_order_date::DATE, last_order_date::DATE) + 1) AS order_frequency,
           total_spent::DOUBLE / total_orders AS revenue_per_order,
           date_diff('day', last_order_date::DATE, {TODAY}) AS days_since_last_order,
           (date_diff('day', last_order_date::DATE, {TODAY}) > 7)::INT AS is_churned FROM coa""")
def _(t):
    return ml.churn_features(coa(t), AS_OF)


@query("customer_history", "SELECT * REPLACE (last_order_date::VARCHAR AS last_order_date) FROM hist")
def _(t):
    return ml.customer_history(t.orders, t.order_items, AS_OF)


@query("purchased_products", """SELECT customer_id, string_agg(product_id::VARCHAR, ',' ORDER BY product_id) AS purchased_products
       FROM (SELECT DISTINCT customer_id, product_id FROM ord JOIN item USING (order_id)) GROUP BY 1""")
def _(t):
    return ml.purchased_products(t.orders, t.order_items)


@query("customer_products", """SELECT customer_id, product_id, COUNT(*) AS purchase_count, SUM(quantity)::BIGINT AS total_quantity,
       MAX(order_date)::VARCHAR AS last_product_purchase FROM ord JOIN item USING (order_id) GROUP BY 1, 2""")
def _(t):
    return ml.customer_products(t.orders, t.order_items)


@query("product_popularity", "SELECT * REPLACE (round(price_variance, 6) AS price_variance) FROM popu")
def _(t):
    return ml.product_popularity(t.order_items).withColumn("price_variance", F.round("price_variance", 6))


_FEATURES = """h.customer_id, p.product_id, h.total_past_orders, h.total_spent, h.avg_item_spend, h.unique_products_bought,
       h.days_since_last_order, p.times_ordered AS product_popularity, p.avg_price AS product_price,
       p.total_quantity_sold AS product_volume, round(p.price_variance, 6) AS product_price_variance"""


def draw(*parts, below):
    """SQL of ml.drawn."""
    return f"(('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 8))::BIGINT % {below})"


SHARED_SQL["bght"] = "SELECT DISTINCT customer_id, product_id FROM ord JOIN item USING (order_id)"

SHARED_SQL["examples"] = f"""
    SELECT customer_id, product_id, 1 AS purchased FROM bght
    UNION ALL
    SELECT customer_id, product_id, 0 FROM (
        SELECT DISTINCT b.customer_id, s.product_id
        FROM (SELECT customer_id, {draw("customer_id", "product_id", "k", below="(SELECT COUNT(*) FROM popu)")} AS place
              FROM bght, range(1, 5) g(k)) b
        JOIN (SELECT product_id, ROW_NUMBER() OVER (ORDER BY product_id) - 1 AS place FROM popu) s USING (place))
    WHERE (customer_id, product_id) NOT IN (SELECT (customer_id, product_id) FROM bght)"""


@query("recommendation_training_set", f"""
    SELECT {_FEATURES}, x.purchased FROM examples x JOIN hist h USING (customer_id) JOIN popu p ON p.product_id = x.product_id""")
def _(t):
    return ml.recommendation_training_set(t.orders, t.order_items, AS_OF).withColumn(
        "product_price_variance", F.round("product_price_variance", 6))


@query("unbought_pairs", """SELECT c.customer_id, p.product_id FROM targets c CROSS JOIN cat p
       WHERE (c.customer_id, p.product_id) NOT IN (SELECT (customer_id, product_id) FROM ord JOIN item USING (order_id))""")
def _(t):
    """Products that the target customers have not bought."""
    bought = ml.customer_products(t.orders, t.order_items)
    return combinations_not_in(_targets(t).select("customer_id"), "customer_id", t.product_catalog, "product_id", bought, block=16)


@query("encode_ids", """SELECT customer_id, product_id, customer_id % 10000 AS customer_id_encoded, product_id % 10000 AS product_id_encoded
       FROM (SELECT DISTINCT customer_id, product_id FROM ord JOIN item USING (order_id))""")
def _(t):
    return ml.encode_ids(ml.customer_products(t.orders, t.order_items).select("customer_id", "product_id"),
                         ["customer_id", "product_id"])


@query("label_encode", "SELECT product_id, ROW_NUMBER() OVER (ORDER BY product_id) - 1 AS product_id_encoded FROM cat")
def _(t):
    return ml.label_encode(t.product_catalog.select("product_id"), "product_id")


@query("engagement_segments", f"""
    SELECT customer_id, total_orders, total_spent, last_order_date::VARCHAR AS last_order_date, idle AS days_since_last_order,
           CASE WHEN idle > 180 AND total_spent > 500 THEN 'HIGH_VALUE_INACTIVE' WHEN idle > 180 THEN 'AT_RISK'
                WHEN total_orders < 3 THEN 'NEW_CUSTOMERS' WHEN total_orders < 6 THEN 'LOW_ENGAGEMENT'
                WHEN total_spent > 1000 THEN 'HIGH_VALUE_ACTIVE' ELSE 'REGULAR' END AS segment
    FROM (SELECT customer_id, COUNT(DISTINCT order_id) AS total_orders, SUM(line_total)::DOUBLE AS total_spent,
                 MAX(order_date) AS last_order_date, date_diff('day', MAX(order_date)::DATE, {TODAY}) AS idle
          FROM ord LEFT JOIN item USING (order_id) GROUP BY 1)""")
def _(t):
    return ml.engagement_segments(t.orders, t.order_items, AS_OF)


def _targets(t, n=25):
    return ml.target_customers(ml.engagement_segments(t.orders, t.order_items, AS_OF), "HIGH_VALUE_INACTIVE", n)


SHARED_SQL["targets"] = f"""
    SELECT customer_id, 'HIGH_VALUE_INACTIVE' AS segment, idle AS days_since_last_order
    FROM (SELECT customer_id, SUM(line_total) AS s, date_diff('day', MAX(order_date)::DATE, {TODAY}) AS idle
          FROM ord LEFT JOIN item USING (order_id) GROUP BY 1)
    WHERE idle > 180 AND s > 500 ORDER BY idle DESC, customer_id LIMIT 25"""


@query("target_customers", "SELECT * FROM targets")
def _(t):
    return _targets(t)


@query("candidate_matrix", f"""
    SELECT h.customer_id, 'HIGH_VALUE_INACTIVE' AS segment, c.product_id, c.product_name, c.product_category,
           h.customer_id % 10000 AS customer_id_encoded, c.product_id % 10000 AS product_id_encoded,
           f.n AS total_past_orders, h.total_spent, h.avg_item_spend, h.unique_products_bought, f.idle AS days_since_last_order,
           coalesce(p.times_ordered, 0) AS product_popularity, c.price::DOUBLE AS product_price,
           coalesce(p.total_quantity_sold, 0) AS product_volume, round(coalesce(p.price_variance, 0), 6) AS product_price_variance
    FROM targets x JOIN hist h USING (customer_id)
    JOIN (SELECT customer_id, COUNT(DISTINCT order_id) AS n, date_diff('day', MAX(order_date)::DATE, {TODAY}) AS idle FROM ord GROUP BY 1) f USING (customer_id)
    CROSS JOIN cat c LEFT JOIN popu p ON p.product_id = c.product_id
    WHERE NOT EXISTS (SELECT 1 FROM ord o JOIN item i USING (order_id) WHERE o.customer_id = x.customer_id AND i.product_id = c.product_id)""")
def _(t):
    return ml.candidate_matrix(_targets(t), t.orders, t.order_items, t.product_catalog, AS_OF).withColumn(
        "product_price_variance", F.round("product_price_variance", 6))


SHARED_SQL["again"] = f"""
    SELECT b.customer_id, b.total_orders, b.total_spent::DOUBLE AS total_spent, b.avg_order_value, s.product_id, c.product_name,
           c.product_category, s.idle AS days_since_purchase, s.n AS times_purchased, s.amount AS total_spent_on_product,
           p.times_ordered AS product_popularity, s.idle * 0.5::DOUBLE + s.n * 10 AS recommendation_score
    FROM (SELECT * FROM coa ORDER BY coa.total_spent DESC, customer_id LIMIT 50) b
    JOIN (SELECT customer_id, product_id, date_diff('day', MAX(order_date)::DATE, {TODAY}) AS idle, COUNT(*) AS n,
                 SUM(unit_price * quantity)::DOUBLE AS amount
          FROM ord JOIN item USING (order_id) WHERE order_status IN ('Completed', 'Shipped') GROUP BY 1, 2) s USING (customer_id)
    JOIN cat c USING (product_id) JOIN popu p USING (product_id) WHERE s.idle > 30
    ORDER BY b.total_spent DESC, recommendation_score DESC, b.customer_id, s.product_id LIMIT 100"""


def _again(t):
    return ml.repurchase_candidates(coa(t), t.orders, t.order_items, t.product_catalog, AS_OF)


@query("repurchase_candidates", "SELECT * FROM again")
def _(t):
    return _again(t)


@query("customer_product_recency", f"""SELECT customer_id, i.product_id, MAX(order_date)::VARCHAR AS last_purchase_date, COUNT(*) AS times_purchased,
       SUM(unit_price * quantity)::DOUBLE AS total_spent_on_product, c.product_name, c.product_category,
       date_diff('day', MAX(order_date)::DATE, {TODAY}) AS days_since_purchase
       FROM ord JOIN item i USING (order_id) JOIN cat c ON c.product_id = i.product_id
       WHERE order_status IN ('Completed', 'Shipped') GROUP BY customer_id, i.product_id, c.product_name, c.product_category""")
def _(t):
    return ml.customer_product_recency(t.customers, t.orders, t.order_items, t.product_catalog, AS_OF)


@query("recommendation_counts", """SELECT product_id, product_name, product_category, COUNT(*) AS recommendation_count,
       SUM(recommendation_score::DECIMAL(18,2))::DOUBLE / COUNT(*) AS avg_score FROM again GROUP BY 1, 2, 3 ORDER BY 4 DESC, 1 LIMIT 15""")
def _(t):
    return recommendation_counts(_again(t))


# --- models: what must hold for any fitted model, over the rows kept back for testing ------------------

SHARED_SQL["churn"] = f"""
    SELECT customer_id, (date_diff('day', last_order_date::DATE, {TODAY}) > {CHURN_AFTER})::INT AS is_churned FROM coa"""
SHARED_SQL["churn_test"] = f"SELECT * FROM churn WHERE {draw('42', 'is_churned', 'customer_id', below='10000')} >= 8000"
SHARED_SQL["buy_test"] = f"""
    SELECT * FROM examples WHERE {draw("42", "purchased", "customer_id || '|' || product_id", below="10000")} >= 8000"""

_FITTED = {}


def _once(t, kind, fit):
    """Several queries look at the same fitted model."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir, kind)
    if key not in _FITTED:
        _FITTED[key] = fit()
    return _FITTED[key]


def _churn(t):
    features = ml.churn_features(coa(t), AS_OF, CHURN_AFTER)
    model, test = _once(t, "churn", lambda: ml.train_churn(features, TREES, DEPTH))
    return model, test


def _valid(label):
    return (F.col("score").between(0, 1) & (F.col("predicted") == (F.col("score") >= 0.5).cast("int"))).alias(label)


def _share(c):
    return F.coalesce(F.col(c), F.lit(0.0)).between(0, 1)


@query("churn_evaluation", "SELECT COUNT(*) AS rows, true AS in_range, true AS better_than_chance, true AS recalls_churned FROM churn_test")
def _(t):
    """Report over the held-out rows: shares, better than chance, most churned customers found."""
    model, test = _churn(t)
    return ml.evaluate(ml.score(model, test), "is_churned").select(
        "rows", (_share("accuracy") & _share("precision") & _share("recall") & _share("f1")).alias("in_range"),
        (F.col("roc_auc") > 0.6).alias("better_than_chance"), (F.col("recall") > 0.5).alias("recalls_churned"))


@query("churn_scores", "SELECT customer_id, is_churned, true AS valid FROM churn_test")
def _(t):
    model, test = _churn(t)
    return ml.score(model, test).select("customer_id", "is_churned", _valid("valid"))


@query("churn_confusion", "SELECT is_churned AS label, COUNT(*) AS rows FROM churn_test GROUP BY 1")
def _(t):
    """The cells of the confusion matrix add up to the rows of each class."""
    model, test = _churn(t)
    return ml.confusion(ml.score(model, test), "is_churned").filter("predicted IN (0, 1)").groupBy("label").agg(
        F.sum("rows").alias("rows"))


SHARED_SQL["fixed_scores"] = """
    SELECT event_id, (event_id % 3 = 0)::INT AS y, event_id * 37 % 100 / 100.0::DOUBLE AS score FROM events"""


@query("confusion_report", """
    SELECT COUNT(*) AS rows, (tp + tn)::DOUBLE / COUNT(*) AS accuracy, tp::DOUBLE / (tp + fp) AS precision, tp::DOUBLE / (tp + fn) AS recall,
           2 * tp::DOUBLE / (2 * tp + fp + fn) AS f1
    FROM fixed_scores, (SELECT COUNT(*) FILTER (y = 1 AND score >= 0.5) AS tp, COUNT(*) FILTER (y = 0 AND score >= 0.5) AS fp,
                               COUNT(*) FILTER (y = 1 AND score < 0.5) AS fn, COUNT(*) FILTER (y = 0 AND score < 0.5) AS tn FROM fixed_scores)
    GROUP BY tp, fp, fn, tn""")
def _(t):
    """The report itself, over scores that need no model."""
    score = (F.col("event_id") * 37 % 100) / F.lit(100.0)
    scored = t.raw("events").select((F.col("event_id") % 3 == 0).cast("int").alias("y"), (score >= 0.5).cast("int").alias("predicted"))
    return ml.classification_report(scored, "y")


@query("churn_importance", """SELECT unnest(['total_orders', 'total_spent', 'avg_order_value', 'customer_tenure_days', 'order_frequency',
       'revenue_per_order']) AS feature, true AS in_range""")
def _(t):
    """Every feature has an importance; ranks have no gaps."""
    return ml.feature_importance(t.spark, _churn(t)[0], ml.CHURN_FEATURES).select(
        "feature", (F.col("importance").between(0, 1) & F.col("rank").between(1, len(ml.CHURN_FEATURES))).alias("in_range"))


@query("churn_class_balance", "SELECT is_churned, COUNT(*) AS rows FROM churn GROUP BY 1")
def _(t):
    return ml.churn_features(coa(t), AS_OF, CHURN_AFTER).groupBy("is_churned").agg(F.count("*").alias("rows"))


@query("stored_model_scores", "SELECT customer_id, 1::BIGINT AS version, true AS same_score FROM churn_test")
def _(t):
    """A model that was stored and loaded again scores like the fitted one."""
    root = scratch_dir(t.spark, "models")
    model, test = _churn(t)
    fitted = ml.score(model, test)
    version = ml.save_model(model, root, {"roc_auc": ml.roc_auc(fitted, "is_churned")}, t.spark)
    loaded, metrics = ml.load_latest(t.spark, root)
    both = ml.score(loaded, test).select("customer_id", F.col("score").alias("again")).join(
        fitted.select("customer_id", "score"), "customer_id")
    known = metrics.filter(F.col("metric") == "roc_auc").agg(F.max("version")).scalar()
    return both.select("customer_id", F.coalesce(known, F.lit(version)).cast("long").alias("version"),
                       (F.col("again") == F.col("score")).alias("same_score"))


def _purchase(t):
    examples = ml.recommendation_training_set(t.orders, t.order_items, AS_OF)
    return _once(t, "purchase", lambda: ml.train_purchase(examples, trees=TREES, depth=DEPTH, rate=0.03))


@query("purchase_evaluation", "SELECT COUNT(*) AS rows, true AS in_range FROM buy_test")
def _(t):
    model, test = _purchase(t)
    return ml.evaluate(ml.score(model, test), "purchased").select(
        "rows", (_share("accuracy") & _share("precision") & _share("recall") & _share("f1") & _share("roc_auc")).alias("in_range"))


@query("recommend_products", """
    SELECT customer_id, segment, rank AS rank_within_customer, true AS new_to_customer, true AS in_range, true AS ordered
    FROM (SELECT customer_id, segment, COUNT(*) AS n FROM targets CROSS JOIN cat
          WHERE (customer_id, product_id) NOT IN (SELECT (customer_id, product_id) FROM bght) GROUP BY 1, 2), range(1, 4) r(rank)
    WHERE rank <= n""")
def _(t):
    """Three products for each target customer: not bought yet, best first."""
    model, _test = _purchase(t)
    best = ml.recommend(model, t.orders, t.order_items, t.product_catalog, AS_OF, "HIGH_VALUE_INACTIVE", 25, 3)
    bought = ml.customer_products(t.orders, t.order_items).select("customer_id", "product_id").withColumn("known", F.lit(True))
    before = F.lag("purchase_probability").over(Window.partitionBy("customer_id").orderBy("rank_within_customer"))
    return best.withColumn("before", before).join(bought, ["customer_id", "product_id"], "left").select(
        "customer_id", "segment", "rank_within_customer", F.col("known").isNull().alias("new_to_customer"),
        F.col("purchase_probability").between(0, 1).alias("in_range"),
        F.coalesce(F.col("before") >= F.col("purchase_probability"), F.lit(True)).alias("ordered"))


# --- similarity -------------------------------------------------------------------------------------

@query("similarity_topk", """SELECT vec_id, round(similarity, 6) AS similarity FROM (
       SELECT e.vec_id, list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS similarity
       FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 0) q) ORDER BY embeddings.similarity DESC, vec_id LIMIT 10"""
       .replace("embeddings.similarity", "round(similarity, 12)"))
def _(t):
    vectors = t.raw("embeddings")
    q = vectors.filter("vec_id = 0").select("embedding").first()[0]
    return similarity.similarity_topk(vectors, "vec_id", "embedding", q, 10).select(
        "vec_id", F.round("similarity", 6).alias("similarity"))


@query("pairwise_similarity", """SELECT id_a, id_b, round(s, 6) AS similarity FROM (
       SELECT a.vec_id AS id_a, b.vec_id AS id_b, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS s
       FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id) ORDER BY round(s, 12) DESC, id_a, id_b LIMIT 10""")
def _(t):
    return similarity.pairwise_topk(t.raw("embeddings"), "vec_id", "embedding", 10, block_rows=256).withColumn(
        "similarity", F.round("similarity", 6))


@query("closest_pairs", """SELECT id_a, id_b, round(s, 6) AS similarity FROM (
       SELECT a.vec_id AS id_a, b.vec_id AS id_b, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS s
       FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id) ORDER BY round(s, 12) DESC, id_a, id_b LIMIT 50""")
def _(t):
    """The same by a tree of pivots, whose pairs of nodes are left out from the top."""
    return closest_pairs.closest_pairs(t.raw("embeddings"), "vec_id", "embedding", 50, leaf_rows=512).withColumn(
        "similarity", F.round("similarity", 6))


_STUMP = ("total_amount", "discount_percent", "shipping_cost")
_STUMP_EDGES = [[500.0, 1000.0, 1500.0, 2000.0, 2500.0, 3000.0, 4000.0], [5.0, 10.0, 15.0, 20.0, 25.0], [10.0, 20.0, 30.0, 40.0]]


@query("boosted_first_split", """
    WITH x AS (SELECT order_id, (order_status = 'Completed')::INT AS y, total_amount::DOUBLE AS total_amount,
                      discount_percent::DOUBLE AS discount_percent, shipping_cost::DOUBLE AS shipping_cost FROM ord),
    long AS (SELECT order_id, y, 0 AS f, total_amount AS v FROM x UNION ALL SELECT order_id, y, 1, discount_percent FROM x
             UNION ALL SELECT order_id, y, 2, shipping_cost FROM x),
    cuts AS (SELECT 0 AS f, unnest([500.0, 1000.0, 1500.0, 2000.0, 2500.0, 3000.0, 4000.0])::DOUBLE AS edge
             UNION ALL SELECT 1, unnest([5.0, 10.0, 15.0, 20.0, 25.0])::DOUBLE
             UNION ALL SELECT 2, unnest([10.0, 20.0, 30.0, 40.0])::DOUBLE),
    sums AS (SELECT f, edge, SUM(0.5::DOUBLE - y) AS g, 0.25 * COUNT(*) AS h, SUM(0.5::DOUBLE - y) FILTER (v <= edge) AS gl,
                    0.25 * COUNT(*) FILTER (v <= edge) AS hl FROM long JOIN cuts USING (f) GROUP BY f, edge),
    best AS (SELECT *, (gl * gl / (hl + 1) + (g - gl) * (g - gl) / (h - hl + 1) - g * g / (h + 1)) / 2 AS gain FROM sums
             WHERE hl >= 1 AND h - hl >= 1 ORDER BY round(gain, 9) DESC, f, edge LIMIT 1)
    SELECT order_id, round(1 / (1 + exp(-CASE WHEN v <= edge THEN -gl / (hl + 1) ELSE -(g - gl) / (h - hl + 1) END)), 9) AS score,
           round(gain, 6) AS gain FROM long JOIN best USING (f)""")
def _(t):
    """Scores of all orders by one split with second-order leaves, which SQL finds from the same sums."""
    orders = t.orders.withColumn("done", (F.col("order_status") == "Completed").cast("int"))
    model = boosting.fit(orders, _STUMP, "done", "order_id", boosting.Settings(trees=1, depth=1, rate=1.0), _STUMP_EDGES)
    return model.score(orders).select(
        "order_id", F.round("score", 9).alias("score"), F.round(F.lit(model.gains[0]), 6).alias("gain"))


# --- text --------------------------------------------------------------------------------------------

def _labelled(t, label):
    return t.documents.select("doc_id", "text").join(t.raw("labels").select("doc_id", label), "doc_id")


def _held_out(docs):
    part = ml.drawn(F.lit("text"), F.col("doc_id"), below=F.lit(5))
    return docs.filter(part != 0), docs.filter(part == 0)


FOLDS = 3


def _cross_fitted(labelled, docs, fit, apply):
    """``apply`` over all documents, each fold by a model fitted on the labelled rows of the others."""
    out = None
    for fold in range(FOLDS):
        part = F.pmod(F.xxhash64(F.lit("fold"), F.col("doc_id")), F.lit(FOLDS))
        done = apply(docs.filter(part == fold), fit(labelled.filter(part != fold)))
        out = done if out is None else out.unionByName(done)
    return out


@query("text_filter", """
    SELECT doc_id, lang, toxic AS label, true AS told_apart FROM documents LEFT JOIN labels USING (doc_id)""")
def _(t):
    """Every document is scored by a model that has not seen it; labelled toxic ones are flagged more often than others.

    With the 400 labels of the small tables that is all such a model can do: 16 % against 8 %.
    """
    docs = text.count_terms(t.documents.select("doc_id", "lang", "text"), "text")
    labelled = cut_lineage(t.spark, docs.join(t.raw("labels").select("doc_id", "toxic"), "doc_id"))
    flagged = _cross_fitted(labelled, docs, lambda rows: text.train_text_filter(rows, "text", "toxic"),
                            lambda docs, model: text.text_flag(docs, model, "flag"))
    rows = cut_lineage(t.spark, flagged.join(t.raw("labels").select("doc_id", "toxic"), "doc_id", "left").select(
        "doc_id", "lang", F.col("toxic").alias("label"), "flag"))
    hit = {label: rows.filter(F.col("label") == label).agg(F.avg(F.col("flag").cast("int"))).scalar() for label in (0, 1)}
    return rows.select("doc_id", "lang", "label", (hit[1] > hit[0]).alias("told_apart"))


@query("text_classify", "SELECT lang, COUNT(*) AS docs, true AS known_class, true AS mostly_right FROM documents GROUP BY 1")
def _(t):
    """Language of every document, from models trained on the language of others."""
    docs = text.count_terms(t.documents.select("doc_id", "lang", "text"), "text")
    out = cut_lineage(t.spark, _cross_fitted(docs, docs, lambda rows: text.train_text_classes(rows, "text", "lang"),
                                             lambda rows, model: text.text_classify(rows, model, "predicted")).drop(text.COUNTED))
    known = docs.select("lang").distinct().withColumnRenamed("lang", "predicted").withColumn("known", F.lit(True))
    per = out.join(known, "predicted", "left").groupBy("lang").agg(
        F.count("*").alias("docs"), F.bool_and(F.coalesce("known", F.lit(False))).alias("known_class"),
        F.count_if(F.col("predicted") == F.col("lang")).alias("right"))
    return per.select("lang", "docs", "known_class", (F.col("right") * 10 > F.col("docs") * 7).alias("mostly_right"))


@query("embed_documents", """SELECT doc_id, 256 AS dim, (len(list_filter(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: len(w) > 0)) > 0)::INT::DOUBLE AS norm FROM documents""")
def _(t):
    model = text.fit_embedding(t.documents, "text", 256)
    return text.embed(t.documents.select("doc_id", "text"), model).select(
        "doc_id", F.size("embedding").alias("dim"),
        F.round(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")), 3).alias("norm"))


@query("embedding_search", """SELECT doc_id, 1.0::DOUBLE AS similarity FROM documents WHERE text = (SELECT text FROM documents WHERE doc_id = 1)
       ORDER BY doc_id LIMIT 1""")
def _(t):
    """The text most similar to a given one, embedded by the same fitted model, is that text."""
    model = text.fit_embedding(t.documents, "text", 256)
    q = t.documents.filter("doc_id = 1").select("text").first()[0]
    found = text.similar_to_text(t.documents.select("doc_id", "text"), model, "doc_id", q, 1)
    return found.select("doc_id", F.round("similarity", 6).alias("similarity"))


# The words and aspects of the library, written out, and words that occur in the test documents.
_GOOD = ("amazing awesome best comfortable durable excellent fantastic good great love perfect recommend satisfied sturdy "
         "thank wonderful only thing ones there").split()
_BAD = ("awful bad broke broken cheap defective delayed disappointed disappointing expensive frustrated poor refund stupid "
        "terrible uncomfortable worst worthless hate for").split()
_ABOUT = {
    "quality": "quality made material materials construction with inner".split(),
    "price": "price cost value money expensive cheap from tire".split(),
    "performance": "performance speed control performs that".split(),
    "durability": "durable durability lasted broke broken this".split(),
    "comfort": "comfort comfortable fit fits uncomfortable was".split(),
}
_EXTRA_WORDS = {"only": 1, "thing": 1, "ones": 1, "there": 1, "hate": -1, "for": -1}
_EXTRA_ABOUT = {"quality": ["with", "inner"], "price": ["from", "tire"], "performance": ["that"], "durability": ["this"], "comfort": ["was"]}


def _words_in(tokens, vocabulary):
    known = ", ".join(f"'{w}'" for w in vocabulary)
    return f"len(list_filter({tokens}, lambda w: w IN ({known})))"


def _sentences(key, body, table):
    return f"""
    SELECT {key}, n, list_filter(string_split_regex(lower(sentence), '[^\\p{{L}}\\p{{N}}]+'), lambda w: len(w) > 0) AS toks
    FROM (SELECT {key}, unnest(string_split_regex({body}, '[.!?\n]+')) AS sentence,
                 generate_subscripts(string_split_regex({body}, '[.!?\n]+'), 1) AS n FROM {table})"""


def _moods(key, table, sentences):
    about = "".join(f""",
           COUNT(*) FILTER (list_has_any(toks, {words})) AS {a}_any,
           coalesce(SUM({_words_in('toks', _GOOD)}) FILTER (list_has_any(toks, {words})), 0) AS {a}_p,
           coalesce(SUM({_words_in('toks', _BAD)}) FILTER (list_has_any(toks, {words})), 0) AS {a}_n""" for a, words in _ABOUT.items())
    return f"""
    SELECT d.{key}, coalesce(SUM({_words_in('toks', _GOOD)}), 0) AS p, coalesce(SUM({_words_in('toks', _BAD)}), 0) AS n{about}
    FROM {table} d LEFT JOIN {sentences} USING ({key}) GROUP BY 1"""


SHARED_SQL["sent"] = _sentences("doc_id", "text", "documents")
SHARED_SQL["moods"] = _moods("doc_id", "documents", "sent")
SHARED_SQL["rsent"] = _sentences("review_id", "review_text", "rev")
SHARED_SQL["rmoods"] = _moods("review_id", "rev", "rsent")


def _verdict(p, n):
    return f"CASE WHEN {p} > 0 AND {n} > 0 THEN 'mixed' WHEN {p} > 0 THEN 'positive' WHEN {n} > 0 THEN 'negative' ELSE 'neutral' END"


def _aspect(a):
    return f"CASE WHEN {a}_any = 0 THEN 'unknown' ELSE {_verdict(f'{a}_p', f'{a}_n')} END AS {a}_sentiment"


def _vocabulary():
    return text.LEXICON | _EXTRA_WORDS, {a: [*words, *_EXTRA_ABOUT[a]] for a, words in text.ASPECTS.items()}


@query("sentiment", f"""SELECT doc_id, {_verdict('p', 'n')} AS overall_sentiment, (p - n)::BIGINT AS score,
       {', '.join(_aspect(a) for a in _ABOUT)} FROM moods""")
def _(t):
    return text.sentiment(t.documents, "doc_id", "text", *_vocabulary())


@query("reviews_with_sentiment", """
    SELECT review_id, rating, true AS flagged, quality_any > 0 AND quality_n > 0 AS mentions_quality_issues,
           CASE WHEN p - n >= 2 THEN 'highly_positive' WHEN p - n = 1 THEN 'positive' WHEN p - n = 0 THEN 'neutral'
                WHEN p - n = -1 THEN 'negative' ELSE 'highly_negative' END AS sentiment_category
    FROM rev JOIN rmoods USING (review_id)""")
def _(t):
    """Satisfaction from a trained model (any flag will do here), the rest from the word list."""
    train, _rest = _held_out(_labelled(t, "quality"))
    model = text.train_text_filter(train, "text", "quality")
    reviews = t.product_reviews.withColumn("text", F.col("review_text"))
    return text.reviews_with_sentiment(reviews, model, *_vocabulary()).select(
        "review_id", "rating", F.col("is_positive").isNotNull().alias("flagged"), "mentions_quality_issues", "sentiment_category")


_NEGATIONS = "['not', 'no', 'never', 'nor', 'cannot', 'without', 'don', 'doesn', 'didn', 'isn', 'wasn', 'nicht', 'kein', 'keine', 'pas', 'jamais']"

# One row per use of a word; words up to three places after a negation are marked.
SHARED_SQL["said"] = f"""
    SELECT review_id, rating, review_id % 3 AS fold,
           CASE WHEN list_has_any(toks[greatest(i - 3, 1):i - 1], {_NEGATIONS}) THEN 'not_' || toks[i] ELSE toks[i] END AS word
    FROM (SELECT review_id, toks, unnest(range(1, len(toks) + 1)) AS i FROM rsent) JOIN rev USING (review_id)"""

_ODDS = """ln(p + 1000.0::DOUBLE * n / tn) - ln(tp + 1000 - p - 1000.0::DOUBLE * n / tn)
           - ln(q + 1000.0::DOUBLE * n / tn) + ln(tq + 1000 - q - 1000.0::DOUBLE * n / tn)"""
_DEVIATION = "sqrt(1 / (p + 1000.0::DOUBLE * n / tn) + 1 / (q + 1000.0::DOUBLE * n / tn))"

SHARED_SQL["said_odds"] = f"""
    SELECT k, word, n, p, q, {_ODDS} AS log_odds, ({_ODDS}) / {_DEVIATION} AS z
    FROM (SELECT *, SUM(n) OVER w AS tn, SUM(p) OVER w AS tp, SUM(q) OVER w AS tq
          FROM (SELECT k, word, COUNT(*) AS n, COUNT(*) FILTER (rating >= 4) AS p, COUNT(*) FILTER (rating <= 2) AS q
                FROM said JOIN (SELECT unnest([0, 1, 2, 9]) AS k) ON fold <> k GROUP BY 1, 2) WINDOW w AS (PARTITION BY k))"""


@query("rating_words", """SELECT word, n AS uses, p AS positive, q AS negative, round(log_odds, 6) AS log_odds, round(z, 6) AS z
       FROM said_odds WHERE k = 9""")
def _(t):
    """Weights of all words, learned from the ratings of all reviews."""
    return opinion.word_log_odds(t.product_reviews).withColumns({c: F.round(c, 6) for c in ("log_odds", "z")})


@query("review_opinions", """SELECT review_id, rating, coalesce(telling, 0) AS telling, coalesce(round(score, 6), 0) AS score
       FROM rev LEFT JOIN (SELECT review_id, COUNT(*) AS telling, SUM(log_odds) / COUNT(*) AS score
                           FROM said s JOIN said_odds o ON s.word = o.word AND s.fold = o.k WHERE abs(z) >= 1.96 GROUP BY 1) USING (review_id)""")
def _(t):
    """Every review, scored by words learned from the other two thirds."""
    scored = opinion.opinion_scores(t.product_reviews, fold=F.pmod(F.col("review_id"), F.lit(3)))
    return scored.withColumn("score", F.round("score", 6))


SHARED_SQL["post"] = """
    SELECT term, doc_id, COUNT(*) AS tf, any_value(len) AS len
    FROM (SELECT doc_id, unnest(ws) AS term, len(ws) AS len
          FROM (SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: len(w) > 0) AS ws FROM documents))
    GROUP BY 1, 2"""

SHARED_SQL["bm"] = """
    SELECT doc_id, round(SUM(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / avglen))), 6) AS score
    FROM (SELECT p.*, COUNT(*) OVER (PARTITION BY term) AS df, (SELECT COUNT(*) FROM documents)::DOUBLE AS n,
                 (SELECT SUM(tf)::DOUBLE / COUNT(DISTINCT doc_id) FROM post) AS avglen
          FROM post p WHERE term IN ('worthless', 'only', 'thing')) GROUP BY 1"""


@query("search_documents", "SELECT doc_id, lang, source, score FROM documents JOIN bm USING (doc_id) ORDER BY score DESC, doc_id LIMIT 20")
def _(t):
    path = scratch_dir(t.spark, "index")
    text.SearchIndex.build(t.documents, "doc_id", "text").write(path)
    return text.SearchIndex.read(t.documents, "doc_id", path).search("Only worthless thing", ["lang", "source"], 20)


@query("search_filtered", """SELECT doc_id, lang, score FROM documents JOIN bm USING (doc_id) WHERE lang = 'en' AND n_chars > 500
       ORDER BY score DESC, doc_id LIMIT 20""")
def _(t):
    """An index that was not stored answers the same query under an attribute filter."""
    return text.SearchIndex.build(t.documents, "doc_id", "text").search(
        "only worthless thing", ["lang"], 20, (F.col("lang") == "en") & (F.col("n_chars") > 500))


SHARED_SQL["fresh_docs"] = """
    SELECT doc_id, CASE WHEN doc_id % 7 = 1 THEN 'Worthless thing. ' || text ELSE text END AS text FROM documents WHERE doc_id % 11 <> 3
    UNION ALL SELECT doc_id, 'only this thing' FROM documents WHERE doc_id % 22 = 3"""

SHARED_SQL["fresh_words"] = """
    SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: len(w) > 0) AS ws FROM fresh_docs"""

SHARED_SQL["fresh_post"] = """
    SELECT term, doc_id, len, COUNT(*) AS tf FROM (SELECT doc_id, len(ws) AS len, unnest(ws) AS term FROM fresh_words)
    WHERE term IN ('worthless', 'only', 'thing') GROUP BY ALL"""


@query("search_index_kept_fresh", """
    SELECT doc_id, round(SUM(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / avglen))), 6) AS score
    FROM (SELECT p.*, COUNT(*) OVER (PARTITION BY term) AS df, (SELECT COUNT(*) FROM fresh_docs)::DOUBLE AS n,
                 (SELECT SUM(len(ws))::DOUBLE / COUNT(*) FROM fresh_words WHERE len(ws) > 0) AS avglen FROM fresh_post p)
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50""")
def _(t):
    """Nine tenths of the documents, then the rest, changed texts, deletions and some that return, batch by batch."""
    index = SegmentedIndex(t.spark, scratch_dir(t.spark, "fresh"), "doc_id", "text")
    docs, i = t.documents.select("doc_id", "text"), F.col("doc_id")

    def batch(rows, op="UPSERT"):
        index.apply(rows.withColumns({"seq": F.lit(0), "op": F.lit(op)}))

    batch(docs.filter(i % 10 != 0))
    batch(docs.filter(i % 10 == 0))
    batch(docs.filter(i % 7 == 1).withColumn("text", F.concat(F.lit("Worthless thing. "), "text")))
    batch(docs.filter(i % 11 == 3), "DELETE")
    batch(docs.filter(i % 22 == 3).withColumn("text", F.lit("only this thing")))
    return index.search("Only worthless thing", 50)[0]


@query("search_index_terms", "SELECT term, COUNT(*) AS docs, SUM(tf)::BIGINT AS uses FROM post GROUP BY 1")
def _(t):
    return text.SearchIndex.build(t.documents, "doc_id", "text").postings.groupBy("term").agg(
        F.count("*").alias("docs"), F.sum("tf").alias("uses"))


SHARED_SQL["best5"] = f"""
    SELECT product_id, product_name, product_category, COUNT(*) AS total_reviews, {half_up('SUM(rating)', 'COUNT(*)', 2)} AS avg_rating
    FROM cat JOIN rev USING (product_id) GROUP BY 1, 2, 3 ORDER BY 5 DESC, 1 LIMIT 5"""

SHARED_SQL["lines"] = """
    SELECT product_id, review_id, n, s, list_distinct(list_filter(string_split_regex(lower(s), '[^\\p{L}\\p{N}]+'), lambda w: len(w) > 0)) AS ws
    FROM (SELECT product_id, review_id, unnest(ss) AS s, generate_subscripts(ss, 1) - 1 AS n
          FROM (SELECT product_id, review_id, list_filter(list_transform(string_split_regex(review_text, '[.!?\n]+'), lambda x: trim(x, ' ')), lambda x: len(x) > 0) AS ss
                FROM rev JOIN best5 USING (product_id)))"""

SHARED_SQL["typical"] = """
    SELECT product_id, review_id, n, any_value(s) AS s, SUM(uses)::DOUBLE / COUNT(*) AS score
    FROM (SELECT product_id, review_id, n, s, term, COUNT(*) OVER (PARTITION BY product_id, term) AS uses
          FROM (SELECT product_id, review_id, n, s, unnest(ws) AS term FROM lines)) GROUP BY 1, 2, 3 HAVING COUNT(*) >= 3"""


@query("review_digest", """
    SELECT b.*, t.review_summary FROM best5 b LEFT JOIN (
        SELECT product_id, string_agg(s, '. ' ORDER BY place) AS review_summary
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY score DESC, review_id, n) AS place FROM typical) WHERE place <= 3
        GROUP BY 1) t USING (product_id)""")
def _(t):
    return text.review_digest(t.product_catalog, t.product_reviews)


@query("review_digest_ratings", f"""SELECT product_id, product_name, COUNT(*) AS total_reviews, {half_up('SUM(rating)', 'COUNT(*)', 2)} AS avg_rating
       FROM cat JOIN rev USING (product_id) GROUP BY 1, 2 ORDER BY 4 DESC, 1 LIMIT 5""")
def _(t):
    return text.review_digest(t.product_catalog, t.product_reviews).select(
        "product_id", "product_name", "total_reviews", "avg_rating")


# Amounts and dates stand in a text made of a table's columns, since the documents hold none.
@query("extract_amounts_dates", """
    SELECT o_orderkey AS id, 2 AS n_amounts, 1 AS n_dates,
           '[{"amount":"$' || o_orderkey || '.25","date":"' || strftime(o_orderdate, '%Y-%m-%d') || '","description":"Paid $' || o_orderkey
           || '.25 on ' || strftime(o_orderdate, '%Y-%m-%d') || '"},{"amount":"$7","description":"Then $7 more"}]' AS records
    FROM orders""")
def _(t):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    notes = t.raw("orders").select(F.col("o_orderkey").alias("id"), F.concat(
        F.lit("Paid $"), F.col("o_orderkey").cast("string"), F.lit(".25 on "), day, F.lit(". Then $7 more")).alias("note"))
    return text.extract_amounts_dates(notes, "id", "note")


@query("extract_sentences", """
    SELECT doc_id, coalesce(string_agg(s, ' | ' ORDER BY n) FILTER (list_has_any(toks, ['only', 'thing'])), '') AS pros,
           coalesce(string_agg(s, ' | ' ORDER BY n) FILTER (list_has_any(toks, ['worthless', 'stupid'])), '') AS cons
    FROM (SELECT doc_id, n, trim(sentence) AS s, list_filter(string_split_regex(lower(sentence), '[^\\p{L}\\p{N}]+'), lambda w: len(w) > 0) AS toks
          FROM (SELECT doc_id, unnest(string_split_regex(text, '[.!?\n]+')) AS sentence,
                       generate_subscripts(string_split_regex(text, '[.!?\n]+'), 1) AS n FROM documents)) GROUP BY 1""")
def _(t):
    return text.extract_sentences(t.documents, "doc_id", "text",
                                  {"pros": ["only", "thing"], "cons": ["worthless", "stupid"]})


@query("redact_pii", r"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}', '[EMAIL]', 'g'),
       '\b[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}\b', '[CARD]', 'g'),
       '[+][0-9]{1,3}(?:[ .-]?[(]?[0-9]{2,4}[)]?){2,5}|[(]?[0-9]{3}[)]?[ .-][0-9]{3}[ .-][0-9]{4}', '[PHONE]', 'g') AS text FROM documents""")
def _(t):
    return t.documents.select("doc_id", text.redact_pii("text").alias("text"))


@query("eval_dataset", "SELECT props AS input_query, COUNT(*) AS rows, (props->>'k')::BIGINT AS k FROM events GROUP BY props")
def _(t):
    """Event properties as questions with a variant ground truth."""
    rows = t.raw("events").select("props", F.col("props").alias("truth"))
    return project_variant(text.eval_dataset(rows, "props", "truth"), "ground_truth", {"k": ("$.k", "bigint")}).groupBy(
        "input_query", "k").agg(F.count("*").alias("rows"))


# --- functions ---------------------------------------------------------------------------------------------

@query("sql_function", "SELECT event_id, value * 2 AS doubled FROM events")
def _(t):
    udf.register_sql_functions(t.spark)
    return t.raw("events").select("event_id", F.call_function("double_it", "value").alias("doubled"))


@query("model_function", """SELECT vec_id, round(1 / (1 + exp(-(0.1 + list_sum(list_transform(embedding, lambda x: x::DOUBLE * 0.5))))), 6) AS p FROM embeddings""")
def _(t):
    vectors = t.raw("embeddings")
    width = len(vectors.select("embedding").first()[0])
    infer = udf.logistic_udf([0.5] * width, 0.1)
    return vectors.select("vec_id", F.round(infer(F.col("embedding").cast("array<double>")), 6).alias("p"))


@query("table_function", """SELECT event_type AS "group", COUNT(*) AS rows, round(SUM(value), 2) AS total, MIN(value) AS low, MAX(value) AS high FROM events GROUP BY 1""")
def _(t):
    return udf.partition_summaries(t.raw("events").select("event_id", "event_type", "value"), "event_type", "value").withColumn(
        "total", F.round("total", 2))


@query("table_metric", "SELECT COUNT(*) AS negatives FROM events WHERE value < 1")
def _(t):
    return udf.table_metric(t.raw("events"), F.count_if(F.col("value") < 1), "negatives")
