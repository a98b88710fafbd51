import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwise.functions import udf
from tillwise.operators import ml, similarity, text
from tillwise.operators.pairs import combinations_not_in


def test_combinations_match_brute_force(spark):
    left = spark.range(7).withColumnRenamed("id", "c").withColumn("extra", F.col("c") * 2)
    right = spark.range(40).withColumnRenamed("id", "p")
    # Customer 0 holds nearly everything, most hold nothing.
    known = spark.createDataFrame([(0, p) for p in range(38)] + [(3, 5)] * 4, "c long, p long")
    got = {(r["c"], r["p"]) for r in combinations_not_in(left, "c", right, "p", known, block=4).collect()}
    held = {(r["c"], r["p"]) for r in known.collect()}
    assert got == {(c, p) for c in range(7) for p in range(40)} - held


@pytest.mark.parametrize("block_rows", [16, 4096])
def test_pairwise_matches_brute_force(spark, folder, block_rows):
    rng = np.random.default_rng(5)
    vectors = np.concatenate([rng.normal(0, 1, (60, 8)), rng.normal(3, 0.2, (60, 8)), np.zeros((1, 8))])
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "id long, v array<double>")
    got = [tuple(r) for r in similarity.pairwise_topk(df, "id", "v", 12, block_rows).collect()]
    unit = vectors[:-1] / np.linalg.norm(vectors[:-1], axis=1, keepdims=True)
    sims = unit @ unit.T
    want = sorted(((-sims[i, j], i, j) for i in range(120) for j in range(i + 1, 120)))[:12]
    assert [(a, b) for a, b, _ in got] == [(i, j) for _, i, j in want]
    assert [s for *_, s in got] == pytest.approx([-s for s, *_ in want])


def test_rows_go_to_a_tile_once_however_many_pairs_of_blocks(spark):
    rng = np.random.default_rng(6)
    m = rng.normal(size=(240, 4))
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    rows = spark.createDataFrame([(i, [float(x) for x in v], i % 60) for i, v in enumerate(m)], "id long, v array<double>, block long")
    ends = rows.select("block").distinct()
    pairs = ends.withColumnRenamed("block", "a").crossJoin(ends.withColumnRenamed("block", "b")).filter("a <= b")
    tiles, shipped = similarity._tiles(pairs, rows, 5)
    assert tiles.count() == 60 * 61 / 2 and shipped.count() <= 240 * 5  # by pairs they were 240 * 60
    order = [F.desc("similarity"), F.asc("id_a"), F.asc("id_b")]
    got = similarity.visit(pairs, rows, 30, 0.2).orderBy(*order).limit(30).collect()
    sims = m @ m.T
    want = sorted((-sims[i, j], i, j) for i in range(240) for j in range(i + 1, 240))[:30]
    assert [(r["id_a"], r["id_b"]) for r in got] == [(i, j) for _, i, j in want]
    none = similarity.visit(pairs, rows, 30, 1.5)
    assert none.count() == 0 and similarity.visit(pairs.limit(0), rows.limit(0), 3).count() == 0


def test_churn_model_round_trip(spark, tables, folder):
    from tillwise.operators.serving import customer_order_analytics

    features = ml.churn_features(customer_order_analytics(tables.customers, tables.orders), "2001-08-02", 120)
    model, test = ml.train_churn(features, trees=3, depth=3)
    scored = ml.score(model, test)
    assert scored.filter("score < 0 OR score > 1 OR predicted <> cast(score >= 0.5 AS int)").count() == 0
    auc = ml.roc_auc(scored, "is_churned")
    assert 0 <= auc <= 1
    assert ml.save_model(model, folder, {"auc": auc}, spark) == 1
    assert ml.save_model(model, folder, {"auc": 0.25}, spark) == 2
    loaded, metrics = ml.load_latest(spark, folder)
    assert metrics.first()["value"] == 0.25
    assert ml.score(loaded, test).exceptAll(scored).count() == 0
    ranked = ml.feature_importance(spark, model, ml.CHURN_FEATURES).collect()
    assert "days_since_last_order" not in [r["feature"] for r in ranked]
    assert sum(r["importance"] for r in ranked) == pytest.approx(1.0)


def test_split_holds_within_classes(spark):
    df = spark.range(4000).select(F.col("id"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    train, test = ml.stratified_split(df, "y", "id")
    assert train.count() + test.count() == 4000
    share = train.filter("y = 1").count() / 400
    assert share == pytest.approx(0.8, abs=0.06)


def test_text_models_learn_the_labels(tables):
    docs = tables.documents.select("doc_id", "lang", "text")
    model = text.train_text_classes(docs, "text", "lang", dim=1 << 14, iterations=10)
    right = text.text_classify(docs, model, "got").filter("lang = got").count()
    assert right / docs.count() > 0.9
    labelled = docs.join(tables.raw("labels"), "doc_id")
    flag = text.train_text_filter(labelled, "text", "toxic", dim=1 << 14, iterations=10)
    flagged = text.text_flag(labelled, flag, "hit")
    assert flagged.filter("hit = (toxic = 1)").count() / flagged.count() > 0.9
    assert text.text_filter(labelled, flag).count() == flagged.filter("hit").count()


def test_terms_counted_once_give_the_same_models(tables):
    docs = tables.documents.select("doc_id", "lang", "text")
    counted = text.count_terms(docs, "text", dim=1 << 12)
    assert counted.columns == ["doc_id", "lang", text.COUNTED]
    model = text.train_text_classes(counted, "text", "lang", dim=1 << 12, iterations=5)
    assert "RegexTokenizer" not in {type(s).__name__ for s in model.stages}
    plain = text.train_text_classes(docs, "text", "lang", dim=1 << 12, iterations=5)
    got, want = (text.text_classify(d, m, "got").select("doc_id", "got") for d, m in ((counted, model), (docs, plain)))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_sentiment_per_aspect(spark):
    df = spark.createDataFrame([
        (1, "Great quality. The price is bad!"), (2, "Good good. Terrible."), (3, "Nothing to say"), (4, None)],
        "id int, t string")
    got = {r["id"]: r for r in text.sentiment(df, "id", "t").collect()}
    assert (got[1]["overall_sentiment"], got[1]["quality_sentiment"], got[1]["price_sentiment"]) == ("mixed", "positive", "negative")
    assert got[1]["comfort_sentiment"] == "unknown"
    assert got[2]["score"] == 1 and got[3]["overall_sentiment"] == "neutral"


def test_search_ranks_and_filters(spark, folder):
    df = spark.createDataFrame([
        (1, "powder skis for deep snow", "Skis"), (2, "deep deep snow snow boots", "Boots"), (3, "city shoes", "Boots"),
        (4, "snow", "Skis")], "id int, body string, kind string")
    index = text.SearchIndex.build(df, "id", "body")
    index.write(folder)
    stored = text.SearchIndex.read(df, "id", folder)
    live = [tuple(r) for r in index.search("Deep SNOW!", ["kind"], 3).collect()]
    assert live == [tuple(r) for r in stored.search("Deep SNOW!", ["kind"], 3).collect()]
    assert live[0][0] == 2 and len(live) == 3
    only = index.search("deep snow", ["kind"], 5, F.col("kind") == "Skis").collect()
    assert {r["id"] for r in only} == {1, 4}
    assert index.search("nothing", ["kind"]).count() == 0


def test_digest_matches_brute_force(spark):
    catalog = spark.createDataFrame([(1, "ski", "Skis"), (2, "boot", "Boots")], "product_id long, product_name string, product_category string")
    texts = ["Fast on hard snow. Fast on hard ice.", "I like blue things. Fast on hard snow", "ok"]
    reviews = spark.createDataFrame(
        [(i, 1, 5, t) for i, t in enumerate(texts)] + [(9, 2, 1, "Too small for me")],
        "review_id long, product_id long, rating int, review_text string")
    top = text.review_digest(catalog, reviews, k=1, per_product=2).first()
    # Uses per word: fast, on, hard 3 each, snow 2, ice 1; the two snow sentences lead.
    assert top["review_summary"] == "Fast on hard snow. Fast on hard snow"
    assert (top["product_id"], top["total_reviews"], float(top["avg_rating"])) == (1, 3, 5.0)


def test_extraction_and_redaction(spark):
    df = spark.createDataFrame([(1, "Paid $1,200.50 on 2024-01-05. Mail a.b@c.org, call +1 (743) 555-3824 or 555-123-4567. "
                                    "Card 1234-5678-9012-3456. Great skis. Poor boots. Or 1234567890123456, +49 30 1234 5678")], "id int, t string")
    row = text.extract_amounts_dates(df, "id", "t").first()
    assert row["records"] == '[{"amount":"$1,200.50","date":"2024-01-05","description":"Paid $1,200.50 on 2024-01-05"}]'
    kinds = text.extract_sentences(df, "id", "t", {"pros": text.PROS, "cons": text.CONS}).first()
    assert (kinds["pros"], kinds["cons"]) == ("Great skis", "Poor boots")
    clean = df.select(text.redact_pii("t")).first()[0]
    assert clean.startswith("Paid $1,200.50 on 2024-01-05. Mail [EMAIL], call [PHONE] or [PHONE]. Card [CARD].")
    assert clean.endswith("Or [CARD], [PHONE]")


def test_functions(spark):
    udf.register_sql_functions(spark)
    assert spark.sql("SELECT double_it(21)").first()[0] == 42
    df = spark.createDataFrame([([1.0, 2.0],), ([0.0, 0.0],)], "f array<double>")
    got = [r[0] for r in df.select(udf.logistic_udf([1.0, -0.5], 0.0)("f")).collect()]
    assert got == pytest.approx([0.5, 0.5])
    skewed = spark.range(900).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise("cold").alias("g"), F.col("id").cast("double").alias("v"))
    rows = {r["group"]: (r["rows"], r["total"]) for r in udf.partition_summaries(skewed, "g", "v", 8).collect()}
    assert rows == {"hot": (300, float(sum(range(0, 900, 3)))), "cold": (600, float(sum(i for i in range(900) if i % 3)))}


def test_words_of_four_languages(spark):
    texts = ["Grüße aus München", "très café naïve", "¿Dónde está el niño?", "東京 2024 ok"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = [r[0] for r in df.orderBy("id").select(text.words("t")).collect()]
    assert got == [["grüße", "aus", "münchen"], ["très", "café", "naïve"], ["dónde", "está", "el", "niño"], ["東京", "2024", "ok"]]
    index = text.SearchIndex.build(df, "id", "t")
    assert [r["id"] for r in index.search("CAFÉ", ["t"]).collect()] == [1]
    assert text.query_words(spark, "Très-café 東京") == sorted(["très", "café", "東京"])


def test_rows_like_a_phrase(spark):
    df = spark.createDataFrame([(1, "red ski boots"), (2, "blue ski poles"), (3, "warm hat")], "id int, t string")
    model = text.fit_embedding(df, "t", 1 << 12)
    assert [r["id"] for r in text.similar_to_text(df, model, "id", "warm red hat", 1).collect()] == [3]
    stored = text.embed(df, model, "e")
    assert [r["id"] for r in text.similar_to_text(stored, model, "id", "blue poles", 1, "e").collect()] == [2]


def test_negatives_are_few_and_new(tables):
    examples = ml.recommendation_training_set(tables.orders, tables.order_items, "2001-08-02", negatives=2)
    n = {r["purchased"]: r["count"] for r in examples.groupBy("purchased").count().collect()}
    assert n[0] <= 2 * n[1]
    assert examples.groupBy("customer_id", "product_id").count().filter("count > 1").count() == 0


def test_examples_equal_brute_force_and_read_the_lines_once_more(tables):
    examples = ml.recommendation_training_set(tables.orders, tables.order_items, "2001-08-02", negatives=3)
    assert examples._jdf.queryExecution().optimizedPlan().toString().count("l_partkey") <= 6  # one scan, its filter and join
    customer = {r["order_id"]: r["customer_id"] for r in tables.orders.collect()}
    lines = [(customer[r["order_id"]], r["product_id"]) for r in tables.order_items.collect() if r["order_id"] in customer]
    bought, products = set(lines), sorted({p for _, p in lines})
    places = spark_draws(tables, bought, 3, len(products))
    want = {(c, p, 1) for c, p in bought} | {(c, products[i], 0) for c, i in places if (c, products[i]) not in bought}
    got = [tuple(r) for r in examples.select("customer_id", "product_id", "purchased").collect()]
    assert len(got) == len(want) and set(got) == want


def spark_draws(tables, bought, negatives, below):
    """(customer, place) of the draws of ``bought``."""
    rows = tables.spark.createDataFrame([(c, p, k) for c, p in bought for k in range(1, negatives + 1)], "c long, p long, k long")
    return {tuple(r) for r in rows.select("c", ml.drawn(F.col("c"), F.col("p"), F.col("k"), below=F.lit(below))).collect()}


def test_bounded_rows_are_the_first_draws_and_stay_in_several_tasks(spark):
    df = spark.range(0, 20000, 1, 6).select("id", (F.col("id") % 2).alias("y"))
    draw = ml.drawn(F.col("id"), below=F.lit(2**32))
    for most in (1, 37, 12345):
        got = ml.bounded(df, ["id"], most)
        assert {r[0] for r in got.select("id").collect()} == {
            r[0] for r in df.orderBy(draw, "id").limit(most).select("id").collect()}
        assert got.columns == df.columns
    assert ml.bounded(df, ["id"], 12345).rdd.getNumPartitions() > 1
    assert ml.bounded(df, ["id"], 20000).count() == 20000


def test_models_are_fitted_on_rows_dealt_to_all_cores(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(ml, "train_boosted", lambda train, *a, **k: seen.append(train.rdd.getNumPartitions()))
    rows = spark.range(500).select(F.col("id").alias("customer_id"), (F.col("id") % 2).cast("int").alias("is_churned"))
    ml.train_churn(rows)
    assert seen == [spark.sparkContext.defaultParallelism]


def test_churn_model_is_fitted_on_every_row(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(ml, "train_boosted", lambda train, *a, **k: seen.append(train))
    monkeypatch.setattr(ml, "bounded", lambda df, key, most=10: df.limit(most))
    monkeypatch.setattr(ml, "ROWS_A_TASK", 40, raising=False)
    rows = spark.range(500).select(F.col("id").alias("customer_id"), (F.col("id") % 2).cast("int").alias("is_churned"))
    _model, test = ml.train_churn(rows)
    assert seen[0].count() + test.count() == 500 and seen[0].intersect(test).count() == 0
    # Tasks hold a bounded number of rows.
    assert seen[0].rdd.getNumPartitions() == -(-seen[0].count() // 40)


def test_purchase_model_is_fitted_on_every_row(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(ml, "train_boosted", lambda train, *a, **k: seen.append(train))
    monkeypatch.setattr(ml, "bounded", lambda df, key, most=10: df.limit(most))
    pairs = spark.range(400).select(F.col("id").alias("customer_id"), (F.col("id") % 7).alias("product_id"),
                                    (F.col("id") % 2).cast("int").alias("purchased"))
    _model, test = ml.train_purchase(pairs)
    ids = [r[0] for part in (seen[0], test) for r in part.select("customer_id").collect()]
    assert sorted(ids) == list(range(400))
