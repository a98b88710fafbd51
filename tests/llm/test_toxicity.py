import numpy as np
from pyspark.sql import functions as F

from tillwise.llm import toxicity


def test_held_out_accuracy(spark):
    where = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{where}/labels.parquet")
    got = toxicity.op8(spark, where)
    seen = got.filter("held_out").join(labels, "doc_id").groupBy("toxic", "predicted").count().collect()
    n = {(r["toxic"], r["predicted"]): r["count"] for r in seen}
    assert n[(1, 1)] >= 0.7 * (n[(1, 1)] + n.get((1, 0), 0))
    assert n.get((0, 1), 0) <= 0.03 * n[(0, 0)]
    bad = got.filter("score < 0 or score > 1 or score is null or predicted <> cast(score >= 0.5 as int)")
    assert got.count() == 10_000 and bad.count() == 0


def test_spelling_model_is_kneser_ney():
    words = ["bad", "badly", "good", "goods", "bat"]
    code, place, word = toxicity.letters(words)
    key = toxicity.grams(code, place, toxicity.ORDER)[place > 0]
    toxic = np.isin(word[place > 0], (0, 1)).astype(float)
    model = toxicity.Model(key, toxic, 1 - toxic)
    d = dict(zip(["bad", "good", "xyz"], model.differences(["bad", "good", "xyz"])))
    assert d["bad"] > 1 and d["good"] < -1 and abs(d["xyz"]) < 0.5
    # After "^b", the toxic words go on with "a" twice in two times, one kind.
    total = toxicity.DISCOUNT
    top, context = model.top, model.context
    k = toxicity.grams(*toxicity.letters(["ba"])[:2], toxicity.ORDER)[2:3]
    assert top.get(k)[0][0] == 2 and context.get(k >> 12)[0][0] == 2 and context.get(k >> 12)[2][0] == 1 and total < 1


def planted(spark, folder):
    rng = np.random.default_rng(1)
    docs, labels = [], []
    for i in range(400):
        words = [f"{a}{b}" for a, b in zip(rng.choice(list("klmnprst"), 60), rng.choice(["ana", "obe", "ili", "uru"], 60))]
        toxic = int(i % 5 == 0)
        if toxic:
            words[int(rng.integers(0, 60))] = "vexu" + str(rng.choice(["ma", "lo", "tri"]))
        docs.append((i, " ".join(words), "xx", "s", 0))
        if i % 2 == 0 or toxic:
            labels.append((i, 1, toxic))
    docs += [(None, None, None, None, None), (900, "", "xx", "s", 0), (901, "one vexuzo two", "xx", "s", 0),
             (901, "one vexuzo two", "xx", "s", 0)]
    labels += [(None, 1, 1), (3, None, None)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long") \
        .withColumn("score", F.lit("clash")).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def test_planted_words_are_found(spark, folder):
    planted(spark, folder)
    rows = toxicity.op8(spark, folder).collect()
    assert len(rows) == 404
    got = {r["doc_id"]: r["predicted"] for r in rows}
    assert sum(got[i] for i in range(0, 400, 5)) >= 76 and sum(got[i] for i in range(400) if i % 5) <= 6
    assert got[901] == 1 and got[900] == 0
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = toxicity.drop_toxic(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    assert kept.columns == docs.columns and kept.count() == sum(r["predicted"] == 0 for r in rows)


def test_without_labels_or_rows(documents, spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model, weights = toxicity.fit(documents, labels)
    assert model is None and toxicity.drop_toxic(documents, labels).count() == documents.count()
    rows = documents.limit(0).select("doc_id", F.col("text").cast("binary").alias("text"))
    assert toxicity.score(rows, model, weights).count() == 0


def test_bounds_on_the_sample_do_not_shift_the_scores(spark, monkeypatch):
    ordinary = [f"calm{i % 7} plain{i % 11} words{i % 13}" for i in range(400)]
    mixed = [f"vile{i % 5} words{i % 13} plain{i % 11}" for i in range(200)]
    rows = [(i, t) for i, t in enumerate(ordinary + mixed)]
    marks = [(i, int(i >= 400 and i % 4 == 0)) for i, _ in rows]  # a quarter of the mixed ones
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")

    def mean():
        model, weights = toxicity.fit(docs, labels)
        scored = toxicity.score(docs.filter("doc_id >= 400"), model, weights)
        return scored.agg({"score": "avg"}).first()[0]

    whole = mean()
    monkeypatch.setattr(toxicity, "MOST_ORDINARY", 60)
    assert abs(mean() - whole) < 0.12
