import math

from pyspark.sql import functions as F

from tillwise.operators import opinion

ROWS = [
    (1, "Splendid boots. I love them", 5), (2, "Splendid and warm", 4), (3, "not a splendid boot. Broken", 1),
    (4, "broken sole", 2), (5, "boots", 3), (6, None, 5), (7, "", 1), (8, "Splendid! broken", 3),
]


def test_log_odds_equal_brute_force(spark):
    df = spark.createDataFrame(ROWS, "review_id long, review_text string, rating int")
    cut = {1: "splendid boots i love them", 2: "splendid and warm", 3: "not not_a not_splendid not_boot broken",
           4: "broken sole", 5: "boots", 8: "splendid broken"}
    said = [(w, rating) for i, _, rating in ROWS for w in cut.get(i, "").split()]
    total, good, bad = len(said), sum(r >= 4 for _, r in said), sum(r <= 2 for _, r in said)
    want = {}
    for w in {w for w, _ in said}:
        n, p, q = sum(x == w for x, _ in said), sum(x == w and r >= 4 for x, r in said), sum(x == w and r <= 2 for x, r in said)
        a = 10 * n / total
        d = math.log((p + a) / (good + 10 - p - a)) - math.log((q + a) / (bad + 10 - q - a))
        want[w] = (n, p, q, d, d / math.sqrt(1 / (p + a) + 1 / (q + a)))
    got = {r["word"]: tuple(r)[1:] for r in opinion.word_log_odds(df, prior=10.0).collect()}
    assert got.keys() == want.keys()
    assert all(math.isclose(x, y, abs_tol=1e-9) for w in want for x, y in zip(got[w], want[w]))
    assert got["splendid"][3] > 0 > got["not_splendid"][3]
    assert opinion.word_log_odds(df.limit(0)).count() == 0


def test_held_out_reviews_are_told_apart_better_than_by_the_word_list(spark):
    good, bad = ["glides", "snug", "splendid", "crisp"], ["wobbles", "leaks", "rattles", "flimsy"]
    rows = []
    for i in range(600):
        rating = 5 if i % 2 else 1
        word = (good if i % 2 else bad)[i // 2 % 4] if i % 3 else f"not {(bad if i % 2 else good)[i // 2 % 4]}"
        rows.append((i, f"The item number {i} of shelf {i % 17}. It {word} here", rating))
    df = spark.createDataFrame(rows, "review_id long, review_text string, rating int")
    scored = opinion.opinion_scores(df).collect()
    assert len(scored) == 600
    assert sum((r["score"] > 0) == (r["rating"] == 5) for r in scored) >= 0.97 * 600
    again = opinion.opinion_scores(df.repartition(5)).collect()
    assert {(r["review_id"], round(r["score"], 9)) for r in scored} == {(r["review_id"], round(r["score"], 9)) for r in again}


def test_reviews_without_words_are_kept(spark):
    df = spark.createDataFrame(ROWS, "review_id long, review_text string, rating int")
    got = {r["review_id"]: (r["telling"], r["score"]) for r in opinion.opinion_scores(df, least=0.0).collect()}
    assert len(got) == 8 and got[6] == got[7] == (0, 0.0)


def test_words_without_a_say_are_left_out_before_the_shuffle(spark):
    """Every held value passes, the ends of the map included, and hardly any other."""
    df = spark.range(40_000).select((F.col("id") % 3).cast("int").alias("fold"), F.concat(F.lit("w"), "id").alias("word"))
    some = df.filter("substring(word, -1) = '7'")
    passed = df.filter(opinion._may_hold(some, "fold", "word"))
    assert passed.join(some, ["fold", "word"], "left_semi").count() == some.count() == 4000
    assert passed.count() < 4200
    assert df.filter(opinion._may_hold(some.limit(0), "fold", "word")).count() == 0
