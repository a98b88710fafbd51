import math
import re
from collections import Counter

from pyspark.sql import functions as F

from tillwise.operators import text
from tillwise.operators.search_index import SegmentedIndex


def bm25(docs, q, limit):
    bags = {k: Counter(w for w in re.split(r"[\W_]+", (t or "").lower()) if w) for k, t in docs.items()}
    filled = [b for b in bags.values() if b]
    average = sum(b.total() for b in filled) / len(filled) if filled else 1
    out = Counter()
    for t in set(q.lower().split()):
        df = sum(t in b for b in bags.values())
        for k, b in bags.items():
            if b[t]:
                idf = math.log(1 + (len(bags) - df + 0.5) / (df + 0.5))
                out[k] += idf * b[t] * 2.2 / (b[t] + 1.2 * (0.25 + 0.75 * b.total() / average))
    return sorted(((k, round(s, 6)) for k, s in out.items()), key=lambda x: (-x[1], x[0]))[:limit]


def same(index, docs, q, limit=5):
    got = [(r["k"], round(r["score"], 5)) for r in index.search(q, limit)[0].collect()]
    want = [(k, round(s, 5)) for k, s in bm25(docs, q, limit)]
    assert got == want, (got, want)


def test_inserts_changes_and_deletes_equal_a_rebuild(spark, folder):
    index = SegmentedIndex(spark, folder, "k", "t", fan=3)
    docs = {}
    words = ["red", "green", "blue", "cold", "warm", "old", "new"]
    assert index.search("red")[0].count() == 0
    for batch in range(8):
        changes = []
        for i in range(12):
            k = (batch * 5 + i * 3) % 40
            if (k + batch) % 5 == 0:
                changes.append((i, "DELETE", k, None))
                docs.pop(k, None)
            else:
                text = None if k % 13 == 5 else " ".join(words[(k * j + batch) % 7] for j in range(1, 3 + k % 9))
                changes.append((i, "UPSERT", k, text))
                docs[k] = text
        changes.append((99, "UPSERT", None, "red red"))
        df = spark.createDataFrame(changes, "seq long, op string, k long, t string")
        index.apply(df)
        if batch == 4:
            index.apply(df)  # a replayed batch
        if batch % 3 == 1 or batch == 7:
            for q in ("red", "warm blue", "old absent", "absent"):
                same(index, docs, q)
        state = index.state()
        assert state["docs"] == len(docs) and len(state["segments"]) <= 5
    before = [tuple(r) for r in index.search("red old")[0].collect()]
    assert index.vacuum()
    assert [tuple(r) for r in index.search("red old")[0].collect()] == before


def test_segments_below_the_threshold_are_skipped(spark, folder):
    index = SegmentedIndex(spark, folder, "k", "t", fan=10)
    docs = {}
    for batch in range(6):
        rows = {batch * 10 + i: ("rare rare rare" if batch == 2 else "rare " + "filler " * 60) for i in range(8)}
        docs |= rows
        index.apply(spark.createDataFrame([(0, "UPSERT", k, t) for k, t in rows.items()],
                                          "seq long, op string, k long, t string"))
    same(index, docs, "rare")
    best, read = index.search("rare", 5)
    assert read == [3] and best.count() == 5


def test_search_reads_postings_by_term(spark, folder):
    index = SegmentedIndex(spark, folder, "k", "t")
    df = spark.range(2000).select(F.lit(0).alias("seq"), F.lit("UPSERT").alias("op"), F.col("id").alias("k"),
                                  F.concat_ws(" ", F.lit("word"), F.col("id")).alias("t"))
    index.apply(df)
    segments = index.state()["segments"]
    plan = index.hits(["17"], segments, segments)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^]]*(In|EqualTo)\(term", plan)
    assert index.hits(["17"], segments, segments).count() == 1


def test_terms_are_counted_inside_the_row(spark):
    rows = [(1, "b a b ä B"), (2, ""), (3, "one"), (4, " ".join(f"w{i % 7}" for i in range(100)))]
    df = spark.createDataFrame(rows, "k long, t string").select("k", text.words("t").alias("w"))
    got = {r["k"]: (r["length"], [tuple(x) for x in r["terms"]]) for r in text.term_counts(df, "w").collect()}
    for k, t in rows:
        words = re.findall(r"\w+", t.lower())
        assert got[k] == (len(words), sorted(Counter(words).items()))


def test_postings_are_made_without_a_hash_of_the_input(spark, folder, monkeypatch):
    """No aggregation stands below the shuffle, and a range holds as many postings in a large index as in a small one."""
    rows = [(i, " ".join(f"w{(i * j) % 50}" for j in range(30))) for i in range(100)] + [(3, "again w3")]
    docs = spark.createDataFrame(rows, "k long, t string")
    built = text.SearchIndex.build(docs, "k", "t")
    plan = built.postings._jdf.queryExecution().executedPlan().toString()
    assert not any("Filter" in line and "zip_with" in line for line in plan.splitlines())  # terms are counted once
    assert "HashAggregate" in plan.split("Exchange")[0] and "HashAggregate" not in plan.split("Exchange", 1)[1]
    monkeypatch.setattr(text, "RANGE", 500)
    built.write(folder)
    n = built.postings.count()
    stored = spark.read.parquet(f"{folder}/postings")
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, built.postings.collect()))
    sizes = [r["count"] for r in stored.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) > n / 1000 and max(sizes) <= 1000
