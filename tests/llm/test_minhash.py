import hashlib

import numpy as np
from pyspark.sql import functions as F

from tillwise.llm import minhash


def jaccard(a, b):
    def shingles(t):
        w = t.split()
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    a, b = shingles(a), shingles(b)
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def test_query_equals_brute_force(documents):
    rows = sorted(((r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()), reverse=True)
    got = {r["doc_id"]: r for r in minhash.op2(documents).collect()}
    edits, others = [], []
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        cut = len(t) // 3
        edited = t[:len(t) - cut] + nxt[:cut]
        assert got[i]["n_chars"] == len(t)
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        edits.append(got[i]["near_edited"] - jaccard(t, edited))
        others.append(got[i]["near_next"] - jaccard(t, nxt))
    assert len(got) == len(rows)
    assert abs(np.mean(edits)) < 0.015 and np.abs(edits).max() < 0.2
    # Unlike texts: chance agreement below its mean counts as none, so errors are never negative.
    assert 0 <= np.mean(others) < 0.02 and np.abs(others).max() < 0.1


def test_equal_texts_and_only_these_have_likeness_one(spark):
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words), " ".join(words), "", " ", "a b", "a c", " ".join(words[::-1])]
    df = minhash.with_fingerprint(spark.createDataFrame(list(enumerate(texts)), "i int, text string"), "text", "fp")
    fp = {r["i"]: r["fp"] for r in df.collect()}
    assert fp[0] == fp[1] and fp[2] == fp[3] == "" and fp[4] != fp[5]
    assert all(len(fp[i]) == 128 for i in (0, 4, 6))


def test_densified_bins_estimate_short_texts(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(120):
        words = [f"t{i}w{k}" for k in range(24)]
        rows.append((i, " ".join(words), " ".join(words[:int(rng.integers(5, 25))])))
    df = spark.createDataFrame(rows, "i int, a string, b string")
    df = minhash.with_fingerprint(minhash.with_fingerprint(df, "a", "fa"), "b", "fb")
    got = df.withColumn("near", minhash.likeness("fa", "fb")).collect()
    errors = [r["near"] - jaccard(r["a"], r["b"]) for r in got]
    assert abs(np.mean(errors)) < 0.05 and np.abs(errors).mean() < 0.12


def test_plan_is_native_and_shuffles_texts_once(documents):
    plan = minhash.op2(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_odd_rows(odd, empty):
    got = minhash.op2(odd)
    assert got.count() == odd.count()
    assert got.filter(F.col("near_edited").isNull() | F.col("near_next").isNull()).count() == 0
    assert got.filter("doc_id = 3 and n_chars = 3").select("edited_sha256").distinct().count() == 1
    assert minhash.op2(empty).count() == 0


def test_single_document_follows_itself(documents):
    row = minhash.op2(documents.filter("doc_id = 7")).first()
    assert row["near_next"] == 1.0
