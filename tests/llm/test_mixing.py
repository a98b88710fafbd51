import re

from pyspark.sql import functions as F

from tillwise.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def water(sizes, weights=(1, 2, 3)):
    """Targets by filling up one source at a time."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while len(fixed) < len(names):
        rest = total - sum(fixed.values())
        free = sum(weight[s] for s in names if s not in fixed)
        over = [s for s in names if s not in fixed and rest * weight[s] / free > 3 * sizes[s]]
        if not over:
            return fixed | {s: rest * weight[s] / free for s in names if s not in fixed}
        fixed |= {s: 3.0 * sizes[s] for s in over}
    return fixed


def test_query_against_brute_force(documents):
    sources = {r["doc_id"]: r["source"] for r in documents.collect()}
    words = {r["doc_id"]: len(WORD.findall(r["text"])) for r in documents.collect()}
    sizes = {}
    for i, s in sources.items():
        sizes[s] = sizes.get(s, 0) + words[i]
    want = water(sizes)
    got = mixing.op4(documents).collect()
    taken = {}
    for r in got:
        s = sources[r["doc_id"]]
        assert r["size"] == words[r["doc_id"]] and r["source_size"] == sizes[s]
        assert abs(r["target"] - want[s]) < 1e-6 * want[s] + 1e-6
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[s] = taken.get(s, 0) + r["taken"]
    assert len(got) == len(words)
    assert all(abs(taken[s] - want[s]) <= 0.03 * want[s] + 2 for s in want)


def test_caps_and_reruns(spark):
    rows = [(i, "w " * 50, "small") for i in range(2)] + [(i, "w " * 50, "large") for i in range(100, 400)]
    rows += [(i, "w " * 50, None) for i in range(500, 503)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    first = sorted(map(tuple, mixing.op4(df).collect()))
    assert first == sorted(map(tuple, mixing.op4(df.repartition(5)).collect()))
    by = {}
    for _, _, size, target, taken in first:
        t, k = by.get((size, target), (0, 0))
        by[(size, target)] = (t + taken, k + 1)
    assert {size for size, _ in by} == {100, 15000, 150}
    for (size, target), (taken, _) in by.items():
        assert target <= 3 * size and abs(taken - target) <= 0.02 * target + 2


def test_schedule_points_do_not_overflow(spark):
    ids = [0, 1, 2, 12345, 2**20 - 1, 2**20, 2**33 + 7, 2**39 + 11]
    df = spark.createDataFrame([(i,) for i in ids], "t long").select("t", mixing._multiply_mod(F.col("t")).alias("u"))
    assert {r["t"]: r["u"] for r in df.collect()} == {i: i * mixing.STEP % 2**62 for i in ids}


def test_mix_is_what_the_report_says(documents):
    out = mixing.take_mix(documents)
    assert out.columns == documents.columns
    got = {r["doc_id"]: r["n"] for r in out.groupBy("doc_id").agg(F.sum(mixing.word_count()).alias("n")).collect()}
    want = {r["doc_id"]: r["taken"] for r in mixing.op4(documents).collect() if r["taken"]}
    assert got == want
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    assert all(texts[r["doc_id"]].startswith(r["text"]) for r in out.collect())


def test_odd_rows(odd, empty):
    got = mixing.op4(odd).collect()
    assert len(got) == odd.count() and all(r["taken"] <= 3 * r["size"] for r in got)
    assert mixing.take_mix(odd).columns == odd.columns
    assert mixing.op4(empty).count() == 0 and mixing.take_mix(empty).count() == 0
