import math
import re
from collections import Counter

import numpy as np
import pytest

from tillwise.llm import lexical

SF = "/root/testdata/sf0.001"


def terms(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)


def best(docs, items, k=20):
    """By brute force: the score of every document for every item."""
    bags = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    length, df = sum(b.total() for _, b in bags), Counter(t for _, b in bags for t in b)
    out = []
    for ident, text in set(items):
        found = []
        for doc, bag in bags:
            m = 75 + 25 * bag.total() * len(bags) // length
            score = 0
            for t in terms(text):
                if t in bag:
                    w = math.floor(1000 * math.log((2 * len(bags) + 2) / (2 * df[t] + 1)))
                    score += w * (1_000_000_000 * bag[t] // (1000 * bag[t] + 12 * m))
            if score:
                found.append((-score, doc is None, doc or 0))
        out += [(ident, r, None if null else doc, -s) for r, (s, null, doc) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def pairs(df, a, b):
    return [(r[a], r[b]) for r in df.select(a, b).collect()]


def test_whole_tables(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    assert got(lexical.op13(spark, SF)) == best(pairs(docs, "doc_id", "text"), pairs(items, "item_id", "text"))


@pytest.mark.parametrize(("segment", "block", "k"), [(64, 4, 3), (1000, 16, 20)])
def test_small_blocks_skip_and_lose_nothing(spark, segment, block, k):
    rng = np.random.default_rng(3)
    rare = [f"t{i}" for i in range(400)]
    docs = []
    for i in range(900):
        topic = rng.integers(0, 380)
        words = [*rng.choice(rare[topic:topic + 20], rng.integers(1, 30)), *rng.choice(["the", "of", "in"], 6)]
        docs.append((i, " ".join(words)))
    docs += [(900 + i, docs[7][1]) for i in range(30)]  # ties
    items = [(i, " ".join(rng.choice(rare[s:s + 20], 8)) + " the of") for i, s in enumerate(rng.integers(0, 380, 25))]
    items += [(25, docs[7][1]), (26, "the"), (27, "absent words"), (28, "the the of of")]
    a = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    b = spark.createDataFrame(items, "item_id long, text string")
    assert got(lexical.rank(a, b, k, segment=segment, block=block)) == best(docs, items, k)


def test_blocks_below_the_threshold_are_skipped(spark):
    docs = [(i, f"common topic{i % 20} word{i}") for i in range(2000)]
    a = spark.createDataFrame(docs, "doc_id long, text string")
    bag = Counter(["common", "topic3", "word3"])
    index = lexical.build(a, sorted(bag), segment=500, block=10)
    asked = lexical._ask(index, [bag])
    every = asked.needed(index.stats)
    first = lexical.search(index, [bag], 5).collect()
    asked.least[0] = min(r["score"] for r in first)
    tids, run = lexical._visited(asked, asked.needed(index.stats), index.frequent, 3, False)
    seen = index.lists.filter(index.lists.tid.isin(tids)).mapInArrow(run, "item int, bound long, uids array<long>")
    looked = sum(len(r["uids"]) for r in seen.collect())
    assert len(every[0]) == 2 and 5 <= looked <= 400 and all(r["bound"] >= asked.least[0] for r in seen.collect())


def test_odd_rows(spark, odd, empty):
    items = [(1, "word1 word2 the"), (1, "word1 word2 the"), (1, "same text"), (2, None), (3, ""), (None, "text without id"),
             (4, " ".join(f"word{i % 977}" for i in range(30_000))), (5, "東京 \U0001f642 PÄSS")]
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert got(lexical.rank(odd, asked)) == best(pairs(odd, "doc_id", "text"), [(i, t or "") for i, t in items])
    assert got(lexical.rank(empty, asked)) == [] and got(lexical.rank(odd, asked.limit(0))) == []


def test_items_in_several_blocks(spark, documents, monkeypatch):
    monkeypatch.setattr(lexical, "ITEMS", 2000)
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert got(lexical.rank(documents, items)) == best(pairs(documents, "doc_id", "text"), pairs(items, "item_id", "text"))
