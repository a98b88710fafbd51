import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tillwise.llm import simhash
from tillwise.llm import components as components_of
from tillwise.llm.common import stage
from tillwise.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_print(text, width=4):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(codes, distance=4):
    parent = list(range(len(codes)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(codes))]


def test_query_equals_brute_force(documents):
    rows = sorted((r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect())
    codes = [brute_print(t) for _, t in rows]
    want = {i: (f"{c:016x}", rows[g][0]) for (i, _), c, g in zip(rows, codes, brute_groups(codes))}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.op1(documents).collect()}
    assert got == want


def clustered(n, seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    codes = base[rng.integers(0, len(base), n)]
    for _ in range(7):
        flip = np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)
        codes = np.where(rng.random(n) < 0.5, codes ^ flip, codes)
    return np.unique(codes)


def test_index_finds_all_components_inside_groups():
    codes = clustered(700, 1)
    rank = codes.copy()
    for s in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(s)
    codes = codes[np.argsort(rank)]
    root = simhash.search(codes, np.zeros(len(codes), int), 4, block=64)
    want = brute_groups([int(c) for c in codes])
    assert len(set(zip(root.tolist(), want))) == len(set(want)) == len(set(root.tolist()))


def test_large_buckets_are_cut_without_losing_links(spark):
    codes = clustered(500, 2)
    frame = spark.createDataFrame([(int(c) - (1 << 64) if c >> np.uint64(63) else int(c),) for c in codes], "fp long")
    roots = {r["node"]: r["root"] for r in components(simhash.near_links(frame, 4, bucket=20)).collect()}
    signed = [int(c) - (1 << 64) if int(c) >> 63 else int(c) for c in codes]
    want = brute_groups([int(c) for c in codes])
    got = [roots.get(c, c) for c in signed]
    assert len(set(zip(got, want))) == len(set(want)) == len(set(got))


def test_dense_group_is_linked_once(spark):
    frame = spark.range(4096).select(F.col("id").alias("fp"))
    links = simhash.near_links(frame, 4)
    assert links.count() <= 15 * 4096  # spanning links per mask, not pairs
    roots = components(links).select("root").distinct().collect()
    assert len(roots) == 1


def test_components_of_a_long_path(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    roots = components(edges)
    assert roots.count() == 301 and roots.agg(F.max("root")).first()[0] == 0


def test_nodes_under_their_roots_need_no_round(spark, monkeypatch):
    """A round only where a node does not hang under a root yet: none is made to see that nothing changes."""
    made = []
    monkeypatch.setattr(components_of, "stage", lambda df: made.append(1) or stage(df))

    def rooted(edges):
        made.clear()
        return {tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}, len(made)

    want = {(1, 1), (5, 1), (6, 1), (2, 2), (9, 2)}
    assert rooted([(1, 5), (6, 1), (9, 2), (1, 1), (2, 2)]) == (want, 1)
    assert rooted([]) == (set(), 1)
    assert rooted([(5, 6), (1, 5), (9, 2)]) == (want, 3)


def test_odd_rows(odd, empty):
    got = simhash.op1(odd).collect()
    assert len(got) == odd.count()
    blank = {r["component_id"] for r in got if r["fingerprint"] == "0" * 16}
    assert blank == {0}  # null and empty texts are linked; the smallest id names them
    assert simhash.op1(empty).count() == 0


def test_one_of_each_group_stays(odd, empty):
    kept = simhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    groups = {r["component"] for r in simhash.near_duplicates(odd).collect()}
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [0, 3, 3, 5, 6, 7, 9] and ids.count(None) == 1
    assert groups <= {0, 3, 5, 6, 7, 9, None}
    assert simhash.drop_near_duplicates(empty).count() == 0
