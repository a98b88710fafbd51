import numpy as np
import pytest

from tillwise.operators import closest_pairs as cp


def brute(ids, m, k):
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    sims = np.round(u @ u.T, cp.PLACES)
    pairs = [(-sims[i, j], min(ids[i], ids[j]), max(ids[i], ids[j])) for i in range(len(ids)) for j in range(i)]
    return [(a, b, -s) for s, a, b in sorted(pairs)[:k]]


def frame(spark, ids, m):
    return spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids, m)], "id long, v array<double>")


def same(got, want):
    assert [(r["id_a"], r["id_b"]) for r in got] == [w[:2] for w in want]
    assert [r["similarity"] for r in got] == pytest.approx([w[2] for w in want], abs=1e-9)


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(40, 16))
    return centres[rng.integers(0, 40, 1200)] + 0.05 * rng.normal(size=(1200, 16))


def test_equals_brute_force(spark, clustered):
    ids = np.random.default_rng(1).permutation(5000)[:500]
    flat = np.random.default_rng(2).normal(size=(100, 16))
    m = np.vstack([clustered[:400], flat])
    same(cp.closest_pairs(frame(spark, ids, m), "id", "v", 20, 100).collect(), brute(ids, m, 20))


def test_node_pairs_stay_below_the_square(spark, clustered):
    ids = np.arange(600)
    found = cp.search(frame(spark, ids, clustered[:600]), "id", "v", 10, 30)
    same(found.pairs.collect(), brute(ids, clustered[:600], 10))
    tree = cp.build_tree(cp.unit_rows(frame(spark, ids, clustered[:600]), "id", "v", 11), 30)
    leaves = tree.nodes.filter("leaf").count()
    assert tree.rows.count() == 600 and tree.rows.groupBy("node").count().agg({"count": "max"}).first()[0] <= 30
    assert found.visited - leaves < leaves * (leaves - 1) / 2 / 4
    assert found.bounded < leaves * (leaves + 1) / 2


def test_copies_cost_nothing(spark):
    """A third of all rows are one vector: only k + 1 of them are compared."""
    rng = np.random.default_rng(3)
    m = np.vstack([np.tile(rng.normal(size=8), (100, 1)), rng.normal(size=(200, 8))])
    ids = rng.permutation(300)
    df = frame(spark, ids, m)
    assert cp.unit_rows(df, "id", "v", 6).count() == 206
    same(cp.closest_pairs(df, "id", "v", 5, 60).collect(), brute(ids, m, 5))


def test_odd_rows(spark):
    df = spark.createDataFrame(
        [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [1.0, None]), (6, [float("nan"), 1.0]),
         (None, [1.0, 1.0]), (7, [0.0, 3.0])], "id long, v array<double>")
    got = cp.closest_pairs(df, "id", "v", 10, 2).collect()
    assert [tuple(r) for r in got] == [(1, 2, 1.0), (1, 7, 0.0), (2, 7, 0.0)]
    assert cp.closest_pairs(df.limit(0), "id", "v", 3).count() == 0
