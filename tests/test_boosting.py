import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwise.operators import boosting as b

NAMES = ["x0", "x1", "x2"]


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 8, (600, 3))
    odds = np.where((x[:, 0] > 3) ^ (x[:, 1] > 4), 0.9, 0.15)
    return x, (rng.random(600) < odds).astype(int)


@pytest.fixture(scope="module")
def table(spark, data):
    x, y = data
    rows = [(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, x0 double, x1 double, x2 double, y int").repartition(3).cache()


def brute(x, y, margin, s, depth, edges):
    """Leaf value of each row by trying every split of every node."""
    def leaf(g, h):
        return -np.sign(g) * max(abs(g) - s.l1, 0) / (h + s.l2)

    def quality(g, h):
        return max(abs(g) - s.l1, 0) ** 2 / (h + s.l2)

    p = 1 / (1 + np.exp(-margin))
    gs, hs, out = p - y, p * (1 - p), np.zeros(len(y))

    def grow(idx, level):
        g, h = gs[idx].sum(), hs[idx].sum()
        out[idx] = leaf(g, h)
        tried = []
        for f in range(x.shape[1]):
            for c, edge in enumerate(edges[f]):
                low = idx[x[idx, f] <= edge]
                gl, hl = gs[low].sum(), hs[low].sum()
                gain = (quality(gl, hl) + quality(g - gl, h - hl) - quality(g, h)) / 2 - s.gamma
                if hl >= s.min_child and h - hl >= s.min_child and round(gain, b.PLACES) > 0:
                    tried.append((-round(gain, b.PLACES), f, c))
        if level < depth and tried:
            _, f, c = min(tried)
            side = x[idx, f] <= edges[f][c]
            grow(idx[side], level + 1)
            grow(idx[~side], level + 1)

    grow(np.arange(len(y)), 0)
    return out


def test_trees_equal_brute_force(spark, data, table):
    x, y = data
    s = b.Settings(trees=2, depth=3, rate=0.5, l1=0.3, gamma=0.05, min_child=2.0)
    edges = [[float(i) for i in range(7)]] * 3
    model = b.fit(table, NAMES, "y", "id", s, edges)
    margin = np.zeros(len(y))
    for _ in range(2):
        margin = margin + s.rate * brute(x, y, margin, s, 3, edges)
    got = np.array([r["score"] for r in model.score(table).orderBy("id").collect()])
    assert got == pytest.approx(1 / (1 + np.exp(-margin)), abs=1e-9)


def test_loss_falls_and_held_out_rows_are_told_apart(spark, table):
    train, test = table.filter("id % 3 <> 0"), table.filter("id % 3 = 0")
    model = b.fit(train, NAMES, "y", "id", b.Settings(trees=10, depth=4, rate=0.3, rows=0.8, columns=0.7))
    losses = []
    for n in (1, 4, 10):
        part = b.Boosted(model.features, model.edges, model.rate, model.trees[:n])
        p = F.when(F.col("y") == 1, F.col("score")).otherwise(1 - F.col("score"))
        losses.append(part.score(train).agg(F.avg(-F.log(p))).first()[0])
    assert losses[0] > losses[1] > losses[2]
    # Area under the curve from the returned scores: how often a row of 1 is above a row of 0.
    scored = model.score(test).select("y", "score").toPandas()
    one, zero = (scored.score[scored.y == v].to_numpy() for v in (1, 0))
    area = ((one[:, None] > zero) + 0.5 * (one[:, None] == zero)).mean()
    assert area > 0.8


def test_odd_tables(spark, table):
    s = b.Settings(trees=2, depth=2, rate=1.0)
    empty = b.fit(table.limit(0), NAMES, "y", "id", s)
    assert {r[0] for r in empty.score(table).select("score").distinct().collect()} == {0.5}
    ones = b.fit(table.filter("y = 1"), NAMES, "y", "id", s)
    assert all(t.feature == [-1] for t in ones.trees) and ones.score(table).filter("score <= 0.5").count() == 0
    odd = spark.createDataFrame([(1, None, float("nan"), 1.0, 1), (2, 1.0, 2.0, None, None)], table.schema)
    assert b.fit(table.unionByName(odd), NAMES, "y", "id", s).score(odd).filter("score IS NULL").count() == 0
    assert b.fit(table, NAMES, "y", "id", b.Settings(trees=1, depth=20, max_leaves=3)).trees[0].feature.count(-1) == 3
