from collections import Counter
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import pytest

from tillwise.operators import frequent_pairs as fp


def brute(rows, support):
    baskets = {}
    for b, i in rows:
        if b is not None and i is not None:
            baskets.setdefault(b, set()).add(i)
    n = Counter(p for items in baskets.values() for p in combinations(sorted(items), 2))
    return sorted((a, b, k) for (a, b), k in n.items() if k >= support)


@pytest.fixture(scope="module")
def lines():
    rng = np.random.default_rng(4)
    rows = [(b, f"i{int(i)}") for b in range(300) for i in rng.zipf(1.5, 6) if i < 200]
    rows += [(1000 + k, f"i{i}") for k in range(2) for i in range(70)]  # large baskets, in several parts
    return rows + rows[:20] + [(None, "i1"), (5, None)]


@pytest.mark.parametrize(("support", "slots", "part"), [(1, 64, 8), (3, 64, 8), (3, 1 << 20, 256), (500, 1 << 10, 8)])
def test_equals_brute_force(spark, lines, support, slots, part):
    df = spark.createDataFrame(lines, "basket long, item string").repartition(4)
    got = sorted(map(tuple, fp.frequent_pairs(df, support, "basket", "item", slots, part).collect()))
    assert got == brute(lines, support)
    assert fp.frequent_pairs(df.limit(0), support, "basket", "item", slots, part).count() == 0


def test_rare_pairs_are_never_emitted(spark):
    """A basket of a third of all products: its rows follow the frequent pairs, not its square."""
    rows = [(0, i) for i in range(700)] + [(b, i) for b in range(1, 40) for i in (2 * b, 2 * b + 1, 700 + b)] * 2
    rows += [(b, i) for b in range(100, 140) for i in (2 * (b - 99), 2 * (b - 99) + 1)]
    df = spark.createDataFrame(rows, "basket long, item long")
    lines, _ = fp.frequent_items(df, 2, "basket", "item")
    met = fp.meetings(lines, 16)
    slots = fp.slot_counts(met, 1 << 20).filter("n >= 2").select("slot").toArrow().column(0).to_numpy()
    full = np.zeros(1 << 20, bool)
    full[slots] = True
    assert fp.emitted(met, full).count() < 300 < 700 * 699 / 2
    assert sorted(map(tuple, fp.frequent_pairs(df, 2, "basket", "item").collect())) == brute(rows, 2)


def test_pairs_of_many_baskets_are_made_together():
    """Baskets of the same size give their pairs in one step, a slice of a batch included."""
    items = [[int(i) for i in range(b, b + 2 + b % 3)] for b in range(900)]
    others = [[b + 50, b + 60] if b % 5 == 0 else [] for b in range(900)]
    batch = pa.RecordBatch.from_arrays([pa.array(items, pa.list_(pa.int64())), pa.array(others, pa.list_(pa.int64()))],
                                       names=["items", "others"]).slice(100)
    steps = list(fp._pairs(batch))
    assert len(steps) <= 6
    got = Counter((int(a), int(b)) for x, y in steps for a, b in zip(x, y))
    want = Counter()
    for x, y in list(zip(items, others))[100:]:
        want.update((min(p), max(p)) for p in (product(x, y) if y else combinations(x, 2)))
    assert got == want
    assert list(fp._pairs(batch.slice(0, 0))) == []
