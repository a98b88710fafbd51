"""Boosted trees with second-order leaves for a binary label.

Features are cut into bins once. A level of a tree is one pass over the rows: tasks add up gradient
and curvature per (node, feature, bin), Spark sums these and finds the best split of every node
by running sums over the bins, and one row per node comes to the driver. The gain of a split
and the value of a leaf follow from the two sums with an L2 weight ``l2``, an L1 threshold ``l1``, a
least gain ``gamma`` and a least curvature of a child.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.session import cut_lineage

#: Gains count to this many places, so that the order of a sum doesn't choose between equal splits.
PLACES = 9
#: Trees after which the rows' margins are written anew; trees since then are walked in each pass.
REFRESH = 8
_HISTOGRAM = "node int, feature int, bin int, g double, h double"


@dataclass
class Settings:
    """Parameters of a fit; a tree has at most ``max_leaves`` leaves, which bounds what the driver holds."""

    trees: int = 100
    depth: int = 20
    rate: float = 0.03
    l2: float = 1.0
    l1: float = 0.0
    gamma: float = 0.0
    min_child: float = 1.0
    rows: float = 1.0
    columns: float = 1.0
    bins: int = 64
    max_leaves: int = 4096
    seed: int = 42


@dataclass
class Tree:
    """Node ``i`` splits on ``feature[i]``, bins up to ``cut[i]`` going to ``left[i]``, else to the next one; -1 is a leaf."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [-1])
    left: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])

    def leaf_of(self, bins: np.ndarray) -> np.ndarray:
        """Node each row ends in."""
        feature, cut, left = (np.array(x) for x in (self.feature, self.cut, self.left))
        at = np.zeros(len(bins), dtype=np.int64)
        while True:
            inner = np.flatnonzero(feature[at] >= 0)
            if inner.size == 0:
                return at
            node = at[inner]
            at[inner] = left[node] + (bins[inner, feature[node]] > cut[node])

    def split(self, node: int, feature: int, cut: int, values: tuple[float, float]) -> tuple[int, int]:
        first = len(self.feature)
        self.feature[node], self.cut[node], self.left[node] = feature, cut, first
        for value in values:
            self.feature.append(-1)
            self.cut.append(-1)
            self.left.append(-1)
            self.value.append(value)
        return first, first + 1


@dataclass
class Boosted:
    """A fitted model: edges of the bins of each feature, and trees."""

    features: list[str]
    edges: list[list[float]]
    rate: float
    trees: list[Tree] = field(default_factory=list)
    gains: list[float] = field(default_factory=list)

    def score(self, df: DataFrame, column: str = "score") -> DataFrame:
        """Add the probability of label 1 of every row."""
        margin = _margins(self.trees, self.rate)
        out = df.withColumn("_bins", _binned(self.features, self.edges))
        return out.withColumn(column, F.lit(1.0) / (F.lit(1.0) + F.exp(-margin(F.col("_bins"))))).drop("_bins")


def quantile_edges(df: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """At most ``bins - 1`` different quantiles per feature, in one aggregate; none where all is NULL."""
    wanted = [i / bins for i in range(1, bins)]
    row = df.agg(*[F.percentile_approx(F.col(f).cast("double"), wanted, 10_000).alias(f"q{i}")
                   for i, f in enumerate(features)]).first()
    return [sorted({x for x in (q or []) if np.isfinite(x)}) for q in row]


def _binned(features: Sequence[str], edges: Sequence[Sequence[float]]) -> Column:
    """Number of edges below each feature's value; NULL and NaN count as the smallest value."""
    def place(name, cuts):
        x = F.nanvl(F.col(name).cast("double"), F.lit(float("-inf")))
        below = F.lit(0)
        for cut in cuts:  # at most ``bins`` terms, kept inside generated code
            below = below + F.coalesce(x > F.lit(float(cut)), F.lit(False)).cast("int")
        return below.cast("smallint")

    return F.array(*[place(f, e) for f, e in zip(features, edges)])


def _matrix(bins: pd.Series) -> np.ndarray:
    return np.stack(bins.to_numpy())


def _margins(trees: list[Tree], rate: float):
    @F.pandas_udf("double")
    def margin(bins: pd.Series) -> pd.Series:
        out = np.zeros(len(bins))
        if len(bins):
            m = _matrix(bins)
            for tree in trees:
                out += rate * np.array(tree.value)[tree.leaf_of(m)]
        return pd.Series(out)

    return margin


def fit(df: DataFrame, features: Sequence[str], label: str, key: str, settings: Settings | None = None,
        edges: list[list[float]] | None = None) -> Boosted:
    """Fit on the rows with a label; ``edges`` may be given instead of quantiles.

    ``key`` decides by its hash which rows a tree sees where ``rows`` is below one. A split of no
    gain is not made, so a table of one class, or an empty one, gives leaves without splits.
    """
    s = settings or Settings()
    features = list(features)
    known = df.filter(F.col(label).isNotNull())
    edges = quantile_edges(known, features, s.bins) if edges is None else edges
    rows = cut_lineage(df.sparkSession, known.select(
        F.xxhash64(key).alias("draw"), F.col(label).cast("double").alias("y"),
        _binned(features, edges).alias("bins"), F.lit(0.0).alias("margin")))
    model = Boosted(features, edges, s.rate)
    rng = np.random.default_rng(s.seed)
    recent: list[Tree] = []
    for number in range(s.trees):
        picked = sorted(rng.choice(len(features), max(1, round(s.columns * len(features))), replace=False).tolist())
        seen = rows if s.rows >= 1 else rows.filter(
            F.pmod(F.xxhash64(F.lit(s.seed + number), "draw"), F.lit(1_000_000)) < int(s.rows * 1_000_000))
        tree, gain = _grow(seen, recent, picked, s)
        model.trees.append(tree)
        model.gains.append(gain)
        recent.append(tree)
        if len(recent) == REFRESH and number + 1 < s.trees:
            margin = F.col("margin") + _margins(recent, s.rate)("bins")
            rows = cut_lineage(df.sparkSession, rows.select("draw", "y", "bins", margin.alias("margin")))
            recent = []
    return model


def _grow(rows: DataFrame, recent: list[Tree], picked: list[int], s: Settings) -> tuple[Tree, float]:
    """One tree, level by level; returns it and the sum of its gains."""
    tree, total = Tree(), 0.0
    open_nodes, leaves = [0], 1
    for level in range(max(s.depth, 1)):
        found = best_splits(_histogram(rows, recent, tree, open_nodes, picked, s.rate), s)
        if level == 0:
            root = found.select("g", "h").first()
            if root is None:
                break
            tree.value[0] = _leaf(root["g"], root["h"], s)
        room = s.max_leaves - leaves if s.depth else 0
        made = found.filter("gain IS NOT NULL").orderBy(F.desc("gain"), "node").limit(room).collect()
        open_nodes = []
        for r in sorted(made, key=lambda r: r["node"]):
            values = _leaf(r["gl"], r["hl"], s), _leaf(r["g"] - r["gl"], r["h"] - r["hl"], s)
            open_nodes += tree.split(r["node"], r["feature"], r["bin"], values)
            total += r["gain"]
        leaves += len(made)
        if not made:
            break
    return tree, total


def _histogram(rows: DataFrame, recent: list[Tree], tree: Tree, nodes: list[int], picked: list[int],
               rate: float) -> DataFrame:
    """Sums of gradient and curvature per (node, feature, bin) of the open nodes."""
    wanted = np.array(nodes)
    features = np.array(picked)

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if pdf.empty:
                continue
            bins, margin = _matrix(pdf["bins"]), pdf["margin"].to_numpy().copy()
            for t in recent:
                margin += rate * np.array(t.value)[t.leaf_of(bins)]
            p = 1.0 / (1.0 + np.exp(-margin))
            node = tree.leaf_of(bins)
            own = np.flatnonzero(np.isin(node, wanted))
            n = len(own)
            cells = pd.DataFrame({
                "node": np.repeat(node[own], len(features)).astype(np.int32),
                "feature": np.tile(features, n).astype(np.int32),
                "bin": bins[own][:, features].ravel().astype(np.int32),
                "g": np.repeat((p - pdf["y"].to_numpy())[own], len(features)),
                "h": np.repeat((p * (1 - p))[own], len(features))})
            yield cells.groupby(["node", "feature", "bin"], as_index=False).sum()

    return rows.select("y", "bins", "margin").mapInPandas(add, _HISTOGRAM).groupBy("node", "feature", "bin").agg(
        F.sum("g").alias("g"), F.sum("h").alias("h"))


def _shrunk(g, s: Settings):
    return F.signum(g) * F.greatest(F.abs(g) - F.lit(s.l1), F.lit(0.0))


def _leaf(g: float, h: float, s: Settings) -> float:
    shrunk = np.sign(g) * max(abs(g) - s.l1, 0.0)
    return float(-shrunk / (h + s.l2)) if h + s.l2 > 0 else 0.0


def best_splits(histogram: DataFrame, s: Settings) -> DataFrame:
    """Sums of each node and its best split (ties to the first feature and bin), NULL where none gains.

    A window holds the bins of one feature in one node, so at most ``bins`` rows.
    """
    w = Window.partitionBy("node", "feature")
    run = w.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    sums = histogram.select("node", "feature", "bin", F.sum("g").over(run).alias("gl"), F.sum("h").over(run).alias("hl"),
                            F.sum("g").over(w).alias("g"), F.sum("h").over(w).alias("h"))

    def quality(g, h):
        return F.try_divide(_shrunk(g, s) * _shrunk(g, s), h + F.lit(s.l2))

    gl, hl, g, h = (F.col(c) for c in ("gl", "hl", "g", "h"))
    gain = (quality(gl, hl) + quality(g - gl, h - hl) - quality(g, h)) / F.lit(2.0) - F.lit(s.gamma)
    fits = (hl >= s.min_child) & (h - hl >= s.min_child)
    tried = sums.withColumn("gain", F.when(fits, F.round(gain, PLACES))).withColumn(
        "gain", F.when(F.col("gain") > 0, F.col("gain")))
    best = F.struct("gain", -F.col("feature"), -F.col("bin"))
    return tried.groupBy("node").agg(
        F.max_by(F.struct("gain", "feature", "bin", "gl", "hl", "g", "h"), best).alias("best"),
        F.max("gain").alias("top")).select(
        "node", F.col("best.g").alias("g"), F.col("best.h").alias("h"), F.col("top").alias("gain"),
        "best.feature", "best.bin", "best.gl", "best.hl")
