"""The most similar pairs of a table of vectors, by a tree of pivots searched from the top.

Rows are dealt to pivots drawn among them, node by node, until every node is small enough for
one task. Each node knows its mean and its radius, so two nodes bound the similarity of any two
rows below them. The search starts with the pairs inside leaves, whose k-th best similarity is
a floor; then it walks pairs of nodes from the root, level by level, and leaves out every pair of
nodes that can't reach the floor with all that lies below it. What is left are pairs of leaves,
visited in batches, the most promising first, with the floor raised after each batch.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.operators.similarity import visit
from tillwise.session import cut_lineage

#: Children of a node.
FAN = 8
#: Pairs of leaves of the first batch; each batch is four times the one before.
FIRST_BATCH = 64
#: Similarities count to this many places, so that equal vectors tie whatever the order of a sum.
PLACES = 12
_SLACK = 1e-9  # a bound may round below the value it bounds


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _distance(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))


def _bound(ca: Column, ra: Column, cb: Column, rb: Column) -> Column:
    """Largest similarity a row of one ball can have to a row of the other."""
    near = F.greatest(_distance(ca, cb) - ra - rb, F.lit(0.0))
    return F.lit(1.0) - near * near / F.lit(2.0) + F.lit(_SLACK)


def unit_rows(df: DataFrame, key: str, vec: str, copies: int) -> DataFrame:
    """Vectors of length one, with at most ``copies`` rows of equal ones, the smallest keys.

    NULL vectors, vectors without length and those with NULL or non-finite numbers have no
    direction and are left out; so are rows without a key.
    """
    v = F.transform(F.col(vec), lambda x: x.cast("double"))
    length = F.sqrt(_dot(F.col("v"), F.col("v")))
    rows = df.select(F.col(key).cast("long").alias("id"), v.alias("v")).filter(F.col("id").isNotNull())
    usable = rows.withColumn("length", length).filter((F.col("length") > 0) & (F.col("length") < float("inf")))
    unit = usable.select("id", F.transform("v", lambda x: x / F.col("length")).alias("v"))
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    return unit.withColumn("place", place).filter(F.col("place") <= copies).drop("place")


@dataclass
class PivotTree:
    """``rows`` (id, v, node) in leaves, and ``nodes`` (node, parent, leaf, centre, radius)."""

    rows: DataFrame
    nodes: DataFrame


def _balls(rows: DataFrame) -> DataFrame:
    centres = rows.groupBy("node").agg(
        vector_to_array(Summarizer.mean(array_to_vector("v"))).alias("centre"), F.count("*").alias("n"))
    return rows.join(centres, "node").groupBy("node", "parent", "centre", "n").agg(
        F.max(_distance(F.col("v"), F.col("centre"))).alias("radius"))


def build_tree(unit: DataFrame, leaf_rows: int) -> PivotTree:
    """Deal rows to the nearest of a node's pivots until no node holds more than ``leaf_rows``.

    A level is one pass over the rows of nodes that are still too large. The pivots are the rows
    of the smallest hashes, other ones at each level, so a level whose pivots happen to be equal
    is followed by one whose are not.
    """
    spark = unit.sparkSession
    level, leaves, nodes = 0, None, None
    rows = cut_lineage(spark, unit.select("id", "v", F.lit("r").alias("node"), F.lit(None).cast("string").alias("parent")))
    while True:
        balls = cut_lineage(spark, _balls(rows).withColumn("leaf", F.col("n") <= leaf_rows).drop("n"))
        nodes = balls if nodes is None else nodes.unionByName(balls)
        small = rows.join(balls.filter("leaf").select("node"), "node", "left_semi").select("id", "v", "node")
        leaves = small if leaves is None else leaves.unionByName(small)
        large = balls.filter("NOT leaf").select("node")
        if large.isEmpty():
            return PivotTree(leaves, nodes)
        level += 1
        own = rows.join(large, "node", "left_semi")
        drawn = own.withColumn("place", F.row_number().over(Window.partitionBy("node").orderBy(
            F.xxhash64(F.lit(level), "id"), "id"))).filter(F.col("place") <= FAN)
        pivots = drawn.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("place", "v"))).alias("pivots"))
        near = F.transform("pivots", lambda p: _dot(F.col("v"), p["v"]))
        dealt = own.join(pivots, "node").withColumn("near", near)
        rows = cut_lineage(spark, dealt.select(
            "id", "v", F.concat_ws(".", "node", F.array_position("near", F.array_max("near")).cast("string")).alias("node"),
            F.col("node").alias("parent")))


@dataclass
class PairSearch:
    """Result of a search and how many pairs of nodes and of leaves it looked at."""

    pairs: DataFrame | None = None
    bounded: int = 0
    visited: int = 0
    batches: list[int] = field(default_factory=list)


def closest_pairs(df: DataFrame, key: str, vec: str, k: int, leaf_rows: int = 2048) -> DataFrame:
    """The ``k`` most similar pairs (``id_a`` < ``id_b``), exactly; see :func:`search`."""
    return search(df, key, vec, k, leaf_rows).pairs


def search(df: DataFrame, key: str, vec: str, k: int, leaf_rows: int = 2048) -> PairSearch:
    """Find the ``k`` most similar pairs by cosine, ties to the smaller ids; keys are unique.

    Of equal vectors only the ``k + 1`` smallest keys take part: each pair of another copy comes
    after ``k`` pairs that are as similar and have smaller ids, so a large group of copies costs
    nothing. Vectors that are nearly equal in great number leave the bounds no room, and pairs of
    their leaves are all visited. An empty table has no pairs; with fewer pairs than ``k`` all are returned.
    """
    spark = df.sparkSession
    # A node of nothing but copies of one vector must fit into a leaf.
    tree = build_tree(unit_rows(df, key, vec, k + 1), max(leaf_rows, 2 * (k + 1)))
    rows = cut_lineage(spark, tree.rows.withColumnRenamed("node", "block"))
    nodes = cut_lineage(spark, tree.nodes)
    leaf = nodes.filter("leaf").select("node")
    done = PairSearch(visited=leaf.count())
    best = _top(visit(leaf.select(F.col("node").alias("a"), F.col("node").alias("b")), rows, k, places=PLACES), k)
    best = cut_lineage(spark, best)
    floor = _floor(best, k)

    # A leaf stands for itself below pairs of nodes of different depth.
    below = nodes.select(F.coalesce("parent", F.lit("")).alias("parent"), "node", "leaf", "centre", "radius").unionByName(
        nodes.filter("leaf").select(F.col("node").alias("parent"), "node", "leaf", "centre", "radius"))
    one = below.select(*[F.col(c).alias(f"a_{c}") for c in below.columns])
    two = below.select(*[F.col(c).alias(f"b_{c}") for c in below.columns])
    front = nodes.filter("parent IS NULL AND NOT leaf").select(F.col("node").alias("a"), F.col("node").alias("b"))
    ready = None
    while not front.isEmpty():
        met = front.join(one, F.col("a") == F.col("a_parent")).join(two, F.col("b") == F.col("b_parent"))
        met = met.filter((F.col("a") != F.col("b")) | (F.col("a_node") <= F.col("b_node"))).withColumn(
            "bound", _bound(F.col("a_centre"), F.col("a_radius"), F.col("b_centre"), F.col("b_radius")))
        met = cut_lineage(spark, met.select(
            F.col("a_node").alias("a"), F.col("b_node").alias("b"), "bound", (F.col("a_leaf") & F.col("b_leaf")).alias("both")))
        done.bounded += met.count()
        kept = met.filter(F.col("bound") >= floor)
        found = kept.filter("both AND a <> b").select("a", "b", "bound")
        ready = found if ready is None else ready.unionByName(found)
        front = kept.filter("NOT both").select("a", "b")

    size = FIRST_BATCH
    while ready is not None:
        ready = ready.filter(F.col("bound") >= floor)
        left = ready.count()
        if left == 0:
            break
        share = max(0.0, 1.0 - size / left)
        edge = ready.agg(F.percentile_approx("bound", share, 10_000)).first()[0] if share else -2.0
        batch = cut_lineage(spark, ready.filter(F.col("bound") >= edge).select("a", "b"))
        done.batches.append(batch.count())
        best = cut_lineage(spark, _top(best.unionByName(visit(batch, rows, k, floor, PLACES)), k))
        floor = _floor(best, k)
        ready = ready.filter(F.col("bound") < edge)
        size *= 4
    done.visited += sum(done.batches)
    done.pairs = best.orderBy(F.desc("similarity"), "id_a", "id_b")
    return done


def _top(pairs: DataFrame, k: int) -> DataFrame:
    return pairs.orderBy(F.desc("similarity"), "id_a", "id_b").limit(k)


def _floor(best: DataFrame, k: int) -> float:
    """The k-th best similarity so far; below all others while there are fewer pairs."""
    n, least = best.agg(F.count("*"), F.min("similarity")).first()
    return least if n >= k else -2.0
