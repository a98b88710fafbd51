"""Cosine similarity: to a query vector, and the most similar pairs of a table."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.session import cut_lineage

BLOCK_ROWS = 2048
#: Numbers of the vectors of a group of blocks, about, and the least number of groups.
SPAN = 1 << 20
LEAST_GROUPS = 8
_SLACK = 1e-9  # a bound may round below the value it bounds


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays, NULL when one has no length."""
    return F.try_divide(_dot(a, b), F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b)))


def similarity_topk(df: DataFrame, key: str, vec: str, query: Sequence[float], k: int) -> DataFrame:
    """Rows most similar to a query vector: one scan, ``k`` rows kept per task."""
    q = F.array(*[F.lit(float(x)) for x in query])
    return df.withColumn("similarity", cosine(F.col(vec), q)).orderBy(
        F.desc_nulls_last("similarity"), F.asc(key)).limit(k)


def pairwise_topk(df: DataFrame, key: str, vec: str, k: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The ``k`` most similar pairs, exactly.

    Vectors are cut into blocks of about ``block_rows`` by direction (sign pattern of a
    few coordinates), so a block has a small radius where the data has clusters. Pairs
    inside each block give a lower bound for the k-th best similarity; a pair of blocks
    is only visited when centre distance and radii allow a better one (triangle
    inequality on unit vectors). A visit multiplies bounded matrices in one task and
    returns at most ``k`` pairs, so no list of all pairs ever exists; see :func:`visit`.

    Intermediate blocks are written tables in the cluster's shared folder.
    """
    length = F.sqrt(_dot(F.col(vec), F.col(vec)))
    unit = df.filter(length > 0).select(
        F.col(key).cast("long").alias("id"),
        F.transform(F.col(vec), lambda x: x.cast("double") / length).alias("v"))
    # As many direction bits as give cells of about one block.
    bits = max(0, (df.count() // block_rows).bit_length() - 1)
    cell = F.aggregate(F.slice("v", 1, bits), F.lit(0), lambda s, x: s * 2 + F.when(x > 0, 1).otherwise(0))
    marked = unit.withColumn("cell", cell)
    # One row per cell, and a cell is a block or more.
    run = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    sizes = marked.groupBy("cell").agg(
        F.ceil(F.count("*") / F.lit(block_rows)).cast("long").alias("parts")).withColumn(
        "before", F.sum("parts").over(run) - F.col("parts"))
    blocks = sizes.agg(F.sum("parts")).scalar()
    block = marked.join(sizes, "cell").select(
        "id", "v", (F.col("before") + F.pmod(F.xxhash64("id"), F.col("parts"))).alias("block"))

    # Read many times below, so it is computed once and its lineage cut.
    block = cut_lineage(df.sparkSession, block)

    # One row per block: mean direction and the largest distance from it.
    centres = block.groupBy("block").agg(
        vector_to_array(Summarizer.mean(array_to_vector("v"))).alias("centre"))
    meta = cut_lineage(df.sparkSession, block.join(centres, "block").groupBy("block", "centre").agg(
        F.max(_distance(F.col("v"), F.col("centre"))).alias("radius")))

    inside = visit(meta.select(F.col("block").alias("a"), F.col("block").alias("b")), block, k)
    order = [F.desc("similarity"), F.asc("id_a"), F.asc("id_b")]
    first = cut_lineage(df.sparkSession, inside.orderBy(*order).limit(k))
    floor = first.agg(F.when(F.count("*") == k, F.min("similarity")).otherwise(F.lit(-1.0))).first()[0]
    # Blocks, not rows, are paired here: one row per ``block_rows`` vectors.
    a = meta.select(F.col("block").alias("a"), F.col("centre").alias("ca"), F.col("radius").alias("ra"))
    b = meta.select(F.col("block").alias("b"), F.col("centre").alias("cb"), F.col("radius").alias("rb"))
    later = a.filter(F.col("a") < blocks - 1).withColumn(
        "b", F.explode(F.sequence(F.col("a") + 1, blocks - F.lit(1))))
    near = F.greatest(_distance(F.col("ca"), F.col("cb")) - F.col("ra") - F.col("rb"), F.lit(0.0))
    across = later.join(b, "b").filter(F.lit(1.0) - near * near / F.lit(2.0) + F.lit(_SLACK) >= floor)
    across = cut_lineage(df.sparkSession, across.select("a", "b"))
    return first.unionByName(visit(across, block, k, floor)).orderBy(*order).limit(k)


def _distance(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))


def _tiles(pairs: DataFrame, rows: DataFrame, groups: int) -> tuple[DataFrame, DataFrame]:
    """(a, b, p, q): pairs of blocks with the groups that meet, and (p, q, block, id, v): the rows each tile needs."""
    g, h = (F.pmod(F.xxhash64(c), F.lit(groups)) for c in ("a", "b"))
    tiles = pairs.select("a", "b", F.least(g, h).alias("p"), F.greatest(g, h).alias("q"))
    sent = tiles.select("p", "q", F.col("a").alias("block")).unionByName(
        tiles.select("p", "q", F.col("b").alias("block"))).distinct()
    return tiles, sent.join(rows, "block").select("p", "q", "block", "id", "v")


def visit(pairs: DataFrame, rows: DataFrame, k: int, floor: float = -1.0, places: int | None = None) -> DataFrame:
    """(id_a, id_b, similarity): among them the ``k`` best row pairs of all ``pairs`` (a, b) of blocks.

    ``rows`` has id, v (length one) and block. Blocks are put into groups and pairs of groups are
    tiles, one task each. A block goes to a tile once, however many of its pairs lie there, so rows
    are shuffled as often as there are groups and not as there are blocks. A tile holds about
    2 * ``SPAN`` numbers. Pairs below ``floor`` are left out; similarities count to ``places``.
    """
    numbers = rows.agg(F.sum(F.size("v"))).first()[0] or 0
    tiles, shipped = _tiles(pairs, rows, max(LEAST_GROUPS, -(-numbers // SPAN)))
    met = tiles.select(F.col("p").alias("of_p"), F.col("q").alias("of_q"), "a", "b")
    return shipped.groupBy("p", "q").cogroup(met.groupBy("of_p", "of_q")).applyInPandas(
        lambda own, met: _best_pairs(own, met, k, floor, places), "id_a long, id_b long, similarity double")


def _best_pairs(own: pd.DataFrame, met: pd.DataFrame, k: int, floor: float, places: int | None) -> pd.DataFrame:
    """Top pairs of one tile; ids ascend within a pair."""
    ids = own["id"].to_numpy()
    m = np.stack(own["v"].to_numpy()) if len(own) else np.empty((0, 0))
    blocks = {name: (ids[at], m[at]) for name, at in own.groupby("block").indices.items()}
    x, y, best = ids[:0], ids[:0], np.empty(0)
    for a, b in zip(met["a"], met["b"]):
        (ids_a, m_a), (ids_b, m_b) = blocks[a], blocks[b]
        for start in range(0, len(ids_a), 512):
            sims = m_a[start:start + 512] @ m_b.T
            if a == b:  # each pair of rows once
                sims[np.arange(sims.shape[0])[:, None] + start >= np.arange(sims.shape[1])] = -np.inf
            flat = sims.ravel()
            pick = np.flatnonzero(flat >= max(floor, -1.0) - _SLACK)
            if not len(pick):
                continue
            found = flat[pick] if places is None else np.round(flat[pick], places)
            if len(found) > k:  # whatever ties with the k-th best stays, since ids decide
                keep = found >= np.partition(found, len(found) - k)[len(found) - k]
                pick, found = pick[keep], found[keep]
            i, j = np.unravel_index(pick, sims.shape)
            u, v = ids_a[start + i], ids_b[j]
            x, y = np.concatenate([x, np.minimum(u, v)]), np.concatenate([y, np.maximum(u, v)])
            best = np.concatenate([best, found])
            first = np.lexsort((y, x, -best))[:k]
            x, y, best = x[first], y[first], best[first]
            if len(best) == k:
                floor = max(floor, best[-1])
    return pd.DataFrame({"id_a": x, "id_b": y, "similarity": best})
