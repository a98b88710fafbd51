"""Approximate nearest neighbours by balanced posting lists.

A bounded sample of the vectors is halved again and again along its widest direction, so
that the parts are of equal size; their middles are the centroids. Every vector is filed
under its nearest centroid, and a boundary vector under further ones that are almost as
near and lie in other directions. Centroids are found by walking a neighbour graph held
in memory. A query reads all lists whose centroid is at most a given factor farther
than its nearest one. Lists and their queries are cut into blocks, so a list that holds a
third of all vectors is many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.llm.common import stage

#: Vectors the index is fitted on, and numbers in them, at most.
SAMPLE = 20_000
SAMPLE_NUMBERS = 4_000_000
#: Vectors a list should hold; lists there are at most.
LIST = 256
LISTS = 1024
#: A vector is filed under up to COPIES centroids at most REACH times as far as the nearest.
COPIES, REACH = 4, 1.15
#: A query reads lists whose centroid is at most PROBE times as far as the nearest one.
PROBE = 1.25
DEGREE = 32
#: Rows of a list, and queries of a list, in one block.
BLOCK = 2048


class Index:
    """Unit centroids and the graph that links each with its nearest ones."""

    def __init__(self, sample: np.ndarray, total: int):
        parts = [sample]
        while len(parts) < LISTS and total / len(parts) > LIST and len(sample) / len(parts) > 8:
            parts = [half for p in parts for half in self._halves(p)]
        middle = np.array([p.mean(axis=0) for p in parts if len(p)])
        size = np.linalg.norm(middle, axis=1, keepdims=True)
        self.centroids = middle / np.where(size > 0, size, 1.0)
        apart = self._apart(self.centroids, self.centroids)
        self.apart = apart
        near = np.argsort(apart, axis=1, kind="stable")[:, 1:DEGREE + 1]
        n = len(self.centroids)
        links = np.zeros((n, n), bool)
        links[np.repeat(np.arange(n), near.shape[1]), near.ravel()] = True
        links[np.arange(n), (np.arange(n) + 1) % n] = True  # a ring keeps the graph in one piece
        self.links = (links | links.T).astype(np.float32)
        self.entries = np.arange(0, n, max(1, n // 8))

    @staticmethod
    def _halves(p: np.ndarray) -> list[np.ndarray]:
        if len(p) < 2:
            return [p]
        axis = np.linalg.eigh(np.cov(p.T) if p.shape[1] > 1 else np.eye(1))[1][:, -1]
        order = np.argsort((p - p.mean(axis=0)) @ axis, kind="stable")
        return [p[order[:len(p) // 2]], p[order[len(p) // 2:]]]

    @staticmethod
    def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(2 - 2 * a @ b.T, 0))

    def walk(self, q: np.ndarray, factor: float) -> np.ndarray:
        """Distances of unit rows to the centroids met on the graph; infinite elsewhere.

        From the entries on, all centroids within ``factor`` of the nearest one met are opened.
        """
        n = len(self.centroids)
        known = np.full((len(q), n), np.inf)
        known[:, self.entries] = self._apart(q, self.centroids[self.entries])
        opened = np.zeros((len(q), n), bool)
        while True:
            best = known.min(axis=1, keepdims=True)
            to_open = (known <= factor * best + 1e-12) & ~opened
            rows = np.flatnonzero(to_open.any(axis=1))
            if not len(rows):
                return known
            opened |= to_open
            fresh = (to_open[rows].astype(np.float32) @ self.links > 0) & np.isinf(known[rows])
            i, j = np.nonzero(fresh)
            known[rows[i], j] = np.sqrt(np.maximum(
                2 - 2 * np.einsum("nd,nd->n", q[rows[i]], self.centroids[j]), 0))

    def file(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of every filing: the nearest centroid, then others in other directions."""
        known = self.walk(v, REACH)
        first = known.argmin(axis=1)
        rows, lists = [np.arange(len(v))], [first]
        best = known[np.arange(len(v)), first]
        # A list is no good if its centroid is nearer to one already chosen than to the vector.
        open_ = (known <= REACH * best[:, None]) & (self.apart[first] >= 0.8 * known)
        open_[np.arange(len(v)), first] = False
        for _ in range(COPIES - 1):
            some = np.flatnonzero(open_.any(axis=1))
            if not len(some):
                break
            pick = np.where(open_[some], known[some], np.inf).argmin(axis=1)
            rows.append(some)
            lists.append(pick)
            open_[some] &= self.apart[pick] >= 0.8 * known[some]
            open_[some, pick] = False
        return np.concatenate(rows), np.concatenate(lists)

    def probes(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        known = self.walk(q, PROBE)
        return np.nonzero(known <= PROBE * known.min(axis=1, keepdims=True) + 1e-12)


def usable(v: Column) -> Column:
    """Whether a vector takes part: not null, all numbers finite, not all zero."""
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return v.isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists(v, lambda x: x != 0)


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)  # squares of very large or small numbers stay finite
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _filing(index, probing: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = _unit(_matrix(batch.column(batch.schema.get_field_index("v"))))
                rows, lists = index.value.probes(v) if probing else index.value.file(v)
                taken = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [*taken.columns, pa.array(lists.astype(np.int32))], names=[*batch.schema.names, "list"])

    return run


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, always added up in the same order."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def _block_search(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[], [], [], []]
        if left.num_rows and right.num_rows:
            qid, qh = left["id"].to_numpy(), left["h"].to_numpy()
            q, c = _matrix(left["v"]), _matrix(right["v"])
            cid = right["id"].to_numpy()  # a null id becomes NaN and equals none
            near = _unit(q) @ _unit(c).T
            near[qid[:, None] == cid[None, :]] = -np.inf
            keep = min(k, len(c))
            kth = np.partition(near, len(c) - keep, axis=1)[:, len(c) - keep]
            for i in range(len(q)):
                at = np.flatnonzero((near[i] >= kth[i] - 1e-12) & (near[i] > -2))
                if not len(at):
                    continue
                exact = cosine(np.broadcast_to(q[i], (len(at), q.shape[1])), c[at])
                order = np.lexsort((cid[at], -exact))[:k]
                out[0].append(np.full(len(order), qid[i]))
                out[1].append(np.full(len(order), qh[i]))
                out[2].append(at[order])
                out[3].append(exact[order])
        at = np.concatenate(out[2]) if out[2] else np.zeros(0, np.int64)
        return pa.table({
            "query_id": pa.array(np.concatenate(out[0]) if out[0] else [], pa.int64()),
            "query_h": pa.array(np.concatenate(out[1]) if out[1] else [], pa.int64()),
            "id": right["id"].combine_chunks().take(pa.array(at)).cast(pa.int64()),
            "h": right["h"].combine_chunks().take(pa.array(at)).cast(pa.int64()),
            "score": pa.array(np.concatenate(out[3]) if out[3] else [], pa.float64())})

    return run


def nearest(vectors: DataFrame, every: int, k: int = 5, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """The ``k`` nearest found of every row whose id is divisible by ``every``, among all others.

    Returns query_id, rank, id, score (cosine, double precision, on the original numbers);
    ties go to the smaller id. Vectors that are null, zero or hold null or non-finite
    numbers, or differ in length from the most frequent length, take no part. Rows with a null
    id are candidates, after others at a tie, and no queries. Rows that share id and vector
    count once; rows that share only the id are never each other's neighbours. Other columns
    are ignored; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).filter(usable(F.col("v")))
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    schema = "query_id long, rank int, id long, score double"
    if common is None:
        return spark.createDataFrame([], schema)
    d = common["d"]
    rows = rows.filter(F.size("v") == F.lit(d)).withColumn("h", F.xxhash64("v"))
    rows = rows.dropDuplicates(["id", "h"])
    rows = stage(rows)
    bound = max(1, min(SAMPLE, SAMPLE_NUMBERS // d))
    picked = rows.withColumn("o", F.xxhash64("h", "id")).orderBy("o").limit(bound).select("v").toArrow()
    index = spark.sparkContext.broadcast(Index(_unit(_matrix(picked["v"])), rows.count()))

    filed = stage(rows.mapInArrow(_filing(index, False), "id long, v array<double>, h long, list int"))
    asked = stage(rows.filter(F.col("id") % F.lit(every) == 0).mapInArrow(
        _filing(index, True), "id long, v array<double>, h long, list int"))

    def blocks(df: DataFrame) -> DataFrame:  # one row per list
        return df.groupBy("list").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("n"))

    sizes = F.broadcast(blocks(filed).withColumnRenamed("n", "n_rows").join(
        blocks(asked).withColumnRenamed("n", "n_asked"), "list"))  # at most LISTS rows
    mine = F.pmod(F.xxhash64("h", "id"), F.col("n_rows")).cast("int")
    cells = filed.join(sizes, "list").select(
        "id", "v", "h", "list", mine.alias("part"),
        F.explode(F.sequence(F.lit(0), F.col("n_asked") - F.lit(1))).alias("turn"))
    turn = F.pmod(F.xxhash64("h", "id"), F.col("n_asked")).cast("int")
    queries = asked.join(sizes, "list").select(
        "id", "v", "h", "list", turn.alias("turn"),
        F.explode(F.sequence(F.lit(0), F.col("n_rows") - F.lit(1))).alias("part"))
    key = ["list", "part", "turn"]
    found = queries.groupBy(*key).cogroup(cells.groupBy(*key)).applyInArrow(
        _block_search(k), "query_id long, query_h long, id long, h long, score double")
    found = found.groupBy("query_id", "query_h", "id", "h").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id", "query_h").orderBy(F.desc("score"), F.asc_nulls_last("id"), "h")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= F.lit(k)).select(
        "query_id", "rank", "id", "score")


def op3(vectors: DataFrame) -> DataFrame:
    """The registered report: every 50th id, five neighbours."""
    return nearest(vectors, every=50).select("query_id", "rank", F.col("id").alias("vec_id"), "score")
