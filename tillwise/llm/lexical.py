"""Ranked lexical search over posting lists in geometric blocks.

Documents are dealt to segments of bounded size. In a segment each term's posting list is
clustered by document similarity (random projections of the weighted term vectors, pivots
from the list itself), and each cluster, a block, keeps a summary: for every term the
largest contribution it makes in any document of the block, rounded up. The inner product
of an item's weights with a summary bounds the score of every document in the block.
Lists of frequent terms hold most of a segment and are blocked as one set of cells of all
its documents.

A search first scores the documents of each item's best bounded blocks; the 20th best of
these scores is a threshold. Then every block of the lists an item needs is skipped when
its bound is below the threshold, and only then: results are those of scoring everything.
Lists an item needs are those that can lift a document over the threshold at all.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.llm.common import prepare, running, stage, table, text_or_empty

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
TOP = 20
#: Documents a segment and a block aim at; a list over the 16th part of all documents is frequent.
SEGMENT, BLOCK, FREQUENT = 8192, 128, 16
#: Characters of items searched at once; blocks first scored for each item.
ITEMS, FIRST = 1 << 21, 8
#: Contributions go to 1,000,000; summaries keep them in steps, rounded up to a byte.
STEP = 4000
_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}
CELLS = -1


def terms(text: str) -> list[str]:
    return TERM.findall(text.lower() if text.isascii() else text.translate(_LOWER))


def _packed(a: np.ndarray, kind) -> bytes:
    return np.ascontiguousarray(a, kind).tobytes()


# -- forward index --------------------------------------------------------------------------

def forward(docs: DataFrame, vocabulary: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(uid, id, n, tids, tfs) of every document with a term: its length and its terms of the vocabulary."""
    number = {t: i for i, t in enumerate(vocabulary)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, tids, tfs = [], [], []
            for text in batch.column(2).to_pylist():
                counted = Counter(terms(text))
                known = sorted((number[t], k) for t, k in counted.items() if t in number)
                sizes.append(counted.total())
                tids.append([t for t, _ in known])
                tfs.append([k for _, k in known])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(tids, pa.list_(pa.int32())),
                 pa.array(tfs, pa.list_(pa.int64()))], names=["uid", "id", "n", "tids", "tfs"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"),
                       text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(run, f"uid long, id {kind}, n long, tids array<int>, tfs array<long>").filter("n > 0")


@dataclass
class Stats:
    """Figures of all documents and of the vocabulary's terms."""

    docs: int
    length: int
    df: np.ndarray
    top: np.ndarray  # largest contribution of each term

    def weights(self) -> np.ndarray:
        """Weight of each term; 0 for one that no document holds."""
        return np.array([math.floor(1000 * math.log((2 * self.docs + 2) / (2 * int(d) + 1))) if d else 0
                         for d in self.df], np.int64)


def scored_terms(fwd: DataFrame, size: int) -> tuple[DataFrame, Stats]:
    """(uid, id, tids, cs) with each term's contribution, and the figures; one row per term of the vocabulary comes here."""
    docs, length = fwd.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    m = F.expr(f"75 + (25 * n * {docs}L) div {max(length, 1)}L")
    cs = F.expr("transform(tfs, tf -> cast((1000000000L * tf) div (1000L * tf + 12L * m) AS int))")
    out = fwd.filter(F.size("tids") > 0).withColumn("m", m).select("uid", "id", "tids", cs.alias("cs"))
    per = (out.select(F.explode(F.arrays_zip("tids", "cs")).alias("x"))
           .groupBy(F.col("x.tids").alias("tid")).agg(F.count("*").alias("df"), F.max("x.cs").alias("top")).toArrow())
    df, top = np.zeros(size, np.int64), np.zeros(size, np.int64)
    at = per.column("tid").to_numpy()
    df[at], top[at] = per.column("df").to_numpy(), per.column("top").to_numpy()
    return out, Stats(docs, length, df, top)


# -- index ------------------------------------------------------------------------------------

_LISTS = "seg int, tid int, docs binary, ends binary, coords binary, tops binary, spans binary"


def clusters(sketch: np.ndarray, size: int) -> list[np.ndarray]:
    """Rows in clusters of about ``size``, at most: nearest of evenly drawn pivots, large ones cut in order of nearness."""
    n = len(sketch)
    if n <= size:
        return [np.arange(n)]
    pivots = sketch[np.linspace(0, n - 1, -(-n // size)).astype(int)]
    nearness = sketch @ pivots.T
    own = nearness.argmax(axis=1)
    order = np.lexsort((-nearness[np.arange(n), own], own))
    starts = np.flatnonzero(np.concatenate([[True], own[order][1:] != own[order][:-1]]))
    return [order[a + k:min(a + k + size, b)] for a, b in zip(starts, [*starts[1:], n]) for k in range(0, b - a, size)]


def _indexed(weights: np.ndarray, frequent: np.ndarray, block: int):
    """Posting lists of one segment's documents, in blocks with their summaries."""
    directions = np.random.default_rng(11).normal(size=(len(weights), 24)).astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches).combine_chunks()
        seg = rows.column("seg")[0].as_py()
        uids = rows.column("uid").to_numpy()
        lists = rows.column("tids").combine_chunks()
        ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
        tids = lists.flatten().to_numpy()
        cs = (-(-rows.column("cs").combine_chunks().flatten().to_numpy() // STEP)).astype(np.uint8)
        doc = np.repeat(np.arange(len(uids)), np.diff(ends))
        strength = (weights[tids] * cs).astype(np.float32)
        sketch = np.empty((len(uids), directions.shape[1]), np.float32)
        for d in range(sketch.shape[1]):
            sketch[:, d] = np.bincount(doc, strength * directions[tids, d], minlength=len(uids))
        sketch /= np.maximum(np.linalg.norm(sketch, axis=1, keepdims=True), 1e-9)
        best = np.zeros(len(weights), np.uint8)  # of the block at hand, else 0

        def row(tid: int, members: np.ndarray) -> tuple:
            blocks = [members[c] for c in clusters(sketch[members], block)]
            coords, tops, spans = [], [], [0]
            for b in blocks:
                at = np.concatenate([np.arange(ends[i], ends[i + 1]) for i in b])
                np.maximum.at(best, tids[at], cs[at])
                found = np.flatnonzero(best)
                coords.append(found)
                tops.append(best[found])
                spans.append(spans[-1] + len(found))
                best[found] = 0
            return (tid, _packed(uids[np.concatenate(blocks)], np.int64),
                    _packed(np.cumsum([len(b) for b in blocks]), np.int32), _packed(np.concatenate(coords), np.int32),
                    _packed(np.concatenate(tops), np.uint8), _packed(spans, np.int32))

        def lists_of() -> Iterator[tuple]:
            yield row(CELLS, np.arange(len(uids)))
            rare = np.flatnonzero(~frequent[tids])
            order = rare[np.argsort(tids[rare], kind="stable")]
            for part in np.split(order, np.flatnonzero(np.diff(tids[order])) + 1):
                if len(part):
                    yield row(int(tids[part[0]]), doc[part])

        for part in itertools.batched(lists_of(), 256):
            columns = list(zip(*part))
            yield pa.RecordBatch.from_arrays(
                [pa.array([seg] * len(part), pa.int32()), pa.array(columns[0], pa.int32()),
                 *[pa.array(c, pa.binary()) for c in columns[1:]]],
                names=["seg", "tid", "docs", "ends", "coords", "tops", "spans"])

    return run


@dataclass
class Index:
    vocabulary: list[str]
    documents: DataFrame
    lists: DataFrame
    stats: Stats
    frequent: np.ndarray


def build(docs: DataFrame, vocabulary: list[str], segment: int = SEGMENT, block: int = BLOCK) -> Index:
    """Index of all documents for the terms of ``vocabulary``, in two written tables."""
    fwd = stage(forward(docs, vocabulary))
    documents, stats = scored_terms(fwd, len(vocabulary))
    frequent = stats.df * FREQUENT > stats.docs
    segments = -(-stats.docs // segment) or 1
    dealt = documents.withColumn("seg", F.pmod(F.xxhash64("uid"), F.lit(segments)).cast("int"))
    lists = dealt.select("seg", "uid", "tids", "cs").groupBy("seg").applyInArrow(
        _indexed(stats.weights(), frequent, block), _LISTS)
    return Index(vocabulary, documents, stage(lists), stats, frequent)


# -- search -----------------------------------------------------------------------------------

@dataclass
class Asked:
    """Items as sparse weights over the vocabulary, and the least score each still needs."""

    tids: list[np.ndarray]
    weights: list[np.ndarray]
    least: np.ndarray

    def needed(self, stats: Stats) -> list[np.ndarray]:
        """Terms whose lists an item needs: what all others add up to stays below its threshold."""
        out = []
        for tids, weights, least in zip(self.tids, self.weights, self.least):
            best = weights * stats.top[tids]
            order = np.argsort(best, kind="stable")
            out.append(tids[order[np.cumsum(best[order]) >= least]])
        return out


def _bounds(row: dict, dense: np.ndarray) -> np.ndarray:
    spans = row["spans"]
    products = dense[row["coords"]] * row["tops"].astype(np.int64)
    return np.add.reduceat(products, spans[:-1]) * STEP if len(products) else np.zeros(len(spans) - 1, np.int64)


_KINDS = {"docs": np.int64, "ends": np.int32, "coords": np.int32, "tops": np.uint8, "spans": np.int32}


def _visited(asked: Asked, needed: list[np.ndarray], frequent: np.ndarray, size: int, first: bool):
    """Blocks an item has to look into: (item, bound, uids); at first only each list's best block."""
    by_tid: dict[int, list[int]] = {}
    for item, tids in enumerate(needed):
        rare = tids[~frequent[tids]]
        # Cells hold every document, so other lists add none; at first the rare terms' lists promise more.
        whole = len(rare) < len(tids) if not first else not len(rare)
        for t in ([CELLS] if whole else rare.tolist()):
            by_tid.setdefault(t, []).append(item)
    wide = np.zeros(size, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, bounds, uids = [], [], []
            for raw in batch.to_pylist():
                row = {k: np.frombuffer(raw[k], kind) for k, kind in _KINDS.items()}
                starts = np.concatenate([[0], row["ends"]])
                for item in by_tid.get(raw["tid"], ()):
                    wide[asked.tids[item]] = asked.weights[item]
                    bound = _bounds(row, wide)
                    wide[asked.tids[item]] = 0
                    at = [int(bound.argmax())] if first else np.flatnonzero(bound >= asked.least[item]).tolist()
                    for b in at:
                        items.append(item)
                        bounds.append(int(bound[b]))
                        uids.append(row["docs"][starts[b]:starts[b + 1]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, pa.int32()), pa.array(bounds, pa.int64()), pa.array(uids, pa.list_(pa.int64()))],
                names=["item", "bound", "uids"])

    return sorted(by_tid), run


def _scored(asked: Asked, size: int):
    wide = np.zeros(size, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, items, scores = [], [], []
            columns = [batch.column(c) for c in ("tids", "cs", "items")]
            for i, (tids, cs, wanted) in enumerate(zip(*columns)):
                wide[:] = 0
                wide[tids.values.to_numpy()] = cs.values.to_numpy()
                for item in wanted.as_py():
                    rows.append(i)
                    items.append(item)
                    scores.append(int((wide[asked.tids[item]] * asked.weights[item]).sum()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, pa.int32()), batch.column("uid").take(pa.array(rows, pa.int64())),
                 batch.column("id").take(pa.array(rows, pa.int64())), pa.array(scores, pa.int64())],
                names=["item", "uid", "id", "score"])

    return run


def _best(index: Index, asked: Asked, blocks: DataFrame, k: int) -> DataFrame:
    """(item, rank, uid, id, score): the best k of the documents in ``blocks``, by exact scores."""
    pairs = blocks.select("item", F.explode("uids").alias("uid")).groupBy("uid").agg(F.collect_set("item").alias("items"))
    kind = index.documents.schema["id"].dataType.simpleString()
    scored = index.documents.join(pairs, "uid").select("uid", "id", "tids", "cs", "items").mapInArrow(
        _scored(asked, len(index.vocabulary)), f"item int, uid long, id {kind}, score long").filter("score > 0")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"), "uid")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _ask(index: Index, items: list[Counter]) -> Asked:
    number = {t: i for i, t in enumerate(index.vocabulary)}
    weights = index.stats.weights()
    tids = [np.array([number[t] for t in item], np.int64) for item in items]
    return Asked(tids, [weights[t] * np.array(list(item.values()), np.int64) for t, item in zip(tids, items)],
                 np.ones(len(items), np.int64))


def search(index: Index, items: list[Counter], k: int = TOP) -> DataFrame:
    """(item, rank, uid, id, score) of the ``k`` best documents of each item, a bag of terms by its place in the list.

    Equal scores go by ascending id, null last. Every item is a query against all documents.
    """
    size = len(index.vocabulary)
    asked = _ask(index, items)

    def visit(first: bool) -> DataFrame:
        tids, run = _visited(asked, asked.needed(index.stats), index.frequent, size, first)
        return index.lists.filter(F.col("tid").isin(tids)).mapInArrow(run, "item int, bound long, uids array<long>")

    order = Window.partitionBy("item").orderBy(F.desc("bound"), F.hash("uids"))
    some = visit(True).withColumn("r", F.row_number().over(order)).filter(F.col("r") <= FIRST)
    found = _best(index, asked, some, k)
    for item, least in found.filter(F.col("rank") == k).select("item", "score").collect():  # one row per item
        asked.least[item] = least
    return _best(index, asked, visit(False), k)


def _blocks(items: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple]]:
    """Distinct (id, text) of items, of at most about ``ITEMS`` characters at a time, on the driver."""
    rows = items.select(F.col(item_col).alias("id"), text_or_empty(text_col).alias("text")).distinct().withColumns({
        "h": F.xxhash64("id", "text"), "size": F.char_length("text").cast("long") + 64, "one": F.lit(0)})
    placed = stage(running(rows, ["one"], "h", ("id", "text"), "size", "before")
                   .withColumn("block", F.floor(F.col("before") / ITEMS)))
    for block in [r[0] for r in placed.select("block").distinct().orderBy("block").collect()]:
        yield [(r["id"], r["text"]) for r in placed.filter(F.col("block") == block).orderBy("id", "text").collect()]


def rank(docs: DataFrame, items: DataFrame, k: int = TOP, item_col: str = "item_id", text_col: str = "text",
         segment: int = SEGMENT, block: int = BLOCK) -> DataFrame:
    """(item_id, rank, doc_id, score) of the best documents of each item.

    Items go in blocks of bounded text, each against all documents. Rows of equal item id
    and text are one item; a document's row counts each time it occurs. Texts without
    terms are no documents and no items find anything by them.
    """
    spark = docs.sparkSession
    # A row of the index is a list of kilobytes: fewer of them are held at once.
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", "256")
    out = None
    for part in _blocks(items, item_col, text_col):
        bags = [Counter(terms(text)) for _, text in part]
        vocabulary = sorted({t for bag in bags for t in bag})
        if not vocabulary:
            continue
        found = search(build(docs, vocabulary, segment, block), bags, k)
        names = spark.createDataFrame([(i, ident) for i, (ident, _) in enumerate(part)],
                                      f"item int, item_id {items.schema[item_col].dataType.simpleString()}")
        named = found.join(F.broadcast(names), "item").select(  # one block of items
            F.col("item_id").alias(item_col), F.col("rank").cast("int").alias("rank"), F.col("id").alias("doc_id"), "score")
        out = named if out is None else out.unionByName(named)
    if out is None:
        ident = items.select(F.col(item_col)).limit(0)
        return ident.withColumns({"rank": F.lit(0), "doc_id": F.lit(0).cast("long"), "score": F.lit(0).cast("long")})
    return out


def op13(spark, sf_dir: str) -> DataFrame:
    """The registered report: the 20 best of all documents for each item of ``benchmark``.

    Null texts have no terms; null ids come last among equal scores; other columns are
    ignored; without documents or items the result is empty.
    """
    prepare(spark)
    return rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
