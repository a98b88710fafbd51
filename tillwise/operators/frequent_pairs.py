"""Frequent pairs by support: pairs of items that meet in at least ``support`` baskets.

Items in fewer baskets than the support go first, since no pair of theirs can reach it.
Then every pair of a basket is hashed to one of a fixed number of slots and the slots are
counted, without a row per pair; a slot below the support holds no frequent pair, and the
others are a bitmap of bounded size that goes to every task. Only pairs whose slot is set
become rows and are counted exactly, so pairs that meet rarely are never emitted.

A large basket is cut into parts of a bounded number of items, and parts are paired, so
its pairs are spread over many rows and tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.session import cut_lineage

#: Slots of the filter, a power of two: a task counts in eight bytes each, the bitmap takes one.
SLOTS = 1 << 20
#: Items of a basket's part.
PART = 256
#: Pairs made at a time.
STEP = 1 << 20


def frequent_items(baskets: DataFrame, support: int, basket: str, item: str) -> tuple[DataFrame, DataFrame]:
    """Distinct (basket, id) of items in at least ``support`` baskets, and (id, item); nulls are left out."""
    lines = baskets.select(F.col(basket).alias("basket"), F.col(item).alias("item")).dropna().distinct()
    lines = cut_lineage(baskets.sparkSession, lines)
    often = lines.groupBy("item").agg(F.count("*").alias("n")).filter(F.col("n") >= support)
    names = cut_lineage(baskets.sparkSession, often.select("item", F.monotonically_increasing_id().alias("id")))
    return lines.join(names, "item").select("basket", "id"), names


def meetings(lines: DataFrame, part: int = PART) -> DataFrame:
    """(items, others): parts of one basket whose items meet; a part meets itself as well.

    A basket of k items gives about (k / part) squared halves of rows, and one where it
    fits into a part.
    """
    size = F.count("*").over(Window.partitionBy("basket"))  # counting and cutting share one shuffle
    dealt = lines.withColumn("parts", F.ceil(size / part).cast("int")).withColumn(
        "part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    parts = cut_lineage(lines.sparkSession, dealt.groupBy("basket", "part", "parts").agg(F.collect_list("id").alias("items")))
    a = parts.select("basket", F.col("part").alias("p"), "items").filter(F.col("parts") > 1)
    b = parts.select("basket", F.col("part").alias("q"), F.col("items").alias("others")).filter(F.col("parts") > 1)
    none = F.array().cast("array<long>").alias("others")
    return parts.filter(F.size("items") > 1).select("items", none).unionByName(
        a.join(b, "basket").filter("p < q").select("items", "others"))


def _starts(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of all lists, where each list starts, and its length."""
    ends = lists.offsets.to_numpy()
    return lists.values.to_numpy(), ends[:-1], np.diff(ends)


def _pairs(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (smaller, larger) of all rows, rows of the same lengths together, about ``STEP`` pairs at a time."""
    x, at_x, n_x = _starts(batch.column(0))
    y, at_y, n_y = _starts(batch.column(1))
    order = np.lexsort((n_y, n_x))
    edges = np.flatnonzero((np.diff(n_x[order]) != 0) | (np.diff(n_y[order]) != 0)) + 1
    for rows in np.split(order, edges) if len(order) else ():
        k, m = int(n_x[rows[0]]), int(n_y[rows[0]])
        i, j = (np.repeat(np.arange(k), m), np.tile(np.arange(m), k)) if m else np.triu_indices(k, 1)
        if not len(i):
            continue
        step = max(1, STEP // len(i))
        for some in (rows[s:s + step] for s in range(0, len(rows), step)):
            a = x[at_x[some][:, None] + i].ravel()
            b = (y[at_y[some][:, None] + j] if m else x[at_x[some][:, None] + j]).ravel()
            yield np.minimum(a, b), np.maximum(a, b)


def _slot(a: np.ndarray, b: np.ndarray, slots: int) -> np.ndarray:
    h = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((h ^ (h >> np.uint64(32))) & np.uint64(slots - 1)).astype(np.int64)


def slot_counts(met: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(slot, n): how many pairs of baskets fall into each slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(slots, np.int64)
        for batch in batches:
            for a, b in _pairs(batch):
                np.add.at(count, _slot(a, b, slots), 1)
        at = np.flatnonzero(count)
        for i in range(0, len(at), 1 << 16):
            part = at[i:i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(count[part])], names=["slot", "n"])

    return met.mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))


def emitted(met: DataFrame, full: np.ndarray) -> DataFrame:
    """(a, b, n): pairs in set slots, counted within a step of a batch."""
    slots = len(full)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in _pairs(batch):
                keep = full[_slot(a, b, slots)]
                # Ids by their place among those of the step, so a pair is one number.
                ids, place = np.unique(np.concatenate([a[keep], b[keep]]), return_inverse=True)
                first, second = place.reshape(2, -1)
                each, n = np.unique(first * len(ids) + second, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[each // max(1, len(ids))]), pa.array(ids[each % max(1, len(ids))]), pa.array(n)],
                    names=["a", "b", "n"])

    return met.mapInArrow(run, "a long, b long, n long")


def frequent_pairs(baskets: DataFrame, support: int, basket: str, item: str,
                   slots: int = SLOTS, part: int = PART) -> DataFrame:
    """(a, b, n) of pairs of items a < b that share at least ``support`` baskets, n of them.

    Repeated lines count once; a support of 1 returns every pair that met, as asked.
    """
    lines, names = frequent_items(baskets, support, basket, item)
    met = cut_lineage(baskets.sparkSession, meetings(lines, part))
    full = np.ones(slots, bool)
    if support > 1:
        full[:] = False
        often = slot_counts(met, slots).filter(F.col("n") >= support).select("slot").toArrow()  # ``slots`` rows at most
        full[often.column(0).to_numpy()] = True
    counted = emitted(met, full).groupBy("a", "b").agg(F.sum("n").alias("n")).filter(F.col("n") >= support)
    named = counted.join(names.select(F.col("id").alias("a"), F.col("item").alias("x")), "a").join(
        names.select(F.col("id").alias("b"), F.col("item").alias("y")), "b")
    return named.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "n")
