"""SimHash near-duplicates over a Gray-order hierarchical index.

Fingerprints within ``distance`` bits of each other are linked. Cut into
``distance + 2`` runs of bits, two such fingerprints agree on at least two runs, so
each fingerprint is filed once per pair of runs: the runs' mask is the topmost node of
an index, the value under it the node below. Inside such a bucket the fingerprints are
sorted by Gray rank, which puts codes with few differing bits side by side; neighbours
form leaves, leaves form upper nodes, and each node keeps the pattern of bits all its
codes share. A search goes down pairs of nodes, accumulating the differences of shared
bits: over ``distance``, the whole pair of groups is pruned.

A bucket yields links that span its components, not all pairs. Buckets too large for a
task are cut anew by pairs of runs of the bits that are not fixed yet, which loses no
link, until they are small.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import stage, text_or_empty
from tillwise.llm.components import components

#: Fingerprints a task holds of one bucket; larger buckets are cut by more bits.
BUCKET = 32768
FAN = 8


# -- fingerprints ---------------------------------------------------------------------

def fingerprint(text: bytes, width: int) -> int:
    """64-bit SimHash of the word shingles of a UTF-8 text; no words: 0."""
    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(line, 42)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    n = len(words) - width + 1
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[i:j], 42) for i, j in zip(starts[:n].tolist(), ends[width - 1:].tolist())],
                      dtype=np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 65536):  # bit counts of a stretch at a time, for very long texts
        bits = np.unpackbits(hashes[at:at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, width: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) of every row; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t, width) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(fps, dtype=np.uint64).view(np.int64))], names=["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).cast("binary").alias("text")).mapInArrow(
        run, f"id {kind}, fp long")


# -- routing --------------------------------------------------------------------------

def masks_over(fixed: int, distance: int, bits: int = 64) -> list[int]:
    """Masks that add two of ``distance + 2`` runs of the free bits to ``fixed``."""
    free = [i for i in range(bits) if not fixed >> i & 1]
    runs = [sum(1 << int(i) for i in part) for part in np.array_split(free, distance + 2)]
    return [fixed | a | b for a, b in itertools.combinations(runs, 2)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _file(rows: DataFrame, fixed: list[int], distance: int) -> DataFrame:
    """One row per fingerprint and mask under its present mask."""
    spark = rows.sparkSession
    pairs = sorted({(_signed(m), _signed(x)) for m in fixed for x in masks_over(m, distance)})
    table = F.broadcast(spark.createDataFrame(pairs, "mask long, sub long"))  # 15 rows per mask
    filed = rows.join(table, "mask").select(F.col("sub").alias("mask"), "fp")
    return filed if len(fixed) == 1 else filed.distinct()  # two masks may be widened to the same


def gray_rank(fp: Column) -> Column:
    """Position of a code in Gray order, as a signed number with the same order."""
    for s in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, s))
    return fp.bitwiseXOR(F.lit(-(1 << 63)))


# -- the index inside buckets -----------------------------------------------------------

class _Links:
    """Components of codes 0..n-1, kept as the smallest index reached."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            ra, rb = self.root[a], self.root[b]
            apart = ra != rb
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            lo, hi = np.minimum(ra[apart], rb[apart]), np.maximum(ra[apart], rb[apart])
            np.minimum.at(self.root, hi, lo)
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up


def search(codes: np.ndarray, group: np.ndarray, distance: int, block: int = 1 << 18) -> np.ndarray:
    """Smallest index linked to each code, inside groups of codes in Gray order.

    ``group`` is ascending. Nodes of a level cover up to ``FAN`` nodes of the level below
    in the same group and keep the AND and OR of their codes; bits where these are equal
    are shared.
    """
    n = len(codes)
    levels = [(codes, codes, np.arange(n), np.arange(1, n + 1), group)]
    while True:
        low, high, _, _, g = levels[-1]
        fresh = np.concatenate([[True], g[1:] != g[:-1]])
        start_of = np.maximum.accumulate(np.where(fresh, np.arange(len(g)), 0))
        first = np.flatnonzero((np.arange(len(g)) - start_of) % FAN == 0)
        if len(first) == len(g):
            break
        last = np.append(first[1:], len(g))
        levels.append((np.bitwise_and.reduceat(low, first), np.bitwise_or.reduceat(high, first), first, last, g[first]))
    links = _Links(n)
    # First and last code below each node, to see whether its codes are linked already.
    begin, end = [np.arange(n)], [np.arange(1, n + 1)]
    for _, _, first, last, _ in levels[1:]:
        begin.append(begin[-1][first])
        end.append(end[-1][last - 1])
    tops = np.arange(len(levels[-1][0]))
    stack = [(len(levels) - 1, tops[i:i + block], tops[i:i + block]) for i in range(0, len(tops), block)]
    while stack:
        k, a, b = stack.pop()
        low, high, first, last, _ = levels[k]
        shared = ~(low[a] ^ high[a]) & ~(low[b] ^ high[b])
        near = np.bitwise_count((low[a] ^ low[b]) & shared) <= distance  # differences so far
        a, b = a[near], b[near]
        if k == 0:
            links.add(a, b)
            continue
        # Any two codes below differ in the bits not shared alike, at most: all are linked.
        spread = (low[a] ^ high[a]) | (low[b] ^ high[b]) | (low[a] ^ low[b])
        close = np.bitwise_count(spread) <= distance
        if close.any():
            _join_all(links, begin[k], end[k], a[close], b[close])
            a, b = a[~close], b[~close]
        if len(a) and len(levels) > 2:
            done = _one_component(links, begin[k], end[k], a, b)
            a, b = a[~done], b[~done]
        na, nb = last[a] - first[a], last[b] - first[b]
        size = na * nb
        for lo, hi in _stretches(size, block):
            s = size[lo:hi]
            at = np.arange(s.sum()) - np.repeat(np.cumsum(s) - s, s)
            wide = np.repeat(nb[lo:hi], s)
            x = np.repeat(first[a[lo:hi]], s) + at // wide
            y = np.repeat(first[b[lo:hi]], s) + at % wide
            once = (x < y) if k == 1 else (x <= y)
            stack.append((k - 1, x[once], y[once]))
    return links.root


def _stretches(size: np.ndarray, block: int) -> Iterator[tuple[int, int]]:
    """Cut so that every stretch adds up to about ``block``."""
    if len(size):
        part = np.cumsum(size) // block
        cuts = np.flatnonzero(np.diff(part)) + 1
        yield from zip(np.append(0, cuts).tolist(), np.append(cuts, len(size)).tolist())


def _join_all(links: _Links, begin, end, a, b) -> None:
    for node in np.unique(np.concatenate([a, b])):
        inside = np.arange(begin[node], end[node])
        links.add(inside[1:], np.full(len(inside) - 1, inside[0]))
    links.add(begin[a], begin[b])


def _one_component(links: _Links, begin, end, a, b) -> np.ndarray:
    nodes, back = np.unique(np.concatenate([a, b]), return_inverse=True)
    # begin/end are ascending and disjoint; reduceat needs the gaps between them as well.
    cuts = np.column_stack([begin[nodes], end[nodes]]).ravel()
    padded = np.append(links.root, links.root[-1])
    low, high = np.minimum.reduceat(padded, cuts)[::2], np.maximum.reduceat(padded, cuts)[::2]
    whole = low == high
    ia, ib = back[:len(a)], back[len(a):]
    return whole[ia] & whole[ib] & (low[ia] == low[ib])


def _searcher(distance: int):
    def links(mask: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        value = codes & mask
        fresh = np.concatenate([[True], (mask[1:] != mask[:-1]) | (value[1:] != value[:-1])])
        group = np.cumsum(fresh)
        many = np.bincount(group)[group] > 1
        codes, group = codes[many], group[many]
        if not len(codes):
            return codes, codes
        root = search(codes, group, distance)
        linked = root != np.arange(len(root))
        return codes[linked], codes[root[linked]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.uint64), np.empty(0, np.uint64)]

        def found(rows):
            a, b = links(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            new = [batch.column(i).to_numpy().view(np.uint64) for i in range(2)]
            held = [np.concatenate([h, x]) for h, x in zip(held, new)]
            if len(held[0]) < BUCKET:
                continue
            value = held[0] & held[1]
            differs = (held[0] != held[0][-1]) | (value != value[-1])
            cut = int(np.flatnonzero(differs)[-1]) + 1 if differs.any() else 0  # the last bucket may go on
            if cut:
                yield found([h[:cut] for h in held])
                held = [h[cut:] for h in held]
        if len(held[0]):
            yield found(held)

    return run


def near_links(codes: DataFrame, distance: int = 4, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) that span the components of distinct ``fp`` within ``distance`` bits."""
    spark = codes.sparkSession
    rows = codes.select(F.lit(0).cast("long").alias("mask"), "fp")
    fixed, out = [0], None
    while True:
        filed = _file(rows, fixed, distance).withColumn("value", F.col("fp").bitwiseAND(F.col("mask")))
        large = stage(filed.groupBy("mask", "value").agg(F.count("*").alias("n")).filter(F.col("n") > bucket)
                      .select("mask", "value"))
        hot = [r[0] for r in large.select("mask").distinct().collect()]  # masks, 15 a level at most each
        small = filed.join(large, ["mask", "value"], "left_anti") if hot else filed
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        found = (
            small.repartition(parts, "mask", "value")
            .withColumn("gray", gray_rank(F.col("fp")))
            .sortWithinPartitions("mask", "value", "gray").select("mask", "fp")
            .mapInArrow(_searcher(distance), "a long, b long")
        )
        found = stage(found.distinct())
        out = found if out is None else out.unionByName(found)
        if not hot:
            return out.distinct()
        rows = stage(filed.join(large, ["mask", "value"], "left_semi").select("mask", "fp"))
        fixed = [m & ((1 << 64) - 1) for m in hot]


def grouped(docs: DataFrame, width: int, distance: int, bucket: int, id_col: str, text_col: str):
    """(id, fp) of every row, and (fp, root) of every fingerprint linked to others or not."""
    prints = stage(fingerprints(docs, width, id_col, text_col))
    codes = stage(prints.select("fp").distinct())
    roots = components(near_links(codes, distance, bucket))
    rooted = codes.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    return prints, stage(rooted)


def near_duplicates(docs: DataFrame, width: int = 4, distance: int = 4, bucket: int = BUCKET,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, component) per row; component is the smallest id reachable by links.

    Null and empty texts have the fingerprint zero and link like any other. Rows with a
    null id get their component's smallest id, null if it has none. Repeated rows each
    get their own row; other columns are ignored; an empty table gives an empty result.
    """
    prints, rooted = grouped(docs, width, distance, bucket, id_col, text_col)
    least = prints.groupBy("fp").agg(F.min("id").alias("least"))
    named = stage(least.join(rooted, "fp").groupBy("root").agg(F.min("least").alias("component")))
    by_code = rooted.join(named, "root").select("fp", "component")
    return prints.join(by_code, "fp").select("id", "fp", "component")


def drop_near_duplicates(docs: DataFrame, width: int = 4, distance: int = 4, bucket: int = BUCKET,
                         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group, with all its columns: the smallest id, a null id last.

    Ids that occur with several texts are told apart by a hash of the text; of rows with
    equal id and text, one stays.
    """
    mark = F.xxhash64(id_col, text_col)
    prints, rooted = grouped(docs.withColumn("__key", F.struct(F.col(id_col).alias("id"), mark.alias("h"))),
                             width, distance, bucket, "__key", text_col)
    return keep_first(docs, mark, prints, rooted)


def keep_first(docs: DataFrame, mark: Column, prints: DataFrame, rooted: DataFrame) -> DataFrame:
    """Rows of ``docs`` with the first id of each root.

    ``mark`` is a hash of id and text; ``prints`` has (id as a struct of id and h, fp), ``rooted`` (fp, root).
    """
    first = F.struct(F.col("id.id").isNull().alias("z"), F.col("id.id").alias("id"), F.col("id.h").alias("h"))
    per_code = prints.groupBy("fp").agg(F.min(first).alias("first"))
    kept = per_code.join(rooted, "fp").groupBy("root").agg(F.min("first").alias("first")).select(
        F.col("first.h").alias("__h"))
    copies = prints.groupBy(F.col("id.h").alias("__h")).agg(F.count("*").alias("__n"))
    kept = stage(kept.join(copies, "__h"))
    rows = docs.withColumn("__h", mark)
    # Texts are shuffled once at any size: a list that is broadcast while it is small tells little of a large run.
    single = rows.join(kept.filter("__n = 1").select("__h").hint("merge"), "__h", "left_semi")
    several = rows.join(kept.filter("__n > 1").select("__h"), "__h", "left_semi").dropDuplicates(["__h"])
    return single.unionByName(several).drop("__h")


def op1(docs: DataFrame) -> DataFrame:
    """The registered report: shingles of four words, links at four bits or fewer."""
    return near_duplicates(docs).select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"))
