"""Spelling variants: words one edit apart, found by k-d trees over letter-count vectors.

One edit moves a word's letter counts by an L1 distance of two at most. A replaced letter
takes one from one count and adds one to another; an inserted letter adds one. So, for
each pair of lengths (n, n) and (n, n + 1), partners lie in a small box around a word.

Words of one length are cut by a k-d tree over their counts. Its upper part is fitted on
a bounded sample of words and only deals out the work: every word goes to its own leaf as
a member and, as a query, to each other leaf whose box it can reach. Inside a leaf a tree
of tight boxes prunes the members, and the letters of what is left are compared in order.
Each leaf counts for itself, so a word's partners are never gathered in one place.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import stage, text_or_empty

#: Shortest word, least occurrences, how much more frequent a form is, and one run in how many is misspelt.
LEAST_LENGTH, LEAST_COUNT, TIMES, EVERY = 7, 2, 10, 31
#: Words of a leaf the upper tree aims at; words of the sample it is fitted on, at most.
LEAF, SAMPLE = 8192, 200_000
#: Members below which boxes are not cut further.
FEW = 24
_LETTERS = [*range(0x61, 0x7B), *range(0xC0, 0x100)]
_SLOT = np.full(0x100, -1)
_SLOT[_LETTERS] = np.arange(len(_LETTERS))
DIMS = len(_LETTERS)
_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


# -- words -------------------------------------------------------------------------------

def words_of(ident: str, text: str, pattern: re.Pattern) -> Counter:
    """Words of a document with their counts, one run in 31 less one letter as the hash says."""
    out: Counter = Counter()
    runs = pattern.findall(text.lower() if text.isascii() else text.translate(_LOWER))
    start = zlib.crc32(f"{ident}:".encode())
    for run, n in Counter(runs).items():
        h = zlib.crc32(run.encode(), start)
        if h % EVERY == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < LEAST_LENGTH:
                continue
        out[run] += n
    return out


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of all words long and frequent enough."""
    # Runs too short to be words are never taken out: a match starts where its run starts.
    pattern = re.compile(f"[A-Za-zÀ-ÿ]{{{LEAST_LENGTH},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                              names=["word", "n"])

        for batch in batches:
            for ident, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for word, n in words_of(ident, text, pattern).items():
                    held[word] += n
                if len(held) > 500_000:
                    yield rows()
                    held.clear()
        if held:
            yield rows()

    ident = F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id")
    counted = docs.select(ident, text_or_empty(text_col).alias("text")).mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


# -- vectors and trees ---------------------------------------------------------------------

def letters(words: list[str], length: int) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-16-le"), np.uint16).reshape(len(words), length)


def counts(codes: np.ndarray) -> np.ndarray:
    out = np.zeros((len(codes), DIMS), np.int32)
    rows = np.arange(len(codes))
    for column in codes.T:
        np.add.at(out, (rows, _SLOT[column]), 1)
    return out


@dataclass
class Tree:
    """Upper part of a k-d tree: (dimension, bound, left, right) by node, None at leaves."""

    cuts: list[tuple[int, int, int, int] | None]

    def reached(self, vectors: np.ndarray, less: int, more: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of leaves that may hold vectors ``more`` above in all and ``less`` below in all, at most.

        Going down, each row carries how far its box lies above and below it so far.
        """
        found, none = [], np.zeros(len(vectors), np.int64)
        stack = [(0, np.arange(len(vectors)), none, none, {}, {})]
        while stack:
            i, rows, up, down, low, high = stack.pop()
            if not len(rows):
                continue
            if self.cuts[i] is None:
                found.append((rows, np.full(len(rows), i)))
                continue
            d, bound, left, right = self.cuts[i]
            v = vectors[rows, d]
            far = down + np.maximum(v - bound, 0) - np.maximum(v - high.get(d, v), 0)
            keep = far <= less
            stack.append((left, rows[keep], up[keep], far[keep], low, {**high, d: bound}))
            far = up + np.maximum(bound + 1 - v, 0) - np.maximum(low.get(d, v) - v, 0)
            keep = far <= more
            stack.append((right, rows[keep], far[keep], down[keep], {**low, d: bound + 1}, high))
        row, leaf = zip(*found) if found else ([none[:0]], [none[:0]])
        return np.concatenate(row), np.concatenate(leaf)

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        row, leaf = self.reached(vectors, 0, 0)
        out = np.empty(len(vectors), np.int64)
        out[row] = leaf
        return out


def in_reach(vectors: np.ndarray, low: np.ndarray, high: np.ndarray, less: int) -> np.ndarray:
    up = np.maximum(low - vectors, 0).sum(axis=1)
    down = np.maximum(vectors - high, 0).sum(axis=1)
    return (up <= 1) & (down <= less)


def best_cut(vectors: np.ndarray) -> tuple[int, int] | None:
    """The dimension and bound that halve the vectors best; None if all are equal."""
    best, cut = 0, None
    for d in np.flatnonzero(vectors.max(axis=0) != vectors.min(axis=0)):
        below = np.cumsum(np.bincount(vectors[:, d]))[:-1]
        smaller = np.minimum(below, len(vectors) - below)
        at = int(smaller.argmax())
        if smaller[at] > best:
            best, cut = int(smaller[at]), (int(d), at)
    return cut


def fit(sample: np.ndarray, leaves: int) -> Tree:
    """A tree whose leaves hold the sample's ``leaves``-th part at most, but for equal vectors.

    Leaves are open outwards, so words the sample lacks have a leaf as well.
    """
    cuts: list[tuple[int, int, int, int] | None] = [None]
    stack = [(0, sample)]
    while stack:
        i, rows = stack.pop()
        cut = best_cut(rows) if len(rows) * leaves > len(sample) else None
        if cut is not None:
            cuts[i] = (*cut, len(cuts), len(cuts) + 1)
            right = rows[:, cut[0]] > cut[1]
            stack += [(len(cuts), rows[~right]), (len(cuts) + 1, rows[right])]
            cuts += [None, None]
    return Tree(cuts)


def search(members: np.ndarray, queries: np.ndarray, less: int, block: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (member, query) whose vectors may be one edit apart, by descent through tight boxes, about ``block`` at a time."""
    stack = [(np.arange(len(members)), np.arange(len(queries)))]
    while stack:
        m, q = stack.pop()
        inside = members[m]
        q = q[in_reach(queries[q], inside.min(axis=0), inside.max(axis=0), less)]
        if not len(q):
            continue
        cut = best_cut(inside) if len(m) > FEW else None
        if cut is None:
            step = max(1, block // len(m))
            for at in range(0, len(q), step):
                part = q[at:at + step]
                yield np.tile(m, len(part)), np.repeat(part, len(m))
        else:
            right = inside[:, cut[0]] > cut[1]
            stack += [(m[~right], q), (m[right], q)]


def replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows that differ in exactly one letter."""
    return (a != b).sum(axis=1) == 1


def inserted(longer: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Rows where one letter more makes the shorter the longer: equal ends cover the shorter."""
    n = shorter.shape[1]
    head = np.cumprod(longer[:, :n] == shorter, axis=1).sum(axis=1)
    tail = np.cumprod((longer[:, 1:] == shorter)[:, ::-1], axis=1).sum(axis=1)
    return head + tail >= n


# -- joins ---------------------------------------------------------------------------------

#: Partial result of a leaf: near words of a word, and the most frequent of them, ties to the smallest.
_PARTIAL = "word string, k long, top struct<less:long,word:string>"


def _dealt(trees: dict[int, Tree]):
    """Rows (length, leaf, kind, word, n): members (0), queries of equal (1) and of smaller length (2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, n = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            sizes = np.array([len(w) for w in words])
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                vectors = counts(letters([words[i] for i in at], int(size)))
                tree = trees[int(size)]
                own = tree.leaf_of(vectors)
                parts = [(size, own, np.zeros(len(at)), np.arange(len(at)))]
                row, leaf = tree.reached(vectors, 1)
                other = leaf > own[row]  # a pair of leaves meets once
                parts.append((size, leaf[other], np.ones(other.sum()), row[other]))
                if size + 1 in trees:
                    row, leaf = trees[size + 1].reached(vectors, 0)
                    parts.append((size + 1, leaf, np.full(len(row), 2), row))
                for length, leaves, kind, rows in parts:
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(rows), length, np.int32)), pa.array(leaves),
                        pa.array(kind.astype(np.int32)), pa.array([words[i] for i in at[rows]], pa.string()),
                        pa.array(n[at[rows]], pa.int64()),
                    ], names=["length", "leaf", "kind", "word", "n"])

    return run


def _found(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Near pairs (row, row) of one leaf's rows."""
    kind = table.column("kind").to_numpy()
    length = table.column("length")[0].as_py()
    words = table.column("word").to_pylist()
    members = np.flatnonzero(kind == 0)
    if not len(members):
        return
    codes = letters([words[i] for i in members], length)
    vectors = counts(codes)
    for which, less in ((1, 1), (2, 0)):
        rows = np.flatnonzero(kind == which)
        if which == 1:  # members search one another as well
            rows = np.concatenate([members, rows])
        if not len(rows):
            continue
        asked = letters([words[i] for i in rows], length - (which == 2))
        used = np.flatnonzero(vectors.any(axis=0) | counts(asked).any(axis=0))
        for m, q in search(vectors[:, used], counts(asked)[:, used], less, (1 << 22) // length + 1):
            if which == 1:
                once = (q >= len(members)) | (m < q)
                m, q = m[once], q[once]
                near = replaced(codes[m], asked[q])
            else:
                near = inserted(codes[m], asked[q])
            if near.any():
                yield members[m[near]], rows[q[near]]


def _joined(table: pa.Table) -> pa.Table:
    words, n = np.array(table.column("word").to_pylist(), object), table.column("n").to_numpy()
    order = np.empty(len(words), np.int64)
    order[np.argsort(words, kind="stable")] = np.arange(len(words))  # code-point order
    near, top = np.zeros(len(words), np.int64), np.full(len(words), -1)
    for a, b in _found(table):
        for x, y in ((a, b), (b, a)):
            near += np.bincount(x, minlength=len(words))
            best = np.lexsort((order[y], -n[y], x))
            first = best[np.concatenate([[True], x[best][1:] != x[best][:-1]])]
            x, y = x[first], y[first]
            old = top[x]
            better = (old < 0) | (n[y] > n[old]) | ((n[y] == n[old]) & (order[y] < order[old]))
            top[x[better]] = y[better]
    at = np.flatnonzero(near)
    return pa.table({
        "word": pa.array(words[at].tolist(), pa.string()), "k": pa.array(near[at]),
        "top": pa.StructArray.from_arrays([pa.array(-n[top[at]]), pa.array(words[top[at]].tolist(), pa.string())],
                                          names=["less", "word"])})


def upper_trees(words: DataFrame, leaf: int = LEAF, sample: int = SAMPLE) -> dict[int, Tree]:
    """A tree per length, fitted on at most about ``sample`` words drawn by their hash.

    One row per length comes to the driver with the sample; lengths of the sample alone
    decide nothing, as every length that occurs gets a tree.
    """
    sizes = {r[0]: r[1] for r in words.groupBy(F.char_length("word")).agg(F.count("*")).collect()}
    share = max(1, -(-sum(sizes.values()) // sample))
    drawn = words.filter(F.pmod(F.xxhash64("word"), F.lit(share)) == 0).select("word").toArrow()
    by_size: dict[int, list[str]] = {}
    for w in drawn.column(0).to_pylist():
        by_size.setdefault(len(w), []).append(w)
    return {size: fit(counts(letters(by_size.get(size, []), size)), -(-n // leaf)) for size, n in sizes.items()}


def near_words(words: DataFrame, leaf: int = LEAF, sample: int = SAMPLE) -> DataFrame:
    """(word, n_near, top_word, top_n) of every word of (word, n) with a word one edit away."""
    trees = upper_trees(words, leaf, sample)
    dealt = words.select("word", "n").mapInArrow(_dealt(trees), "length int, leaf long, kind int, word string, n long")
    partial = dealt.groupBy("length", "leaf").applyInArrow(_joined, _PARTIAL)
    return partial.groupBy("word").agg(F.sum("k").alias("n_near"), F.min("top").alias("top")).select(
        "word", "n_near", F.col("top.word").alias("top_word"), (-F.col("top.less")).alias("top_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) where forms (word, form) lead at last; each round doubles the steps taken.

    A form is at least ten times as frequent, so chains are short and have no cycle.
    """
    ends = stage(forms.select("word", F.col("form").alias("root")))
    while True:
        on = ends.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = stage(ends.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                             F.col("next").isNotNull().alias("moved")))
        ends = further.select("word", "root")
        if further.filter("moved").isEmpty():
            return ends


def variants(words: DataFrame, leaf: int = LEAF, sample: int = SAMPLE) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of a table (word, n) of distinct words.

    A word's form is its most frequent near word, the smallest of equals, if at least ten
    times as frequent; its root is where forms lead from it. An empty table gives none.
    """
    words = stage(words)
    if words.isEmpty():
        none = F.lit(None)
        return words.select("word", "n", F.lit(0).cast("long").alias("n_near"), none.cast("string").alias("form"),
                            none.cast("long").alias("form_n"), F.col("word").alias("root"))
    near = words.join(near_words(words, leaf, sample), "word", "left")
    has = F.col("top_n") >= TIMES * F.col("n")
    formed = stage(near.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                               F.when(has, F.col("top_word")).alias("form"), F.when(has, F.col("top_n")).alias("form_n")))
    ends = roots(formed.filter("form IS NOT NULL"))
    return formed.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op12(docs: DataFrame) -> DataFrame:
    """The registered report over whole texts.

    A null text has no words, a null id hashes like the empty text; repeated rows count
    each time; other columns are ignored; an empty table gives an empty result.
    """
    return variants(vocabulary(docs)).select("word", "form", "root", "n", "n_near", "form_n")
