"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Candidates come from two sources. SimHash codes of the shingles within four bits of each
other, found by the Gray-order index, give groups; that catches copies with few changes,
but only some 4 % of the pairs at just 0.8, whose codes differ in about ten bits. Texts
that agree on one of 20 bands of five MinHash values make up for it: a pair at 0.8 shares
a band with probability 0.9996, more similar ones nearly always. Every candidate pair is
then compared exactly, or else its texts are linked already by compared pairs.
Texts with equal sets of shingles are one node.

Each band value's members are first compared with its smallest member, then with its
largest, then, where it still holds several components, with its central member: the one
whose shingles most of these texts hold, so that the others differ from it about half as
much as from each other. That links a large group of copies without multiplying it. Texts
of such band values are at last compared across components as a similarity of 0.8 allows
at all: two of them share one of the rarest fifth of either one's shingles, and their
numbers of shingles differ by a fifth at most. A passage that many texts share is no such
shingle, unless it is most of the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm import simhash
from tillwise.llm.common import stage, text_or_empty
from tillwise.llm.components import components

WIDTH = 5
#: Least similarity, as a fraction.
LEAST = (4, 5)
BANDS, ROWS = 20, 5
#: Differing bits of SimHash codes that make candidates.
DISTANCE = 4
_RANDOM = np.random.default_rng(42)
_FACTORS = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TERMS = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def shingles(text: bytes) -> np.ndarray:
    """Distinct hashes, ascending, of the shingles of a UTF-8 text; a text of fewer words is one shingle."""
    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    if len(words) <= WIDTH:
        return np.array([xxhash.xxh64_intdigest(line, 42)], np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    n = len(words) - WIDTH + 1
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array(
        [digest(line[i:j], 42) for i, j in zip(starts[:n].tolist(), ends[WIDTH - 1:].tolist())], np.uint64))


def bands(found: np.ndarray) -> list[int]:
    """Band values of a set of shingles, none of an empty set."""
    if not len(found):
        return []
    least = np.full(BANDS * ROWS, np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(found), 512):
        np.minimum(least, (found[at:at + 512, None] * _FACTORS + _TERMS).min(axis=0), out=least)
    return [xxhash.xxh64_intdigest(v.tobytes(), i) for i, v in enumerate(least.reshape(BANDS, ROWS))]


def code(found: np.ndarray) -> int:
    """SimHash of a set of shingles, as a signed number; 0 for none."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(found), 65536):
        bits = np.unpackbits(found[at:at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(found), bitorder="little").view(np.int64)[0])


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return LEAST[1] * both >= LEAST[0] * (len(a) + len(b) - both)


def _signed(values) -> pa.Array:
    return pa.array(np.array(values, dtype=np.uint64).view(np.int64))


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingles(t) for t in batch.column(1).to_pylist()]
        values = [bands(s) for s in sets]
        ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([
            batch.column(0), _signed([xxhash.xxh64_intdigest(s.tobytes(), 42) for s in sets]),
            pa.ListArray.from_arrays(pa.array(ends), _signed([v for row in values for v in row])),
            pa.array([code(s) for s in sets], pa.int64()),
        ], names=["id", "fp", "bands", "code"])


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, known = None, np.empty(0, np.uint64)  # rows come sorted by b
    for batch in batches:
        a, b, text_a, text_b = (batch.column(i) for i in range(4))
        near = np.zeros(len(a), bool)
        for i in range(len(a)):
            if b[i].as_py() != held:
                held, known = b[i].as_py(), shingles(text_b[i].as_py())
            near[i] = alike(shingles(text_a[i].as_py()), known)
        yield pa.RecordBatch.from_arrays([a.filter(pa.array(near)), b.filter(pa.array(near))], names=["a", "b"])


def _pairs(rows: DataFrame, a: str, b: str) -> DataFrame:
    return rows.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).filter("a < b").distinct()


def near_links(nodes: DataFrame, texts_of) -> DataFrame:
    """Links (a, b) that span the components of similar nodes; ``nodes`` has fp and bands.

    ``texts_of`` gives (fp, text) of the nodes in a table with the column fp.
    """
    rows = nodes.select("fp", F.explode("bands").alias("key"))
    ends = rows.groupBy("key").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).filter("low < high")
    rows = stage(rows.join(ends, "key"))
    texts = stage(texts_of(rows.select("fp").distinct()))

    def compare(pairs: DataFrame) -> DataFrame:
        left = texts.select(F.col("fp").alias("a"), F.col("text").alias("text_a"))
        right = texts.select(F.col("fp").alias("b"), F.col("text").alias("text_b"))
        # Texts are shuffled at any size, so a small run tells of a large one.
        both = pairs.hint("merge").join(left, "a").hint("merge").join(right, "b")
        return stage(both.select("a", "b", "text_a", "text_b").mapInArrow(_compared, "a long, b long"))

    def grown(links: DataFrame) -> DataFrame:
        """Links of every node to its root, so that what is linked is not followed anew."""
        return components(links).select(F.col("node").alias("a"), F.col("root").alias("b"))

    def rooted_by(links: DataFrame, some: DataFrame) -> DataFrame:
        roots = links.select(F.col("a").alias("fp"), F.col("b").alias("root"))
        return some.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))

    def mixed(links: DataFrame) -> DataFrame:
        """Members, with their component, of band values that hold several components."""
        rooted = rooted_by(links, rows)
        several = rooted.groupBy("key").agg(F.min("root").alias("r"), F.max("root").alias("s")).filter("r < s")
        return stage(rooted.join(several.select("key"), "key", "left_semi"))

    tried = stage(_pairs(rows, "fp", "low"))
    links = grown(compare(tried))
    left = mixed(links)
    if left.isEmpty():
        return links
    # A pair whose ends are linked already needs no comparison.
    tops = left.groupBy("key").agg(F.max_by("root", "fp").alias("top"))
    pairs = _pairs(left.join(tops, "key").filter("root <> top"), "fp", "high")
    pairs = stage(pairs.join(tried, ["a", "b"], "left_anti"))
    tried, links = tried.unionByName(pairs), grown(links.unionByName(compare(pairs)))
    left = mixed(links)
    if left.isEmpty():
        return links
    central = _common_share(texts, left)
    centres = left.join(central, "fp").groupBy("key").agg(F.max_by(F.struct("fp", "root"), F.struct("share", "fp")).alias("c"))
    pairs = left.join(centres, "key").filter("root <> c.root").select("fp", F.col("c.fp").alias("centre"))
    pairs = stage(_pairs(pairs, "fp", "centre").join(tried, ["a", "b"], "left_anti"))
    tried, links = tried.unionByName(pairs), grown(links.unionByName(compare(pairs)))
    # Texts the centres have linked still take part, with those of other components.
    pairs = _prefix_pairs(texts, stage(rooted_by(links, left.select("fp").distinct())))
    pairs = stage(_pairs(pairs.join(tried, ["a", "b"], "left_anti"), "a", "b"))
    return links.unionByName(compare(pairs))


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingles(t) for t in batch.column(1).to_pylist()]
        ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([
            batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
            pa.ListArray.from_arrays(pa.array(ends), _signed(np.concatenate([np.empty(0, np.uint64), *sets])))],
            names=["fp", "n", "shingles"])


def _shingle_sets(texts: DataFrame, left: DataFrame) -> DataFrame:
    """(fp, n, shingles) of the texts in ``left``."""
    return (texts.join(left.select("fp").distinct(), "fp", "left_semi").select("fp", "text")
            .mapInArrow(_shingled, "fp long, n long, shingles array<long>"))


def _common_share(texts: DataFrame, left: DataFrame) -> DataFrame:
    """(fp, share): by how many of the texts in ``left`` a shingle of the text is held, on average."""
    each = stage(_shingle_sets(texts, left).select("fp", F.explode("shingles").alias("shingle")))
    held = each.groupBy("shingle").agg(F.count("*").alias("held"))
    return each.join(held, "shingle").groupBy("fp").agg((F.sum("held") / F.count("*")).alias("share"))


def _prefix_pairs(texts: DataFrame, left: DataFrame) -> DataFrame:
    """Pairs (a, b) of the texts in ``left`` that may be similar and are not linked; ``left`` has fp and root.

    Every pair at 0.8 or more is among them. Shingles go by how many of these texts hold
    them, rarest first; a text's first fifth and one more stand for it.
    """
    roots = left.select("fp", "root").distinct()
    rows = stage(_shingle_sets(texts, roots))
    each = rows.select("fp", "n", F.explode("shingles").alias("shingle"))
    rare = each.groupBy("shingle").agg(F.count("*").alias("held"))
    first = F.floor(F.col("n") * (LEAST[1] - LEAST[0]) / LEAST[1]).cast("int") + 1
    ranked = each.join(rare, "shingle").groupBy("fp", "n").agg(
        F.sort_array(F.collect_list(F.struct("held", "shingle"))).alias("order"))
    prefix = stage(ranked.select("fp", "n", F.posexplode(F.slice("order", F.lit(1), first)).alias("at", "x"))
                   .filter("x.held > 1").select("fp", "n", "at", F.col("x.shingle").alias("shingle")).join(roots, "fp"))
    a, b = (prefix.select(F.col("fp").alias(s), "shingle", *[F.col(c).alias(f"{c}_{s}") for c in ("n", "at", "root")])
            for s in ("a", "b"))
    near = F.least("n_a", "n_b") * LEAST[1] >= F.greatest("n_a", "n_b") * LEAST[0]
    # Shingles the two must share; one of them comes before either has too few left.
    both = F.ceil((F.col("n_a") + F.col("n_b")) * LEAST[0] / (LEAST[0] + LEAST[1]))
    early = (F.col("at_a") <= F.col("n_a") - both) & (F.col("at_b") <= F.col("n_b") - both)
    return a.join(b, "shingle").filter(
        (F.col("a") < F.col("b")) & (F.col("root_a") != F.col("root_b")) & near & early).select("a", "b").distinct()


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group linked by similar pairs, with all its columns: the smallest id, a null id last.

    Texts without words are alike and unlike any other; a null text counts as empty.
    Ids that occur with several texts are told apart by a hash of the text; of rows with
    equal id and text, one stays.
    """
    mark = F.xxhash64(id_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    prints = stage(docs.select(F.struct(F.col(id_col).alias("id"), mark.alias("h")).alias("id"),
                               text_or_empty(text_col).cast("binary").alias("text"))
                   .mapInArrow(_banded, f"id struct<id:{kind},h:bigint>, fp long, bands array<long>, code long"))
    nodes = stage(prints.groupBy("fp").agg(F.min("id.h").alias("h"), F.first("bands").alias("bands"),
                                           F.first("code").alias("code")))
    groups = components(simhash.near_links(stage(nodes.filter(F.size("bands") > 0).select(F.col("code").alias("fp")).distinct()),
                                           DISTANCE)).select(F.col("node").alias("code"), "root")
    # Equal codes are a group as well; texts without shingles have none.
    group = F.xxhash64(F.lit("simhash"), F.coalesce("root", "code"))
    nodes = stage(nodes.join(groups, "code", "left").select("fp", "h", F.when(F.size("bands") > 0, F.concat(
        F.array(group), "bands")).otherwise(F.col("bands")).alias("bands")))

    def texts_of(some: DataFrame) -> DataFrame:
        wanted = nodes.select("fp", "h").join(some, "fp")
        texts = docs.select(mark.alias("h"), text_or_empty(text_col).cast("binary").alias("text"))
        return texts.join(wanted.hint("merge"), "h").dropDuplicates(["h"]).select("fp", "text")

    roots = components(near_links(nodes, texts_of)).select(F.col("node").alias("fp"), "root")
    rooted = stage(nodes.select("fp").join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    return simhash.keep_first(docs, mark, prints, rooted)
