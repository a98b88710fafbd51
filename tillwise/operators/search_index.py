"""A search index kept fresh: immutable segments with tombstones, merged by tiers.

Changes come as batches of (sequence, operation, document). Each batch is written as one
segment of postings and never touched again. A row of an older segment that the batch
changes or deletes is buried: the batch's segment lists its key and segment. Statistics
(live documents, their words, documents per term) are kept as sums to which each batch adds
its own rows and from which it takes those it buries. When a tier holds ``fan`` segments
they are merged without buried rows, so a document is rewritten as often as the logarithm
of the number of batches.

A search reads the query terms' postings only: postings are sorted by term, so Parquet skips
other row groups. Each segment bounds the score of its documents by the largest count and
the shortest text it stored per term. Segments are visited best bound first; those whose
bound is below the k-th score found so far are skipped.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.functions.semantics import first_per_key
from tillwise.operators.text import BM25_B, BM25_K1, by_term, exploded, postings_of, query_words, term_counts, words
from tillwise.sources.files import cuts, read_current, remove, write_version

#: Segments of a tier before they are merged.
FAN = 4
_SEGMENT = ("number", "tier")
_STATE = "number long, segments array<struct<number:long,tier:int>>, docs long, filled long, words long"


class SegmentedIndex:
    """An index below one folder: ``segments/<number>/{postings,documents,terms,buried}`` and a log of versions.

    ``key`` names the document's key, ``text`` its text column. Readers take the newest
    version of the log, so a batch or a merge appears at once or not at all.
    """

    def __init__(self, spark: SparkSession, root: str, key: str, text: str, fan: int = FAN):
        self.spark, self.root, self.key, self.text, self.fan = spark, root, key, text, fan

    # -- state --------------------------------------------------------------------------

    def state(self) -> dict:
        """The newest version: a few sums, and number and tier of each segment."""
        newest = read_current(self.spark, f"{self.root}/log")
        if newest is None:
            return {"number": 0, "segments": [], "docs": 0, "filled": 0, "words": 0}
        row = newest.first()
        return {**row.asDict(), "segments": [s.asDict() for s in row["segments"]]}

    def _commit(self, **state) -> None:
        row = (state["number"], [tuple(s[c] for c in _SEGMENT) for s in state["segments"]],
               state["docs"], state["filled"], state["words"])
        write_version(self.spark.createDataFrame([row], _STATE), f"{self.root}/log")

    def _table(self, name: str, segments: Sequence[dict]) -> DataFrame:
        """A table of several segments, with the segment's number as ``seg``."""
        parts = None
        for s in segments:
            part = self.spark.read.parquet(f"{self.root}/segments/{s['number']}/{name}").withColumn(
                "seg", F.lit(s["number"]).cast("long"))
            parts = part if parts is None else parts.unionByName(part)
        return parts

    def _live(self, rows: DataFrame, segments: Sequence[dict]) -> DataFrame:
        """``rows`` (with key and seg) that no segment has buried."""
        buried = self._table("buried", segments).select(self.key, F.col("in_seg").alias("seg"))
        return rows.join(buried, [self.key, "seg"], "left_anti")

    # -- writing ---------------------------------------------------------------------------

    def _write(self, number: int, documents: DataFrame, postings: DataFrame, buried: DataFrame, rows: int) -> None:
        """Write a segment of ``rows`` postings at most."""
        path = f"{self.root}/segments/{number}"
        buried.write.mode("overwrite").parquet(f"{path}/buried")
        documents.repartitionByRange(self.key).sortWithinPartitions(self.key).write.mode("overwrite").parquet(
            f"{path}/documents")
        by_term(postings, self.key, rows).sortWithinPartitions("term", self.key).write.mode(
            "overwrite").option("parquet.block.size", str(8 << 20)).parquet(f"{path}/postings")
        stored = self.spark.read.parquet(f"{path}/postings")
        stored.groupBy("term").agg(F.max("tf").alias("max_tf"), F.min("length").alias("min_length")).repartitionByRange(
            "term").sortWithinPartitions("term").write.mode("overwrite").parquet(f"{path}/terms")

    @staticmethod
    def _sums(documents: DataFrame) -> tuple[int, int, int]:
        return tuple(documents.agg(F.count("*"), F.count_if(F.col("length") > 0),
                                   F.coalesce(F.sum("length"), F.lit(0))).first())

    def apply(self, changes: DataFrame, sequence: str = "seq", op: str = "op") -> None:
        """Take in a batch: of several changes of a key the last by ``sequence`` counts; ``DELETE`` removes.

        Any other operation inserts or replaces. Null keys are left out, a null text is
        empty. The same batch again changes nothing. Work follows the batch, but for a scan
        of older keys in the batch's range and for merges that fall due.
        """
        state = self.state()
        number, older = state["number"] + 1, state["segments"]
        last = first_per_key(changes.filter(F.col(self.key).isNotNull()), [self.key],
                             [F.desc(sequence), F.desc(op), F.desc(self.text)])
        gone_op = F.coalesce(F.col(op), F.lit("")) == "DELETE"
        with cuts(self.spark) as cut:
            # The batch's texts are shuffled and cut once; what follows reads the written table.
            last = cut(term_counts(last.select(self.key, gone_op.alias("gone"), words(
                F.when(gone_op, F.lit("")).otherwise(F.coalesce(F.col(self.text), F.lit("")))).alias("w")), "w"))
            kept = last.filter(~F.col("gone"))
            gone = last.select(self.key, F.lit(0).cast("long").alias("in_seg"), F.lit(0).cast("long").alias("length")).limit(0)
            if older:
                low, high = last.agg(F.min(self.key), F.max(self.key)).first()
                near = self._table("documents", older).filter(F.col(self.key).between(F.lit(low), F.lit(high)))
                gone = self._live(near.join(last.select(self.key), self.key, "left_semi"), older).select(
                    self.key, F.col("seg").alias("in_seg"), "length")
            self._write(number, kept.select(self.key, "length"), exploded(kept, self.key), gone,
                        postings_of(kept))
        path = f"{self.root}/segments/{number}"
        added, taken = (self._sums(self.spark.read.parquet(f"{path}/{t}")) for t in ("documents", "buried"))
        sums = {c: state[c] + a - b for c, a, b in zip(("docs", "filled", "words"), added, taken)}
        self._commit(number=number, segments=[*older, {"number": number, "tier": 0}], **sums)
        self._merge()

    def _merge(self) -> None:
        """Merge the segments of a tier that holds ``fan`` of them, until none does."""
        while True:
            state = self.state()
            segments = state["segments"]
            tiers = {t: [s for s in segments if s["tier"] == t] for t in {s["tier"] for s in segments}}
            run = next((tiers[t] for t in sorted(tiers) if len(tiers[t]) >= self.fan), None)
            if run is None:
                return
            number = state["number"] + 1
            rest = [s for s in segments if s not in run]
            documents = self._live(self._table("documents", run), segments).drop("seg")
            postings = self._live(self._table("postings", run), segments).drop("seg")
            # What these segments have buried in others stays buried; the rest is gone for good.
            buried = self._table("buried", run).drop("seg").filter(F.col("in_seg").isin([s["number"] for s in rest]))
            self._write(number, documents, postings, buried, self._table("postings", run).count())
            merged = {"number": number, "tier": run[0]["tier"] + 1}
            self._commit(**{**state, "number": number, "segments": [*rest, merged]})

    def vacuum(self) -> list[int]:
        """Remove segments the newest version does not list; readers of older versions must be done."""
        state = self.state()
        listed = {s["number"] for s in state["segments"]}
        gone = [n for n in range(1, state["number"] + 1) if n not in listed]
        for n in gone:
            remove(self.spark, f"{self.root}/segments/{n}")
        return gone

    # -- reading ------------------------------------------------------------------------------

    def hits(self, terms: Sequence[str], picked: Sequence[dict], segments: Sequence[dict]) -> DataFrame:
        """Live postings of the terms in the picked segments: (term, key, length, tf)."""
        return self._live(self._table("postings", picked).filter(F.col("term").isin(*terms)), segments).drop("seg")

    def _bounds(self, segments: Sequence[dict], idf: dict[str, float], average: float) -> dict[int, float]:
        """Largest score a document of each segment can have; buried rows only loosen it."""
        rows = self._table("terms", segments).filter(F.col("term").isin(*idf))
        best = _part(idf, F.col("max_tf"), F.col("min_length"), average)
        return {r["seg"]: r["b"] for r in rows.groupBy("seg").agg(F.sum(best).alias("b")).collect()}

    def search(self, q: str, limit: int = 5) -> tuple[DataFrame, list[int]]:
        """(key, score) of the best live documents by BM25, ties to the smaller key, and the segments scored."""
        state = self.state()
        segments = state["segments"]
        terms = query_words(self.spark, q)
        if not segments or not terms or not state["filled"]:
            key = self._table("documents", segments).select(self.key) if segments else self.spark.createDataFrame(
                [], f"`{self.key}` long")
            return key.limit(0).withColumn("score", F.lit(0.0)), []
        average = state["words"] / state["filled"]
        found = self.hits(terms, segments, segments).groupBy("term").agg(F.count("*").alias("df")).collect()
        df = {r["term"]: r["df"] for r in found}  # one row per query word
        idf = {t: math.log(1 + (state["docs"] - n + 0.5) / (n + 0.5)) for t, n in df.items()}
        bound = self._bounds(segments, idf, average) if idf else {}
        order = sorted((s for s in segments if s["number"] in bound), key=lambda s: -bound[s["number"]])
        scored, read = self._table("documents", segments).select(self.key).limit(0).withColumn("score", F.lit(0.0)), []
        while order:
            # The best segment alone gives a threshold, then twice as many each time.
            step, order = order[:max(1, len(read))], order[max(1, len(read)):]
            score = F.round(F.sum(_part(idf, F.col("tf"), F.col("length"), average)), 6).alias("score")
            scored = scored.unionByName(self.hits(list(idf), step, segments).groupBy(self.key).agg(score))
            read += [s["number"] for s in step]
            if order:
                best = scored.orderBy(F.desc("score"), F.asc(self.key)).limit(limit).collect()
                if len(best) == limit:  # rounding lifts a score by half a millionth at most
                    order = [s for s in order if bound[s["number"]] + 1e-6 >= best[-1]["score"]]
        return scored.orderBy(F.desc("score"), F.asc(self.key)).limit(limit), read


def _part(idf: dict[str, float], tf: Column, length: Column, average: float) -> Column:
    """What a term adds to a score; it grows with the count and falls with the length."""
    weight: Column = F.lit(0.0)
    for t, w in idf.items():
        weight = F.when(F.col("term") == t, F.lit(w)).otherwise(weight)
    norm = F.lit(1 - BM25_B) + F.lit(BM25_B) * length / F.lit(average)
    return weight * tf * F.lit(BM25_K1 + 1) / (tf + F.lit(BM25_K1) * norm)
