"""Toxicity by class-conditional Kneser-Ney models of words' letters.

A word is spelled letter by letter, each given up to four letters before it in the word.
The counts of the longest context are kept per class, toxic and ordinary; what a class
has not seen backs off to continuation counts that both classes share, so rare
expressions are judged alike by both. The difference of a word's two log-likelihoods says
which class it speaks for. Differences are taken per word, so long texts weigh no more
than short ones: their mean, the largest, the mean of the three largest and the logarithm
of the number of words go through a logistic curve. It is fitted crosswise: each labelled
row is seen by a model that has not learned from it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import stage, table, text_or_empty

#: Labelled rows the model is fitted on, at most; the lowest hashes of the ids are taken.
MOST_TOXIC = 6000
MOST_ORDINARY = 9000
ORDER = 5
DISCOUNT = 0.75
#: Words whose difference a task remembers.
CACHE = 300_000
#: Parts of the labelled rows for the crosswise fit.
PARTS = 3
NAMES = ("__mean", "__most", "__top", "__length")
_BITS = 12
_START, _END = 1, 2


def letters(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all words with start and end marks: symbol, place in its word, word number."""
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    stop = np.cumsum(size)
    start = stop - size
    code = np.empty(int(stop[-1]), np.int64)
    inner = np.ones(len(code), bool)
    inner[start] = inner[stop - 1] = False
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
    code[inner] = 3 + points % ((1 << _BITS) - 3)
    code[start], code[stop - 1] = _START, _END
    return code, np.arange(len(code)) - np.repeat(start, size), np.repeat(np.arange(len(words)), size)


def grams(code: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    """Key of the last ``n`` symbols at each place, fewer at a word's start."""
    key = code.copy()
    for back in range(1, n):
        before = np.zeros_like(code)
        before[back:] = code[:-back]
        key |= np.where(place >= back, before, 0) << (_BITS * back)
    return key


def _cut(keys: np.ndarray, n: int) -> np.ndarray:
    return keys & ((1 << (_BITS * n)) - 1)


class _Table:
    """Sums by key."""

    def __init__(self, keys: np.ndarray, *values: np.ndarray):
        self.keys, at = np.unique(keys, return_inverse=True)
        self.values = [np.bincount(at, weights=v, minlength=len(self.keys)) for v in values]

    def get(self, keys: np.ndarray) -> list[np.ndarray]:
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = self.keys[at] == keys
        return [np.where(hit, v[at], 0.0) for v in self.values]


class Model:
    """Differences of log-likelihood from counts of the longest grams per class."""

    def __init__(self, keys: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray):
        self.top = _Table(keys, toxic, ordinary)
        keys, (toxic, ordinary) = self.top.keys, self.top.values
        self.context = _Table(keys >> _BITS, toxic, ordinary, toxic > 0, ordinary > 0)
        # Continuation counts: in how many grams one symbol longer a gram occurs.
        self.shared = []
        longer = keys
        for n in range(ORDER - 1, 0, -1):
            full = np.unique(longer[longer >> (_BITS * n) > 0])
            count = _Table(_cut(full, n), np.ones(len(full)))
            above = _Table(count.keys >> _BITS, count.values[0], np.ones(len(count.keys)))
            self.shared.insert(0, (count, above))
            # Grams of n symbols: endings of the longer ones, and those at a word's start.
            longer = np.unique(np.concatenate([_cut(full, n), longer[longer >> (_BITS * n) == 0]]))

    def differences(self, words: list[str]) -> np.ndarray:
        """Toxic less ordinary log-likelihood of each word."""
        if not words:
            return np.zeros(0)
        code, place, word = letters(words)
        use = place > 0
        count, above = self.shared[0]
        key = _cut(code, 1)
        p = (count.get(key)[0] + 0.5) / (above.values[0].sum() + 0.5 * (1 << _BITS))
        for n in range(2, ORDER):
            count, above = self.shared[n - 1]
            key = grams(code, place, n)
            total, kinds = above.get(key >> _BITS)
            seen = (total > 0) & (place >= n)
            with np.errstate(divide="ignore", invalid="ignore"):
                better = (np.maximum(count.get(key)[0] - DISCOUNT, 0) + DISCOUNT * kinds * p) / total
            p = np.where(seen, better, p)
        key = grams(code, place, ORDER)
        counts, context = self.top.get(key), self.context.get(key >> _BITS)
        logs = []
        for k in range(2):
            total, kinds = context[k], context[k + 2]
            with np.errstate(divide="ignore", invalid="ignore"):
                own = (np.maximum(counts[k] - DISCOUNT, 0) + DISCOUNT * kinds * p) / total
            logs.append(np.log(np.where(total > 0, own, p)))
        return np.bincount(word[use], weights=(logs[0] - logs[1])[use], minlength=len(words))


def held_out(id_col: str, folds: int, fold: int) -> Column:
    """Whether the id's checksum falls into the fold; false for a null id."""
    crc = F.crc32(F.col(id_col).cast("string").cast("binary"))
    return F.coalesce(crc % F.lit(folds) == F.lit(fold), F.lit(False))


def _words(text: bytes | str | None) -> list[bytes]:
    if isinstance(text, str):
        text = text.encode()
    return text.lower().split() if text else []


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, key, toxic, ordinary) of the longest grams, added up per batch."""
    for batch in batches:
        kinds: dict[tuple[int, int], Counter] = {}
        for text, toxic, part in zip(*(batch.column(i).to_pylist() for i in range(3))):
            kinds.setdefault((part, 0 if toxic else 1), Counter()).update(_words(text))
        for (part, k), words in kinds.items():
            if words:
                code, place, word = letters([w.decode().lower() for w in words])
                n = np.fromiter(words.values(), np.float64, len(words))[word][place > 0]
                t = _Table(grams(code, place, ORDER)[place > 0], n)
                both = [t.values[0] if k == i else np.zeros(len(t.keys)) for i in range(2)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(t.keys), part)), pa.array(t.keys), *map(pa.array, both)],
                    names=["part", "key", "toxic", "ordinary"])


def _features(model, text: str, drop: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, known = model.value, {}
        for batch in batches:
            texts = [_words(t) for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            fresh = list({w for words in texts for w in words if w not in known})
            if len(known) + len(fresh) > CACHE:
                known.clear()
                fresh = list({w for words in texts for w in words})
            for at in range(0, len(fresh), 20_000):
                part = fresh[at:at + 20_000]
                known.update(zip(part, m.differences([w.decode().lower() for w in part]).tolist()))
            out = np.zeros((len(texts), len(NAMES)))
            for i, words in enumerate(texts):
                if words:
                    d = np.fromiter(map(known.__getitem__, words), np.float64, len(words))
                    top = np.sort(d if len(d) <= 3 else np.partition(d, len(d) - 3)[-3:])
                    out[i] = d.mean(), top[-1], top.mean(), np.log1p(len(d))
            names = [n for n in batch.schema.names if not (drop and n == text)]
            rest = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays(
                [*rest, *(pa.array(out[:, j].copy()) for j in range(len(NAMES)))], names=[*names, *NAMES])

    return run


def features(rows: DataFrame, model, text: str = "text", drop: bool = True) -> DataFrame:
    """Add what the curve reads, and drop the column ``text`` if told; ``model`` is a broadcast Model."""
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if not (drop and f.name == text)]
    return rows.mapInArrow(_features(model, text, drop), ", ".join([*kinds, *(f"{n} double" for n in NAMES)]))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50,
             times: np.ndarray | None = None) -> np.ndarray:
    """Weights of a logistic curve (the first is the constant) by Newton's method.

    A row counts as often as ``times`` says, once without it.
    """
    times = np.ones(len(x)) if times is None else times
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (times * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (times * (y - p)) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", folds: int = 5, fold: int = 0):
    """(broadcast Model, weights) from labelled rows outside the held-out fold.

    At most ``MOST_TOXIC`` and ``MOST_ORDINARY`` rows, those with the lowest hashes. Ids labelled
    more than once are toxic if any label says so; null labels count for nothing. Without
    labels of both kinds the score is one half. In the logistic fit the rows of a class stand
    for all its labels, so the bounds do not shift the scores.
    """
    spark = docs.sparkSession
    known = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("toxic")).dropna()
        .filter(~held_out("id", folds, fold)).groupBy("id").agg(F.max("toxic").alias("toxic"))
        .withColumn("h", F.xxhash64("id", F.lit("toxicity")))
    )
    # One aggregate over all labels: how many of a class each sampled row stands for.
    total = dict(known.groupBy("toxic").agg(F.count("*")).collect())
    stands = [max(1.0, total.get(k, 0) / n) for k, n in ((0, MOST_ORDINARY), (1, MOST_TOXIC))]
    picked = [known.filter(F.col("toxic") == F.lit(k)).orderBy("h", "id").limit(n)
              for k, n in ((1, MOST_TOXIC), (0, MOST_ORDINARY))]
    sample = F.broadcast(picked[0].unionByName(picked[1]))  # at most the two bounds
    text = text_or_empty(text_col).cast("binary").alias("text")
    rows = stage(docs.select(F.col(id_col).alias("id"), text).join(sample, "id")
                 .withColumn("part", F.pmod(F.col("h"), F.lit(PARTS))))
    counts = (
        rows.select("text", "toxic", "part").mapInArrow(_counted, "part long, key long, toxic double, ordinary double")
        .groupBy("part", "key").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))
        .toArrow()  # grams of a bounded number of texts
    )
    part, key, toxic, ordinary = (counts[c].to_numpy() for c in ("part", "key", "toxic", "ordinary"))

    def model(without: int | None):
        use = np.full(len(part), True) if without is None else part != without
        if not (toxic[use].sum() > 0 and ordinary[use].sum() > 0):
            return None
        return spark.sparkContext.broadcast(Model(key[use], toxic[use], ordinary[use]))

    seen = []
    for k in range(PARTS):
        m = model(k)
        if m is not None:
            seen.append(features(rows.filter(F.col("part") == F.lit(k)).select("text", "toxic"), m).toArrow())
            m.unpersist()
    x = np.concatenate([np.column_stack([s[n].to_numpy() for n in NAMES]) for s in seen]) if seen else np.zeros((0, len(NAMES)))
    y = np.concatenate([s["toxic"].to_numpy().astype(float) for s in seen]) if seen else np.zeros(0)
    if not 0 < y.sum() < len(y):
        return None, np.zeros(len(NAMES) + 1)
    return model(None), logistic(x, y, times=np.where(y > 0, stands[1], stands[0]))


def score(rows: DataFrame, model, weights: np.ndarray, text: str = "text", drop: bool = True,
          out: str = "score") -> DataFrame:
    """Add the score, 0 to 1, and drop the column ``text`` if told."""
    if model is None:
        return (rows.drop(text) if drop else rows).withColumn(out, F.lit(0.5))
    z = F.lit(float(weights[0]))
    for name, w in zip(NAMES, weights[1:]):
        z = z + F.lit(float(w)) * F.col(name)
    return features(rows, model, text, drop).withColumn(out, F.lit(1.0) / (F.lit(1.0) + F.exp(-z))).drop(*NAMES)


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               threshold: float = 0.5) -> DataFrame:
    """Documents scored below ``threshold``, with all their columns.

    Without labels of both kinds nothing can be told, and every document stays.
    """
    model, weights = fit(docs, labels, id_col, text_col)
    if model is None:
        return docs
    scored = score(docs, model, weights, text=text_col, drop=False, out="__score")
    return scored.filter(F.col("__score") < F.lit(threshold)).drop("__score")


def op8(spark, sf_dir: str) -> DataFrame:
    """The registered report: every document scored, learning only outside its own fold.

    A null text counts as empty. Repeated rows each get their own row; other columns
    are ignored; an empty table gives an empty result.
    """
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model, weights = fit(docs, labels)
    rows = docs.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"),
                       text_or_empty().cast("binary").alias("text"))
    return score(rows, model, weights).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
