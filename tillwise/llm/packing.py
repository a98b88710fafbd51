"""Packing token pieces into fixed windows by minimum bin slack.

Documents are tokenized, ended by an end id and cut into pieces: as many full windows as
they hold, and a remainder. Remainders of the same length are alike, so the plan needs
only how many pieces there are of each length, at most as many numbers as a window has
tokens. Window by window, a bitset of reachable sums finds the multiset of remaining
lengths that fills it closest to capacity; the multiset is read back from the bitsets
and used as often as the counts allow. The pieces are then ranked inside their length
and take the places of the plan by rank.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import running, stage, text_or_empty

WINDOW = 2048
END_ID = 1
#: Words whose ids a task remembers.
CACHE = 500_000


#: How the tokenizer cuts a lower-case text before its merges (fixed values of the vocabulary).
PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
#: Below this code point no mark combines with a letter, and lower case is letter by letter.
PLAIN = regex.compile(r"[\x00-\u012f\u0131-\u024f]*")


class _PartIds(dict):
    """Ids of a part of a word as little-endian 32-bit bytes, tokenized when first met."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: Marks such as an end of text are one id wherever they stand, as the tokenizer reads them by itself.
        self.marks = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # The merges read bytes as characters: printable ones as themselves, others from 256 on.
        own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        rest = [b for b in range(256) if b not in own]
        self.characters = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def __missing__(self, part: str) -> bytes:
        read = "".join(map(self.characters.__getitem__, part.encode()))
        ids = np.array([t.id for t in self.tokenizer.model.tokenize(read)], dtype="<u4").tobytes()
        if len(self) >= CACHE:
            self.clear()
        if len(part) <= 64:
            self[part] = ids
        return ids


class _WordIds(dict):
    """Ids of a word given as UTF-8.

    The tokenizer's parts never cross white space, so a text's ids are its words' ids,
    and a plain word's ids are its parts' ids.
    """

    def __init__(self, path: str):
        self.parts = _PartIds(path)

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode()
        if PLAIN.fullmatch(text) and not any(mark in text for mark in self.parts.marks):
            ids = b"".join(map(self.parts.__getitem__, PARTS.findall(text.lower())))
        else:
            ids = self.parts.whole(text)
        if len(self) >= CACHE:
            self.clear()
        if len(word) <= 64:
            self[word] = ids
        return ids


@functools.cache
def _word_ids(path: str) -> _WordIds:
    """One per Python worker, which keeps it from task to task."""
    return _WordIds(path)


def pieces(docs: DataFrame, tokenizer: str, window: int = WINDOW,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of each document: id, start, length, crc of the ids and the document's tokens."""
    end = np.array([END_ID], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _word_ids(tokenizer)
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            names = batch.column(0).to_pylist()
            for name, text in zip(names, batch.column(1).to_pylist()):
                raw = b"".join(map(ids.__getitem__, text.split())) + end  # bytes split at ASCII white space
                total = len(raw) // 4
                for start in range(0, total, window):
                    part = raw[4 * start:4 * (start + window)]
                    for col, v in zip(out, (name, start, len(part) // 4, zlib.crc32(part), total)):
                        col.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], batch.schema.field(0).type), *(pa.array(c, pa.int64()) for c in out[1:])],
                names=["id", "start", "length", "crc", "doc_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).cast("binary").alias("text")).mapInArrow(
        cut, f"id {kind}, start long, length long, crc long, doc_tokens long")


def fullest(counts: dict[int, int], window: int) -> dict[int, int]:
    """The multiset of lengths, the longest one included, that leaves least slack.

    Bit s of a bitset is set if the sum s can be reached. Lengths are added longest
    first, each in parts of 1, 2, 4, ... copies, until the window can be full.
    """
    seed = max(counts)
    room = window - seed
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, part = min(counts[length] - (length == seed), room // length), 1
        while left > 0:
            take = min(part, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left, part = left - take, part * 2
        if reach >> room & 1:
            break
    at = reach.bit_length() - 1
    chosen = {seed: 1}
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            chosen[length] = chosen.get(length, 0) + take
            at -= length * take
    return chosen


def plan(counts: dict[int, int], window: int = WINDOW) -> list[tuple[dict[int, int], int]]:
    """Fillings and how often each is used, until no piece is left."""
    counts = {k: n for k, n in counts.items() if n}
    out = []
    while counts:
        chosen = fullest(counts, window)
        times = min(counts[k] // n for k, n in chosen.items())
        out.append((chosen, times))
        for k, n in chosen.items():
            counts[k] -= n * times
            if not counts[k]:
                del counts[k]
    return out


def places(made: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """For each length, rows (first rank, pieces per window, first window, first offset)."""
    out: dict[int, list] = {}
    used: dict[int, int] = {}
    window = 0
    for chosen, times in made:
        offset = 0
        for length, n in chosen.items():
            out.setdefault(length, []).append((used.get(length, 0), n, window, offset))
            used[length] = used.get(length, 0) + n * times
            offset += length * n
        window += times
    return {k: np.array(v, dtype=np.int64) for k, v in out.items()}


def pack(cut: DataFrame, window: int = WINDOW) -> DataFrame:
    """Add sequence_id and offset to pieces that have id, start, length and crc.

    No sequence is longer than ``window``; offsets in a sequence have no gaps. Ranks and
    places depend on the pieces alone, so reruns agree. An empty table gives an empty result.
    """
    cut = stage(cut.withColumn("h", F.xxhash64("id", "start", "crc")))
    counts = dict(cut.groupBy("length").agg(F.count("*")).collect())  # one row per length
    where = places(plan(counts, window))
    ranked = running(cut, ["length"], "h", ["id", "start", "crc"], out="r")

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, r = (batch.column(n).to_numpy() for n in ("length", "r"))
            seq, off = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for k in np.unique(length):
                sel = length == k
                rows = where[int(k)]
                at = rows[np.searchsorted(rows[:, 0], r[sel], side="right") - 1]
                gone = r[sel] - at[:, 0]
                seq[sel] = at[:, 2] + gone // at[:, 1]
                off[sel] = at[:, 3] + gone % at[:, 1] * k
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(seq), pa.array(off)], names=[*batch.schema.names, "sequence_id", "offset"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema)
    return ranked.mapInArrow(put, f"{kinds}, sequence_id long, offset long").drop("h", "r")


def op5(docs: DataFrame) -> DataFrame:
    """The registered report: whole texts, windows of 2048 ids.

    A null or empty text is its end id alone. Repeated rows are documents of their own;
    null ids are kept; other columns are ignored.
    """
    import public_tokenizers

    return pack(pieces(docs, public_tokenizers.path("word_bpe_49k.json"))).select(
        F.col("id").alias("doc_id"), "start", "length", F.col("crc").alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset")
