import itertools
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tillwise.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(docs, rows):
    tok = Tokenizer.from_file(PATH)
    texts = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    want = sorted((str(i), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, ids in (
        (i, tok.encode(t, add_special_tokens=False).ids + [1]) for i, t in texts) if len(ids) <= 2048)
    got = sorted((str(r["doc_id"]), r["doc_tokens"], r["ids_crc32"]) for r in rows if r["doc_tokens"] <= 2048)
    assert got == want
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert sorted(sequences) == list(range(len(sequences)))
    return sum(n for p in sequences.values() for _, n in p), len(sequences)


def test_round_trip_and_padding(documents):
    tokens, sequences = check(documents, packing.op5(documents).collect())
    assert sequences <= tokens / 2048 * 1.01 + 1


def test_long_documents_are_cut_whole(spark):
    df = spark.createDataFrame([(1, "abc def ghi. " * 4000), (2, "x")], "doc_id long, text string")
    rows = packing.op5(df).collect()
    ids = Tokenizer.from_file(PATH).encode("abc def ghi. " * 4000, add_special_tokens=False).ids + [1]
    for r in (r for r in rows if r["doc_id"] == 1):
        part = ids[r["start"]:r["start"] + r["length"]]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(ids)
    assert sum(r["length"] for r in rows if r["doc_id"] == 1) == len(ids)


def test_fullest_is_the_best_multiset():
    rng = np.random.default_rng(3)
    for _ in range(60):
        lengths = rng.integers(1, 40, rng.integers(1, 8)).tolist()
        counts = {k: lengths.count(k) for k in lengths}
        chosen = packing.fullest(counts, 50)
        seed = max(counts)
        rest = list(lengths)
        rest.remove(seed)
        best = max(seed + sum(c) for n in range(len(rest) + 1) for c in itertools.combinations(rest, n)
                   if seed + sum(c) <= 50)
        assert sum(k * n for k, n in chosen.items()) == best
        assert all(n <= counts[k] for k, n in chosen.items())


def test_plan_uses_every_piece_once():
    rng = np.random.default_rng(5)
    counts = {int(k): int(rng.integers(1, 5000)) for k in rng.integers(1, 2049, 300)}
    made = packing.plan(counts)
    used = {}
    for chosen, times in made:
        assert sum(k * n for k, n in chosen.items()) <= 2048
        for k, n in chosen.items():
            used[k] = used.get(k, 0) + n * times
    assert used == counts and len(made) < 2000


def test_words_are_tokenized_like_whole_texts():
    tok = Tokenizer.from_file(PATH)
    words = packing._WordIds(PATH)
    rng = np.random.default_rng(8)
    letters = list("aB's TRE verm123é ÉßñŒſİıΣσς東́  \x1c\x85,.!?&%\n\t\x0b🙂ŉǅ")
    for _ in range(3000):
        text = "".join(rng.choice(letters, rng.integers(0, 30)))
        got = np.frombuffer(b"".join(map(words.__getitem__, text.encode().split())), "<u4").tolist()
        assert got == tok.encode(text, add_special_tokens=False).ids


def test_marks_inside_and_next_to_words():
    tok = Tokenizer.from_file(PATH)
    words = packing._WordIds(PATH)
    rng = np.random.default_rng(9)
    bits = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "word", "it's", "é東", " ", " \n", "7", "<|end", "oftext|>"]
    for _ in range(2000):
        text = "".join(rng.choice(bits, rng.integers(1, 9)))
        got = np.frombuffer(b"".join(map(words.__getitem__, text.encode().split())), "<u4").tolist()
        assert got == tok.encode(text, add_special_tokens=False).ids
    assert tok.encode("a <|endoftext|> b", add_special_tokens=False).ids == [320, 49407, 321]


def test_odd_rows(odd, empty):
    check(odd, packing.op5(odd).collect())
    assert packing.op5(empty).count() == 0
