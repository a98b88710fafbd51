import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tillwise.llm import mixlm


def fold(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def base_of(rows):
    counts = Counter()
    for i, t in rows:
        if not fold(i):
            counts.update((t or "").encode().lower().split())
            counts[b""] += 1
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        words = (t or "").encode().lower().split() + [b""]
        out.append((i, fold(i), len(words), sum(counts[w] > 0 for w in words), n,
                    sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)))
    return out


def near(got, want):
    got = sorted(got, key=lambda r: (str(r[0]), r[2], r[5]))
    want = sorted(want, key=lambda r: (str(r[0]), r[2], r[5]))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(abs(g[5] - w[5]) < 1e-9 * abs(w[5]) + 1e-9 for g, w in zip(got, want))


def test_query_has_the_exact_base_and_beats_it_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = mixlm.op7(docs).cache()
    near([tuple(r)[:6] for r in got.collect()], base_of(rows))
    held = got.filter("held_out").agg(F.sum("score"), F.sum("base_score"), F.max("score")).first()
    assert held[0] > held[1] and held[2] < 0


def test_branch_probabilities_add_up_to_one():
    rng = np.random.default_rng(2)
    hashes = np.unique(rng.integers(0, 1 << 63, 200, dtype=np.uint64))
    counts = rng.poisson(2.0, (len(hashes), mixlm.CLASSES)).astype(float)
    counts[:, 0] += 1
    tree, mixer = mixlm.Tree(hashes, counts, 0), mixlm.Mixer(32, (0.5, 0.3, 0.2))
    word, klass = np.nonzero(counts)
    tree.learn(mixer, word, klass, counts[word, klass])
    for k in (0, 5, mixlm.CLASSES - 1):
        p = np.exp(tree.log_p(mixer, np.arange(len(hashes)), np.full(len(hashes), k)))
        assert abs(p.sum() - 1) < 1e-9 and (p > 0).all()


def test_spelling_is_a_probability():
    words = [b"aab", b"aba", b"abb", b"aabb", b"abab"]
    counts = np.zeros(2 * sum(mixlm.SLOTS), np.float32)
    _, bit, slots = mixlm.spelled(words)
    for j in range(len(mixlm.SLOTS)):
        counts += np.bincount(2 * slots[:, j] + bit, minlength=len(counts))
    speller, mixer = mixlm.Speller(counts), mixlm.Mixer(32, (0.1, 0.1, 0.3, 0.4, 0.4))
    speller.learn(mixer, words)
    likely, odd = np.exp(speller.log_p(mixer, [b"abba", b"zq\xc3\xa9x"]))
    assert 0 < odd < likely < 1
    every = [bytes([a]) for a in range(256) if a != 32]
    assert np.exp(speller.log_p(mixer, every)).sum() < 1


def test_hash_is_sparks(spark):
    words = [b"", b"the", "läßt".encode()]
    df = spark.createDataFrame([(bytearray(w),) for w in words], "w binary")
    got = [r[0] for r in df.select(F.xxhash64("w")).collect()]
    assert got == [h - (1 << 64) if (h := mixlm.digest(w)) >> 63 else h for w in words]


def test_small_word_table_gives_the_same_scores(documents, monkeypatch):
    want = {r["doc_id"]: r["score"] for r in mixlm.op7(documents).collect()}
    monkeypatch.setattr(mixlm, "FREQUENT", 50)
    got = {r["doc_id"]: r["score"] for r in mixlm.op7(documents).collect()}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-6 for i in want)


def test_odd_rows(odd, empty):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = mixlm.op7(odd).collect()
    near([tuple(r)[:6] for r in got], base_of(rows))
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)
    assert mixlm.op7(empty).count() == 0


def test_words_are_those_of_a_plain_split():
    texts = [b"", b" A b.  a ", b"\x0b\x1c", b"  ", b"x\xc2\xa0Y \xc3\x84.\tq", b"the the, a"]
    want = [t.lower().split() for t in texts]
    words, size = mixlm.words_of(pa.array(texts, pa.binary()))
    assert size.tolist() == [len(w) for w in want] and words.to_pylist() == [w for ws in want for w in ws]
    leads = {b"the": 0, b"a": 1}
    table = mixlm.Words(leads, np.log(np.full((2, mixlm.GROUPS), 1 / mixlm.GROUPS)), {b"q": 0})
    text, ids, klass = table.read(pa.array(texts, pa.binary()))
    tokens = [(i, w) for i, ws in enumerate(want) for w in [*ws, mixlm.END]]
    assert list(zip(text.tolist(), table.words.take(pa.array(ids)).to_pylist())) == tokens
    assert table.hashes()[ids].view(np.uint64).tolist() == [mixlm.digest(w) for _, w in tokens]
    before = [1 if i == 0 or tokens[i - 1][0] != t else mixlm.ENDING[tokens[i - 1][1][-1]] for i, (t, _) in enumerate(tokens)]
    assert (klass % mixlm.ENDS).tolist() == before


def test_texts_are_read_in_large_batches():
    """Small batches are read together: a word is looked up and sent on once, not once a batch."""
    batches = [pa.RecordBatch.from_arrays([pa.array([b"same words in all"] * 4, pa.binary())], names=["text"])] * 50
    out = list(mixlm._count(iter(batches)))
    assert sum(len(b) for b in out) == 5
    assert {w: n for b in out for w, n in zip(b[0].to_pylist(), b[1].to_pylist())} == {
        b"same": 200, b"words": 200, b"in": 200, b"all": 200, mixlm.END: 200}


def leads_and_texts(n):
    rng = np.random.default_rng(4)
    leads = {f"l{i}".encode(): i for i in range(40)}
    texts = [" ".join(f"l{i}" if i < 40 else f"w{i}" for i in rng.integers(0, 80, k)).encode()
             for k in rng.integers(0, 900, n)]
    return leads, np.log(rng.dirichlet(np.ones(mixlm.GROUPS), 40)), pa.array(texts, pa.binary())


def test_groups_are_those_of_the_last_leads(monkeypatch):
    leads, speak, texts = leads_and_texts(60)
    want = []
    for t in texts.to_pylist():
        seen = []
        for word in [*t.split(), mixlm.END]:
            want.append(int(sum(speak[i] for i in seen[-mixlm.REACH:]).argmax()) if seen else mixlm.GROUPS)
            seen += [leads[word]] if word in leads else []
    for held in (mixlm.LEADS_HELD, 1, 7, 64):
        monkeypatch.setattr(mixlm, "LEADS_HELD", held)
        klass = mixlm.Words(leads, speak, {}).read(texts)[2]
        assert (klass // mixlm.ENDS).tolist() == want


def test_texts_are_read_in_little_memory():
    """What a task holds for the tokens of a batch, of six bytes or so here: a few narrow values each."""
    leads, speak, texts = leads_and_texts(4000)
    words = mixlm.Words(leads, speak, {})
    tracemalloc.start()
    try:
        tokens = len(words.read(texts)[1])
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert tokens > 1_500_000 and peak < 45 * tokens, peak / tokens
    assert mixlm.HELD <= 4 << 20
