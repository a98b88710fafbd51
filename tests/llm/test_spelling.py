import re
import zlib
from collections import Counter

import numpy as np

from tillwise.llm import spelling

SF = "/root/testdata/sf0.001"


def vocabulary(rows):
    n = Counter()
    for ident, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if ident is None else ident}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def variants(n):
    """By brute force over all pairs that share what is left without one letter."""
    near = {w: set() for w in n}
    cut = {}
    for w in n:
        for i in range(len(w)):
            cut.setdefault(w[:i] + w[i + 1:], set()).add(w)
        cut.setdefault(w, set()).add(w)
    for group in cut.values():
        for a in group:
            near[a] |= {b for b in group if a != b and one_edit(a, b)}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda b: (-n[b], b), default=None)
        if best and n[best] >= 10 * n[w]:
            form[w] = best
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        f = form.get(w)
        out.add((w, f, root, n[w], len(near[w]), n[f] if f else None))
    return out


def got(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = variants(vocabulary([(r["doc_id"], r["text"]) for r in docs.collect()]))
    assert got(spelling.op12(docs)) == want and any(w[1] for w in want)


def test_odd_rows(spark, odd, empty):
    want = variants(vocabulary([(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]))
    assert got(spelling.op12(odd)) == want
    assert spelling.op12(empty).count() == 0


def test_many_small_leaves_lose_nothing(spark):
    """Anagrams, near words across leaves and lengths, chains of forms; leaves of a few words."""
    rng = np.random.default_rng(5)
    alphabet = np.array(list("abcdé"))
    n = {"".join(rng.choice(alphabet, rng.integers(7, 10))): int(rng.integers(2, 9)) for _ in range(3000)}
    n |= {"stardust": 4000, "stardusts": 300, "stadusts": 25, "stadustz": 2, "z" * 300: 5, "z" * 301: 2}
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    for leaf, sample in ((40, 10_000), (200, 50), (10_000, 10)):
        assert got(spelling.variants(df, leaf, sample)) == variants(n)


def test_one_task_sees_a_small_share(spark):
    """Boxes prune: a word meets few leaves of a tree of many."""
    rng = np.random.default_rng(6)
    words = sorted({"".join(map(chr, rng.integers(0x61, 0x7B, 9))) for _ in range(20_000)})
    vectors = spelling.counts(spelling.letters(words, 9))
    tree = spelling.fit(vectors, 64)
    own = tree.leaf_of(vectors)
    assert np.bincount(np.unique(own, return_inverse=True)[1]).max() <= len(own) / 64
    for less, share in ((1, 0.5), (0, 0.25)):
        row, leaf = tree.reached(vectors, less)
        assert len(row) < share * len(np.unique(own)) * len(words)
        assert (leaf == own[row]).sum() == len(words)
