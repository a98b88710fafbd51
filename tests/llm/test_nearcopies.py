import corpus_pipeline
import numpy as np

from tillwise.llm import nearcopies


def pieces(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def kept(rows):
    """Smallest id of each component of pairs at 0.8 or more, by brute force."""
    sets = {i: pieces(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            both = len(sets[i] & sets[j])
            if 5 * both >= 4 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {find(i) for i in ids}


def edited(rng, words, n):
    out = list(words)
    for at in rng.choice(len(words), n, replace=False):
        out[at] = f"new{rng.integers(1 << 40)}"
    return " ".join(out)


def test_stage_keeps_one_of_each_group_at_the_least_similarity(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    got = [r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, documents, "").collect()]
    assert sorted(got) == sorted(kept(rows))


def test_pairs_about_the_bound_and_a_common_passage(spark):
    rng = np.random.default_rng(7)
    rows, i = [], 0
    for k in range(150):
        words = [f"w{k}x{j}" for j in range(200)]
        for n in (0, 2 + k % 6):  # one edit in the middle changes five shingles: 0.9 to 0.7
            rows.append((i, edited(rng, words, n)))
            i += 1
    passage = " ".join(f"common{j}" for j in range(60))
    rows += [(i + k, f"{passage} " + " ".join(f"own{k}x{j}" for j in range(k % 30 + 10))) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [r["doc_id"] for r in nearcopies.drop_near_copies(docs).collect()]
    assert len(got) == len(set(got)) and set(got) == kept(rows)


def test_texts_of_one_passage_are_not_paired(spark):
    """Texts that share a passage only: pairs to compare do not grow with the square of the texts."""
    passage = " ".join(f"common{j}" for j in range(60))
    rows = [(k, f"{passage} " + " ".join(f"own{k}x{j}" for j in range(40))) for k in range(80)]
    texts = spark.createDataFrame([(k, t.encode()) for k, t in rows], "fp long, text binary")
    alone = spark.createDataFrame([(k, k) for k, _ in rows], "fp long, root long")
    assert nearcopies._prefix_pairs(texts, alone).count() == 0
    near = spark.createDataFrame([(0, rows[0][1].encode()), (1, f"{rows[0][1]} tail".encode())], "fp long, text binary")
    pairs = nearcopies._prefix_pairs(near, alone).collect()
    assert [(r["a"], r["b"]) for r in pairs] == [(0, 1)]


def test_odd_rows(spark, odd, empty):
    out = nearcopies.drop_near_copies(odd)
    assert out.columns == odd.columns and nearcopies.drop_near_copies(empty).count() == 0
    texts = [(r["doc_id"], r["text"]) for r in out.collect()]
    # No words at all (null, empty, white space) is one group; equal texts are one group.
    assert sum(not (t or "").split() for _, t in texts) == 1
    assert len([t for _, t in texts if t and t.startswith("same text")]) == 1


def test_a_large_group_of_near_copies(spark):
    rng = np.random.default_rng(8)
    words = [f"w{j}" for j in range(120)]
    rows = [(k, edited(rng, words, 1 + k % 3)) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"] for r in nearcopies.drop_near_copies(docs).collect()} == kept(rows)


def test_a_large_group_about_a_centre_is_not_paired(spark, monkeypatch):
    """Copies with up to four edits of one text: pairs of rare shingles do not grow with the square of the group."""
    rng = np.random.default_rng(9)
    words = [f"w{j}" for j in range(150)]
    rows = [(k, edited(rng, words, k % 5)) for k in range(1, 200)] + [(200, " ".join(words))]
    made, whole = [], nearcopies._prefix_pairs

    def counted(texts, left):
        out = whole(texts, left)
        made.append(out.count())
        return out

    monkeypatch.setattr(nearcopies, "_prefix_pairs", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"] for r in nearcopies.drop_near_copies(docs).collect()} == kept(rows)
    assert made and sum(made) < 3 * len(rows), made
