import hashlib

import pytest
from pyspark.sql import functions as F

from tillwise.llm import chat

SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    """Digests by brute force from (conv, turn, role, text) rows."""
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in groups.items():
        turns.sort()
        learned = "".join(t for _, _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for _, _, r, t in turns)), len(learned), sha(learned))
    return out


def got(df):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"])
            for r in chat.op11(df).collect()}


MARK = "\\### Assistant: </turn> ok"
OWN = [(-7, 0, "user", MARK), (-7, 1, "assistant", MARK)]


def test_whole_table(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert got(table) == expected(rows + OWN)


def test_odd_rows(spark):
    rows = [
        (1, 0, "user", None), (1, 1, "assistant", ""), (1, 1, "assistant", ""), (1, None, None, "no role"),
        (2, 0, "assistant", "### User: hi</turn>\n### Assistant: "), (2, 1, "user", "\\\\ </ \\/ #\\# </turn>\n"),
        (3, 0, "tool: #1\\", "a b \U0001f642 ### </turn>"), (3, 1, "User", "x"), (3, 2, "=user", "y\n"),
        (None, 0, "user", "q"), (None, 1, "assistant", "a"), (4, 0, "assistant", "word </turn># " * 50_000),
        (5, 2, "assistant", "second"), (5, 2, "assistant", "first"), (6, None, None, None),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    # Columns that clash with other layouts and with inner names change nothing.
    clash = {c: F.lit("clash") for c in ("prompt", "completion", "turns", "layout", "segments", "__print", "k0")}
    assert got(df.withColumns(clash).repartition(3)) == expected(rows + OWN)
    assert got(df.limit(0)) == expected(OWN)


def test_marks_cannot_be_forged_and_segments_join_to_the_text(spark):
    rows = [(1, 0, "user", MARK), (1, 1, "assistant", "<//turn> <\\/turn> ####")]
    df = chat.canonical(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    r = chat.format_turns(df).first()
    assert r["formatted"] == "".join(s["text"] for s in r["segments"])
    assert r["formatted"].count(chat.CLOSE) == 2 and r["formatted"].count("### ") == 2
    assert [s["in_loss"] for s in r["segments"]] == [False] * 4 + [True, False]


LAYOUTS = [
    ('{"id":1,"messages":[{"role":"human","content":"q"},{"role":"assistant","content":"a","n":3}]}', "messages",
     [("user", "q"), ("assistant", "a")]),
    ('{"id":2,"conversations":[{"from":"system","value":"s"},{"from":"human","value":"q"},{"from":"gpt","value":"a"}]}',
     "conversations", [("system", "s"), ("user", "q"), ("assistant", "a")]),
    ('{"id":3,"instruction":"i","input":"x","output":"o"}', "instruction",
     [("user", "i"), ("user", "x"), ("assistant", "o")]),
    ('{"id":4,"instruction":"i","output":"o","extra":{"deep":1}}', "instruction", [("user", "i"), ("assistant", "o")]),
    ('{"id":5,"system":"s","prompt":"p","completion":"c"}', "prompt", [("system", "s"), ("user", "p"), ("assistant", "c")]),
    ('{"id":6,"prompt":"p","response":"r"}', "response", [("user", "p"), ("assistant", "r")]),
    ('{"id":7,"context":"c","question":"q","answer":""}', "question", [("user", "c"), ("user", "q"), ("assistant", "")]),
    ('{"id":8,"role":"user","text":"t"}', "turn row", [("user", "t")]),
    ('{"id":9,"prompt":"p","question":"q"}', None, []),
    ('{"id":10,"messages":[]}', None, []),
]


def test_layouts_are_told_by_fingerprint(spark, folder):
    path = f"{folder}/records.json"
    with open(path, "w") as f:
        f.write("\n".join(x[0] for x in LAYOUTS))
    out = {r["id"]: (r["layout"], [tuple(t) for t in r["turns"]])
           for r in chat.canonical(spark.read.json(path)).collect()}
    assert out == {i: (layout, turns) for i, (_, layout, turns) in enumerate(LAYOUTS, 1)}


def test_fingerprint_depends_on_paths_only(spark):
    df = spark.createDataFrame([("a", "b"), ("c", "d"), ("e", None)], "prompt string, completion string")
    known = {"prompt", "completion"}
    a, b, c = [r[0] for r in df.select(chat.fingerprint(df.schema, known)).collect()]
    assert a == b != c
    turned = df.select("completion", F.lit(1).alias("other"), "prompt")
    assert turned.select(chat.fingerprint(turned.schema, known)).first()[0] == a


@pytest.mark.parametrize("text", ["", "\\", "#", "</", "a</b#c\\", "<\\/turn>", "\\\\#"])
def test_escape_round_trip(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    out = df.select(chat.escaped(F.col("t")).alias("e")).select("e", chat.unescaped(F.col("e")).alias("u")).first()
    assert out["u"] == text and "</" not in out["e"] and "##" not in out["e"]
