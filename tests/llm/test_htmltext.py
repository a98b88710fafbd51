import html
import re

import numpy as np
import pytest

from tillwise.llm import htmltext


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet("/root/testdata/sf0.001/pages.parquet")


def article(page):
    inner = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    return " ".join(html.unescape(re.sub(r"<[^>]*>", " ", inner)).split())


def test_query_gives_the_articles(pages):
    want = {r["page_id"]: article(r["html"]) for r in pages.collect()}
    got = htmltext.op6(pages).collect()
    assert {r["page_id"]: r["text"] for r in got} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got)


@pytest.fixture(scope="module")
def net(pages):
    return htmltext.train([r["html"] for r in pages.collect()], assembled=900)


def main_text(net, page):
    cut = htmltext.blocks(page)
    chosen = net.classify([htmltext._Reader()(cut)])[0]
    return " ".join(t for (_, t, _), k in zip(cut, chosen) if k)


def test_held_out_layouts(net):
    rng = np.random.default_rng(77)
    good = [f"Some sentence number {i} of the story, which goes on for a while." for i in range(200)]
    bad = [f"Buy thing {i} now" for i in range(60)]
    wrong = total = 0
    for _ in range(200):
        cut = htmltext.blocks(htmltext.assemble(rng, good, bad))
        if cut:
            got = net.classify([htmltext._Reader()(cut)])[0]
            wrong += (got != np.array(htmltext.labels(cut))).sum()
            total += len(cut)
    assert wrong < 0.04 * total


def test_known_page_parts(net):
    body = "".join(f"<p>Sentence {i} of the main story is told here at some length.</p>" for i in range(6))
    page = (f"<body><header><a href='/'>Home page</a></header><nav><ul><li><a>One</a></li></ul></nav><aside><p>Aside.</p></aside>"
            f"<main><article><h1>Title &amp; more</h1>{body}</article></main><section class='comments'><p>A reader wrote this.</p>"
            f"</section><form><label>Mail</label></form><footer>&copy; us</footer></body>")
    text = main_text(net, page)
    assert text.startswith("Title & more Sentence 0") and "Sentence 5" in text
    assert not any(w in text for w in ("Home", "Aside", "reader", "Mail", "©"))


def test_block_cutting():
    cut = htmltext.blocks("<p>a <b>b</b>c<br>d&nbsp;&lt;e&gt;<p>f<script>if (1 < 2) '</p>'</script> g<!-- x --><li>h<li>i</ul>j < k")
    assert [t for _, t, _ in cut] == ["a bc d <e>", "f g", "h", "i", "j < k"]
    assert htmltext.blocks("") == [] and htmltext.blocks("<script>never closed") == []
    deep = htmltext.blocks("<div>" * 3000 + "x" + "</div>" * 3000)
    assert [t for _, t, _ in deep] == ["x"]


def test_gradient_is_right():
    net = htmltext.Labeller()
    rng = np.random.default_rng(1)
    d = htmltext.PATH_DIM + htmltext.WORD_DIM + htmltext.MEASURES
    x, sizes = htmltext.padded([rng.normal(size=(4, d)), rng.normal(size=(2, d))])
    y = (rng.random(x.shape[:2]) < 0.5).astype(float)
    real = np.arange(len(x))[:, None] < sizes

    def loss():
        p = htmltext._sigmoid(net.forward(x, sizes))
        return -(np.log(np.where(y > 0, p, 1 - p)) * real).sum() / real.sum()

    g = net.gradient(x, sizes, y)
    for name in net.w:
        flat, i = net.w[name].ravel(), net.w[name].size // 2
        old = flat[i]
        flat[i] = old + 1e-5
        up = loss()
        flat[i] = old - 1e-5
        down = loss()
        flat[i] = old
        assert abs((up - down) / 2e-5 - g[name].ravel()[i]) < 1e-6


def test_odd_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (2, None, ""), (3, "u", "just words"), (None, "u", "<p>" * 5000 + "deep"),
            (4, "u", "<article><p>" + "many words " * 50_000 + "</p></article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    from pyspark.sql import functions as F
    got = htmltext.op6(df.withColumn("text", F.lit("clash")))
    assert got.count() == 6 and {r["text"] for r in got.filter("page_id < 3").collect()} == {""}
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert htmltext.op6(df.limit(0)).count() == 0


def test_sample_holds_different_pages(spark):
    rows = [("<p>the same page</p>",)] * 500 + [(f"<p>page {i}</p>",) for i in range(40)] + [("<p>" + "long " * 30_000,), ("",)]
    df = spark.createDataFrame(rows, "html string").repartition(5)
    every = htmltext.sampled(df, 1000)
    assert sorted(every) == sorted({r[0] for r in rows if len(r[0]) <= htmltext.SAMPLE_CHARS})
    assert htmltext.sampled(df, 7) == every[:7] == htmltext.sampled(df.coalesce(1), 7)
    assert htmltext.sampled(df.limit(0)) == []
