import corpus_pipeline
from pyspark.sql import functions as F

from tests.llm.test_nearcopies import kept
from tillwise.llm import mixing, packing, secrets, toxicity

SF = "/root/testdata/sf0.001"


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "secrets", "mixing", "packing"]


def test_every_stage_takes_effect(spark, folder):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)

    def apply(name, df):
        steps[name](spark, df, SF).write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    clean = apply("toxicity", docs)
    rejected = {r["doc_id"] for r in toxicity.op8(spark, SF).filter("predicted = 1").collect()}
    ids = {r["doc_id"] for r in clean.collect()}
    assert clean.columns == docs.columns and ids == {r["doc_id"] for r in docs.collect()} - rejected

    single = apply("simhash", clean)
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(kept((r["doc_id"], r["text"]) for r in clean.collect()))
    assert single.columns == docs.columns

    masked = apply("secrets", single)
    assert masked.columns == docs.columns and masked.count() == single.count()
    spans = {r["doc_id"]: r["spans"] for r in secrets.op9(single).collect()}
    before = {r["doc_id"]: r["text"] for r in single.collect()}
    for r in masked.collect():
        assert (r["text"] == before[r["doc_id"]]) == (spans[r["doc_id"]] == "") and r["n_chars"] == len(r["text"])
    assert secrets.op9(masked).agg(F.sum("n_assign") + F.sum("n_access") + F.sum("n_hex")).first()[0] == 0

    mixed = apply("mixing", masked)
    want = {r["doc_id"]: r["taken"] for r in mixing.op4(masked).collect() if r["taken"]}
    got = mixed.groupBy("doc_id").agg(F.sum(mixing.word_count()).alias("n")).collect()
    assert mixed.columns == docs.columns and {r["doc_id"]: r["n"] for r in got} == want

    packed = apply("packing", mixed)
    direct = packing.op5(mixed)
    assert sorted(map(tuple, packed.collect())) == sorted(map(tuple, direct.collect()))


def test_run_and_odd_documents(spark, odd, empty):
    assert corpus_pipeline.run(spark, SF).count() > 0
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, empty, SF).count() == 0
    kept = odd
    for name, step in corpus_pipeline.STAGES[:-1]:
        kept = step(spark, kept, SF)
        assert kept.columns == odd.columns, name
    assert corpus_pipeline.STAGES[-1][1](spark, kept, SF).count() > 0
