"""A training corpus from documents: clean, deduplicate, mask, mix and pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read
again as the next one's documents. All but the last keep the documents' columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm import mixing, nearcopies, packing, secrets, toxicity
from tillwise.llm.common import prepare, stage, table


def _measured(docs: DataFrame) -> DataFrame:
    """Lengths that follow the changed texts."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else docs


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score rejects go; it learns from the table ``labels``."""
    prepare(spark)
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts at 0.8 or more of five-word shingles one document stays, that of the smallest id."""
    prepare(spark)
    return nearcopies.drop_near_copies(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in its text are replaced by a mark."""
    prepare(spark)
    return _measured(secrets.mask_secrets(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, the last time perhaps in part."""
    prepare(spark)
    return _measured(mixing.take_mix(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids in sequences of 2048; see ``packing.op5``."""
    prepare(spark)
    return packing.pack(packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"))).select(
        F.col("id").alias("doc_id"), "start", "length", F.col("crc").alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: Models, hashes and tokenizers are beyond SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
