"""A training corpus from documents: language, near-duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's documents. All but the last keep
the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listwright.llm import langid, packing, pii, simhash
from listwright.session import bounded_batches, scratch_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in no known language: those no language explains better than chance, and those without letters.

    Without any labelled document there is no model and all documents stay.
    """
    bounded_batches(spark)
    model = langid.train(docs)
    if model.languages == [langid.NONE]:
        return docs
    found = langid.identify(docs, model, **langid.document_evidence(docs), language="_language", confidence="_confidence")
    return found.where(F.col("_language") != langid.NONE).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each near-duplicate group.

    Documents without a doc_id stay only where their group has no other, then
    one of them.
    """
    bounded_batches(spark)
    return simhash.keep_first(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts marks in place of personal data; n_chars follows the text."""
    return pii.redact(docs).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 tokens."""
    bounded_batches(spark)
    return packing.pack_texts(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("pack", pack)]

# Language models, fingerprints and tokens are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
