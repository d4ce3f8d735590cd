"""The registered queries of this package and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listwright.llm import bpe, hard_negatives, langid, packing, pii, quality_rules, runs, secret_scan, sharding, simhash, spotsigs, token_counts, topk


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_bpe() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), byte_bpe())


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_texts(table(spark, sf_dir, "documents"), byte_bpe(), cached=600_000)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.train(docs), **langid.document_evidence(docs))
    return found.select("doc_id", "language", "confidence")


def page_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language identification with all kinds of evidence, over raw pages."""
    pages = langid.page_evidence(table(spark, sf_dir, "pages"))
    evidence = {c: F.col(c) for c in ("host", "domain", "declared", "suffix")}
    found = langid.identify(pages, langid.train(table(spark, sf_dir, "documents")), **evidence)
    return found.select("page_id", "host", "declared", "language", "confidence")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), byte_bpe())


SHARDS = [f"shard-{i:02d}" for i in range(64)]


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.place(table(spark, sf_dir, "documents"), "doc_id", SHARDS)
    return placed.select("doc_id", "slot", "shard")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.summary(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.summary(table(spark, sf_dir, "documents"))


def op9_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.edited_likeness(table(spark, sf_dir, "documents"))


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digests(runs.planted(table(spark, sf_dir, "documents")))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    relabelled = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine(relabelled, F.col("vec_id") % 50 == 0)


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.summary(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_bpe, op2_packing, op3_language_id, page_languages, op4_token_counts, op5_sharding, op6_secrets, op7_simhash, op8_pii, op9_spotsigs, op10_topk, op11_runs, op12_hard_negatives, op13_quality)}

ORACLE: dict[str, str] = {
    # the lookup table is stated; the placement is worked out from the keys
    "op5_sharding": f"""
        WITH t AS (SELECT string_split('{','.join(map(str, sharding.lookup_table(SHARDS)))}', ',') AS shards),
             d AS (SELECT doc_id, ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT % {sharding.SIZE} AS slot FROM documents)
        SELECT doc_id, slot, shards[slot + 1]::INTEGER AS shard FROM d, t
    """,
    "op10_topk": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
                   WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
        SELECT q.vec_id AS query_id, (row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(q.e, p.e) DESC, p.vec_id))::INTEGER AS rank,
               p.vec_id AS vec_id, list_dot_product(q.e, p.e)::BIGINT AS score
        FROM v q JOIN v p ON q.vec_id % 50 = 0 AND p.vec_id <> q.vec_id
        QUALIFY rank <= 5
    """,
    "op12_hard_negatives": hard_negatives.ORACLE,
    "op13_quality": quality_rules.oracle(),
}
