"""Registered queries of the pipeline operators, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skewsafe.llm import bpe, embeddings, filter_audit, nnls_packing, packing, phrases, pii, quality, sharding, simhash, sql, token_counts, toxicity, url_filter
from skewsafe.llm.common import table

# Production parameters.
PACK_TOKENIZER = "word_bpe_49k.json"
SURROGATE_KEY = "skewsafe"
COUNT_TOKENIZER = "byte_bpe_50k.json"
RANK_FILE = "byte_bpe_multi_50k.tiktoken"


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(PACK_TOKENIZER))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 contiguous shards of near equal bytes."""
    placed = sharding.shard_by_bytes(sharding.sized(table(spark, sf_dir, "documents")))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with personal data replaced by surrogates."""
    return pii.with_surrogates(table(spark, sf_dir, "documents"), SURROGATE_KEY)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents whose fingerprints differ by at most 3 bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and CRF verdict of every document."""
    return quality.judge_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, components and kept rows of all embeddings at cosine 0.9."""
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; labels of held-out rows are never learned."""
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url.

    ``pages`` carries no labels of its own: the row of ``labels`` with the page's
    number is its outcome (bad: low quality or toxic).
    """
    bad = F.greatest(1 - F.col("quality"), F.col("toxic"))
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    judged = url_filter.judge_pages(table(spark, sf_dir, "pages"), outcomes)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every document by overlap resynchronisation."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(COUNT_TOKENIZER))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document with the local rank file."""
    return bpe.encode_decode(
        table(spark, sf_dir, "documents"), public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders of the five filters over all documents, by part."""
    return filter_audit.audit_filters(spark, f"{sf_dir.rstrip('/')}/documents.parquet", table(spark, sf_dir, "labels"))


def op12_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into windows of 2048 tokens by non-negative least squares."""
    return nnls_packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(PACK_TOKENIZER))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of each language over all documents."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_sharding": op2_sharding,
    "op3_pii": op3_pii,
    "op4_simhash": op4_simhash,
    "op5_quality": op5_quality,
    "op6_embeddings": op6_embeddings,
    "op7_toxicity": op7_toxicity,
    "op8_url_filter": op8_url_filter,
    "op9_token_counts": op9_token_counts,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_filter_audit": op11_filter_audit,
    "op12_nnls_packing": op12_nnls_packing,
    "op13_phrases": op13_phrases,
}

ORACLE_SQL: dict[str, str] = {**sql.ORACLE_SQL}
