"""Training-data pipeline over ``documents``: each stage calls one operator of ``skewsafe.llm``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from skewsafe.llm import packing, pii, quality, simhash, toxicity
from skewsafe.llm.common import ship_code, staged, table
from skewsafe.llm.registry import PACK_TOKENIZER, SURROGATE_KEY


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose lines are mostly content."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near fingerprints."""
    ship_code(spark)
    return simhash.deduplicated(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by surrogates."""
    return pii.with_surrogates(docs, SURROGATE_KEY)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents packed into sequences."""
    ship_code(spark)
    return packing.pack_documents(docs, public_tokenizers.path(PACK_TOKENIZER))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_low_quality),
    ("simhash", drop_near_duplicates),
    ("pii", replace_personal_data),
    ("packing", pack),
]

# Several stages are learned models and graph searches, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
