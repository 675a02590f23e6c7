"""The corpus from raw documents to packed sequences, in five stages.

Every stage works on all that the stage before kept; its result is written and
read again before the next begins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallymill.llm import exact_dedup, ngram_join, packing, pii, quality
from tallymill.llm.common import table
from tallymill.llm.queries import TOKENIZER
from tallymill.session import stored


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed quality rules keep."""
    return quality.keep_good(docs)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the largest id."""
    return exact_dedup.drop_exact_copies(docs)


def unlike_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return ngram_join.drop_near_copies(docs)


def masked_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.mask_personal(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids and their places in sequences."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("quality_rules", good_documents),
    ("exact_dedup", distinct_documents),
    ("near_dedup", unlike_documents),
    ("personal_data", masked_documents),
    ("packing", packed_sequences),
]

#: The trained segment model and the linear program are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
