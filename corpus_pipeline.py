"""From raw documents to packed training sequences; each stage calls one operator of feedfold.llm."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedfold.llm import lines, neardup, packing, quality, secrets
from feedfold.llm.common import landed, table
from feedfold.llm.queries import WORD_BPE


def measured(docs: DataFrame) -> DataFrame:
    """The length of a text follows its changes."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed quality rules accept."""
    return quality.keep_good(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of runs of 50 words and more go; documents that were nothing else go, too."""
    shorter = lines.dedup(docs)
    deleted = F.col(shorter.columns[-1])
    return measured(shorter.where((deleted == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(*docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8)."""
    return neardup.dedup(docs, k=5, percent=80)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are masked."""
    return measured(secrets.redact(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their ids and places in sequences of 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path(WORD_BPE), end_id=2)


STAGES = [
    ("quality_rules", keep_quality),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("secret_scans", mask_secrets),
    ("packing", pack_sequences),
]

#: Expectation-maximisation, graph components and tokenisation have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over the table of documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = landed(stage(spark, docs, sf_dir), name)
    return docs
