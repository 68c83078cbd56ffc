"""Corpus pipeline: language, exact copies, near copies, secrets, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs.  All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regmine.llm import dedup, jaccard, langid, packing, secrets
from regmine.llm.common import tokenizer_path, write_shared


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts that the language model rejects (no letter, or too far from
    every centroid)."""
    return langid.drop_rejected(docs, langid.train(docs, F.lit(True)))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the smallest doc_id stays."""
    return jaccard.drop_near_copies(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reported secrets are masked; every document stays."""
    return secrets.redact_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the kept documents in sequences of 1024 ids."""
    return packing.pack_documents(docs, tokenizer_path(), capacity=1024, end_id=2)


STAGES = [
    ("language", keep_known_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("secrets", redact_secrets),
    ("packing", pack),
]

#: SQL has no tokenizer and no language model; the stages are tested against
#: brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = write_shared(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
