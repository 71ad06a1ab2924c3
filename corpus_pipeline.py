"""A training-data pipeline over ``documents``: quality classifier, near-duplicate
removal, secret redaction, source mixing, packing into token windows.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.llm import mixing, packing, quality, secret_scan, simhash
from rankforge.llm.common import table, unused
from rankforge.storage import materialize


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    score = unused(docs, "score")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score_documents(docs, model, score).where(F.col(score) >= 0.3).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.one_of_each(docs)


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of every secret."""
    spans = unused(docs, "spans")
    found = secret_scan.scan(docs, name=spans)
    cleaned = found.withColumn("text", F.when(
        F.col("text").isNotNull(), secret_scan.redact(F.col("text"), F.col(spans))))
    if "n_chars" in docs.columns:
        touched = F.size(spans) > 0
        cleaned = cleaned.withColumn("n_chars", F.when(
            touched, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return cleaned.select(*docs.columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.copied(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1024 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_redaction),
    ("source_mixing", source_mixing),
    ("packing", pack),
]

# Trained models, fingerprints of hashes and tokenizers have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
