"""The corpus pipeline: stages over documents, each calling one operator of ``promptloom.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promptloom.llm import cotraining, minhash, packing, pii, quality_rules
from promptloom.storage import materialise


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject."""
    return cotraining.keep_good(docs, _labels(spark, sf_dir))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the learned decision list reject."""
    return quality_rules.keep_good(docs, _labels(spark, sf_dir))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: those that share four fifths of their five-word shingles."""
    return minhash.keep_first(docs, width=5)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data replaced by its kind."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 1024 ids."""
    return packing.pack(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality classifier", classify), ("quality rules", rules), ("minhash near-dedup", dedup), ("pii", private), ("packing", packed),
]
# Learned and neighbour-based decisions have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's rows written before the next one reads them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
