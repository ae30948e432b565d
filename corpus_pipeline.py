"""A corpus pipeline of five operators: documents in, a training mix out.

Toxic documents go; of each class of near-duplicates one document stays;
documents that hold a benchmark window go; secrets are replaced in the texts;
sources are mixed to their target weights, each document as often as it is
taken. Every stage but the last returns the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quillspark.llm import decontamination, minhash, mixing, secrets, toxicity
from quillspark.llm.common import read, scratch, scratch_dir


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, read(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without_contaminated(docs, read(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.emitted(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", decontaminate),
    ("secret_scan", redact),
    ("source_mixing", mix_sources),
]

# Kernel machines, signatures and decoding are beyond SQL. Tests hold each stage against its operator, and the operators against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of sf_dir's documents; what each stage leaves is written to the shared folder and read again, scratch tables of a stage are removed after it."""
    base = f"{scratch_dir(spark)}/quillspark/pipeline-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = f"{base}/{name}"
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
