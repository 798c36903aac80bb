"""The corpus pipeline: language, near copies, benchmark passages, personal data, and the mix of sources."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from clickmart.llm import decontamination, language_id, mixing, ngram_join, pii
from clickmart.operators.materialize import checkpoint_root

SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_EPOCHS = 2.0


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language, with the language found where none is given; texts that the model rejects go."""
    return language_id.keep_known(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is linked by five-word shingles with a similarity of 0.8 or more."""
    return ngram_join.keep_one(docs, SHINGLE_WORDS, SIMILAR_PERCENT)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document: doc_id, source, size, source_size, target, taken."""
    return mixing.mix(docs, WEIGHTS, SHARE, MOST_EPOCHS)


STAGES = [
    ("language_id", languages),
    ("ngram_jaccard", near_copies),
    ("decontamination", benchmark_passages),
    ("pii", personal_data),
    ("mixing", mix_sources),
]

# A trained model decides in the first stage, which SQL cannot express; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = f"{checkpoint_root(spark)}/pipeline-{uuid.uuid4().hex}/{name}"
            docs.write.parquet(path)
            docs = spark.read.schema(docs.schema).parquet(path)
    return docs
