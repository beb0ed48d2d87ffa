"""The corpus pipeline: from raw documents to packed training sequences.

Each stage works on all that its predecessor kept, written as Parquet and read again: quality rules
(failing lines and rejected documents go), n-gram Jaccard join (one document of each class stays),
benchmark decontamination (leaked passages go), secret scans (findings are replaced) and packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quoteflow.llm import benchmarks, near, packing, quality, secrets
from quoteflow.llm.common import stored, table
from quoteflow.llm.queries import default_tokenizer


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.clean(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return benchmarks.remove(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, default_tokenizer())


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("packing", pack),
]

# Tokens, similarity classes and linked secrets are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        if i:
            docs = stored(docs, "stage")
        docs = stage(spark, docs, sf_dir)
    return docs
