"""The job topic as a DataFrame: from Kafka, or replayed from files with the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quoteflow import rules, schemas, session


def kafka_options(brokers: str, topic: str = rules.JOBS_TOPIC, committed_only: bool = True) -> dict[str, str]:
    """Options of a reader that starts at the earliest record and sees committed records only."""
    return {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "includeHeaders": "true",
        "kafka.isolation.level": "read_committed" if committed_only else "read_uncommitted",
    }


def from_kafka(spark: SparkSession, brokers: str, topic: str = rules.JOBS_TOPIC, streaming: bool = True) -> DataFrame:
    """Needs Spark's Kafka package. Every query has its own checkpoint and so its own position."""
    reader = session.prepare(spark).readStream if streaming else session.prepare(spark).read
    rows = reader.format("kafka").options(**kafka_options(brokers, topic)).load()
    return rows.select(
        F.col("key").cast("string"),
        F.col("value").cast("string"),
        "timestamp",
        "topic",
        "partition",
        "offset",
        "headers",
    )


def replay(
    spark: SparkSession,
    path: str,
    streaming: bool = True,
    files_per_batch: int | None = None,
    file_format: str = "parquet",
) -> DataFrame:
    """A folder of message files, oldest file first; a column the files lack is null."""
    reader = session.prepare(spark).readStream if streaming else session.prepare(spark).read
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.schema(schemas.MESSAGE).format(file_format).load(path)
