"""Rows in the shape of Spark's Kafka sink (``key``, ``value``, ``headers``).

The connector is a separate Spark package. Its sink repeats records when a batch is retried, so only
keyed topics, where a repeat replaces itself, may be fed by it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from quoteflow import rules
from quoteflow.operators import windows


def as_json(record: Column) -> Column:
    return F.to_json(record, {"ignoreNullFields": "false"})


def as_avro(record: Column) -> Column:
    """Needs Spark's Avro package."""
    from pyspark.sql.avro.functions import to_avro

    return to_avro(record)


def quote_requests(events: DataFrame, encode: Callable[[Column], Column] = as_json) -> DataFrame:
    """Quote events keyed by their job."""
    fields = [c for c in events.columns if c != "timestamp"]
    return events.select(F.col("job_id").alias("key"), encode(F.struct(*fields)).alias("value"))


def region_stats(stats: DataFrame, encode: Callable[[Column], Column] = as_json) -> DataFrame:
    """Totals keyed by region and window start."""
    return windows.keyed(stats).select("key", encode(F.struct(*stats.columns)).alias("value"))


def producer_options(brokers: str, topic: str) -> dict[str, str]:
    """A write counts only once every replica has it, and retries inside the producer do not repeat it."""
    return {
        "kafka.bootstrap.servers": brokers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.enable.idempotence": "true",
    }


def publish(rows: DataFrame, brokers: str, topic: str = rules.JOBS_TOPIC) -> None:
    writer = rows.write.format("kafka").options(**producer_options(brokers, topic))
    (writer.option("includeHeaders", "true") if "headers" in rows.columns else writer).save()


class KeyedTopic:
    """A topic as the sink of region totals: the newest record of a key counts, so repeats do no harm.

    ``send`` takes the rows; :func:`publish` is the one that writes to Kafka.
    """

    def __init__(self, send: Callable[[DataFrame], None], encode: Callable[[Column], Column] = as_json):
        self.send, self.encode = send, encode

    def upsert(self, rows: DataFrame, batch: int, writer: str = "main") -> None:
        self.send(region_stats(rows, self.encode))
