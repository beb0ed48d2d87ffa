"""Fan-out of messages to rows and the projections written to the event sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quoteflow import rules


def quote_events(checked: DataFrame) -> DataFrame:
    """One row per quote of every valid message, carrying the message's own event time."""
    valid = checked.filter("error is null")
    return valid.select("timestamp", F.explode("events").alias("event")).select(
        "event.*", "timestamp"
    )


def dead_letters(checked: DataFrame, topic: str = rules.JOBS_TOPIC) -> DataFrame:
    """Rejected messages with their original key and payload, the reason and where they came from."""
    headers = F.array(
        F.struct(
            F.lit(rules.ERROR_HEADER).alias("key"), F.encode("error", "UTF-8").alias("value")
        ),
        F.struct(
            F.lit(rules.SOURCE_TOPIC_HEADER).alias("key"),
            F.encode(F.lit(topic), "UTF-8").alias("value"),
        ),
    )
    return checked.filter("error is not null").select("key", "value", headers.alias("headers"))


def header_text(name: str) -> F.Column:
    """Text of the first header called ``name``."""
    matching = F.filter("headers", lambda h: h["key"] == name)
    return F.decode(F.get(matching, F.lit(0))["value"], "UTF-8")


def outcomes(checked: DataFrame, topic: str = rules.JOBS_TOPIC) -> DataFrame:
    """Both branches as one row set, so a stream can write them in a single exactly-once sink.

    A valid message gives one ``request`` row per quote, an invalid one a single ``dead_letter`` row.
    """
    rows = checked.withColumn("event", F.explode_outer("events"))
    return rows.select(
        F.when(F.col("error").isNull(), "request").otherwise("dead_letter").alias("outcome"),
        "key",
        F.when(F.col("error").isNotNull(), F.col("value")).alias("value"),
        "error",
        F.when(F.col("error").isNotNull(), F.lit(topic)).alias("source_topic"),
        "timestamp",
        "event.*",
    )


def line_rows(priced: DataFrame, keys: list[str]) -> DataFrame:
    """Line items of priced quotes as rows, in their original order (``line`` counts from 0)."""
    return priced.select(*keys, F.posexplode("line_items").alias("line", "item")).select(
        *keys, "line", "item.*"
    )
