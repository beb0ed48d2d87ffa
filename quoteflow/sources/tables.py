"""Keyed lookups and committed reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quoteflow.sinks import tables
from quoteflow.sinks.tables import KeyedTable


def lookup(ids: DataFrame, table: DataFrame, key: str, now: Column | None = None) -> DataFrame:
    """Every requested id with its row and ``found``; expired rows count as not found."""
    live = tables.not_expired(table, now) if now is not None else table
    return ids.join(live.withColumn("_hit", F.lit(True)), key, "left").withColumn(
        "found", F.coalesce("_hit", F.lit(False))
    ).drop("_hit")


def lookup_stored(ids: DataFrame, table: KeyedTable, now: Column) -> DataFrame:
    """:func:`lookup` in a stored table by its key; reads the buckets and pages of few keys only."""
    (key,) = table.keys
    return lookup(ids, table.live(now, only=ids), key)


def committed(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Output of a streaming file sink.

    Spark lists the files through the sink's own commit log, so files of unfinished or failed
    batches are not seen.
    """
    if not streaming:
        return spark.read.parquet(path)
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
