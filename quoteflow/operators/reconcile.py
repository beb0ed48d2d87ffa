"""End-to-end checks of a sink against what was accepted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from quoteflow.operators import fanout
from quoteflow.sinks import tables


def totals(accepted: DataFrame, stored: DataFrame, minimum: int = 0) -> DataFrame:
    """Accepted quote events against the stored sum of ``quote_count``, as one row with a verdict."""
    sides = accepted.select(F.lit(1).cast("bigint").alias("accepted"), F.lit(0).cast("bigint").alias("stored"))
    sides = sides.unionByName(
        stored.select(F.lit(0).cast("bigint").alias("accepted"), F.col("quote_count").alias("stored"))
    )
    both = sides.agg(
        F.coalesce(F.sum("accepted"), F.lit(0)).alias("accepted"),
        F.coalesce(F.sum("stored"), F.lit(0)).alias("stored"),
    )
    return both.withColumns(
        {
            "complete": F.col("accepted") == F.col("stored"),
            "enough": F.col("accepted") >= minimum,
        }
    )


def ledger(accepted: DataFrame, batch: Column, schema: T.StructType) -> DataFrame:
    """``batch``, ``rows`` and ``checksum`` of what was accepted, to hold against a table's ledger."""
    return accepted.groupBy(batch.cast("long").alias("batch")).agg(
        F.count(F.lit(1)).alias("rows"), tables.checksum(schema).alias("checksum")
    )


def ledgers(accepted: DataFrame, stored: DataFrame) -> DataFrame:
    """Batches whose entries differ, with a verdict; only the ledgers are read, no rows.

    A repeated row leaves the checksum when it comes twice, so a doubled batch has twice the rows and
    the checksum of none.
    """
    both = accepted.select("batch", F.col("rows").alias("accepted"), F.col("checksum").alias("_a")).join(
        stored.groupBy("batch").agg(F.sum("rows").alias("stored"), F.bit_xor("checksum").alias("_s")), "batch", "full"
    )
    none = F.coalesce("stored", F.lit(0)) == 0
    verdict = (
        F.when(F.col("accepted").isNull(), F.when(~none, "unexpected"))
        .when(none, "missing")
        .when((F.col("stored") == 2 * F.col("accepted")) & (F.col("_s") == 0), "doubled")
        .when((F.col("stored") != F.col("accepted")) | (F.col("_s") != F.col("_a")), "changed")
    )
    count = [F.coalesce(c, F.lit(0)).alias(c) for c in ("accepted", "stored")]
    return both.select("batch", verdict.alias("verdict"), *count).filter("verdict is not null")


def region_gross(stored: DataFrame, region: str, at_least: int) -> DataFrame:
    """Grand total of one region, 0 when it has no rows."""
    total = stored.filter(F.col("region") == region).agg(
        F.coalesce(F.sum("gross_amount_cents"), F.lit(0)).alias("gross_amount_cents")
    )
    return total.select(
        F.lit(region).alias("region"),
        "gross_amount_cents",
        (F.col("gross_amount_cents") >= at_least).alias("ok"),
    )


def has_reason(dead_letters: DataFrame, reason: str) -> DataFrame:
    """Whether some dead letter carries exactly this reason."""
    matching = F.count_if(fanout.header_text("dlq.error") == reason)
    return dead_letters.agg(matching.alias("messages")).select(
        F.lit(reason).alias("reason"), "messages", (F.col("messages") > 0).alias("found")
    )


def dump(stored: DataFrame) -> DataFrame:
    return stored.orderBy("window_start", "region")
