"""Per-region totals in tumbling event-time windows, the same for batch and streaming DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quoteflow import rules
from quoteflow.operators import scan


def region_totals(
    events: DataFrame, window: str = rules.WINDOW, grace: str | None = None, time: str = "timestamp"
) -> DataFrame:
    """Quote count, item count and gross cents per region and window ``[start, end)``.

    With ``grace`` the totals of a stream stay open that long after the window's end. The watermark
    is set here, on quote events only, so rejected messages never advance it. Few regions share all
    rows, but each task sends one partial row per region and window into the shuffle.
    """
    if grace is not None:
        events = events.withWatermark(time, grace)
    grouped = events.groupBy(F.window(time, window).alias("window"), "region").agg(
        F.count(F.lit(1)).alias("quote_count"),
        F.sum(F.col("item_count").cast("bigint")).alias("item_count"),
        F.sum("gross_amount_cents").alias("gross_amount_cents"),
    )
    return grouped.select(
        "region",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "quote_count",
        "item_count",
        "gross_amount_cents",
    )


def keyed(stats: DataFrame) -> DataFrame:
    """Add the sink key: region and the window start as an ISO instant."""
    # An ISO instant shows seconds, and a fraction only where there is one.
    start = F.date_format("window_start", "yyyy-MM-dd'T'HH:mm:ss")
    millis = F.date_format("window_start", "SSS")
    fraction = F.when(millis == "000", "").otherwise(F.concat(F.lit("."), millis))
    return stats.select(
        F.concat(F.col("region"), F.lit("@"), start, fraction, F.lit("Z")).alias("key"), *stats.columns
    )


def added(partials: DataFrame) -> DataFrame:
    """Totals per region and window from partial totals of disjoint sets of events."""
    sums = [F.sum(c).alias(c) for c in ("quote_count", "item_count", "gross_amount_cents")]
    return partials.groupBy("region", "window_start", "window_end").agg(*sums)


def judged_in_grace(
    events: DataFrame,
    arrival: list[str],
    window: str = rules.WINDOW,
    grace: str = rules.GRACE,
    time: str = "timestamp",
    partition: str | None = None,
    since: Column | None = None,
) -> DataFrame:
    """Add ``stream_time`` and ``late`` as a record-at-a-time stream would judge each event.

    Stream time is the largest event time seen so far (per ``partition`` if given, else overall), the
    event itself and what came before the first event (``since``) included. An event counts while its
    window's end is after stream time minus grace. ``arrival`` must order the rows totally.
    """
    by = [partition] if partition else []
    timed = scan.running(events, arrival, {"stream_time": ("max", F.col(time))}, by=by)
    if since is not None:
        timed = timed.withColumn("stream_time", F.greatest("stream_time", since))
    window_end = F.window(time, window)["end"]
    timed = timed.withColumn("_end", window_end)
    late = F.col("_end") <= F.col("stream_time") - F.expr(f"INTERVAL {grace}")
    return timed.withColumn("late", late).drop("_end")


def accepted_in_grace(
    events: DataFrame,
    arrival: list[str],
    window: str = rules.WINDOW,
    grace: str = rules.GRACE,
    time: str = "timestamp",
    partition: str | None = None,
) -> DataFrame:
    """Keep the events a record-at-a-time stream would keep, replayed exactly in arrival order."""
    return judged_in_grace(events, arrival, window, grace, time, partition).filter("not late").drop("late")
