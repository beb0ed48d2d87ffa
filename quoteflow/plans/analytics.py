"""Queries of the analytics path: validation, dead letters, quote events, region windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quoteflow import session
from quoteflow.operators import fanout, parse, windows
from quoteflow.plans import inputs, sql


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.validated(inputs.job_messages(spark, sf_dir))


def validate_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(spark, sf_dir).select(
        "key", F.col("error").isNull().alias("valid"), "error", F.size("events").alias("events")
    )


def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    dead = fanout.dead_letters(_checked(spark, sf_dir))
    return dead.select(
        "key",
        fanout.header_text("dlq.error").alias("reason"),
        fanout.header_text("dlq.source.topic").alias("source_topic"),
        F.size("headers").alias("headers"),
    )


def dead_letters_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    dead = fanout.dead_letters(_checked(spark, sf_dir))
    return dead.groupBy(fanout.header_text("dlq.error").alias("reason")).agg(
        F.count(F.lit(1)).alias("messages")
    )


def quote_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fanout.quote_events(_checked(spark, sf_dir)).drop("timestamp")


def region_minute_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = windows.region_totals(fanout.quote_events(_checked(spark, sf_dir)))
    return windows.keyed(stats).select(
        "key", "region", "quote_count", "item_count", "gross_amount_cents"
    )


def late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quote events with an arrival order that differs from event order by up to two hours."""
    events = fanout.quote_events(_checked(spark, sf_dir))
    number = F.substring("job_id", 5, 20).cast("bigint")
    minutes = (number * 37 % 120).cast("int")
    delay = F.make_dt_interval(mins=minutes)
    return events.withColumns({"arrived": F.col("timestamp") + delay, "number": number})


def region_totals_with_grace(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The replay sorts its input, which reads it twice; the events are written so as to parse once.
    events = session.durable(late_events(spark, sf_dir), "late-events")
    kept = windows.accepted_in_grace(
        events, ["arrived", "number", "position"], "1 hour", "30 minutes"
    )
    return windows.keyed(windows.region_totals(kept, "1 hour")).select(
        "key", "region", "quote_count", "item_count", "gross_amount_cents"
    )


QUERIES = {
    "validate_jobs": validate_jobs,
    "dead_letters": dead_letters,
    "dead_letters_by_reason": dead_letters_by_reason,
    "quote_requests": quote_requests,
    "region_minute_totals": region_minute_totals,
    "region_totals_with_grace": region_totals_with_grace,
}

_STATS = """
SELECT region || '@' || strftime(w, '%Y-%m-%dT%H:%M:%SZ') AS key, region,
       count(*) AS quote_count, CAST(sum(item_count) AS BIGINT) AS item_count,
       CAST(sum(gross_amount_cents) AS BIGINT) AS gross_amount_cents
FROM {source} GROUP BY region, w"""

_ARRIVAL = """
arrival AS (
  SELECT *, date_trunc('hour', ts) AS w,
    max(ts) OVER (ORDER BY ts + to_minutes(e * 37 % 120), e, position
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stream_time
  FROM quote_event
)"""

LATE_ROWS = sql.with_inputs(
    sql.CHECKED + "," + _ARRIVAL,
    """SELECT job_id, position, region, gross_amount_cents FROM arrival
       WHERE w + INTERVAL 1 HOUR <= stream_time - INTERVAL 30 MINUTE""",
)

# Lateness as Spark judges it: by the largest event time of the batches before.
REGION_UPDATES = sql.with_inputs(
    sql.CHECKED
    + """,
arrived AS (SELECT *, date_trunc('hour', ts) AS w, epoch_us(ts + to_minutes(e * 37 % 120)) AS came FROM quote_event),
span AS (SELECT min(came) AS first, greatest(1, (max(came) - min(came)) // 5 + 1) AS span FROM arrived),
batched AS (SELECT a.*, (a.came - s.first) // s.span AS batch FROM arrived a, span s),
tops AS (SELECT batch, max(ts) AS top FROM batched GROUP BY batch),
marks AS (SELECT b.batch, max(t.top) - INTERVAL 30 MINUTE AS mark FROM tops b LEFT JOIN tops t ON t.batch < b.batch GROUP BY b.batch),
judged AS (SELECT b.*, coalesce(w + INTERVAL 1 HOUR <= mark, false) AS late FROM batched b JOIN marks USING (batch)),
kept AS (SELECT * FROM judged WHERE NOT late)""",
    _STATS.format(source="kept").strip()
    + """
UNION ALL SELECT 'dropped', NULL, count(*), NULL, NULL FROM (SELECT DISTINCT batch, region, w FROM judged WHERE late)""",
)

ORACLE = {
    "validate_jobs": sql.with_inputs(
        sql.CHECKED,
        """SELECT job_id AS key, error IS NULL AS valid, error,
                  CASE WHEN error IS NULL THEN CAST(nq AS INTEGER) ELSE 0 END AS events
           FROM checked""",
    ),
    "dead_letters": sql.with_inputs(
        sql.CHECKED,
        """SELECT job_id AS key, error AS reason, 'quote-jobs' AS source_topic, 2 AS headers
           FROM checked WHERE error IS NOT NULL""",
    ),
    "dead_letters_by_reason": sql.with_inputs(
        sql.CHECKED,
        """SELECT error AS reason, count(*) AS messages FROM checked
           WHERE error IS NOT NULL GROUP BY error""",
    ),
    "quote_requests": sql.with_inputs(
        sql.CHECKED,
        """SELECT job_id, position, region, item_count, gross_amount_cents, coupon
           FROM quote_event""",
    ),
    "region_minute_totals": sql.with_inputs(
        sql.CHECKED,
        _STATS.format(source="(SELECT *, date_trunc('minute', ts) AS w FROM quote_event)"),
    ),
    "region_totals_with_grace": sql.with_inputs(
        sql.CHECKED
        + ","
        + _ARRIVAL
        + """,
kept AS (SELECT * FROM arrival WHERE w + INTERVAL 1 HOUR > stream_time - INTERVAL 30 MINUTE)""",
        _STATS.format(source="kept"),
    ),
}
