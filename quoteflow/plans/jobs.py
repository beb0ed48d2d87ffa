"""Queries of the job path: summaries, redelivery, state after a batch, keyed upserts, expiry."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from quoteflow import session
from quoteflow.operators import contract, jobs
from quoteflow.plans import inputs, pricing, sql
from quoteflow.sinks import tables
from quoteflow.sinks.tables import KeyedTable

_NOW = "2024-01-20 00:00:00"


def job_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, done = jobs.run(pricing.checked_messages(spark, sf_dir))
    return done.select(
        "job_id", "status", "total_requests", F.concat_ws(",", "quote_ids").alias("quote_ids")
    )


def pending_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = pricing.checked_messages(spark, sf_dir)
    submitted = checked.filter(F.col("job_id").isNotNull() & F.col("quotes").isNotNull())
    return jobs.pending(submitted).select(
        "job_id", "status", "total_requests", F.size("quote_ids").alias("quotes"), "error"
    )


def _redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.redelivered(inputs.job_messages(spark, sf_dir))


def _states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.job_states(inputs.events(spark, sf_dir))


def redelivery_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages left to work on: those of jobs that are not done yet."""
    messages = _redelivered(spark, sf_dir).withColumnRenamed("key", "job_id")
    left = jobs.skip_done(messages, _states(spark, sf_dir))
    return left.select("job_id", "offset")


def poison_of_known_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs on record that received an invalid payload."""
    checked = pricing.checked_messages(spark, sf_dir)
    poison = checked.filter(F.col("job_id").isNotNull() & F.col("quotes").isNull())
    known = jobs.of_known_jobs(poison, _states(spark, sf_dir))
    return known.select("job_id", F.lit("invalid job payload").alias("error"))


def job_status_after_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of every job after the worker has applied all messages to the jobs on record."""
    states = _states(spark, sf_dir)
    checked = contract.check_messages(_redelivered(spark, sf_dir))
    _, changed = jobs.settled(jobs.decide(checked, states))
    rows = states.withColumn("write", F.lit(0)).unionByName(changed.withColumn("write", F.lit(1)))
    after = tables.latest_by(rows, ["job_id"], F.col("write"))
    return after.select(
        "job_id", "status", "total_requests", F.size("quote_ids").alias("quotes"), "error"
    )


def job_message_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What becomes of every delivered message; their number is that of the messages."""
    checked = contract.check_messages(_redelivered(spark, sf_dir))
    rows = jobs.message_outcomes(checked, _states(spark, sf_dir))
    return rows.select("offset", "outcome", "reason")


def job_quotes_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job's quotes read back by the ids listed in the job."""
    # Both sides of the join come from the messages, which are parsed once and stored.
    valid = pricing.checked_messages(spark, sf_dir).filter(F.col("job_id").isNotNull() & F.col("quotes").isNotNull())
    quotes, done = jobs.run(session.durable(valid.select("job_id", "timestamp", "quotes"), "valid-jobs"))
    rows = jobs.ordered_quotes(done, quotes)
    return rows.select("job_id", "position", "id", F.col("total").cast("string").alias("total"))


def _quote_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated writes of the same quote ids, one per event."""
    raw = inputs.events(spark, sf_dir)
    return raw.select(
        F.concat(F.lit("q-"), F.col("u"), F.lit("-"), F.col("t")).alias("id"),
        F.col("p").cast("string").alias("total"),
        F.col("timestamp").alias("written_at"),
        F.col("e").alias("version"),
    )


def latest_quote_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches of writes, each with several of a key, upserted into a stored table."""
    writes = session.durable(_quote_writes(spark, sf_dir), "quote-writes")
    table = KeyedTable(
        spark,
        session.scratch_path(spark, "latest-quotes"),
        writes.select("id", "total", "version").schema,
        ["id"],
    ).create()
    last = writes.agg(F.max("version")).first()[0] or 0
    for batch in range(3):
        rows = writes.filter(F.floor(F.col("version") * 3 / (last + 1)) == batch)
        table.upsert(rows, batch, order=F.col("version"))
    return table.latest()


def ttl_live_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest quotes that have not expired seven days after their last write."""
    rows = tables.latest_by(_quote_writes(spark, sf_dir), ["id"], F.col("version"))
    stored = tables.with_expiry(rows, F.col("written_at"))
    live = tables.not_expired(stored, F.lit(_NOW).cast("timestamp"))
    return live.select("id", "total", "version")


def ttl_purge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes written in three batches; what has expired is taken away by days, no live row is rewritten."""
    writes = session.durable(tables.with_expiry(_quote_writes(spark, sf_dir), F.col("written_at")), "quote-writes")
    columns = writes.select("id", "total", "version", tables.EXPIRES)
    table = KeyedTable(spark, session.scratch_path(spark, "ttl-quotes"), columns.schema, ["id"]).create()
    last = writes.agg(F.max("version")).first()[0] or 0
    for batch in range(3):
        rows = columns.filter(F.floor(F.col("version") * 3 / (last + 1)) == batch)
        table.upsert(rows, batch, order=F.col("version"))
    session.discard(writes)
    now = datetime.fromisoformat(_NOW)
    table.purge(now)
    table.vacuum()
    return table.live(F.lit(_NOW).cast("timestamp")).select("id", "total", "version")


QUERIES = {
    "ttl_purge": ttl_purge,
    "job_summary": job_summary,
    "pending_jobs": pending_jobs,
    "redelivery_skip": redelivery_skip,
    "poison_of_known_jobs": poison_of_known_jobs,
    "job_status_after_batch": job_status_after_batch,
    "job_message_outcomes": job_message_outcomes,
    "job_quotes_in_order": job_quotes_in_order,
    "latest_quote_upsert": latest_quote_upsert,
    "ttl_live_quotes": ttl_live_quotes,
}

_LATEST = """
writes AS (
  SELECT 'q-' || user_id || '-' || event_type AS id, CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR) AS total,
         ts, event_id AS version FROM events
),
latest AS (
  SELECT * FROM writes QUALIFY row_number() OVER (PARTITION BY id ORDER BY version DESC) = 1
)"""

_BATCH = (
    sql.CONTRACT_VALID
    + """,
state AS (
  SELECT e, CASE WHEN e % 7 = 0 THEN 'done' WHEN e % 3 = 1 THEN 'pending' END AS was, nq
  FROM (SELECT event_id AS e, event_id % 3 + 1 AS nq FROM events)
),
judged AS (
  SELECT s.e, s.was, s.nq, v.e IS NOT NULL AS valid, r.e IS NOT NULL AS readable
  FROM state s LEFT JOIN valid_job v ON v.e = s.e LEFT JOIN readable r ON r.e = s.e
)"""
)

WORKER_SNAPSHOT = sql.with_inputs(
    _BATCH,
    """SELECT 'submitted' AS version, 'job-' || e AS job_id, was AS status, 0::BIGINT AS listed, 0::BIGINT AS stored,
         0::BIGINT AS messages FROM judged WHERE was IS NOT NULL
       UNION ALL
       SELECT 'worked', 'job-' || e,
         CASE WHEN was = 'done' OR valid THEN 'done' WHEN readable AND was IS NOT NULL THEN 'failed' ELSE was END,
         CAST(CASE WHEN was IS DISTINCT FROM 'done' AND valid THEN nq ELSE 0 END AS BIGINT),
         CAST(CASE WHEN was IS DISTINCT FROM 'done' AND valid THEN nq ELSE 0 END AS BIGINT),
         CAST(CASE WHEN readable THEN 1 ELSE 0 END AS BIGINT)
       FROM judged WHERE was IS NOT NULL OR valid OR readable""",
)

REDELIVERY = sql.with_inputs(
    _BATCH,
    """SELECT e AS message,
         CASE WHEN NOT readable THEN 'dead_letter' WHEN was = 'done' THEN 'skipped' WHEN valid THEN 'done'
           WHEN was IS NOT NULL THEN 'failed' ELSE 'dead_letter' END AS outcome,
         CASE WHEN NOT readable THEN 'no readable job id'
           WHEN was IS DISTINCT FROM 'done' AND NOT valid THEN 'invalid job payload' END AS reason
       FROM judged
       UNION ALL
       SELECT NULL, 'redelivered', CAST(count(*) AS VARCHAR) FROM events WHERE event_id % 10 = 0""",
)

ORACLE = {
    "job_summary": sql.with_inputs(
        sql.PRICED,
        """SELECT job_id, 'done' AS status, CAST(count(*) AS INTEGER) AS total_requests,
             string_agg(id, ',' ORDER BY position) AS quote_ids FROM priced GROUP BY job_id""",
    ),
    "pending_jobs": sql.with_inputs(
        sql.CONTRACT_VALID,
        """SELECT job_id, 'pending' AS status, CAST(nq AS INTEGER) AS total_requests, 0 AS quotes,
             CAST(NULL AS VARCHAR) AS error FROM valid_job""",
    ),
    "redelivery_skip": """
        WITH delivered AS (
          SELECT event_id AS e, event_id AS "offset" FROM events
          UNION ALL SELECT event_id, event_id + 1000000000000 FROM events WHERE event_id % 10 = 0)
        SELECT 'job-' || e AS job_id, "offset" FROM delivered WHERE e % 7 <> 0""",
    "poison_of_known_jobs": sql.with_inputs(
        _BATCH,
        """SELECT 'job-' || e AS job_id, 'invalid job payload' AS error
           FROM judged WHERE was IS NOT NULL AND readable AND NOT valid""",
    ),
    "job_status_after_batch": sql.with_inputs(
        _BATCH,
        """SELECT 'job-' || e AS job_id,
             CASE WHEN was = 'done' OR valid THEN 'done' WHEN readable THEN 'failed' ELSE was END AS status,
             CAST(nq AS INTEGER) AS total_requests,
             CAST(CASE WHEN was IS DISTINCT FROM 'done' AND valid THEN nq ELSE 0 END AS INTEGER) AS quotes,
             CASE WHEN was IS DISTINCT FROM 'done' AND NOT valid AND readable THEN 'invalid job payload' END AS error
           FROM judged WHERE was IS NOT NULL OR valid""",
    ),
    "job_message_outcomes": sql.with_inputs(
        _BATCH
        + """,
delivered AS (
  SELECT event_id AS e, event_id AS "offset", 1 AS nth FROM events
  UNION ALL SELECT event_id, event_id + 1000000000000, 2 FROM events WHERE event_id % 10 = 0
),
fate AS (
  SELECT d."offset", CASE WHEN NOT j.readable THEN 'dead_letter' WHEN j.was = 'done' OR (j.valid AND d.nth = 2) THEN 'skipped'
    WHEN j.valid THEN 'done' WHEN j.was IS NOT NULL THEN 'failed' ELSE 'dead_letter' END AS outcome, j.readable
  FROM delivered d JOIN judged j USING (e)
)""",
        """SELECT "offset", outcome, CASE WHEN outcome IN ('dead_letter', 'failed')
             THEN CASE WHEN readable THEN 'invalid job payload' ELSE 'no readable job id' END END AS reason FROM fate""",
    ),
    "job_quotes_in_order": sql.with_inputs(
        sql.PRICED, "SELECT job_id, position, id, CAST(total AS VARCHAR) AS total FROM priced"
    ),
    "ttl_purge": sql.with_inputs(
        _LATEST,
        f"""SELECT id, total, version FROM latest
            WHERE ts + INTERVAL 7 DAY > TIMESTAMP '{_NOW}'""",
    ),
    "latest_quote_upsert": sql.with_inputs(_LATEST, "SELECT id, total, version FROM latest"),
    "ttl_live_quotes": sql.with_inputs(
        _LATEST,
        f"""SELECT id, total, version FROM latest
            WHERE ts + INTERVAL 7 DAY > TIMESTAMP '{_NOW}'""",
    ),
}
