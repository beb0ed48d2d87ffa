"""Bulk jobs: submission, pricing of a job's quotes, redelivery and the job's state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from quoteflow import rules, session
from quoteflow.functions import ids
from quoteflow.operators import contract, pricing
from quoteflow.sinks import tables
from quoteflow.sinks.tables import KeyedTable

JOB_COLUMNS = ["job_id", "status", "total_requests", "quote_ids", "error"]


def _no_ids() -> F.Column:
    return F.array().cast("array<string>")


def quote_ids() -> F.Column:
    """Ids of a job's quotes in request order; a job holds at most 50, so they stay one array."""
    return F.transform("quotes", lambda q, i: ids.derived(F.col("job_id"), i))


def pending(submitted: DataFrame) -> DataFrame:
    return submitted.select(
        "job_id",
        F.lit(rules.PENDING).alias("status"),
        F.size("quotes").alias("total_requests"),
        _no_ids().alias("quote_ids"),
        F.lit(None).cast("string").alias("error"),
    )


def failed(jobs: DataFrame, error: str) -> DataFrame:
    return jobs.withColumns({"status": F.lit(rules.FAILED), "error": F.lit(error)}).select(*JOB_COLUMNS)


def done(valid: DataFrame) -> DataFrame:
    """Job rows of valid messages. The summary needs only the message itself, so nothing is grouped."""
    return valid.select(
        "job_id",
        F.lit(rules.DONE).alias("status"),
        F.size("quotes").alias("total_requests"),
        quote_ids().alias("quote_ids"),
        F.lit(None).cast("string").alias("error"),
    )


def price_quotes(valid: DataFrame) -> DataFrame:
    """One priced quote per request of every valid job; the same job always gives the same ids."""
    requests = valid.select("job_id", "timestamp", F.posexplode("quotes").alias("position", "request"))
    requests = requests.select(
        ids.derived(F.col("job_id"), F.col("position")).alias("quote_id"),
        "job_id",
        "position",
        F.col("timestamp").alias("ts"),
        "request.*",
    )
    return pricing.price(requests).select("job_id", "position", *pricing.QUOTE_COLUMNS)


def run(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Quotes and job rows of all valid messages, without looking at earlier state."""
    valid = checked.filter(F.col("job_id").isNotNull() & F.col("quotes").isNotNull())
    return price_quotes(valid), done(valid)


def skip_done(messages: DataFrame, jobs: DataFrame) -> DataFrame:
    """Drop redelivered messages of jobs that are already done."""
    finished = jobs.filter(F.col("status") == rules.DONE).select("job_id")
    return messages.join(finished, "job_id", "left_anti")


def of_known_jobs(messages: DataFrame, jobs: DataFrame) -> DataFrame:
    return messages.join(jobs.select("job_id"), "job_id", "left_semi")


def arrival() -> list[F.Column]:
    """Order of messages: offsets alone compare only within a partition."""
    return [F.col("timestamp"), F.col("partition"), F.col("offset")]


def message_outcomes(checked: DataFrame, jobs: DataFrame) -> DataFrame:
    """Every message with its ``outcome``: done, failed, skipped or dead_letter, and the ``reason``.

    A message without a readable job id, or with an invalid payload for a job that nobody knows, is a
    dead letter. A valid message settles its job, unless the job is done: then it is skipped, like
    everything behind the message that settled it. Per job only the place of the first valid message
    is computed and joined back, so a job with any number of messages is not put in order.
    """
    valid = F.col("quotes").isNotNull()
    place = F.struct(*[c.alias(n) for n, c in zip(("t", "p", "o"), arrival())])
    first = (
        checked.filter(F.col("job_id").isNotNull() & valid)
        .groupBy(F.col("job_id").alias("_job"))
        .agg(F.min(place).alias("_first"))
    )
    known = jobs.select(F.col("job_id").alias("_known"), F.col("status").alias("_status"))
    # A null id meets nobody; a value of its own keeps such messages from filling one task.
    key = F.coalesce("job_id", F.concat(F.lit("\u0000"), F.col("partition"), F.lit("-"), F.col("offset")))
    rows = checked.withColumn("_key", key)
    rows = rows.join(first, F.col("_key") == F.col("_job"), "left")
    rows = rows.join(known, F.col("_key") == F.col("_known"), "left")
    outcome = (
        F.when(F.col("job_id").isNull(), rules.DEAD_LETTER)
        .when(F.col("_status").eqNullSafe(rules.DONE) | (place > F.col("_first")), rules.SKIPPED)
        .when(valid, rules.DONE)
        .when(F.col("_status").isNotNull(), rules.FAILED)
        .otherwise(rules.DEAD_LETTER)
    )
    unreadable = F.when(F.col("job_id").isNull(), rules.UNREADABLE)
    reason = F.when(outcome.isin(rules.DEAD_LETTER, rules.FAILED), F.coalesce(unreadable, F.lit(rules.PAYLOAD_ERROR)))
    return rows.withColumns({"outcome": outcome, "reason": reason}).select(
        *checked.columns, "outcome", "reason"
    )


def decide(checked: DataFrame, jobs: DataFrame) -> DataFrame:
    """What a batch of worker messages does to each job, one row per job that changes.

    Messages of a job take effect in arrival order (:func:`arrival`): the first valid one settles the
    job and later ones are skipped, so a job is ``done`` if any message is valid. An invalid payload
    only fails a job that is known. Copies of a message are reduced inside each task before the
    shuffle, and both sides of the join then have one row per job.
    """
    valid = F.col("quotes").isNotNull()
    # The first column of the ordering makes any valid message win over all invalid ones.
    per_job = (
        checked.filter(F.col("job_id").isNotNull())
        .groupBy("job_id")
        .agg(
            F.min_by(F.struct("quotes", "timestamp"), F.struct(~valid, *arrival())).alias("_first"),
            F.count(F.lit(1)).alias("messages"),
        )
        .select("job_id", "messages", "_first.*")
    )
    state = jobs.select(
        "job_id", F.col("status").alias("_status"), F.col("total_requests").alias("_requests"),
        F.col("quote_ids").alias("_ids"),
    )
    joined = per_job.join(state, "job_id", "left")
    open_ = joined.filter(~F.col("_status").eqNullSafe(rules.DONE))
    return open_.filter(F.col("quotes").isNotNull() | F.col("_status").isNotNull())


def settled(decided: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Quote rows and job rows of decided jobs."""
    valid = F.col("quotes").isNotNull()
    rows = decided.select(
        "job_id",
        F.when(valid, rules.DONE).otherwise(rules.FAILED).alias("status"),
        F.when(valid, F.size("quotes")).otherwise(F.col("_requests")).alias("total_requests"),
        F.coalesce(quote_ids(), F.col("_ids"), _no_ids()).alias("quote_ids"),
        F.when(~valid, rules.PAYLOAD_ERROR).alias("error"),
    )
    return price_quotes(decided.filter(valid)), rows


def ordered_quotes(jobs: DataFrame, quotes: DataFrame) -> DataFrame:
    """A job's quotes in request order, by the ids listed in the job."""
    wanted = jobs.select("job_id", F.posexplode("quote_ids").alias("position", "id"))
    return wanted.join(quotes.drop("job_id", "position"), "id")


def submit(
    requests: DataFrame,
    table: KeyedTable,
    publish: Callable[[DataFrame], None],
    batch: int,
) -> DataFrame:
    """Submit bulk requests (``request_id``, ``body``): record them as pending, then publish.

    Returns status and detail of every request. The fresh job ids are random, so they are written
    before anything uses them. If publishing fails, the same jobs are recorded as failed and their
    callers are told the queue is down.
    """
    checked = contract.check_jobs(requests)
    numbered = session.durable(checked.withColumn("job_id", ids.fresh()), "submitted")
    accepted = numbered.filter(F.col("quotes").isNotNull())
    table.upsert(_stored(pending(accepted)), batch, "submit")
    messages = accepted.select(
        F.col("job_id").alias("key"),
        contract.normalized(F.col("quotes"), F.col("job_id")).alias("value"),
    )
    enqueued = True
    try:
        publish(messages)
    except Exception:
        enqueued = False
        rejected = failed(pending(accepted), rules.ENQUEUE_ERROR)
        table.upsert(_stored(rejected), batch, "submit-failed")
    answered = contract.job_outcome(numbered, F.lit(enqueued))
    accepted_id = F.when(F.col("quotes").isNotNull(), F.col("job_id"))
    return answered.select("request_id", "status", "detail", accepted_id.alias("job_id"))


def _stored(rows: DataFrame) -> DataFrame:
    return tables.with_expiry(rows, F.current_timestamp())
