"""Streaming queries: the given event table replayed as a message stream, run to its end."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from quoteflow import schemas, session
from quoteflow.operators import fanout, windows
from quoteflow.plans import analytics, inputs, jobs as job_plans
from quoteflow.sinks.log import files
from quoteflow.sinks.tables import KeyedTable
from quoteflow.sources import tables as sources
from quoteflow.streaming import queries as streams


# Partitions of a state that has a row per region and open window, whatever the number of events.
_WINDOW_TASKS = 8


def message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job messages of the batch queries as a stream over the same table."""
    schema = inputs.table(spark, sf_dir, "events").schema
    # A pattern that only the table's own name fits: unlike a plain path it may be a file or a folder.
    raw = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")
    return inputs.messages(session.spread(inputs.carts(raw), inputs.size(spark, sf_dir, "events")))


def _validated(spark: SparkSession, sf_dir: str, root: str) -> str:
    streams.validate(message_stream(spark, sf_dir), f"{root}/outcomes", f"{root}/validate").awaitTermination()
    return f"{root}/outcomes"


def _totals_table(spark: SparkSession, path: str) -> KeyedTable:
    return KeyedTable(spark, path, schemas.REGION_STATS, ["region", "window_start"]).create()


def stream_region_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages to validated rows to totals; no event of the replay is lost, however it is cut."""
    root = session.scratch_path(spark, "region-totals")
    outcomes = _validated(spark, sf_dir, root)
    requests = streams.requests_of(sources.committed(spark, outcomes, streaming=True))
    table = _totals_table(spark, f"{root}/stats")
    streams.totals_in_order(requests, table, f"{root}/totals").awaitTermination()
    return windows.keyed(windows.added(table.history())).select(
        "key", "region", "quote_count", "item_count", "gross_amount_cents"
    )


def in_parts(
    rows: DataFrame, path: str, part: Column, parts: int, run: Callable[[DataFrame], StreamingQuery]
) -> list[StreamingQuery]:
    """``run`` over ``rows`` as a stream, whose micro-batches are the values of ``part`` (0 to ``parts`` - 1) in order.

    The rows are written once, each part into a folder with as many files as ``rows`` has tasks.
    ``run``, which must go on from its checkpoint, is started again for every part, with a pattern that
    reaches one folder further, and ends when it has read what is there. Returns the ended queries.
    """
    spark = rows.sparkSession
    rows.withColumn("_part", part).write.partitionBy("_part").parquet(path)
    ended = []
    for number in range(parts):
        if not files(spark).names(f"{path}/_part={number}"):
            # A file without rows, so that an empty part is a micro-batch, too, and the numbers agree.
            spark.createDataFrame([], rows.schema).write.parquet(f"{path}/_part={number}")
        reached = ",".join(str(n) for n in range(number + 1))
        query = run(spark.readStream.schema(rows.schema).parquet(f"{path}/_part={{{reached}}}"))
        query.awaitTermination()
        ended.append(query)
    return ended


def _by_arrival(events: DataFrame, parts: int) -> Column:
    """Which of so many equal spans of arrival time an event is in."""
    first, last = events.agg(F.min(F.unix_micros("arrived")), F.max(F.unix_micros("arrived"))).first()
    span = max(1, ((last or 0) - (first or 0)) // parts + 1)
    return F.floor((F.unix_micros("arrived") - F.lit(first or 0)) / span).cast("int")


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that arrive after their window's grace, from a stream that keeps them apart."""
    root = session.scratch_path(spark, "late-rows")
    events = session.durable(analytics.late_events(spark, sf_dir), "late-events")
    keys, log = ["job_id", "position"], f"{root}/log"
    late = KeyedTable(spark, f"{root}/late", schemas.LATE_EVENT, keys, log=log).create()
    clock = KeyedTable(spark, f"{root}/clock", schemas.STREAM_CLOCK, ["stream"], buckets=1, log=log).create()
    stats = KeyedTable(spark, f"{root}/stats", schemas.REGION_STATS, ["region", "window_start"], log=log).create()
    in_parts(
        events,
        f"{root}/topic",
        _by_arrival(events, 4),
        4,
        lambda source: streams.totals_in_order(
            source,
            stats,
            f"{root}/checkpoint",
            "1 hour",
            "30 minutes",
            ["arrived", "number", "position"],
            late,
            clock,
        ),
    )
    return late.history().select("job_id", "position", "region", "gross_amount_cents")


def stream_region_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live totals over five micro-batches, the query stopped and started again between them.

    Spark keeps the open windows as state and judges lateness by the watermark at the start of a batch;
    the row without a region says how many groups (a region and window of a batch) came too late.
    """
    root = session.scratch_path(spark, "region-updates")
    events = session.durable(analytics.late_events(spark, sf_dir), "late-events")
    table = _totals_table(spark, f"{root}/stats")
    ended = in_parts(
        events,
        f"{root}/topic",
        _by_arrival(events, 5),
        5,
        lambda source: streams.region_stats(
            source, table, f"{root}/checkpoint", "1 hour", "30 minutes", tasks=_WINDOW_TASKS
        ),
    )
    late = sum(streams.dropped(query) for query in ended)
    columns = ["key", "region", "quote_count", "item_count", "gross_amount_cents"]
    nothing = [F.lit(None).cast(t).alias(n) for n, t in (("region", "string"), ("item_count", "long"), ("gross_amount_cents", "long"))]
    count = spark.range(1).select(F.lit("dropped").alias("key"), F.lit(late).cast("long").alias("quote_count"), *nothing)
    return windows.keyed(table.latest()).select(*columns).unionByName(count)


def stream_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters as committed by the validating stream."""
    root = session.scratch_path(spark, "dead-letters")
    rows = sources.committed(spark, _validated(spark, sf_dir, root))
    return streams.dead_letters_of(rows).select(
        "key",
        fanout.header_text("dlq.error").alias("reason"),
        fanout.header_text("dlq.source.topic").alias("source_topic"),
        F.size("headers").alias("headers"),
    )


def stream_job_worker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs on record after the worker has consumed the message stream."""
    root = session.scratch_path(spark, "worker")
    job_table = KeyedTable(
        spark, f"{root}/jobs", schemas.expiring(schemas.QUOTE_JOB), ["job_id"], final="status = 'done'"
    ).create()
    quotes = KeyedTable(spark, f"{root}/quotes", schemas.expiring(schemas.QUOTE), ["id"]).create()
    states = inputs.job_states(inputs.events(spark, sf_dir))
    expires = F.current_timestamp() + F.expr("INTERVAL 7 DAYS")
    job_table.upsert(states.withColumn("expires_at", expires), 0, "submit")
    streams.job_worker(
        message_stream(spark, sf_dir), quotes, job_table, f"{root}/checkpoint"
    ).awaitTermination()
    return job_table.live(F.current_timestamp()).select(
        "job_id", "status", "total_requests", F.size("quote_ids").alias("quotes"), "error"
    )


def worker_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs with their stored quotes and message outcomes, all read at one version, before and after the worker.

    A version holds the three tables' runs of a batch, or none of them.
    """
    root = session.scratch_path(spark, "snapshot")
    log = f"{root}/log"
    quotes = KeyedTable(spark, f"{root}/quotes", schemas.expiring(schemas.QUOTE), ["id"], log=log).create()
    job_table = KeyedTable(
        spark, f"{root}/jobs", schemas.expiring(schemas.QUOTE_JOB), ["job_id"], final="status = 'done'", log=log
    ).create()
    outcomes = KeyedTable(
        spark, f"{root}/outcomes", schemas.MESSAGE_OUTCOME, ["partition", "offset"], log=log
    ).create()
    states = inputs.job_states(inputs.events(spark, sf_dir))
    expires = F.current_timestamp() + F.expr("INTERVAL 7 DAYS")
    job_table.upsert(states.withColumn("expires_at", expires), 0, "submit")
    before = job_table.log.read()
    streams.job_worker(
        message_stream(spark, sf_dir), quotes, job_table, f"{root}/checkpoint", outcomes=outcomes
    ).awaitTermination()
    views = []
    for name, version in (("submitted", before), ("worked", job_table.log.read())):
        listed = job_table.latest(version=version)
        ids = listed.select("job_id", F.explode("quote_ids").alias("id"))
        found = ids.join(quotes.latest(version=version).select("id"), "id")
        rows = [
            listed.select("job_id", "status", F.size("quote_ids").alias("listed"), F.lit(0).alias("stored"), F.lit(0).alias("messages")),
            found.select("job_id", F.lit(None).cast("string").alias("status"), F.lit(0).alias("listed"), F.lit(1).alias("stored"), F.lit(0).alias("messages")),
            outcomes.latest(version=version).filter("job_id is not null").select(
                "job_id", F.lit(None).cast("string").alias("status"), F.lit(0).alias("listed"), F.lit(0).alias("stored"), F.lit(1).alias("messages")
            ),
        ]
        # Counted per job instead of joined: every part adds up inside its tasks first.
        counts = [F.sum(c).cast("long").alias(c) for c in ("listed", "stored", "messages")]
        whole = rows[0].unionAll(rows[1]).unionAll(rows[2]).groupBy("job_id").agg(F.max("status").alias("status"), *counts)
        views.append(whole.select(F.lit(name).alias("version"), "job_id", "status", "listed", "stored", "messages"))
    return views[0].unionAll(views[1])


def stream_redelivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What becomes of every message when every 10th is delivered again an hour later, over four micro-batches.

    The second delivery is kept back by the stream's state, so each message has one outcome; the row
    without a message says how many deliveries were kept back.
    """
    root = session.scratch_path(spark, "redelivery")
    log = f"{root}/log"
    quotes = KeyedTable(spark, f"{root}/quotes", schemas.expiring(schemas.QUOTE), ["id"], log=log).create()
    job_table = KeyedTable(
        spark, f"{root}/jobs", schemas.expiring(schemas.QUOTE_JOB), ["job_id"], final="status = 'done'", log=log
    ).create()
    outcomes = KeyedTable(
        spark, f"{root}/outcomes", schemas.MESSAGE_OUTCOME, ["partition", "offset"], log=log
    ).create()
    states = inputs.job_states(inputs.events(spark, sf_dir))
    expires = F.current_timestamp() + F.expr("INTERVAL 7 DAYS")
    job_table.upsert(states.withColumn("expires_at", expires), 0, "submit")
    again = F.col("offset") >= inputs.AGAIN
    later = F.when(again, F.col("timestamp") + F.expr("INTERVAL 1 HOUR")).otherwise(F.col("timestamp"))
    delivered = inputs.redelivered(inputs.job_messages(spark, sf_dir)).withColumn("arrived", later)
    ended = in_parts(
        delivered,
        f"{root}/topic",
        _by_arrival(delivered, 4),
        4,
        lambda source: streams.job_worker(
            streams.first_deliveries(source, "1 day").drop("arrived"),
            quotes,
            job_table,
            f"{root}/checkpoint",
            outcomes=outcomes,
            tasks=session.tasks(spark, inputs.size(spark, sf_dir, "events")),
        ),
    )
    kept_back = str(sum(streams.repeated(query) for query in ended))
    count = spark.range(1).select(
        F.lit(None).cast("long").alias("message"),
        F.lit("redelivered").alias("outcome"),
        F.lit(kept_back).alias("reason"),
    )
    message = (F.col("offset") % inputs.AGAIN).alias("message")
    return outcomes.history().select(message, "outcome", "reason").unionAll(count)


QUERIES = {
    "stream_redelivery": stream_redelivery,
    "stream_region_updates": stream_region_updates,
    "worker_snapshot": worker_snapshot,
    "stream_late_rows": stream_late_rows,
    "stream_region_totals": stream_region_totals,
    "stream_dead_letters": stream_dead_letters,
    "stream_job_worker": stream_job_worker,
}

ORACLE = {
    "stream_redelivery": job_plans.REDELIVERY,
    "stream_region_updates": analytics.REGION_UPDATES,
    "worker_snapshot": job_plans.WORKER_SNAPSHOT,
    "stream_late_rows": analytics.LATE_ROWS,
    "stream_region_totals": analytics.ORACLE["region_minute_totals"],
    "stream_dead_letters": analytics.ORACLE["dead_letters"],
    "stream_job_worker": job_plans.ORACLE["job_status_after_batch"],
}
