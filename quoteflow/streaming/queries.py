"""The two streaming paths: region statistics from job messages, and the job worker.

Every query has its own checkpoint. Outputs are either Spark's file sink, whose commit log makes it
exactly-once, or keyed tables written by the query's own id and batch, so a repeated batch replaces
itself and neither a second query nor a new checkpoint touches what is stored.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from quoteflow import rules, session
from quoteflow.operators import contract, fanout, jobs, parse, windows
from quoteflow.sinks import tables
from quoteflow.sinks.jdbc import RelationalTable
from quoteflow.sinks.kafka import KeyedTopic
from quoteflow.sinks.tables import KeyedTable, publish

# Settings of queries, taken when they start.
_STATEFUL = {
    # Late rows must be judged by the current watermark. With chained stateful operators allowed, Spark
    # filters by the watermark of one batch earlier, which lets rows in after their window has closed.
    "spark.sql.streaming.statefulOperator.allowMultiple": "false",
}
# A batch without messages would write every table once more, only to forget state that the next batch
# forgets as well.
_WORKER = {"spark.sql.streaming.noDataMicroBatches.enabled": "false"}


def _trigger(writer: DataStreamWriter, available_now: bool, interval: str | None) -> DataStreamWriter:
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval) if interval else writer


def _started(writer: DataStreamWriter, spark: SparkSession, settings: dict[str, str]) -> StreamingQuery:
    """The query, started with ``settings``; the session's own values are put back.

    A checkpoint does not keep all settings, so they are set at every start.
    """
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        return writer.start()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _partitions(tasks: int | None) -> dict[str, str]:
    return {"spark.sql.shuffle.partitions": str(tasks)} if tasks else {}


def writer_of(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gave the query of this checkpoint; a new checkpoint is a new writer."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def validate(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    available_now: bool = True,
    interval: str | None = None,
) -> StreamingQuery:
    """Parse every message once and append quote requests and dead letters under ``path``.

    Both kinds go into one file sink, partitioned by ``outcome``: one parse, one commit. A poison
    message is a dead-letter row and cannot hold up the stream.
    """
    rows = fanout.outcomes(parse.validated(messages))
    writer = (
        rows.writeStream.format("parquet")
        .partitionBy("outcome")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return _trigger(writer, available_now, interval).start()


def requests_of(outcomes: DataFrame) -> DataFrame:
    """Quote events among the rows written by :func:`validate`."""
    names = ["job_id", "position", "region", "item_count", "gross_amount_cents", "coupon", "timestamp"]
    return outcomes.filter(F.col("outcome") == "request").select(*names)


def dead_letters_of(outcomes: DataFrame) -> DataFrame:
    return fanout.dead_letters(outcomes.filter(F.col("outcome") == "dead_letter"))


def region_stats(
    events: DataFrame,
    table: KeyedTable | RelationalTable | KeyedTopic,
    checkpoint: str,
    window: str = rules.WINDOW,
    grace: str = rules.GRACE,
    available_now: bool = True,
    interval: str | None = None,
    final_only: bool = False,
    tasks: int | None = None,
) -> StreamingQuery:
    """Running totals per region and window, upserted by region and window start.

    For a live stream: what comes after its window's grace is gone. :func:`totals_in_order` replays
    stored messages without losing any, and keeps late ones.

    The state is a row per region and open window, so Spark's default store holds it; another one is
    chosen by the session's settings. ``tasks`` is the number of its partitions, fixed by the first start;
    the session's if it is not given. Every task sends them one row per region and window of a batch.

    Update mode: each batch writes the totals it changed, and the newest batch wins per key. With
    ``final_only`` a window is written once, when its grace period has passed. Spark judges lateness
    between batches; ``windows.accepted_in_grace`` is the exact per-record replay.
    """
    spark = events.sparkSession
    stats = windows.region_totals(events, window, grace)

    def write(batch: DataFrame, batch_id: int) -> None:
        table.upsert(batch, batch_id, writer_of(spark, checkpoint))

    writer = stats.writeStream.outputMode("append" if final_only else "update").foreachBatch(write)
    writer = _trigger(writer.option("checkpointLocation", checkpoint), available_now, interval)
    return _started(writer, spark, _STATEFUL | _partitions(tasks))


def dropped(query: StreamingQuery) -> int:
    """Groups of a batch (a region and window each) that came after their window's grace, over all batches.

    Spark keeps the progress of the last ``spark.sql.streaming.numRecentProgressUpdates`` batches.
    """
    return sum(o.numRowsDroppedByWatermark for p in query.recentProgress for o in p.stateOperators)


def totals_in_order(
    events: DataFrame,
    partials: KeyedTable,
    checkpoint: str,
    window: str = rules.WINDOW,
    grace: str | None = None,
    arrival: list[str] | None = None,
    late: KeyedTable | None = None,
    clock: KeyedTable | None = None,
    available_now: bool = True,
    interval: str | None = None,
) -> StreamingQuery:
    """Partial totals per batch, which add up (``windows.added``) to the totals of all events.

    Without ``grace`` every event counts, however the replay is cut into batches. With it, each event
    is judged by the record before it in ``arrival`` order, as ``windows.judged_in_grace`` does in
    batch: stream time is carried over in ``clock``, and what is too late goes to ``late``. The result
    does not depend on the cut, as long as batches arrive in order.
    """
    spark = events.sparkSession
    partials.sum_up(["quote_count", "item_count", "gross_amount_cents"])

    def write(batch: DataFrame, batch_id: int) -> None:
        writer = writer_of(spark, checkpoint)
        if grace is not None:
            before = clock.latest(without=(writer, batch_id)).filter(F.col("stream") == writer)
            since = before.agg(F.max("stream_time")).first()[0]
            since = F.lit(since).cast("timestamp")
            judged = session.durable(
                windows.judged_in_grace(batch, arrival, window, grace, since=since), "judged"
            )
            time = judged.agg(F.max("stream_time").alias("stream_time"))
            on_time = windows.region_totals(judged.filter("not late"), window)
            publish(
                [
                    late.prepare(judged.filter("late"), batch_id, writer),
                    clock.prepare(time.withColumn("stream", F.lit(writer)), batch_id, writer),
                    partials.prepare(on_time, batch_id, writer),
                ]
            )
            session.discard(judged)
        else:
            partials.upsert(windows.region_totals(batch, window), batch_id, writer)

    writer = events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(writer, available_now, interval).start()


def first_deliveries(messages: DataFrame, within: str, arrived: str = "arrived") -> DataFrame:
    """The messages without those delivered again ``within`` that time of their first delivery.

    Deliveries with equal key and value are one message; which of several in one micro-batch goes on is
    open. Spark keeps a digest per message until the watermark of ``arrived`` passes its delivery by
    ``within``, so the state is bounded by the messages of that span. What comes again later goes on to
    the worker, whose table knows the jobs that are done. ``arrived`` is the time at the consumer:
    micro-batches in its order lose nothing to the watermark.
    """
    same = F.unhex(F.sha2(F.to_json(F.struct("key", "value")), 256))
    timed = messages.withColumn("_same", same).withWatermark(arrived, within)
    return timed.dropDuplicatesWithinWatermark(["_same"]).drop("_same")


def repeated(query: StreamingQuery) -> int:
    """Deliveries that :func:`first_deliveries` kept back, over the batches whose progress Spark keeps."""
    operators = [o for p in query.recentProgress for o in p.stateOperators]
    return sum(int(o.customMetrics.get("numDroppedDuplicateRows", 0)) for o in operators)


def work_batch(
    messages: DataFrame,
    batch_id: int,
    quotes: KeyedTable,
    job_table: KeyedTable,
    writer: str = "worker",
    outcomes: KeyedTable | None = None,
) -> None:
    """Apply one batch of job messages: their quotes, the jobs that list them, and the outcomes.

    All are written first and then published: at once where the tables share a log, else quotes
    before jobs. A crash on the way is repaired by the repeated batch: derived ids rewrite the same
    quotes. State written by this batch itself is left out when it runs again. ``outcomes`` gets a
    row for every message, dead letters with their value.
    """
    now = F.current_timestamp()
    made = []

    def kept(rows: DataFrame, label: str) -> DataFrame:
        made.append(session.durable(rows, label, job_table.spark))
        return made[-1]

    # Parsed once, for the ids to look up and for the work itself. Read back in the tables' session: Spark
    # keeps adaptive execution off in that of a stateful query, where each step of a batch, however small,
    # would run and write files in every shuffle partition.
    try:
        checked = kept(contract.check_messages(messages).drop("issues"), "checked")
        known = job_table.live(now, without=(writer, batch_id), only=checked.filter("job_id is not null"))
        earlier = kept(known, "earlier")
        decided = kept(jobs.decide(checked, earlier), "decided")
        written = []
        if outcomes is not None:
            rows = jobs.message_outcomes(checked, earlier)
            dead = F.when(F.col("outcome") == rules.DEAD_LETTER, F.col("value"))
            written.append(outcomes.prepare(rows.withColumn("value", dead), batch_id, writer))
        quote_rows, job_rows = jobs.settled(decided)
        quote_rows = tables.with_expiry(quote_rows.drop("job_id", "position"), now)
        written.append(quotes.prepare(quote_rows, batch_id, writer))
        written.append(job_table.prepare(tables.with_expiry(job_rows, now), batch_id, writer))
        publish(written)
    finally:
        session.discard(*made)


def job_worker(
    messages: DataFrame,
    quotes: KeyedTable,
    job_table: KeyedTable,
    checkpoint: str,
    available_now: bool = True,
    interval: str | None = None,
    outcomes: KeyedTable | None = None,
    compact_every: int = 100,
    tasks: int | None = None,
) -> StreamingQuery:
    """Price the jobs of a message stream; redelivered jobs that are done are skipped.

    Every ``compact_every`` batches the tables are compacted, so that a lookup reads few files.
    ``tasks`` is the number of partitions of a state that ``messages`` keep, fixed by the first start;
    the session's if it is not given.
    """
    spark = messages.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        work_batch(batch, batch_id, quotes, job_table, writer_of(spark, checkpoint), outcomes)
        if (batch_id + 1) % compact_every == 0:
            quotes.compact()
            job_table.compact()

    writer = messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _started(_trigger(writer, available_now, interval), spark, _WORKER | _partitions(tasks))
