"""Submission, redelivery, partial failure and poison on the job path."""

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F, types as T

from quoteflow import schemas
from quoteflow.operators import contract, diff, jobs
from quoteflow.plans import jobs as job_plans
from quoteflow.sinks import tables
from quoteflow.sinks.tables import KeyedTable
from quoteflow.sources import messages as sources, tables as lookups
from quoteflow.streaming import queries as streams

QUOTE = {"items": [{"sku": "S", "qty": 1, "unit_price": "10.00"}], "region": "US"}
NOW = F.current_timestamp


@pytest.fixture
def store(spark, tmp_path):
    quotes = KeyedTable(spark, str(tmp_path / "quotes"), schemas.expiring(schemas.QUOTE), ["id"]).create()
    job_table = KeyedTable(
        spark, str(tmp_path / "jobs"), schemas.expiring(schemas.QUOTE_JOB), ["job_id"], final="status = 'done'"
    ).create()
    return quotes, job_table


def batch(spark, *messages):
    rows = [
        (key, json.dumps(value) if isinstance(value, dict) else value, datetime(2024, 5, 1), "quote-jobs", 0, n, None)
        for n, (key, value) in enumerate(messages)
    ]
    return spark.createDataFrame(rows, schemas.MESSAGE)


def job(name, *quotes):
    return name, {"job_id": name, "quotes": list(quotes)}


def state(table):
    return {r.job_id: r for r in table.live(NOW()).collect()}


def pending(spark, table, name, count, number=0):
    rows = spark.createDataFrame([(name, "pending", count, [], None)], schemas.QUOTE_JOB)
    table.upsert(tables.with_expiry(rows, NOW()), number, "submit")


def work(spark, store, number, *messages):
    streams.work_batch(batch(spark, *messages), number, *store)


def test_redelivery_in_the_same_and_in_a_later_batch(spark, store):
    message = job("job-1", QUOTE)
    work(spark, store, 0, message, message)
    first = state(store[1])["job-1"]
    work(spark, store, 1, message)
    second = state(store[1])["job-1"]
    assert first.status == "done" and second.quote_ids == first.quote_ids
    assert store[0].latest().count() == 1 and store[0].history().count() == 1


def test_retry_after_a_crash_between_the_writes(spark, store):
    quotes, job_table = store
    message = job("job-1", QUOTE, {**QUOTE, "region": "IN"})
    work(spark, store, 0, message)
    done, before = state(job_table)["job-1"], quotes.latest()
    keys = before.select("id").collect()
    pending(spark, job_table, "job-1", 2, 1)
    work(spark, store, 1, message)
    again = state(job_table)["job-1"]
    assert (again.status, again.quote_ids) == ("done", done.quote_ids)
    known = spark.createDataFrame([(k.id,) for k in keys], "id string")
    assert diff.key_changes(known, quotes.latest(), ["id"]).count() == 0


def test_repeating_a_batch_leaves_the_same_tables(spark, store):
    messages = [job("a", QUOTE), job("b", {**QUOTE, "items": []}), job("c", QUOTE)]
    pending(spark, store[1], "b", 1)
    work(spark, store, 0, *messages)
    first = {k: (r.status, r.error, r.quote_ids) for k, r in state(store[1]).items()}
    work(spark, store, 0, *messages)
    assert {k: (r.status, r.error, r.quote_ids) for k, r in state(store[1]).items()} == first
    assert store[0].history().count() == 2


def test_poison_of_known_and_unknown_jobs(spark, store):
    pending(spark, store[1], "job-1", 1)
    bad = {**QUOTE, "items": []}
    work(spark, store, 0, job("job-1", bad), job("job-2", bad), ("x", "{bad"), ("y", None))
    got = state(store[1])
    assert (got["job-1"].status, got["job-1"].error) == ("failed", "invalid job payload")
    assert set(got) == {"job-1"}


def test_failed_job_can_be_done_later_and_done_is_final(spark, store):
    pending(spark, store[1], "j", 1)
    work(spark, store, 0, job("j", {**QUOTE, "items": []}))
    assert state(store[1])["j"].status == "failed"
    work(spark, store, 1, job("j", QUOTE))
    assert state(store[1])["j"].status == "done"
    work(spark, store, 2, job("j", {**QUOTE, "items": []}))
    assert state(store[1])["j"].status == "done"


def test_invalid_then_valid_message_in_one_batch(spark, store):
    work(spark, store, 0, job("j", {**QUOTE, "items": []}), job("j", QUOTE), job("j", QUOTE, QUOTE))
    assert state(store[1])["j"].total_requests == 1


def test_quotes_read_back_in_request_order(spark, store):
    prices = ["3.00", "1.00", "2.00"]
    made = [{"items": [{"sku": "S", "qty": 1, "unit_price": p}], "region": "US"} for p in prices]
    work(spark, store, 0, job("j", *made))
    rows = jobs.ordered_quotes(store[1].latest(), store[0].latest().withColumns({"job_id": F.lit(""), "position": F.lit(0)}))
    assert [str(r.subtotal) for r in rows.orderBy("position").collect()] == prices


def test_worker_stream(spark, store, tmp_path):
    source = str(tmp_path / "topic")
    batch(spark, job("a", QUOTE), job("b", QUOTE, QUOTE)).write.parquet(source)
    for _ in range(2):
        stream = sources.replay(spark, source)
        streams.job_worker(stream, *store, str(tmp_path / "check")).awaitTermination()
    assert {k: r.total_requests for k, r in state(store[1]).items()} == {"a": 1, "b": 2}
    assert store[0].latest().count() == 3


def test_submission(spark, store, tmp_path):
    bodies = [("r1", json.dumps({"quotes": [QUOTE, QUOTE]})), ("r2", json.dumps({"quotes": []}))]
    requests = spark.createDataFrame(bodies, "request_id string, body string")
    out = str(tmp_path / "out")
    answers = jobs.submit(requests, store[1], lambda rows: rows.write.parquet(out), 0)
    got = {r.request_id: r for r in answers.collect()}
    assert (got["r1"].status, got["r2"].status) == (202, 422)
    (message,) = spark.read.parquet(out).collect()
    assert message.key == got["r1"].job_id == json.loads(message.value)["job_id"]
    assert json.loads(message.value)["quotes"][0]["items"][0]["unit_price"] == "10.00"
    row = state(store[1])[message.key]
    assert (row.status, row.total_requests) == ("pending", 2)


def test_submission_when_the_queue_is_down(spark, store):
    def refuse(rows):
        raise ConnectionError("no broker")

    requests = spark.createDataFrame([("r1", json.dumps({"quotes": [QUOTE]}))], "request_id string, body string")
    (answer,) = jobs.submit(requests, store[1], refuse, 0).collect()
    assert (answer.status, answer.detail) == (503, "Job queue unavailable")
    (row,) = state(store[1]).values()
    assert (row.status, row.error) == ("failed", "could not enqueue job")


def test_known_and_done_filters(spark):
    messages = spark.createDataFrame([("a",), ("b",), ("c",)], "job_id string")
    states = spark.createDataFrame([("a", "done"), ("b", "pending")], "job_id string, status string")
    assert {r.job_id for r in jobs.skip_done(messages, states).collect()} == {"b", "c"}
    assert {r.job_id for r in jobs.of_known_jobs(messages, states).collect()} == {"a", "b"}


def test_lookup_and_expiry(spark, store):
    work(spark, store, 0, job("j", QUOTE))
    (quote,) = store[0].latest().collect()
    ids = spark.createDataFrame([(quote.id,), ("does-not-exist",)], "id string")
    found = contract.lookup_outcome(lookups.lookup(ids, store[0].latest(), "id", NOW()))
    assert {r.id: r.status for r in found.collect()} == {quote.id: 200, "does-not-exist": 404}
    later = NOW() + F.expr("INTERVAL 8 DAYS")
    assert store[0].live(later).count() == 0
    assert not lookups.lookup(ids, store[0].latest(), "id", later).filter("found").count()
    kept = store[0].rewrite(store[0].path + "-kept")
    purged = store[0].rewrite(store[0].path + "-purged", later)
    assert (kept.latest().count(), purged.latest().count()) == (1, 0)


def test_every_message_has_one_outcome(spark, store, tmp_path):
    bad = {**QUOTE, "items": []}
    outcomes = KeyedTable(
        spark, str(tmp_path / "outcomes"), schemas.MESSAGE_OUTCOME, ["partition", "offset"]
    ).create()
    pending(spark, store[1], "known", 1)
    work(spark, store, 0, job("finished", QUOTE))
    messages = [
        job("finished", QUOTE),
        job("finished", bad),
        job("known", bad),
        job("known", QUOTE),
        job("known", QUOTE),
        job("known", bad),
        job("new", bad),
        job("new", QUOTE),
        ("x", "{bad"),
        ("y", None),
    ]
    rows = batch(spark, *messages)
    for _ in range(2):  # the batch again gives the same
        streams.work_batch(rows, 1, *store, outcomes=outcomes)
        got = {r.offset: (r.outcome, r.reason, r.value is None) for r in outcomes.latest().collect()}
        assert [got[n][0] for n in range(10)] == [
            "skipped", "skipped", "failed", "done", "skipped", "skipped", "dead_letter", "done", "dead_letter", "dead_letter",
        ]
    assert got[6][1:] == ("invalid job payload", False) and got[8][1:] == ("no readable job id", False)
    assert all(got[n][2] for n in range(6))


def test_done_stays_when_another_writers_clock_is_ahead(spark, store):
    work(spark, store, 0, job("j", QUOTE))
    pending(spark, store[1], "j", 1, 5)  # written later: without the rule it would win
    assert state(store[1])["j"].status == "done"


def test_messages_go_by_time_then_partition_then_offset(spark, store):
    rows = [
        ("j", json.dumps({"job_id": "j", "quotes": [QUOTE] * n}), datetime(2024, 5, 1, hour), "quote-jobs", part, offset, None)
        for n, hour, part, offset in ((2, 2, 0, 1), (3, 1, 1, 9), (1, 1, 0, 10))
    ]
    streams.work_batch(spark.createDataFrame(rows, schemas.MESSAGE), 0, *store)
    assert state(store[1])["j"].total_requests == 1


def test_two_checkpoints_into_one_table_keep_both(spark, store, tmp_path):
    for name in ("a", "b"):
        source = str(tmp_path / f"topic-{name}")
        batch(spark, job(name, QUOTE)).write.parquet(source)
        streams.job_worker(sources.replay(spark, source), *store, str(tmp_path / f"check-{name}")).awaitTermination()
    assert set(state(store[1])) == {"a", "b"} and store[0].latest().count() == 2


def test_worker_reads_many_files_one_at_a_time(spark, store, tmp_path):
    source = str(tmp_path / "topic")
    for n in range(5):
        batch(spark, job(f"j{n}", QUOTE), job("same", QUOTE)).coalesce(1).write.mode("append").parquet(source)
    stream = sources.replay(spark, source, files_per_batch=1)
    streams.job_worker(stream, *store, str(tmp_path / "check"), compact_every=2).awaitTermination()
    assert set(state(store[1])) == {f"j{n}" for n in range(5)} | {"same"}
    assert store[0].latest().count() == 6


def test_deliveries_within_the_span_are_one_message_and_later_ones_meet_the_table(spark, store, tmp_path):
    source, ends = str(tmp_path / "topic"), []
    timed = T.StructType([*schemas.MESSAGE.fields, T.StructField("arrived", T.TimestampType())])
    # Hours of arrival: "a" again within the span, "b" in one batch, "c" long after it; a null value twice.
    for hours in ([("a", 0), ("b", 0), ("b", 1), (None, 0)], [("a", 3), (None, 2), ("c", 3)], [("d", 90)], [("e", 91)], [("c", 92), ("a", 93)]):
        sent = [job(name, QUOTE) if name else ("n", None) for name, _ in hours]
        rows = [r.asDict() for r in batch(spark, *sent).collect()]
        at = [datetime(2024, 1, 1) + timedelta(hours=h) for _, h in hours]
        made = spark.createDataFrame([(*[r[c] for c in schemas.MESSAGE.names], t) for r, t in zip(rows, at)], timed)
        made.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(made.schema).parquet(source)
        query = streams.job_worker(
            streams.first_deliveries(stream, "12 hours").drop("arrived"), *store, str(tmp_path / "check")
        )
        query.awaitTermination()
        ends.append(streams.repeated(query))
    assert ends == [1, 2, 0, 0, 0]
    assert set(state(store[1])) == set("abcde") and store[0].latest().count() == 5


def test_a_stateful_worker_writes_a_small_batch_with_few_tasks(spark, store, tmp_path):
    source = str(tmp_path / "topic")
    sent = [job(f"j{n}", QUOTE, QUOTE) for n in range(300)]
    batch(spark, *sent, sent[0]).withColumn("arrived", F.col("timestamp")).coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
    deliveries = streams.first_deliveries(stream, "1 day").drop("arrived")
    query = streams.job_worker(deliveries, *store, str(tmp_path / "check"), tasks=3)
    query.awaitTermination()
    assert streams.repeated(query) == 1
    assert [o.numShufflePartitions for o in query.lastProgress.stateOperators] == [3]
    assert store[0].latest().count() == 600 and len(state(store[1])) == 300
    # Small partitions were joined: no bucket of the few bytes has more than one file.
    assert len(store[0].history().inputFiles()) <= store[0].buckets


def test_the_quotes_of_a_job_are_joined_from_messages_parsed_once(spark):
    sf_dir = os.environ.get("QUOTEFLOW_TEST_SF", "/root/testdata/sf0.001")
    plan = job_plans.job_quotes_in_order(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "parseJson" not in plan and "valid-jobs" in plan


def test_text_behind_a_message_makes_it_unreadable(spark):
    good = json.dumps(job("j", QUOTE)[1])
    texts = [good, f" {good}\n", f"{good}] , [{good}", f"{good},1", f"{good}]", f"{good} x", "", " ", f"[{good}]", f"{good},", None]
    rows = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, value string")
    got = {r.n for r in contract.check_messages(rows).filter("quotes is not null").collect()}
    assert got == {0, 1}
