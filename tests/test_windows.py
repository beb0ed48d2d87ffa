"""Region totals: tumbling windows, grace, exact replay, streaming."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quoteflow import schemas, session
from quoteflow.operators import fanout, parse, windows
from quoteflow.sinks.tables import KeyedTable
from quoteflow.sources import messages as sources, tables
from quoteflow.streaming import queries as streams

# Per message: one quote of two lines in IN (6655 cents), one of a single line in US (4550 cents).
JOB = {
    "quotes": [
        {
            "items": [{"sku": "cup", "qty": 2, "unit_price": "31.40"}, {"sku": "spoon", "qty": 5, "unit_price": "0.75"}],
            "region": "IN",
        },
        {"items": [{"sku": "pot", "qty": 1, "unit_price": 45.5}], "region": "US", "coupon": "none"},
    ]
}


def at(text):
    return datetime.fromisoformat(f"2024-05-01 {text}")


def frame(spark, times, poison=()):
    rows = []
    for n, time in enumerate(times):
        value = "{bad" if n in poison else json.dumps({"job_id": f"job-{n}", **JOB})
        rows.append((f"job-{n}", value, at(time), "quote-jobs", 0, n, None))
    return spark.createDataFrame(rows, schemas.MESSAGE)


def events(spark, times):
    return fanout.quote_events(parse.validated(frame(spark, times)))


def test_windows_and_keys(spark):
    stats = windows.keyed(windows.region_totals(events(spark, ["10:00:31", "10:00:59.999", "10:01:00"])))
    got = {r.key: (r.quote_count, r.item_count, r.gross_amount_cents) for r in stats.collect()}
    assert len(got) == 4
    assert got["IN@2024-05-01T10:00:00Z"] == (2, 4, 2 * 6655)
    assert got["US@2024-05-01T10:00:00Z"] == (2, 2, 2 * 4550)
    assert got["IN@2024-05-01T10:01:00Z"] == (1, 2, 6655)


LATE = [
    (["10:00:41", "10:01:27", "10:00:03", "10:01:45", "10:00:50"], 2),
    (["10:00:05", "10:01:30", "10:00:10"], 1),
    (["10:00:05", "10:01:29.999", "10:00:10"], 2),
]


@pytest.mark.parametrize("times, expected", LATE)
def test_replay_judges_every_record(spark, times, expected):
    arriving = events(spark, times).withColumn("n", F.substring("job_id", 5, 9).cast("int"))
    kept = windows.accepted_in_grace(arriving, ["n", "position"])
    row = windows.region_totals(kept).filter("region = 'IN' and minute(window_start) = 0").collect()[0]
    assert row.quote_count == expected


def test_replay_can_keep_stream_time_per_partition(spark):
    arriving = events(spark, ["10:00:05", "10:05:00", "10:00:10"])
    arriving = arriving.withColumn("n", F.substring("job_id", 5, 9).cast("int"))
    arriving = arriving.withColumn("part", F.col("n") % 2)
    kept = windows.accepted_in_grace(arriving, ["n", "position"], partition="part")
    assert kept.count() == 6


@pytest.mark.parametrize("times, expected", LATE)
def test_stream_drops_late_rows_by_the_current_watermark(spark, tmp_path, times, expected):
    """One file per batch: Spark moves the watermark between batches."""
    table = KeyedTable(spark, str(tmp_path / "stats"), schemas.REGION_STATS, ["region", "window_start"]).create()
    source = str(tmp_path / "topic")
    for n, time in enumerate(times):
        one = frame(spark, [time]).withColumn("offset", F.lit(n).cast("long"))
        one.coalesce(1).write.mode("append").parquet(source)
        stream = sources.replay(spark, source, files_per_batch=1)
        checked = fanout.quote_events(parse.validated(stream))
        # Stopped and started again for every batch, as after a crash.
        streams.region_stats(checked, table, str(tmp_path / "check")).awaitTermination()
    row = table.latest().filter("region = 'IN' and minute(window_start) = 0").collect()[0]
    assert row.quote_count == expected


def test_validating_stream_commits_each_message_once(spark, tmp_path):
    source, out = str(tmp_path / "topic"), str(tmp_path / "outcomes")
    frame(spark, ["10:00:05", "10:00:10", "10:00:20"], poison={1}).write.parquet(source)
    for _ in range(2):  # the second start finds nothing new
        stream = sources.replay(spark, source)
        streams.validate(stream, out, str(tmp_path / "check")).awaitTermination()
    rows = tables.committed(spark, out)
    assert streams.requests_of(rows).count() == 4
    (dead,) = streams.dead_letters_of(rows).collect()
    assert dead.value == "{bad" and bytes(dead.headers[0].value) == b"malformed JSON"


def test_totals_from_committed_requests(spark, tmp_path):
    source, out = str(tmp_path / "topic"), str(tmp_path / "outcomes")
    frame(spark, ["10:00:05", "10:00:25"], poison={1}).write.parquet(source)
    streams.validate(sources.replay(spark, source), out, str(tmp_path / "c1")).awaitTermination()
    table = KeyedTable(spark, str(tmp_path / "stats"), schemas.REGION_STATS, ["region", "window_start"]).create()
    requests = streams.requests_of(tables.committed(spark, out, streaming=True))
    streams.region_stats(requests, table, str(tmp_path / "c2")).awaitTermination()
    assert {(r.region, r.quote_count) for r in table.latest().collect()} == {("IN", 1), ("US", 1)}


def test_poison_does_not_advance_stream_time(spark):
    """A rejected message far in the future must not close the windows of valid ones."""
    times = ["10:00:05", "23:00:00", "10:00:10"]
    valid = fanout.quote_events(parse.validated(frame(spark, times, poison={1})))
    arriving = valid.withColumn("n", F.substring("job_id", 5, 9).cast("int"))
    assert windows.accepted_in_grace(arriving, ["n", "position"]).count() == 4


@pytest.mark.parametrize("files", [1, 4])
def test_a_backfill_in_any_cut_equals_the_batch_totals(spark, tmp_path, files):
    """Files out of event order, one per batch: every event counts."""
    times = ["10:05:00", "10:00:05", "10:09:00", "10:00:10", "10:02:00", "10:00:59", "10:05:30", "09:00:00"]
    source = str(tmp_path / "topic")
    for n in range(4):
        frame(spark, times[2 * n : 2 * n + 2]).coalesce(1).write.mode("append").parquet(source)
    table = KeyedTable(spark, str(tmp_path / "stats"), schemas.REGION_STATS, ["region", "window_start"]).create()
    stream = fanout.quote_events(parse.validated(sources.replay(spark, source, files_per_batch=files)))
    streams.totals_in_order(stream, table, str(tmp_path / "check")).awaitTermination()
    whole = windows.region_totals(fanout.quote_events(parse.validated(spark.read.parquet(source))))
    got = windows.added(table.history()).select(whole.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.collect()))


@pytest.mark.parametrize("files", [1, 2, 5])
@pytest.mark.parametrize("times, expected", LATE)
def test_late_rows_are_kept_apart_in_any_cut(spark, tmp_path, times, expected, files):
    source = str(tmp_path / "topic")
    for n, time in enumerate(times):
        one = frame(spark, [time]).withColumn("offset", F.lit(n).cast("long"))
        one.coalesce(1).write.mode("append").parquet(source)
    stream = sources.replay(spark, source, files_per_batch=files)
    checked = parse.validated(stream)
    events = checked.select("offset", "timestamp", F.explode("events").alias("e")).select("e.*", "offset", "timestamp")
    table = KeyedTable(spark, str(tmp_path / "stats"), schemas.REGION_STATS, ["region", "window_start"]).create()
    late = KeyedTable(spark, str(tmp_path / "late"), schemas.LATE_EVENT, ["job_id", "position"]).create()
    clock = KeyedTable(spark, str(tmp_path / "clock"), schemas.STREAM_CLOCK, ["stream"], buckets=1).create()
    streams.totals_in_order(
        events, table, str(tmp_path / "check"), grace="30 seconds", arrival=["offset", "position"], late=late, clock=clock
    ).awaitTermination()
    stats = windows.added(table.history())
    row = stats.filter("region = 'IN' and minute(window_start) = 0").collect()[0]
    assert row.quote_count == expected
    assert stats.agg(F.sum("quote_count")).first()[0] + late.history().count() == 2 * len(times)


def test_a_table_stored_as_a_folder_streams_like_a_file(spark, tmp_path):
    from quoteflow.plans import streams as plans

    one, many = str(tmp_path / "one"), str(tmp_path / "many")
    raw = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    raw.repartition(4).write.parquet(f"{many}/events.parquet")
    got = plans.stream_region_totals(spark, many).collect()
    want = plans.stream_region_totals(spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and got


def test_a_micro_batch_is_a_part_of_several_tasks(spark, tmp_path):
    from quoteflow.plans import streams as plans

    seen = []

    def run(stream):
        def write(batch, batch_id):
            files = batch.groupBy(F.input_file_name()).count().collect()
            seen.append((batch_id, sorted(r.n for r in batch.select("n").collect()), len(files)))

        writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", str(tmp_path / "check"))
        return writer.trigger(availableNow=True).start()

    rows = spark.range(40, numPartitions=4).select(F.col("id").alias("n"))
    # A part that has nearly all rows, an empty one, and one with the rest.
    part = F.when(F.col("n") < 37, 0).otherwise(2)
    plans.in_parts(rows, str(tmp_path / "topic"), part, 3, run)
    seen = [s for s in seen if s[1]]
    assert [numbers for _, numbers, _ in seen] == [list(range(37)), [37, 38, 39]]
    assert [b for b, _, _ in seen] == [0, 2] and [f for _, _, f in seen] == [4, 1]


def test_durable_tables_go_to_the_configured_folder(spark):
    assert session.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_window_keys_show_fractions_only_when_there_are_some(spark):
    base = events(spark, ["10:00:05"])
    stats = windows.keyed(windows.region_totals(base, "500 milliseconds"))
    assert {r.key for r in stats.collect()} == {"IN@2024-05-01T10:00:05Z", "US@2024-05-01T10:00:05Z"}
    later = base.withColumn("timestamp", F.col("timestamp") + F.lit(timedelta(milliseconds=600)))
    stats = windows.keyed(windows.region_totals(later, "500 milliseconds"))
    assert {r.key for r in stats.collect()} == {"IN@2024-05-01T10:00:05.500Z", "US@2024-05-01T10:00:05.500Z"}


def test_final_only_writes_a_window_once_it_is_closed(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "stats"), schemas.REGION_STATS, ["region", "window_start"]).create()
    source = str(tmp_path / "topic")
    for time in ("10:00:05", "10:00:50", "10:02:00", "10:02:05"):
        frame(spark, [time]).coalesce(1).write.mode("append").parquet(source)
        checked = fanout.quote_events(parse.validated(sources.replay(spark, source, files_per_batch=1)))
        streams.region_stats(checked, table, str(tmp_path / "check"), final_only=True).awaitTermination()
    rows = table.history().filter("region = 'IN' and quote_count is not null").collect()
    assert [(r.window_start.minute, r.quote_count) for r in rows] == [(0, 2)]


def test_the_state_of_open_windows_has_the_partitions_asked_for(spark, tmp_path):
    source = str(tmp_path / "events")
    row = "'j' as job_id, 0 as position, 'EU' as region, 1 as item_count, 5L as gross_amount_cents, 'c' as coupon"
    spark.sql(f"select {row}, timestamp'2024-01-01 00:00:00' as timestamp").write.parquet(source)
    table = KeyedTable(spark, str(tmp_path / "stats"), schemas.REGION_STATS, ["region", "window_start"]).create()
    stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
    query = streams.region_stats(stream, table, str(tmp_path / "check"), tasks=2)
    query.awaitTermination()
    assert {o.numShufflePartitions for p in query.recentProgress for o in p.stateOperators} == {2}
    assert [r.quote_count for r in table.latest().collect()] == [1]
