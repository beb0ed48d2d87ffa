"""Request-log operators against plain Python on the same rows, with one group far larger than the rest."""

import math
import random
import statistics
from collections import Counter, defaultdict
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from quoteflow.operators import ranks, scan, traffic

START = datetime(2024, 1, 1)


def make_log(n=4000, seed=3):
    """Half of all rows on one backend, many equal latencies, repeated timestamps."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        backend = "hot" if i % 2 else rng.choice(["a", "b", "", None])
        status = rng.choice([201, 201, 201, 404, 502, 503, None])
        latency = rng.choice([5.0, 5.0, 5.0, round(rng.expovariate(1 / 40), 3), float(rng.randint(1, 9))])
        ts = START + timedelta(seconds=rng.randint(0, n // 4))
        rows.append((i, ts, backend, status, latency, rng.choice(["u1", "u1", "u1", f"u{rng.randint(2, 30)}"])))
    return rows


ROWS = make_log()


@pytest.fixture(scope="module")
def log(spark):
    schema = "seq bigint, ts timestamp, backend string, status int, latency_ms double, consumer string"
    frame = spark.createDataFrame(ROWS, schema).repartition(7)
    return frame.withColumn("round", F.date_trunc("minute", "ts")).cache()


def name(backend):
    return backend or "unknown"


def healthy(row):
    return row[3] is not None and row[3] < 500


def test_split_counts_healthy_requests_by_named_backend(log):
    expected = Counter(name(r[2]) for r in ROWS if healthy(r))
    assert {r.backend: r.requests for r in traffic.split(log).collect()} == expected


def test_snapshots(log):
    rounds = defaultdict(list)
    for r in ROWS:
        rounds[r[1].replace(second=0)].append(r)
    got = {r["round"]: r for r in traffic.snapshot(log, "round").collect()}
    assert set(got) == set(rounds)
    for key, rows in rounds.items():
        good = [r for r in rows if healthy(r)]
        values = sorted(r[4] for r in good)
        assert got[key].samples == len(good) and got[key].errors == len(rows) - len(good)
        assert got[key].by_backend == Counter(name(r[2]) for r in good)
        assert got[key].p95_ms == values[math.ceil(0.95 * len(values)) - 1]
        assert got[key].updated_at == max(r[1] for r in rows)


@pytest.mark.parametrize("statuses, samples, errors, by_backend", [
    ([404] * 10, 10, 0, {"stable": 5, "canary": 5}),
    ([502] * 4, 0, 4, {}),
    ([None] * 3, 0, 3, {}),
])
def test_snapshot_examples(spark, statuses, samples, errors, by_backend):
    rows = [(i, START, ["stable", "canary"][i % 2], s, 1.0, 0) for i, s in enumerate(statuses)]
    frame = spark.createDataFrame(rows, "seq bigint, ts timestamp, backend string, status int, latency_ms double, round int")
    (row,) = traffic.snapshot(frame, "round").collect()
    assert (row.samples, row.errors, row.by_backend) == (samples, errors, by_backend)
    assert row.p95_ms == (1.0 if samples else 0.0)


def test_nearest_rank_example(spark):
    frame = spark.createDataFrame([(1, float(v)) for v in (50, 10, 40, 20, 30)], "g int, v double")
    assert ranks.percentiles(frame, ["g"], "v", [95]).collect()[0].p95 == 50.0


@pytest.mark.parametrize("width", [0.01, 1.0, 1000.0])
def test_percentiles_by_group(log, width):
    frame = log.withColumn("backend", traffic.backend_name(F.col("backend")))
    groups = defaultdict(list)
    for r in ROWS:
        groups[name(r[2])].append(r[4])
    for row in ranks.percentiles(frame, ["backend"], "latency_ms", [1, 50, 95, 99, 100], width).collect():
        values = sorted(groups[row.backend])
        for p in (1, 50, 95, 99, 100):
            assert row[f"p{p}"] == values[math.ceil(p * len(values) / 100) - 1]
    for row in ranks.interpolated(frame, ["backend"], "latency_ms", [50, 95, 99], width).collect():
        cuts = statistics.quantiles(groups[row.backend], n=100)
        for p in (50, 95, 99):
            assert row[f"p{p}"] == pytest.approx(cuts[p - 1], abs=1e-9)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 100, 101])
def test_interpolated_small_groups(spark, n):
    values = [float((7 * i) % 13) for i in range(n)]
    frame = spark.createDataFrame([(1, v) for v in values], "g int, v double")
    row = ranks.interpolated(frame, ["g"], "v", [50, 95, 99]).collect()[0]
    expected = statistics.quantiles(values, n=100) if n > 1 else values * 99
    assert [row.p50, row.p95, row.p99] == pytest.approx([expected[49], expected[94], expected[98]])


def test_running_measures_match_a_walk_over_the_rows(log):
    rows = scan.running(
        log.withColumn("backend", traffic.backend_name(F.col("backend"))),
        ["ts", "seq"],
        {"n": ("sum", F.lit(1).cast("bigint")), "top": ("max", F.col("latency_ms"))},
        by=["backend"],
    ).collect()
    count, top = Counter(), {}
    expected = {}
    for r in sorted(ROWS, key=lambda r: (r[1], r[0])):
        b = name(r[2])
        count[b] += 1
        top[b] = max(top.get(b, r[4]), r[4])
        expected[r[0]] = (count[b], top[b])
    assert {r.seq: (r.n, r.top) for r in rows} == expected


def test_one_hot_group_is_spread_over_tasks(spark):
    """All rows in one group: the sort must still give every task a share."""
    frame = spark.range(20000).withColumn("g", F.lit("x"))
    rows = scan.ordered(frame, ["g", "id"])
    sizes = [r["count"] for r in rows.groupBy("_part").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 20000 * 0.7


def test_round_robin_and_sticky_assignment(spark):
    frame = spark.range(60).select(F.col("id").alias("seq"), F.lit(START).alias("ts"), (F.col("id") % 7).alias("user"))
    weights = {"stable": 20, "canary": 80}
    assigned = traffic.weighted_round_robin(frame, weights, ["ts", "seq"])
    assert {r.assigned: r["count"] for r in assigned.groupBy("assigned").count().collect()} == {"stable": 12, "canary": 48}
    sticky = traffic.weighted_by_key(frame, weights, "user").groupBy("user").agg(F.count_distinct("assigned").alias("n"))
    assert sticky.filter("n <> 1").count() == 0
    only = traffic.weighted_by_key(frame, {"stable": 0, "canary": 100}, "user")
    assert only.filter("assigned <> 'canary'").count() == 0


def test_rate_limit(log):
    expected, seen = set(), Counter()
    for r in sorted(ROWS, key=lambda r: (r[1], r[0])):
        key = (r[5], r[1].replace(second=0))
        seen[key] += 1
        if seen[key] > 30:
            expected.add(r[0])
    assert expected
    assert {r.seq for r in traffic.rate_limit_excess(log, 30).collect()} == expected


def test_health_changes(log):
    frame = log.select(
        "seq", "ts", traffic.backend_name(F.col("backend")).alias("backend"),
        traffic.failure_kind(F.col("status")).alias("failure"),
    )
    down, runs, expected = {}, defaultdict(Counter), set()
    for r in sorted(ROWS, key=lambda r: (r[1], r[0])):
        b = name(r[2])
        if healthy(r):
            runs[b].clear()
        else:
            runs[b]["tcp" if r[3] is None else "http"] += 1
        now = runs[b]["http"] >= 3 or runs[b]["tcp"] >= 2
        if now != down.get(b, False):
            expected.add((r[0], "unhealthy" if now else "healthy"))
        down[b] = now
    assert expected
    assert {(r.seq, r.state) for r in traffic.health_changes(frame).collect()} == expected


def test_warmup_and_report(log):
    frame = log.withColumn("backend", traffic.backend_name(F.col("backend")))
    rows = sorted(ROWS, key=lambda r: (r[1], r[0]))
    seen, kept = Counter(), defaultdict(list)
    for r in rows:
        seen[name(r[2])] += 1
        if seen[name(r[2])] > 20:
            kept[name(r[2])].append(r)
    measured = traffic.after_warmup(frame, 20)
    assert measured.count() == sum(map(len, kept.values()))
    for row in traffic.load_report(measured).collect():
        own = kept[row.backend]
        begin = min(r[1] for r in own)
        end = max((r[1] - begin).total_seconds() + r[4] / 1000 for r in own)
        assert row.rps == pytest.approx(len(own) / end)
        assert row.errors == sum(r[3] != 201 for r in own)
        assert row.p95 == pytest.approx(statistics.quantiles([r[4] for r in own], n=100)[94])


def test_warmup_of_any_length_drops_the_first_rows_of_each_group(spark):
    begin = datetime(1969, 12, 31, 23, 50, tzinfo=timezone.utc)
    rows = []
    for seq in range(400):
        group = ["hot", "hot", "hot", None, "late"][seq % 5]
        second = None if seq % 37 == 3 else (7 * seq) % 1200 if group != "hot" else 600 + seq % 3
        rows.append((seq, None if second is None else begin + timedelta(seconds=second), group))
    frame = spark.createDataFrame(rows, "seq long, ts timestamp, backend string").repartition(5)
    first = datetime(1, 1, 1, tzinfo=timezone.utc)
    for warmup in (0, 1, 20, 79, 80, 81, 239, 240, 1000):
        want = set()
        for group in ("hot", None, "late"):
            own = sorted((r for r in rows if r[2] == group), key=lambda r: (r[1] or first, r[0]))
            want |= {r[0] for r in own[warmup:]}
        kept = [r.seq for r in traffic.after_warmup(frame, warmup).collect()]
        assert sorted(kept) == sorted(want), warmup
    assert traffic.after_warmup(frame.limit(0), 20).count() == 0


def test_gate_and_metrics(log):
    frame = log.withColumn("backend", traffic.backend_name(F.col("backend")))
    assert traffic.gate(frame, 1e9).filter("passed").count() == 0
    clean = frame.filter("status = 201")
    assert traffic.gate(clean, 1e9).filter("not passed").count() == 0
    assert traffic.gate(clean, 0.5).filter("within_budget").count() == 0
    rows = {(r.metric, r.label): r.value for r in traffic.metrics(log, "round").collect()}
    assert rows["probe_errors_total", ""] == sum(not healthy(r) for r in ROWS)
    assert rows["probe_requests_total", "hot"] == sum(healthy(r) and r[2] == "hot" for r in ROWS)


def test_split_after_cutover(spark):
    frame = spark.range(20).select(F.lit("canary").alias("backend"), F.lit(201).alias("status"))
    (row,) = traffic.share_check(frame, {"stable": 0, "canary": 100}, 0.0).collect()
    assert row.ok and row.expected == 1.0
    assert not traffic.share_check(frame, {"stable": 100, "canary": 0}, 0.5).collect()[0].ok
