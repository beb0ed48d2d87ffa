"""Queries over the gateway's request log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from quoteflow import rules, session
from quoteflow.operators import ranks, traffic
from quoteflow.plans import inputs, sql
from quoteflow.sinks.tables import KeyedTable

_DAY_LIMIT = 3
_WARMUP = 20
_CHECK_TIMEOUT_MS = 100.0
_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format("ts", "yyyy-MM-dd")
    return inputs.request_log(spark, sf_dir).withColumn("day", day)


def traffic_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic.split(_log(spark, sf_dir))


def cumulative_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic.cumulative_split(_log(spark, sf_dir), "day")


def probe_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = traffic.snapshot(_log(spark, sf_dir), "day")
    entries = F.transform(
        F.array_sort(F.map_entries("by_backend")),
        lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")),
    )
    return rows.select(
        "day",
        "samples",
        "errors",
        F.array_join(entries, ",").alias("by_backend"),
        "p95_ms",
        F.date_format("updated_at", _MICROS).alias("updated_at"),
    )


def probe_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic.metrics(_log(spark, sf_dir), "day")


def latency_nearest_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    healthy = traffic.labelled(_log(spark, sf_dir)).filter(~F.col("is_error"))
    return ranks.percentiles(healthy, ["backend"], "latency_ms", [50, 95, 99])


def rolling_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles over all rounds so far: each round is read once and adds its counts to a stored table."""
    healthy = traffic.labelled(_log(spark, sf_dir)).filter(~F.col("is_error"))
    schema = T.StructType().add("backend", "string").add("latency_ms", "double").add("n", "long")
    keys = ["backend", "latency_ms"]
    table = KeyedTable(spark, session.scratch_path(spark, "latencies"), schema, keys).create().sum_up(["n"])
    for number, round_ in enumerate(("day < '2024-01-11'", "day >= '2024-01-11' AND day < '2024-01-21'", "day >= '2024-01-21'")):
        table.upsert(ranks.counts(healthy.filter(round_), ["backend"], "latency_ms"), number)
    wanted = {f"p{p}": ranks.nearest_rank(p) for p in (50, 95, 99)}
    return ranks.of_counts(table.latest(), ["backend"], "latency_ms", wanted)


def latency_exclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = traffic.labelled(_log(spark, sf_dir))
    rows = ranks.interpolated(log, ["backend", "day"], "latency_ms", [50, 95, 99])
    return rows.select("backend", "day", "rows", *[F.round(f"p{p}", 6).alias(f"p{p}") for p in (50, 95, 99)])


def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = traffic.labelled(_log(spark, sf_dir))
    measured = traffic.after_warmup(log, _WARMUP)
    rounded = [F.round(c, 6).alias(c) for c in ("rps", "p50", "p95", "p99")]
    return traffic.load_report(measured).select("backend", "requests", "errors", *rounded)


def budget_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic.gate(_log(spark, sf_dir), budget_ms=100.0, by="day")


def canary_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = traffic.weighted_round_robin(
        inputs.request_log(spark, sf_dir).select("seq", "ts"), rules.CANARY_WEIGHTS, ["ts", "seq"]
    )
    return rows.select("seq", "assigned")


def sticky_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = traffic.weighted_by_key(_log(spark, sf_dir), rules.CANARY_WEIGHTS, "consumer")
    return rows.groupBy("consumer").agg(
        F.count_distinct("assigned").alias("backends"), F.count(F.lit(1)).alias("requests")
    )


def split_after_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = traffic.share_check(_log(spark, sf_dir), rules.CANARY_WEIGHTS, tolerance=0.05)
    return rows.select("backend", "requests", F.round("share", 9).alias("share"), "expected", "ok")


def rate_limit_excess(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = inputs.request_log(spark, sf_dir).select("seq", "ts", "consumer")
    return traffic.rate_limit_excess(log, _DAY_LIMIT, "day").select("seq", "consumer", "nth")


def backend_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = inputs.request_log(spark, sf_dir).select("seq", "ts", "backend", "status")
    log = log.select(
        "seq",
        "ts",
        traffic.backend_name(F.col("backend")).alias("backend"),
        traffic.failure_kind(F.col("status")).alias("failure"),
    )
    return traffic.health_changes(log).select("seq", "backend", "state")


def backend_active_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Health by active checks: fewer failures count, and answers that come too late."""
    log = inputs.request_log(spark, sf_dir).select(
        "seq",
        "ts",
        traffic.backend_name(F.col("backend")).alias("backend"),
        traffic.failure_kind(F.col("status"), F.col("latency_ms"), _CHECK_TIMEOUT_MS).alias("failure"),
    )
    return traffic.health_changes(log, rules.ACTIVE_FAILURES_TO_UNHEALTHY).select("seq", "backend", "state")


def unauthenticated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = traffic.unauthenticated(_log(spark, sf_dir), inputs.consumers(spark, sf_dir))
    return rows.select("seq", "consumer", "api_key")


def request_id_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic.request_id_gaps(_log(spark, sf_dir))


def status_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir).withColumn("status", F.coalesce(F.col("status").cast("string"), F.lit("none")))
    return traffic.status_metrics(log, ["service", "status"])


QUERIES = {
    "rolling_percentiles": rolling_percentiles,
    "traffic_split": traffic_split,
    "cumulative_requests": cumulative_requests,
    "probe_snapshots": probe_snapshots,
    "probe_metrics": probe_metrics,
    "latency_nearest_rank": latency_nearest_rank,
    "latency_exclusive": latency_exclusive,
    "load_report": load_report,
    "budget_gate": budget_gate,
    "canary_assignment": canary_assignment,
    "sticky_assignment": sticky_assignment,
    "split_after_change": split_after_change,
    "rate_limit_excess": rate_limit_excess,
    "backend_health": backend_health,
    "backend_active_health": backend_active_health,
    "unauthenticated": unauthenticated,
    "request_id_gaps": request_id_gaps,
    "status_metrics": status_metrics,
}

_LOG = """
log AS (
  SELECT event_id AS seq, ts, strftime(ts, '%Y-%m-%d') AS day,
    CASE WHEN event_id % 50 <> 49 THEN 'req-' || event_id END AS request_id,
    CASE WHEN event_id % 40 = 7 THEN '' WHEN event_id % 41 = 9 THEN NULL
         WHEN event_id % 5 = 0 THEN 'stable' ELSE 'canary' END AS raw_backend,
    CASE WHEN event_id % 40 = 7 OR event_id % 41 = 9 THEN 'unknown'
         WHEN event_id % 5 = 0 THEN 'stable' ELSE 'canary' END AS named,
    CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN NULL WHEN event_type = 'error' THEN 502
         WHEN event_type = 'signup' AND event_id % 7 = 0 THEN 404 ELSE 201 END AS status,
    event_type = 'error' AS failed, CASE WHEN event_id % 53 <> 5 THEN value END AS latency_ms, 'user-' || user_id AS consumer,
    CASE WHEN event_id % 30 = 12 THEN 'key-stolen' WHEN event_id % 30 <> 11 THEN 'key-' || user_id END AS api_key,
    CASE WHEN event_id % 3 = 0 THEN 'quote-jobs' ELSE 'quotes' END AS service, user_id
  FROM events
)"""

# Interpolated percentile on the n + 1 basis over rows (g, v): columns g, n, p50, p95, p99.
_EXCLUSIVE = """
numbered AS (
  SELECT g, v, row_number() OVER (PARTITION BY g ORDER BY v) AS r, count(*) OVER (PARTITION BY g) AS n
  FROM sample WHERE v IS NOT NULL
),
ranked AS (
  SELECT g, v, r, n, pct, greatest(least((n + 1) * pct // 100, n - 1), 1) AS j
  FROM numbered, (VALUES (50), (95), (99)) AS q(pct)
),
between_ranks AS (
  SELECT g, pct, any_value(n) AS n, any_value((n + 1) * pct - j * 100) AS delta,
    max(CASE WHEN r = j THEN v END) AS low, max(CASE WHEN r = least(j + 1, n) THEN v END) AS high
  FROM ranked GROUP BY g, pct
),
interpolated AS (
  SELECT g, any_value(n) AS n,
    max(CASE WHEN pct = 50 THEN x END) AS p50, max(CASE WHEN pct = 95 THEN x END) AS p95,
    max(CASE WHEN pct = 99 THEN x END) AS p99
  FROM (SELECT *, CASE WHEN n = 1 THEN low ELSE (low * (100.0::DOUBLE - delta) + high * delta) / 100.0::DOUBLE END AS x
        FROM between_ranks) GROUP BY g
)"""

_LOAD = """
measured AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY named ORDER BY ts, seq) AS r FROM log)
  WHERE r > 20
),
sample AS (SELECT named AS g, latency_ms AS v FROM measured),""" + _EXCLUSIVE

_NEAREST = sql.with_inputs(
    _LOG,
    """SELECT named AS backend, count(latency_ms) AS rows, quantile_disc(latency_ms, 0.5) AS p50,
         quantile_disc(latency_ms, 0.95) AS p95, quantile_disc(latency_ms, 0.99) AS p99
       FROM log WHERE NOT failed GROUP BY named""",
)

ORACLE = {
    "traffic_split": sql.with_inputs(
        _LOG, "SELECT named AS backend, count(*) AS requests FROM log WHERE NOT failed GROUP BY named"
    ),
    "cumulative_requests": sql.with_inputs(
        _LOG,
        """SELECT backend, day, requests, CAST(sum(requests) OVER (PARTITION BY backend ORDER BY day) AS BIGINT) AS total
           FROM (SELECT named AS backend, day, count(*) AS requests FROM log WHERE NOT failed GROUP BY ALL)""",
    ),
    "probe_snapshots": sql.with_inputs(
        _LOG
        + """,
per_backend AS (SELECT day, named, count(*) AS n FROM log WHERE NOT failed GROUP BY ALL),
backends AS (SELECT day, string_agg(named || '=' || n, ',' ORDER BY named) AS by_backend FROM per_backend GROUP BY day),
totals AS (
  SELECT day, count(*) FILTER (WHERE NOT failed) AS samples, count(*) FILTER (WHERE failed) AS errors,
    quantile_disc(latency_ms, 0.95) FILTER (WHERE NOT failed) AS p95,
    strftime(max(ts), '%Y-%m-%dT%H:%M:%S.%f') AS updated_at
  FROM log GROUP BY day
)""",
        """SELECT day, samples, errors, coalesce(by_backend, '') AS by_backend, coalesce(p95, 0) AS p95_ms, updated_at
           FROM totals LEFT JOIN backends USING (day)""",
    ),
    "probe_metrics": sql.with_inputs(
        _LOG,
        """SELECT 'probe_requests_total' AS metric, named AS label, CAST(count(*) AS DOUBLE) AS value
           FROM log WHERE NOT failed GROUP BY named
           UNION ALL SELECT 'probe_errors_total', '', CAST(count(*) FILTER (WHERE failed) AS DOUBLE) FROM log
           UNION ALL SELECT 'probe_latency_p95_ms', '', coalesce(quantile_disc(latency_ms, 0.95), 0)
             FROM log WHERE NOT failed AND day = (SELECT max(day) FROM log)""",
    ),
    "latency_nearest_rank": _NEAREST,
    "rolling_percentiles": _NEAREST,
    "latency_exclusive": sql.with_inputs(
        _LOG
        + ", sample AS (SELECT named || '|' || day AS g, latency_ms AS v FROM log),"
        + _EXCLUSIVE,
        """SELECT split_part(g, '|', 1) AS backend, split_part(g, '|', 2) AS day, n AS rows,
             round(p50, 6) AS p50, round(p95, 6) AS p95, round(p99, 6) AS p99 FROM interpolated""",
    ),
    "load_report": sql.with_inputs(
        _LOG + "," + _LOAD,
        """SELECT named AS backend, count(*) AS requests,
             count(*) FILTER (WHERE status IS DISTINCT FROM 201) AS errors,
             round(count(*) * 1000000.0::DOUBLE / (max(epoch_us(ts)::DOUBLE + coalesce(latency_ms, 0) * 1000.0::DOUBLE)
                   - min(epoch_us(ts)::DOUBLE)), 6) AS rps,
             round(any_value(i.p50), 6) AS p50, round(any_value(i.p95), 6) AS p95, round(any_value(i.p99), 6) AS p99
           FROM measured LEFT JOIN interpolated i ON i.g = named GROUP BY named""",
    ),
    "budget_gate": sql.with_inputs(
        _LOG,
        """SELECT day, requests, errors, p95_ms, errors = 0 AS no_errors, p95_ms <= 100 AS within_budget,
             errors = 0 AND p95_ms <= 100 AS passed
           FROM (SELECT day, count(*) AS requests, count(*) FILTER (WHERE status IS DISTINCT FROM 201) AS errors,
                   quantile_disc(latency_ms, 0.95) AS p95_ms FROM log GROUP BY day)""",
    ),
    "canary_assignment": sql.with_inputs(
        _LOG,
        """SELECT seq, CASE WHEN (row_number() OVER (ORDER BY ts, seq) - 1) % 5 < 1
                            THEN 'stable' ELSE 'canary' END AS assigned FROM log""",
    ),
    # Which backend a consumer gets is up to the hash; that it is always the same one is not.
    "sticky_assignment": sql.with_inputs(
        _LOG, "SELECT consumer, 1 AS backends, count(*) AS requests FROM log GROUP BY consumer"
    ),
    "split_after_change": sql.with_inputs(
        _LOG,
        """SELECT backend, requests, round(share, 9) AS share, expected,
             CASE WHEN expected = 0 THEN share = 0 ELSE abs(share - expected) <= 0.05 END AS ok
           FROM (SELECT backend, requests, requests / sum(requests) OVER () AS share,
                   CAST(CASE backend WHEN 'stable' THEN 0.2 WHEN 'canary' THEN 0.8 ELSE 0 END AS DOUBLE) AS expected
                 FROM (SELECT named AS backend, count(*) AS requests FROM log WHERE NOT failed GROUP BY named))""",
    ),
    "rate_limit_excess": sql.with_inputs(
        _LOG,
        """SELECT seq, consumer, nth FROM (
             SELECT seq, consumer, row_number() OVER (PARTITION BY consumer, day ORDER BY ts, seq) AS nth FROM log)
           WHERE nth > 3""",
    ),
    "backend_health": sql.with_inputs(
        _LOG
        + """,
runs AS (
  SELECT seq, named, ts, failed, status,
    count(*) FILTER (WHERE NOT failed) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS epoch FROM log
  WINDOW w AS (PARTITION BY named ORDER BY ts, seq)
),
streaks AS (
  SELECT *, count(*) FILTER (WHERE failed AND status = 502) OVER s AS http,
            count(*) FILTER (WHERE failed AND status IS NULL) OVER s AS tcp
  FROM runs WINDOW s AS (PARTITION BY named, epoch ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
states AS (
  SELECT seq, named, ts, NOT failed AS healthy_row, failed AND (http >= 3 OR tcp >= 2) AS down FROM streaks
),
changes AS (
  SELECT seq, named, down, coalesce(lag(down) OVER (PARTITION BY named ORDER BY ts, seq), false) AS was FROM states
)""",
        """SELECT seq, named AS backend, CASE WHEN down THEN 'unhealthy' ELSE 'healthy' END AS state
           FROM changes WHERE down <> was""",
    ),
    "backend_active_health": sql.with_inputs(
        _LOG
        + """,
checks AS (
  SELECT seq, named, ts, CASE WHEN status IS NULL THEN 'tcp' WHEN latency_ms > 100 THEN 'timeout'
    WHEN status >= 500 THEN 'http' END AS kind FROM log
),
runs AS (
  SELECT *, count(*) FILTER (WHERE kind IS NULL) OVER (PARTITION BY named ORDER BY ts, seq
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS epoch FROM checks
),
streaks AS (
  SELECT *, row_number() OVER (PARTITION BY named, epoch, kind ORDER BY ts, seq) AS nth FROM runs
),
states AS (
  SELECT *, kind IS NOT NULL AND coalesce(max(CASE WHEN kind IS NOT NULL THEN nth END) OVER (PARTITION BY named, epoch
    ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) >= 2 AS down FROM streaks
),
changes AS (
  SELECT seq, named, down, coalesce(lag(down) OVER (PARTITION BY named ORDER BY ts, seq), false) AS was FROM states
)""",
        """SELECT seq, named AS backend, CASE WHEN down THEN 'unhealthy' ELSE 'healthy' END AS state
           FROM changes WHERE down <> was""",
    ),
    "unauthenticated": sql.with_inputs(
        _LOG,
        """SELECT seq, consumer, api_key FROM log WHERE api_key IS NULL OR api_key NOT IN
             (SELECT DISTINCT 'key-' || user_id FROM events WHERE user_id % 17 <> 3)""",
    ),
    "request_id_gaps": sql.with_inputs(
        _LOG,
        """SELECT count(*) AS requests, count(*) FILTER (WHERE request_id IS NULL) AS missing,
             count(*) FILTER (WHERE request_id IS NULL) = 0 AS complete FROM log""",
    ),
    "status_metrics": sql.with_inputs(
        _LOG,
        """SELECT service, coalesce(CAST(status AS VARCHAR), 'none') AS status, count(*) AS rows,
             quantile_disc(latency_ms, 0.5) AS p50, quantile_disc(latency_ms, 0.95) AS p95,
             quantile_disc(latency_ms, 0.99) AS p99 FROM log GROUP BY ALL""",
    ),
}
