"""Request-log analytics: traffic split, latency, load reports, gateway policies, backend health.

A log row has ``ts``, ``backend``, ``status`` (null when the backend was unreachable), ``latency_ms``,
``consumer``, ``api_key``, ``request_id`` and a unique ``seq``. Any backend may hold most of the rows.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from quoteflow import rules, session
from quoteflow.functions.rows import matched
from quoteflow.operators import ranks, scan


def is_error(status: Column) -> Column:
    """Server errors and unreachable backends; any other status is a healthy sample."""
    return F.coalesce(status, F.lit(599)) >= 500


def backend_name(backend: Column) -> Column:
    return F.coalesce(F.nullif(backend, F.lit("")), F.lit("unknown"))


def labelled(log: DataFrame) -> DataFrame:
    return log.withColumns(
        {"backend": backend_name(F.col("backend")), "is_error": is_error(F.col("status"))}
    )


def split(log: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Healthy requests per backend."""
    healthy = labelled(log).filter(~F.col("is_error"))
    return healthy.groupBy(*(by or []), "backend").agg(F.count(F.lit(1)).alias("requests"))


def cumulative_split(log: DataFrame, round_: str) -> DataFrame:
    """Requests per backend and round, with the running total over rounds.

    The running total goes over the counts, one row per backend and round.
    """
    per_round = split(log, [round_])
    upto = Window.partitionBy("backend").orderBy(round_).rowsBetween(Window.unboundedPreceding, 0)
    return per_round.withColumn("total", F.sum("requests").over(upto))


def snapshot(log: DataFrame, round_: str, width: float = 1.0) -> DataFrame:
    """Per sampling round: samples, errors, requests by backend, 95th percentile, last update.

    Rounds without a healthy sample have an empty map and a percentile of 0. A sample without a
    latency counts, but not in the percentile. A null round is a round like any other.
    """
    rows = labelled(log)
    totals = rows.groupBy(round_).agg(
        F.count_if(~F.col("is_error")).alias("samples"),
        F.count_if("is_error").alias("errors"),
        F.max("ts").alias("updated_at"),
    )
    # One entry per backend, counted before it is gathered.
    backends = split(log, [round_]).groupBy(round_).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("backend", "requests")))).alias("by_backend")
    )
    p95 = ranks.percentiles(rows.filter(~F.col("is_error")), [round_], "latency_ms", [95], width)
    joined = matched(matched(totals, backends, [round_]), p95.drop("rows"), [round_])
    return joined.select(
        round_,
        "samples",
        "errors",
        F.coalesce("by_backend", F.create_map().cast("map<string,bigint>")).alias("by_backend"),
        F.coalesce("p95", F.lit(0.0)).alias("p95_ms"),
        "updated_at",
    )


def metrics(log: DataFrame, round_: str) -> DataFrame:
    """Counters over all rounds and the gauge of the latest round as ``(metric, label, value)``.

    The log is read once for the counts and once for the percentiles; everything else works on one
    row per round and backend.
    """
    rows = labelled(log)
    counts = rows.groupBy(round_, "backend").agg(
        F.count_if(~F.col("is_error")).alias("healthy"), F.count_if("is_error").alias("errors")
    )
    counts = session.durable(counts, "metrics")
    requests = counts.filter("healthy > 0").groupBy("backend").agg(F.sum("healthy").alias("n"))
    requests = requests.select(
        F.lit(rules.REQUESTS_METRIC).alias("metric"),
        F.col("backend").alias("label"),
        F.col("n").cast("double").alias("value"),
    )
    errors = counts.agg(F.coalesce(F.sum("errors"), F.lit(0)).cast("double").alias("value")).select(
        F.lit(rules.ERRORS_METRIC).alias("metric"), F.lit("").alias("label"), "value"
    )
    latest = counts.agg(F.max(round_).alias(round_))
    gauges = ranks.percentiles(rows.filter(~F.col("is_error")), [round_], "latency_ms", [95])
    gauge = matched(latest, gauges, [round_]).select(
        F.lit(rules.LATENCY_METRIC).alias("metric"),
        F.lit("").alias("label"),
        F.coalesce("p95", F.lit(0.0)).alias("value"),
    )
    return requests.unionByName(errors).unionByName(gauge)


def _warmup_end(counts: DataFrame, by: str, span: str, warmup: int) -> DataFrame:
    """The span in which the ``warmup``-th request of each group lies, and how many lie ahead of the span."""
    ahead = F.col("_before") + F.sum("_n").over(Window.partitionBy(by).orderBy(span)) - F.col("_n")
    ends = counts.withColumn("_ahead", ahead).filter((F.col("_ahead") < warmup) & (F.col("_ahead") + F.col("_n") >= warmup))
    return ends.select(by, F.col(span).alias("_end"), "_ahead")


def after_warmup(log: DataFrame, warmup: int, by: str = "backend") -> DataFrame:
    """Drop the first ``warmup`` requests of each group; a null group is one too, a null time comes first.

    Requests per group and day, then those per minute of one day, tell the minute in which the warm-up
    ends. Later rows stay as they are read; only those of that minute are numbered, over range-sorted parts, so a hot backend or
    minute stays spread over many tasks whatever ``warmup`` is.
    """
    if warmup <= 0:
        return log
    minute = F.coalesce(F.expr("unix_micros(ts) div 60000000"), F.lit(-(2**63)).cast("long"))
    rows = log.withColumn("_minute", minute)
    counts = session.durable(rows.groupBy(by, "_minute").agg(F.count(F.lit(1)).alias("_n")), "warmup-counts")
    counts = counts.withColumn("_day", F.expr("_minute div 1440"))
    days = counts.groupBy(by, "_day").agg(F.sum("_n").alias("_n")).withColumn("_before", F.lit(0))
    last_day = _warmup_end(days, by, "_day", warmup)
    minutes = matched(counts, last_day.withColumnsRenamed({"_end": "_last", "_ahead": "_before"}), [by], "inner")
    ends = _warmup_end(minutes.filter("_day = _last"), by, "_minute", warmup)
    # One row per group that outlasts the warm-up; groups without one are dropped whole.
    ends = session.durable(ends, "warmup")
    rows = matched(rows, ends, [by], "inner")
    last = scan.running(
        rows.filter("_minute = _end"), ["ts", "seq"], {"_nth": ("sum", F.lit(1).cast("bigint"))}, by=[by]
    )
    last = last.filter(F.col("_ahead") + F.col("_nth") > warmup)
    return rows.filter("_minute > _end").select(log.columns).unionAll(last.select(log.columns))


def load_report(log: DataFrame, ok_status: int = 201, by: str = "backend", width: float = 1.0) -> DataFrame:
    """Per backend: requests per second, interpolated p50 / p95 / p99, requests with another status.

    A request without a latency counts as a request that ended when it began; it is in no percentile.
    A group with none at all, or in which no time passes, has null for what cannot be said.
    """
    start = F.unix_micros("ts").cast("double")
    finish = start + F.coalesce("latency_ms", F.lit(0.0)) * 1000.0
    span = F.max(finish) - F.min(start)
    totals = log.groupBy(by).agg(
        F.count(F.lit(1)).alias("requests"),
        F.when(span > 0, F.count(F.lit(1)) * 1000000.0 / span).alias("rps"),
        F.count_if(~F.col("status").eqNullSafe(ok_status)).alias("errors"),
    )
    latency = ranks.interpolated(log, [by], "latency_ms", [50, 95, 99], width).drop("rows")
    return matched(totals, latency, [by])


def gate(log: DataFrame, budget_ms: float = rules.P95_BUDGET_MS, by: str = "backend") -> DataFrame:
    """Pass when there are no errors and the nearest-rank p95 stays within the budget.

    A group without any latency has nothing to show that it is within the budget: it does not pass.
    """
    totals = log.groupBy(by).agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(~F.col("status").eqNullSafe(201)).alias("errors"),
    )
    p95 = ranks.percentiles(log, [by], "latency_ms", [95]).drop("rows")
    within = F.coalesce(F.col("p95") <= budget_ms, F.lit(False))
    return matched(totals, p95, [by]).select(
        by,
        "requests",
        "errors",
        F.col("p95").alias("p95_ms"),
        (F.col("errors") == 0).alias("no_errors"),
        within.alias("within_budget"),
        ((F.col("errors") == 0) & within).alias("passed"),
    )


def share_check(log: DataFrame, weights: dict[str, int], tolerance: float) -> DataFrame:
    """Observed share per backend against the share its weight asks for.

    Weight 0 allows no request at all, and with a single weighted backend every request is its own.
    """
    counts = split(log)
    total = sum(weights.values())
    entries = [F.lit(x) for name, weight in weights.items() for x in (name, weight / total)]
    expected = F.coalesce(F.try_element_at(F.create_map(*entries), F.col("backend")), F.lit(0.0))
    # One row per backend by now.
    everything = Window.partitionBy()
    shared = counts.withColumn("share", F.col("requests") / F.sum("requests").over(everything))
    off = F.abs(F.col("share") - F.col("expected"))
    exact = F.col("expected").isin(0.0, 1.0)
    return shared.withColumn("expected", expected).withColumn(
        "ok", F.when(exact, off == 0).otherwise(off <= tolerance)
    )


# --- gateway policies ----------------------------------------------------------------------------


def weighted_round_robin(log: DataFrame, weights: dict[str, int], order: list[str]) -> DataFrame:
    """Assign requests in turn, ``weights`` reduced to lowest terms (20:80 gives 1 of every 5)."""
    slots = _slots(weights)
    total = sum(slots.values())
    numbered = scan.running(log, order, {"_n": ("sum", F.lit(1).cast("bigint"))})
    slot = (F.col("_n") - 1) % total
    return numbered.withColumn("assigned", _pick(slot, slots)).drop("_n")


def weighted_by_key(log: DataFrame, weights: dict[str, int], key: str) -> DataFrame:
    """Assign requests by a hash of ``key``: no shuffle, and a key always meets the same backend."""
    slots = _slots(weights)
    slot = F.pmod(F.xxhash64(key), F.lit(sum(slots.values())))
    return log.withColumn("assigned", _pick(slot, slots))


def _slots(weights: dict[str, int]) -> dict[str, int]:
    divisor = reduce(math.gcd, weights.values())
    return {name: weight // divisor for name, weight in weights.items()}


def _pick(slot: Column, slots: dict[str, int]) -> Column:
    out, upper = None, 0
    for name, width in slots.items():
        upper += width
        out = F.when(slot < upper, name) if out is None else out.when(slot < upper, name)
    return out


def rate_limit_excess(
    log: DataFrame, limit: int = rules.RATE_LIMIT_PER_MINUTE, per: str = "minute"
) -> DataFrame:
    """Requests beyond the first ``limit`` of a consumer in one calendar unit."""
    rows = log.withColumn("period", F.date_trunc(per, "ts"))
    over = rows.groupBy("consumer", "period").count().filter(F.col("count") > limit).drop("count")
    # Only periods over the limit are put in order; everyone else's requests stay where they are.
    # Sorting samples its input first, so the join is stored and not run twice.
    busy = session.durable(rows.join(over, ["consumer", "period"], "left_semi"), "over-limit")
    numbered = scan.running(
        busy, ["ts", "seq"], {"nth": ("sum", F.lit(1).cast("bigint"))}, by=["consumer", "period"]
    )
    return numbered.filter(F.col("nth") > limit)


def health_changes(log: DataFrame, thresholds: dict[str, int] | None = None) -> DataFrame:
    """Rows at which a backend turns unhealthy (enough failures of one kind since the last success)
    or healthy again (one success).

    ``failure`` holds the kind of failure (``http``, ``tcp``, ``timeout``) or null for a success.
    Failures since the last success are the running count now minus the running count at that
    success, so two running passes over the same ordered rows replace a walk through each backend.
    """
    thresholds = thresholds or rules.LIVE_FAILURES_TO_UNHEALTHY
    kinds = list(thresholds)
    rows = scan.ordered(log, ["backend", "ts", "seq"], "health")
    one = {k: F.when(F.col("failure") == k, 1).otherwise(0).cast("bigint") for k in kinds}
    rows = scan.accumulate(rows, {f"_n_{k}": ("sum", one[k]) for k in kinds}, ["backend"])
    at_success = {k: F.when(F.col("failure").isNull(), F.col(f"_n_{k}")) for k in kinds}
    rows = scan.accumulate(
        rows, {f"_base_{k}": ("max", at_success[k]) for k in kinds}, ["backend"], before_row=True
    )
    since = {k: F.col(f"_n_{k}") - F.coalesce(F.col(f"_base_{k}"), F.lit(0)) for k in kinds}
    was = reduce(Column.__or__, [since[k] - one[k] >= thresholds[k] for k in kinds])
    now = F.col("failure").isNotNull() & reduce(Column.__or__, [since[k] >= thresholds[k] for k in kinds])
    changed = rows.withColumns({"_was": was, "_now": now}).filter(F.col("_was") != F.col("_now"))
    return changed.select(
        "backend", "ts", "seq", F.when(F.col("_now"), "unhealthy").otherwise("healthy").alias("state")
    )


def failure_kind(status: Column, latency_ms: Column | None = None, timeout_ms: float | None = None) -> Column:
    """Failure kind of a log row: unreachable is a tcp failure, an answer after ``timeout_ms`` a
    timeout, a server error an http failure."""
    kind = F.when(status.isNull(), "tcp")
    if timeout_ms is not None:
        kind = kind.when(latency_ms > timeout_ms, "timeout")
    return kind.when(status >= 500, "http")


def unauthenticated(log: DataFrame, consumers: DataFrame) -> DataFrame:
    """Requests without an API key or with a key no consumer owns (``consumers`` has ``api_key``).

    Requests without a key match nothing; a value of their own spreads them over the tasks instead
    of sending them all to the task of the null key.
    """
    spread = F.coalesce(F.col("api_key"), F.concat(F.lit("\u0000"), F.col("seq").cast("string")))
    owned = consumers.select(F.col("api_key").alias("_key"))
    return log.withColumn("_key", spread).join(owned, "_key", "left_anti").drop("_key")


def request_id_gaps(log: DataFrame) -> DataFrame:
    """How many requests carry no request id; complete logs have none."""
    return log.agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(F.col("request_id").isNull()).alias("missing"),
    ).withColumn("complete", F.col("missing") == 0)


def status_metrics(log: DataFrame, by: list[str], width: float = 1.0) -> DataFrame:
    """Requests and nearest-rank p50 / p95 / p99 latency per group (service, status).

    ``rows`` counts all requests of the group, the percentiles those with a latency.
    """
    totals = log.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"))
    measured = ranks.percentiles(log, by, "latency_ms", [50, 95, 99], width).drop("rows")
    return matched(totals, measured, by)
