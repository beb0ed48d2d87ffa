"""Exact order statistics (percentiles) per group without sorting or gathering the group.

Two histograms replace the sort. Rows are first counted per distinct value, which adds up inside
each task and spreads a hot group over the whole cluster; coarse buckets of those counts then tell
which bucket holds each wanted rank, and only the values of these buckets are put in order.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def at_ranks(
    df: DataFrame,
    by: list[str],
    value: str,
    ranks: dict[str, Callable[[Column], Column]],
    width: float = 1.0,
) -> DataFrame:
    """One row per group: ``rows`` and, for each name, the value at a 1-based rank.

    ``ranks`` maps a name to a function from the group's row count to the rank. ``width`` is the
    bucket width: milliseconds of latency are capped by timeouts, so buckets per group stay few and
    a bucket holds at most ``width`` / resolution distinct values. Null values are not counted.
    """
    return of_counts(counts(df, by, value), by, value, ranks, width)


def counts(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """How often (``n``) each value occurs in a group. Counts of disjoint sets of rows add up."""
    return df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))


def of_counts(
    counted: DataFrame,
    by: list[str],
    value: str,
    ranks: dict[str, Callable[[Column], Column]],
    width: float = 1.0,
) -> DataFrame:
    """:func:`at_ranks` from one row per group and value, as :func:`counts` makes or a table adds up."""
    counted = counted.select(*by, F.col(value).alias("_value"), F.col("n").alias("_n"))
    counted = counted.withColumn("_bucket", F.floor(F.col("_value") / width))
    upto = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    buckets = counted.groupBy(*by, "_bucket").agg(F.sum("_n").alias("_n"))
    buckets = buckets.withColumns(
        {
            "_upto": F.sum("_n").over(upto),
            "_rows": F.sum("_n").over(Window.partitionBy(*by)),
        }
    )
    wanted = F.array(
        *[
            F.struct(F.lit(name).alias("name"), rank(F.col("_rows")).cast("bigint").alias("rank"))
            for name, rank in ranks.items()
        ]
    )
    below = F.col("_upto") - F.col("_n")
    hit = F.filter(wanted, lambda w: (w["rank"] > below) & (w["rank"] <= F.col("_upto")))
    located = buckets.select(*by, "_bucket", "_rows", below.alias("_below"), hit.alias("_hit")).filter(
        F.size("_hit") > 0
    )
    inside = (
        Window.partitionBy(*by, "_bucket").orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)
    )
    # Null-safe equality keeps groups with a null key, and adds no filter on one side only: the counts
    # stay the same shuffle in both branches, so the table is read once.
    keys = [*by, "_bucket"]
    located = located.withColumnsRenamed({k: f"_at_{k}" for k in keys})
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_at_{k}")) for k in keys])
    values = counted.join(located, same).drop(*[f"_at_{k}" for k in keys])
    values = values.withColumn("_upto", F.col("_below") + F.sum("_n").over(inside))
    found = values.select(
        *by,
        "_rows",
        "_value",
        F.filter(
            "_hit",
            lambda w: (w["rank"] > F.col("_upto") - F.col("_n")) & (w["rank"] <= F.col("_upto")),
        ).alias("_hit"),
    )
    picks = [F.max(F.when(_names(name), F.col("_value"))).alias(name) for name in ranks]
    return found.groupBy(*by).agg(F.max("_rows").alias("rows"), *picks)


def _names(name: str) -> Column:
    return F.exists("_hit", lambda w: w["name"] == name)


def nearest_rank(percent: int) -> Callable[[Column], Column]:
    """Rank of the smallest value with at least ``percent`` of the rows at or below it."""
    return lambda n: F.greatest(F.ceil(n * F.lit(percent) / F.lit(100)), F.lit(1))


def percentiles(df: DataFrame, by: list[str], value: str, percents: list[int], width: float = 1.0) -> DataFrame:
    """Nearest-rank percentiles ``p50``, ``p95`` ... per group."""
    return at_ranks(df, by, value, {f"p{p}": nearest_rank(p) for p in percents}, width)


def _position(percent: int, n: Column) -> Column:
    """Lower of the two neighbouring ranks on the n + 1 basis."""
    raw = F.floor((n + 1) * F.lit(percent) / F.lit(100))
    return F.greatest(F.least(raw, n - 1), F.lit(1))


def interpolated(df: DataFrame, by: list[str], value: str, percents: list[int], width: float = 1.0) -> DataFrame:
    """Percentiles interpolated between neighbouring ranks on the n + 1 (exclusive) basis."""
    ranks: dict[str, Callable[[Column], Column]] = {}
    for p in percents:
        ranks[f"_low{p}"] = lambda n, p=p: _position(p, n)
        ranks[f"_high{p}"] = lambda n, p=p: F.least(_position(p, n) + 1, n)
    found = at_ranks(df, by, value, ranks, width)
    n = F.col("rows")
    columns = []
    for p in percents:
        delta = ((n + 1) * p - _position(p, n) * 100).cast("double")
        between = (F.col(f"_low{p}") * (F.lit(100.0) - delta) + F.col(f"_high{p}") * delta) / F.lit(100.0)
        columns.append(F.when(n == 1, F.col(f"_low{p}")).otherwise(between).alias(f"p{p}"))
    return found.select(*by, "rows", *columns)
