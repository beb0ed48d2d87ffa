"""Sharding by histogram sort, in DataFrame functions only: shards of near equal bytes.

Rows are ordered by (hash of the text, ``doc_id``, row number of the stored keys), so equal texts are
neighbours and a group of any size can still be cut. A row lies in shard ``floor(shards * before /
total)``, with ``before`` the bytes of the rows ahead of it: each shard is off by less than a row.

The splitters are found by counting: each round sums the exact bytes between evenly spaced probes
inside the interval that holds a splitter, and goes on with the one bucket that the splitter is in,
until that bucket holds one row. A round returns at most ``(shards - 1) * probes`` sums to the
driver, however large the table is. The rows are then exchanged once, by range.

Defined cases: a null text has size 1 and the checksum of an empty text; null ids come first;
repeated rows are rows of their own; an empty table gives an empty result; with fewer rows than
shards some shards stay empty; other columns stay with :func:`place` unless it adds their name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from quoteflow import session
from quoteflow.operators import scan

LAW = "bytes"
PROBES = 1024
_LEVELS = ("_h", "_id", "_tie")
_NO_ID = -(2**63)


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.withColumns(
        {
            "size": F.octet_length(text).cast("long") + 1,
            "text_crc32": F.crc32(text.cast("binary")),
            "_h": F.shiftrightunsigned(F.xxhash64(text), 1),
            "_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)),
            "_tie": F.monotonically_increasing_id(),
        }
    )


@dataclass(frozen=True)
class Splitter:
    """Rows up to ``key`` (as many levels as it has, inclusive) lie before the boundary."""

    key: tuple[int, ...]

    def passed(self) -> Column:
        """Whether a row lies behind the boundary."""
        beyond = F.lit(False)
        for level in reversed(range(len(self.key))):
            value, at = F.col(_LEVELS[level]), F.lit(self.key[level]).cast("long")
            last = level == len(self.key) - 1
            beyond = value > at if last else (value > at) | ((value == at) & beyond)
        return beyond


@dataclass
class _Search:
    """One boundary: the first row with ``goal`` bytes or more ahead of it is behind it."""

    goal: int
    prefix: tuple[int, ...]
    low: int
    high: int
    before: int  # bytes ahead of the interval


def splitters(keys: DataFrame, shards: int, probes: int = PROBES) -> list[Splitter]:
    """The boundaries between ``shards`` shards of ``keys`` (:func:`_keyed`, stored)."""
    span = keys.agg(
        F.sum("size"), *[f(c) for c in _LEVELS for f in (F.min, F.max)]
    ).first()
    total = span[0]
    if total is None:
        return []
    ranges = [(span[1 + 2 * i], span[2 + 2 * i]) for i in range(len(_LEVELS))]
    goals = [-(-i * total // shards) for i in range(1, shards)]
    open_ = [_Search(goal, (), *ranges[0], 0) for goal in goals]
    found: list[Splitter] = []
    while open_:
        again: list[_Search] = []
        for level in sorted({len(s.prefix) for s in open_}):
            here = [s for s in open_ if len(s.prefix) == level]
            again += _round(keys, here, level, ranges, probes, found)
        open_ = again
    return sorted(found, key=lambda s: s.key)


def _round(
    keys: DataFrame,
    here: list[_Search],
    level: int,
    ranges: list[tuple[int, int]],
    probes: int,
    found: list[Splitter],
) -> list[_Search]:
    """Count below the probes of all intervals of a level at once; searches that are not done yet."""
    # At one level intervals are equal or disjoint: all start alike and are cut at the same probes.
    intervals = sorted({(s.prefix, s.low, s.high) for s in here})
    value = F.col(_LEVELS[level]).cast("decimal(38,0)") if level else F.col(_LEVELS[level])
    which, bucket = F.lit(None).cast("int"), F.lit(None).cast("long")
    for number, (prefix, low, high) in enumerate(intervals):
        inside = F.col(_LEVELS[level]).between(F.lit(low).cast("long"), F.lit(high).cast("long"))
        for name, at in zip(_LEVELS, prefix):
            inside &= F.col(name) == F.lit(at).cast("long")
        width = -(-(high - low + 1) // probes)
        offset = value - F.lit(low).cast(value_type := "decimal(38,0)" if level else "long")
        cut = F.call_function("floor", offset / F.lit(width).cast(value_type)) if level else F.expr(
            f"({_LEVELS[level]} - {low}L) div {width}L"
        )
        which = F.when(inside, F.lit(number)).otherwise(which)
        bucket = F.when(inside, cut.cast("long")).otherwise(bucket)
    counted = (
        keys.select(which.alias("which"), bucket.alias("bucket"), "size")
        .filter("which is not null")
        .groupBy("which", "bucket")
        .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    )
    sums: dict[int, list] = {}
    for row in counted.collect():
        sums.setdefault(row.which, []).append((row.bucket, row.bytes, row.n))
    left = []
    for search in here:
        prefix, low, high = search.prefix, search.low, search.high
        width = -(-(high - low + 1) // probes)
        before = search.before
        for bucket_no, size, n in sorted(sums[intervals.index((prefix, low, high))]):
            if before + size >= search.goal:  # the last row ahead of the boundary is in here
                start = low + bucket_no * width
                end = min(high, start + width - 1)
                if n == 1:
                    found.append(Splitter((*prefix, end)))
                elif start == end:
                    left.append(_Search(search.goal, (*prefix, start), *ranges[level + 1], before))
                else:
                    left.append(_Search(search.goal, prefix, start, end, before))
                break
            before += size
    return left


def _shard(cuts: list[Splitter]) -> Column:
    shard = F.lit(0)
    for cut in cuts:
        shard = shard + cut.passed().cast("int")
    return shard.cast("int")


def assign(docs: DataFrame, shards: int = 16, probes: int = PROBES) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard`` for every row."""
    keys = _keyed(docs.select("doc_id", "text")).drop("text")
    keys = session.durable(keys, "shard-keys")
    rows = keys.withColumn("shard", _shard(splitters(keys, shards, probes)))
    placed = scan.running(rows, list(_LEVELS), {"slot": ("sum", F.lit(1))}, by=["shard"])
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        (F.col("slot") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def place(docs: DataFrame, shards: int = 16, probes: int = PROBES) -> DataFrame:
    """``docs`` with ``shard``, in shard order after one exchange; for ``write.partitionBy("shard")``."""
    keyed = _keyed(docs.drop("shard"))
    keys = session.durable(keyed.select("size", *_LEVELS), "shard-keys")
    # A scan numbers its rows alike each time, so _tie here is _tie there.
    rows = keyed.withColumn("shard", _shard(splitters(keys, shards, probes)))
    ordered = rows.repartitionByRange("shard", *_LEVELS).sortWithinPartitions("shard", *_LEVELS)
    return ordered.select(*[c for c in docs.columns if c.lower() != "shard"], "shard")
