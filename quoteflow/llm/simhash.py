"""SimHash near-duplicates by bit-sliced comparison.

A text's words (ASCII letters in lower case) form shingles of three words, repeats included; a text
with fewer words is one shingle. Each shingle is hashed with XXH64 (seed 42), and a bit of the
fingerprint is 1 if it is set in over half of the hashes. Fingerprints link when they differ in at
most ``radius`` bits; a component is everything that links reach.

1. Every text gets its fingerprint; equal fingerprints are one from here on.
2. The 64 bits are cut into ``radius + 2`` parts. Two linked fingerprints agree on at least two of
   them, so fingerprints that agree on a pair of parts are one bucket. Buckets above ``BLOCK`` are
   cut into blocks, and pairs of blocks are separate groups, so a bucket of any size is spread out.
3. A task takes the groups it was dealt a few thousand rows at a time and stores their fingerprints
   vertically: plane ``b`` holds bit ``b`` of 64 rows per machine word. A row is compared with a block
   of 64 others at once: each plane's differences go into bitwise counters by carry-save addition. The
   counters start so far up that the difference beyond the radius overflows them, which marks the
   row as too far; a block whose rows are all marked is abandoned.
4. A group gives back one edge per fingerprint, to the smallest one it reaches there, never its pairs.
   Components of these edges are found by star joins.

Defined cases: null and empty texts have the fingerprint zero, which links like any other; a null
``doc_id`` names a component only if it has no other id; repeated rows and equal texts are in one
component; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quoteflow.llm.common import discard, per_text, release, stored
from quoteflow.llm.graphs import components

WORDS, SEED, BITS = 3, 42, 64
RADIUS = 2
BLOCK = 4096
# A task compares this many rows at a time, or one group if it is larger (two blocks at most).
_ROWS = 4096
# Planes between two looks at which blocks to abandon.
_STEP = 8
_HASHES = 1 << 16
_GROUP = ["pair", "value", "low", "high"]


def fingerprint(text: str | None, words: int = WORDS) -> int:
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    size = min(len(found), words)
    shingles = map(b" ".join, zip(*[found[i:] for i in range(size)]))
    n = len(found) - size + 1
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64, n)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, _HASHES):  # bounded working memory for long texts
        part = hashes[at : at + _HASHES].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def planes(fingerprints: np.ndarray) -> np.ndarray:
    """Row ``b``: bit ``b`` of all fingerprints, 64 of them in a word, the first in its lowest bit."""
    n = len(fingerprints)
    bits = np.unpackbits(fingerprints.astype("<u8").view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    padded = np.zeros((BITS, -(-n // 64) * 64), np.uint8)
    padded[:, :n] = bits.T
    return np.packbits(padded, axis=1, bitorder="little").view("<u8")


def _marks(first: np.ndarray, last: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Words with a one for every row of block ``word`` that lies in [first, last)."""

    def below(row: np.ndarray) -> np.ndarray:
        held = np.clip(row - word * 64, 0, 64).astype(np.uint64)
        part = (np.uint64(1) << np.minimum(held, np.uint64(63))) - np.uint64(1)
        return np.where(held == 64, ~np.uint64(0), part)

    return below(last) & ~below(first)


def within(
    fingerprints: np.ndarray, first: np.ndarray, last: np.ndarray, radius: int = RADIUS
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) with j in [first[i], last[i]) whose fingerprints differ in at most ``radius`` bits."""
    vertical = planes(fingerprints)
    low, count = first // 64, np.where(last > first, (last - 1) // 64 - first // 64 + 1, 0)
    row = np.repeat(np.arange(len(fingerprints)), count)
    word = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())
    # Bits of rows that are out of the range, or too far by now.
    gone = ~_marks(first[row], last[row], word)
    # The counters hold 2**k - 1 - radius at first, so that the (radius + 1)th difference overflows.
    width = radius.bit_length()
    start = (1 << width) - 1 - radius
    counters = [np.full(len(row), ~np.uint64(0) if start >> c & 1 else 0, np.uint64) for c in range(width)]
    own = fingerprints.astype(np.uint64)
    for at in range(0, BITS, _STEP):
        for b in range(at, min(at + _STEP, BITS)):
            bit = np.uint64(0) - (own[row] >> np.uint64(b) & np.uint64(1))
            carry = vertical[b][word] ^ bit
            for c in range(width):
                counters[c], carry = counters[c] ^ carry, counters[c] & carry
            gone |= carry
        alive = gone != ~np.uint64(0)
        row, word, gone = row[alive], word[alive], gone[alive]
        counters = [c[alive] for c in counters]
    left = np.unpackbits((~gone).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    cell, place = np.nonzero(left)
    return row[cell], word[cell] * 64 + place


def _smallest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For every row the first row it reaches over the pairs."""
    label = np.arange(n)
    while True:
        before = label.copy()
        least = np.minimum(label[i], label[j])
        np.minimum.at(label, i, least)
        np.minimum.at(label, j, least)
        np.minimum.at(label, before, label)
        label = label[label]
        if (label == before).all():
            return label


def _parts(radius: int) -> list[list[int]]:
    """The bits of each part, as near to equal in number as can be."""
    return [p.tolist() for p in np.array_split(np.arange(BITS), radius + 2)]


def _buckets(fingerprint: Column, radius: int) -> Column:
    """An array with the value on each pair of parts: the fingerprint with its other bits off."""
    masks = []
    for a, b in combinations(_parts(radius), 2):
        mask = sum(1 << bit for bit in a + b)
        masks.append(mask - (1 << BITS) if mask >> (BITS - 1) else mask)
    return F.array(*[fingerprint.bitwiseAND(F.lit(m).cast("long")) for m in masks])


def _groups(distinct: DataFrame, radius: int) -> DataFrame:
    """Candidate groups of more than one fingerprint: their keys, ``fingerprint``, ``block``."""
    rows = distinct.select("fingerprint", F.posexplode(_buckets(F.col("fingerprint"), radius)).alias("pair", "value"))
    sizes = rows.groupBy("pair", "value").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    # Stored first, so that the join has partitions of its own and Spark can split a large bucket's.
    sizes = stored(
        sizes.select("pair", "value", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")), "simhash-sizes"
    )
    placed = rows.join(sizes, ["pair", "value"]).withColumn(
        "block", F.pmod(F.xxhash64("fingerprint", "pair"), F.col("blocks")).cast("int")
    )
    return placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "pair",
        "value",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        "block",
        "fingerprint",
    )


def _compared(keys: np.ndarray, block: np.ndarray, fingerprints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of sorted rows: each row's fingerprint and the smallest it reaches within its group."""
    n = len(keys)
    new = np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)]
    starts = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    end = np.r_[starts[1:], n][group]
    # Within a block each row is compared with those behind it; of two blocks, the first with the second.
    middle = (starts + np.add.reduceat((block != keys[:, 3]).astype(np.int64), starts))[group]
    same = keys[:, 2] == keys[:, 3]
    first = np.where(same, np.arange(n) + 1, middle)
    last = np.where(same | (np.arange(n) < middle), end, first)
    i, j = within(fingerprints, np.minimum(first, last), last, radius)
    reached = _smallest(n, i, j)
    moved = np.flatnonzero(reached != np.arange(n))
    return fingerprints[moved], fingerprints[reached[moved]]


def _edges(groups: DataFrame, radius: int) -> DataFrame:
    schema = StructType([StructField("a", LongType()), StructField("b", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, 6), np.int64)
        for batch in batches:
            part = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns])
            held = np.concatenate([held, part])
            if len(held) < _ROWS:
                continue
            # The last group may go on in the next batch.
            whole = np.flatnonzero((held[1:, :4] != held[:-1, :4]).any(axis=1))
            if len(whole):
                yield from out(held[: whole[-1] + 1])
                held = held[whole[-1] + 1 :]
        if len(held):
            yield from out(held)

    def out(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        cuts = np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(axis=1)) + 1
        at = 0
        for cut in [*cuts.tolist(), len(rows)]:
            if cut - at >= _ROWS or cut == len(rows):
                a, b = _compared(rows[at:cut, :4], rows[at:cut, 4], rows[at:cut, 5].view(np.uint64), radius)
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])
                at = cut

    dealt = groups.repartition(*_GROUP).sortWithinPartitions(*_GROUP, "block", "fingerprint")
    return dealt.mapInArrow(run, schema).distinct()


def link(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits), ``component_id`` for every row."""

    def run(texts: list[str | None]):
        made = np.array([fingerprint(t) for t in texts], np.uint64)
        return [made.view(np.int64).tolist()]

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = stored(per_text(rows, [StructField("fingerprint", LongType())], run, ["doc_id"]), "simhash-rows")
    distinct = stored(
        rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "simhash-distinct"
    )
    edges = stored(_edges(_groups(distinct, radius), radius), "simhash-edges")
    release(docs.sparkSession)
    stars = components(edges)
    named = distinct.join(stars.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn(
        "root", F.coalesce("root", "fingerprint")
    )
    ids = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = stored(named.select("fingerprint", "root").join(ids, "root").drop("root"), "simhash-components")
    discard(distinct, edges)
    return rows.join(named, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )
