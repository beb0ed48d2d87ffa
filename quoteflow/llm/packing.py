"""Packing along a space-filling curve.

Each document's token ids are hashed into a count vector, which is scaled to unit length and
projected to four dimensions with fixed random signs. The Hilbert key of the point orders the
documents, so that neighbours along the curve are alike, and the documents are laid end to end in
that order and cut every ``length`` tokens. Only the very last sequence can be short.

The ids are computed once and stored. Only keys and lengths are sorted; running totals over the
sorted rows are carried between sort partitions by a summary of a row per partition, so no task
holds a curve segment larger than a sort partition, and a third of all rows at one point are split
like any others. The offsets are then joined to the stored ids by row number.

Defined cases: a null or empty text has only its end id; tied points go by ``doc_id`` (null first)
and then row; repeated rows are packed each; texts of any length are cut over as many sequences as
they need; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from quoteflow.llm.common import release, slices, stored
from quoteflow.llm.tokens import Tokens
from quoteflow.operators import scan

LENGTH = 1024
END_ID = 0
DIMENSIONS, BITS, BUCKETS = 4, 12, 256
_SLICE_CHARS = 8_000_000  # of text tokenized at once: equal words in them are encoded once
_REACH = 6.0  # coordinates are cut off at this distance from the middle

PIECES = StructType(
    [
        StructField(name, LongType())
        for name in (
            "doc_id",
            "start",
            "length",
            "ids_crc32",
            "doc_tokens",
            "sequence_id",
            "offset",
        )
    ]
)


def _mixed(values: np.ndarray) -> np.ndarray:
    """Well spread 64-bit numbers, one for each of ``values``."""
    x = values.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signs() -> np.ndarray:
    """The fixed projection: one row of +1 / -1 per bucket."""
    bits = _mixed(np.arange(BUCKETS * DIMENSIONS)) & np.uint64(1)
    return (bits.astype(np.float64) * 2 - 1).reshape(BUCKETS, DIMENSIONS)


def points(counts: np.ndarray) -> np.ndarray:
    """Grid coordinates of the count vectors (rows), below 2**BITS."""
    norms = np.linalg.norm(counts, axis=1, keepdims=True)
    projected = (counts / np.where(norms == 0, 1, norms)) @ signs()
    scaled = (np.clip(projected, -_REACH, _REACH) + _REACH) / (2 * _REACH)
    return np.minimum((scaled * 2**BITS).astype(np.int64), 2**BITS - 1)


def hilbert(grid: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position along the Hilbert curve of the grid points (rows).

    Works the point's bits from the top: undo the turns and mirrors of the larger cells, then read
    the bits of all axes, as a Gray code, one after another.
    """
    axes = [grid[:, i].astype(np.int64) for i in range(grid.shape[1])]
    for shift in range(bits - 1, 0, -1):
        bit, below = 1 << shift, (1 << shift) - 1
        for i in range(len(axes)):
            mirrored = (axes[i] & bit) != 0
            swap = np.where(mirrored, 0, (axes[0] ^ axes[i]) & below)
            axes[0] = axes[0] ^ np.where(mirrored, below, swap)
            axes[i] = axes[i] ^ (swap if i else 0)
    for i in range(1, len(axes)):
        axes[i] = axes[i] ^ axes[i - 1]
    flip = np.zeros_like(axes[0])
    for shift in range(bits - 1, 0, -1):
        flip ^= np.where(axes[-1] & (1 << shift), (1 << shift) - 1, 0)
    axes = [a ^ flip for a in axes]
    key = np.zeros_like(axes[0])
    for shift in range(bits - 1, -1, -1):
        for axis in axes:
            key = (key << 1) | ((axis >> shift) & 1)
    return key


def tokenized(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id``, ``ids`` (with the end id), ``n``, ``curve`` for every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = StructType(
        [
            StructField("doc_id", LongType()),
            StructField("ids", BinaryType()),
            StructField("n", LongType()),
            StructField("curve", LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(tokenizer)
        names = [f.name for f in schema]
        for batch in batches:
            for part in slices(batch, 1, _SLICE_CHARS):
                ids, count = tokens.many(part.column(1))
                ends = np.cumsum(count)
                columns = [
                    part.column(0),
                    _binary(np.insert(ids, ends, END_ID), count + 1),
                    pa.array(count + 1),
                    pa.array(hilbert(points(_bucket_counts(ids, count)))),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(run, schema)


def _bucket_counts(ids: np.ndarray, count: np.ndarray) -> np.ndarray:
    """One row per document: the logarithm of one plus the number of its ids in each bucket."""
    cell = np.repeat(np.arange(len(count)) * BUCKETS, count) + _BUCKET_OF[ids & 0xFFFF]
    return np.log1p(np.bincount(cell, minlength=len(count) * BUCKETS).reshape(-1, BUCKETS))


def _binary(values: np.ndarray, count: np.ndarray) -> pa.Array:
    offsets = np.r_[0, np.cumsum(count)] * values.dtype.itemsize
    made = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(count), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(values)]
    )
    return made.cast(pa.binary())


_BUCKET_OF = (_mixed(np.arange(2**16)) % np.uint64(BUCKETS)).astype(np.int64)


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """The pieces of all documents: which ids of a document lie where in which sequence.

    ``start`` and ``length`` are counted in the document's own ids, ``offset`` in the sequence;
    ``ids_crc32`` is the checksum of the piece as little-endian unsigned 32-bit ids.
    """
    numbered = tokenized(docs, tokenizer).withColumn("row", F.monotonically_increasing_id())
    rows = stored(numbered, "packed-ids", compression="zstd")
    order = scan.running(
        rows.select("row", "doc_id", "n", "curve"), ["curve", "doc_id", "row"], {"end": ("sum", F.col("n"))}
    )
    at = stored(order.select(F.col("row").alias("at_row"), (F.col("end") - F.col("n")).alias("at")), "packed-at")
    del order
    release(docs.sparkSession)
    placed = rows.select("row", "doc_id", "n", "ids").join(
        at.hint("shuffle_hash"), F.col("row") == F.col("at_row")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(PIECES)
        for batch in batches:
            columns: list[list] = [[] for _ in PIECES]
            for doc_id, n, ids, begin in zip(*[c.to_pylist() for c in batch.columns]):
                wide = np.frombuffer(ids, f"<u{len(ids) // n}").astype("<u4").tobytes()
                start = 0
                while start < n:
                    sequence, offset = divmod(begin + start, length)
                    size = min(length - offset, n - start)
                    crc = zlib.crc32(wide[4 * start : 4 * (start + size)])
                    for column, value in zip(columns, (doc_id, start, size, crc, n, sequence, offset)):
                        column.append(value)
                    start += size
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

    return placed.select("doc_id", "n", "ids", "at").mapInArrow(run, PIECES)
