"""Product codes of vectors by an exact Lloyd iteration that follows the entries that moved.

Components are integers, ``floor(1024 * x)``; a vector is cut into ``parts`` equal parts, and every
part position has a codebook of at most ``entries`` entries. It starts as that part of the vectors with
the smallest ids. A round assigns every part to the nearest entry (squared Euclidean distance, ties to
the lower index), then replaces every entry by the floor of the mean of its parts.

A row keeps, for each part, the entry it was assigned and the exact distance to it. If that entry
stayed where it was, no entry that stayed can have become nearer, so the part is compared with the
moved entries only; if its entry moved, with all of them. Rows are rewritten once a round with their
new state. The same pass gives each task's changes of the sums and counts of every entry (what left
it and what joined it), so a round reads and writes the rows once, and the driver gets at most
``parts * entries`` sums, however many rows there are. The codebooks are of that size, too.

All arithmetic is on integers: in double precision where every intermediate value is below 2**53,
else in 64 bits. Components are held within +-2**25 (a value beyond 32,768 is not a direction any
more), so that nothing overflows for parts of up to 512 components.

Defined cases: rows whose vector is null, or holds a null or a component that is not finite, are
dropped, as are those whose length differs from that of the smallest id's vector (or cannot be cut
into equal parts); a null ``vec_id`` is larger than any other; of equal ids the smaller vector comes
first; repeated rows count each; with fewer rows than entries the codebooks are shorter; a table
without rows gives an empty result; null labels are one label; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from quoteflow.llm.common import discard, stored

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
_BOUND = 1 << 25
_ROWS = 4096  # rows compared at a time
_EXACT = 2.0**53


@dataclass(frozen=True)
class Codebooks:
    """``values[p, e]`` is entry ``e`` of part ``p``; ``moved[p, e]`` whether the last update changed it."""

    values: np.ndarray
    moved: np.ndarray

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.values.ravel().tolist())).encode()).hexdigest()


def distances(parts: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of every part (row) to every entry (row)."""
    largest = max(np.abs(parts).max(initial=0), np.abs(entries).max(initial=0))
    if 4.0 * largest * largest * max(parts.shape[1], 1) < _EXACT:
        a, b = parts.astype(np.float64), entries.astype(np.float64)
        found = (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None, :]
        return found.astype(np.int64)
    out = np.empty((len(parts), len(entries)), np.int64)
    for e, entry in enumerate(entries):
        out[:, e] = ((parts - entry) ** 2).sum(axis=1)
    return out


def assigned(
    parts: np.ndarray, code: np.ndarray, distance: np.ndarray, entries: np.ndarray, moved: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """New code and distance of parts of one position; a code of -1 is one not assigned yet."""
    code, distance = code.copy(), distance.copy()
    again = (code < 0) | moved[code]
    if again.any():
        found = distances(parts[again], entries)
        code[again] = found.argmin(axis=1)
        distance[again] = found.min(axis=1)
    active = np.flatnonzero(moved)
    stayed = np.flatnonzero(~again)
    if len(active) and len(stayed):
        found = distances(parts[stayed], entries[active])
        nearest = found.argmin(axis=1)
        best, at = found[np.arange(len(stayed)), nearest], active[nearest]
        better = (best < distance[stayed]) | ((best == distance[stayed]) & (at < code[stayed]))
        code[stayed[better]], distance[stayed[better]] = at[better], best[better]
    return code, distance


def _vectors(table: DataFrame) -> DataFrame:
    """``vec_id``, ``label``, ``vector`` (integer components) of the rows that count."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scaled = F.transform("embedding", lambda x: _integer(x.cast("double")))
    return table.filter(F.col("embedding").isNotNull()).filter(whole).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label"), scaled.alias("vector")
    )


def _integer(x):
    bound = float(_BOUND // SCALE)
    return F.floor(F.greatest(F.least(x, F.lit(bound)), F.lit(-bound)) * SCALE).cast("int")


def _blob(values: np.ndarray) -> pa.Array:
    """Rows of a contiguous matrix as binary values."""
    width = values.shape[1] * values.itemsize
    made = pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(width), len(values), [None, pa.py_buffer(np.ascontiguousarray(values))]
    )
    return made.cast(pa.binary())


def _matrix(column: pa.Array, dtype, width: int) -> np.ndarray:
    flat = b"".join(column.to_pylist())
    return np.frombuffer(flat, dtype).reshape(-1, width)


class _Round:
    """One pass over the rows: new codes and distances, and the changes of every entry's sum."""

    def __init__(self, books: Codebooks, label):
        self.books = books
        # Rows of the table have ``entry`` null; those that carry changes have nothing else.
        self.schema = StructType(
            [
                StructField("vec_id", LongType()),
                label,
                StructField("vector", BinaryType()),
                StructField("codes", BinaryType()),
                StructField("distances", BinaryType()),
                StructField("entry", IntegerType()),
                StructField("joined", LongType()),
                StructField("sums", ArrayType(LongType())),
            ]
        )

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(self.schema)
        parts, entries, width = self.books.values.shape
        sums = np.zeros((parts, entries, width), np.int64)
        joined = np.zeros((parts, entries), np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(at, _ROWS)
                vectors = _matrix(batch.column(2), "<i4", parts * width).astype(np.int64).reshape(-1, parts, width)
                codes = _matrix(batch.column(3), "<i2", parts).astype(np.int64)
                found = _matrix(batch.column(4), "<i8", parts)
                now, far = np.empty_like(codes), np.empty_like(found)
                for p in range(parts):
                    now[:, p], far[:, p] = assigned(
                        vectors[:, p], codes[:, p], found[:, p], self.books.values[p], self.books.moved[p]
                    )
                    changed = np.flatnonzero(now[:, p] != codes[:, p])
                    left = changed[codes[changed, p] >= 0]
                    for rows, code, sign in ((changed, now, 1), (left, codes, -1)):
                        np.add.at(sums[p], code[rows, p], sign * vectors[rows, p])
                        joined[p] += sign * np.bincount(code[rows, p], minlength=entries)
                none = [pa.nulls(batch.num_rows, f.type) for f in list(arrow)[5:]]
                columns = [batch.column(0), batch.column(1), batch.column(2)]
                columns += [_blob(now.astype("<i2")), _blob(far.astype("<i8")), *none]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)
        used = np.flatnonzero((joined != 0).ravel() | (sums != 0).any(axis=2).ravel())
        none = [pa.nulls(len(used), f.type) for f in list(arrow)[:5]]
        changes = pa.array(sums.reshape(parts * entries, width)[used].tolist(), arrow.field("sums").type)
        columns = [*none, pa.array(used, pa.int32()), pa.array(joined.ravel()[used]), changes]
        yield pa.RecordBatch.from_arrays(columns, schema=arrow)


def _pass(rows: DataFrame, books: Codebooks) -> DataFrame:
    step = _Round(books, rows.schema["label"])
    columns = ["vec_id", "label", "vector", "codes", "distances"]
    return stored(rows.select(*columns).mapInArrow(step, step.schema), "codes", compression="zstd")


def _changes(done: DataFrame, shape: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray]:
    """The changes of all tasks added up: at most one row per entry of every part."""
    parts, entries, width = shape
    adding = [F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(width)]
    found = done.filter("entry is not null").groupBy("entry").agg(F.sum("joined").alias("joined"), *adding).collect()
    sums, joined = np.zeros((parts * entries, width), np.int64), np.zeros(parts * entries, np.int64)
    for row in found:
        joined[row[0]], sums[row[0]] = row[1], row[2:]
    return sums.reshape(shape), joined.reshape(parts, entries)


def encode(
    table: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[DataFrame, Codebooks]:
    """Rows (``vec_id``, ``label``, ``codes``, ``distances``: as many 2 and 8 byte numbers as parts) and the codebooks."""
    rows = _vectors(table.select("vec_id", "label", "embedding"))
    fits = rows.filter((F.size("vector") > 0) & (F.size("vector") % parts == 0))
    order = [F.col("vec_id").asc_nulls_last(), "vector"]
    size = fits.select("vec_id", "vector").sort(*order).limit(1).select(F.size("vector")).first()
    size = size[0] if size else 0
    rows = fits.filter(F.size("vector") == size)
    seeds = [r[0] for r in rows.select("vec_id", "vector").sort(*order).limit(entries).select("vector").collect()]
    width = size // parts
    values = np.array(seeds, np.int64).reshape(len(seeds), parts, width).transpose(1, 0, 2).copy()
    books = Codebooks(values, np.ones(values.shape[:2], bool))
    sums, joined = np.zeros(values.shape, np.int64), np.zeros(values.shape[:2], np.int64)
    done = _pass(_unassigned(rows, parts), books)
    for _ in range(rounds):
        more, gone = _changes(done, values.shape)
        sums, joined = sums + more, joined + gone
        means = np.where(joined[:, :, None] > 0, sums // np.maximum(joined, 1)[:, :, None], books.values)
        books = Codebooks(means, (means != books.values).any(axis=2))
        last, done = done, _pass(done.filter("entry is null"), books)
        discard(last)
    return done.filter("entry is null").select("vec_id", "label", "codes", "distances"), books


def _unassigned(rows: DataFrame, parts: int) -> DataFrame:
    """The rows with their components packed and no code yet."""
    schema = StructType(
        [
            *rows.select("vec_id", "label").schema,
            StructField("vector", BinaryType()),
            StructField("codes", BinaryType()),
            StructField("distances", BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if n:
                flat = batch.column(2).flatten().to_numpy().astype("<i4").reshape(n, -1)
                blank = [_blob(np.full((n, parts), -1, "<i2")), _blob(np.zeros((n, parts), "<i8"))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), _blob(flat), *blank], [f.name for f in schema]
                )

    return rows.select("vec_id", "label", "vector").mapInArrow(run, schema)


def quantize(table: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``vec_id``, ``code``, ``error``, ``label_error``, ``codebooks_sha256`` for every row that counts."""
    rows, books = encode(table, parts, entries, rounds)

    def digits(blob: str, i: int, bytes_: int) -> str:
        """The little-endian number ``i`` of a binary column as hexadecimal digits, the highest first."""
        at = [f"substr(hex({blob}), {2 * (i * bytes_ + b) + 1}, 2)" for b in reversed(range(bytes_))]
        return f"concat({', '.join(at)})"

    code = F.lower(F.expr("concat(" + ", ".join(f"right({digits('codes', p, 2)}, 2)" for p in range(parts)) + ")"))
    error = sum(F.conv(F.expr(digits("distances", p, 8)), 16, 10).cast("long") for p in range(parts))
    rows = rows.select("vec_id", "label", code.alias("code"), error.alias("error"))
    known, label = F.col("label").isNotNull(), F.coalesce(F.col("label").cast("string"), F.lit(""))
    rows = stored(rows.select("vec_id", "code", "error", known.alias("known"), label.alias("label")), "codes-rows")
    # Stored, so that the join has partitions of its own and Spark can split those of a large label.
    totals = stored(rows.groupBy("known", "label").agg(F.sum("error").alias("label_error")), "codes-labels")
    return rows.join(totals, ["known", "label"]).select(
        "vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256")
    )
