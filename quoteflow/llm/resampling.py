"""Importance resampling towards a target, with an exact cutoff by weighted median of medians.

Features of a text (ASCII letters in lower case) are its runs of one to ``longest`` words, repeats
counted; a feature's bucket is its crc32 modulo ``buckets``. How much more frequent a bucket is in the
target than in the documents gives its gain, an integer; a document's weight is the sum of its
features' gains. Documents of enough words get a score, the weight plus random noise that depends on
the id alone, and the highest scores are drawn (without replacement, in the manner of Gumbel's noise).

1. Texts are taken apart once: a document's buckets are stored as one array of 2-byte numbers. Counts
   per bucket are added up inside a task first, so at most ``buckets`` rows a task are exchanged.
2. The gains, one array of ``buckets`` numbers, go to the tasks, and the stored arrays are scored.
3. The cutoff is the key of rank k in the order (score, id, row). Each task gives the median of
   every ``CHUNK`` remaining keys and their number; the median of the medians, weighted by these
   numbers, has at least a quarter of the remaining keys on either side. Counting the keys up to it
   tells which side holds the cutoff, and the other is discarded. Remaining keys are stored again
   when they have shrunk to a quarter. The last ``FEW`` are cut at their own rank.
4. Only the winners are sorted, by range, and numbered.

Defined cases: a null or empty text has no features and is not drawn; a null ``doc_id`` comes after
all others and its noise is that of an empty id; of equal keys the text with fewer features comes
first, then the earlier row; repeated rows are drawn each; an empty table gives an empty result; an
empty target counts no feature; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from quoteflow.llm.common import discard, per_text, stored
from quoteflow.operators import scan

LONGEST, BUCKETS = 1, 10_000
SEED, PERCENT, LEAST_WORDS = 2024, 10, 20
CHUNK = 1 << 18
# So many remaining keys are put in order at once.
FEW = 1 << 12
_KNOWN = 200_000  # buckets of words kept by a task; changes no result
# A smaller key is drawn earlier.
_KEY = ["minus", "id", "n_features", "tie"]
_NO_ID = 2**63 - 1

# Bytes of words as they are, letters in lower case; all others are blanks.
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


class _Buckets(dict):
    """Feature to bucket; empties itself when full."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= _KNOWN:
            self.clear()
        made = self[feature] = zlib.crc32(feature) % self.buckets
        return made


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORDS).split()


def featured(docs: DataFrame, keep: list[str], longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """Columns ``keep``, ``n_words``, ``n_features`` and ``held``: the features' buckets, 2 bytes each."""
    if buckets > 1 << 16:
        raise ValueError("buckets are kept in two bytes")
    fields = [StructField("n_words", LongType()), StructField("n_features", LongType()), StructField("held", BinaryType())]

    def run(texts: list[str | None]):
        known, counts, sizes, held = _Buckets(buckets), [], [], []
        for text in texts:
            own = words(text)
            made = list(map(known.__getitem__, own))
            for size in range(2, longest + 1):
                runs = zip(*[own[i:] for i in range(size)])
                made += [known[b" ".join(r)] for r in runs]
            counts.append(len(own))
            sizes.append(len(made))
            held.append(np.array(made, "<u2").tobytes())
        return [counts, sizes, held]

    return per_text(docs, fields, run, keep)


def counted(rows: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all rows each bucket holds: at most ``buckets`` sums come to the driver."""
    schema = StructType([StructField("bucket", LongType()), StructField("n", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for held in batch.column(0):
                total += np.bincount(np.frombuffer(held.as_buffer(), "<u2"), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for bucket, n in rows.select("held").mapInArrow(run, schema).groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    buckets = len(source)
    s, t = float(source.sum()), float(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((tb + 1.0) * (s + buckets) / ((sb + 1.0) * (t + buckets))))
            for sb, tb in zip(source.tolist(), target.tolist())
        ],
        np.int64,
    )


def noise(doc_id: int | None, seed: int = SEED) -> int:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return math.floor(-1000 * math.log(-math.log((int(digest[:8], 16) + 0.5) / 4294967296)))


def scored(rows: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight`` and ``score`` of rows of :func:`featured`."""
    names = ["doc_id", "n_words", "n_features", "weight", "score"]
    schema = StructType([StructField(n, LongType()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weight = np.array(
                [gain[np.frombuffer(held.as_buffer(), "<u2")].sum() for held in batch.column(3)], np.int64
            )
            score = weight + np.array([noise(i, seed) for i in batch.column(0).to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(weight), pa.array(score)], names
            )

    return rows.select("doc_id", "n_words", "n_features", "held").mapInArrow(run, schema)


def _upto(key: tuple[int, ...]) -> Column:
    """Whether a row's key is at most ``key``."""
    within = F.lit(True)
    for name, value in reversed(list(zip(_KEY, key))):
        at = F.lit(value).cast("long")
        within = (F.col(name) < at) | ((F.col(name) == at) & within)
    return within


def _medians(keys: DataFrame) -> list[tuple[tuple[int, ...], int]]:
    """The lower median of every ``CHUNK`` keys of a task, and how many keys it stands for."""
    schema = StructType([StructField(n, LongType()) for n in [*_KEY, "n"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def median(held: list[np.ndarray]) -> pa.RecordBatch:
            rows = np.concatenate(held)
            at = np.lexsort(rows.T[::-1])[(len(rows) - 1) // 2]
            made = [*rows[at].tolist(), len(rows)]
            return pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in made], [f.name for f in schema])

        held, n = [], 0
        for batch in batches:
            rows = np.column_stack([c.to_numpy() for c in batch.columns])
            while n + len(rows) >= CHUNK:
                held.append(rows[: CHUNK - n])
                rows = rows[CHUNK - n :]
                yield median(held)
                held, n = [], 0
            if len(rows):
                held.append(rows)
                n += len(rows)
        if n:
            yield median(held)

    return [(tuple(row[:-1]), row[-1]) for row in keys.select(*_KEY).mapInArrow(run, schema).collect()]


def weighted_median(medians: list[tuple[tuple[int, ...], int]]) -> tuple[int, ...]:
    """The first key, in order, that half of the weight is at or below."""
    total, seen = sum(n for _, n in medians), 0
    for key, n in sorted(medians):
        seen += n
        if 2 * seen >= total:
            return key
    raise ValueError("no keys")


def cutoff(keys: DataFrame, rank: int, n: int) -> tuple[int, ...]:
    """The key of this rank (from 1) among the ``n`` stored keys (columns ``_KEY``, all different)."""
    held, held_n, mine = keys, n, None
    left, low, high = n, None, None
    while True:
        remaining = held
        if low is not None:
            remaining = remaining.filter(~_upto(low))
        if high is not None:
            remaining = remaining.filter(_upto(high))
        if left <= FEW:
            found = tuple(remaining.sort(*_KEY).limit(rank).agg(F.max(F.struct(*_KEY))).first()[0])
            break
        if 4 * left <= held_n:
            last, mine = mine, stored(remaining.select(*_KEY), "remaining-keys")
            held, held_n, remaining = mine, left, mine
            low = high = None
            if last is not None:
                discard(last)
        pivot = weighted_median(_medians(remaining))
        below = remaining.filter(_upto(pivot)).count()
        if below == rank:
            found = pivot
            break
        if below > rank:
            high, left = pivot, below
        else:
            low, left, rank = pivot, left - below, rank - below
    if mine is not None:
        discard(mine)
    return found


def resample(
    docs: DataFrame,
    target: DataFrame,
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id``, ``n_features``, ``weight``, ``score``, ``rank`` (null if not drawn) for every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    features = stored(featured(rows, ["doc_id"], longest, buckets), "features", compression="zstd")
    wanted = featured(target.select("text"), [], longest, buckets)
    gain = gains(counted(features, buckets), counted(wanted, buckets))
    keyed = scored(features, gain, seed).withColumns(
        {
            "minus": -F.col("score"),
            "id": F.coalesce("doc_id", F.lit(_NO_ID)),
            "tie": F.monotonically_increasing_id(),
        }
    )
    keyed = stored(keyed, "scores")
    discard(features)
    able = keyed.filter(F.col("n_words") >= least_words)
    n = able.count()
    drawn = percent * n // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    lost = keyed.select(*columns, F.lit(None).cast("long").alias("rank"))
    if not drawn:
        return lost
    winner = (F.col("n_words") >= least_words) & _upto(cutoff(able.select(*_KEY), drawn, n))
    ranked = scan.running(keyed.filter(winner), _KEY, {"rank": ("sum", F.lit(1))})
    return ranked.select(*columns, F.col("rank").cast("long").alias("rank")).unionAll(
        keyed.filter(~winner).select(*columns, F.lit(None).cast("long").alias("rank"))
    )
