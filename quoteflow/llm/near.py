"""N-gram Jaccard join with Bayesian candidate pruning.

A text's shingles are its runs of five words (all its words if it has fewer). Two different texts
link when the Jaccard similarity of their shingle sets reaches the threshold.

1. Every text gets a MinHash signature. Equal texts are one from here on.
2. Texts that agree on a band of the signature are candidates. Buckets of more than one text are
   cut into blocks by hash, and pairs of blocks are separate groups, so a bucket of any size is
   spread over many tasks; a pair belongs to the first band it agrees on, and is seen once.
3. Inside a group, signatures are compared a few values at a time. A pair is dropped as soon as the
   posterior probability of reaching the threshold (uniform prior) is below the tolerance.
4. Texts with a pair left get their shingle sets, and those pairs are verified exactly.

A group gives back one row per text (its links there, and a link that joins it to the others), never
its pairs. Classes are the connected components of links and equal texts.

A pair just at the threshold of 0.8 shares none of the bands with a probability of 6e-7, and is
pruned with one of about 1e-9; others of these are rarer by far.

Defined cases: null and empty texts have no shingles and link to nothing, but equal ones are copies
of each other (null is like empty); a null ``doc_id`` never names a class that has another id;
repeated rows are copies; an empty table gives an empty result; other columns are kept by
:func:`one_of_each`.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    IntegerType,
    LongType,
    StructField,
    StructType,
)

from quoteflow.llm.common import discard, per_group, per_text, release, slices, small_batches, stored
from quoteflow.llm.graphs import components

WORDS = 5
THRESHOLD = Fraction(4, 5)
HASHES, STEP = 96, 16
BANDS, ROWS = 20, 3
TOLERANCE = 1e-9
BLOCK = 256

_GROUP = ["band", "bucket", "low", "high"]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SEEDS = _mixed(np.arange(1, 2 * HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTOR = (_SEEDS[:HASHES] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_SHIFT = (_SEEDS[HASHES:] >> np.uint64(32)).astype(np.uint32)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles."""
    found = text.encode().split()
    n = len(found)
    if not n:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, n)
    size = min(n, words)
    rolled = np.zeros(n - size + 1, np.uint64)
    for i in range(size):
        rolled = rolled * _BASE + hashes[i : n - size + 1 + i]
    return np.unique(_mixed(rolled ^ np.uint64(size)))


def signature(hashes: np.ndarray) -> np.ndarray:
    """MinHash values; long sets go through in pieces, so the working memory is bounded."""
    small = (hashes >> np.uint64(32)).astype(np.uint32)
    best = np.full(HASHES, 2**32 - 1, np.uint32)
    for at in range(0, len(small), 2048):
        part = small[None, at : at + 2048] * _FACTOR[:, None] + _SHIFT[:, None]
        best = np.minimum(best, part.min(axis=1))
    return best


def bands(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit value per band; equal exactly when the band's MinHash values are (or nearly so)."""
    parts = signatures[:, : BANDS * ROWS].astype(np.uint64).reshape(-1, BANDS, ROWS)
    out = np.arange(BANDS, dtype=np.uint64)[None, :] + np.uint64(1)
    for i in range(ROWS):
        out = _mixed(out * _BASE + parts[:, :, i])
    return out.view(np.int64)


def fewest_matches(threshold: Fraction = THRESHOLD, tolerance: float = TOLERANCE) -> dict[int, int]:
    """After n compared values: the fewest matches that keep a pair.

    With a uniform prior the posterior of the similarity after m matches in n is Beta(m+1, n-m+1), and
    its chance to reach t is that of at most m successes in n+1 trials with probability t.
    """
    t, out = float(threshold), {}
    for n in range(STEP, HASHES + 1, STEP):
        chance = 0.0
        for m in range(n + 1):
            chance += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if chance >= tolerance:
                out[n] = m
                break
    return out


_FEWEST = fewest_matches()


def surviving(group: tuple, blocks: np.ndarray, signatures: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (as two index arrays) of this group that the pruning leaves."""
    band, _, low, high = group
    values = bands(signatures)
    left = np.flatnonzero(blocks == low)
    right = left if low == high else np.flatnonzero(blocks == high)
    own = values[left][:, None, band] == values[right][None, :, band]
    if low == high:
        own &= np.triu(np.ones(own.shape, bool), 1)
    for earlier in range(band):  # a pair belongs to the first band it agrees on
        own &= values[left][:, None, earlier] != values[right][None, :, earlier]
    i, j = np.nonzero(own)
    i, j = left[i], right[j]
    matches = np.zeros(len(i), np.int64)
    for n in range(STEP, HASHES + 1, STEP):
        part = signatures[:, n - STEP : n]
        matches = matches + (part[i] == part[j]).sum(axis=1)
        keep = matches >= _FEWEST[n]
        i, j, matches = i[keep], j[keep], matches[keep]
    return i, j


def verified(
    i: np.ndarray, j: np.ndarray, sets: list[np.ndarray], threshold: Fraction = THRESHOLD
) -> tuple[np.ndarray, np.ndarray]:
    """The pairs whose sets reach the threshold.

    Shared shingles are counted for all pairs at once as a product of incidence matrices, a bounded
    number of shingles at a time.
    """
    used = np.unique(np.concatenate([i, j]))
    sizes = np.array([len(s) for s in sets], np.int64)
    joined = np.concatenate([sets[k] for k in used])
    owner = np.repeat(np.arange(len(used)), sizes[used])
    _, column, count = np.unique(joined, return_inverse=True, return_counts=True)
    shared = count[column] > 1
    column, owner = column[shared], owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    starts = np.r_[True, column[1:] != column[:-1]] if len(column) else np.zeros(0, bool)
    column = np.cumsum(starts) - 1
    both = np.zeros((len(used), len(used)), np.float64)
    width = 4096
    for begin in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [begin, begin + width])
        incidence = np.zeros((len(used), width), np.float32)
        incidence[owner[a:b], column[a:b] - begin] = 1
        both += incidence @ incidence.T
    at = np.zeros(len(sets), np.int64)
    at[used] = np.arange(len(used))
    common = both[at[i], at[j]].astype(np.int64)
    union = sizes[i] + sizes[j] - common
    keep = common * threshold.denominator >= union * threshold.numerator
    return i[keep], j[keep]


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> list[int]:
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in zip(i.tolist(), j.tolist()):
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def _members(rows: list[tuple]) -> list[tuple]:
    """A repeated row would otherwise be a partner of itself."""
    return list({row[0]: row for row in rows}.values())


def _light(group: tuple, rows: list[tuple]) -> list[tuple]:
    """Members (key, block, signature) that have a pair left here."""
    rows = _members(rows)
    signatures = np.frombuffer(b"".join(r[2] for r in rows), np.uint32).reshape(-1, HASHES)
    i, j = surviving(group, np.array([r[1] for r in rows]), signatures)
    return [(*group, rows[k][0], rows[k][1]) for k in np.unique(np.concatenate([i, j])).tolist()]


def _heavy(group: tuple, rows: list[tuple]) -> list[tuple]:
    """(key, links here, a text of its class here) for members (key, block, shingles) with links."""
    rows = _members(rows)
    sets = [np.frombuffer(r[2], np.uint64) for r in rows]
    signatures = np.array([signature(s) for s in sets])
    i, j = surviving(group, np.array([r[1] for r in rows]), signatures)
    if not len(i):
        return []
    i, j = verified(i, j, sets)
    links = np.bincount(np.concatenate([i, j]), minlength=len(rows))
    roots = _roots(len(rows), i, j)
    return [(rows[k][0], int(links[k]), rows[roots[k]][0]) for k in np.flatnonzero(links).tolist()]


def _key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def _signed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``key``, ``signature`` (null without shingles) and ``bands`` for every row."""
    fields = [
        StructField("key", BinaryType()),
        StructField("signature", BinaryType()),
        StructField("bands", ArrayType(LongType())),
    ]

    def run(texts: list[str | None]):
        keys, signatures, found = [], [], []
        for text in texts:
            keys.append(hashlib.md5((text or "").encode()).digest())
            hashes = shingles(text or "")
            values = signature(hashes) if len(hashes) else None
            signatures.append(None if values is None else values.tobytes())
            found.append([] if values is None else bands(values[None])[0].tolist())
        return [keys, signatures, found]

    return per_text(docs.select("doc_id", "text"), fields, run, ["doc_id"])


def _groups(texts: DataFrame) -> DataFrame:
    """Candidate groups: ``band``, ``bucket``, ``low``, ``high``, ``key``, ``block``."""
    rows = texts.select("key", F.posexplode("bands").alias("band", "bucket"))
    sizes = (
        rows.groupBy("band", "bucket")
        .agg(
            F.count(F.lit(1)).alias("size"),
            F.bit_xor(F.xxhash64("key")).alias("mark"),
            F.min("key").alias("least"),
        )
        .filter("size > 1")
    )
    # Of buckets with the same texts the first band's is enough: it holds all their pairs.
    kept = sizes.groupBy("size", "mark", "least").agg(F.min(F.struct("band", "bucket")).alias("b"))
    kept = kept.select("b.band", "b.bucket", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    placed = rows.join(kept, ["band", "bucket"]).withColumn(
        "block", F.pmod(F.xxhash64("key", "band"), F.col("blocks")).cast("int")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return placed.withColumn("other", other).select(
        "band",
        "bucket",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        "key",
        "block",
    )


def _pruned(texts: DataFrame) -> DataFrame:
    """The rows of the groups whose text has a pair left there."""
    schema = StructType(
        [
            StructField("band", IntegerType()),
            StructField("bucket", LongType()),
            StructField("low", IntegerType()),
            StructField("high", IntegerType()),
            StructField("key", BinaryType()),
            StructField("block", IntegerType()),
        ]
    )
    rows = _groups(texts).join(texts.select("key", "signature"), "key")
    return per_group(rows.select(*_GROUP, "key", "block", "signature"), _GROUP, schema, _light)


def _checked(docs: DataFrame, texts: DataFrame, pruned: DataFrame) -> DataFrame:
    """``key``, ``links``, ``peer`` per text and group with verified links."""
    wanted = pruned.groupBy("key").agg(
        F.collect_list(F.struct(*_GROUP, "block")).alias("groups")
    ).join(texts.select("key", "first_id"), "key")
    rows = docs.select(F.col("doc_id"), "text", _key(F.col("text")).alias("key"))
    wanted = wanted.withColumnRenamed("key", "w_key")
    same = (F.col("key") == F.col("w_key")) & F.col("doc_id").eqNullSafe(F.col("first_id"))
    first = rows.join(wanted, same).select("key", "text", "groups")
    schema = StructType(
        [*pruned.select(*_GROUP, "key", "block").schema, StructField("shingles", BinaryType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)

        def out(made: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*made), arrow)], schema=arrow
            )

        for batch in (part for whole in batches for part in slices(whole, 1)):
            made, held = [], 0
            for key, text, groups in zip(*[c.to_pylist() for c in batch.columns]):
                payload = shingles(text).tobytes()
                for g in groups:
                    made.append((g["band"], g["bucket"], g["low"], g["high"], key, g["block"], payload))
                    held += len(payload)
                    if held > 8_000_000:
                        yield out(made)
                        made, held = [], 0
            if made:
                yield out(made)

    result = StructType(
        [StructField("key", BinaryType()), StructField("links", LongType()), StructField("peer", BinaryType())]
    )
    return per_group(first.mapInArrow(run, schema), _GROUP, result, _heavy)


def classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored rows (``doc_id``, ``key``) and, per distinct text, ``key``, ``first_id``, ``class_id``,
    ``n_links`` (different texts linked to it), ``copies`` (rows with this text) and ``stands`` (whether
    it is the text of its class with the smallest id)."""
    spark = docs.sparkSession
    with small_batches(spark):
        rows = stored(_signed(docs), "near-rows")
    texts = stored(
        rows.groupBy("key").agg(
            F.min("doc_id").alias("first_id"),
            F.count(F.lit(1)).alias("copies"),
            F.first("signature").alias("signature"),
            F.first("bands").alias("bands"),
        ),
        "near-texts",
    )
    signed, rows = rows, stored(rows.select("doc_id", "key"), "near-keys")
    discard(signed)
    release(spark)
    with small_batches(spark):
        pruned = stored(_pruned(texts), "near-pruned")
        release(spark)
        found = stored(_checked(docs, texts, pruned), "near-links")
    discard(pruned)
    release(spark)
    links = found.groupBy("key").agg(F.sum("links").alias("n_links"))
    stars = components(found.select(F.col("key").alias("a"), F.col("peer").alias("b")))
    ids = texts.select("key", "first_id", "copies").join(
        stars.withColumnRenamed("node", "key"), "key", "left"
    )
    named = ids.filter("root is not null").groupBy("root").agg(
        F.min("first_id").alias("class_of"),
        # The text that stands for the class: the one with the smallest id, nulls last.
        F.min(F.struct(F.col("first_id").isNull(), "first_id", "key")).alias("_best"),
    )
    per_text_ = (
        ids.join(named, "root", "left")
        .join(links, "key", "left")
        .select(
            "key",
            "first_id",
            F.coalesce("class_of", "first_id").alias("class_id"),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            "copies",
            F.coalesce(F.col("_best.key") == F.col("key"), F.lit(True)).alias("stands"),
        )
    )
    named_texts = stored(per_text_, "near-classes")
    discard(found, texts)
    release(spark)
    return rows, named_texts


def join(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``class_id``, ``n_links``, ``n_copies`` (other rows with the same text) for every row."""
    rows, texts = classes(docs)
    return rows.join(texts, "key").select(
        "doc_id", "class_id", "n_links", (F.col("copies") - 1).alias("n_copies")
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` in its own columns with one row of each class: the one with the smallest id.

    A class is what links reach, so unrelated texts under one id are kept, each as its own class.
    """
    _, texts = classes(docs)
    # Structs are equal where both ids are null, so they can be join and grouping keys as they are.
    chosen = texts.filter("stands").select("key", F.struct(F.col("first_id").alias("id")).alias("who"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")  # out of the way of other names
    rows = docs.select(row, F.struct(F.col("doc_id").alias("id")).alias("who"), _key(F.col("text")).alias("key"))
    # Repeated rows go before the join, on the join's keys: whole texts are shuffled and sorted once.
    return rows.dropDuplicates(["key", "who"]).join(chosen, ["key", "who"]).select("row.*")
