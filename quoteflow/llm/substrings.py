"""Substring dedup on a compacted De Bruijn graph of words.

Every run of ``k`` words is an edge between the two runs of ``k - 1`` words it begins and ends with.
A word is removed when an edge that covers it also starts in a document with a smaller id.

Edges are never shuffled one by one. Each edge has an anchor, its smallest run of ``anchor`` words by
hash, and successive edges with the same anchor form one piece of a path (a fifth of the rows):

1. Anchors found in two or more documents are kept, by a minimum and maximum per anchor and a semi
   join. Everything else cannot repeat.
2. The texts with such anchors give the pieces, with their edges' hashes.
3. Where all occurrences of an anchor carry the same edges, the path does not branch, and the piece
   is compacted: its first occurrence (by id, then position) is the source of all of it. Where they
   differ, the path branches, and its edges are joined to their own first occurrences.
4. Per document, neighbouring pieces that run parallel to the same source merge into long spans.
5. The source coordinates are read back: a span counts only if its words are those of its source.

Of equal texts, the first stands for all; the others go as a whole. Every phase is written to the
shared folder, and the shuffle files of a finished phase are released. A frequent anchor or passage
meets partial minima and joins whose large partitions Spark splits, never a list of its documents.

Defined cases: a null or empty text has no words; a text with fewer than ``k`` words keeps them; a
row with a null id is neither a source nor cut; repeated rows (an id with the same text) do not cut
each other and get a result each; different texts under one id do not cut each other either; an
empty table gives an empty result; other columns are kept by :func:`cut` unless a result has their
name.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from quoteflow.llm.common import discard, others, per_group, release, slices, stored

K = 13
ANCHOR = 5

_BASE = np.uint64(0x9E3779B97F4A7C15)

RESULTS = [
    StructField("n_words", LongType()),
    StructField("n_removed", LongType()),
    StructField("kept_sha256", StringType()),
    StructField("kept", StringType()),
]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _grams(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each place on."""
    out = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for i in range(size):
        out = out * _BASE + words[i : len(out) + i]
    return _mixed(out ^ np.uint64(size))


class Pieces:
    """Pieces of the paths of some texts, laid end to end.

    ``start``: place of a piece's first edge; ``n``: its edges; ``anchor``: its key; ``owner``: the
    text; ``pos``: the start within the text.
    """

    def __init__(self, texts: list[str], k: int, anchor: int):
        split = [t.encode().split() for t in texts]
        counts = np.array([len(s) for s in split], np.int64)
        total = int(counts.sum())
        words = np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(split)), np.uint64, total)
        owner = np.repeat(np.arange(len(texts), dtype=np.int32), counts)
        edges = max(0, total - k + 1)
        inside = owner[:edges] == owner[total - edges :]
        keys = _grams(words, anchor)
        best, at = keys[:edges].copy(), np.arange(edges)
        for shift in range(1, k - anchor + 1):
            other = keys[shift : shift + edges]
            smaller = other < best  # of equal ones the first
            best[smaller] = other[smaller]
            at[smaller] = np.flatnonzero(smaller) + shift
        goes_on = np.zeros(edges, bool)
        goes_on[1:] = inside[1:] & inside[:-1] & (at[1:] == at[:-1])
        first = inside & ~goes_on
        self.words, self.k = words, k
        self.start = np.flatnonzero(first)
        self.n = np.bincount((np.cumsum(first) - 1)[inside], minlength=len(self.start)).astype(np.int32)
        self.anchor = best[self.start].view(np.int64)
        self.owner = owner[self.start]
        begin = np.cumsum(counts) - counts
        self.pos = (self.start - begin[self.owner]).astype(np.int32)

    def edges(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Edge hashes of the chosen pieces end to end, the offsets, and a hash of each piece."""
        n = self.n[chosen].astype(np.int64)
        offsets = np.r_[0, np.cumsum(n)]
        within = np.arange(offsets[-1]) - np.repeat(offsets[:-1], n)
        places = np.repeat(self.start[chosen], n) + within
        hashes = _grams(self.words, self.k)[places]
        if not len(n):
            return hashes.view(np.int64), offsets, np.zeros(0, np.int64)
        spread = _mixed(hashes + within.astype(np.uint64) * _BASE)
        whole = np.add.reduceat(spread, offsets[:-1])
        return hashes.view(np.int64), offsets, whole.view(np.int64)


def _anchors(docs: DataFrame, k: int, anchor: int) -> DataFrame:
    """``anchor``, ``doc_id``, ``pos`` per piece; of equal texts in a task the first ones are enough."""
    schema = StructType(
        [
            StructField("anchor", LongType()),
            StructField("doc_id", LongType()),
            StructField("pos", IntegerType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "doc_id", "pos"]
        smallest: dict[bytes, int] = {}
        for batch in batches:
            for part in slices(batch, 1):
                ids, texts = [], []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    mark = hashlib.md5(text.encode()).digest()
                    if doc_id < smallest.get(mark, doc_id + 1):
                        smallest[mark] = doc_id
                        ids.append(doc_id)
                        texts.append(text)
                found = Pieces(texts, k, anchor)
                columns = [found.anchor, np.array(ids, np.int64)[found.owner], found.pos]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return docs.mapInArrow(run, schema)


def _shared(anchors: DataFrame) -> DataFrame:
    """Anchors in two or more documents."""
    ends = anchors.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    return ends.filter("low < high").select("anchor")


def _with_text(docs: DataFrame, lists: DataFrame, how: str = "inner") -> DataFrame:
    """``docs`` with a row of ``lists`` by ``doc_id``; the texts are exchanged, not sorted."""
    lists = lists.withColumnRenamed("doc_id", "l_doc_id").hint("shuffle_hash")
    return docs.join(lists, F.col("doc_id") == F.col("l_doc_id"), how).drop("l_doc_id")


def _paths(docs: DataFrame, repeated: DataFrame, k: int, anchor: int) -> DataFrame:
    """The pieces at the repeated positions, with their edges and a hash of all of them."""
    lists = repeated.groupBy("doc_id").agg(F.collect_set("pos").alias("at"))
    schema = StructType(
        [
            StructField("anchor", LongType()),
            StructField("doc_id", LongType()),
            StructField("mark", LongType()),
            StructField("pos", IntegerType()),
            StructField("whole", LongType()),
            StructField("edges", ArrayType(LongType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.name for f in schema]
        for batch in batches:
            for part in slices(batch, 1):
                ids = part.column(0).to_numpy()
                texts = part.column(1).to_pylist()
                found = Pieces(texts, k, anchor)
                marks = np.array([zlib.crc32(t.encode()) for t in texts], np.int64)
                wanted = part.column(2)
                owners = np.repeat(np.arange(len(ids)), np.diff(wanted.offsets.to_numpy()))
                at = wanted.flatten().to_numpy()
                both = (found.owner.astype(np.int64) << 32) | found.pos
                chosen = np.flatnonzero(np.isin(both, (owners.astype(np.int64) << 32) | at))
                hashes, offsets, whole = found.edges(chosen)
                columns = [
                    pa.array(found.anchor[chosen]),
                    pa.array(ids[found.owner[chosen]]),
                    pa.array(marks[found.owner[chosen]]),
                    pa.array(found.pos[chosen]),
                    pa.array(whole),
                    pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(hashes)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return _with_text(docs, lists).select("doc_id", "text", "at").mapInArrow(run, schema)


def _first() -> Column:
    """The first occurrence: the smallest id, then the smallest position."""
    return F.min(F.struct("doc_id", "pos")).alias("source")


def _compacted(paths: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pieces that do not branch, next to their source: ``doc_id``, ``mark``, ``pos``, ``n``, ``s_doc``, ``s_pos``."""
    straight = nodes.filter("not branches").select("anchor", "source").hint("shuffle_hash")
    rows = paths.select("anchor", "doc_id", "mark", "pos", F.size("edges").alias("n")).join(straight, "anchor")
    return rows.filter("doc_id > source.doc_id").select(
        "doc_id", "mark", "pos", "n", F.col("source.doc_id").alias("s_doc"), F.col("source.pos").alias("s_pos")
    )


def _sources_of(edges: DataFrame) -> DataFrame:
    """First occurrences of edges in two or more documents."""
    first = edges.groupBy("anchor", "edge").agg(_first(), F.max("doc_id").alias("last"))
    return first.filter("source.doc_id < last").drop("last")


def _single(edges: DataFrame, first: DataFrame) -> DataFrame:
    """Edges of branching paths next to their own first occurrences, in the columns of pieces."""
    rows = edges.join(first.hint("shuffle_hash"), ["anchor", "edge"]).filter("doc_id > source.doc_id")
    return rows.select(
        "doc_id",
        "mark",
        "pos",
        F.lit(1).alias("n"),
        F.col("source.doc_id").alias("s_doc"),
        F.col("source.pos").alias("s_pos"),
    )


def _merge(_: tuple, rows: list[tuple]) -> list[tuple]:
    """Neighbouring pieces (pos, n, s_doc, s_pos) of a document on the same diagonal, as one."""
    spans: list[list[int]] = []
    for pos, n, s_doc, s_pos in sorted(set(rows), key=lambda r: (r[2], r[3] - r[0], r[0])):
        last = spans[-1] if spans else None
        if last and last[2] == s_doc and last[3] - last[0] == s_pos - pos and pos <= last[0] + last[1]:
            last[1] = max(last[1], pos + n - last[0])
        else:
            spans.append([pos, n, s_doc, s_pos])
    return [(_[0], *s) for s in spans]


def _spans(pieces: DataFrame, k: int) -> DataFrame:
    """Long spans in words: ``doc_id``, ``start``, ``length``, ``s_doc``, ``s_start``."""
    schema = StructType(
        [
            StructField("doc_id", LongType()),
            StructField("start", IntegerType()),
            StructField("n", IntegerType()),
            StructField("s_doc", LongType()),
            StructField("s_start", IntegerType()),
        ]
    )
    # Texts under one id do not merge: the mark keeps them apart.
    merged = per_group(pieces, ["doc_id", "mark"], schema, _merge)
    return merged.select("doc_id", "start", (F.col("n") + (k - 1)).alias("length"), "s_doc", "s_start")


def _digest(words: list[bytes], start: int, length: int) -> bytes:
    return hashlib.blake2b(b" ".join(words[start : start + length]), digest_size=16).digest()


def _sources(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Digest of the words at every source coordinate that a span names."""
    wanted = spans.groupBy(F.col("s_doc").alias("doc_id")).agg(
        F.collect_set(F.struct(F.col("s_start").alias("start"), "length")).alias("at")
    )
    schema = StructType(
        [
            StructField("s_doc", LongType()),
            StructField("s_start", IntegerType()),
            StructField("length", IntegerType()),
            StructField("digest", BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for doc_id, text, at in zip(*[c.to_pylist() for c in batch.columns]):
                words = text.encode().split()
                made += [
                    (doc_id, a["start"], a["length"], _digest(words, a["start"], a["length"])) for a in at
                ]
            columns = list(zip(*made)) or [()] * 4
            types = [pa.int64(), pa.int32(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=[f.name for f in schema]
            )

    found = _with_text(docs, wanted).select("doc_id", "text", "at").mapInArrow(run, schema)
    return found.distinct()  # an id may stand for several rows


def _finished(docs: DataFrame, lists: DataFrame, k: int) -> DataFrame:
    """Cut every row by the spans whose words are those of their source."""
    keep = others(docs, [f.name for f in RESULTS] + ["text"])
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")  # out of the way of other names
    joined = _with_text(docs.select(row, "doc_id", "text"), lists, "left")
    rows = joined.select("row", "text", "spans", "copied")
    schema = StructType([rows.schema["row"]] + RESULTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            for part in slices(batch, 1):
                made = [_cut(t, k, s, c) for t, s, c in zip(*[part.column(i).to_pylist() for i in (1, 2, 3)])]
                columns = [part.column(0).cast(arrow.field(0).type)]
                columns += [pa.array(c, f.type) for c, f in zip(zip(*made), list(arrow)[1:])]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return rows.mapInArrow(run, schema).select("row.*", *[f.name for f in RESULTS])


def _cut(text: str | None, k: int, spans: list[dict] | None, copied: list[str] | None) -> tuple:
    raw = (text or "").encode()
    words = raw.split()
    kept = words
    if copied and len(words) >= k and hashlib.md5(raw).hexdigest() in copied:
        kept = []
    elif spans:
        gone = np.zeros(len(words) + 1, bool)
        for s in spans:
            start, length = s["start"], s["length"]
            if start + length <= len(words) and _digest(words, start, length) == s["digest"]:
                gone[start : start + length] = True
        kept = [w for w, g in zip(words, gone.tolist()) if not g]
    joined = b" ".join(kept)
    return len(words), len(words) - len(kept), hashlib.sha256(joined).hexdigest(), joined.decode()


def cut(docs: DataFrame, k: int = K, anchor: int = ANCHOR) -> DataFrame:
    """Every row of ``docs`` with ``n_words``, ``n_removed``, ``kept_sha256`` and the ``kept`` words."""
    spark = docs.sparkSession
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    texts = docs.select("doc_id", "text").filter("doc_id is not null and text is not null")

    # What the joins look up is stored first: a join right behind the aggregation that feeds it would
    # keep that one's partitions, and Spark could not split those of a frequent anchor.
    anchors = stored(_anchors(texts, k, anchor), "anchors")
    shared = stored(_shared(anchors), "anchors-shared")
    release(spark)
    repeated = anchors.join(shared.hint("shuffle_hash"), "anchor", "left_semi").select("doc_id", "pos")
    repeated = stored(repeated, "anchors-repeated")
    discard(anchors, shared)
    release(spark)

    paths = stored(_paths(texts, repeated, k, anchor), "paths")
    discard(repeated)
    release(spark)
    nodes = paths.groupBy("anchor").agg(_first(), (F.min("whole") != F.max("whole")).alias("branches"))
    nodes = stored(nodes, "nodes")
    release(spark)
    straight = stored(_compacted(paths, nodes), "compacted")
    release(spark)
    forks = nodes.filter("branches").select("anchor").hint("shuffle_hash")
    edges = paths.select("anchor", "doc_id", "mark", "pos", "edges").join(forks, "anchor", "left_semi")
    edges = edges.select(
        "anchor", "doc_id", "mark", F.col("pos").alias("p0"), F.posexplode("edges").alias("i", "edge")
    )
    edges = stored(edges.select("anchor", "edge", "doc_id", "mark", (F.col("p0") + F.col("i")).alias("pos")), "edges")
    discard(paths, nodes)
    release(spark)
    first = stored(_sources_of(edges), "edge-sources")
    release(spark)
    single = stored(_single(edges, first), "edges-resolved")
    discard(edges, first)
    release(spark)

    spans = stored(_spans(straight.unionByName(single), k), "spans")
    discard(straight, single)
    release(spark)
    sources = stored(_sources(texts, spans), "sources")
    release(spark)
    proven = spans.join(sources, ["s_doc", "s_start", "length"]).select("doc_id", "start", "length", "digest")

    marks = texts.select("doc_id", F.md5(F.col("text").cast("binary")).alias("mark"))
    first = marks.groupBy("mark").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    first = stored(first.filter("first < last").select("mark", "first"), "copied-texts")
    copies = marks.join(first.hint("shuffle_hash"), "mark").filter("doc_id > first").select("doc_id", "mark")
    both = proven.select(
        "doc_id", F.struct("start", "length", "digest").alias("span"), F.lit(None).cast("string").alias("mark")
    ).unionByName(copies, allowMissingColumns=True)
    lists = both.groupBy("doc_id").agg(
        F.collect_list("span").alias("spans"), F.collect_set("mark").alias("copied")
    )
    return _finished(docs, lists, k)
