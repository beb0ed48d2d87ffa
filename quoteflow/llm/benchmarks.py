"""Benchmark decontamination, in DataFrame functions only.

Words are runs of lower-cased letters and digits (anything beyond ASCII counts as a letter). A window
is ten consecutive words of a benchmark item; a shorter item is one window. The hashes of all windows
are broadcast; the tasks that read the documents hash each of their windows and look it up, so that
only windows with a known hash leave the scan's stage. Those are then joined on their words.

A broadcast holds at most ``max_windows`` hashes, about ``ENTRY_BYTES`` each in a task's memory (64 MiB
as it stands). A larger benchmark takes the same steps in several rounds over the documents, a part of
the hashes at a time; windows of documents are never shuffled.

Defined cases: null texts have no words; an item or document without words gives no windows; items
with a null id make words hit but are not listed; repeated rows of either table count by themselves
(an id is listed once); empty tables give an empty result or no hits; other columns are kept by
:func:`remove`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from quoteflow.functions.rows import once
from quoteflow.llm.common import stored

WINDOW = 10
ENTRY_BYTES = 64
MAX_WINDOWS = (64 << 20) // ENTRY_BYTES

# Windows that start in one block are looked up with the block's words at hand, not the whole text's.
_BLOCK = 64

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Runs of what is no word character, in lower-cased text; words in the text as it is.
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _BREAK, -1)
    return F.filter(parts, lambda w: w != "")


def windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``gram`` (its words), ``length``, ``hash``, ``item_ids``: one row per distinct window."""
    items = once(
        benchmark.select("item_id", "text"), ["item_id"], {"words": words(F.col("text"))}
    ).withColumn("n", F.size("words")).filter("n > 0")
    length = F.least(F.col("n"), F.lit(window))
    starts = F.sequence(F.lit(1), F.col("n") - length + 1)
    rows = items.select("item_id", "words", length.alias("length"), F.explode(starts).alias("start"))
    gram = F.array_join(F.slice("words", F.col("start"), F.col("length")), " ")
    grouped = rows.groupBy(gram.alias("gram"), "length").agg(F.collect_set("item_id").alias("item_ids"))
    return grouped.withColumn("hash", F.xxhash64(F.split("gram", " ")))


class Windows:
    """The distinct windows of a benchmark, written once, and the rounds in which their hashes are sent."""

    def __init__(self, benchmark: DataFrame, window: int = WINDOW, max_windows: int = MAX_WINDOWS):
        self.table = stored(windows(benchmark, window), "benchmark-windows")
        # One row per length, of which there are at most ``window``.
        sizes = {r["length"]: r["count"] for r in self.table.groupBy("length").count().collect()}
        self.lengths = sorted(sizes)
        self.rounds = max(1, -(-sum(sizes.values()) // max_windows))

    def hits(self, texts: DataFrame, keys: list[str], markers: bool) -> DataFrame:
        """``keys``, ``start`` (from 1), ``length``, ``gram``: windows of ``words`` with a known hash.

        With ``markers`` each text also has a row where it has none to give: its first window, without
        a gram. Several rounds read ``texts`` as often, each writes what it found.
        """
        found = [self._round(texts, keys, i, markers and i == 0) for i in range(self.rounds)]
        if self.rounds > 1:
            found = [stored(part, "benchmark-round") for part in found]
        return reduce(DataFrame.unionAll, found)

    def _round(self, texts: DataFrame, keys: list[str], number: int, markers: bool) -> DataFrame:
        part = F.pmod(F.col("hash"), F.lit(self.rounds)) == number
        known = self.table.filter(part).select(F.col("hash").alias("known")).distinct()
        probes = self._probes(texts, keys)
        on = F.col("probe.hash") == F.col("known")
        hit = F.col("known").isNotNull()
        if markers:
            joined = probes.join(F.broadcast(known), on, "left")
            # The first of all windows is one of the shortest length.
            first = (F.col("probe.start") == 1) & (F.col("probe.length") == min(self.lengths, default=0))
            joined = joined.filter(hit | ((F.col("at") == 1) & (F.col("probe").isNull() | first)))
        else:
            joined = probes.join(F.broadcast(known), on)
        gram = F.array_join(F.slice("part", F.col("probe.start"), F.col("probe.length")), " ")
        return joined.select(
            *keys,
            (F.col("at") - 1 + F.col("probe.start")).alias("start"),
            F.col("probe.length").alias("length"),
            F.when(hit, gram).alias("gram"),
        )

    def _probes(self, texts: DataFrame, keys: list[str]) -> DataFrame:
        """Every window of every text: ``at`` and ``part`` are its block, ``probe`` (start, length, hash)."""
        reach = _BLOCK + max(self.lengths, default=1) - 1
        starts = F.sequence(F.lit(1), F.greatest(F.size("words"), F.lit(1)), F.lit(_BLOCK))
        blocks = F.transform(
            starts, lambda at: F.struct(at.alias("at"), F.slice("words", at, F.lit(reach)).alias("part"))
        )
        cut = texts.select(*keys, F.inline(blocks))
        made = [F.array().cast("array<struct<start:int,length:int,hash:bigint>>")]
        made += [self._of_length(length) for length in self.lengths]
        return cut.select(*keys, "at", "part", F.explode_outer(F.concat(*made)).alias("probe"))

    @staticmethod
    def _of_length(length: int) -> Column:
        """The windows of one length that start in the block ``part``."""
        last = F.least(F.size("part") - length + 1, F.lit(_BLOCK))
        starts = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(
            starts,
            lambda i: F.struct(
                i.alias("start"),
                F.lit(length).alias("length"),
                F.xxhash64(F.slice("part", i, F.lit(length))).alias("hash"),
            ),
        )


def covered(hits: Column) -> Column:
    """The numbers (from 1) of the words inside at least one of the (start, length) spans."""
    runs = F.transform(hits, lambda h: F.sequence(h.start, h.start + h.length - 1))
    return F.array_distinct(F.flatten(runs))


def score(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated`` for every row."""
    of = Windows(benchmark, window, max_windows)
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    if of.rounds > 1:
        # Read once a round, by the same numbers.
        rows = stored(rows, "benchmark-texts")
    split = once(rows, ["row", "doc_id"], {"words": words(F.col("text"))})
    split = split.withColumn("n_words", F.size("words").cast("long"))
    found = of.hits(split, ["row", "doc_id", "n_words"], markers=True)
    # A row without a gram takes a key of its own, which no gram equals, instead of one that all share.
    found = found.withColumn("key", F.coalesce("gram", F.concat(F.lit(" "), F.col("row"))))
    table = of.table.select(F.col("gram").alias("known"), "item_ids")
    joined = found.join(table, F.col("key") == F.col("known"), "left")
    hit = F.when(F.col("known").isNotNull(), F.struct("start", "length"))
    per = joined.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.collect_list(hit).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("item_ids"))).cast("array<string>")).alias("items"),
    )
    per = per.withColumn("n_hit", F.size(covered(F.col("hits"))).cast("long"))
    return per.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def remove(
    docs: DataFrame,
    benchmark: DataFrame,
    max_hit_percent: int = 50,
    window: int = WINDOW,
    max_windows: int = MAX_WINDOWS,
) -> DataFrame:
    """``docs`` in its own columns without benchmark passages.

    Hit words are cut out of the text with the breaks behind them (``n_chars`` follows); a document with
    more than ``max_hit_percent`` of its words hit goes as a whole.

    The hits are kept by the SHA-256 of the text and written; Spark sees their size there and sends them
    to the texts, or sorts both sides when they are many.
    """
    of = Windows(benchmark, window, max_windows)
    digest = F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))
    texts = once(docs.select("text"), [], {"digest": digest, "words": words(F.col("text"))})
    found = of.hits(texts, ["digest"], markers=False)
    sure = found.join(of.table.select("gram"), "gram", "left_semi")
    known = sure.groupBy("digest").agg(F.collect_set(F.struct("start", "length")).alias("hits"))
    known = stored(known, "benchmark-hits")

    cells = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), digest.alias("of"))
    judged = cells.join(known, F.col("of") == F.col("digest"), "left")
    hit, text = F.col("hits").isNotNull(), F.col("_doc.text")
    # Columns of their own: inside a function over the words they would be made again for every word.
    parts = {
        "cut": F.when(hit, covered(F.col("hits"))),
        "kept": F.when(hit, F.regexp_extract_all(text, F.lit(_WORD_ANY_CASE), F.lit(0))),
        "breaks": F.when(hit, F.split(text, _WORD_ANY_CASE, -1)),
    }
    rows = once(judged, ["_doc"], parts).filter(
        F.col("cut").isNull() | (F.lit(100) * F.size("cut") <= F.lit(max_hit_percent) * F.size("kept"))
    )
    left = F.array_except(F.sequence(F.lit(1), F.size("kept")), F.col("cut"))
    pieces = F.transform(left, lambda i: F.concat(F.element_at("kept", i), F.element_at("breaks", i + 1)))
    clean = F.concat(F.element_at("breaks", 1), F.array_join(pieces, ""))
    out = once(rows, ["_doc"], {"text": F.when(F.col("cut").isNull(), text).otherwise(clean)})
    columns = {c: F.col(f"_doc.`{c}`") for c in docs.columns}
    columns["text"] = F.col("text")
    if "n_chars" in columns:
        columns["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.select(*[c.alias(name) for name, c in columns.items()])
