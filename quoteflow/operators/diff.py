"""Comparing two result sets."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from quoteflow import rules, session

_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_TOKEN = rf'{_STRING}|[\[{{]|[\]}}]|[^"\[\]{{}}]++|"'
_SCALAR = rf'^(?:{_STRING}|[^\s,\[\]{{}}"]++)'


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, which is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _closing(text: Column, depth: Column) -> Column:
    """Brackets still open at the end (0: closed in ``text``) and characters read, with ``depth`` open at the start."""

    def step(state: Column, token: Column) -> Column:
        moved = (
            F.when(token.isin("[", "{"), state["depth"] + 1)
            .when(token.isin("]", "}"), state["depth"] - 1)
            .otherwise(state["depth"])
        )
        # Closed when a bracket was read and none is open.
        closed = (state["used"] > 0) & (state["depth"] == 0)
        read = F.struct(moved.alias("depth"), (state["used"] + F.length(token)).alias("used"))
        return F.when(closed, state).otherwise(read)

    start = F.struct(depth.cast("int").alias("depth"), F.lit(0).alias("used"))
    return F.aggregate(F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0)), start, step)


def mask(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Blank the columns that differ between any two runs (ids, creation times)."""
    names = columns or [c for c in df.columns if c in rules.VOLATILE_FIELDS]
    return df.withColumns({name: F.lit(rules.VOLATILE_MARK) for name in names})


def mask_json(body: Column) -> Column:
    """The same for JSON text: members of these names at any depth, whatever their value.

    The text is cut at these names and the brackets of a value are counted to its end, over further
    such names inside it. Text behind a value that never closes stays as it is.
    """
    name = rf'"(?:{"|".join(rules.VOLATILE_FIELDS)})"\s*:\s*'

    def state(out: Column, depth: Column, held: Column) -> Column:
        return F.struct(out.alias("out"), depth.cast("int").alias("depth"), held.alias("held"))

    def step(now: Column, piece: Column) -> Column:
        key, text = piece["key"], piece["text"]
        raw, nothing = F.concat(key, text), F.lit("")
        marked = F.concat(now["out"], F.regexp_extract(key, r'^"\w+"', 0), F.lit(f':"{rules.VOLATILE_MARK}"'))
        inside = now["depth"] > 0
        masked = F.when(inside, now["out"]).otherwise(marked)

        def cut(end: Column) -> Column:
            # The mark is written when a value opens, so ``held`` has the text before it, too.
            held = F.when(inside, F.concat(now["held"], raw)).otherwise(F.concat(now["out"], raw))
            rest = text.substr(end["used"] + 1, F.length(text))
            return F.when(end["depth"] > 0, state(masked, end["depth"], held)).otherwise(
                state(F.concat(masked, rest), F.lit(0), nothing)
            )

        scalar = state(F.concat(marked, F.regexp_replace(text, _SCALAR, "")), F.lit(0), nothing)
        return (
            F.when(inside | text.rlike(r"^[\[{]"), _with(_closing(text, now["depth"]), cut))
            .when(text.rlike(_SCALAR), scalar)
            .otherwise(state(F.concat(now["out"], raw), F.lit(0), nothing))
        )

    texts = F.split(body, name, -1)
    pieces = F.arrays_zip(
        F.regexp_extract_all(body, F.lit(name), F.lit(0)).alias("key"),
        F.slice(texts, F.lit(2), F.size(texts)).alias("text"),
    )
    return F.aggregate(
        pieces,
        state(F.element_at(texts, 1), F.lit(0), F.lit("")),
        step,
        lambda end: F.when(end["depth"] > 0, end["held"]).otherwise(end["out"]),
    )


def compare(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose rows differ: missing on one side, or different in some other column.

    Rows are counted per side instead of joined: copies of a key add up inside each task, so a key
    with any number of copies neither multiplies into pairs nor fills one task.
    """
    columns = left.columns
    sides = left.withColumn("_left", F.lit(1)).unionByName(right.select(columns).withColumn("_left", F.lit(0)))
    rows = sides.groupBy(*columns).agg(
        F.sum("_left").alias("_l"), F.sum(1 - F.col("_left")).alias("_r")
    )
    per_key = rows.groupBy(*keys).agg(
        F.sum("_l").alias("left_rows"),
        F.sum("_r").alias("right_rows"),
        F.sum(F.abs(F.col("_l") - F.col("_r"))).alias("_off"),
    )
    verdict = (
        F.when(F.col("left_rows") == 0, "only right")
        .when(F.col("right_rows") == 0, "only left")
        .otherwise("different")
    )
    return per_key.filter("_off > 0").select(*keys, verdict.alias("verdict"), "left_rows", "right_rows")


@dataclass(frozen=True)
class Digested:
    """A stored table whose rows lie by ranges of their key's hash, and a digest of every part of a range."""

    rows: DataFrame
    digests: DataFrame


RANGES, PARTS = 64, 64


def digested(df: DataFrame, keys: list[str], ranges: int = RANGES, parts: int = PARTS) -> Digested:
    """Store ``df`` by key ranges, with the digests that :func:`compare_tree` reads instead of rows.

    A digest is a count, an exclusive or and a sum of row hashes, so it does not depend on order and
    adds up over parts. Made once per table; a part should be about what one task reads.
    """
    whole, leaf = F.xxhash64(*df.columns), F.pmod(F.xxhash64(*keys), F.lit(ranges * parts))
    placed = df.withColumns({"_range": F.floor(leaf / parts).cast("int"), "_part": leaf.cast("int"), "_h": whole})
    # Copies of a key, however many, are dealt over several tasks of their range.
    dealt = placed.repartition("_range", F.pmod("_h", F.lit(8))).sortWithinPartitions("_range", "_part")
    path = session.scratch_path(df.sparkSession, "digested")
    dealt.write.partitionBy("_range").parquet(f"{path}/rows")
    schema = T.StructType([f for f in placed.schema if f.name != "_range"] + [T.StructField("_range", T.IntegerType())])
    rows = df.sparkSession.read.schema(schema).parquet(f"{path}/rows")
    sums = rows.groupBy("_range", "_part").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor("_h").alias("x"), F.sum(F.col("_h").cast("decimal(38,0)")).alias("s")
    )
    sums.write.parquet(f"{path}/digests")
    return Digested(rows.drop("_h"), df.sparkSession.read.schema(sums.schema).parquet(f"{path}/digests"))


def unequal_parts(left: Digested, right: Digested) -> list[tuple[int, int]]:
    """(range, part) of the parts that differ: first the digests of ranges, then those of parts of unequal ranges.

    At most ``RANGES * PARTS`` pairs come to the driver.
    """
    signed = left.digests.unionByName(right.digests.withColumns({"n": -F.col("n"), "s": -F.col("s")}))

    def unequal(digests: DataFrame, by: list[str]) -> list:
        sums = digests.groupBy(*by).agg(F.sum("n").alias("n"), F.bit_xor("x").alias("x"), F.sum("s").alias("s"))
        return sums.filter("n != 0 or x != 0 or s != 0").select(*by).collect()

    found = [r["_range"] for r in unequal(signed, ["_range"])]
    if not found:
        return []
    return sorted(tuple(r) for r in unequal(signed.filter(F.col("_range").isin(found)), ["_range", "_part"]))


def compare_tree(left: Digested, right: Digested, keys: list[str]) -> DataFrame:
    """The rows of :func:`compare`, from the parts whose digests differ; equal parts are not read."""
    parts = unequal_parts(left, right)
    inside = F.col("_range").isin(sorted({r for r, _ in parts})) & F.col("_part").isin([p for _, p in parts])
    sides = [side.rows.filter(inside if parts else F.lit(False)).drop("_range", "_part") for side in (left, right)]
    return compare(sides[0], sides[1], keys)


def key_changes(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Keys added or removed between two states of a table (empty when a retry changed nothing)."""
    gone = before.select(keys).distinct().withColumn("_side", F.lit(1))
    come = after.select(keys).distinct().withColumn("_side", F.lit(2))
    sides = gone.unionByName(come).groupBy(*keys).agg(F.sum("_side").alias("_side"))
    change = F.when(F.col("_side") == 1, "removed").otherwise("added")
    return sides.filter("_side < 3").select(*keys, change.alias("change"))


def distinct_bodies(responses: DataFrame, by: list[str]) -> DataFrame:
    """Number of different masked bodies per group; one when every backend answers alike.

    Digests go through the shuffle, not the bodies.
    """
    masked = F.sha2(mask_json(F.col("body")), 256)
    return responses.groupBy(*by).agg(F.count_distinct(masked).alias("bodies"))
