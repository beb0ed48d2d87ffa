"""Running totals over a total order that do not put a whole group into one task.

``row_number`` or a running ``max`` over a hot group (or over everything) would run in one task.
Here the rows are range-partitioned on the full order, which splits a hot group over many tasks,
each part computes its own running value, and the parts before it are carried in from a summary
with at most one row per part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from quoteflow import session

# monotonically_increasing_id() keeps the partition number above its 33 low bits.
_ROW_BITS = 33

_FOLD = {"sum": F.sum, "max": F.max}


def ordered(df: DataFrame, order: list[str], label: str = "ordered") -> DataFrame:
    """Rows in total order with ``_seq`` (increasing in that order) and ``_part`` (sort partition).

    The result is written to the shared folder: part numbers must not change between the passes
    that use them, also when an executor is lost and its tasks run again. Sorting samples the input
    first and so computes it twice: pass a stored table rather than an expensive expression.
    """
    ranked = df.sort(*order).withColumn("_seq", F.monotonically_increasing_id())
    stored = session.durable(ranked, label)
    return stored.withColumn("_part", F.shiftright("_seq", _ROW_BITS).cast("int"))


def running(
    df: DataFrame,
    order: list[str],
    measures: dict[str, tuple[str, Column]],
    by: list[str] | None = None,
    keep_order: bool = False,
) -> DataFrame:
    """Add running ``sum`` / ``max`` measures, up to and including each row, within ``by``."""
    by = by or []
    rows = ordered(df, [*by, *order])
    out = accumulate(rows, measures, by)
    return out if keep_order else out.drop("_seq", "_part")


def accumulate(
    rows: DataFrame,
    measures: dict[str, tuple[str, Column]],
    by: list[str],
    before_row: bool = False,
) -> DataFrame:
    """Running measures over rows already placed by :func:`ordered` on ``by`` first.

    With ``before_row`` a measure covers the earlier rows only (a ``max`` over none of them is null).
    """
    last = -1 if before_row else 0
    inside = Window.partitionBy("_part", *by).orderBy("_seq").rowsBetween(Window.unboundedPreceding, last)
    summary = rows.groupBy("_part", *by).agg(
        *[_FOLD[fold](value).alias(name) for name, (fold, value) in measures.items()]
    )
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.select(
        "_part",
        *by,
        F.count(F.lit(1)).over(before).alias("_earlier"),
        *[_FOLD[fold](name).over(before).alias(f"_in_{name}") for name, (fold, _) in measures.items()],
    )
    # Only a group that continues from an earlier part carries anything in, and a sorted part can
    # continue at most one group: never more rows than sort partitions, so the broadcast is bounded.
    carried = carried.filter("_earlier > 0").drop("_earlier")
    local = rows.withColumns(
        {name: _FOLD[fold](value).over(inside) for name, (fold, value) in measures.items()}
    )
    joined = local.join(F.broadcast(carried), ["_part", *by], "left")
    combined = {
        name: (
            F.coalesce(F.col(name), F.lit(0)) + F.coalesce(F.col(f"_in_{name}"), F.lit(0))
            if fold == "sum"
            else F.greatest(F.col(name), F.col(f"_in_{name}"))
        )
        for name, (fold, _) in measures.items()
    }
    return joined.withColumns(combined).select(*rows.columns, *measures)
