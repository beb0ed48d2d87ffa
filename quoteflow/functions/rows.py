"""Row-level building blocks."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Named columns added together; each may use the columns of the stages before it.
Stage = dict[str, Column]


def add_stages(df: DataFrame, stages: Iterable[Stage]) -> DataFrame:
    """Add the columns stage by stage, each stage its own projection.

    An intermediate value that several later checks use is thereby computed once. The stages are
    cached by the functions that build them: a column only names its inputs, and building a large
    expression costs far more calls into the JVM than using it.
    """
    for stage in stages:
        df = df.withColumns(stage)
    return df


def once(steps: DataFrame, keep: list[str], results: dict[str, Column]) -> DataFrame:
    """Columns ``keep`` plus ``results``, evaluated exactly once per row.

    A later filter on a plain computed column is pushed below it and so evaluates the whole parse
    again at every step. Rows that come out of a generator are not rebuilt that way; this one gives
    exactly one output row per input row.
    """
    result = F.struct(*[column.alias(name) for name, column in results.items()])
    return steps.select(*keep, F.inline(F.array(result)))


def matched(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on ``keys`` where null equals null; a group whose key is null keeps its partner."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(Column.__and__, [left[k].eqNullSafe(renamed[f"_right_{k}"]) for k in keys])
    return left.join(renamed, same, how).drop(*[f"_right_{k}" for k in keys])


def present(values: Column) -> Column:
    """The array without its nulls."""
    return F.filter(values, lambda v: v.isNotNull())
