"""Reading JSON through VARIANT, which keeps the difference between ``3``, ``"3"`` and ``3.0``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def fields(value: Column) -> Column:
    """Object members as ``map<string,variant>``; null for anything that is not an object."""
    return F.try_variant_get(value, "$", "map<string,variant>")


def elements(value: Column) -> Column:
    """Array elements as ``array<variant>``; null for anything that is not an array."""
    return F.try_variant_get(value, "$", "array<variant>")


def kind(value: Column) -> Column:
    """JSON type of a scalar: STRING, BIGINT, DECIMAL(p,s), DOUBLE, BOOLEAN, VOID; null if absent."""
    return F.schema_of_variant(value)


def is_number(kind_: Column) -> Column:
    return (kind_ == "BIGINT") | (kind_ == "DOUBLE") | kind_.startswith("DECIMAL")


def text(value: Column) -> Column:
    """The value of a JSON string; null for every other type."""
    return F.when(kind(value) == "STRING", F.try_variant_get(value, "$", "string"))


def member(obj: Column, name: str) -> Column:
    return F.try_element_at(obj, F.lit(name))


def is_object(value: Column) -> Column:
    return F.try_variant_get(value, "$", "struct<>").isNotNull()


def number_text(value: Column, kind_: Column) -> Column:
    """A JSON number as text, with fractions read in double precision like common JSON readers."""
    return F.when(
        kind_ == "BIGINT", F.try_variant_get(value, "$", "bigint").cast("string")
    ).when(is_number(kind_), F.try_variant_get(value, "$", "double").cast("string"))


def number_or_text(value: Column) -> Column:
    """Text of a JSON string or number; null for other types."""
    as_text = F.try_variant_get(value, "$", "string")
    return (
        F.when(kind(value).isin("STRING", "BIGINT"), as_text)
        .when(is_number(kind(value)), F.try_variant_get(value, "$", "double").cast("string"))
    )
