"""Schema evolution of stored results: new readers must be able to read old rows."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


class IncompatibleSchema(ValueError):
    pass


# Fixed value: types that may widen when a newer schema reads older rows.
_WIDENS = {
    (T.IntegerType, T.LongType),
    (T.IntegerType, T.DoubleType),
    (T.FloatType, T.DoubleType),
}


def backward_errors(old: T.StructType, new: T.StructType, defaults: dict[str, object] | None = None) -> list[str]:
    """Why rows written with ``old`` could not be read with ``new`` (empty when they can).

    A new field, at any depth, needs a default (an explicit null for a nullable one); dropping a field is
    allowed. Defaults are named by the path to the field, without the steps into elements and values:
    ``lines.unit`` is the field ``unit`` of the structs in the array ``lines``.
    """
    return list(_struct_errors(old, new, defaults or {}, ""))


def _struct_errors(old: T.StructType, new: T.StructType, defaults: dict[str, object], path: str) -> Iterator[str]:
    known = {f.name: f for f in old.fields}
    for field in new.fields:
        before, at = known.get(field.name), f"{path}{field.name}"
        if before is None:
            if at not in defaults:
                yield f"new field {at} has no default"
            continue
        yield from _type_errors(before.dataType, field.dataType, defaults, at)
        if before.nullable and not field.nullable and at not in defaults:
            yield f"field {at} became required"


def _type_errors(old: T.DataType, new: T.DataType, defaults: dict[str, object], at: str) -> Iterator[str]:
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        yield from _struct_errors(old, new, defaults, f"{at}.")
    elif isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        yield from _type_errors(old.elementType, new.elementType, defaults, at)
        if old.containsNull and not new.containsNull:
            yield f"elements of {at} became required"
    elif isinstance(old, T.MapType) and isinstance(new, T.MapType) and old.keyType == new.keyType:
        yield from _type_errors(old.valueType, new.valueType, defaults, at)
        if old.valueContainsNull and not new.valueContainsNull:
            yield f"values of {at} became required"
    elif old != new and (type(old), type(new)) not in _WIDENS:
        yield f"field {at} changed from {old} to {new}"


def require_backward(old: T.StructType, new: T.StructType, defaults: dict[str, object] | None = None) -> None:
    """Refuse an incompatible schema before anything is written."""
    errors = backward_errors(old, new, defaults)
    if errors:
        raise IncompatibleSchema("; ".join(errors))


def read_as(spark: SparkSession, path: str, schema: T.StructType, defaults: dict[str, object]) -> DataFrame:
    """Read old and new files alike under the newer schema."""
    return filled(spark.read.schema(schema).parquet(path), schema, defaults)


def filled(rows: DataFrame, schema: T.StructType, defaults: dict[str, object]) -> DataFrame:
    """``rows``, whose columns include those of ``schema``, with defaults where a field is null; columns without any stay as they are."""
    changed = {
        f.name: _conformed(F.col(f.name), f.dataType, f.dataType, defaults, f.name)
        for f in schema.fields
        if any(d == f.name or d.startswith(f"{f.name}.") for d in defaults)
    }
    return rows.withColumns(changed) if changed else rows


def conform(rows: DataFrame, schema: T.StructType, defaults: dict[str, object]) -> DataFrame:
    """Rows of an older layout in the newer one."""
    return rows.select(*_fields(None, rows.schema, schema, defaults, ""))


def _fields(parent: Column | None, old: T.StructType, new: T.StructType, defaults: dict[str, object], path: str) -> list[Column]:
    known, columns = {f.name: f for f in old.fields}, []
    for field in new.fields:
        at = f"{path}{field.name}"
        if field.name in known:
            value = F.col(field.name) if parent is None else parent[field.name]
            column = _conformed(value, known[field.name].dataType, field.dataType, defaults, at)
        else:
            column = F.lit(defaults.get(at)).cast(field.dataType)
        columns.append(column.alias(field.name))
    return columns


def _conformed(
    value: Column, old: T.DataType, new: T.DataType, defaults: dict[str, object], at: str, whole: bool = True
) -> Column:
    """``value`` as ``new``; a default of its own only where it is a field, not an element of one."""
    deeper = any(d.startswith(f"{at}.") for d in defaults)
    if old != new or deeper:
        if isinstance(new, T.StructType) and isinstance(old, T.StructType):
            made = F.struct(*_fields(value, old, new, defaults, f"{at}."))
            value = F.when(value.isNotNull(), made)
        elif isinstance(new, T.ArrayType) and isinstance(old, T.ArrayType):
            value = F.transform(value, lambda x: _conformed(x, old.elementType, new.elementType, defaults, at, False))
        elif isinstance(new, T.MapType) and isinstance(old, T.MapType):
            value = F.transform_values(
                value, lambda _, x: _conformed(x, old.valueType, new.valueType, defaults, at, False)
            )
        else:
            value = value.cast(new)
    return F.coalesce(value, F.lit(defaults[at]).cast(new)) if whole and at in defaults else value
