"""Exact decimal texts: shape, scale and value without any silent rounding."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: a plain price such as 19.99, which needs no further analysis.
_PLAIN = r"^\d{1,6}(\.\d{0,2})?\z"
# Fixed value: sign, digits, fraction, exponent of a decimal literal.
_LITERAL = r"^[+-]?(?:(\p{Nd}+)(?:\.(\p{Nd}*))?|\.(\p{Nd}+))(?:[eE]([+-]?\p{Nd}+))?\z"


def is_literal(text: Column) -> Column:
    return text.rlike(_LITERAL)


def _parts(text: Column) -> tuple[Column, Column, Column]:
    whole = F.regexp_extract(text, _LITERAL, 1)
    fraction = F.concat(F.regexp_extract(text, _LITERAL, 2), F.regexp_extract(text, _LITERAL, 3))
    exponent = F.regexp_extract(text, _LITERAL, 4)
    return whole, fraction, F.when(exponent == "", F.lit(0)).otherwise(exponent.try_cast("int"))


def scale(text: Column) -> Column:
    """Decimal places left after dropping trailing zeros (negative for multiples of ten)."""
    whole, fraction, exponent = _parts(text)
    digits = F.concat(whole, fraction)
    zeros = F.length(digits) - F.length(F.rtrim(digits, F.lit("0")))
    return F.length(fraction).cast("bigint") - exponent - zeros


def digits(text: Column) -> Column:
    """Significant digits left after dropping leading and trailing zeros."""
    whole, fraction, _ = _parts(text)
    return F.length(F.trim(F.concat(whole, fraction), F.lit("0"))).cast("bigint")


def money(text: Column) -> Column:
    """The value as ``decimal(38,2)``, or null unless it is exactly representable with two places."""
    # One element list: the text is worked out once, however often the checks read it.
    return F.get(F.transform(F.array(text), _money), F.lit(0))


def _money(text: Column) -> Column:
    exact = F.when(is_literal(text) & (scale(text) <= 2), text.try_cast("decimal(38,2)"))
    return F.when(text.rlike(_PLAIN), text.try_cast("decimal(38,2)")).otherwise(exact)


def round2(value: Column) -> Column:
    """Half-up rounding to cents (``bround`` would be half-even)."""
    return F.round(value, 2)


def money_text(value: Column) -> Column:
    """Two-place text of an amount, e.g. ``1234.50``."""
    return value.cast("decimal(38,2)").cast("string")
