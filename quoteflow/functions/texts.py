"""Small text helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_OUTSIDE_SUPPLEMENTARY = r"[^\x{10000}-\x{10FFFF}]"
# Fixed value: the characters that count as blank around a coupon code.
_BLANK = r"[\s\x1c-\x1f]"


def fits_utf16(text: Column, limit: int) -> Column:
    """At most ``limit`` UTF-16 units; ``length`` counts code points, which may be two units each."""
    points = F.length(text)
    units = points + F.length(F.regexp_replace(text, _OUTSIDE_SUPPLEMENTARY, ""))
    return F.when(points > limit, False).when(points <= limit // 2, True).otherwise(units <= limit)


def is_blank(text: Column) -> Column:
    return text.rlike(r"^\p{javaWhitespace}*\z")


def is_json_blank(text: Column) -> Column:
    return F.length(F.btrim(text, F.lit(" \t\r\n"))) == 0


def strip(text: Column) -> Column:
    """Remove Unicode white space at both ends (``trim`` removes only the space character)."""
    left = F.regexp_replace(text, f"(?U)^{_BLANK}+", "")
    return F.regexp_replace(left, f"(?U){_BLANK}+\\z", "")


def iso_seconds(ts: Column) -> Column:
    """UTC instant at second precision, ``2024-01-01T00:00:00Z``."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
