"""Fast reading of well-formed quotes, the bulk of any real traffic.

``schema_of_variant`` describes a whole list in one walk. If that description is exactly the layout of
a quote (no other member, every quantity an integer, every price a number or text), one typed cast
reads everything and a few range checks settle it. A list that is not certainly fine is left to the
full checks, which say what is wrong with it; so nothing is accepted or rejected by this step alone.
"""

from __future__ import annotations

from decimal import Decimal
from functools import cache

from pyspark.sql import Column, functions as F

from quoteflow import rules
from quoteflow.functions.rows import Stage

# Fixed value: what the description of a list of plain quotes looks like.
_LAYOUT = (
    r"^ARRAY<OBJECT<(coupon: (STRING|VOID), )?"
    r"items: ARRAY<OBJECT<qty: BIGINT, sku: STRING, "
    r"unit_price: (STRING|BIGINT|DOUBLE|VARIANT|DECIMAL\(\d+,\d+\))>>, "
    r"region: STRING>>\z"
)
_PRICE = r"^\d{1,6}(\.\d{1,2})?\z"
_TYPED = (
    "array<struct<items:array<struct<sku:string,qty:bigint,unit_price:string>>,"
    "region:string,coupon:string>>"
)


@cache
def stages(quotes: str) -> tuple[Stage, ...]:
    """Add ``_clean``: the typed requests of a list of quotes (the VARIANT column ``quotes``), or
    null where the list needs the full checks."""
    plain = F.coalesce(F.schema_of_variant(quotes).rlike(_LAYOUT), F.lit(False))
    typed = F.when(plain, F.try_variant_get(quotes, "$", _TYPED))
    sized = F.size("_clean").between(1, rules.MAX_QUOTES)
    return (
        {"_clean": F.transform(typed, _type_quote)},
        {"_clean": F.when(sized & F.forall("_clean", _quote_ok), F.col("_clean"))},
    )


def _type_quote(quote: Column) -> Column:
    items = F.transform(F.transform(quote["items"], _type_item), lambda i: F.when(_item_ok(i), i))
    return F.struct(items.alias("items"), quote["region"].alias("region"), quote["coupon"].alias("coupon"))


def _type_item(item: Column) -> Column:
    text = item["unit_price"]
    return F.struct(
        item["sku"].alias("sku"),
        F.when(item["qty"].between(1, rules.MAX_QTY), item["qty"].cast("int")).alias("qty"),
        F.when(text.rlike(_PRICE), text.cast("decimal(8,2)")).alias("unit_price"),
    )


def _item_ok(item: Column) -> Column:
    # A text is never longer in characters or UTF-16 units than in bytes.
    return (
        F.octet_length(item["sku"]).between(1, rules.MAX_SKU)
        & item["qty"].isNotNull()
        & item["unit_price"].between(F.lit(Decimal("0.01")), F.lit(rules.MAX_UNIT_PRICE))
    )


def _quote_ok(quote: Column) -> Column:
    ok = (
        quote["region"].isin(*rules.REGIONS)
        & F.size(quote["items"]).between(1, rules.MAX_ITEMS)
        & ~F.exists(quote["items"], lambda i: i.isNull())
        & (quote["coupon"].isNull() | (F.octet_length(quote["coupon"]) <= rules.MAX_COUPON))
    )
    return F.coalesce(ok, F.lit(False))
