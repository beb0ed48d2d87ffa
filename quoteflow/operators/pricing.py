"""Pricing: line totals, coupon, regional tax, shipping, total. Exact decimals at every step."""

from __future__ import annotations

from decimal import Decimal
from functools import cache

from pyspark.sql import Column, DataFrame, functions as F

from quoteflow import rules
from quoteflow.functions import decimals, texts
from quoteflow.functions.rows import Stage, add_stages

MONEY = "decimal(13,2)"


def _by_region(region: Column, values: dict[str, Decimal | str]) -> Column:
    """Three fixed regions: a CASE folds into the generated code, no lookup join needed."""
    out = None
    for name, value in values.items():
        out = F.when(region == name, F.lit(value)) if out is None else out.when(region == name, F.lit(value))
    return out


def line_total(unit_price: Column, qty: Column) -> Column:
    return decimals.round2(unit_price * qty).cast("decimal(11,2)")


def coupon_code(coupon: Column) -> Column:
    return F.upper(texts.strip(F.coalesce(coupon, F.lit(""))))


def discount(coupon: Column, subtotal: Column) -> Column:
    """Unknown coupons give no discount; they are not an error."""
    code = coupon_code(coupon)
    percent = F.least(
        decimals.round2(subtotal * F.lit(rules.PERCENT_COUPON_RATE)).cast(MONEY),
        F.lit(rules.PERCENT_COUPON_CAP).cast(MONEY),
    )
    flat_applies = (code == rules.FLAT_COUPON) & (subtotal >= F.lit(rules.FLAT_COUPON_MIN_SUBTOTAL))
    return (
        F.when(code == rules.PERCENT_COUPON, percent)
        .when(flat_applies, F.lit(rules.FLAT_COUPON_AMOUNT).cast(MONEY))
        .otherwise(F.lit(Decimal("0.00")).cast(MONEY))
    )


def tax(region: Column, taxable: Column) -> Column:
    return decimals.round2(taxable * _by_region(region, rules.TAX_RATE)).cast(MONEY)


def shipping(region: Column, taxable: Column) -> Column:
    free = taxable >= _by_region(region, rules.FREE_SHIPPING_FROM)
    fee = _by_region(region, rules.SHIPPING_FEE)
    return F.when(free, F.lit(Decimal("0.00"))).otherwise(fee).cast(MONEY)


def currency(region: Column) -> Column:
    return _by_region(region, rules.CURRENCY)


def totals(quotes: DataFrame) -> DataFrame:
    """From ``region``, ``coupon`` and ``subtotal`` to discount, tax, shipping and total.

    The free-shipping threshold and the tax both look at the discounted subtotal.
    """
    return add_stages(quotes, _total_stages()).drop("_taxable")


@cache
def _total_stages() -> tuple[Stage, ...]:
    region, taxable = F.col("region"), F.col("_taxable")
    return (
        {"discount": discount(F.col("coupon"), F.col("subtotal"))},
        {"_taxable": (F.col("subtotal") - F.col("discount")).cast(MONEY)},
        {
            "tax": tax(region, taxable),
            "shipping": shipping(region, taxable),
            "currency": currency(region),
        },
        {"total": (taxable + F.col("tax") + F.col("shipping")).cast(MONEY)},
    )


def price(requests: DataFrame) -> DataFrame:
    """Price nested requests (``quote_id``, ``region``, ``coupon``, ``items``, ``ts``) row by row.

    A request holds at most 100 items, so its lines stay an array and nothing is shuffled.
    """
    priced = totals(add_stages(requests, _subtotal_stages()))
    priced = priced.withColumn("created_at", texts.iso_seconds(F.col("ts")))
    return priced.withColumnRenamed("quote_id", "id").drop("items", "ts")


@cache
def _subtotal_stages() -> tuple[Stage, ...]:
    lines = F.transform(
        "items",
        lambda i: F.struct(
            i["sku"].alias("sku"),
            i["qty"].alias("qty"),
            i["unit_price"].alias("unit_price"),
            line_total(i["unit_price"], i["qty"]).alias("line_total"),
        ),
    )
    subtotal = F.aggregate(
        "line_items",
        F.lit(Decimal("0.00")).cast(MONEY),
        lambda sum_, line: (sum_ + line["line_total"]).cast(MONEY),
    )
    return {"line_items": lines}, {"subtotal": subtotal}


QUOTE_COLUMNS = [
    "id",
    "region",
    "currency",
    "coupon",
    "line_items",
    "subtotal",
    "discount",
    "tax",
    "shipping",
    "total",
    "created_at",
]


def price_lines(lines: DataFrame, key: str) -> DataFrame:
    """Subtotals of requests kept as flat rows (``key``, ``qty``, ``unit_price``), and ``reject``: why a
    request is invalid, null if it is not.

    Never gathers the lines of a request: each task adds up its own rows first, so an order of any
    size reaches the shuffle as one row per task.
    """
    bad = ~(
        F.col("unit_price").between(F.lit(Decimal("0.01")), F.lit(rules.MAX_UNIT_PRICE))
        & F.col("qty").between(1, rules.MAX_QTY)
    )
    totals_ = lines.groupBy(key).agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.coalesce(bad, F.lit(True))).alias("_bad"),
        F.sum(line_total(F.col("unit_price"), F.col("qty"))).cast(MONEY).alias("subtotal"),
    )
    reject = F.when(F.col("lines") > rules.MAX_ITEMS, rules.TOO_MANY_ITEMS).when(
        F.col("_bad") > 0, rules.ITEM_OUT_OF_RANGE
    )
    return totals_.select(key, "lines", "subtotal", reject.alias("reject"))


def quote_body() -> Column:
    """A priced quote as its JSON document, amounts as two-place strings."""
    amounts = ["subtotal", "discount", "tax", "shipping", "total"]
    line_items = F.transform(
        "line_items",
        lambda i: F.struct(
            i["sku"].alias("sku"),
            i["qty"].alias("qty"),
            i["unit_price"].cast("string").alias("unit_price"),
            i["line_total"].cast("string").alias("line_total"),
        ),
    )
    members = [
        *["id", "region", "currency", "coupon"],
        line_items.alias("line_items"),
        *[decimals.money_text(F.col(name)).alias(name) for name in amounts],
        "created_at",
    ]
    return F.to_json(F.struct(*members), {"ignoreNullFields": "false"})
