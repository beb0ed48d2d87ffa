"""Validation of bulk-job messages for the analytics path.

The first failing check gives the whole message its single error text; a message is accepted or
rejected as a unit. A bad message becomes data in the ``error`` column and never an exception.
All checks are built-in expressions, so parsing is one narrow stage with no shuffle.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, functions as F

from quoteflow import rules
from quoteflow.functions import decimals, texts, variants as V
from quoteflow.functions.rows import Stage, add_stages, once

EVENTS = (
    "array<struct<job_id string, position int, region string, item_count int, "
    "gross_amount_cents bigint, coupon string>>"
)


def validated(messages: DataFrame, value: str = "value") -> DataFrame:
    """Add ``error`` (null when valid) and ``events`` (one per quote, empty when invalid)."""
    steps = add_stages(messages, _stages(value))
    return once(steps, messages.columns, _results())


@cache
def _stages(value: str) -> tuple[Stage, ...]:
    quote_errors = F.filter(F.transform("_q", lambda q: q["error"]), lambda e: e.isNotNull())
    return (
        {"_json": F.try_parse_json(F.col(value))},
        {
            "_job_id": V.text(F.try_variant_get("_json", "$.job_id", "variant")),
            "_quotes": F.try_variant_get("_json", "$.quotes", "variant"),
        },
        {"_q": _read_quotes(F.col("_quotes"))},
        {"_message_error": _message_error(F.col(value))},
        # Quotes of a message that is already rejected are not looked at.
        {"_q": F.when(F.col("_message_error").isNull(), F.col("_q"))},
        {"_q": F.transform(F.transform("_q", _type_quote), _check_quote)},
        {"_error": F.coalesce(F.col("_message_error"), F.get(quote_errors, F.lit(0)))},
    )


@cache
def _results() -> Stage:
    valid = F.col("_error").isNull()
    events = F.when(valid, F.transform("_q", _event).cast(EVENTS)).otherwise(F.array().cast(EVENTS))
    return {"error": F.col("_error"), "events": events}


def _event(quote: Column, position: Column) -> Column:
    return F.struct(
        F.col("_job_id").alias("job_id"),
        position.alias("position"),
        quote["region"].alias("region"),
        quote["item_count"].alias("item_count"),
        quote["cents"].alias("gross_amount_cents"),
        quote["coupon"].alias("coupon"),
    )


def split(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid messages and the rest. Both branches read the same plan; persist it to parse once."""
    return checked.filter("error is null"), checked.filter("error is not null")


def _message_error(value: Column) -> Column:
    unreadable = F.col("_json").isNull()
    return (
        F.when(value.isNull(), rules.EMPTY_MESSAGE)
        .when(unreadable & ~texts.is_json_blank(value), rules.MALFORMED_JSON)
        .when(unreadable | ~V.is_object(F.col("_json")), rules.NOT_AN_OBJECT)
        .when(F.col("_job_id").isNull() | texts.is_blank(F.col("_job_id")), rules.MISSING_JOB_ID)
        .when(
            F.col("_q").isNull() | ~F.size("_q").between(1, rules.MAX_QUOTES),
            rules.BAD_QUOTES,
        )
    )


# Layout of a job's quotes. Scalars stay VARIANT, so their JSON types can still be checked.
_ITEM = "struct<sku:variant,qty:variant,unit_price:variant>"
_QUOTE = f"struct<region:variant,items:array<{_ITEM}>,coupon:variant>"


def _read_quotes(quotes: Column) -> Column:
    """The list in the layout above: a null element is not an object, null items are not a list.

    A list of the right shape is read in one step. Only when that fails is it read element by
    element, to tell which part has the wrong shape.
    """
    return F.coalesce(
        F.try_variant_get(quotes, "$", f"array<{_QUOTE}>"),
        F.transform(V.elements(quotes), _read_quote),
    )


def _read_quote(quote: Column) -> Column:
    items = F.try_variant_get(quote, "$.items", "variant")
    piecewise = F.struct(
        F.try_variant_get(quote, "$.region", "variant").alias("region"),
        F.transform(V.elements(items), lambda item: F.try_variant_get(item, "$", _ITEM)).alias("items"),
        F.try_variant_get(quote, "$.coupon", "variant").alias("coupon"),
    )
    return F.coalesce(F.try_variant_get(quote, "$", _QUOTE), F.when(V.is_object(quote), piecewise))


def _type_quote(quote: Column) -> Column:
    # Oversized lists are rejected by their size alone, so their items are not read.
    items = F.when(F.size(quote["items"]) <= rules.MAX_ITEMS, F.transform(quote["items"], _type_item))
    return F.struct(
        quote.isNotNull().alias("is_object"),
        V.text(quote["region"]).alias("region"),
        F.size(quote["items"]).alias("item_count"),
        F.transform(items, _check_item).alias("lines"),
        V.kind(quote["coupon"]).alias("coupon_kind"),
        V.text(quote["coupon"]).alias("coupon"),
    )


def _type_item(item: Column) -> Column:
    return F.struct(
        item.isNotNull().alias("is_object"),
        V.text(item["sku"]).alias("sku"),
        F.when(V.kind(item["qty"]) == "BIGINT", F.try_variant_get(item["qty"], "$", "bigint")).alias("qty"),
        decimals.money(V.number_or_text(item["unit_price"])).alias("price"),
    )


def _check_item(item: Column) -> Column:
    sku_ok = (F.length(item["sku"]) > 0) & texts.fits_utf16(item["sku"], rules.MAX_SKU)
    price_ok = (item["price"] > 0) & (item["price"] <= F.lit(rules.MAX_UNIT_PRICE))
    problem = (
        F.when(~item["is_object"], rules.ITEM_NOT_OBJECT)
        .when(~F.coalesce(sku_ok, F.lit(False)), rules.BAD_SKU)
        .when(~F.coalesce(item["qty"].between(1, rules.MAX_QTY), F.lit(False)), rules.BAD_QTY)
        .when(~F.coalesce(price_ok, F.lit(False)), rules.BAD_PRICE)
    )
    # Only read when no item of the quote has a problem.
    cents = F.when(price_ok & item["qty"].between(1, rules.MAX_QTY), (item["price"] * 100).cast("bigint") * item["qty"])
    return F.struct(problem.alias("problem"), cents.alias("cents"))


def _check_quote(quote: Column, position: Column) -> Column:
    where = F.concat(F.lit("quotes["), position.cast("string"), F.lit("]"))
    item_errors = F.filter(
        F.transform(
            quote["lines"],
            lambda line, j: F.concat(where, F.lit(".items["), j.cast("string"), F.lit("]"), line["problem"]),
        ),
        lambda e: e.isNotNull(),
    )
    region_ok = F.coalesce(quote["region"].isin(*rules.REGIONS), F.lit(False))
    items_ok = F.coalesce(quote["item_count"].between(1, rules.MAX_ITEMS), F.lit(False))
    coupon_given = quote["coupon_kind"].isNotNull() & (quote["coupon_kind"] != "VOID")
    coupon_ok = F.coalesce(texts.fits_utf16(quote["coupon"], rules.MAX_COUPON), F.lit(False))
    error = (
        F.when(~quote["is_object"], F.concat(where, F.lit(rules.QUOTE_NOT_OBJECT)))
        .when(~region_ok, F.concat(where, F.lit(rules.BAD_REGION)))
        .when(~items_ok, F.concat(where, F.lit(rules.BAD_ITEMS)))
        .otherwise(
            F.coalesce(
                F.get(item_errors, F.lit(0)),
                F.when(coupon_given & ~coupon_ok, F.concat(where, F.lit(rules.BAD_COUPON))),
            )
        )
    )
    return F.struct(
        error.alias("error"),
        quote["region"].alias("region"),
        quote["item_count"].alias("item_count"),
        F.aggregate(quote["lines"], F.lit(0).cast("bigint"), lambda sum_, line: sum_ + line["cents"]).alias("cents"),
        quote["coupon"].alias("coupon"),
    )
