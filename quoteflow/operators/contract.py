"""Validation of requests against the full contract: every problem is reported, with its location.

Stricter than the analytics checks in some ways (unknown fields) and laxer in others (``"3"`` and
``3.0`` are integers), so the two stay separate. Errors are rows of data: location, type, message,
offending input and the limit that was broken.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, DataFrame, functions as F

from quoteflow import rules
from quoteflow.functions import clean, decimals, texts, variants as V
from quoteflow.functions.rows import Stage, add_stages, once, present

ISSUE = "struct<loc array<string>, type string, msg string, input string, ctx string>"
ITEM = "struct<sku string, qty int, unit_price decimal(8,2)>"
REQUEST = f"struct<items array<{ITEM}>, region string, coupon string>"

_INT_TEXT = r"^([+-]?\d+(?:_\d+)*)(?:\.0*)?\z"
_NOT_FINITE = r"(?i)^[+-]?(s?nan\d*|inf|infinity)\z"
_PLAIN_PRICE = r"^\d{1,6}(\.\d{1,2})?\z"


def check_quotes(requests: DataFrame, body: str = "body") -> DataFrame:
    """Bodies of single-quote requests: add ``issues`` and ``request`` (null unless valid)."""
    steps = add_stages(requests, (*_listed_stages(body), *clean.stages("_list"), *_single_stages(body)))
    request = F.get("_requests", F.lit(0))
    return once(steps, requests.columns, {"issues": F.col("_issues"), "request": request})


def check_jobs(requests: DataFrame, body: str = "body") -> DataFrame:
    """Bodies of bulk-job requests: add ``issues`` and ``quotes`` (null unless valid)."""
    steps = add_stages(requests, (*_body_stages(body), *_job_stages(body)))
    return once(steps, requests.columns, {"issues": F.col("_issues"), "quotes": F.col("_requests")})


def check_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    """Job messages as the worker sees them: add ``job_id``, ``issues`` and ``quotes``.

    Only the ``quotes`` member is held against the contract; other members are not the worker's
    business. A message without a readable job id cannot be recorded against any job, so ``job_id``
    is null for it and the caller dead-letters it.
    """
    steps = add_stages(messages, (*_body_stages(value), *_message_stages()))
    results = {
        "job_id": F.when(~texts.is_blank(F.col("_job_id")), F.col("_job_id")),
        "issues": F.col("_issues"),
        "quotes": F.col("_requests"),
    }
    return once(steps, messages.columns, results)


def issue_rows(checked: DataFrame, keys: list[str]) -> DataFrame:
    """One row per problem, numbered within its request."""
    return checked.select(*keys, F.posexplode("issues").alias("n", "issue")).select(
        *keys, "n", "issue.*"
    )


def quote_outcome(checked: DataFrame) -> DataFrame:
    """Status and detail of creating a quote: 201, or 422 with the list of issues."""
    valid = F.size("issues") == 0
    return checked.withColumns(
        {
            "status": F.when(valid, 201).otherwise(422),
            "detail": F.when(~valid, F.to_json("issues")),
        }
    )


def job_outcome(checked: DataFrame, enqueued: Column) -> DataFrame:
    """Status and detail of submitting a job: 202, 422, or 503 when the queue did not take it."""
    valid = F.size("issues") == 0
    return checked.withColumns(
        {
            "status": F.when(~valid, 422).when(enqueued, 202).otherwise(503),
            "detail": F.when(~valid, F.to_json("issues")).when(~enqueued, rules.QUEUE_DOWN),
        }
    )


def lookup_outcome(found: DataFrame, missing_detail: str = rules.QUOTE_NOT_FOUND) -> DataFrame:
    """Status and detail of a lookup: 200, or 404."""
    return found.withColumns(
        {
            "status": F.when(F.col("found"), 200).otherwise(404),
            "detail": F.when(~F.col("found"), missing_detail),
        }
    )


def normalized(quotes: Column, job_id: Column) -> Column:
    """The message published for a valid job: prices as two-place strings, defaults filled in."""
    rendered = F.transform(
        quotes,
        lambda q: F.struct(
            F.transform(
                q["items"],
                lambda i: F.struct(
                    i["sku"].alias("sku"),
                    i["qty"].alias("qty"),
                    i["unit_price"].cast("string").alias("unit_price"),
                ),
            ).alias("items"),
            q["region"].alias("region"),
            q["coupon"].alias("coupon"),
        ),
    )
    return F.to_json(
        F.struct(job_id.alias("job_id"), rendered.alias("quotes")), {"ignoreNullFields": "false"}
    )


# --- body ----------------------------------------------------------------------------------------


@cache
def _listed_stages(body: str) -> tuple[Stage, ...]:
    """``_body`` as :func:`_body_stages` has it; ``_list``: the value as the only element of a list.

    The JSON reader stops after the first value. Wrapping the text in two different ways makes
    anything that follows the value visible: no text can complete both wrappers early.
    """
    text = F.col(body)
    single = F.col("_whole") & (F.size("_one") == 1)
    return (
        {
            "_list": F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))),
            "_whole": F.try_parse_json(F.concat(F.lit('{"value":'), text, F.lit("}"))).isNotNull(),
        },
        {"_one": V.elements(F.col("_list"))},
        {
            "_body": F.when(single, F.get("_one", F.lit(0))),
            "_list": F.when(single, F.col("_list")),
        },
    )


@cache
def _body_stages(body: str) -> tuple[Stage, ...]:
    """``_body``: the JSON value, null unless the whole text is exactly one JSON value.

    The JSON reader stops after the first value. The text is read once, as the first of two elements
    of a list; the second is its own hash. Whatever follows the value moves the hash or hides it.
    """
    text = F.col(body)
    end = F.xxhash64(text)
    wrapped = F.concat(F.lit("["), text, F.lit(","), end.cast("string"), F.lit("]"))
    closed = F.try_variant_get(F.get("_two", F.lit(1)), "$", "bigint") == end
    single = (F.size("_two") == 2) & closed
    return (
        {"_two": V.elements(F.try_parse_json(wrapped))},
        {"_body": F.when(single, F.get("_two", F.lit(0)))},
    )


def _body_issues(text: Column) -> Column:
    where = F.array(F.lit("body"))
    absent = text.isNull() | (text == "") | (V.kind(F.col("_body")) == "VOID")
    return present(
        F.array(
            F.coalesce(
                _issue(F.coalesce(absent, F.lit(False)), where, "missing", "Field required", F.lit(None)),
                _issue(F.col("_body").isNull(), where, "json_invalid", "JSON decode error", F.lit("{}")),
                _issue(~V.is_object(F.col("_body")), where, *_NOT_AN_OBJECT, F.to_json(F.col("_body"))),
            )
        )
    )


# --- issues --------------------------------------------------------------------------------------

_NOT_AN_OBJECT = (
    "model_attributes_type",
    "Input should be a valid dictionary or object to extract fields from",
)


def _issue(
    when: Column, loc: Column, kind: str, msg: str | Column, input_: Column, ctx: str | Column | None = None
) -> Column:
    return F.when(
        when,
        F.struct(
            loc.alias("loc"),
            F.lit(kind).alias("type"),
            (msg if isinstance(msg, Column) else F.lit(msg)).alias("msg"),
            input_.cast("string").alias("input"),
            (ctx if isinstance(ctx, Column) else F.lit(ctx).cast("string")).alias("ctx"),
        ),
    )


def _missing(when: Column, loc: Column, parent: Column) -> Column:
    return _issue(when, loc, "missing", "Field required", F.to_json(parent))


def _extra_issues(members: Column, allowed: list[str], where: Column) -> Column:
    extra = F.filter(F.map_keys(members), lambda name: ~name.isin(*allowed))
    return F.coalesce(
        F.transform(
            extra,
            lambda name: F.struct(
                F.concat(where, F.array(name)).alias("loc"),
                F.lit("extra_forbidden").alias("type"),
                F.lit("Extra inputs are not permitted").alias("msg"),
                F.to_json(F.try_element_at(members, name)).alias("input"),
                F.lit(None).cast("string").alias("ctx"),
            ),
        ),
        F.array().cast(f"array<{ISSUE}>"),
    )


def _length_issue(size: Column, limits: tuple[int, int], where: Column, value: Column) -> Column:
    low, high = limits
    template = '{"field_type":"List","%s":%d,"actual_length":'
    return F.coalesce(
        _issue(
            size > high,
            where,
            "too_long",
            F.concat(F.lit(f"List should have at most {high} items after validation, not "), size.cast("string")),
            F.to_json(value),
            F.concat(F.lit(template % ("max_length", high)), size.cast("string"), F.lit("}")),
        ),
        _issue(
            size < low,
            where,
            "too_short",
            F.concat(F.lit(f"List should have at least {low} item after validation, not "), size.cast("string")),
            F.to_json(value),
            F.concat(F.lit(template % ("min_length", low)), size.cast("string"), F.lit("}")),
        ),
    )


# --- quotes --------------------------------------------------------------------------------------


@cache
def _single_stages(body: str) -> tuple[Stage, ...]:
    unsure = F.when(F.col("_clean").isNull() & V.is_object(F.col("_body")), F.array("_body"))
    issues = F.concat(_body_issues(F.col(body)), _quote_issues())
    return (*_each_stages(unsure, lambda i: F.array(F.lit("body"))), *_result_stages(issues))


@cache
def _job_stages(body: str) -> tuple[Stage, ...]:
    where = F.array(F.lit("body"))
    missing = _missing(
        F.col("_members").isNotNull() & F.col("_quotes").isNull(), _quotes_loc(), F.col("_body")
    )
    issues = F.concat(
        _body_issues(F.col(body)),
        present(F.array(missing)),
        _list_issues(),
        _extra_issues(F.col("_members"), ["quotes"], where),
    )
    return (
        {"_members": V.fields(F.col("_body"))},
        {"_quotes": V.member(F.col("_members"), "quotes")},
        *_list_stages(),
        *_result_stages(issues),
    )


@cache
def _message_stages() -> tuple[Stage, ...]:
    missing = _missing(F.col("_quotes").isNull(), _quotes_loc(), F.col("_body"))
    return (
        {
            "_job_id": V.text(F.try_variant_get("_body", "$.job_id", "variant")),
            "_quotes": F.try_variant_get("_body", "$.quotes", "variant"),
        },
        *_list_stages(),
        *_result_stages(F.concat(present(F.array(missing)), _list_issues())),
    )


def _quotes_loc() -> Column:
    return F.array(F.lit("body"), F.lit("quotes"))


@cache
def _list_stages() -> tuple[Stage, ...]:
    """Check a job's list of quotes, the VARIANT column ``_quotes``."""
    usable = F.when(F.size("_elements") <= rules.MAX_QUOTES, F.col("_elements"))
    return (
        *clean.stages("_quotes"),
        {"_unsure": F.when(F.col("_clean").isNull(), F.col("_quotes"))},
        {"_elements": V.elements(F.col("_unsure"))},
        *_each_stages(usable, lambda i: F.concat(_quotes_loc(), F.array(i.cast("string")))),
    )


@cache
def _list_issues() -> Column:
    shape = F.coalesce(
        _issue(
            F.col("_unsure").isNotNull() & F.col("_elements").isNull(),
            _quotes_loc(),
            "list_type",
            "Input should be a valid list",
            F.to_json("_unsure"),
        ),
        _length_issue(F.size("_elements"), (1, rules.MAX_QUOTES), _quotes_loc(), F.col("_unsure")),
    )
    return F.concat(present(F.array(shape)), _quote_issues())


def _each_stages(values: Column, where: Callable[[Column], Column]) -> tuple[Stage, ...]:
    """Check quote values (``array<variant>``): ``_q`` has the issues and the typed request of each."""
    opened = F.transform(values, lambda v: F.struct(v.alias("v"), V.fields(v).alias("m")))
    return (
        {"_q": F.transform(opened, _open_quote)},
        {"_q": F.transform(F.transform("_q", _type_lines), lambda q, i: _check_quote(q, where(i)))},
    )


@cache
def _quote_issues() -> Column:
    return F.coalesce(
        F.flatten(F.transform("_q", lambda q: q["issues"])), F.array().cast(f"array<{ISSUE}>")
    )


def _result_stages(issues: Column) -> tuple[Stage, ...]:
    checked = F.transform("_q", lambda q: q["request"]).cast(f"array<{REQUEST}>")
    return (
        {"_issues": issues.cast(f"array<{ISSUE}>")},
        {"_requests": F.when(F.size("_issues") == 0, F.coalesce("_clean", checked))},
    )


def _open_quote(q: Column) -> Column:
    items = V.member(q["m"], "items")
    return F.struct(
        q["v"].alias("v"),
        q["m"].alias("m"),
        items.alias("items"),
        V.elements(items).alias("list"),
        V.member(q["m"], "region").alias("region"),
        V.member(q["m"], "coupon").alias("coupon"),
    )


def _type_lines(q: Column) -> Column:
    lines = F.transform(
        F.when(F.size(q["list"]) <= rules.MAX_ITEMS, q["list"]),
        lambda v: F.struct(v.alias("v"), V.fields(v).alias("m")),
    )
    return F.struct(
        q["v"].alias("v"),
        q["m"].alias("m"),
        q["items"].alias("items"),
        F.size(q["list"]).alias("size"),
        F.transform(F.transform(lines, _open_line), _type_line).alias("lines"),
        q["region"].alias("region"),
        V.text(q["region"]).alias("region_text"),
        q["coupon"].alias("coupon"),
        V.kind(q["coupon"]).alias("coupon_kind"),
        V.text(q["coupon"]).alias("coupon_text"),
    )


def _check_quote(q: Column, where: Column) -> Column:
    is_object = q["m"].isNotNull()
    at = lambda name: F.concat(where, F.array(F.lit(name)))
    line_results = F.transform(
        q["lines"], lambda line, j: _check_line(line, F.concat(where, F.array(F.lit("items"), j.cast("string"))))
    )
    line_issues = F.coalesce(
        F.flatten(F.transform(line_results, lambda r: r["issues"])), F.array().cast(f"array<{ISSUE}>")
    )
    items_issue = F.coalesce(
        _missing(is_object & q["items"].isNull(), at("items"), q["v"]),
        _issue(
            q["items"].isNotNull() & (q["size"].isNull() | (q["size"] < 0)),
            at("items"),
            "list_type",
            "Input should be a valid list",
            F.to_json(q["items"]),
        ),
        _length_issue(q["size"], (1, rules.MAX_ITEMS), at("items"), q["items"]),
    )
    region_issue = F.coalesce(
        _missing(is_object & q["region"].isNull(), at("region"), q["v"]),
        _issue(
            is_object & ~F.coalesce(q["region_text"].isin(*rules.REGIONS), F.lit(False)),
            at("region"),
            "enum",
            "Input should be 'IN', 'US' or 'EU'",
            F.to_json(q["region"]),
            "{\"expected\":\"'IN', 'US' or 'EU'\"}",
        ),
    )
    coupon_given = q["coupon_kind"].isNotNull() & (q["coupon_kind"] != "VOID")
    coupon_issue = F.coalesce(
        _issue(
            coupon_given & q["coupon_text"].isNull(),
            at("coupon"),
            "string_type",
            "Input should be a valid string",
            F.to_json(q["coupon"]),
        ),
        _issue(
            F.length(q["coupon_text"]) > rules.MAX_COUPON,
            at("coupon"),
            "string_too_long",
            f"String should have at most {rules.MAX_COUPON} characters",
            F.to_json(q["coupon"]),
            f'{{"max_length":{rules.MAX_COUPON}}}',
        ),
    )
    not_object = _issue(~is_object, where, *_NOT_AN_OBJECT, F.to_json(q["v"]))
    issues = F.concat(
        present(F.array(not_object, items_issue)),
        line_issues,
        present(F.array(region_issue, coupon_issue)),
        _extra_issues(q["m"], ["items", "region", "coupon"], where),
    )
    request = F.struct(
        F.transform(line_results, lambda r: r["item"]).alias("items"),
        q["region_text"].alias("region"),
        q["coupon_text"].alias("coupon"),
    )
    return F.struct(issues.alias("issues"), request.alias("request"))


# --- line items ----------------------------------------------------------------------------------


def _open_line(line: Column) -> Column:
    qty, price = V.member(line["m"], "qty"), V.member(line["m"], "unit_price")
    price_text = F.regexp_replace(texts.strip(V.number_or_text(price)), "_", "")
    return F.struct(
        line["v"].alias("v"),
        line["m"].alias("m"),
        V.member(line["m"], "sku").alias("sku"),
        qty.alias("qty"),
        V.kind(qty).alias("qty_kind"),
        texts.strip(V.text(qty)).alias("qty_text"),
        price.alias("price"),
        V.kind(price).alias("price_kind"),
        price_text.alias("price_text"),
    )


def _type_line(line: Column) -> Column:
    int_text = F.regexp_replace(F.regexp_extract(line["qty_text"], _INT_TEXT, 1), "_", "")
    number = (
        F.when(V.is_number(line["qty_kind"]), F.try_variant_get(line["qty"], "$", "double"))
        .when(line["qty_kind"] == "BOOLEAN", F.try_variant_get(line["qty"], "$", "boolean").cast("double"))
        .when(line["qty_text"].rlike(_INT_TEXT), int_text.try_cast("double"))
    )
    kept = ["v", "m", "sku", "qty", "qty_kind", "qty_text", "price", "price_kind", "price_text"]
    return F.struct(
        *[line[name].alias(name) for name in kept],
        V.text(line["sku"]).alias("sku_text"),
        number.alias("number"),
    )


def _check_line(line: Column, where: Column) -> Column:
    is_object = line["m"].isNotNull()
    at = lambda name: F.concat(where, F.array(F.lit(name)))
    not_object = _issue(~is_object, where, *_NOT_AN_OBJECT, F.to_json(line["v"]))
    issues = F.concat(
        present(
            F.array(
                not_object,
                _sku_issue(line, is_object, at("sku")),
                _qty_issue(line, is_object, at("qty")),
                _price_issue(line, is_object, at("unit_price")),
            )
        ),
        _extra_issues(line["m"], ["sku", "qty", "unit_price"], where),
    )
    item = F.struct(
        line["sku_text"].alias("sku"),
        F.when(line["number"].between(1, rules.MAX_QTY), line["number"].cast("int")).alias("qty"),
        line["price_text"].try_cast("decimal(8,2)").alias("unit_price"),
    )
    return F.struct(issues.alias("issues"), item.alias("item"))


def _sku_issue(line: Column, is_object: Column, loc: Column) -> Column:
    shown = F.to_json(line["sku"])
    return F.coalesce(
        _missing(is_object & line["sku"].isNull(), loc, line["v"]),
        _issue(is_object & line["sku_text"].isNull(), loc, "string_type", "Input should be a valid string", shown),
        _issue(
            F.length(line["sku_text"]) < 1,
            loc,
            "string_too_short",
            "String should have at least 1 character",
            shown,
            '{"min_length":1}',
        ),
        _issue(
            F.length(line["sku_text"]) > rules.MAX_SKU,
            loc,
            "string_too_long",
            f"String should have at most {rules.MAX_SKU} characters",
            shown,
            f'{{"max_length":{rules.MAX_SKU}}}',
        ),
    )


def _qty_issue(line: Column, is_object: Column, loc: Column) -> Column:
    shown, number = F.to_json(line["qty"]), line["number"]
    return F.coalesce(
        _missing(is_object & line["qty"].isNull(), loc, line["v"]),
        _issue(
            is_object & number.isNull() & (line["qty_kind"] == "STRING"),
            loc,
            "int_parsing",
            "Input should be a valid integer, unable to parse string as an integer",
            shown,
        ),
        _issue(is_object & number.isNull(), loc, "int_type", "Input should be a valid integer", shown),
        _issue(
            # floor() of a double would stop at the largest bigint; the remainder is right at any size.
            number % 1 != 0,
            loc,
            "int_from_float",
            "Input should be a valid integer, got a number with a fractional part",
            shown,
        ),
        _issue(
            number > rules.MAX_QTY,
            loc,
            "less_than_equal",
            f"Input should be less than or equal to {rules.MAX_QTY}",
            shown,
            f'{{"le":{rules.MAX_QTY}}}',
        ),
        _issue(
            number < 1,
            loc,
            "greater_than_equal",
            "Input should be greater than or equal to 1",
            shown,
            '{"ge":1}',
        ),
    )


def _price_issue(line: Column, is_object: Column, loc: Column) -> Column:
    shown, text = F.to_json(line["price"]), line["price_text"]
    places = F.greatest(decimals.scale(text), F.lit(0))
    scale = decimals.scale(text)
    total = F.when(scale <= 0, decimals.digits(text) - scale).otherwise(
        F.greatest(decimals.digits(text), scale)
    )
    readable = F.coalesce(
        _missing(is_object & line["price"].isNull(), loc, line["v"]),
        _issue(
            is_object & text.isNull(),
            loc,
            "decimal_type",
            "Decimal input should be an integer, float, string or Decimal object",
            shown,
        ),
        _issue(text.rlike(_NOT_FINITE), loc, "finite_number", "Input should be a finite number", shown),
        _issue(~decimals.is_literal(text), loc, "decimal_parsing", "Input should be a valid decimal", shown),
    )
    whole_max = rules.PRICE_MAX_DIGITS - rules.PRICE_MAX_PLACES
    sized = F.coalesce(
        _issue(
            total > rules.PRICE_MAX_DIGITS,
            loc,
            "decimal_max_digits",
            f"Decimal input should have no more than {rules.PRICE_MAX_DIGITS} digits in total",
            shown,
            f'{{"max_digits":{rules.PRICE_MAX_DIGITS}}}',
        ),
        _issue(
            places > rules.PRICE_MAX_PLACES,
            loc,
            "decimal_max_places",
            f"Decimal input should have no more than {rules.PRICE_MAX_PLACES} decimal places",
            shown,
            f'{{"decimal_places":{rules.PRICE_MAX_PLACES}}}',
        ),
        _issue(
            total - places > whole_max,
            loc,
            "decimal_whole_digits",
            f"Decimal input should have no more than {whole_max} digits before the decimal point",
            shown,
            f'{{"whole_digits":{whole_max}}}',
        ),
    )
    amount = text.try_cast("decimal(10,2)")
    ranged = F.coalesce(
        _issue(
            amount > F.lit(rules.MAX_UNIT_PRICE),
            loc,
            "less_than_equal",
            f"Input should be less than or equal to {rules.MAX_UNIT_PRICE}",
            shown,
            f'{{"le":{rules.MAX_UNIT_PRICE}}}',
        ),
        _issue(amount <= 0, loc, "greater_than", "Input should be greater than 0", shown, '{"gt":0}'),
    )
    # A plain price can only break the range; everything else is analysed digit by digit.
    return F.when(text.rlike(_PLAIN_PRICE), ranged).otherwise(F.coalesce(readable, sized, ranged))
