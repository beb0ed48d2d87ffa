"""Request contract: all problems with their location, type and limit."""

import json

import pytest
from pyspark.sql import functions as F

from quoteflow.operators import contract, jobs


def item(**changes):
    made = {"sku": "mug", "qty": 6, "unit_price": "8.40", **changes}
    return {k: v for k, v in made.items() if v != "drop"}


def body(**changes):
    return json.dumps({"items": [item()], "region": "IN", **changes})


# body text -> [(location, type)]
CASES = [
    (body(), []),
    (body(coupon=None), []),
    (body(items=[item(unit_price=19.99)]), []),
    (body(items=[item(qty="3")]), []),
    (body(items=[item(qty=" +3.0 ")]), []),
    (body(items=[item(qty=3.0)]), []),
    (body(items=[item(qty=True)]), []),
    (body(items=[item(unit_price=" 5 ")]), []),
    (body(items=[item(unit_price="1_0.00")]), []),
    (body(items=[item(unit_price="1.9900")]), []),
    (body(items=[item(unit_price="1e2")]), []),
    (body(items=[item(sku="\U0001f600" * 64)]), []),
    (json.dumps({"items": [item()]}), [("body.region", "missing")]),
    (body(region="UK"), [("body.region", "enum")]),
    (body(region=None), [("body.region", "enum")]),
    (body(items=[]), [("body.items", "too_short")]),
    (body(items=[item(qty=0)] * 101), [("body.items", "too_long")]),
    (body(items="x"), [("body.items", "list_type")]),
    (body(items=None), [("body.items", "list_type")]),
    (body(items=[item(qty=0)]), [("body.items.0.qty", "greater_than_equal")]),
    (body(items=[item(qty=1001)]), [("body.items.0.qty", "less_than_equal")]),
    (body(items=[item(qty="two")]), [("body.items.0.qty", "int_parsing")]),
    (body(items=[item(qty=1.5)]), [("body.items.0.qty", "int_from_float")]),
    (body(items=[item(qty=None)]), [("body.items.0.qty", "int_type")]),
    (body(items=[item(unit_price="-1")]), [("body.items.0.unit_price", "greater_than")]),
    (body(items=[item(unit_price="1.999")]), [("body.items.0.unit_price", "decimal_max_places")]),
    (body(items=[item(unit_price="123456789")]), [("body.items.0.unit_price", "decimal_max_digits")]),
    (body(items=[item(unit_price="1234567")]), [("body.items.0.unit_price", "decimal_whole_digits")]),
    (body(items=[item(unit_price="100000.01")]), [("body.items.0.unit_price", "less_than_equal")]),
    (body(items=[item(unit_price="abc")]), [("body.items.0.unit_price", "decimal_parsing")]),
    (body(items=[item(unit_price="-Infinity")]), [("body.items.0.unit_price", "finite_number")]),
    (body(items=[item(unit_price=True)]), [("body.items.0.unit_price", "decimal_type")]),
    (body(items=[item(unit_price="drop")]), [("body.items.0.unit_price", "missing")]),
    (body(items=[item(sku="drop", qty="drop")]), [("body.items.0.sku", "missing"), ("body.items.0.qty", "missing")]),
    (body(items=[item(sku="")]), [("body.items.0.sku", "string_too_short")]),
    (body(items=[item(sku="x" * 65)]), [("body.items.0.sku", "string_too_long")]),
    (body(items=[item(sku=3)]), [("body.items.0.sku", "string_type")]),
    (body(items=[item(), 3]), [("body.items.1", "model_attributes_type")]),
    (body(items=[item(colour="red")]), [("body.items.0.colour", "extra_forbidden")]),
    (body(priority=True), [("body.priority", "extra_forbidden")]),
    (body(coupon="y" * 33), [("body.coupon", "string_too_long")]),
    (body(coupon=5), [("body.coupon", "string_type")]),
    ("[1, 2, 3]", [("body", "model_attributes_type")]),
    ('{"items": [,], "region": "IN"}', [("body", "json_invalid")]),
    (body() + " {}", [("body", "json_invalid")]),
    ("1] , [2", [("body", "json_invalid")]),
    ('1, "x": 2', [("body", "json_invalid")]),
    (" ", [("body", "json_invalid")]),
    ("", [("body", "missing")]),
    (None, [("body", "missing")]),
    ("null", [("body", "missing")]),
    (
        body(items=[item(qty=0), item(unit_price="x")], region="UK", zip=1),
        [
            ("body.items.0.qty", "greater_than_equal"),
            ("body.items.1.unit_price", "decimal_parsing"),
            ("body.region", "enum"),
            ("body.zip", "extra_forbidden"),
        ],
    ),
]


@pytest.fixture(scope="module")
def checked(spark):
    frame = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "n int, body string")
    return contract.check_quotes(frame).cache()


def test_every_case(checked):
    got = {r.n: [(".".join(i.loc), i.type) for i in r.issues] for r in checked.collect()}
    wrong = {CASES[n][0]: (g, CASES[n][1]) for n, g in got.items() if g != CASES[n][1]}
    assert not wrong


def test_valid_requests_are_typed_and_invalid_ones_are_not(checked):
    for row in checked.collect():
        assert (row.request is not None) == (not CASES[row.n][1]), CASES[row.n][0]
        if row.request:
            assert all(i.sku and i.qty and i.unit_price for i in row.request["items"])


def test_issue_details(checked):
    rows = contract.issue_rows(checked.withColumnRenamed("n", "case_no"), ["case_no"])
    by_type = {(r.type, ".".join(r["loc"])): r for r in rows.collect()}
    gt = by_type["greater_than", "body.items.0.unit_price"]
    assert (gt.msg, gt.input, gt.ctx) == ("Input should be greater than 0", '"-1"', '{"gt":0}')
    le = by_type["less_than_equal", "body.items.0.unit_price"]
    assert (le.msg, le.ctx) == ("Input should be less than or equal to 100000", '{"le":100000}')
    assert by_type["enum", "body.region"].ctx == "{\"expected\":\"'IN', 'US' or 'EU'\"}"
    assert by_type["too_short", "body.items"].input == "[]"
    assert by_type["json_invalid", "body"].input == "{}"
    assert by_type["missing", "body"].input is None


def test_outcomes(checked):
    rows = contract.quote_outcome(checked).collect()
    assert all(r.status == (422 if CASES[r.n][1] else 201) for r in rows)
    assert all((r.detail is None) == (r.status == 201) for r in rows)


def test_job_bodies(spark):
    quote = json.loads(body())
    cases = [
        (json.dumps({"quotes": [quote]}), []),
        (json.dumps({"quotes": []}), [("body.quotes", "too_short")]),
        (json.dumps({"quotes": [quote] * 51}), [("body.quotes", "too_long")]),
        (json.dumps({}), [("body.quotes", "missing")]),
        (json.dumps({"quotes": 3}), [("body.quotes", "list_type")]),
        (json.dumps({"quotes": [quote, 3], "x": 1}), [("body.quotes.1", "model_attributes_type"), ("body.x", "extra_forbidden")]),
        (json.dumps({"quotes": [quote, {**quote, "region": 1}]}), [("body.quotes.1.region", "enum")]),
        ("[]", [("body", "model_attributes_type")]),
    ]
    frame = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "n int, body string")
    for row in contract.check_jobs(frame).collect():
        assert [(".".join(i.loc), i.type) for i in row.issues] == cases[row.n][1]
        assert (row.quotes is None) == bool(cases[row.n][1])


def test_published_message_has_text_prices_and_defaults(spark):
    frame = spark.createDataFrame([(json.dumps({"quotes": [{"items": [item(unit_price=10)], "region": "IN"}]}),)], "body string")
    valid = contract.check_jobs(frame)
    text = contract.normalized(F.col("quotes"), F.lit("job-9"))
    message = json.loads(valid.select(text.alias("m")).collect()[0].m)
    assert message == {
        "job_id": "job-9",
        "quotes": [{"items": [{"sku": "mug", "qty": 6, "unit_price": "10.00"}], "region": "IN", "coupon": None}],
    }


def test_worker_contract_differs_from_the_analytics_checks(spark):
    """Extra members of the message are fine for the worker, extra members of a quote are not."""
    rows = [
        ("a", json.dumps({"job_id": "a", "x": 1, "quotes": [json.loads(body())]}), True),
        ("b", json.dumps({"job_id": "b", "quotes": [json.loads(body(x=1))]}), False),
        ("c", json.dumps({"job_id": "c", "quotes": [json.loads(body(items=[item(qty="3")]))]}), True),
        ("d", json.dumps({"job_id": "d"}), False),
    ]
    frame = spark.createDataFrame([(k, v) for k, v, _ in rows], "key string, value string")
    got = {r.job_id: r.quotes is not None for r in contract.check_messages(frame).collect()}
    assert got == {k: ok for k, _, ok in rows}


def test_messages_without_job_id_are_left_to_the_dead_letters(spark):
    frame = spark.createDataFrame([('{"quotes": []}',), ("{bad",), (None,), ('{"job_id": " "}',)], "value string")
    checked = contract.check_messages(frame)
    assert checked.filter("job_id is not null").count() == 0
    quotes, done = jobs.run(checked.withColumn("timestamp", F.current_timestamp()))
    assert quotes.count() == 0 and done.count() == 0


@pytest.mark.parametrize(
    "qty, kind",
    [
        ("10000000000000000000", "less_than_equal"),
        ("1e30", "less_than_equal"),
        ('"' + "9" * 30 + '"', "less_than_equal"),
        ("1000.5", "int_from_float"),
        ("-1e30", "greater_than_equal"),
    ],
)
def test_quantities_of_any_size_get_the_right_error(spark, qty, kind):
    body = f'{{"region": "EU", "items": [{{"sku": "s", "qty": {qty}, "unit_price": "1.00"}}]}}'
    checked = contract.check_quotes(spark.createDataFrame([("r", body)], "request_id string, body string"))
    assert [r.type for r in contract.issue_rows(checked, ["request_id"]).collect()] == [kind]
