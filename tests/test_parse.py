"""Analytics-path validation: fixed error texts, first error wins, whole message atomic."""

import json

import pytest
from pyspark.sql import functions as F

from quoteflow import session
from quoteflow.operators import fanout, parse
from quoteflow.plans import inputs

# A cart with a price as text, as a whole number and as a fraction; a coupon given, null and left out.
VALID = {
    "job_id": "spring order",
    "quotes": [
        {
            "items": [
                {"sku": "lamp", "qty": 4, "unit_price": "12.50"},
                {"sku": "bulb", "qty": 10, "unit_price": 0.99},
                {"sku": "shade", "qty": 1, "unit_price": 7},
            ],
            "region": "EU",
            "coupon": "FLAT50",
        },
        {"items": [{"sku": "desk", "qty": 1, "unit_price": "310.05"}], "region": "US"},
        {"items": [{"sku": "pen", "qty": 12, "unit_price": "1.5"}], "region": "IN", "coupon": None},
    ],
}
ITEM = "quotes[0].items[0]"
PRICE = f"{ITEM}.unit_price must be > 0 and <= 100000 with at most 2 decimals"
QTY = f"{ITEM}.qty must be an integer from 1 to 1000"
SKU = f"{ITEM}.sku must be 1-64 characters"
LIST = "quotes must be a list of 1-50 requests"
ITEMS = "quotes[0].items must be a list of 1-100 items"
COUPON = "quotes[0].coupon must be a string of at most 32 characters"


def job(**quote):
    return json.dumps({"job_id": "j", "quotes": [{"items": [item()], "region": "IN", **quote}]})


def item(**changes):
    return {"sku": "A", "qty": 1, "unit_price": "10.00", **changes}


def priced(text):
    """A job whose unit price is the given JSON token."""
    return job(items=[item(unit_price="@")]).replace('"@"', text)


CASES = [
    (None, "empty message"),
    ('{"job_id": "j", "quotes": [', "malformed JSON"),
    ("{'job_id': 'j'}", "malformed JSON"),
    ("", "message is not a JSON object"),
    (" \n ", "message is not a JSON object"),
    ("[1, 2]", "message is not a JSON object"),
    ('"x"', "message is not a JSON object"),
    ("null", "message is not a JSON object"),
    ('{"quotes": []}', "missing job_id"),
    ('{"job_id": " \\t", "quotes": []}', "missing job_id"),
    ('{"job_id": 7, "quotes": []}', "missing job_id"),
    ('{"job_id": "j"}', LIST),
    ('{"job_id": "j", "quotes": []}', LIST),
    ('{"job_id": "j", "quotes": {"a": 1}}', LIST),
    (json.dumps({"job_id": "j", "quotes": [{}] * 51}), LIST),
    (json.dumps({"job_id": "j", "quotes": [3]}), "quotes[0] is not an object"),
    (json.dumps({"job_id": "j", "quotes": [None]}), "quotes[0] is not an object"),
    (job(region="UK"), "quotes[0].region must be IN, US or EU"),
    (job(region="in"), "quotes[0].region must be IN, US or EU"),
    (job(region=1), "quotes[0].region must be IN, US or EU"),
    (job(items=[]), ITEMS),
    (job(items=None), ITEMS),
    (job(items={"a": 1}), ITEMS),
    (job(items=[item()] * 101), ITEMS),
    (job(items=["x"]), f"{ITEM} is not an object"),
    (job(items=[None]), f"{ITEM} is not an object"),
    (job(items=[item(sku="")]), SKU),
    (job(items=[item(sku="x" * 65)]), SKU),
    (job(items=[item(sku="\U0001f600" * 33)]), SKU),
    (job(items=[item(sku=5)]), SKU),
    (job(items=[item(qty=0)]), QTY),
    (job(items=[item(qty=1.5)]), QTY),
    (job(items=[item(qty=1.0)]), QTY),
    (job(items=[item(qty="3")]), QTY),
    (job(items=[item(qty=1001)]), QTY),
    (job(items=[item(qty=10**30)]), QTY),
    (job(items=[item(qty=True)]), QTY),
    *[
        (priced(t), PRICE)
        for t in (
            '"1.999"', "1.999", '"-1"', "-1", '"abc"', "0", '"0.00"', "100000.01", '" 5 "', "true",
            "null", '"1e-3"', '"1.0000000000000000000000000000000000000000000001"', '"1e99999999999"',
            '"NaN"', '""', '"."', '"5\\n"',
        )
    ],
    (job(coupon="y" * 33), COUPON),
    (job(coupon=5), COUPON),
    (job(region="XX", items=[], coupon=5), "quotes[0].region must be IN, US or EU"),
    (job(items=[item(), item(qty=0), item(sku="")]), QTY.replace("items[0]", "items[1]")),
    (job(items=[item(sku="", qty=0)], coupon=5), SKU),
    (
        json.dumps({"job_id": "j", "quotes": [{"items": [item()], "region": "IN"}, {"items": [], "region": "IN"}]}),
        ITEMS.replace("quotes[0]", "quotes[1]"),
    ),
    # accepted
    (json.dumps(VALID), None),
    (job(coupon=None), None),
    (job(coupon="y" * 32), None),
    (job(note="extra fields are ignored"), None),
    (job(items=[item(sku="\U0001f600" * 32)]), None),
    (job(items=[item()] * 100), None),
    (json.dumps({"job_id": "j", "quotes": [{"items": [item()], "region": "EU"}] * 50}), None),
    ('{"job_id": "a", "job_id": "b", "quotes": [{"items": [{"sku":"A","qty":1,"unit_price":"1"}], "region":"IN"}]}', None),
    *[
        (priced(t), None)
        for t in (
            '"1.990"', "19.99", "100000", '"100000.00"', '"1e2"', "1e2", '"+5"', '".5"', '"5."',
            '"0.01"', '"1.5E+1"', "0.1000000000000000055", '"00012.30"', '"1200e-2"',
        )
    ],
]


@pytest.fixture(scope="module")
def checked(spark):
    rows = [(i, f"k{i}", text) for i, (text, _) in enumerate(CASES)]
    frame = spark.createDataFrame(rows, "n int, key string, value string")
    frame = frame.withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))
    return parse.validated(frame).cache()


def test_every_case(checked):
    got = {r.n: r.error for r in checked.collect()}
    wrong = {CASES[n][0]: (error, CASES[n][1]) for n, error in got.items() if error != CASES[n][1]}
    assert not wrong


def test_events_of_a_valid_job(checked):
    number = next(i for i, (text, _) in enumerate(CASES) if text == json.dumps(VALID))
    (row,) = checked.filter(F.col("n") == number).collect()
    assert [tuple(e) for e in row.events] == [
        ("spring order", 0, "EU", 3, 4 * 1250 + 10 * 99 + 700, "FLAT50"),
        ("spring order", 1, "US", 1, 31005, None),
        ("spring order", 2, "IN", 1, 12 * 150, None),
    ]


def test_a_rejected_message_has_no_events(checked):
    assert checked.filter("error is not null and size(events) > 0").count() == 0


def test_largest_quote_does_not_overflow(spark):
    text = job(items=[item(qty=1000, unit_price="100000.00")] * 100)
    frame = spark.createDataFrame([("k", text)], "key string, value string")
    (row,) = parse.validated(frame).collect()
    assert row.events[0].gross_amount_cents == 1_000_000_000_000


def test_last_duplicate_key_wins(checked):
    number = next(i for i, (text, _) in enumerate(CASES) if text and '"job_id": "a"' in text)
    (row,) = checked.filter(F.col("n") == number).collect()
    assert row.events[0].job_id == "b"


def test_every_message_is_either_fanned_out_or_dead(checked):
    valid, dead = parse.split(checked)
    assert valid.count() + dead.count() == len(CASES)
    outcomes = fanout.outcomes(checked).groupBy("outcome").count().collect()
    counts = {r.outcome: r["count"] for r in outcomes}
    assert counts["dead_letter"] == dead.count()
    assert counts["request"] == fanout.quote_events(checked).count()


def test_dead_letter_keeps_payload_and_reason(checked):
    dead = fanout.dead_letters(checked).filter(F.col("key") == "k1")
    (row,) = dead.select("*", fanout.header_text("dlq.error").alias("why")).collect()
    assert row.value == CASES[1][0]
    assert row.why == "malformed JSON"
    assert [h.key for h in row.headers] == ["dlq.error", "dlq.source.topic"]
    assert bytes(row.headers[1].value) == b"quote-jobs"


def test_events_of_one_row_group_are_parsed_by_many_tasks(spark, tmp_path):
    made = spark.range(50).selectExpr(
        "id as event_id", "id % 7 as user_id", "'view' as event_type", "id + 0.5D as value",
        """'{"k": 3}' as props""", "timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, id) as ts",
    )
    made.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    before = spark.conf.get(session.SPREAD)
    spark.conf.unset(session.SPREAD)
    try:
        events = inputs.events(spark, str(tmp_path))
        assert events.rdd.getNumPartitions() == 3 * spark.sparkContext.defaultParallelism
        assert sorted(r.e for r in events.collect()) == list(range(50))
    finally:
        spark.conf.set(session.SPREAD, before)
    assert session.tasks(spark, 1 << 40) == int(before)
