"""Pricing rules with worked examples, and ids."""

import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quoteflow.functions import decimals, ids
from quoteflow.operators import pricing

# region, items (qty, price), coupon, expected amounts (only the ones given are checked)
# Published examples of the pricing rules that have to hold as they are.
PUBLISHED = [
    ("IN", [(2, "199.99")], None, dict(subtotal="399.98", discount="0.00", tax="72.00", shipping="49.00", total="520.98", currency="INR")),
    ("IN", [(1, "0.25")], None, dict(tax="0.05")),
    ("US", [(1, "0.10")], None, dict(tax="0.01")),
    ("IN", [(1, "1000.00")], "SAVE10", dict(discount="100.00")),
    ("IN", [(1, "1000.00")], "save10", dict(discount="100.00")),
    ("IN", [(1, "1000.00")], " \t Save10  ", dict(discount="100.00")),
    ("IN", [(1, "1000.00")], "FLAT50", dict(discount="50.00")),
    ("IN", [(1, "1000.00")], "NOPE", dict(discount="0.00")),
    ("IN", [(1, "1000.00")], None, dict(discount="0.00")),
    ("IN", [(10, "999.00")], "SAVE10", dict(discount="500.00")),
    ("US", [(1, "105.00")], "SAVE10", dict(shipping="15.00")),
    ("US", [(1, "5")], None, dict(subtotal="5.00")),
    ("US", [(1, "100.00")], None, dict(shipping="0.00", currency="USD")),
    ("US", [(1, "99.99")], None, dict(shipping="15.00")),
    ("EU", [(3, "12.35"), (1, "0.01"), (7, "4.99")], None, dict(subtotal="71.99", tax="14.40", shipping="12.00", total="98.39", currency="EUR")),
    ("IN", [(4, "250.00")], "SAVE10", dict(discount="100.00", tax="162.00", shipping="49.00", total="1111.00")),
    ("EU", [(1, "499.99")], "FLAT50", dict(discount="0.00")),
    ("EU", [(1, "500.00")], "FLAT50", dict(discount="50.00", tax="90.00", shipping="0.00", total="540.00")),
    ("US", [(1, "10.00")], "BOGUS", dict(discount="0.00")),
    ("US", [(3, "0.35")], None, dict(subtotal="1.05", tax="0.09")),
]

# Own examples of every rule, worked out by hand.
OWN = [
    ("EU", [(4, "12.50"), (10, "0.99")], None, dict(subtotal="59.90", tax="11.98", shipping="12.00", total="83.88")),
    ("EU", [(1, "90.00")], None, dict(tax="18.00", shipping="0.00", total="108.00")),
    ("EU", [(1, "99.99")], "SAVE10", dict(discount="10.00", tax="18.00", shipping="12.00", total="119.99")),
    ("US", [(1, "310.05")], None, dict(tax="25.58", shipping="0.00", total="335.63")),
    ("US", [(7, "71.50")], "FLAT50", dict(subtotal="500.50", discount="50.00", tax="37.17", total="487.67")),
    ("IN", [(12, "1.50")], "FLAT50", dict(discount="0.00", tax="3.24", shipping="49.00", total="70.24")),
    ("IN", [(3, "333.33")], None, dict(subtotal="999.99", tax="180.00", shipping="0.00", total="1179.99")),
    ("IN", [(1, "5000.10")], "SAVE10", dict(discount="500.00", tax="810.02", total="5310.12")),
]
EXAMPLES = PUBLISHED + OWN


@pytest.fixture(scope="module")
def priced(spark):
    rows = [
        (str(n), region, coupon, [("A", qty, Decimal(price)) for qty, price in items])
        for n, (region, items, coupon, _) in enumerate(EXAMPLES)
    ]
    schema = "quote_id string, region string, coupon string, items array<struct<sku string, qty int, unit_price decimal(8,2)>>"
    frame = spark.createDataFrame(rows, schema)
    ts = F.lit("2024-05-01 10:00:00.987").cast("timestamp")
    return pricing.price(frame.withColumn("ts", ts)).cache()


def test_examples(priced):
    for row in priced.collect():
        for name, expected in EXAMPLES[int(row.id)][3].items():
            assert str(row[name]) == expected, (EXAMPLES[int(row.id)], name)


def test_total_is_the_sum_of_its_parts(priced):
    whole = F.col("subtotal") - F.col("discount") + F.col("tax") + F.col("shipping")
    assert priced.filter(F.col("total") != whole).count() == 0


def test_creation_time_and_coupon_text_are_kept(priced):
    row = priced.filter("id = '4'").collect()[0]
    assert row.created_at == "2024-05-01T10:00:00Z"
    assert row.coupon == "save10"


def test_lines_keep_their_order(priced):
    row = priced.filter("id = '14'").collect()[0]
    assert [str(i.line_total) for i in row.line_items] == ["37.05", "0.01", "34.93"]


def test_flat_rows_price_like_nested_ones(spark, priced):
    flat = priced.select("id", F.explode("line_items").alias("i")).select("id", "i.*")
    sums = pricing.price_lines(flat, "id")
    joined = sums.join(priced.select("id", F.col("subtotal").alias("expected")), "id")
    assert joined.filter("subtotal <> expected or reject is not null").count() == 0


def test_derived_ids_are_name_based_uuids(spark):
    names = [(f"job-{n}é", n % 50) for n in range(200)]
    frame = spark.createDataFrame(names, "job string, n int")
    rows = frame.select("job", "n", ids.derived(F.col("job"), F.col("n")).alias("id")).collect()
    for row in rows:
        assert row.id == uuid.uuid5(uuid.NAMESPACE_URL, f"quote-job:{row.job}:{row.n}").hex


def test_fresh_ids_are_random_uuids(spark):
    rows = spark.range(50).select(ids.fresh().alias("id")).collect()
    assert len({r.id for r in rows}) == 50
    assert all(len(r.id) == 32 and uuid.UUID(r.id).version == 4 for r in rows)


def test_decimal_texts_are_exact(spark):
    texts = ["19.99", "1.990", "1e2", "1E-3", "1.0000000000000000001", "0.1e1", "+5", "5.", ".5", "-3", "12345e-2", "x", "", "1e", "٣"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.m for r in frame.select("t", decimals.money(F.col("t")).alias("m")).collect()}
    for text in texts:
        try:
            value = Decimal(text)
            expected = value if value == value.quantize(Decimal("0.01")) else None
        except Exception:
            expected = None
        assert got[text] == expected, text
