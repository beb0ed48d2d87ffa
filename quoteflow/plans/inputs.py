"""Inputs derived from the given tables: job messages, request bodies, carts, a request log.

Every message is a projection of one ``events`` row (no shuffle, no grouping), so the same functions
work on batch and streaming DataFrames and grow with the table. Poison of every kind is mixed in by
``event_id`` so that each rule has rows that break it. ``plans/sql.py`` states the same inputs as SQL.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quoteflow import session
from quoteflow.sinks.log import files

# Which slot of a poison cycle breaks which rule (event_id modulo the cycle length).
MESSAGE_CYCLE = 97
BODY_CYCLE = 61

# A list that is rejected by its length alone; what it holds does not matter.
_OVERLONG = "[%s{}]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return session.prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def size(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Bytes of a table's files."""
    return files(spark).size(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session.spread(carts(table(spark, sf_dir, "events")), size(spark, sf_dir, "events"))


def carts(raw: DataFrame) -> DataFrame:
    """Typed columns of the event rows under short names."""
    return raw.select(
        F.col("event_id").alias("e"),
        F.col("user_id").alias("u"),
        F.col("event_type").alias("t"),
        F.col("value").cast("decimal(10,2)").alias("p"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def _case(column: Column, *branches: tuple[Column | bool, str | Column]) -> Column:
    out = None
    for condition, value in branches:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out.otherwise(column)


def _quoted(text: Column) -> Column:
    return F.concat(F.lit('"'), text, F.lit('"'))


def _obj(*pairs: tuple[str, Column]) -> Column:
    members = []
    for name, value in pairs:
        members.append(F.concat(F.lit(f'"{name}": '), value))
    return F.concat(F.lit("{"), F.concat_ws(", ", *members), F.lit("}"))


def _list(values: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(values, ", "), F.lit("]"))


def _upto(n: Column) -> Column:
    return F.sequence(F.lit(0), n - F.lit(1))


def region_of(i: Column) -> Column:
    slot = (F.col("u") + i) % 16
    return F.when(slot < 5, "IN").when(slot < 10, "US").when(slot < 15, "EU").otherwise("UK")


def coupon_json(i: Column) -> Column:
    slot = (F.col("e") + i) % 6
    return (
        F.when(slot == 0, '"SAVE10"')
        .when(slot == 1, '" save10 "')
        .when(slot == 2, '"FLAT50"')
        .when(slot == 3, '"BOGUS"')
        .when(slot == 4, "null")
    )


def item_count(i: Column) -> Column:
    return (F.expr("e div 3") + i) % 3 + 1


def _item(i: Column, j: Column, c: Column, last: Column) -> Column:
    target = (i == last) & (j == 0)
    sku = _case(
        F.concat(F.col("t"), F.lit("-"), j.cast("string")),
        (target & (c == 14), ""),
        (target & (c == 15), "x" * 65),
    )
    qty = _case(
        ((F.col("k") + i + j) % 5 + 1).cast("string"),
        (target & (c == 16), "0"),
        (target & (c == 17), "1.5"),
        (target & (c == 18), '"3"'),
        (target & (c == 19), "1001"),
        (target & (c == 28), "1.0"),
    )
    plain = (F.col("p") + (j * 10).cast("decimal(10,2)")).cast("decimal(10,2)").cast("string")
    price = _case(
        F.when((F.col("e") + j) % 2 == 0, _quoted(plain)).otherwise(plain),
        (target & (c == 20), '"1.999"'),
        (target & (c == 21), "100000.01"),
        (target & (c == 22), '"abc"'),
        (target & (c == 26), '"1.990"'),
        (target & (c == 27), "1.5e2"),
    )
    item = _obj(("sku", _quoted(sku)), ("qty", qty), ("unit_price", price))
    return F.when(target & (c == 13), F.lit('"x"')).otherwise(item)


def _quote(i: Column, c: Column, last: Column) -> Column:
    items = _list(F.transform(_upto(item_count(i).cast("int")), lambda j: _item(i, j, c, last)))
    items = _case(
        items,
        ((c == 11) & (i == last), "[]"),
        ((c == 29) & (i == 0), "[]"),
        ((c == 12) & (i == 0), _OVERLONG % (100 * "{}, ")),
    )
    region = _case(region_of(i), ((c == 10) & (i == 0), "in"), ((c == 29) & (i == 0), "XX"))
    coupon = _case(
        coupon_json(i), ((c == 23) & (i == 0), '"' + "y" * 33 + '"'), ((c == 24) & (i == 0), "5")
    )
    quote = _obj(("items", items), ("region", _quoted(region)), ("coupon", coupon))
    return F.when((c == 9) & (i == last), F.lit("7")).otherwise(quote)


def messages(cart_rows: DataFrame) -> DataFrame:
    """One bulk-job message per cart, 1 to 3 quotes each: key, value, timestamp, topic, offset."""
    return cart_rows.select(
        F.concat(F.lit("job-"), F.col("e")).alias("key"),
        _message_text().alias("value"),
        "timestamp",
        F.lit("quote-jobs").alias("topic"),
        (F.col("e") % 3).cast("int").alias("partition"),
        F.col("e").alias("offset"),
    )


@cache
def _message_text() -> Column:
    c = F.col("e") % MESSAGE_CYCLE
    n = (F.col("e") % 3 + 1).cast("int")
    quotes = _list(F.transform(_upto(n), lambda i: _quote(i, c, n - 1)))
    quotes = _case(quotes, (c == 6, "[]"), (c == 7, "null"), (c == 8, _OVERLONG % (50 * "{}, ")))
    job_id = _case(_quoted(F.concat(F.lit("job-"), F.col("e"))), (c == 4, '"  "'), (c == 5, "12"))
    value = F.concat(
        F.lit("{"),
        F.when(c == 3, F.lit("")).otherwise(F.concat(F.lit('"job_id": '), job_id, F.lit(", "))),
        F.when(c == 25, F.lit('"priority": true, ')).otherwise(F.lit("")),
        F.lit('"quotes": '),
        quotes,
        F.lit("}"),
    )
    return _case(
        value,
        (c == 0, F.lit(None).cast("string")),
        (c == 1, F.substring(value, F.lit(1), F.length(value) - 1)),
        (c == 2, "[1, 2, 3]"),
        (c == 30, ""),
    )


def job_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages(events(spark, sf_dir))


def _slot(n: int) -> Column:
    return F.col("e") % BODY_CYCLE == n


def bodies(cart_rows: DataFrame) -> DataFrame:
    """One single-quote request body per cart: ``request_id``, ``body``; every rule is broken by some."""
    request_id = F.concat(F.lit("req-"), F.col("e")).alias("request_id")
    return cart_rows.select(request_id, _body_text().alias("body"), "timestamp")


@cache
def _body_text() -> Column:
    zero = F.lit(0)
    items = _list(F.transform(_upto(item_count(zero).cast("int")), _body_item))
    items = _case(items, (_slot(7), "[]"), (_slot(14), "3"), (_slot(37), _OVERLONG % (100 * "{}, ")))
    region = _case(region_of(zero), (_slot(6) | _slot(35), "UK"))
    coupon = _case(coupon_json(zero), (_slot(33), '"' + "y" * 33 + '"'), (_slot(34), "5"))
    members = F.concat_ws(
        ", ",
        F.when(~_slot(13), F.concat(F.lit('"items": '), items)),
        F.when(~_slot(5), F.concat(F.lit('"region": '), _quoted(region))),
        F.concat(F.lit('"coupon": '), coupon),
        F.when(_slot(12), F.lit('"priority": true')),
    )
    body = F.concat(F.lit("{"), members, F.lit("}"))
    return _case(
        body,
        (_slot(0), F.lit(None).cast("string")),
        (_slot(1), ""),
        (_slot(2), F.substring(body, F.lit(1), F.length(body) - 1)),
        (_slot(3), "[1, 2, 3]"),
        (_slot(4), "null"),
        (_slot(38), F.concat(body, F.lit(" {}"))),
    )


def _body_item(j: Column) -> Column:
    first = j == 0
    sku = _case(
        _quoted(F.concat(F.lit("sku-"), j.cast("string"))),
        (first & _slot(17), "9"),
        (first & _slot(18), '""'),
        (first & _slot(19), '"' + "x" * 65 + '"'),
    )
    qty = _case(
        ((F.col("k") + j) % 5 + 1).cast("string"),
        (first & (_slot(8) | _slot(35)), "0"),
        (first & _slot(9), '"two"'),
        (first & _slot(21), "true"),
        (first & _slot(22), '"3"'),
        (first & _slot(23), "3.0"),
        (first & _slot(24), "1.5"),
        (first & _slot(25), "1001"),
    )
    plain = (F.col("p") + (j * 10).cast("decimal(10,2)")).cast("decimal(10,2)").cast("string")
    price = _case(
        F.when((F.col("e") + j) % 2 == 0, _quoted(plain)).otherwise(plain),
        (first & _slot(10), '"-1"'),
        (first & _slot(11), '"1.999"'),
        (first & _slot(27), "true"),
        (first & _slot(28), '"abc"'),
        (first & _slot(29), "100000.01"),
        (first & _slot(30), '"1234567.00"'),
        (first & _slot(31), '"123456789"'),
        (first & _slot(32), '" 5 "'),
        (first & _slot(39), '"NaN"'),
        (first & _slot(40), '"1_0"'),
    )
    members = F.concat_ws(
        ", ",
        F.when(~(first & _slot(16)), F.concat(F.lit('"sku": '), sku)),
        F.when(~(first & _slot(20)), F.concat(F.lit('"qty": '), qty)),
        F.when(~(first & _slot(26)), F.concat(F.lit('"unit_price": '), price)),
        F.when(first & _slot(36), F.lit('"note": "x"')),
    )
    item = F.concat(F.lit("{"), members, F.lit("}"))
    return F.when(first & _slot(15), F.lit("8")).otherwise(item)


def quote_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bodies(events(spark, sf_dir))


def job_states(cart_rows: DataFrame) -> DataFrame:
    """Jobs already on record: every 7th is done, every 3rd of the others pending, the rest unknown."""
    e = F.col("e")
    status = F.when(e % 7 == 0, "done").when(e % 3 == 1, "pending")
    return cart_rows.select(
        F.concat(F.lit("job-"), e).alias("job_id"),
        status.alias("status"),
        (e % 3 + 1).cast("int").alias("total_requests"),
        F.array().cast("array<string>").alias("quote_ids"),
        F.lit(None).cast("string").alias("error"),
    ).filter("status is not null")


# What a second delivery adds to its message's offset.
AGAIN = 1000000000000


def redelivered(message_rows: DataFrame) -> DataFrame:
    """The messages with a second copy of every 10th, delivered later."""
    offset = F.col("offset")
    again = F.array(offset, offset + AGAIN)
    offsets = F.explode(F.when(offset % 10 == 0, again).otherwise(F.array(offset)))
    return message_rows.withColumn("_offset", offsets).withColumn("offset", F.col("_offset")).drop("_offset")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as priced items; a line over the price limit makes its order invalid."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part"),
        F.col("l_quantity").cast("int").alias("qty"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("unit_price"),
    )


def order_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One quote request per order: pricing region from the customer's nation, coupon from priority.

    How the sides are joined is left to the optimizer, which knows their sizes; hot customers are split
    by the adaptive skew join.
    """
    names = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    markets = nations.join(names, F.col("n_regionkey") == F.col("r_regionkey"))
    region = (
        F.when(F.col("r_name") == "ASIA", "IN")
        .when(F.col("r_name") == "AMERICA", "US")
        .when(F.col("r_name") == "EUROPE", "EU")
        .otherwise(F.col("r_name"))
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    customers = customers.join(markets, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", region.alias("region")
    )
    priority = F.substring("o_orderpriority", 1, 1)
    coupon = (
        F.when(priority == "1", "SAVE10")
        .when(priority == "2", " save10 ")
        .when(priority == "3", "FLAT50")
        .when(priority == "4", "BOGUS")
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), "o_custkey", coupon.alias("coupon")
    )
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        "order_id", "region", "coupon"
    )


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A gateway log derived from the events: one request per event."""
    raw = table(spark, sf_dir, "events")
    e, t = F.col("event_id"), F.col("event_type")
    return raw.select(
        e.alias("seq"),
        F.when(e % 50 != 49, F.concat(F.lit("req-"), e)).alias("request_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(e % 40 == 7, "")
        .when(e % 41 == 9, F.lit(None).cast("string"))
        .when(e % 5 == 0, "stable")
        .otherwise("canary")
        .alias("backend"),
        F.when((t == "error") & (e % 3 == 0), F.lit(None).cast("int"))
        .when(t == "error", 502)
        .when((t == "signup") & (e % 7 == 0), 404)
        .otherwise(201)
        .alias("status"),
        F.when(e % 53 != 5, F.col("value")).alias("latency_ms"),
        F.concat(F.lit("user-"), F.col("user_id")).alias("consumer"),
        F.when(e % 30 == 12, "key-stolen")
        .when(e % 30 != 11, F.concat(F.lit("key-"), F.col("user_id")))
        .alias("api_key"),
        F.when(e % 3 == 0, "quote-jobs").otherwise("quotes").alias("service"),
    )


def consumers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered consumers: every user but those whose number leaves 3 when divided by 17."""
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    return users.filter(F.col("user_id") % 17 != 3).select(
        F.concat(F.lit("key-"), F.col("user_id")).alias("api_key")
    )
