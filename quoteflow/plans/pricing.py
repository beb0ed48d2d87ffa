"""Queries of the pricing path: priced quotes, order pricing, quote ids, coupon sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quoteflow import rules
from quoteflow.functions import decimals, ids
from quoteflow.operators import contract, fanout, jobs, pricing
from quoteflow.plans import inputs, sql

_AMOUNTS = ["subtotal", "discount", "tax", "shipping", "total"]


def checked_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.check_messages(inputs.job_messages(spark, sf_dir))


def priced(spark: SparkSession, sf_dir: str) -> DataFrame:
    quotes, _ = jobs.run(checked_messages(spark, sf_dir))
    return quotes


def price_event_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return priced(spark, sf_dir).select(
        "job_id",
        "position",
        "id",
        "region",
        "currency",
        "coupon",
        *[decimals.money_text(F.col(name)).alias(name) for name in _AMOUNTS],
        "created_at",
    )


def quote_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fanout.line_rows(priced(spark, sf_dir), ["id"])
    return rows.select(
        "id",
        "line",
        "sku",
        "qty",
        F.col("unit_price").cast("string").alias("unit_price"),
        F.col("line_total").cast("string").alias("line_total"),
    )


def priced_totals_by_region_coupon(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = priced(spark, sf_dir).withColumn("code", pricing.coupon_code(F.col("coupon")))
    return rows.groupBy("region", "currency", "code").agg(
        F.count(F.lit(1)).alias("quotes"),
        *[decimals.money_text(F.sum(name)).alias(name) for name in _AMOUNTS],
    )


def price_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = pricing.line_total(F.col("unit_price"), F.col("qty"))
    return inputs.order_lines(spark, sf_dir).select(
        "order_id",
        "line",
        "part",
        "qty",
        F.col("unit_price").cast("string").alias("unit_price"),
        total.cast("string").alias("line_total"),
    )


def _order_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    subtotals = pricing.price_lines(inputs.order_lines(spark, sf_dir), "order_id").filter("reject is null")
    headers = inputs.order_headers(spark, sf_dir).filter(F.col("region").isin("IN", "US", "EU"))
    return pricing.totals(subtotals.join(headers, "order_id"))


def price_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders priced as one quote each. Orders without lines, with a line over the price limit, or
    from a region without prices are invalid and left out."""
    return _order_quotes(spark, sf_dir).select(
        "order_id",
        "region",
        "currency",
        "lines",
        *[decimals.money_text(F.col(name)).alias(name) for name in _AMOUNTS],
    )


def order_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that are not priced, and why; with ``price_orders`` they are all orders."""
    lines = pricing.price_lines(inputs.order_lines(spark, sf_dir), "order_id")
    headers = inputs.order_headers(spark, sf_dir)
    rows = headers.join(lines, "order_id", "left")
    reason = F.coalesce(
        F.when(~F.col("region").isin("IN", "US", "EU"), rules.REGION_WITHOUT_PRICES),
        F.when(F.col("lines").isNull(), rules.NO_ITEMS),
        F.col("reject"),
    )
    return rows.select("order_id", "region", reason.alias("reason")).filter("reason is not null")


def order_market_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priced order totals per region and coupon code."""
    quotes = _order_quotes(spark, sf_dir)
    quotes = quotes.withColumn("code", pricing.coupon_code(F.col("coupon")))
    return quotes.groupBy("region", "code").agg(
        F.count(F.lit(1)).alias("orders"),
        *[decimals.money_text(F.sum(name)).alias(name) for name in _AMOUNTS],
    )


def derived_quote_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    job_id = F.concat(F.lit("cust-"), F.col("o_custkey"))
    return orders.select(
        "o_orderkey", ids.derived(job_id, F.col("o_orderkey")).alias("quote_id")
    )


QUERIES = {
    "price_event_quotes": price_event_quotes,
    "quote_lines": quote_lines,
    "priced_totals_by_region_coupon": priced_totals_by_region_coupon,
    "price_order_lines": price_order_lines,
    "price_orders": price_orders,
    "order_rejects": order_rejects,
    "order_market_totals": order_market_totals,
    "derived_quote_ids": derived_quote_ids,
}


_HEADERS = """
header AS (
  SELECT o_orderkey AS order_id,
    CASE r_name WHEN 'ASIA' THEN 'IN' WHEN 'AMERICA' THEN 'US' WHEN 'EUROPE' THEN 'EU' ELSE r_name END AS region,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'SAVE10' WHEN '2' THEN ' save10 '
         WHEN '3' THEN 'FLAT50' WHEN '4' THEN 'BOGUS' END AS coupon
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
line AS (
  SELECT l_orderkey AS order_id, CAST(l_quantity AS INTEGER) AS qty,
         CAST(l_extendedprice AS DECIMAL(10,2)) AS unit_price
  FROM lineitem
)"""

_PRICED_ORDERS = _HEADERS + """,
valid AS (
  SELECT order_id, count(*) AS lines, CAST(sum(round(unit_price * qty, 2)) AS DECIMAL(13,2)) AS subtotal
  FROM line GROUP BY order_id
  HAVING count(*) <= 100 AND count(*) FILTER
    (WHERE unit_price NOT BETWEEN 0.01 AND 100000 OR qty NOT BETWEEN 1 AND 1000) = 0
),
base AS (
  SELECT valid.*, region, coupon FROM valid JOIN header USING (order_id)
  WHERE region IN ('IN', 'US', 'EU')
),
""" + sql.TOTALS

ORACLE = {
    "price_event_quotes": sql.with_inputs(
        sql.PRICED,
        """SELECT job_id, position, id, region, currency, coupon,
             CAST(subtotal AS VARCHAR) AS subtotal, CAST(discount AS VARCHAR) AS discount,
             CAST(tax AS VARCHAR) AS tax, CAST(shipping AS VARCHAR) AS shipping,
             CAST(total AS VARCHAR) AS total, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS created_at
           FROM priced""",
    ),
    "quote_lines": sql.with_inputs(
        sql.PRICED,
        """SELECT p.id, CAST(i.j AS INTEGER) AS line, i.sku, CAST(i.qty AS INTEGER) AS qty,
             CAST(i.price AS VARCHAR) AS unit_price,
             CAST(CAST(round(i.price * i.qty, 2) AS DECIMAL(11,2)) AS VARCHAR) AS line_total
           FROM priced p JOIN item i ON i.e = p.e AND i.i = p.position""",
    ),
    "priced_totals_by_region_coupon": sql.with_inputs(
        sql.PRICED,
        """SELECT region, currency, code, count(*) AS quotes,
             CAST(sum(subtotal) AS VARCHAR) AS subtotal, CAST(sum(discount) AS VARCHAR) AS discount,
             CAST(sum(tax) AS VARCHAR) AS tax, CAST(sum(shipping) AS VARCHAR) AS shipping,
             CAST(sum(total) AS VARCHAR) AS total
           FROM priced GROUP BY region, currency, code""",
    ),
    "price_order_lines": """
        SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS part,
          CAST(l_quantity AS INTEGER) AS qty,
          CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS VARCHAR) AS unit_price,
          CAST(CAST(round(CAST(l_extendedprice AS DECIMAL(10,2)) * CAST(l_quantity AS INTEGER), 2)
               AS DECIMAL(11,2)) AS VARCHAR) AS line_total
        FROM lineitem""",
    "price_orders": sql.with_inputs(
        _PRICED_ORDERS,
        """SELECT order_id, region, currency, lines, CAST(subtotal AS VARCHAR) AS subtotal,
             CAST(discount AS VARCHAR) AS discount, CAST(tax AS VARCHAR) AS tax,
             CAST(shipping AS VARCHAR) AS shipping, CAST(total AS VARCHAR) AS total
           FROM totals""",
    ),
    "order_rejects": "WITH " + _HEADERS + """,
per_order AS (
  SELECT order_id, count(*) AS lines, count(*) FILTER
    (WHERE unit_price NOT BETWEEN 0.01 AND 100000 OR qty NOT BETWEEN 1 AND 1000) AS bad FROM line GROUP BY order_id
)
SELECT * FROM (
  SELECT order_id, region, CASE WHEN region NOT IN ('IN', 'US', 'EU') THEN 'region without prices'
    WHEN lines IS NULL THEN 'no items' WHEN lines > 100 THEN 'more than 100 items'
    WHEN bad > 0 THEN 'item out of range' END AS reason
  FROM header LEFT JOIN per_order USING (order_id)) WHERE reason IS NOT NULL""",
    "order_market_totals": sql.with_inputs(
        _PRICED_ORDERS,
        """SELECT region, code, count(*) AS orders, CAST(sum(subtotal) AS VARCHAR) AS subtotal,
             CAST(sum(discount) AS VARCHAR) AS discount, CAST(sum(tax) AS VARCHAR) AS tax,
             CAST(sum(shipping) AS VARCHAR) AS shipping, CAST(sum(total) AS VARCHAR) AS total
           FROM totals GROUP BY region, code""",
    ),
    "derived_quote_ids": """
        WITH hashed AS (
          SELECT o_orderkey, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') ||
            encode('quote-job:cust-' || o_custkey || ':' || o_orderkey)) AS h FROM orders)
        SELECT o_orderkey, substr(h, 1, 12) || '5' || substr(h, 14, 3) ||
          translate(substr(h, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr(h, 18, 15) AS quote_id
        FROM hashed""",
}
