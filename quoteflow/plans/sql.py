"""The inputs of ``plans/inputs.py`` as SQL over the flat tables, for checking results in DuckDB.

The SQL never sees the JSON text: it works out from the arithmetic of the inputs which rule each
message breaks, so it checks the parsing and not only the counting.
"""

from __future__ import annotations

SRC = """
src AS (
  SELECT event_id AS e, user_id AS u, event_type AS t, CAST(value AS DECIMAL(10,2)) AS p,
         CAST(props->>'$.k' AS INTEGER) AS k, ts, event_id % 97 AS c
  FROM events
),
job AS (
  SELECT *, CASE WHEN c = 8 THEN 51 ELSE e % 3 + 1 END AS nq FROM src
),
quote AS (
  SELECT *,
    CASE WHEN c = 12 AND i = 0 THEN 101 WHEN c = 11 AND i = nq - 1 THEN 0 WHEN c = 29 AND i = 0 THEN 0
         ELSE (e // 3 + i) % 3 + 1 END AS ni,
    CASE WHEN c = 10 AND i = 0 THEN 'in' WHEN c = 29 AND i = 0 THEN 'XX'
         WHEN (u + i) % 16 < 5 THEN 'IN' WHEN (u + i) % 16 < 10 THEN 'US'
         WHEN (u + i) % 16 < 15 THEN 'EU' ELSE 'UK' END AS region,
    CASE (e + i) % 6 WHEN 0 THEN 'SAVE10' WHEN 1 THEN ' save10 ' WHEN 2 THEN 'FLAT50'
         WHEN 3 THEN 'BOGUS' END AS coupon
  FROM (SELECT *, unnest(range(nq)) AS i FROM job)
),
item AS (
  SELECT *, i = nq - 1 AND j = 0 AS target,
    t || '-' || j AS sku,
    CASE WHEN i = nq - 1 AND j = 0 AND c = 18 THEN 3
         WHEN i = nq - 1 AND j = 0 AND c = 28 THEN 1
         ELSE (k + i + j) % 5 + 1 END AS qty,
    CASE WHEN i = nq - 1 AND j = 0 AND c = 26 THEN CAST(1.99 AS DECIMAL(10,2))
         WHEN i = nq - 1 AND j = 0 AND c = 27 THEN CAST(150.00 AS DECIMAL(10,2))
         ELSE CAST(p + j * 10 AS DECIMAL(10,2)) END AS price
  FROM (SELECT *, unnest(range(ni)) AS j FROM quote)
)"""

_PRICE_TEXT = ".unit_price must be > 0 and <= 100000 with at most 2 decimals"

# First failing check per message, in the order item < quote < message.
CHECKED = (
    SRC
    + f""",
item_error AS (
  SELECT e, i, j, 'quotes[' || i || '].items[' || j || ']' ||
    CASE WHEN target AND c = 13 THEN ' is not an object'
         WHEN target AND c IN (14, 15) THEN '.sku must be 1-64 characters'
         WHEN target AND c IN (16, 17, 18, 19, 28) THEN '.qty must be an integer from 1 to 1000'
         WHEN (target AND c IN (20, 21, 22)) OR price <= 0 THEN '{_PRICE_TEXT}' END AS err
  FROM item
),
first_item_error AS (
  SELECT e, i, arg_min(err, j) AS err FROM item_error WHERE err IS NOT NULL GROUP BY e, i
),
quote_error AS (
  SELECT q.e, q.i,
    CASE WHEN q.c = 9 AND q.i = q.nq - 1 THEN 'quotes[' || q.i || '] is not an object'
         WHEN q.region NOT IN ('IN', 'US', 'EU') THEN 'quotes[' || q.i || '].region must be IN, US or EU'
         WHEN q.ni NOT BETWEEN 1 AND 100 THEN 'quotes[' || q.i || '].items must be a list of 1-100 items'
         WHEN f.err IS NOT NULL THEN f.err
         WHEN q.c IN (23, 24) AND q.i = 0
           THEN 'quotes[' || q.i || '].coupon must be a string of at most 32 characters' END AS err
  FROM quote q LEFT JOIN first_item_error f ON f.e = q.e AND f.i = q.i
),
first_quote_error AS (
  SELECT e, arg_min(err, i) AS err FROM quote_error WHERE err IS NOT NULL GROUP BY e
),
checked AS (
  SELECT job.*, 'job-' || job.e AS job_id,
    CASE WHEN c = 0 THEN 'empty message' WHEN c = 1 THEN 'malformed JSON'
         WHEN c IN (2, 30) THEN 'message is not a JSON object'
         WHEN c IN (3, 4, 5) THEN 'missing job_id'
         WHEN c IN (6, 7, 8) THEN 'quotes must be a list of 1-50 requests'
         ELSE f.err END AS error
  FROM job LEFT JOIN first_quote_error f ON f.e = job.e
),
quote_event AS (
  SELECT c.job_id, CAST(q.i AS INTEGER) AS position, q.region, CAST(q.ni AS INTEGER) AS item_count,
         g.cents AS gross_amount_cents, q.coupon, q.ts, q.e
  FROM checked c JOIN quote q ON q.e = c.e
  JOIN (SELECT e, i, CAST(sum(CAST(price * 100 AS BIGINT) * qty) AS BIGINT) AS cents
        FROM item GROUP BY e, i) g ON g.e = q.e AND g.i = q.i
  WHERE c.error IS NULL
)"""
)


def with_inputs(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select.strip()}"


# From ``base`` (any columns plus region, coupon, subtotal) to ``totals``.
TOTALS = """
rules(region, currency, rate, fee, free_from) AS (
  VALUES ('IN', 'INR', CAST(0.18 AS DECIMAL(5,4)), CAST(49 AS DECIMAL(13,2)), CAST(999 AS DECIMAL(13,2))),
         ('US', 'USD', 0.0825, 15, 100), ('EU', 'EUR', 0.20, 12, 90)
),
coded AS (SELECT *, upper(trim(coalesce(coupon, ''))) AS code FROM base),
discounted AS (
  SELECT *, CAST(CASE WHEN code = 'SAVE10' THEN least(round(subtotal * CAST(0.10 AS DECIMAL(3,2)), 2), 500)
                      WHEN code = 'FLAT50' AND subtotal >= 500 THEN 50 ELSE 0 END AS DECIMAL(13,2)) AS discount
  FROM coded
),
taxed AS (
  SELECT d.*, r.currency, CAST(round((subtotal - discount) * r.rate, 2) AS DECIMAL(13,2)) AS tax,
    CAST(CASE WHEN subtotal - discount >= r.free_from THEN 0 ELSE r.fee END AS DECIMAL(13,2)) AS shipping
  FROM discounted d JOIN rules r ON r.region = d.region
),
totals AS (
  SELECT *, CAST(subtotal - discount + tax + shipping AS DECIMAL(13,2)) AS total FROM taxed
)"""

# Valid jobs by the request contract, which accepts "3" and 1.0 as integers (slots 18 and 28).
CONTRACT_VALID = (
    SRC
    + """,
bad_item AS (
  SELECT DISTINCT e FROM item
  WHERE (target AND c IN (13, 14, 15, 16, 17, 19, 20, 21, 22)) OR price <= 0
),
bad_quote AS (
  SELECT DISTINCT e FROM quote
  WHERE region NOT IN ('IN', 'US', 'EU') OR ni NOT BETWEEN 1 AND 100
     OR (c = 9 AND i = nq - 1) OR (c IN (23, 24) AND i = 0)
),
readable AS (SELECT *, 'job-' || e AS job_id FROM job WHERE c NOT IN (0, 1, 2, 3, 4, 5, 30)),
valid_job AS (
  SELECT * FROM readable WHERE c NOT IN (6, 7, 8)
    AND e NOT IN (SELECT e FROM bad_item) AND e NOT IN (SELECT e FROM bad_quote)
),
hashed AS (
  SELECT v.e, v.ts, v.job_id, CAST(q.i AS INTEGER) AS position, q.region, q.coupon,
    sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode('quote-job:' || v.job_id || ':' || q.i)) AS h
  FROM valid_job v JOIN quote q ON q.e = v.e
),
base AS (
  SELECT hashed.*, substr(h, 1, 12) || '5' || substr(h, 14, 3) ||
      translate(substr(h, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr(h, 18, 15) AS id,
    s.subtotal
  FROM hashed JOIN (SELECT e, i, CAST(sum(round(price * qty, 2)) AS DECIMAL(13,2)) AS subtotal
                    FROM item GROUP BY e, i) s ON s.e = hashed.e AND s.i = hashed.position
)"""
)

PRICED = CONTRACT_VALID + "," + TOTALS + ", priced AS (SELECT * FROM totals)"
