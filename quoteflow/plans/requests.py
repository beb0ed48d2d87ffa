"""Queries of the request contract: issues, outcomes, normalized messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quoteflow import rules, session
from quoteflow.operators import contract, jobs
from quoteflow.plans import inputs, pricing, sql
from quoteflow.sinks import tables
from quoteflow.sinks.tables import KeyedTable
from quoteflow.sources import tables as lookups


def contract_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = contract.check_quotes(inputs.quote_bodies(spark, sf_dir))
    return contract.issue_rows(checked, ["request_id"]).select(
        "request_id", "n", F.concat_ws(".", "loc").alias("loc"), "type", "msg", "ctx"
    )


def issues_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = contract.check_quotes(inputs.quote_bodies(spark, sf_dir))
    rows = contract.issue_rows(checked, ["request_id"])
    return rows.groupBy("type").agg(
        F.count(F.lit(1)).alias("issues"), F.count_distinct("request_id").alias("requests")
    )


def _job_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    quotes = inputs.quote_bodies(spark, sf_dir)
    body = F.concat(F.lit('{"quotes": ['), F.col("body"), F.lit("]}"))
    return quotes.withColumn("body", body)


def request_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of creating a quote, of submitting it as a bulk job, and of looking its id up."""
    number = F.substring("request_id", 5, 20).cast("bigint")
    created = contract.quote_outcome(contract.check_quotes(inputs.quote_bodies(spark, sf_dir)))
    submitted = contract.job_outcome(
        contract.check_jobs(_job_bodies(spark, sf_dir)), enqueued=number % 13 != 0
    )
    answered = created.select(F.lit("create").alias("request"), "request_id", "status", "detail")
    answered = answered.unionByName(
        submitted.select(F.lit("submit").alias("request"), "request_id", "status", "detail")
    )
    texts_ = F.when(F.col("status") == 422, "issues").otherwise(F.col("detail"))
    return answered.select("request", "request_id", "status", texts_.alias("detail"))


def lookup_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Look up the first quote of every job in the stored quotes; jobs that were never priced give 404."""
    priced = tables.with_expiry(pricing.priced(spark, sf_dir).select("id", "total"), F.current_timestamp())
    stored = KeyedTable(spark, session.scratch_path(spark, "quotes"), priced.schema, ["id"]).create()
    stored.upsert(priced, 0)
    wanted = inputs.events(spark, sf_dir).select(
        F.concat(F.lit("job-"), F.col("e")).alias("job_id")
    )
    wanted = wanted.withColumn("id", jobs.ids.derived(F.col("job_id"), F.lit(0)))
    found = contract.lookup_outcome(lookups.lookup_stored(wanted, stored, F.current_timestamp()))
    return found.select("job_id", "id", "status", "detail", F.col("total").cast("string").alias("total"))


def lookup_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Look up every job; those that are not on record give 404."""
    rows = inputs.events(spark, sf_dir)
    asked = rows.select(F.concat(F.lit("job-"), F.col("e")).alias("job_id"))
    states = inputs.job_states(rows).select("job_id", F.col("status").alias("job_status"))
    found = contract.lookup_outcome(lookups.lookup(asked, states, "job_id"), rules.JOB_NOT_FOUND)
    return found.select("job_id", "status", "detail", "job_status")


def normalized_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = pricing.checked_messages(spark, sf_dir).filter(
        F.col("job_id").isNotNull() & F.col("quotes").isNotNull()
    )
    return valid.select(
        "job_id", contract.normalized(F.col("quotes"), F.col("job_id")).alias("message")
    )


QUERIES = {
    "contract_issues": contract_issues,
    "issues_by_type": issues_by_type,
    "request_outcomes": request_outcomes,
    "lookup_quotes": lookup_quotes,
    "lookup_jobs": lookup_jobs,
    "normalized_messages": normalized_messages,
}

_ISSUES = """
body AS (
  SELECT event_id AS e, user_id AS u, CAST(value AS DECIMAL(10,2)) AS p, event_id % 61 AS s,
         event_id % 61 NOT IN (0, 1, 2, 3, 4, 38) AS opened,
         event_id % 61 NOT IN (0, 1, 2, 3, 4, 38, 7, 13, 14, 37) AS lines_read
  FROM events
),
found AS (
  SELECT e, 0 AS ord, 'body' AS loc, CASE WHEN s IN (0, 1, 4) THEN 'missing' WHEN s IN (2, 38)
    THEN 'json_invalid' ELSE 'model_attributes_type' END AS type FROM body WHERE s IN (0, 1, 2, 3, 4, 38)
  UNION ALL SELECT e, 1, 'body.items', CASE s WHEN 13 THEN 'missing' WHEN 14 THEN 'list_type'
    WHEN 37 THEN 'too_long' ELSE 'too_short' END FROM body WHERE s IN (7, 13, 14, 37)
  UNION ALL SELECT e, 2, 'body.items.0', 'model_attributes_type' FROM body WHERE s = 15
  UNION ALL SELECT e, 3, 'body.items.0.sku', CASE s WHEN 16 THEN 'missing' WHEN 17 THEN 'string_type'
    WHEN 18 THEN 'string_too_short' ELSE 'string_too_long' END FROM body WHERE s IN (16, 17, 18, 19)
  UNION ALL SELECT e, 4, 'body.items.0.qty', CASE s WHEN 20 THEN 'missing' WHEN 9 THEN 'int_parsing'
    WHEN 24 THEN 'int_from_float' WHEN 25 THEN 'less_than_equal' ELSE 'greater_than_equal' END
    FROM body WHERE s IN (20, 9, 24, 25, 8, 35)
  UNION ALL SELECT e, 5, 'body.items.0.unit_price', CASE s WHEN 26 THEN 'missing' WHEN 27 THEN 'decimal_type'
    WHEN 39 THEN 'finite_number' WHEN 28 THEN 'decimal_parsing' WHEN 31 THEN 'decimal_max_digits'
    WHEN 30 THEN 'decimal_whole_digits' WHEN 11 THEN 'decimal_max_places' WHEN 29 THEN 'less_than_equal'
    ELSE 'greater_than' END
    FROM body WHERE s IN (26, 27, 39, 28, 31, 30, 11, 29, 10)
       OR (lines_read AND p <= 0 AND s NOT IN (15, 32, 40))
  UNION ALL SELECT e, 6, 'body.items.0.note', 'extra_forbidden' FROM body WHERE s = 36
  UNION ALL SELECT e, 7, 'body.region', CASE WHEN s = 5 THEN 'missing' ELSE 'enum' END
    FROM body WHERE s = 5 OR (opened AND (s IN (6, 35) OR u % 16 = 15))
  UNION ALL SELECT e, 8, 'body.coupon', CASE s WHEN 33 THEN 'string_too_long' ELSE 'string_type' END
    FROM body WHERE s IN (33, 34)
  UNION ALL SELECT e, 9, 'body.priority', 'extra_forbidden' FROM body WHERE s = 12
),
issue AS (
  SELECT e, CAST(row_number() OVER (PARTITION BY e ORDER BY ord) - 1 AS INTEGER) AS n, loc, type,
    CASE type WHEN 'missing' THEN 'Field required' WHEN 'json_invalid' THEN 'JSON decode error'
      WHEN 'model_attributes_type' THEN 'Input should be a valid dictionary or object to extract fields from'
      WHEN 'list_type' THEN 'Input should be a valid list'
      WHEN 'too_long' THEN 'List should have at most 100 items after validation, not 101'
      WHEN 'too_short' THEN 'List should have at least 1 item after validation, not 0'
      WHEN 'string_type' THEN 'Input should be a valid string'
      WHEN 'string_too_short' THEN 'String should have at least 1 character'
      WHEN 'string_too_long' THEN 'String should have at most ' || CASE ord WHEN 3 THEN 64 ELSE 32 END || ' characters'
      WHEN 'int_parsing' THEN 'Input should be a valid integer, unable to parse string as an integer'
      WHEN 'int_from_float' THEN 'Input should be a valid integer, got a number with a fractional part'
      WHEN 'less_than_equal' THEN 'Input should be less than or equal to ' || CASE ord WHEN 4 THEN 1000 ELSE 100000 END
      WHEN 'greater_than_equal' THEN 'Input should be greater than or equal to 1'
      WHEN 'decimal_type' THEN 'Decimal input should be an integer, float, string or Decimal object'
      WHEN 'finite_number' THEN 'Input should be a finite number'
      WHEN 'decimal_parsing' THEN 'Input should be a valid decimal'
      WHEN 'decimal_max_digits' THEN 'Decimal input should have no more than 8 digits in total'
      WHEN 'decimal_whole_digits' THEN 'Decimal input should have no more than 6 digits before the decimal point'
      WHEN 'decimal_max_places' THEN 'Decimal input should have no more than 2 decimal places'
      WHEN 'greater_than' THEN 'Input should be greater than 0'
      WHEN 'extra_forbidden' THEN 'Extra inputs are not permitted'
      WHEN 'enum' THEN 'Input should be ''IN'', ''US'' or ''EU''' END AS msg,
    CASE type WHEN 'too_long' THEN '{"field_type":"List","max_length":100,"actual_length":101}'
      WHEN 'too_short' THEN '{"field_type":"List","min_length":1,"actual_length":0}'
      WHEN 'string_too_short' THEN '{"min_length":1}'
      WHEN 'string_too_long' THEN '{"max_length":' || CASE ord WHEN 3 THEN 64 ELSE 32 END || '}'
      WHEN 'less_than_equal' THEN '{"le":' || CASE ord WHEN 4 THEN 1000 ELSE 100000 END || '}'
      WHEN 'greater_than_equal' THEN '{"ge":1}' WHEN 'greater_than' THEN '{"gt":0}'
      WHEN 'decimal_max_digits' THEN '{"max_digits":8}' WHEN 'decimal_whole_digits' THEN '{"whole_digits":6}'
      WHEN 'decimal_max_places' THEN '{"decimal_places":2}'
      WHEN 'enum' THEN '{"expected":"''IN'', ''US'' or ''EU''"}' END AS ctx
  FROM found
)"""

ORACLE = {
    "contract_issues": sql.with_inputs(
        _ISSUES, "SELECT 'req-' || e AS request_id, n, loc, type, msg, ctx FROM issue"
    ),
    "issues_by_type": sql.with_inputs(
        _ISSUES,
        "SELECT type, count(*) AS issues, count(DISTINCT e) AS requests FROM issue GROUP BY type",
    ),
    "request_outcomes": sql.with_inputs(
        _ISSUES + ", verdict AS (SELECT e, e IN (SELECT e FROM issue) AS bad FROM body)",
        """SELECT 'create' AS request, 'req-' || e AS request_id, CASE WHEN bad THEN 422 ELSE 201 END AS status,
             CASE WHEN bad THEN 'issues' END AS detail FROM verdict
           UNION ALL
           SELECT 'submit', 'req-' || e, CASE WHEN bad THEN 422 WHEN e % 13 <> 0 THEN 202 ELSE 503 END,
             CASE WHEN bad THEN 'issues' WHEN e % 13 = 0 THEN 'Job queue unavailable' END FROM verdict""",
    ),
    "lookup_quotes": sql.with_inputs(
        sql.PRICED
        + """,
asked AS (
  SELECT 'job-' || event_id AS job_id,
    sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode('quote-job:job-' || event_id || ':0')) AS h
  FROM events
)""",
        """SELECT a.job_id, substr(a.h, 1, 12) || '5' || substr(a.h, 14, 3) ||
             translate(substr(a.h, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr(a.h, 18, 15) AS id,
             CASE WHEN p.id IS NULL THEN 404 ELSE 200 END AS status,
             CASE WHEN p.id IS NULL THEN 'Quote not found' END AS detail, CAST(p.total AS VARCHAR) AS total
           FROM asked a LEFT JOIN priced p ON p.job_id = a.job_id AND p.position = 0""",
    ),
    "lookup_jobs": """
        SELECT 'job-' || e AS job_id, CASE WHEN s IS NULL THEN 404 ELSE 200 END AS status,
          CASE WHEN s IS NULL THEN 'Job not found' END AS detail, s AS job_status
        FROM (SELECT event_id AS e, CASE WHEN event_id % 7 = 0 THEN 'done' WHEN event_id % 3 = 1 THEN 'pending' END AS s
              FROM events)""",
    "normalized_messages": sql.with_inputs(
        sql.CONTRACT_VALID
        + """,
quote_text AS (
  SELECT v.e, q.i, '{"items":[' || string_agg('{"sku":"' || i.sku || '","qty":' || i.qty ||
           ',"unit_price":"' || i.price || '"}', ',' ORDER BY i.j) || '],"region":"' || any_value(q.region) ||
           '","coupon":' || coalesce('"' || any_value(q.coupon) || '"', 'null') || '}' AS txt
  FROM valid_job v JOIN quote q ON q.e = v.e JOIN item i ON i.e = q.e AND i.i = q.i GROUP BY v.e, q.i
)""",
        """SELECT 'job-' || e AS job_id, '{"job_id":"job-' || e || '","quotes":[' ||
             string_agg(txt, ',' ORDER BY i) || ']}' AS message
           FROM quote_text GROUP BY e""",
    ),
}
