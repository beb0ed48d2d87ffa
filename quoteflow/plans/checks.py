"""Queries that compare results with each other: parity, retries, reconciliation, schema growth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from quoteflow import schemas, session
from quoteflow.operators import diff, evolve, fanout, parse, pricing as P, reconcile, windows
from quoteflow.plans import inputs, pricing, sql, streams as plan_streams
from quoteflow.sinks.tables import KeyedTable
from quoteflow.streaming import queries as streams


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priced quotes, written once: the comparisons below read them several times."""
    quotes = session.durable(pricing.priced(spark, sf_dir), "answers")
    return quotes.withColumns(
        {
            "e": F.substring("job_id", 5, 20).cast("bigint"),
            "case": F.concat_ws("/", "job_id", "position"),
        }
    )


def _two_backends(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two implementations' answers to the same requests, with drift in some of the second one's.

    What differs between any two runs is masked before the body is rendered, and the body goes on as
    its digest.
    """
    answers = _answers(spark, sf_dir)
    e = F.col("e")
    status = F.lit(201).alias("status")

    def answer(rows: DataFrame, case: Column, status: Column) -> DataFrame:
        body = F.sha2(P.quote_body(), 256).alias("body")
        return diff.mask(rows, ["id", "created_at"]).select(case.alias("case"), status, "region", body)

    left = answer(answers, F.col("case"), status)
    changed = answers.filter(e % 211 != 0).withColumns(
        {
            "id": F.reverse("id"),
            "created_at": F.lit("2030-01-01T00:00:00Z"),
            "shipping": F.when(e % 199 == 0, F.col("shipping") + 1).otherwise(F.col("shipping")),
        }
    )
    right = answer(changed, F.col("case"), F.when(e % 193 == 0, 500).otherwise(201).alias("status"))
    extra = answer(answers.filter(e % 197 == 0), F.concat("case", F.lit("/extra")), status)
    return left, right.unionByName(extra)


def parity_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases whose status or masked body differs between two implementations."""
    left, right = _two_backends(spark, sf_dir)
    return diff.compare(left, right, ["case"])


def parity_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same cases by way of digests: parts of the key range that agree are not read."""
    left, right = (diff.digested(side, ["case"]) for side in _two_backends(spark, sf_dir))
    return diff.compare_tree(left, right, ["case"])


def backend_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Different masked answers per region when every quote is answered by two backends."""
    left, right = _two_backends(spark, sf_dir)
    both = left.unionByName(right)
    return both.groupBy("region").agg(F.count_distinct("body").alias("bodies"))


def cross_read_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes written through one backend and read through the other: every column must agree.

    A quote goes on as its id and the digest of all its other columns, line items included.
    """
    answers = _answers(spark, sf_dir)
    e = F.col("e")
    lost = answers.filter(e % 223 != 0).withColumn(
        "tax", F.when(e % 227 == 0, F.col("tax") + F.lit("0.01").cast("decimal(13,2)")).otherwise(F.col("tax"))
    )
    columns = [name for name in answers.columns if name not in ("id", "e", "case")]
    text = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    written, read = (side.select("id", F.unhex(F.sha2(text, 256)).alias("rest")) for side in (answers, lost))
    return diff.compare(written, read, ["id"])


def retry_key_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that changed between two runs; the second run here lost some jobs and renamed others."""
    answers = _answers(spark, sf_dir)
    e = F.col("e")
    again = answers.filter(e % 229 != 0).withColumn(
        "id", F.when(e % 233 == 0, F.concat(F.lit("x"), "id")).otherwise(F.col("id"))
    )
    return diff.key_changes(answers.select("id"), again.select("id"), ["id"])


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fanout.quote_events(parse.validated(inputs.job_messages(spark, sf_dir)))


def reconcile_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quote events accepted against the stored totals of a stream, and again with a batch missing."""
    root = session.scratch_path(spark, "reconcile")
    events = session.durable(_events(spark, sf_dir), "accepted")
    number = F.substring("job_id", 5, 20).cast("bigint")
    table = KeyedTable(spark, f"{root}/stats", schemas.REGION_STATS, ["region", "window_start"]).create()
    plan_streams.in_parts(
        events,
        f"{root}/topic",
        number % 3,
        3,
        lambda source: streams.totals_in_order(source, table, f"{root}/checkpoint"),
    )
    writer = streams.writer_of(spark, f"{root}/checkpoint")
    cases = {"stored": table.history(), "batch missing": table.history(without=(writer, 2))}
    rows = [
        reconcile.totals(events, stored, minimum=2).withColumn("case", F.lit(case))
        for case, stored in cases.items()
    ]
    return rows[0].unionByName(rows[1])


def reconcile_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of six batches a sink lost, wrote twice over, changed or made up, by ledgers alone."""
    events = session.durable(_events(spark, sf_dir), "accepted")
    batch = F.substring("job_id", 5, 20).cast("bigint") % 6
    table = KeyedTable(
        spark, session.scratch_path(spark, "ledger"), schemas.QUOTE_EVENT, ["job_id", "position"]
    ).create()
    raised = (F.col("gross_amount_cents") + F.when(F.col("position") == 0, 1).otherwise(0)).cast("long")
    for number in range(6):
        rows = events.filter(batch == number)
        if number == 2:
            rows = rows.unionAll(rows)
        if number == 3:
            rows = rows.withColumn("gross_amount_cents", raised)
        if number != 1:
            table.upsert(rows, number)
    table.upsert(events.filter(batch == 5), 6)
    return reconcile.ledgers(reconcile.ledger(events, batch, schemas.QUOTE_EVENT), table.ledger())


def region_gross(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.region_gross(windows.region_totals(_events(spark, sf_dir)), "EU", 5997)


def dead_letter_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    dead = fanout.dead_letters(parse.validated(inputs.job_messages(spark, sf_dir)))
    return reconcile.has_reason(dead, "quotes must be a list of 1-50 requests")


def stats_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = windows.region_totals(_events(spark, sf_dir), "1 hour")
    start = F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start")
    rows = reconcile.dump(stats)
    return rows.select("region", start, "quote_count", "item_count", "gross_amount_cents")


def evolved_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals stored before and after the table gained a ``currency`` column with a default.

    The old layout writes every region; the newer one then replaces the European rows.
    """
    old = schemas.REGION_STATS
    new = T.StructType([*old.fields, T.StructField("currency", T.StringType())])
    defaults = {"currency": "INR"}
    evolve.require_backward(old, new, defaults)
    stats = session.durable(windows.region_totals(_events(spark, sf_dir), "1 day"), "stats")
    path, keys = session.scratch_path(spark, "evolved"), ["region", "window_start"]
    KeyedTable(spark, path, old, keys).create().upsert(stats, 1)
    grown = KeyedTable(spark, path, new, keys, defaults)
    european = stats.filter(F.col("region") == "EU").withColumn("currency", F.lit("EUR"))
    grown.upsert(european, 2)
    start = F.date_format("window_start", "yyyy-MM-dd").alias("window_start")
    return grown.latest().select("region", start, "quote_count", "gross_amount_cents", "currency")


def evolved_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of quotes stored before and after a line gained a ``tax_class`` with a default.

    The old layout writes every quote; the newer one then replaces every other job's.
    """
    answers = _answers(spark, sf_dir)
    line = T.StructType([*schemas.LINE_ITEM_OUT.fields, T.StructField("tax_class", T.StringType())])
    old = T.StructType([schemas.QUOTE["id"], schemas.QUOTE["line_items"]])
    new = T.StructType([schemas.QUOTE["id"], T.StructField("line_items", T.ArrayType(line))])
    defaults = {"line_items.tax_class": "standard"}
    evolve.require_backward(old, new, defaults)
    path = session.scratch_path(spark, "evolved-nested")
    KeyedTable(spark, path, old, ["id"]).create().upsert(answers.select("id", "line_items"), 1)
    grown = KeyedTable(spark, path, new, ["id"], defaults)
    reduced = evolve.conform(
        answers.filter(F.col("e") % 2 == 0).select("id", "line_items"), new, {"line_items.tax_class": "reduced"}
    )
    grown.upsert(reduced, 2)
    lines = grown.latest().select("id", F.posexplode("line_items").alias("line", "item"))
    return lines.select("id", "line", "item.sku", "item.qty", "item.tax_class")


QUERIES = {
    "evolved_nested": evolved_nested,
    "parity_tree": parity_tree,
    "reconcile_ledger": reconcile_ledger,
    "parity_diff": parity_diff,
    "backend_bodies": backend_bodies,
    "cross_read_diff": cross_read_diff,
    "retry_key_diff": retry_key_diff,
    "reconcile_totals": reconcile_totals,
    "region_gross": region_gross,
    "dead_letter_reason": dead_letter_reason,
    "stats_dump": stats_dump,
    "evolved_stats": evolved_stats,
}

_PARITY = sql.with_inputs(
    sql.PRICED,
    """SELECT job_id || '/' || position AS "case",
         CASE WHEN e % 211 = 0 THEN 'only left' ELSE 'different' END AS verdict,
         CAST(1 AS BIGINT) AS left_rows, CAST(CASE WHEN e % 211 = 0 THEN 0 ELSE 1 END AS BIGINT) AS right_rows
       FROM priced WHERE e % 211 = 0 OR e % 199 = 0 OR e % 193 = 0
       UNION ALL
       SELECT job_id || '/' || position || '/extra', 'only right', 0, 1 FROM priced WHERE e % 197 = 0""",
)

ORACLE = {
    "evolved_nested": sql.with_inputs(
        sql.PRICED,
        """SELECT p.id, CAST(row_number() OVER (PARTITION BY p.id ORDER BY i.j) - 1 AS INTEGER) AS line, i.sku,
             CAST(i.qty AS INTEGER) AS qty, CASE WHEN p.e % 2 = 0 THEN 'reduced' ELSE 'standard' END AS tax_class
           FROM priced p JOIN item i ON i.e = p.e AND i.i = p.position""",
    ),
    "parity_diff": _PARITY,
    "parity_tree": _PARITY,
    "reconcile_ledger": sql.with_inputs(
        sql.CHECKED
        + """,
batches AS (SELECT e % 6 AS batch, count(*) AS n, count(*) FILTER (position = 0) AS firsts FROM quote_event GROUP BY e % 6)""",
        """SELECT batch::BIGINT AS batch, CASE batch WHEN 1 THEN 'missing' WHEN 2 THEN 'doubled' ELSE 'changed' END AS verdict,
             n AS accepted, CASE batch WHEN 1 THEN 0 WHEN 2 THEN 2 * n ELSE n END AS stored
           FROM batches WHERE batch IN (1, 2) OR (batch = 3 AND firsts > 0)
           UNION ALL SELECT 6, 'unexpected', 0, n FROM batches WHERE batch = 5""",
    ),
    "backend_bodies": sql.with_inputs(
        sql.PRICED
        + """,
lines AS (
  SELECT e, i, string_agg(sku || '|' || qty || '|' || price, ';' ORDER BY j) AS txt FROM item GROUP BY e, i
),
answers AS (
  SELECT p.region, p.coupon, l.txt, p.shipping FROM priced p JOIN lines l ON l.e = p.e AND l.i = p.position
  UNION ALL
  SELECT p.region, p.coupon, l.txt, p.shipping + CASE WHEN p.e % 199 = 0 THEN 1 ELSE 0 END
  FROM priced p JOIN lines l ON l.e = p.e AND l.i = p.position WHERE p.e % 211 <> 0
)""",
        """SELECT region, count(*) AS bodies FROM (SELECT DISTINCT * FROM answers) GROUP BY region""",
    ),
    "cross_read_diff": sql.with_inputs(
        sql.PRICED,
        """SELECT id, CASE WHEN e % 223 = 0 THEN 'only left' ELSE 'different' END AS verdict,
             CAST(1 AS BIGINT) AS left_rows, CAST(CASE WHEN e % 223 = 0 THEN 0 ELSE 1 END AS BIGINT) AS right_rows
           FROM priced WHERE e % 223 = 0 OR e % 227 = 0""",
    ),
    "retry_key_diff": sql.with_inputs(
        sql.PRICED,
        """SELECT id, 'removed' AS change FROM priced WHERE e % 229 = 0 OR e % 233 = 0
           UNION ALL SELECT 'x' || id, 'added' FROM priced WHERE e % 233 = 0 AND e % 229 <> 0""",
    ),
    "reconcile_totals": sql.with_inputs(
        sql.CHECKED,
        """SELECT "case", (SELECT count(*) FROM quote_event) AS accepted, stored,
             stored = (SELECT count(*) FROM quote_event) AS complete, stored >= 2 AS enough
           FROM (SELECT 'stored' AS "case", count(*) AS stored FROM quote_event
                 UNION ALL SELECT 'batch missing', count(*) FROM quote_event WHERE e % 3 <> 2)""",
    ),
    "region_gross": sql.with_inputs(
        sql.CHECKED,
        """SELECT 'EU' AS region, CAST(coalesce(sum(gross_amount_cents), 0) AS BIGINT) AS gross_amount_cents,
             coalesce(sum(gross_amount_cents), 0) >= 5997 AS ok FROM quote_event WHERE region = 'EU'""",
    ),
    "dead_letter_reason": sql.with_inputs(
        sql.CHECKED,
        """SELECT 'quotes must be a list of 1-50 requests' AS reason, count(*) AS messages, count(*) > 0 AS found
           FROM checked WHERE error = 'quotes must be a list of 1-50 requests'""",
    ),
    "stats_dump": sql.with_inputs(
        sql.CHECKED,
        """SELECT region, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
             count(*) AS quote_count, CAST(sum(item_count) AS BIGINT) AS item_count,
             CAST(sum(gross_amount_cents) AS BIGINT) AS gross_amount_cents
           FROM quote_event GROUP BY region, date_trunc('hour', ts) ORDER BY 2, 1""",
    ),
    "evolved_stats": sql.with_inputs(
        sql.CHECKED,
        """SELECT region, strftime(ts, '%Y-%m-%d') AS window_start, count(*) AS quote_count,
             CAST(sum(gross_amount_cents) AS BIGINT) AS gross_amount_cents,
             CASE region WHEN 'EU' THEN 'EUR' ELSE 'INR' END AS currency
           FROM quote_event GROUP BY region, strftime(ts, '%Y-%m-%d')""",
    ),
}
