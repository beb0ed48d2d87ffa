"""Keyed tables, schema growth, comparison, reconciliation, relational and Kafka adapters."""

import json
import random
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from quoteflow import rules, schemas, session
from quoteflow.operators import diff, evolve, fanout, parse, reconcile
from quoteflow.plans import checks
from quoteflow.sinks import jdbc, kafka
from quoteflow.sinks.log import files
from quoteflow.sinks.tables import KeyedTable, latest_by, publish
from quoteflow.sources import messages

CURRENCY = T.StructField("currency", T.StringType())


def test_new_field_with_default_is_compatible():
    grown = T.StructType([*schemas.REGION_STATS.fields, CURRENCY])
    assert evolve.backward_errors(schemas.REGION_STATS, grown, {"currency": "INR"}) == []


def test_new_field_without_default_is_refused():
    grown = T.StructType([*schemas.REGION_STATS.fields, CURRENCY])
    assert evolve.backward_errors(schemas.REGION_STATS, grown)
    with pytest.raises(evolve.IncompatibleSchema, match="currency"):
        evolve.require_backward(schemas.REGION_STATS, grown)


def test_removed_widened_and_changed_fields():
    old = T.StructType().add("a", "integer").add("b", "string")
    assert evolve.backward_errors(old, T.StructType().add("a", "long")) == []
    assert evolve.backward_errors(old, T.StructType().add("b", "integer"))


def test_new_schema_reads_old_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("IN", 1)], "region string, n bigint").write.parquet(path)
    spark.createDataFrame([("EU", 2, "EUR")], "region string, n bigint, currency string").write.mode("append").parquet(path)
    grown = T.StructType().add("region", "string").add("n", "long").add("currency", "string")
    rows = evolve.read_as(spark, path, grown, {"currency": "INR"}).collect()
    assert {(r.region, r.currency) for r in rows} == {("IN", "INR"), ("EU", "EUR")}
    old = spark.createDataFrame([("IN", 1)], "region string, n bigint")
    assert evolve.conform(old, grown, {"currency": "INR"}).collect()[0].currency == "INR"


def test_last_write_wins_and_batches_are_replaced(spark, tmp_path):
    schema = T.StructType().add("k", "string").add("v", "integer")
    table = KeyedTable(spark, str(tmp_path / "t"), schema, ["k"]).create()
    assert table.latest().count() == 0
    table.upsert(spark.createDataFrame([("a", 1), ("b", 1)], schema), 0)
    table.upsert(spark.createDataFrame([("a", 2), ("c", 2)], schema), 1)
    table.upsert(spark.createDataFrame([("a", 3)], schema), 1)  # the same batch again
    assert {(r.k, r.v) for r in table.latest().collect()} == {("a", 3), ("b", 1)}
    compacted = table.rewrite(str(tmp_path / "u"))
    assert compacted.history().count() == 2


def test_an_order_decides_between_writes_of_one_batch(spark, tmp_path):
    schema = T.StructType().add("k", "string").add("v", "integer")
    table = KeyedTable(spark, str(tmp_path / "t"), schema, ["k"]).create()
    rows = spark.createDataFrame([("a", n) for n in range(40)], schema).repartition(5)
    table.upsert(rows, 0, order=F.col("v"))
    assert [tuple(r) for r in table.history().select("k", "v").collect()] == [("a", 39)]


def test_a_lookup_reads_the_buckets_of_its_keys_only(spark, tmp_path):
    schema = T.StructType().add("k", "long").add("v", "long")
    table = KeyedTable(spark, str(tmp_path / "t"), schema, ["k"]).create()
    table.upsert(spark.range(2000).select(F.col("id").alias("k"), F.col("id").alias("v")), 0)
    wanted = spark.createDataFrame([(7,)], "k long")
    rows = table.latest(only=wanted)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [(bucket" in plan
    scanned = {f.split("bucket=")[1].split("/")[0] for f in table.history(only=wanted).inputFiles()}
    assert [tuple(r) for r in rows.collect()] == [(7, 7)] and len(scanned) <= 16
    with pytest.raises(ValueError, match="buckets-16"):
        KeyedTable(spark, str(tmp_path / "t"), schema, ["k"], buckets=4).create()


def test_compaction_keeps_the_newest_rows_and_repeats_still_replace(spark, tmp_path):
    schema = T.StructType().add("k", "string").add("v", "integer")
    table = KeyedTable(spark, str(tmp_path / "t"), schema, ["k"]).create()
    for n in range(5):
        table.upsert(spark.createDataFrame([("a", n), (f"k{n}", n)], schema), n)
    want = {("a", 4)} | {(f"k{n}", n) for n in range(5)}
    for _ in range(2):
        table.compact()
        table.vacuum()
        assert {(r.k, r.v) for r in table.latest().collect()} == want
    assert table.history().count() == 7  # the merged rows and the last batch
    table.upsert(spark.createDataFrame([("a", 9)], schema), 4)
    assert {r.k: r.v for r in table.latest().collect()}["a"] == 9


def test_a_large_batch_is_written_by_all_tasks(spark, tmp_path):
    """Buckets do not limit the tasks: a bucket is dealt over several."""
    schema = T.StructType().add("k", "long").add("v", "long")
    table = KeyedTable(spark, str(tmp_path / "t"), schema, ["k"]).create()
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        table.upsert(spark.range(20000).select(F.col("id").alias("k"), F.col("id").alias("v")), 0)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    tasks = {f.split("part-")[1].split("-")[0] for f in table.history().inputFiles()}
    assert len(tasks) >= 60 and table.latest().count() == 20000


def test_buckets_split_as_the_table_grows(spark, tmp_path):
    schema = T.StructType().add("k", "long").add("v", "long")
    table = KeyedTable(spark, str(tmp_path / "t"), schema, ["k"], buckets=2, split_bytes=8000).create()
    for n in range(4):
        rows = spark.range(n * 2000, n * 2000 + 2000).select(F.col("id").alias("k"), F.xxhash64("id").alias("v"))
        table.upsert(rows, n)
    splits = [r.split for r in sorted(table.log.read().runs, key=lambda r: r.batch)]
    assert splits == [0, 1, 2, 3]
    wanted = spark.createDataFrame([(5,), (7999,), (9000,)], "k long")
    rows = table.latest(only=wanted)
    assert {r.k for r in rows.collect()} == {5, 7999}
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "part#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    table.compact()
    assert {r.k for r in table.latest(only=wanted).collect()} == {5, 7999} and table.latest().count() == 8000


def test_a_lookup_pushes_its_keys_to_the_files(spark, tmp_path):
    schema = T.StructType().add("k", "string").add("v", "long")
    table = KeyedTable(spark, str(tmp_path / "t"), schema, ["k"]).create()
    table.upsert(spark.range(5000).select(F.concat(F.lit("q-"), F.col("id")).alias("k"), F.col("id").alias("v")), 0)
    rows = table.latest(only=spark.createDataFrame([("q-7",), ("q-4001",), ("none",)], "k string"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(k, [" in plan and {r.v for r in rows.collect()} == {7, 4001}
    many = spark.range(2000).select(F.concat(F.lit("q-"), F.col("id")).alias("k"))  # left to the join
    assert table.latest(only=many).count() == 2000
    nulls = spark.createDataFrame([(None,), ("q-1",)], "k string")
    assert [r.v for r in table.latest(only=nulls).collect()] == [1]


def test_tables_of_one_log_are_seen_together_or_not_at_all(spark, tmp_path):
    schema = T.StructType().add("k", "string").add("v", "integer")
    log = str(tmp_path / "log")
    a, b = (KeyedTable(spark, str(tmp_path / n), schema, ["k"], log=log).create() for n in "ab")
    rows = [spark.createDataFrame([("x", n)], schema) for n in range(3)]

    def seen(version=None):
        return [[r.v for r in t.latest(version=version).collect()] for t in (a, b)]

    publish([a.prepare(rows[0], 0), b.prepare(rows[0], 0)])
    first = a.log.read()
    a.prepare(rows[1], 1)  # the batch dies before it has written its second table
    assert seen() == [[0], [0]]
    a.prepare(rows[1], 1), b.prepare(rows[1], 1)  # and again before it publishes
    assert seen() == [[0], [0]]
    publish([a.prepare(rows[2], 1), b.prepare(rows[2], 1)])
    assert seen() == [[2], [2]] and seen(first) == [[0], [0]]
    a.vacuum()
    assert seen() == [[2], [2]] and len(a.log.numbers()) == 1


def test_writers_at_the_same_time_lose_no_version(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    schema = T.StructType().add("k", "string").add("v", "integer")
    table = KeyedTable(spark, str(tmp_path / "t"), schema, ["k"]).create()

    def write(n):
        table.upsert(spark.createDataFrame([(f"k{n}", n)], schema), 0, f"writer-{n}")

    with ThreadPoolExecutor(6) as pool:
        list(pool.map(write, range(6)))
    assert table.log.numbers() == [1, 2, 3, 4, 5, 6] and table.latest().count() == 6
    taken = files(spark)
    assert not taken.create(f"{table.log.path}/000000000003", "again") and table.log.read(3).number == 3


def test_partial_sums_add_up_when_they_are_merged(spark, tmp_path):
    schema = T.StructType().add("k", "string").add("n", "long").add("note", "string")
    table = KeyedTable(spark, str(tmp_path / "t"), schema, ["k"]).create().sum_up(["n"])
    for batch in range(4):
        table.upsert(spark.createDataFrame([("a", 10, "x"), (f"b{batch % 2}", 1, "y")], schema), batch)
    want = {("a", 40, "x"), ("b0", 2, "y"), ("b1", 2, "y")}
    again = KeyedTable(spark, table.path, schema, ["k"])  # the rule lies with the table
    for _ in range(2):
        assert {tuple(r) for r in again.latest().collect()} == want
        table.compact()
    assert {tuple(r) for r in again.rewrite(str(tmp_path / "u")).latest().collect()} == want
    newest = KeyedTable(spark, str(tmp_path / "v"), schema, ["k"]).create()
    newest.upsert(spark.createDataFrame([("a", 1, "x")], schema), 0)
    with pytest.raises(ValueError, match="newest counts"):
        newest.sum_up(["n"])
    with pytest.raises(ValueError, match="sums-n"):
        again.sum_up(["note"])


def test_a_compaction_shows_no_row_twice(spark, tmp_path, monkeypatch):
    schema = T.StructType().add("k", "string").add("v", "integer")
    table = KeyedTable(spark, str(tmp_path / "t"), schema, ["k"]).create()
    for n in range(4):
        table.upsert(spark.createDataFrame([(f"k{n}", n)], schema), n)
    commit, counts = table.log.commit, []

    def watched(change):
        counts.append(table.history().count())
        made = commit(change)
        counts.append(table.history().count())
        return made

    monkeypatch.setattr(table.log, "commit", watched)
    table.compact()
    assert counts == [4, 4]


def test_a_batch_repeated_during_a_compaction_is_kept(spark, tmp_path, monkeypatch):
    schema = T.StructType().add("k", "string").add("v", "integer")
    table = KeyedTable(spark, str(tmp_path / "t"), schema, ["k"]).create()
    for n in range(3):
        table.upsert(spark.createDataFrame([("a", n)], schema), n)
    write = table._write

    def late(rows, writer, batch):
        made = write(rows, writer, batch)
        monkeypatch.setattr(table, "_write", write)
        table.upsert(spark.createDataFrame([("a", 50), ("b", 50)], schema), 1)
        return made

    monkeypatch.setattr(table, "_write", late)
    table.compact()
    assert {(r.k, r.v) for r in table.latest().collect()} == {("a", 50), ("b", 50)}


def test_days_that_have_ended_are_dropped_without_rewriting(spark, tmp_path):
    schema = T.StructType().add("k", "string").add("expires_at", "timestamp")
    table = KeyedTable(spark, str(tmp_path / "t"), schema, ["k"]).create()
    days = [datetime(2024, 1, d, h) for d in (8, 9, 10) for h in (6, 18)]
    table.upsert(spark.createDataFrame([(f"k{n}", d) for n, d in enumerate(days)], schema), 0)
    table.upsert(spark.createDataFrame([("none", None), ("old", datetime(2024, 1, 8))], schema), 1)
    before, now = set(table.history().inputFiles()), datetime(2024, 1, 9, 12)
    live = {r.k for r in table.live(now).collect()}
    table.purge(now)
    assert {r.k for r in table.live(now).collect()} == live == {"k3", "k4", "k5"}
    # The day that has not ended stays whole, as does what never expires.
    assert {r.k for r in table.history().collect()} == {"k2", "k3", "k4", "k5", "none"}
    table.vacuum()
    after = set(table.history().inputFiles())
    assert after < before and all("day=2024-01-08" in f for f in before - after)
    table.purge(datetime(2024, 1, 8))  # an earlier day brings nothing back
    assert table.history().count() == 5


def test_an_unpublished_run_is_not_seen(spark, tmp_path):
    schema = T.StructType().add("k", "string").add("v", "integer")
    table = KeyedTable(spark, str(tmp_path / "t"), schema, ["k"]).create()
    table.upsert(spark.createDataFrame([("a", 1)], schema), 0)
    half = spark.createDataFrame([("a", 2, 0)], "k string, v int, bucket int")
    half.write.partitionBy("bucket").parquet(table._folder("main", 1, "crashed"))
    assert [r.v for r in table.latest().collect()] == [1]


def test_intermediate_tables_can_be_cleaned_up(spark):
    import os

    kept = session.durable(spark.range(3), "cleaned")
    path = kept.inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path)
    session.clean(spark)
    assert not os.path.exists(path)


def test_latest_of_a_hot_key(spark):
    rows = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("k"), F.col("id").alias("v")
    )
    got = {r.k: r.v for r in latest_by(rows, ["k"], F.col("v")).collect()}
    assert got[-1] == 4999 and len(got) == 1 + 1667


def test_compare_counts_copies(spark):
    left = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1), ("d", None), ("e", 1), ("e", 1)], "k string, v int")
    right = spark.createDataFrame([("a", 1), ("b", 2), ("x", 1), ("d", None), ("e", 1)], "k string, v int")
    got = {r.k: (r.verdict, r.left_rows, r.right_rows) for r in diff.compare(left, right, ["k"]).collect()}
    assert got == {
        "b": ("different", 1, 1),
        "c": ("only left", 1, 0),
        "x": ("only right", 0, 1),
        "e": ("different", 2, 1),
    }


def test_only_parts_that_differ_are_compared_by_rows(spark):
    left = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("k"), (F.col("id") % 7).alias("v"))
    changed = left.filter("k <> 'k5'").withColumn("v", F.when(F.col("k") == "k9", -1).otherwise(F.col("v")))
    right = changed.unionAll(changed.filter("k = 'k77'")).unionAll(changed.limit(0))
    a, b = diff.digested(left, ["k"]), diff.digested(right.repartition(5), ["k"])
    parts = diff.unequal_parts(a, b)
    leaf = F.pmod(F.xxhash64("k"), F.lit(diff.RANGES * diff.PARTS))
    wanted = left.filter("k in ('k5', 'k9', 'k77')").select(F.floor(leaf / diff.PARTS), leaf).distinct()
    assert parts == sorted(map(tuple, wanted.collect()))
    made = diff.compare_tree(a, b, ["k"])
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_range" in plan and "PushedFilters: [In(_part" in plan
    assert {tuple(r) for r in made.collect()} == {tuple(r) for r in diff.compare(left, right, ["k"]).collect()}
    assert diff.unequal_parts(a, diff.digested(left.repartition(3), ["k"])) == []
    assert diff.compare_tree(a, a, ["k"]).count() == 0
    none = diff.digested(left.limit(0), ["k"])
    assert diff.compare_tree(none, none, ["k"]).count() == 0 and diff.compare_tree(a, none, ["k"]).count() == 3000


def test_a_cross_read_compares_every_column(spark, monkeypatch):
    line = ("pen", 2, Decimal("1.50"), Decimal("3.00"))
    money = [Decimal(n) for n in ("3.00", "0.00", "0.54", "49.00", "52.54")]
    quote = ["IN", "INR", "SAVE10", [line], *money, "2024-01-01T00:00:00Z"]
    columns = schemas.QUOTE.names[1:]
    other = {name: None for name in columns} | {"line_items": [(*line[:2], Decimal("1.51"), line[3])]}
    written = [("same", *quote), *((name, *quote) for name in columns)]
    read = [("same", *quote)]
    for i, name in enumerate(columns):
        read.append((name, *quote[:i], other[name], *quote[i + 1 :]))

    # What the query hands to the comparison, of the quotes as they were written and as they are read.
    compare, handed = diff.compare, []
    monkeypatch.setattr(checks.diff, "compare", lambda left, right, keys: handed.append((left, right)) or left)
    for rows in (written, read):
        answers = spark.createDataFrame(rows, schemas.QUOTE).withColumns(
            {"job_id": F.lit("job-1"), "position": F.lit(0), "e": F.lit(1).cast("long"), "case": F.lit("job-1/0")}
        )
        monkeypatch.setattr(checks, "_answers", lambda *_, answers=answers: answers)
        checks.cross_read_diff(spark, "")
    got = compare(handed[0][0], handed[1][1], ["id"]).collect()
    assert {r.id: r.verdict for r in got} == dict.fromkeys(columns, "different")


def test_a_ledger_names_the_batch(spark, tmp_path):
    schema = T.StructType().add("k", "long").add("v", "string")
    table = KeyedTable(spark, str(tmp_path / "t"), schema, ["k"]).create()
    rows = spark.range(50).select(F.col("id").alias("k"), F.when(F.col("id") % 3 == 0, "x").alias("v"))
    for n in (0, 2, 3, 4, 5):
        part = rows.filter(F.col("k") % 5 == n)
        part = part.unionAll(part) if n == 2 else part.withColumn("v", F.lit("y")) if n == 3 else part
        table.upsert(part, n)
    table.upsert(rows.filter("k % 5 = 0"), 7)
    got = reconcile.ledgers(reconcile.ledger(rows, F.col("k") % 5, schema), table.ledger())
    assert {(r.batch, r.verdict, r.accepted, r.stored) for r in got.collect()} == {
        (1, "missing", 10, 0),
        (2, "doubled", 10, 20),
        (3, "changed", 10, 10),
        (7, "unexpected", 0, 10),
    }


def test_nested_fields_grow(spark, tmp_path):
    old = T._parse_datatype_string("id string, lines array<struct<sku: string, n: int>>, by map<string, struct<a: int>>")
    new = T._parse_datatype_string(
        "id string, lines array<struct<sku: string, n: bigint, unit: string>>, by map<string, struct<a: int, b: struct<c: int>>>"
    )
    assert evolve.backward_errors(old, new) == ["new field lines.unit has no default", "new field by.b has no default"]
    defaults = {"lines.unit": "piece", "by.b": None}
    assert evolve.backward_errors(old, new, defaults) == []
    assert evolve.backward_errors(new, old, {}) == ["field lines.n changed from LongType() to IntegerType()"]
    rows = spark.createDataFrame(
        [("1", [("a", 1), None], {"x": (1,)}), ("2", None, None), ("3", [], {})], old
    )
    want = [
        ("1", [("a", 1, "piece"), None], {"x": (1, None)}),
        ("2", None, None),
        ("3", [], {}),
    ]

    def plain(frame):
        assert frame.schema.simpleString() == new.simpleString()
        return sorted(
            (
                r.id,
                None if r.lines is None else [None if x is None else tuple(x) for x in r.lines],
                None if r.by is None else {k: tuple(v) for k, v in r.by.items()},
            )
            for r in frame.collect()
        )

    assert plain(evolve.conform(rows, new, defaults)) == want
    rows.withColumn("lines", F.expr("transform(lines, x -> if(x is null, null, named_struct('sku', x.sku, 'n', bigint(x.n))))")).write.parquet(
        str(tmp_path / "t")
    )
    assert plain(evolve.read_as(spark, str(tmp_path / "t"), new, defaults)) == want


def test_masking(spark):
    body = {
        "id": "1\"2", "job_id": None, "quote_ids": ["a", "b"], "note": 'the "id": "kept"',
        "nested": [{"created_at": "2024", "total": "1.00"}],
    }
    frame = spark.createDataFrame([(json.dumps(body),)], "body string")
    masked = json.loads(frame.select(diff.mask_json(F.col("body")).alias("m")).collect()[0].m)
    mark = "<volatile>"
    assert masked == {
        "id": mark, "job_id": mark, "quote_ids": mark, "note": body["note"],
        "nested": [{"created_at": mark, "total": "1.00"}],
    }
    nested = {
        "id": {"a": [1, {"id": "]"}]}, "quote_ids": [["x"], "y"], "keep": {"quote_ids": ["a]b", "c}"], "n": 1.5},
        "job_id": True, "created_at": -1e9, "text": 'x" , "id": 7' + "y" * 20_000, "list": [{"id": 3}, {"id": []}],
    }
    frame = spark.createDataFrame([(json.dumps(nested),)], "body string")
    masked = json.loads(frame.select(diff.mask_json(F.col("body")).alias("m")).collect()[0].m)
    assert masked == {
        "id": mark, "quote_ids": mark, "keep": {"quote_ids": mark, "n": 1.5}, "job_id": mark, "created_at": mark,
        "text": nested["text"], "list": [{"id": mark}, {"id": mark}],
    }
    typed = spark.createDataFrame([("x", "y")], "id string, total string")
    assert tuple(diff.mask(typed).collect()[0]) == (mark, "y")


def test_masking_json_does_not_depend_on_depth(spark):
    def mark(value):
        if isinstance(value, list):
            return [mark(v) for v in value]
        if not isinstance(value, dict):
            return value
        return {k: "<volatile>" if k in rules.VOLATILE_FIELDS else mark(v) for k, v in value.items()}

    def deep(levels, leaf):
        for k in range(levels):
            leaf = [leaf, "]"] if k % 2 else {"job_id" if k % 10 == 0 else "a": leaf, "b": '}"\\'}
        return leaf

    rnd = random.Random(4)

    def some(levels):
        kind = rnd.random()
        if not levels or kind < 0.3:
            return rnd.choice([1, -2.5, True, None, "", "x", "]", '"id": [', "\\", "id"])
        if kind < 0.6:
            return [some(levels - 1) for _ in range(rnd.randint(0, 3))]
        names = rnd.sample(["id", "job_id", "quote_ids", "created_at", "a", "b", "xid"], rnd.randint(0, 4))
        return {n: some(levels - 1) for n in names}

    bodies = [{"id": deep(n, 1), "keep": deep(n, 2), "quote_ids": [deep(n, 3)]} for n in (1, 23, 24, 25, 26, 90)]
    bodies += [some(6) for _ in range(300)]
    rows = [(k, json.dumps(b, indent=k % 3 or None)) for k, b in enumerate(bodies)] + [(-1, None)]
    frame = spark.createDataFrame(rows, "k int, body string")
    got = {r.k: r.m for r in frame.select("k", diff.mask_json(F.col("body")).alias("m")).collect()}
    assert got.pop(-1) is None
    for k, masked in got.items():
        assert json.loads(masked) == mark(bodies[k]), rows[k]
    broken = spark.createDataFrame([('{"id": 1, "a": 2, "job_id": [1, {"id": 3}',)], "body string")
    masked = broken.select(diff.mask_json(F.col("body")).alias("m")).first().m
    assert masked == '{"id":"<volatile>", "a": 2, "job_id": [1, {"id": 3}'


def test_key_changes_and_bodies(spark):
    before = spark.createDataFrame([("a",), ("b",), ("b",)], "id string")
    after = spark.createDataFrame([("b",), ("c",)], "id string")
    assert {tuple(r) for r in diff.key_changes(before, after, ["id"]).collect()} == {("a", "removed"), ("c", "added")}
    answers = spark.createDataFrame([("r", '{"id": "1", "t": 2}'), ("r", '{"id": "9", "t": 2}')], "g string, body string")
    assert diff.distinct_bodies(answers, ["g"]).collect()[0].bodies == 1


def test_reconciliation(spark):
    stored = spark.createDataFrame(
        [("EU", datetime(2024, 1, 1), 2, 9000), ("IN", datetime(2024, 1, 1), 1, 10)],
        "region string, window_start timestamp, quote_count bigint, gross_amount_cents bigint",
    )
    accepted = spark.range(3)
    (row,) = reconcile.totals(accepted, stored, 2).collect()
    assert (row.accepted, row.stored, row.complete, row.enough) == (3, 3, True, True)
    (row,) = reconcile.totals(spark.range(0), stored.limit(0), 2).collect()
    assert (row.accepted, row.stored, row.complete, row.enough) == (0, 0, True, False)
    assert reconcile.region_gross(stored, "EU", 5997).collect()[0].ok
    assert reconcile.region_gross(stored, "US", 1).collect()[0].gross_amount_cents == 0
    assert [r.region for r in reconcile.dump(stored).collect()] == ["EU", "IN"]
    dead = fanout.dead_letters(parse.validated(spark.createDataFrame([("k", "[]")], "key string, value string")))
    assert reconcile.has_reason(dead, "message is not a JSON object").collect()[0].found
    assert not reconcile.has_reason(dead, "missing job_id").collect()[0].found


def test_relational_statements():
    keys = ["region", "window_start"]
    assert jdbc.create_statement("stats", schemas.REGION_STATS, keys) == (
        "CREATE TABLE IF NOT EXISTS stats (region TEXT NOT NULL, window_start TIMESTAMP NOT NULL, "
        "window_end TIMESTAMP, quote_count BIGINT, item_count BIGINT, gross_amount_cents BIGINT, "
        "PRIMARY KEY (region, window_start))"
    )
    assert jdbc.upsert_statement("t", ["k", "v"], ["k"]) == (
        "INSERT INTO t (k, v) VALUES (%s, %s) ON CONFLICT (k) DO UPDATE SET v = EXCLUDED.v"
    )
    grown = T.StructType([*schemas.REGION_STATS.fields, CURRENCY])
    assert jdbc.evolve_statements("stats", schemas.REGION_STATS.fieldNames(), grown) == [
        "ALTER TABLE stats ADD COLUMN currency TEXT"
    ]
    assert jdbc.sql_type(schemas.MONEY) == "DECIMAL(13,2)"


def test_kafka_shapes(spark):
    options = messages.kafka_options("b:9092")
    assert options["startingOffsets"] == "earliest"
    assert options["kafka.isolation.level"] == "read_committed"
    assert kafka.producer_options("b:9092", "t")["kafka.acks"] == "all"
    event = spark.createDataFrame([("j", 0, "IN", 1, 100, None)], schemas.QUOTE_EVENT)
    (row,) = kafka.quote_requests(event).collect()
    assert row.key == "j" and json.loads(row.value)["coupon"] is None


class Recorder:
    """A DB-API connection that writes down what it is asked to do."""

    def __init__(self, path):
        self.path, self.lines = path, []

    def cursor(self):
        return self

    description = [("region",), ("window_start",)]

    def execute(self, statement):
        self.lines.append(json.dumps([statement]))

    def executemany(self, statement, rows):
        self.lines += [json.dumps([statement, *row], default=str) for row in rows]

    def commit(self):
        import uuid

        (self.path / f"{uuid.uuid4().hex}.txt").write_text("\n".join(self.lines))

    def close(self):
        pass


def test_relational_upsert_sends_every_row_once(spark, tmp_path):
    from functools import partial

    rows = spark.range(2500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    jdbc.write(rows, partial(make_recorder, str(tmp_path)), "t", ["k"], connections=3)
    sent = [json.loads(line) for f in tmp_path.iterdir() for line in f.read_text().splitlines()]
    assert sorted(s[1] for s in sent) == list(range(2500))
    assert {s[0] for s in sent} == {jdbc.upsert_statement("t", ["k", "v"], ["k"])}


def make_recorder(path):
    from pathlib import Path

    return Recorder(Path(path))


def test_a_stream_fills_a_relational_table_and_a_topic(spark, tmp_path):
    from functools import partial

    from quoteflow.sinks.jdbc import RelationalTable
    from quoteflow.sinks.kafka import KeyedTopic
    from quoteflow.streaming import queries as streams

    rows = [("j", n, "EU", 2, 100, None, datetime(2024, 5, 1, 10, 0, n)) for n in range(3)]
    schema = T.StructType([*schemas.QUOTE_EVENT.fields, T.StructField("timestamp", T.TimestampType())])
    source, log, sent = str(tmp_path / "topic"), tmp_path / "log", []
    log.mkdir()
    spark.createDataFrame(rows, schema).write.parquet(source)
    keys = ["region", "window_start"]
    table = RelationalTable(partial(make_recorder, str(log)), "stats", schemas.REGION_STATS, keys, connections=1).create()
    topic = KeyedTopic(lambda out: sent.extend(out.collect()))
    for name, sink in (("table", table), ("topic", topic)):
        stream = spark.readStream.schema(schema).parquet(source)
        streams.region_stats(stream, sink, str(tmp_path / f"check-{name}")).awaitTermination()
    said = [json.loads(line) for f in log.iterdir() for line in f.read_text().splitlines()]
    statements = [s[0] for s in said if len(s) == 1]
    assert statements[0] == jdbc.create_statement("stats", schemas.REGION_STATS, keys)
    assert [s.split()[-2] for s in statements[2:]] == ["window_end", "quote_count", "item_count", "gross_amount_cents"]
    assert [s[1:2] + s[4:] for s in said if len(s) > 1] == [["EU", 3, 6, 300]]
    assert [(r.key, json.loads(r.value)["quote_count"]) for r in sent] == [("EU@2024-05-01T10:00:00Z", 3)]
