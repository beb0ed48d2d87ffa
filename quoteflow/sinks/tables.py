"""Keyed tables on shared storage: append a batch of rows, read the latest row of each key.

Plain Parquet has no in-place update. A writer puts each run of batch ``n`` into a folder of its own,
``in_writer=<name>/in_batch=<n>/run=<id>``, and then publishes it with the next version of the table's
log (:mod:`quoteflow.sinks.log`). Readers read the runs of one version, so they see a batch whole or not
at all, a repeated batch replaces itself, and no write touches a file that someone may be reading.
Tables that share a log can be published together (:func:`publish`) and read at one version.

Rows lie in hash buckets of their key, sorted by key, so that a lookup of some keys reads only their
buckets and, by the files' statistics, the pages that hold them. Buckets are split, two for one, as
the table grows: a run says how often its buckets are split, and runs written earlier stay as they
are. Rows that expire also lie apart by the day on which they do, so that what has expired is
dropped by folders.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from quoteflow import rules
from quoteflow.operators import evolve
from quoteflow.sinks.log import Log, Run, Version, files

EXPIRES = "expires_at"
BUCKETS = 16
# A bucket is split when the table has more than so many bytes for each.
SPLIT_BYTES = 256 << 20
# A lookup of more keys than this reads all buckets and leaves the choice to the join.
_FEW_KEYS = 1000
_WRITTEN = T.StructType().add("stored_at", "timestamp").add("writer", "string").add("batch", "long")
# Where a row lies; a row that was merged keeps its own writer and batch.
_PLACE = ["in_writer", "in_batch", "run", "split", "day", "bucket", "part"]
_MERGED = "merged"


class KeyedTable:
    """``keys`` identify a row; ``schema`` are its columns, ``defaults`` fill fields added later,
    also nested ones (``operators.evolve``).

    The last write of a key wins, by the writers' clocks. ``final`` is an SQL condition for rows that
    no other row replaces, whatever the clocks say. ``buckets`` is fixed when the table is created.
    ``log`` is the folder of the versions: the table's own, or one shared with other tables.

    A table whose rows are partial sums (:meth:`sum_up`) adds up the writes of a key instead.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: list[str],
        defaults: dict[str, object] | None = None,
        final: str | None = None,
        buckets: int = BUCKETS,
        log: str | None = None,
        split_bytes: int = SPLIT_BYTES,
    ):
        self.spark, self.path, self.schema, self.keys = spark, path.rstrip("/"), schema, keys
        self.defaults, self.final, self.buckets = defaults or {}, final, buckets
        self.log, self.split_bytes = Log(spark, log or f"{self.path}/log"), split_bytes

    def create(self) -> KeyedTable:
        """Record the number of buckets; an existing table must have the same."""
        there = [name for name in self._layout() if name.startswith("buckets-")]
        if there and there != [f"buckets-{self.buckets}"]:
            raise ValueError(f"{self.path} has {there[0]}")
        self._mark(f"buckets-{self.buckets}")
        return self

    def sum_up(self, columns: list[str]) -> KeyedTable:
        """Record that these columns are partial sums, which merging adds up; the other ones are alike per key."""
        wanted, found = f"sums-{','.join(columns)}", self._sums()
        if found is None and self.log.read().of(self.path):
            raise ValueError(f"{self.path} already has rows of which the newest counts")
        if found not in (None, columns):
            raise ValueError(f"{self.path} has sums-{','.join(found)}")
        self._mark(wanted)
        return self

    def upsert(self, rows: DataFrame, batch: int, writer: str = "main", order: Column | None = None) -> None:
        """Insert or replace ``rows`` by key. Running the same batch again replaces it.

        With ``order`` the batch may hold several writes of a key, and its highest one counts.
        """
        publish([self.prepare(rows, batch, writer, order)])

    def prepare(
        self, rows: DataFrame, batch: int, writer: str = "main", order: Column | None = None
    ) -> tuple[KeyedTable, Run]:
        """Write a batch that nobody sees before :func:`publish`."""
        columns = self.schema.fieldNames()
        rows = rows.select(*columns) if order is None else latest_by(
            rows.select(*columns, order.alias("_order")), self.keys, F.col("_order")
        ).drop("_order")
        stamped = rows.withColumns(
            {"stored_at": F.current_timestamp(), "writer": F.lit(writer), "batch": F.lit(batch).cast("long")}
        )
        return self, self._write(stamped, writer, batch)

    def history(
        self,
        without: tuple[str, int] | None = None,
        only: DataFrame | None = None,
        version: Version | None = None,
    ) -> DataFrame:
        """Every published row, optionally without one (writer, batch), or of the keys in ``only``.

        Added columns get their defaults. ``version`` is one of the log's, else the newest.
        """
        version = version or self.log.read()
        rows = self._read([r for r in version.of(self.path) if (r.writer, r.batch) != without], version)
        if only is not None:
            keys = only.select(*self.keys).distinct()
            near = self._near(keys, version)
            rows = (rows if near is None else rows.filter(near)).join(keys, self.keys, "left_semi")
        rows = rows.drop(*_PLACE)
        return evolve.filled(rows, self.schema, self.defaults)

    def latest(
        self,
        without: tuple[str, int] | None = None,
        only: DataFrame | None = None,
        version: Version | None = None,
    ) -> DataFrame:
        """The newest row of each key (or its sums), or just of the keys in ``only``."""
        return self._merged(self.history(without, only, version)).drop(*_WRITTEN.fieldNames())

    def live(
        self,
        now: Column | datetime,
        without: tuple[str, int] | None = None,
        only: DataFrame | None = None,
        version: Version | None = None,
    ) -> DataFrame:
        """Latest rows that have not expired at ``now``."""
        return not_expired(self.latest(without, only, version), now)

    def compact(self, now: Column | datetime | None = None) -> None:
        """Merge all batches but each writer's last, which may still be repeated, into one.

        Keeps one row per key, and only live ones if ``now`` is given. One version takes the merged
        batches away and brings the result. Their files stay for readers of earlier versions, and
        :meth:`vacuum` deletes them.
        """
        version = self.log.read()
        last: dict[str, int] = {}
        for run in version.of(self.path):
            last[run.writer] = max(run.batch, last.get(run.writer, run.batch))
        old = [r for r in version.of(self.path) if r.writer == _MERGED or r.batch < last[r.writer]]
        if len(old) < 2:
            return
        rows = self._merged(self._read(old, version).drop(*_PLACE))
        rows = rows if now is None else not_expired(rows, now)
        made = self._write(rows, _MERGED, last.get(_MERGED, -1) + 1)

        def swap(newest: Version) -> Version:
            if not set(old) <= set(newest.runs):  # a batch was repeated, or merged by another
                return newest
            kept = tuple(r for r in newest.runs if r not in old)
            return replace(newest, runs=(*kept, made))

        self.log.commit(swap)

    def purge(self, now: datetime) -> None:
        """Take away the days that have ended at ``now``, with all rows that expired on them; rewrites nothing.

        Right where a later write of a key does not expire before an earlier one, as with one time to
        live for all rows; otherwise use :meth:`compact`.
        """
        if EXPIRES not in self.schema.fieldNames():
            raise ValueError(f"rows of {self.path} do not expire")
        moment = now if now.tzinfo is None else now.astimezone(timezone.utc)
        day = moment.strftime("%Y-%m-%d")

        def change(newest: Version) -> Version:
            later = max(day, newest.purged.get(self.path, day))
            return replace(newest, purged={**newest.purged, self.path: later})

        self.log.commit(change)

    def vacuum(self) -> None:
        """Delete the files that the newest version does not show; no reader or writer may be active."""
        version, own = self.log.read(), files(self.spark)
        known = {self._folder(r.writer, r.batch, r.id): r for r in version.of(self.path)}
        gone = version.purged.get(self.path, "")
        for writer in own.names(f"{self.path}/data", folders=True):
            for batch in own.names(f"{self.path}/data/{writer}", folders=True):
                for run in own.names(f"{self.path}/data/{writer}/{batch}", folders=True):
                    folder = f"{self.path}/data/{writer}/{batch}/{run}"
                    if folder not in known:
                        own.delete(folder)
                        continue
                    inner = f"{folder}/split={known[folder].split}"
                    for day in own.names(inner, folders=True):
                        if "" < day.removeprefix("day=") < gone:
                            own.delete(f"{inner}/{day}")
        self.log.forget()

    def ledger(self) -> DataFrame:
        """``writer``, ``batch``, ``rows``, ``checksum`` as recorded when each batch was written."""
        entries = [(r.writer, r.batch, r.rows, r.checksum) for r in self.log.read().of(self.path)]
        return self.spark.createDataFrame(entries, "writer string, batch long, rows long, checksum long")

    def rewrite(self, path: str, now: Column | datetime | None = None) -> KeyedTable:
        """Copy the latest rows into a new table with one batch, without expired ones if ``now`` is given."""
        target = KeyedTable(
            self.spark, path, self.schema, self.keys, self.defaults, self.final, self.buckets
        ).create()
        sums = self._sums()
        if sums is not None:
            target.sum_up(sums)
        target.upsert(self.latest() if now is None else self.live(now), 0)
        return target

    def _read(self, runs: list[Run], version: Version) -> DataFrame:
        """The rows of these runs and where they lie."""
        columns = T.StructType([*self.schema.fields, *_WRITTEN.fields])
        columns = T.StructType(columns.fields + [T.StructField(c, T.StringType()) for c in _PLACE])
        folders = [self._folder(r.writer, r.batch, r.id) for r in runs if r.rows]
        if not folders:
            return self.spark.createDataFrame([], columns)
        rows = self.spark.read.schema(columns).option("basePath", f"{self.path}/data").parquet(*folders)
        gone = version.purged.get(self.path)
        return rows if gone is None else rows.filter(F.col("day") >= gone)

    def _near(self, keys: DataFrame, version: Version) -> Column | None:
        """Where these keys lie, as a condition on folders and key values; None if they are many."""
        few = keys.select(*self.keys, self._bucket().alias("bucket"), self._hash().alias("hash"))
        few = few.limit(_FEW_KEYS + 1).collect()
        if len(few) > _FEW_KEYS:
            return None
        near = F.col("bucket").isin(sorted({str(r["bucket"]) for r in few}))
        splits = {r.split for r in version.of(self.path)}
        if any(splits):
            parts = [
                (F.col("split") == str(n)) & F.col("part").isin(sorted({str((r["hash"] >> 8) % 2**n) for r in few}))
                for n in sorted(splits)
            ]
            either = parts[0]
            for one in parts[1:]:
                either |= one
            near &= either
        for key in self.keys:
            values = [r[key] for r in few]
            if None not in values:
                near &= F.col(key).isin(values)
        return near

    def _merged(self, rows: DataFrame) -> DataFrame:
        sums = self._sums()
        if sums is not None:
            return summed_by(rows, self.keys, sums, F.struct("stored_at", "batch"))
        settled = F.coalesce(F.expr(self.final), F.lit(False)) if self.final else F.lit(False)
        return latest_by(rows, self.keys, F.struct(settled, "stored_at", "batch"))

    def _hash(self) -> Column:
        return F.xxhash64(*self.keys)

    def _bucket(self) -> Column:
        return F.pmod(self._hash(), F.lit(self.buckets)).cast("int")

    def _split(self, version: Version) -> int:
        """How often each bucket is split in two: once more when they have over ``split_bytes`` each."""
        held = version.of(self.path)
        size, n = sum(r.bytes for r in held), max([r.split for r in held], default=0)
        return n + 1 if size > self.buckets * 2**n * self.split_bytes else n

    def _write(self, rows: DataFrame, writer: str, batch: int) -> Run:
        split, id_ = self._split(self.log.read()), uuid.uuid4().hex
        day = F.to_date(F.col(EXPIRES)).cast("string") if EXPIRES in self.schema.fieldNames() else F.lit("0")
        placed = rows.withColumns(
            {
                "day": F.coalesce(day, F.lit("9999-12-31")),
                "bucket": self._bucket(),
                "part": F.pmod(F.shiftright(self._hash(), 8), F.lit(2**split)),
            }
        )
        # More groups than shuffle partitions, so that every one of them gets rows; Spark joins small
        # partitions by their size, so a small batch is written by few tasks and a large one by all.
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        groups = -(-4 * tasks // (self.buckets * 2**split))
        salt = F.pmod(F.shiftright(self._hash(), 40), F.lit(groups))
        places = ["day", "bucket", "part"]
        dealt = placed.repartition(*places, salt).sortWithinPartitions(*places, *self._sortable())
        seen = Observation()
        dealt = dealt.observe(seen, F.count(F.lit(1)).alias("rows"), checksum(self.schema).alias("checksum"))
        folder = self._folder(writer, batch, id_)
        dealt.write.partitionBy(*places).parquet(f"{folder}/split={split}")
        found = seen.get
        size = files(self.spark).size(folder)
        return Run(self.path, writer, batch, id_, split, found["rows"], found["checksum"] or 0, size)

    def _sortable(self) -> list[str]:
        return [k for k in self.keys if not isinstance(self.schema[k].dataType, (T.MapType, T.VariantType))]

    def _folder(self, writer: str, batch: int, run: str) -> str:
        return f"{self.path}/data/in_writer={writer}/in_batch={batch}/run={run}"

    def _sums(self) -> list[str] | None:
        found = [name for name in self._layout() if name.startswith("sums-")]
        return found[0].removeprefix("sums-").split(",") if found else None

    def _layout(self) -> Iterable[str]:
        return files(self.spark).names(f"{self.path}/layout")

    def _mark(self, name: str) -> None:
        files(self.spark).touch(f"{self.path}/layout/{name}")


def publish(prepared: list[tuple[KeyedTable, Run]]) -> None:
    """Show prepared batches: those of tables with one log in one version, logs in the order given."""
    logs: dict[str, tuple[Log, list[Run]]] = {}
    for table, run in prepared:
        logs.setdefault(table.log.path, (table.log, []))[1].append(run)
    for log, runs in logs.values():
        log.commit(lambda version: version.put(runs))


def checksum(schema: T.StructType) -> Column:
    """A checksum of rows that does not depend on their order: equal rows cancel out in pairs, no others."""
    values = [f.name if "map<" not in f.dataType.simpleString() else F.to_json(f.name) for f in schema.fields]
    return F.bit_xor(F.xxhash64(*values))


def summed_by(rows: DataFrame, keys: list[str], sums: list[str], version: Column) -> DataFrame:
    """One row per key with these columns added up; the other columns are those of the highest version."""
    rest = [c for c in rows.columns if c not in [*keys, *sums]]
    made = rows.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in sums], F.max_by(F.struct(*rest), version).alias("_row")
    )
    return made.select(*keys, *sums, "_row.*").select(*rows.columns)


def latest_by(rows: DataFrame, keys: list[str], version: Column) -> DataFrame:
    """The row with the highest version of each key.

    An aggregate rather than ``row_number``: copies of a hot key are reduced to one row inside each
    task and never sorted together.
    """
    values = [c for c in rows.columns if c not in keys]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), version).alias("_row"))
    return newest.select(*keys, "_row.*").select(*rows.columns)


def with_expiry(rows: DataFrame, written_at: Column, days: int = rules.TTL_DAYS) -> DataFrame:
    return rows.withColumn(EXPIRES, written_at + F.expr(f"INTERVAL {days} DAYS"))


def not_expired(rows: DataFrame, now: Column | datetime) -> DataFrame:
    moment = now if isinstance(now, Column) else F.lit(now)
    return rows.filter(F.col(EXPIRES) > moment)
