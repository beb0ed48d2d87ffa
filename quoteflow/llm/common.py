"""Helpers shared by the operators: reading tables, running a function over batches of texts."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

from quoteflow import session

# One call of a text function sees about this many characters (or one longer text).
_SLICE_CHARS = 4_000_000

# Rows of a batch in :func:`small_batches`.
_BATCH_ROWS = 1000

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def others(df: DataFrame, taken: Iterable[str]) -> list[str]:
    """Columns of ``df`` whose names, in any case, are not among ``taken``."""
    lower = {name.lower() for name in taken}
    return [c for c in df.columns if c.lower() not in lower]


def slices(batch: pa.RecordBatch, text_column: int, limit: int = _SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with bounded text; a longer text is a run of its own."""
    column, start, held = batch.column(text_column), 0, 0
    for i, n in enumerate(pc.binary_length(column).to_pylist()):
        n = n or 0
        if i > start and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if batch.num_rows > start:
        yield batch.slice(start)


def per_text(
    df: DataFrame,
    fields: Sequence[StructField],
    fn: Callable[[list[str | None]], Sequence[Sequence]],
    keep: Sequence[str],
    text: str = "text",
) -> DataFrame:
    """Columns ``keep`` plus ``fields``, one row per row; ``fn`` maps a list of texts to columns.

    A narrow stage: no shuffle, one slice of a batch in memory at a time.
    """
    schema = StructType([df.schema[c] for c in keep] + list(fields))
    at, count = len(keep), len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            for part in slices(batch, at):
                made = fn(part.column(at).to_pylist())
                columns = [part.column(i).cast(arrow.field(i).type) for i in range(count)]
                columns += [
                    pa.array(values, arrow.field(count + i).type) for i, values in enumerate(made)
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return df.select(*keep, df[text].cast("string").alias("_text")).mapInArrow(run, schema)


def stored(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """``df`` written to the cluster's shared folder and read back: cuts lineage, outlives executors."""
    path = session.scratch_path(df.sparkSession, label)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Tables written in here hand wide rows to Python a few at a time.

    Spark's own batches hold 10,000 rows or 64 MB; the JVM, which doubles a buffer to make it grow, and the
    worker would each hold that more than once, for every core.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if not 0 < int(before) <= _BATCH_ROWS:
        spark.conf.set(name, str(_BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def discard(*tables: DataFrame) -> None:
    """Delete tables written by :func:`stored` that no later phase reads."""
    for df in tables:
        spark, files = df.sparkSession, df.inputFiles()
        if files:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished phases, whose results are in written tables.

    Spark frees them when the driver's garbage is collected, which it otherwise does by the half hour.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


# So many rows of a batch are Python objects at a time.
_SLICE_ROWS = 256


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    """The batch's rows, turned into Python objects a few at a time: wide ones do not all exist twice."""
    for start in range(0, batch.num_rows, _SLICE_ROWS):
        yield from zip(*[c.to_pylist() for c in batch.slice(start, _SLICE_ROWS).columns])


def per_group(
    df: DataFrame,
    keys: Sequence[str],
    schema: StructType,
    fn: Callable[[tuple, list[tuple]], list[tuple]],
) -> DataFrame:
    """``fn(key, rows)`` for every group of ``keys``; rows are the other columns, results are rows.

    For many small groups of bounded size: one exchange and one sort, then the groups are read off
    the sorted rows one at a time, without starting Python work for each.
    """
    rest = [c for c in df.columns if c not in keys]
    width = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * len(arrow)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow
            )

        key, members, made = None, [], []
        for batch in batches:
            for row in _rows(batch):
                if row[:width] != key:
                    if members:
                        made += fn(key, members)
                    key, members = row[:width], []
                    if len(made) >= 10_000:
                        yield out(made)
                        made = []
                members.append(row[width:])
        if members:
            made += fn(key, members)
        yield out(made)

    dealt = df.select(*keys, *rest).repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, schema)
