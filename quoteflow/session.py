"""Session settings and the shared folder for durable intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every quoteflow job relies on; all of them are runtime SQL settings.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    # A repeated JSON key keeps its last value instead of making the message malformed.
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Number of tasks that input files are dealt over before they are parsed; chosen by their size if not set.
SPREAD = "spark.quoteflow.spread"
# So many bytes of a compressed table are seconds of parsing; one row group may hold a hundred times as many.
_TASK_BYTES = 2 << 20
# Files of this size in all have more row groups than any cluster has cores.
_MANY_BYTES = 32 << 30


def prepare(spark: SparkSession) -> SparkSession:
    for name, value in REQUIRED.items():
        spark.conf.set(name, value)
    return spark


def local(cpus: int | str = "*", app: str = "quoteflow") -> SparkSession:
    """A single-machine session for tests and the bench."""
    partitions = str(cpus) if str(cpus).isdigit() else "8"
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("QUOTEFLOW_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", partitions)
        .config(SPREAD, partitions)
        .config("spark.sql.adaptive.enabled", "true")
        # Records a Python call site with every column expression; costs more than building it.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Only a local session may do without the setting: it then uses its checkpoint folder, or a new
    temporary one. On a cluster a machine-local path would be lost with its machine, so a missing
    setting is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    # The setting itself cannot be changed once a session runs.
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quoteflow-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def _own_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/quoteflow/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{_own_dir(spark)}/{label}-{uuid.uuid4().hex}"


def clean(spark: SparkSession) -> None:
    """Delete the intermediate tables this application has written; results not yet read go with them."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(_own_dir(spark))
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def tasks(spark: SparkSession, size: int) -> int:
    """How many tasks parse files of ``size`` bytes: ``spark.quoteflow.spread``, else three a core or more by size."""
    configured = spark.conf.get(SPREAD, None)
    return int(configured) if configured else max(3 * spark.sparkContext.defaultParallelism, -(-size // _TASK_BYTES))


def spread(df: DataFrame, size: int) -> DataFrame:
    """Deal the rows of a scan of files of ``size`` bytes over so many tasks (:func:`tasks`).

    A row group is read by one task, and files of few row groups starve CPU-heavy parsing: it takes
    50 times as long as to read and deal a row. A very large table needs no shuffle before it is parsed.
    """
    spark = df.sparkSession
    if size > _MANY_BYTES and not spark.conf.get(SPREAD, None):
        return df
    return df.repartition(tasks(spark, size))


def durable(df: DataFrame, label: str, spark: SparkSession | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors.

    Parquet rather than ``checkpoint()`` so that later passes read only the columns they use. ``spark``
    is the session that reads it, if not that of ``df``.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return (spark or df.sparkSession).read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables written by :func:`durable` that nothing reads any more."""
    for df in tables:
        files = df.inputFiles()
        if files:
            path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
