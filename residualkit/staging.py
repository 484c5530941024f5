"""Written intermediate tables.

A staged table is a Parquet table below the folder the session names in
``spark.checkpoint.dir``. It cuts lineage in a way that survives the loss of
executors: the rows, and any partition numbers stored with them, are values on
shared storage and are never recomputed. Reading one back keeps column pruning
and filter pushdown, which an RDD checkpoint does not.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import AbstractContextManager, contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECKPOINT_CONF = "spark.checkpoint.dir"


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Only a local session without one gets a temporary folder. On a cluster a
    missing setting is an error, because a machine-local folder would not be
    visible to the executors.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    root = context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors can reach")
    root = tempfile.mkdtemp(prefix="residualkit-")
    context.setCheckpointDir(root)
    return context.getCheckpointDir().rstrip("/")


_scope: ContextVar[str] = ContextVar("staging_scope", default="")


def staged_folder(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/residualkit/{spark.sparkContext.applicationId}{_scope.get()}"


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are deleted at the end, and only they. Write all results before it ends."""
    token = _scope.set(f"{_scope.get()}/scope-{uuid.uuid4().hex}")
    try:
        yield
    finally:
        clear_staged(spark)
        _scope.reset(token)


def size_columns(schema: T.StructType) -> list[Column]:
    """Aggregates that together give the unpacked size of a table, see :func:`size_of`."""
    texts = [F.octet_length(F.col(f"`{f.name}`")) for f in schema.fields if isinstance(f.dataType, T.StringType)]
    arrays = [F.size(F.col(f"`{f.name}`")) * 9 for f in schema.fields if isinstance(f.dataType, T.ArrayType)]
    varying = [F.sum(c).alias(f"v{i}") for i, c in enumerate([*texts, *arrays])]
    return [F.count(F.lit(1)).alias("n"), *varying]


def size_of(values: Sequence[int | None], width: int) -> int:
    """Bytes of a table of ``width`` columns, from the values of its :func:`size_columns`."""
    rows, *varying = values
    return rows * (16 + 8 * width) + sum(v or 0 for v in varying)


def stage_measured(df: DataFrame, label: str, partition_by: str | None = None) -> tuple[DataFrame, int]:
    """Stage a table and learn its unpacked size while writing it.

    A task that runs twice is counted twice, so the size is an upper bound.
    """
    seen = Observation()
    staged = stage(df.observe(seen, *size_columns(df.schema)), label, partition_by)
    return staged, size_of(list(seen.get.values()), len(df.columns))


def new_path(spark: SparkSession, label: str) -> str:
    """A folder for one staged table."""
    return f"{staged_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, partition_by: str | None = None, path: str | None = None, **options: str) -> DataFrame:
    """Write ``df`` below the checkpoint folder and return a scan of what was written.

    With ``partition_by`` later filters on that column read only their own folders. ``path`` is a :func:`new_path`
    that the caller will delete; ``options`` are those of the writer.
    """
    spark = df.sparkSession
    path = path or new_path(spark, label)
    writer = df.write.mode("errorifexists").options(**options)
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    if partition_by is None:
        return staged
    return staged.select(*[f"`{c}`" for c in df.columns])


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def session_conf(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """Set a session setting for a while."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def arrow_rows(spark: SparkSession, rows: int) -> AbstractContextManager[None]:
    """Hand at most ``rows`` rows at a time to Python, so that a batch of long texts stays small."""
    return session_conf(spark, BATCH_ROWS, str(rows))


def clear_staged(spark: SparkSession) -> bool:
    """Delete what this application, or the current scope, staged. Call once its results are written."""
    return delete_staged(spark, staged_folder(spark))


def delete_staged(spark: SparkSession, path: str) -> bool:
    """Delete a folder below this application's staging folder; no other folder is touched."""
    if not path.startswith(f"{checkpoint_root(spark)}/residualkit/{spark.sparkContext.applicationId}"):
        raise ValueError(f"{path} is not in the staging folder")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.delete(folder, True)
