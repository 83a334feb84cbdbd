"""Intermediate tables on the storage that all executors share."""

from __future__ import annotations

import contextlib
import contextvars
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# The folder opened by working_tables(), of each thread by itself: tasks run beside each other.
_OPEN: contextvars.ContextVar[str | None] = contextvars.ContextVar("rowmend_working_folder", default=None)


def work_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a session running in one local process may do without: it uses its own
    warehouse folder. On a cluster a missing setting is an error, as no executor
    could read another machine's files.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")


def _folder(spark: SparkSession, path: str):
    """The file system of a path, and the path, as the JVM knows them."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def run_dir(spark: SparkSession) -> str:
    """This application's own folder below the working folder; it goes when the application ends."""
    path = f"{work_dir(spark)}/rowmend/{spark.sparkContext.applicationId}"
    files, place = _folder(spark, path)
    if not files.exists(place):
        files.mkdirs(place)
        files.deleteOnExit(place)
    return path


def new_path(spark: SparkSession, label: str) -> str:
    return f"{_OPEN.get() or run_dir(spark)}/{label}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def working_tables(spark: SparkSession, label: str) -> Iterator[str]:
    """Tables written meanwhile by this thread go to a folder that is removed at the end, also after an error."""
    path = new_path(spark, label)
    opened = _OPEN.set(path)
    try:
        yield path
    finally:
        _OPEN.reset(opened)
        files, place = _folder(spark, path)
        files.delete(place, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """The table, written once and read back.

    What is read again later is computed once, a lost executor costs no
    recomputation, and the planner knows the real size: a small table is broadcast
    by Spark's own threshold, a large one is shuffled.
    """
    return stored(df, new_path(df.sparkSession, label))


def stored(df: DataFrame, path: str) -> DataFrame:
    """The table, written to a place of its own and read back."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
