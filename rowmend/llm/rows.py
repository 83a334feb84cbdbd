"""Decisions about documents carried back to their rows, whatever other columns these have.

A row is known by its doc_id, null or not, and the hash of its text. Rows alike in both are
interchangeable.
"""

from __future__ import annotations

import contextlib
import ctypes
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_AT_ONCE = 500  # documents that a Python worker has in hand as objects
BYTES_AT_ONCE = 4 << 20  # of text in them, unless a single document has more
BROADCAST_ROWS = 1_000_000  # decisions, about 24 bytes each, that go to all executors; more are shuffled


def small(parts: Iterator[pa.RecordBatch], most: int = ROWS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of a few documents, so that a worker never holds a whole batch as Python objects."""
    for part in parts:
        held = np.arange(part.num_rows + 1)
        if "text" in part.schema.names:
            sizes = pc.fill_null(pc.binary_length(part.column("text")), 0).to_numpy(zero_copy_only=False)
            held = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        first = 0
        while first < part.num_rows:
            within = int(np.searchsorted(held, held[first] + BYTES_AT_ONCE, "right")) - 1 if "text" in part.schema.names else part.num_rows
            last = min(max(within, first + 1), first + most, part.num_rows)
            yield part.slice(first, last - first)
            first = last


@contextlib.contextmanager
def small_batches(spark: SparkSession, most: int) -> Iterator[None]:
    """What is run meanwhile hands at most so many rows at once to Python: both sides hold whole batches."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(most, int(before)) if int(before) > 0 else most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


_KEPT: dict[str, dict] = {}


def release() -> None:
    """Gives memory that this worker process has freed back to the system; Arrow and the C library keep it otherwise."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        getattr(ctypes.CDLL(None), "malloc_trim", lambda kept: None)(0)


def worker_cache(owner: str) -> dict:
    """What this worker process keeps for an operator between tasks. One that turns to another operator drops the rest."""
    others = [o for o in _KEPT if o != owner]
    for other in others:
        _KEPT.pop(other).clear()
    if others:
        release()
    return _KEPT.setdefault(owner, {})


def text_hash() -> Column:
    return F.xxhash64("text").alias("text_hash")


def row_key(doc_id: str = "doc_id", hashed: str = "text_hash") -> Column:
    """The key of a decision, without nulls."""
    return F.struct(F.coalesce(F.col(doc_id), F.lit(0)).alias("id"), F.col(doc_id).isNull().alias("none"), F.col(hashed).alias("text")).alias("key")


def packed(docs: DataFrame) -> DataFrame:
    """Each row as one column beside its key, so that no name can clash."""
    key = F.struct(F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("none"), F.xxhash64("text").alias("text"))
    return docs.select(F.struct("*").alias("row"), key.alias("key"))


def sized(decisions: DataFrame) -> DataFrame:
    """Decisions to join with, broadcast if there are few."""
    return F.broadcast(decisions) if decisions.count() <= BROADCAST_ROWS else decisions


def without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The documents whose key is not in ``keys``."""
    return packed(docs).join(sized(keys), "key", "left_anti").select("row.*")


def repeated(docs: DataFrame, copies: DataFrame) -> DataFrame:
    """Each document as often as ``copies`` (key, copies, unique by key) says; documents not named there go.

    Rows alike share their copies, so they are reduced to one first, if there are any.
    """
    rows = packed(docs)
    twins = rows.groupBy("key").count().where("count > 1").select("key")
    if not twins.isEmpty():
        alike = sized(twins)
        rows = rows.join(alike, "key", "left_anti").union(rows.join(alike, "key", "left_semi").dropDuplicates(["key"]))
    taken = rows.join(sized(copies.where("copies > 0")), "key").select("row", F.explode(F.sequence(F.lit(1), "copies")))
    return taken.select("row.*")
