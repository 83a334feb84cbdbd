"""Key columns: whether they identify rows, which keys are hot, and occurrence numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmend.operators.ranks import number_in_hot_key, number_in_key, quoted
from rowmend.sources.storage import materialize

OCCURRENCE = "occurrence"
# A key with about this many rows or more is spread over tasks instead of going to one.
HOT_ROWS = 1_000_000
# Sampled rows a key of HOT_ROWS rows is expected to show; half of them make it hot.
SAMPLE_HITS = 200
# A task sorts about this many rows at most, so that it need not spill them.
TASK_ROWS = 500_000


def any_null(keys: Sequence[str]) -> Column:
    found = F.lit(False)
    for key in quoted(keys):
        found = found | F.col(key).isNull()
    return found


def key_audit(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that cannot identify a row: ``(keys, row_cnt, has_null)``."""
    counted = df.groupBy(*quoted(keys)).agg(F.count("*").alias("row_cnt"))
    return counted.withColumn("has_null", any_null(keys)).where("row_cnt > 1 OR has_null")


def same_keys(keys: Sequence[str], left: str, right: str, null_safe: bool = True) -> Column:
    """Join condition between two aliased tables."""
    condition = None
    for k in keys:
        a, b = F.col(f"{left}.`{k}`"), F.col(f"{right}.`{k}`")
        part = a.eqNullSafe(b) if null_safe else a == b
        condition = part if condition is None else condition & part
    return condition


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left", null_safe: bool = True) -> DataFrame:
    """Columns of ``left`` with the other columns of ``right``, joined by key; NULL keys meet unless told otherwise."""
    condition = same_keys(keys, "l", "r", null_safe)
    others = [] if how in ("left_semi", "left_anti") else [F.col(f"r.`{c}`") for c in right.columns if c not in keys]
    return left.alias("l").join(right.alias("r"), condition, how).select(*[F.col(f"l.`{c}`") for c in left.columns], *others)


def primary_key_audit(src: DataFrame, tgt: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Whether the keys identify rows on each side: ``(side, row_cnt, repeated_cnt, null_cnt, is_key)``.

    ``repeated_cnt`` counts rows of keys that occur more than once, ``null_cnt`` rows with a NULL in the key.
    """
    sides = [df.select(*quoted(keys), F.lit(name).alias("side")) for name, df in (("src", src), ("tgt", tgt))]
    counted = sides[0].unionByName(sides[1]).groupBy("side", *quoted(keys)).agg(F.count("*").alias("_n"))
    found = counted.withColumn("_null", any_null(keys)).groupBy("side").agg(
        F.sum("_n").alias("row_cnt"),
        F.sum(F.when(F.col("_n") > 1, F.col("_n")).otherwise(0)).alias("repeated_cnt"),
        F.sum(F.when(F.col("_null"), F.col("_n")).otherwise(0)).alias("null_cnt"),
    )
    return found.withColumn("is_key", (F.col("repeated_cnt") == 0) & (F.col("null_cnt") == 0))


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int | None = HOT_ROWS) -> DataFrame | None:
    """Keys that hold about ``hot_rows`` rows or more, or None.

    They are found in a sample of the key columns, since the answer only decides how
    the work is laid out: a key on the wrong side of the line gets the same result,
    from one task or from many. The list is written down, so that every part of a
    plan splits the table alike. ``hot_rows=None`` says that there are none, and nothing
    is read.
    """
    return hot_keys_and_rows(df, keys, hot_rows)[0]


def hot_keys_and_rows(df: DataFrame, keys: Sequence[str], hot_rows: int | None = HOT_ROWS) -> tuple[DataFrame | None, int]:
    """The hot keys, and about how many rows there are in all, as far as the sample tells; 0 without a sample."""
    if hot_rows is None:
        return None, 0
    fraction = min(1.0, SAMPLE_HITS / hot_rows)
    needed = hot_rows * fraction / 2
    sampled = df.select(*quoted(keys)).sample(fraction, seed=1)
    counted = sampled.groupBy(*quoted(keys)).agg(F.count("*").alias("_hits")).persist()
    try:
        hits, most = counted.agg(F.coalesce(F.sum("_hits"), F.lit(0)), F.coalesce(F.max("_hits"), F.lit(0))).first()
        found = counted.where(F.col("_hits") > needed).select(*quoted(keys))
        return materialize(found, "hot-keys") if most > needed else None, int(hits / fraction)
    finally:
        counted.unpersist()


def by_key(df: DataFrame, keys: Sequence[str], row_cnt: int = 0) -> DataFrame:
    """The rows of a key in one partition, of which there are more than usual if each would hold more than TASK_ROWS rows."""
    needed = -(-row_cnt // TASK_ROWS)
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(needed, *quoted(keys)) if needed > usual else df.repartition(*quoted(keys))


def split_hot(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The rows of all other keys, and the rows of the hot ones."""
    condition = same_keys(keys, "rows", "hot")
    rows, listed = df.alias("rows"), hot.alias("hot")
    return rows.join(listed, condition, "left_anti"), rows.join(listed, condition, "left_semi")


def number_occurrences(
    df: DataFrame, keys: Sequence[str], hot_rows: int | None = HOT_ROWS, name: str = OCCURRENCE
) -> DataFrame:
    """The table with an occurrence number from 1 inside each key, in the order of its other columns."""
    order = [c for c in df.columns if c not in keys]
    hot = hot_keys(df, keys, hot_rows)
    if hot is None:
        return number_in_key(df, keys, order or keys, name)
    usual, large = split_hot(df, hot, keys)
    return number_in_key(usual, keys, order or keys, name).unionByName(number_in_hot_key(large, keys, order, name))
