"""Numbering rows over the whole table, or inside keys of any size.

No window here runs over more rows than one sorted partition holds: the table is
sorted across the cluster, each row gets its place inside its partition, and the
partitions' sizes, one row each, give the offsets.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmend.sources.storage import materialize

# monotonically_increasing_id() holds the partition above bit 33, the row's place below.
PLACE_BITS = 33
# Copies of one row are put back in steps of this size, so that no task emits them all.
COPY_STEP = 100_000

_SIGNS = "_signs"
_PART, _PLACE, _BEFORE, _COPIES, _END, _START, _STEP, _ROWS = (
    "_part",
    "_place",
    "_before",
    "_copies",
    "_end",
    "_start",
    "_step",
    "_rows",
)


def quoted(names: Sequence[str]) -> list[str]:
    """Column names as expressions, whatever characters they have."""
    return ["`" + n.replace("`", "``") + "`" for n in names]


def sorted_places(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The table in cluster-wide order with ``_part`` and ``_place`` of each row.

    The places depend on where the sort happened to cut the table, so they are
    written down before anything is computed from them.
    """
    placed = df.orderBy(*quoted(order)).withColumn(_PLACE, F.monotonically_increasing_id())
    stored = materialize(placed, "sorted")
    return stored.withColumn(_PART, F.shiftright(_PLACE, PLACE_BITS)).withColumn(
        _PLACE, F.col(_PLACE) - F.shiftleft(F.shiftright(_PLACE, PLACE_BITS), PLACE_BITS)
    )


def global_rank(df: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """The table with each row's place, from 1, in the order of all rows.

    ``order`` must tell any two rows apart.
    """
    placed = sorted_places(df, order)
    sizes = placed.groupBy(_PART).agg(F.count("*").alias(_ROWS))
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    # One row per sort partition, however large the table: small enough for one window and a broadcast.
    offsets = sizes.select(_PART, F.coalesce(F.sum(_ROWS).over(earlier), F.lit(0)).alias(_BEFORE))
    return placed.join(F.broadcast(offsets), _PART).select(
        *quoted(df.columns), (F.col(_BEFORE) + F.col(_PLACE) + 1).alias(name)
    )


def assign_batches(keys: DataFrame, key_columns: Sequence[str], size: int = 3000) -> DataFrame:
    """Distinct keys with their batch number: ``size`` keys a batch, in key order."""
    if size < 1:
        raise ValueError("a batch holds at least one key")
    distinct = keys.select(*quoted(key_columns)).distinct()
    ranked = global_rank(distinct, key_columns, "_position")
    batch = F.expr(f"(_position - 1) div {int(size)} + 1")
    return ranked.select(*quoted(key_columns), batch.alias("batch"))


def number_in_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Occurrence number inside each key by a window: for keys of moderate size."""
    window = Window.partitionBy(*quoted(keys)).orderBy(*quoted(order))
    return df.withColumn(name, F.row_number().over(window).cast("bigint"))


def _zero_signs(value: Column, dtype: T.DataType) -> list[Column]:
    """Whether each fraction in a value is a negative zero."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        # Functions of numbers take both zeros for one; a text is made of zeros only.
        return [F.when(value == 0, value.cast("string").startswith("-")).otherwise(F.lit(False))]
    if isinstance(dtype, T.StructType):
        return [s for f in dtype.fields for s in _zero_signs(value.getField(f.name), f.dataType)]
    if re.search("double|float", dtype.simpleString()):
        return [F.coalesce(value.cast("string").contains("-0.0"), F.lit(False))]
    return []


def number_in_hot_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """The same numbers when a single key may hold more rows than a task should.

    Equal rows are counted together first, so copies travel as one row. What is left
    is sorted across the cluster; a key then stretches over many partitions and is
    numbered in pieces, each piece starting after the earlier ones. ``order`` and
    ``keys`` together must be all columns, so that copies are interchangeable. Grouping
    makes 0.0 of -0.0, so rows are grouped by the signs of their zeros as well, and columns
    with fractions are carried beside.
    """
    columns = df.columns
    signs = {f.name: _zero_signs(F.col(q), f.dataType) for f, q in zip(df.schema, quoted(columns))}
    signed = [c for c, found in signs.items() if found]
    negative = F.concat(*[F.when(s, F.lit("-")).otherwise(F.lit("+")) for c in signed for s in signs[c]]) if signed else F.lit("")
    carried = F.first(F.struct(*[F.col(q) for q in quoted(signed)])).alias("_own") if signed else F.lit(None).alias("_own")
    distinct = df.withColumn(_SIGNS, negative).groupBy(*quoted(columns), _SIGNS).agg(F.count("*").alias(_COPIES), carried)
    distinct = distinct.select(*[F.col("_own")[c].alias(c) if c in signed else F.col(q) for c, q in zip(columns, quoted(columns))], _COPIES)
    placed = sorted_places(distinct, [*keys, *order])

    pieces = placed.groupBy(_PART, *quoted(keys)).agg(F.sum(_COPIES).alias(_ROWS))
    earlier = Window.partitionBy(*quoted(keys)).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select(
        F.col(_PART).alias("_p"),
        *[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)],
        F.coalesce(F.sum(_ROWS).over(earlier), F.lit(0)).alias(_BEFORE),
    )
    inside = (
        Window.partitionBy(_PART, *quoted(keys)).orderBy(_PLACE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    numbered = placed.withColumn(_END, F.sum(_COPIES).over(inside))
    same_piece = F.col(_PART) == F.col("_p")
    for i, k in enumerate(keys):
        same_piece = same_piece & F.col(f"`{k}`").eqNullSafe(F.col(f"_k{i}"))
    first = (F.col(_BEFORE) + F.col(_END) - F.col(_COPIES)).alias(_START)
    runs = numbered.join(starts, same_piece).select(*quoted(columns), _COPIES, first)

    steps = runs.withColumn(_STEP, F.explode(F.expr(f"sequence(0L, ({_COPIES} - 1) div {COPY_STEP}L)")))
    spread = steps.repartition(F.col(_START), F.col(_STEP))
    upto = f"least({_COPIES}, ({_STEP} + 1) * {COPY_STEP}L)"
    return spread.select(
        *quoted(columns),
        F.explode(F.expr(f"sequence({_START} + {_STEP} * {COPY_STEP}L + 1, {_START} + {upto})")).alias(name),
    )
