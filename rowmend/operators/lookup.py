"""Reading only where wanted keys can be: a few ranges of the first key column, pushed to the scan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmend.operators.compare import any_of, rows_of_keys
from rowmend.operators.ranks import quoted

# Ranges a condition consists of at most; a scan checks each row group, or an index, against all of them.
MOST_RANGES = 200
# Types whose order and equality a scan shares with Spark. Fractions are left out for NaN and -0.0.
_ORDERED = (T.IntegralType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType)


@dataclass(frozen=True)
class KeyRanges:
    """Values of one column between which all wanted keys lie, ascending and disjoint."""

    column: str
    dtype: T.DataType
    bounds: tuple[tuple[object, object], ...]
    nulls: bool

    def condition(self) -> Column:
        key = F.col(quoted([self.column])[0])
        value = lambda v: F.lit(v).cast(self.dtype)
        parts = [key == value(a) if a == b else (key >= value(a)) & (key <= value(b)) for a, b in self.bounds]
        return any_of([*parts, *([key.isNull()] if self.nulls else [])])


def covering_ranges(wanted: DataFrame, keys: Sequence[str], most: int = MOST_RANGES) -> KeyRanges | None:
    """Ranges that cover the first column of the wanted keys; None where its type has no common order.

    The keys are sorted into ``most`` parts across the cluster and each part gives its
    least and its greatest value, so parts far from each other leave out what lies between
    them. At most that many rows reach the driver.
    """
    name, dtype = keys[0], wanted.schema[keys[0]].dataType
    if not isinstance(dtype, _ORDERED):
        return None
    key = F.col(quoted([name])[0])
    held = wanted.select(key.alias("k")).where("k IS NOT NULL").distinct()
    parts = held.repartitionByRange(most, "k").groupBy(F.spark_partition_id().alias("part"))
    bounds = parts.agg(F.min("k").alias("a"), F.max("k").alias("b")).orderBy("a").collect()
    nulls = not wanted.where(key.isNull()).isEmpty()
    return KeyRanges(name, dtype, tuple((r["a"], r["b"]) for r in bounds), nulls)


def within(df: DataFrame, ranges: KeyRanges | None) -> DataFrame:
    """The rows inside the ranges. Of a column of another type all rows: a cast would not reach the scan."""
    if ranges is None or df.schema[ranges.column].dataType != ranges.dtype:
        return df
    return df.where(ranges.condition())


def lookup_by_ranges(
    df: DataFrame, wanted: DataFrame, keys: Sequence[str], null_safe: bool = True, ranges: KeyRanges | None = None
) -> DataFrame:
    """The rows of the wanted keys. The scan gets the ranges that cover them, the semi join makes it exact."""
    ranges = ranges or covering_ranges(wanted, keys)
    return rows_of_keys(within(df, ranges), wanted, keys, null_safe)
