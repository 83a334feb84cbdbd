"""Slices of equal work over keys of several columns.

A cut is a whole key, and a slice is everything from one cut up to the next in the order of
the columns: ``a > x OR (a = x AND b >= y)``. So a first column with few values, or with most
rows under one value, is cut inside that value by the next one. NULLs come before all values,
as a database's lowest; every row is in exactly one slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmend.functions.literals import column_name, sql_literal
from rowmend.operators.ranks import global_rank, quoted
from rowmend.sources.jdbc import JdbcTable, load_query, tuple_cuts_query
from rowmend.sources.tables import TableSpec, scan_by_key, scan_slices, scan_table

PART = "part"


def equal_cuts(df: DataFrame, keys: Sequence[str], slices: int) -> DataFrame:
    """``(part, keys)``: the least key of each of ``slices`` parts whose numbers of rows differ by one at most.

    Only the key columns are sorted. Parts that begin with the same key, because it repeats
    more often than a part has rows, give one cut.
    """
    if slices < 1:
        raise ValueError("at least one slice")
    ranked = global_rank(df.select(*quoted(keys)), keys, "_position")
    total = ranked.count()
    starts = sorted({part * (total // slices) + min(part, total % slices) + 1 for part in range(min(slices, total))})
    chosen = ranked.where(F.col("_position").isin(starts) if starts else F.lit(False))
    # One row per slice.
    return chosen.groupBy(*quoted(keys)).agg(F.min("_position").alias(PART)).select(PART, *quoted(keys))


def _before(names: Sequence[str], cut: Sequence[str]) -> str:
    """Condition of all keys before a cut; NULL is before every value."""
    name, value = names[0], cut[0]
    rest = _before(names[1:], cut[1:]) if len(names) > 1 else None
    if value == "NULL":
        return f"{name} IS NULL AND ({rest})" if rest else "1 = 0"
    less = f"{name} < {value} OR {name} IS NULL"
    return f"{less} OR ({name} = {value} AND ({rest}))" if rest else less


def _from(names: Sequence[str], cut: Sequence[str]) -> str:
    """Condition of the cut itself and all keys behind it."""
    name, value = names[0], cut[0]
    rest = _from(names[1:], cut[1:]) if len(names) > 1 else None
    if value == "NULL":
        return f"{name} IS NOT NULL OR ({rest})" if rest else "1 = 1"
    return f"{name} > {value} OR ({name} = {value} AND ({rest}))" if rest else f"{name} >= {value}"


def slice_conditions(cuts: DataFrame, keys: Sequence[str], dialect: str | None = None) -> list[str]:
    """Disjoint conditions between the cuts, in their order; the first slice takes all that lies before."""
    types = {f.name: f.dataType for f in cuts.schema.fields}
    texts = [sql_literal(F.col(q), types[k], dialect).alias(f"k{i}") for i, (k, q) in enumerate(zip(keys, quoted(keys)))]
    # As many rows as there are slices.
    listed = [tuple(r)[1:] for r in sorted(cuts.select(PART, *texts).collect(), key=lambda r: r[0])]
    inner = list(dict.fromkeys(listed))[1:]
    if not inner:
        return ["1 = 1"]
    names = [column_name(k, dialect) for k in keys]
    between = [f"({_from(names, a)}) AND ({_before(names, b)})" for a, b in zip(inner, inner[1:])]
    return [_before(names, inner[0]), *between, _from(names, inner[-1])]


def count_slices(df: DataFrame, conditions: Sequence[str]) -> DataFrame:
    """``(slice, row_cnt, hits)`` in one pass; ``hits`` is the largest number of conditions that one of its rows meets."""
    met = [F.coalesce(F.expr(c), F.lit(False)) for c in conditions]
    number = F.coalesce(*[F.when(m, F.lit(i)) for i, m in enumerate(met)])
    hits = F.aggregate(F.array(*[m.cast("int") for m in met]), F.lit(0), lambda a, x: a + x)
    return df.select(number.alias("slice"), hits.alias("hit")).groupBy("slice").agg(F.count("*").alias("row_cnt"), F.max("hit").alias("hits"))


def scan_by_keys(
    spark: SparkSession, spec: TableSpec, keys: Sequence[str], slices: int, columns: Sequence[str] | None = None
) -> DataFrame:
    """The table in ``slices`` parallel slices of equal numbers of rows by its whole key.

    A database numbers its own keys and answers each slice by a condition on its key, for
    which it has an index. Files are split by the scan itself.
    """
    if not isinstance(spec, JdbcTable) or slices < 2:
        return scan_table(spark, spec, columns)
    if len(keys) == 1 and columns is None:
        return scan_by_key(spark, spec, keys[0], slices)
    found = load_query(spark, spec, tuple_cuts_query(spec, keys, slices))
    cuts = found.toDF(PART, *keys)
    return scan_slices(spark, spec, slice_conditions(cuts, keys, spec.dialect), columns)
