"""Scans. Columns and predicates given here end up in the scan itself."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmend.functions.columns import ordered_unique
from rowmend.sources.jdbc import (
    JdbcTable,
    bounds_query,
    connection_options,
    cut_predicates,
    cuts_query,
    limited_query,
    load_query,
    table_options,
)
from rowmend.sources.versions import VersionedTable, open_version


@dataclass(frozen=True)
class FileTable:
    """A table in files, by path. A known schema saves the job that reads it from the files."""

    path: str
    format: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)
    schema: T.StructType | str | None = None


@dataclass(frozen=True)
class CatalogTable:
    """A table the session's catalog knows by name."""

    name: str


@dataclass(frozen=True)
class SourceTable:
    """A table behind a data source that the session knows by name, such as one of the user's own.

    Stores without JDBC are read by a class of Spark's Python data source interface, made known by
    ``spark.dataSource.register``: its partitions are read in parallel, and it is offered the filters.
    """

    format: str
    options: dict[str, str] = field(default_factory=dict)


RANGED_TYPES = (T.IntegralType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType)

TableSpec = FileTable | CatalogTable | JdbcTable | VersionedTable | SourceTable


def _open(spark: SparkSession, spec: TableSpec) -> DataFrame:
    if isinstance(spec, FileTable):
        reader = spark.read.schema(spec.schema) if spec.schema else spark.read
        return reader.format(spec.format).options(**spec.options).load(spec.path)
    if isinstance(spec, CatalogTable):
        return spark.table(spec.name)
    if isinstance(spec, VersionedTable):
        return open_version(spark, spec)
    if isinstance(spec, SourceTable):
        return spark.read.format(spec.format).options(**spec.options).load()
    return spark.read.format("jdbc").options(**table_options(spec)).load()


def _narrow(df: DataFrame, columns: Sequence[str] | None, predicate: Column | str | None) -> DataFrame:
    if predicate is not None:
        df = df.where(predicate)
    if columns is not None:
        df = df.select(*[f"`{c}`" for c in ordered_unique(columns)])
    return df


def scan_table(
    spark: SparkSession,
    spec: TableSpec,
    columns: Sequence[str] | None = None,
    predicate: Column | str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Named columns of a table under a predicate."""
    if limit is not None and isinstance(spec, JdbcTable) and columns is not None and not isinstance(predicate, Column):
        query = limited_query(spec, columns, limit, predicate)
        return spark.read.format("jdbc").options(**connection_options(spec), query=query).load()
    df = _narrow(_open(spark, spec), columns, predicate)
    return df if limit is None else df.limit(limit)


def slice_predicates(column: str, lower: int, upper: int, slices: int) -> list[str]:
    """Conditions that split a table by key range.

    Each row meets exactly one of them: the first slice also takes NULLs and all
    below ``lower``, the last one all above ``upper``.
    """
    if slices < 1 or upper < lower:
        raise ValueError("need at least one slice and lower <= upper")
    width = max(1, -(-(upper - lower + 1) // slices))
    cuts = [c for c in (lower + width * i for i in range(1, slices)) if c <= upper]
    if not cuts:
        return ["1 = 1"]
    first = f"{column} < {cuts[0]} OR {column} IS NULL"
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [first, *inner, f"{column} >= {cuts[-1]}"]


def scan_partitioned(
    spark: SparkSession,
    spec: TableSpec,
    column: str,
    lower: int,
    upper: int,
    slices: int,
    columns: Sequence[str] | None = None,
    predicate: Column | str | None = None,
) -> DataFrame:
    """The table read in parallel slices.

    A database is asked for one disjoint key range per task. Files are split by the
    scan itself, so for them the slicing arguments change nothing.
    """
    if isinstance(spec, JdbcTable):
        options = table_options(spec, column, lower, upper, slices)
        df = spark.read.format("jdbc").options(**options).load()
    else:
        df = _open(spark, spec)
    return _narrow(df, columns, predicate)


def scan_slices(
    spark: SparkSession, spec: TableSpec, predicates: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """The rows that meet one of several disjoint conditions, e.g. key ranges of text keys.

    A database is asked for one condition per task.
    """
    if isinstance(spec, JdbcTable):
        options = connection_options(spec)
        df = spark.read.jdbc(options.pop("url"), spec.qualified, predicates=list(predicates), properties=options)
        return _narrow(df, columns, None)
    return _narrow(_open(spark, spec), columns, " OR ".join(f"({p})" for p in predicates))


def scan_by_key(spark: SparkSession, spec: JdbcTable, column: str, slices: int) -> DataFrame:
    """A database table in ``slices`` parallel ranges between the least and the greatest key.

    The database itself finds the two bounds; for keys without ranges (text) it finds the
    cuts between parts of equal size. Empty tables are read by one task.
    """
    whole = _open(spark, spec)
    if slices < 2:
        return whole
    if not isinstance(whole.schema[column].dataType, RANGED_TYPES):
        # One row per slice; the parts' numbers keep the database's own order of texts.
        cuts = sorted(load_query(spark, spec, cuts_query(spec, column, slices)).collect(), key=lambda r: r[0])
        return scan_slices(spark, spec, cut_predicates(spec, column, [str(r[1]) for r in cuts]))
    low, high = load_query(spark, spec, bounds_query(spec, column)).first()
    return whole if low is None else scan_partitioned(spark, spec, column, low, high, slices)


def slice_counts(df: DataFrame, column: str, lower: int, upper: int, slices: int) -> DataFrame:
    """Rows per slice of ``slice_predicates``: ``(slice, row_cnt)`` in one pass."""
    conditions = slice_predicates(column, lower, upper, slices)
    number = F.coalesce(*[F.when(F.expr(c), F.lit(i)) for i, c in enumerate(conditions)])
    return df.groupBy(number.alias("slice")).agg(F.count("*").alias("row_cnt"))


def first_rows(df: DataFrame, n: int, order: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows; with an order, each task keeps only its own first ``n``."""
    return (df.orderBy(*order) if order else df).limit(n)


def row_count(df: DataFrame, predicate: Column | str | None = None) -> DataFrame:
    return _narrow(df, None, predicate).agg(F.count("*").alias("row_cnt"))


def table_metadata(df: DataFrame, counts: bool = False) -> DataFrame:
    """``(position, name, type)`` per column, from the schema alone.

    With ``counts`` also ``non_null_cnt``, from one pass over the table.
    """
    fields = df.schema.fields
    if counts:
        base = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"n{i}") for i, f in enumerate(fields)])
    else:
        base = df.sparkSession.range(1)
    entries = []
    for i, f in enumerate(fields):
        entry = [F.lit(i + 1).alias("position"), F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type")]
        entries.append(F.struct(*entry, *([F.col(f"n{i}").alias("non_null_cnt")] if counts else [])))
    return base.select(F.inline(F.array(*entries)))


def schema_diff(src: DataFrame, tgt: DataFrame, counts: bool = False) -> DataFrame:
    """Columns on one side only or of differing type: ``(name, difference, src_type, tgt_type)``.

    With ``counts`` also ``src_filled`` and ``tgt_filled``, the rows that hold a value there.
    """

    def side(df: DataFrame, name: str) -> DataFrame:
        filled = [F.col("non_null_cnt").alias(f"{name}_filled")] if counts else []
        return table_metadata(df, counts).select("name", F.col("type").alias(f"{name}_type"), *filled)

    kind = (
        F.when(F.col("tgt_type").isNull(), "src_only")
        .when(F.col("src_type").isNull(), "tgt_only")
        .otherwise("type_differs")
    )
    filled = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("src_filled", "tgt_filled")] if counts else []
    return (
        side(src, "src")
        .join(side(tgt, "tgt"), "name", "full_outer")
        .where(~F.col("src_type").eqNullSafe(F.col("tgt_type")))
        .select("name", kind.alias("difference"), "src_type", "tgt_type", *filled)
    )
