"""Reader options and catalog queries for tables in relational databases.

Spark's JDBC source owns connections, retries and type mapping; this module only
builds what it is told.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from rowmend.sources.dialects import dialect_of

FETCH_ROWS = 10_000
RUN_ID = "run_id"  # column of a staging table


@dataclass(frozen=True)
class JdbcTable:
    dialect: str
    host: str
    port: int
    database: str
    table: str
    user: str
    password: str = field(repr=False)
    schema: str | None = None

    def __post_init__(self):
        dialect_of(self.dialect)

    @property
    def qualified(self) -> str:
        return dialect_of(self.dialect).table_name(self.database, self.schema, self.table)


def quote_name(dialect: str, name: str) -> str:
    """The name in the quotes of its database."""
    return dialect_of(dialect).quote(name)


def text_literal(value: str, dialect: str) -> str:
    """A text in the database's SQL."""
    return dialect_of(dialect).literal(value)


def connection_options(spec: JdbcTable) -> dict[str, str]:
    return {
        "url": dialect_of(spec.dialect).url.format(host=spec.host, port=spec.port, database=spec.database),
        "driver": dialect_of(spec.dialect).driver,
        "user": spec.user,
        "password": spec.password,
        "fetchsize": str(FETCH_ROWS),
    }


def table_options(
    spec: JdbcTable,
    partition_column: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int | None = None,
) -> dict[str, str]:
    """Options reading the whole table, in disjoint slices when a column is named."""
    options = connection_options(spec) | {"dbtable": spec.qualified}
    if partition_column is not None:
        if lower is None or upper is None or not partitions:
            raise ValueError("a sliced read needs lower and upper bound and the number of slices")
        options |= {
            # Spark looks the column up by its plain name and quotes it itself.
            "partitionColumn": partition_column,
            "lowerBound": bound_text(lower, math.floor),
            "upperBound": bound_text(upper, math.ceil),
            "numPartitions": str(partitions),
        }
    return options


def bound_text(value: object, whole) -> str:
    """A bound of slices: numbers as whole ones, which Spark asks for; slices cover everything beyond the bounds anyway."""
    return str(whole(value) if isinstance(value, (float, Decimal)) else value)


def limited_query(spec: JdbcTable, columns: Sequence[str], limit: int, predicate: str | None = None) -> str:
    """SELECT of the first rows in the database's own words, so only they travel."""
    names = ", ".join(quote_name(spec.dialect, c) for c in columns)
    conditions = [f"({predicate})"] if predicate else []
    return dialect_of(spec.dialect).first_rows(names, spec.qualified, conditions, int(limit))


def metadata_query(spec: JdbcTable) -> str:
    """Name and type of each column, in table order, from the database's catalog."""
    return dialect_of(spec.dialect).columns_query(spec.database, spec.schema, spec.table)


def primary_key_query(spec: JdbcTable) -> str:
    """Name and position of each primary-key column from the database's catalog."""
    return dialect_of(spec.dialect).key_query(spec.database, spec.schema, spec.table)


def bounds_query(spec: JdbcTable, column: str) -> str:
    name = quote_name(spec.dialect, column)
    return f"SELECT MIN({name}) AS low, MAX({name}) AS high FROM {spec.qualified}"


def cuts_query(spec: JdbcTable, column: str, slices: int) -> str:
    """Number and least key of each of ``slices`` parts of equal size, as the database orders its keys."""
    name, part = quote_name(spec.dialect, column), quote_name(spec.dialect, "part")
    ranked = f"SELECT {name}, NTILE({int(slices)}) OVER (ORDER BY {name}) AS {part} FROM {spec.qualified} WHERE {name} IS NOT NULL"
    return f"SELECT {part}, MIN({name}) AS {quote_name(spec.dialect, 'cut')} FROM ({ranked}) ranked GROUP BY {part}"


def tuple_cuts_query(spec: JdbcTable, keys: Sequence[str], slices: int) -> str:
    """Number and least key of each of ``slices`` parts of equal size, by all key columns in order."""
    names = [quote_name(spec.dialect, k) for k in keys]
    part, place, listed = quote_name(spec.dialect, "part"), quote_name(spec.dialect, "place"), ", ".join(names)
    tiles = f"SELECT {listed}, NTILE({int(slices)}) OVER (ORDER BY {listed}) AS {part} FROM {spec.qualified}"
    placed = f"SELECT {listed}, {part}, ROW_NUMBER() OVER (PARTITION BY {part} ORDER BY {listed}) AS {place} FROM ({tiles}) tiles"
    return f"SELECT {part}, {listed} FROM ({placed}) placed WHERE {place} = 1"


def cut_predicates(spec: JdbcTable, column: str, cuts: Sequence[str]) -> list[str]:
    """Disjoint conditions between the cuts, which are in the database's order; the first one takes NULLs as well."""
    name = quote_name(spec.dialect, column)
    inner = list(dict.fromkeys(cuts))[1:]
    if not inner:
        return ["1 = 1"]
    texts = [text_literal(c, spec.dialect) for c in inner]
    between = [f"{name} >= {a} AND {name} < {b}" for a, b in zip(texts, texts[1:])]
    return [f"{name} < {texts[0]} OR {name} IS NULL", *between, f"{name} >= {texts[-1]}"]


def upsert_query(spec: JdbcTable, staging: JdbcTable, keys: Sequence[str], columns: Sequence[str], run_id: str, mode: str = "update") -> str:
    """The database's own statement that writes one run's staged rows into the table.

    ``insert`` adds rows of new keys, ``update`` also overwrites the columns of known keys. The table needs a
    unique key over ``keys``. Running it again changes nothing more.
    """
    dialect = dialect_of(spec.dialect)
    values = [c for c in columns if c not in keys]
    listed = ", ".join(map(dialect.quote, [*keys, *values]))
    staged = f"SELECT {listed} FROM {staging.qualified} WHERE {dialect.quote(RUN_ID)} = {dialect.literal(run_id)}"
    return dialect.upsert(spec.qualified, staged, keys, values, mode != "insert")


def load_query(spark: SparkSession, spec: JdbcTable, query: str) -> DataFrame:
    return spark.read.format("jdbc").options(**connection_options(spec), query=query).load()


def primary_keys(spark: SparkSession, spec: JdbcTable) -> list[str]:
    """Ordered key columns; as many rows as the key has columns."""
    rows = load_query(spark, spec, primary_key_query(spec)).collect()
    ordered = sorted(rows, key=lambda r: r[1])
    if not ordered:
        raise LookupError(f"{spec.qualified} has no primary key")
    return [r[0] for r in ordered]
