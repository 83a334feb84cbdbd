"""Kinds of databases: how they are reached, and what is said to each in its own words.

``Dialect`` speaks standard SQL with an information schema, FETCH FIRST and MERGE. A further
kind of database is an instance or a subclass of it, made known by ``register_dialect``; tables
of that kind can then be read, compared and repaired like the others.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

# URL layout and driver class per database.
URLS = {
    "mysql": "jdbc:mysql://{host}:{port}/{database}?useUnicode=true&characterEncoding=utf8",
    "oracle": "jdbc:oracle:thin:@{host}:{port}:{database}",
    "sqlserver": "jdbc:sqlserver://{host}:{port};DatabaseName={database}",
    "postgresql": "jdbc:postgresql://{host}:{port}/{database}",
}
DRIVERS = {
    "mysql": "com.mysql.cj.jdbc.Driver",
    "oracle": "oracle.jdbc.driver.OracleDriver",
    "sqlserver": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
    "postgresql": "org.postgresql.Driver",
}


@dataclass(frozen=True)
class Dialect:
    """A database of standard SQL. ``url`` has places for host, port and database."""

    name: str
    url: str
    driver: str
    quotes: str = '""'
    # Whether a text reads a backslash as the start of an escape.
    backslash_escapes: bool = False

    def quote(self, name: str) -> str:
        opening, closing = self.quotes
        return f"{opening}{name.replace(closing, closing * 2)}{closing}"

    def literal(self, value: str) -> str:
        value = value.replace("\\", "\\\\") if self.backslash_escapes else value
        return "'" + value.replace("'", "''") + "'"

    def table_name(self, database: str, schema: str | None, table: str) -> str:
        return ".".join(map(self.quote, (schema or database, table)))

    def first_rows(self, names: str, table: str, conditions: Sequence[str], n: int) -> str:
        return f"SELECT {names} FROM {table}{where(conditions)} FETCH FIRST {n} ROWS ONLY"

    # The column of the information schema that tells whose a table is, and what it holds for ours.
    owner_column = "table_schema"

    def owner(self, database: str, schema: str | None) -> str:
        return schema or database

    def columns_query(self, database: str, schema: str | None, table: str) -> str:
        """Name and type of each column, in table order."""
        return (
            "SELECT column_name AS name, data_type AS type FROM information_schema.columns "
            f"WHERE {self.owner_column} = {self.literal(self.owner(database, schema))} AND table_name = {self.literal(table)}"
        )

    def key_query(self, database: str, schema: str | None, table: str) -> str:
        """Name and position of each primary-key column."""
        return (
            "SELECT k.column_name AS name, k.ordinal_position AS position "
            "FROM information_schema.key_column_usage k JOIN information_schema.table_constraints c "
            "ON c.constraint_name = k.constraint_name AND c.table_schema = k.table_schema "
            "AND c.table_name = k.table_name "
            f"WHERE c.constraint_type = 'PRIMARY KEY' AND k.{self.owner_column} = {self.literal(self.owner(database, schema))} "
            f"AND k.table_name = {self.literal(table)}"
        )

    def upsert(self, table: str, staged: str, keys: Sequence[str], values: Sequence[str], overwrites: bool) -> str:
        """The statement that writes the rows of ``staged`` into the table; ``overwrites`` tells what becomes of known keys."""
        q, names = self.quote, [*keys, *values]
        on = " AND ".join(f"t.{q(k)} = s.{q(k)}" for k in keys)
        changes = ", ".join(f"t.{q(c)} = s.{q(c)}" for c in values)
        matched = f" WHEN MATCHED THEN UPDATE SET {changes}" if overwrites and values else ""
        added = f" WHEN NOT MATCHED THEN INSERT ({', '.join(map(q, names))}) VALUES ({', '.join('s.' + q(c) for c in names)})"
        return f"MERGE INTO {table} t USING ({staged}) s ON ({on}){matched}{added}"


def where(conditions: Sequence[str]) -> str:
    return f" WHERE {' AND '.join(conditions)}" if conditions else ""


class MySql(Dialect):
    def first_rows(self, names: str, table: str, conditions: Sequence[str], n: int) -> str:
        return f"SELECT {names} FROM {table}{where(conditions)} LIMIT {n}"

    def upsert(self, table: str, staged: str, keys: Sequence[str], values: Sequence[str], overwrites: bool) -> str:
        q = self.quote
        kept = values if overwrites and values else keys[:1]
        changes = ", ".join(f"{q(c)} = {'VALUES(' + q(c) + ')' if c in values else q(c)}" for c in kept)
        return f"INSERT INTO {table} ({', '.join(map(q, [*keys, *values]))}) {staged} ON DUPLICATE KEY UPDATE {changes}"


class PostgreSql(Dialect):
    def first_rows(self, names: str, table: str, conditions: Sequence[str], n: int) -> str:
        return f"SELECT {names} FROM {table}{where(conditions)} LIMIT {n}"

    def upsert(self, table: str, staged: str, keys: Sequence[str], values: Sequence[str], overwrites: bool) -> str:
        q = self.quote
        changes = ", ".join(f"{q(c)} = EXCLUDED.{q(c)}" for c in values)
        action = f"DO UPDATE SET {changes}" if overwrites and values else "DO NOTHING"
        listed = ", ".join(map(q, [*keys, *values]))
        return f"INSERT INTO {table} ({listed}) {staged} ON CONFLICT ({', '.join(map(q, keys))}) {action}"


class Oracle(Dialect):
    def quote(self, name: str) -> str:
        """Unquoted names are kept in upper case, so that is what configured names mean there."""
        return super().quote(name.upper())

    def first_rows(self, names: str, table: str, conditions: Sequence[str], n: int) -> str:
        return f"SELECT {names} FROM {table}{where([*conditions, f'ROWNUM <= {n}'])}"

    def columns_query(self, database: str, schema: str | None, table: str) -> str:
        return (
            "SELECT column_name AS name, data_type AS type FROM all_tab_columns "
            f"WHERE owner = UPPER({self.literal(self.owner(database, schema))}) AND table_name = UPPER({self.literal(table)})"
        )

    def key_query(self, database: str, schema: str | None, table: str) -> str:
        return (
            "SELECT k.column_name AS name, k.position AS position "
            "FROM all_cons_columns k JOIN all_constraints c "
            "ON c.owner = k.owner AND c.constraint_name = k.constraint_name "
            f"WHERE c.constraint_type = 'P' AND c.owner = UPPER({self.literal(self.owner(database, schema))}) "
            f"AND c.table_name = UPPER({self.literal(table)})"
        )


class SqlServer(Dialect):
    owner_column = "table_catalog"

    def table_name(self, database: str, schema: str | None, table: str) -> str:
        return ".".join(map(self.quote, (database, schema or "dbo", table)))

    def owner(self, database: str, schema: str | None) -> str:
        return database

    def first_rows(self, names: str, table: str, conditions: Sequence[str], n: int) -> str:
        return f"SELECT TOP {n} {names} FROM {table}{where(conditions)}"

    def upsert(self, table: str, staged: str, keys: Sequence[str], values: Sequence[str], overwrites: bool) -> str:
        return super().upsert(table, staged, keys, values, overwrites) + ";"


DIALECTS: dict[str, Dialect] = {}


def register_dialect(dialect: Dialect) -> None:
    """Makes a kind of database known under its name, in place of one of that name."""
    DIALECTS[dialect.name] = dialect


def dialect_of(name: str) -> Dialect:
    if name not in DIALECTS:
        raise ValueError(f"unsupported database type: {name!r}")
    return DIALECTS[name]


register_dialect(MySql("mysql", URLS["mysql"], DRIVERS["mysql"], quotes="``", backslash_escapes=True))
register_dialect(Oracle("oracle", URLS["oracle"], DRIVERS["oracle"]))
register_dialect(SqlServer("sqlserver", URLS["sqlserver"], DRIVERS["sqlserver"], quotes="[]"))
register_dialect(PostgreSql("postgresql", URLS["postgresql"], DRIVERS["postgresql"]))
