"""SQL text for names and values, as used in generated predicates."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmend.sources.dialects import dialect_of

TIMES = (T.TimestampType, T.TimestampNTZType)


def column_name(name: str, dialect: str | None = None) -> str:
    """A column's name in a condition: quoted for its database; for Spark only where it has to be."""
    if dialect is not None:
        return dialect_of(dialect).quote(name)
    return name if re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name) else "`" + name.replace("`", "``") + "`"


def sql_literal(value: Column, dtype: T.DataType, dialect: str | None = None) -> Column:
    """SQL text of a value: NULL, quoted text or time (to the microsecond), or the plain number."""
    if isinstance(dtype, T.StringType):
        # Spark reads a backslash inside a text as the start of an escape, and so do some databases.
        if dialect is None or dialect_of(dialect).backslash_escapes:
            value = F.replace(value, F.lit("\\"), F.lit("\\\\"))
        text = F.concat(F.lit("'"), F.replace(value, F.lit("'"), F.lit("''")), F.lit("'"))
    elif isinstance(dtype, (*TIMES, T.DateType)):
        text = F.concat(F.lit("'"), value.cast("string"), F.lit("'"))
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit("NULL"))
