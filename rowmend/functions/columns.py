"""Choosing and naming the columns that take part in a comparison.

Everything here works on schemas; the data is touched only by the ``select``
the caller ends up running, so the choice reaches the scan as column pruning.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

COMPARABLE_TYPES = (
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.DecimalType,
    T.FloatType,
    T.DoubleType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
    T.BooleanType,
)


@dataclass(frozen=True)
class ColumnRoles:
    """The columns of a comparison, by what they are used for."""

    keys: tuple[str, ...]
    update: str | None
    extra: tuple[str, ...]

    @property
    def all(self) -> list[str]:
        return ordered_unique([*self.keys, *([self.update] if self.update else []), *self.extra])

    @property
    def values(self) -> list[str]:
        return [c for c in self.all if c not in self.keys]

    def describe(self) -> str:
        """Text kept in the result log."""
        return (
            f"key_columns: {list(self.keys)}, "
            f"update_column: {[self.update] if self.update else []}, "
            f"extra_columns: {list(self.extra)}"
        )


def ordered_unique(names: Iterable[str]) -> list[str]:
    """Names without repeats, first mention first."""
    return list(dict.fromkeys(names))


def split_names(text: str | None) -> list[str]:
    """Names out of a comma-separated list; blanks around and between are ignored."""
    return [part.strip() for part in (text or "").split(",") if part.strip()]


def compare_columns(
    schema: T.StructType,
    keys: Sequence[str],
    update_column: str | None = None,
    sensitive: str | Iterable[str] = (),
    include_extra: bool = True,
    include_strings: bool = False,
) -> ColumnRoles:
    """Key, update-time and comparable columns of a table.

    Strings are compared only as keys or update column unless ``include_strings``
    is set. A sensitive column leaves the update and extra roles; a sensitive key
    is refused, since rows could not be matched without it.
    """
    if not keys:
        raise ValueError("the table has no primary key, so its rows cannot be matched")
    names = set(schema.fieldNames())
    missing = [c for c in [*keys, *([update_column] if update_column else [])] if c not in names]
    if missing:
        raise ValueError(f"columns not in the table: {missing}")
    hidden = set(split_names(sensitive) if isinstance(sensitive, str) else sensitive)
    if hidden.intersection(keys):
        raise ValueError(f"key columns cannot be sensitive: {sorted(hidden.intersection(keys))}")
    wanted = (*COMPARABLE_TYPES, T.StringType) if include_strings else COMPARABLE_TYPES
    extra = (
        tuple(
            f.name
            for f in schema.fields
            if isinstance(f.dataType, wanted)
            and f.name not in hidden
            and f.name not in keys
            and f.name != update_column
        )
        if include_extra
        else ()
    )
    update = update_column if update_column not in hidden else None
    return ColumnRoles(tuple(ordered_unique(keys)), update, extra)


def drop_sensitive(df: DataFrame, sensitive: str | Iterable[str], keys: Sequence[str] = ()) -> DataFrame:
    """The table without its sensitive columns."""
    hidden = split_names(sensitive) if isinstance(sensitive, str) else list(sensitive)
    if set(hidden).intersection(keys):
        raise ValueError(f"key columns cannot be sensitive: {sorted(set(hidden).intersection(keys))}")
    return df.drop(*hidden)


def common_columns(src: DataFrame, tgt: DataFrame, keys: Sequence[str] = ()) -> list[str]:
    """Columns both tables have, in source order; every key must be among them."""
    theirs = set(tgt.columns)
    shared = [c for c in src.columns if c in theirs]
    if not shared:
        raise ValueError("source and target have no column in common")
    missing = [k for k in keys if k not in shared]
    if missing:
        raise ValueError(f"key columns missing on one side: {missing}")
    return shared


def fold_names(df: DataFrame) -> DataFrame:
    """The table with lower-case column names; names that would collide are refused."""
    folded = [c.lower() for c in df.columns]
    if len(set(folded)) < len(folded):
        raise ValueError(f"column names differ only in case: {sorted(df.columns)}")
    return df.toDF(*folded)
