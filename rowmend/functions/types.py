"""One type per compared column on both sides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGRAL_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
FLOATING = (T.FloatType, T.DoubleType)
TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)
MAX_DIGITS = 38


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.DecimalType, *FLOATING, *INTEGRAL_DIGITS))


def _as_decimal(dtype: T.DataType) -> T.DecimalType:
    if isinstance(dtype, T.DecimalType):
        return dtype
    return T.DecimalType(INTEGRAL_DIGITS[type(dtype)], 0)


def unified_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type in which values of ``a`` and ``b`` are compared.

    Numbers meet in double as soon as one of them is floating, in decimal as soon
    as one is decimal, else in bigint. Anything temporal meets in the timestamp
    type, everything else as text.
    """
    if a == b:
        return a
    if is_numeric(a) and is_numeric(b):
        if isinstance(a, FLOATING) or isinstance(b, FLOATING):
            return T.DoubleType()
        if isinstance(a, T.DecimalType) or isinstance(b, T.DecimalType):
            x, y = _as_decimal(a), _as_decimal(b)
            scale = max(x.scale, y.scale)
            whole = max(x.precision - x.scale, y.precision - y.scale)
            if whole + scale > MAX_DIGITS:
                return T.DoubleType()
            return T.DecimalType(whole + scale, scale)
        return T.LongType()
    if isinstance(a, TEMPORAL) or isinstance(b, TEMPORAL):
        zoned = isinstance(a, T.TimestampType) or isinstance(b, T.TimestampType)
        return T.TimestampType() if zoned else T.TimestampNTZType()
    return T.StringType()


def unify_types(
    src: DataFrame,
    tgt: DataFrame,
    columns: Sequence[str] | None = None,
    unparseable: str = "fail",
) -> tuple[DataFrame, DataFrame]:
    """Both tables with the shared (or named) columns cast to one type per column.

    Only sides whose type differs from the common one get a cast, so a column that
    already agrees still pushes its filters into the scan. Text that should be a
    time and is not stops the job (``unparseable="fail"``); with ``"null"`` it
    becomes NULL instead, and then equals a NULL of the other side.
    """
    if unparseable not in ("fail", "null"):
        raise ValueError("unparseable must be 'fail' or 'null'")
    names = list(columns) if columns is not None else [c for c in src.columns if c in set(tgt.columns)]
    a_types = {f.name: f.dataType for f in src.schema.fields}
    b_types = {f.name: f.dataType for f in tgt.schema.fields}

    def side(df: DataFrame, types: dict[str, T.DataType]) -> DataFrame:
        out = []
        for name in names:
            goal = unified_type(a_types[name], b_types[name])
            quoted = f"`{name}`"
            if types[name] == goal:
                out.append(quoted)
                continue
            soft = unparseable == "null" and isinstance(types[name], T.StringType)
            value = F.col(quoted)
            out.append((value.try_cast(goal) if soft else value.cast(goal)).alias(name))
        return df.select(*out)

    return side(src, a_types), side(tgt, b_types)
