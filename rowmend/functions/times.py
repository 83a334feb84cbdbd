"""Update-time windows and their text form."""

from __future__ import annotations

import re
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The text form of a recorded window, `[start,end)`; a fraction of a second only where there is one.
RANGE_FORMAT = "%Y-%m-%d %H:%M:%S"
_MOMENT = r"(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(?:\.\d{1,6})?)"
RANGE_PATTERN = rf"^\[{_MOMENT},{_MOMENT}\)$"


def window_bounds(days: float, end: datetime) -> tuple[datetime, datetime]:
    """The half-open window of the last ``days`` days before ``end``."""
    return end - timedelta(days=days), end


def time_text(moment: datetime) -> str:
    return moment.strftime(RANGE_FORMAT + (".%f" if moment.microsecond else ""))


def format_range(start: datetime, end: datetime) -> str:
    return f"[{time_text(start)},{time_text(end)})"


def parse_range(text: str) -> tuple[datetime, datetime]:
    """Bounds of a recorded window; anything but `[start,end)` is an error."""
    found = re.match(RANGE_PATTERN, text or "")
    if not found:
        raise ValueError(f"not a check range: {text!r}")
    start, end = (datetime.strptime(part, RANGE_FORMAT + (".%f" if "." in part else "")) for part in found.groups())
    return start, end


def range_start(text: Column) -> Column:
    """Lower bound of recorded windows held in a column; NULL where malformed."""
    return _bound(text, 1)


def range_end(text: Column) -> Column:
    return _bound(text, 2)


def _bound(text: Column, group: int) -> Column:
    return F.regexp_extract(text, RANGE_PATTERN, group).try_cast(T.TimestampNTZType())


def with_range_bounds(df: DataFrame, column: str = "check_range") -> DataFrame:
    """The table with ``range_start`` and ``range_end`` of its recorded windows.

    A malformed window has neither, and says so in ``range_error``.
    """
    text = F.col(f"`{column}`")
    bounded = df.withColumns({"range_start": range_start(text), "range_end": range_end(text)})
    unreadable = text.isNotNull() & (F.col("range_start").isNull() | F.col("range_end").isNull())
    message = F.concat(F.lit("not a check range: "), text)
    return bounded.withColumn("range_error", F.when(unreadable, message))


def time_literal(value: datetime, dtype: T.DataType) -> Column:
    """A literal of the time column's own type, so that the filter reaches the scan uncast."""
    text = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(text).cast(T.TimestampNTZType())
    if isinstance(dtype, T.TimestampType):
        return F.lit(text).cast(T.TimestampType())
    if isinstance(dtype, T.StringType):
        return F.lit(time_text(value))
    raise ValueError(f"not a time column type: {dtype.simpleString()}")


def in_window(column: str, dtype: T.DataType, start: datetime, end: datetime) -> Column:
    """``start <= column < end`` in the column's own type."""
    value = F.col(f"`{column}`")
    if isinstance(dtype, T.DateType):
        # A date stands for its midnight: the first date inside is the one at or after
        # the bound, which keeps the comparison in dates and lets it push down.
        return (value >= F.lit(_first_date_at_or_after(start))) & (value < F.lit(_first_date_at_or_after(end)))
    return (value >= time_literal(start, dtype)) & (value < time_literal(end, dtype))


def _first_date_at_or_after(moment: datetime):
    midnight = datetime(moment.year, moment.month, moment.day)
    return (midnight if midnight == moment else midnight + timedelta(days=1)).date()


def as_time(value: Column, dtype: T.DataType) -> Column:
    """The value as a zone-free timestamp; text that is no time becomes NULL."""
    if isinstance(dtype, T.TimestampNTZType):
        return value
    if isinstance(dtype, T.StringType):
        return value.try_cast(T.TimestampNTZType())
    return value.cast(T.TimestampNTZType())


def not_older_by(newer: Column, older: Column, seconds: float) -> Column:
    """``newer - older >= seconds``, to the microsecond and free of any time zone."""
    zero = F.lit(0)
    return (newer - older) >= F.make_dt_interval(zero, zero, zero, F.lit(seconds).cast("decimal(18,6)"))
