"""Comparison by a tree of digests: rows are brought together only where the sides differ.

The range of the first key column is cut into parts of equal width. One pass over each side
gives of every part the number of rows and two sums of row hashes, which do not depend on any
order, so no row is shuffled. Parts that agree are equal; those that differ are cut again as
long as that leaves rows out, and what differs at the end is read once more, by ranges the
scan gets, and compared row by row. With few differences a comparison costs a scan of each
side; with many, the second look is left out and all rows are compared as ``compare_rows`` does.

Two sets of rows with the same number and the same two 64-bit sums count as equal. For rows
that differ by chance that happens once in about 2 to the power of 128 parts; the digests are
no proof against rows made to deceive. Values are hashed in the types both sides are compared
in, NULLs by place, NaN and -0.0 as their equals. Tolerances have no digest.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmend.operators.compare import DIFF_TYPE, MATCH, any_of, compare_rows, prepare
from rowmend.operators.keys import HOT_ROWS
from rowmend.operators.ranks import quoted
from rowmend.operators.summary import count_columns

PARTS = 1024  # into which a range is cut on each level
LEVELS = 3
LEAF_ROWS = 10_000  # parts of fewer rows a side are not cut again
# If parts with more than this share of all rows differ, they are compared as they are.
MOST_OPEN = 0.5
# Differences in more places than this are spread out: cutting again would leave little out.
MOST_SPANS = 64

_EPOCH = datetime(1970, 1, 1)


@dataclass(frozen=True)
class Span:
    """Places from ``low`` up to, but without, ``high``; without a bound on the outer sides."""

    low: int | None
    high: int | None


@dataclass(frozen=True)
class DigestDiff:
    """The compared rows of parts that differ, and what is known of those that agree.

    ``equal_rows`` rows of either side lie in equal parts and match. ``looked_at`` is the
    number of rows of both sides that were compared row by row, ``spans`` the ranges they lie in.
    """

    rows: DataFrame
    equal_rows: int
    looked_at: int
    spans: tuple[Span, ...]

    def summary(self) -> DataFrame:
        """The counts ``compare_summary`` gives of a whole comparison."""
        counted = self.rows.agg(*count_columns())
        for name in ("src_cnt", "tgt_cnt", "match_cnt"):
            counted = counted.withColumn(name, F.col(name) + F.lit(self.equal_rows))
        larger = F.greatest("src_cnt", "tgt_cnt")
        rate = F.when(larger == 0, F.lit(1.0)).otherwise(F.col("match_cnt").cast("double") / larger.cast("double"))
        return counted.withColumn("matching_rate", rate)

    def differences(self) -> DataFrame:
        return self.rows.where(F.col(DIFF_TYPE) != MATCH)


def place_of(key: Column, dtype: T.DataType) -> Column | None:
    """A whole number in the order of the key; None for types without one."""
    if isinstance(dtype, T.IntegralType):
        return key.cast("bigint")
    if isinstance(dtype, T.DecimalType) and dtype.precision - dtype.scale <= 18:
        return F.floor(key).cast("bigint")
    if isinstance(dtype, T.DateType):
        return F.unix_date(key).cast("bigint")
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit(_EPOCH).cast("timestamp_ntz"), key)
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(key)
    return None


def _value(place: int, dtype: T.DataType) -> Column:
    """The least key of a place, as a literal of the key's type, so that a filter on it reaches the scan."""
    if isinstance(dtype, T.DateType):
        return F.lit(date(1970, 1, 1) + timedelta(days=place))
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(_EPOCH + timedelta(microseconds=place)).cast("timestamp_ntz")
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_micros(F.lit(place))
    if isinstance(dtype, T.DecimalType):
        return F.lit(Decimal(place)).cast(dtype)
    return F.lit(place).cast(dtype)


def _inside(key: Column, dtype: T.DataType, spans: Sequence[Span]) -> Column:
    """Rows of the spans; NULL keys are always looked at."""
    parts = [key.isNull()]
    for span in spans:
        low = F.lit(True) if span.low is None else key >= _value(span.low, dtype)
        parts.append(low if span.high is None else low & (key < _value(span.high, dtype)))
    return any_of(parts)


def row_hashes(columns: Sequence[str]) -> list[Column]:
    """Two hashes of a row that tell a NULL in one column from a NULL in another."""
    values = [F.col(q) for q in quoted(columns)]
    told = [x for v in values for x in (v.isNull(), v)]
    return [F.xxhash64(*told), F.xxhash64(F.lit("second"), *reversed(told))]


def part_digests(side: DataFrame, part: Column, columns: Sequence[str], name: str) -> DataFrame:
    """``(part, <name>_rows, <name>_a, <name>_b)``: an aggregate that needs no order and sums up partly in each task."""
    a, b = row_hashes(columns)
    wide = lambda c: F.sum(c.cast("decimal(38,0)"))
    held = side.groupBy(part.alias("part"))
    return held.agg(F.count("*").alias(f"{name}_rows"), wide(a).alias(f"{name}_a"), wide(b).alias(f"{name}_b"))


def _number(value: int) -> Column:
    """A literal of any whole number: one behind the largest place may need more than 64 bits."""
    return F.lit(value) if -(1 << 63) <= value < 1 << 63 else F.lit(Decimal(value))


def _parts(place: Column, spans: Sequence[tuple[int, int]], parts: int) -> Column:
    """Number of the part a place lies in: each span is cut into ``parts``."""
    number = F.when(place.isNull(), F.lit(-1).cast("bigint"))
    for k, (low, high) in enumerate(spans):
        width = max(1, -(-(high - low) // parts))
        # In decimals where the distance of two places may pass 64 bits.
        own = place if high - low < 1 << 62 else place.cast("decimal(20,0)")
        number = number.when(place < _number(high), F.lit(k * parts) + F.call_function("div", own - F.lit(low), _number(width)))
    return number


def _bounds(low: int, high: int, parts: int) -> list[tuple[int, int]]:
    width = max(1, -(-(high - low) // parts))
    return [(low + width * k, low + width * (k + 1)) for k in range(parts)]


def _open_ended(spans: Sequence[tuple[int, int]], outer: tuple[int, int]) -> list[Span]:
    """Spans as conditions: the ends of the whole range need none, and may be no values of the key's type."""
    return [Span(None if low <= outer[0] else low, None if high >= outer[1] else high) for low, high in spans]


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans next to each other as one."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and out[-1][1] >= low:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def digest_compare(
    src: DataFrame,
    tgt: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    primary_key: bool = False,
    hot_rows: int | None = HOT_ROWS,
    parts: int = PARTS,
    levels: int = LEVELS,
    leaf_rows: int = LEAF_ROWS,
) -> DigestDiff:
    """``compare_rows`` of the parts of the key's range in which the sides differ.

    All keys, NULLs and repeated ones included, and all differences are found; rows of equal
    parts are only counted. A first key column without whole places (texts, fractions) makes
    one part, so that everything is compared unless all rows agree.
    """
    a, b, values = prepare(src, tgt, keys, columns)
    hashed = [*keys, *values]
    name, dtype = keys[0], a.schema[keys[0]].dataType
    key = F.col(quoted([name])[0])
    place = place_of(key, dtype)
    if place is None:
        spans, place = [], F.lit(0).cast("bigint")
    else:
        ends = [df.agg(F.min(place).alias("low"), F.max(place).alias("high")).first() for df in (a, b)]
        low = min((r["low"] for r in ends if r["low"] is not None), default=0)
        high = max((r["high"] for r in ends if r["high"] is not None), default=0) + 1
        spans = [(low, high)]
    ordered, total, looked, equal = bool(spans), None, 0, 0
    spans = spans or [(0, 1)]
    outer = spans[0]
    for level in range(levels if ordered else 1):
        cut = max(1, parts // len(spans)) if ordered else 1
        number = _parts(place, spans, cut)
        read = [df if level == 0 else df.where(_inside(key, dtype, _open_ended(spans, outer))) for df in (a, b)]
        found = [part_digests(df, number, hashed, side) for df, side in zip(read, ("src", "tgt"))]
        # At most `parts` rows and one for NULL keys, whatever the tables hold.
        digests = found[0].join(found[1], "part", "full_outer").collect()
        count = lambda r, side: r[f"{side}_rows"] or 0
        differs = [r for r in digests if any(r[f"src_{c}"] != r[f"tgt_{c}"] for c in ("rows", "a", "b"))]
        open_parts = {r["part"] for r in differs}
        looked = sum(count(r, "src") + count(r, "tgt") for r in differs)
        total = sum(count(r, "src") + count(r, "tgt") for r in digests) if total is None else total
        equal += sum(count(r, "src") for r in digests if r["part"] not in open_parts)
        bounds = [s for low, high in spans for s in _bounds(low, high, cut)]
        spans = _joined([bounds[p] for p in open_parts if p >= 0]) if ordered else spans
        null_open = -1 in open_parts
        large = any(max(count(r, "src"), count(r, "tgt")) > leaf_rows for r in differs if r["part"] >= 0)
        narrow = all(high - low <= 1 for low, high in spans)
        if not spans or not large or narrow or looked > MOST_OPEN * total or len(spans) > MOST_SPANS:
            break
        if not null_open:
            a, b = (df.where(key.isNotNull()) for df in (a, b))
    if not looked:
        chosen: list[Span] = []
        sides = [df.where(F.lit(False)) for df in (a, b)]
    elif not ordered:
        chosen, sides = [Span(None, None)], [a, b]
    else:
        chosen = _open_ended(spans, outer)
        inside = _inside(key, dtype, chosen) if null_open else _inside(key, dtype, chosen) & key.isNotNull()
        sides = [df.where(inside) for df in (a, b)]
    rows = compare_rows(*sides, keys, values, primary_key=primary_key, hot_rows=hot_rows)
    return DigestDiff(rows, equal, looked, tuple(chosen))
