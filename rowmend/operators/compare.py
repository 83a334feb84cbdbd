"""Row comparison: every key's rows of both sides brought together, and the narrower joins next to it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmend.functions.types import is_numeric, unify_types
from rowmend.operators.keys import HOT_ROWS, OCCURRENCE, by_key, hot_keys_and_rows, same_keys, split_hot
from rowmend.operators.ranks import COPY_STEP, number_in_hot_key, number_in_key, quoted
from rowmend.sources.storage import materialize

MATCH, MISMATCH, SRC_ONLY, TGT_ONLY = "match", "mismatch", "src_only", "tgt_only"
DIFF_TYPE, DIFF_COLUMNS = "diff_type", "diff_columns"
SRC, TGT = "src", "tgt"
_IS_SRC, _RECORD = "_is_src", "_record"
# Metadata of the only field of a record without values; a name could be a column's as well.
KEY_ONLY = "rowmend.key_only"


def any_of(conditions: Sequence[Column]) -> Column:
    """OR over the conditions as a balanced tree, so hundreds of columns stay shallow."""
    if not conditions:
        return F.lit(False)
    level = list(conditions)
    while len(level) > 1:
        level = [a | b for a, b in zip(level[::2], level[1::2])] + (level[-1:] if len(level) % 2 else [])
    return level[0]


def difference(a: Column, b: Column, dtype: T.DataType) -> Column:
    """Absolute difference of two numbers, exact and without overflow."""
    if isinstance(dtype, T.LongType):
        wide = "decimal(20,0)"
    elif isinstance(dtype, T.DecimalType):
        wide = dtype.simpleString()
    else:
        wide = "double" if isinstance(dtype, (T.FloatType, T.DoubleType)) else "bigint"
    return F.abs(a.cast(wide) - b.cast(wide))


def values_equal(a: Column, b: Column, dtype: T.DataType, abs_tol: float = 0.0, rel_tol: float = 0.0) -> Column:
    """Equality with NULL = NULL; numbers also within ``abs_tol + rel_tol * |b|``."""
    same = a.eqNullSafe(b)
    if (abs_tol or rel_tol) and is_numeric(dtype):
        room = F.lit(float(abs_tol)) + F.lit(float(rel_tol)) * F.abs(b.cast("double"))
        return same | F.coalesce(difference(a, b, dtype).cast("double") <= room, F.lit(False))
    return same


def prepare(
    src: DataFrame, tgt: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides cut to keys and compared columns, of one type each, and the compared columns."""
    if not keys:
        raise ValueError("no key columns")
    theirs = set(tgt.columns)
    missing = [k for k in keys if k not in src.columns or k not in theirs]
    if missing:
        raise ValueError(f"key columns missing on one side: {missing}")
    taken = {OCCURRENCE, DIFF_TYPE, DIFF_COLUMNS, SRC, TGT}.intersection(keys)
    if taken:
        raise ValueError(f"column names used by the comparison: {sorted(taken)}")
    wanted = src.columns if columns is None else columns
    values = [c for c in dict.fromkeys(wanted) if c in set(src.columns) and c in theirs and c not in keys]
    a, b = unify_types(src, tgt, [*keys, *values])
    return a, b, values


def _records(df: DataFrame, keys: Sequence[str], values: Sequence[str], name: str) -> DataFrame:
    """``(keys, record)``. The record is never NULL, so it tells an absent row from a row of NULLs."""
    record = F.struct(*quoted(values)) if values else F.struct(F.lit(True).alias("present", metadata={KEY_ONLY: True}))
    return df.select(*quoted(keys), record.alias(name))


def join_sides(
    src: DataFrame, tgt: DataFrame, keys: Sequence[str], how: str = "full_outer", null_safe: bool = False
) -> DataFrame:
    """``(keys, src, tgt)`` from two tables of records whose keys are unique."""
    joined = src.alias("s").join(tgt.alias("t"), same_keys(keys, "s", "t", null_safe), how)
    both = [F.coalesce(F.col(f"s.`{k}`"), F.col(f"t.`{k}`")) if how == "full_outer" else F.col(f"s.`{k}`") for k in keys]
    return joined.select(*[c.alias(k) for c, k in zip(both, keys)], F.col(f"s.{SRC}").alias(SRC), F.col(f"t.{TGT}").alias(TGT))


def pair_occurrences(src: DataFrame, tgt: DataFrame, keys: Sequence[str], hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """``(keys, occurrence, src, tgt)`` from two tables of records whose keys may repeat or be NULL.

    The k-th source record of a key, in value order, meets its k-th target record;
    never all pairs. Both sides go through one shuffle by key: numbering and pairing
    both work on it. Hot keys are taken out, numbered across tasks, and paired by key
    and number, which spreads them.
    """
    stacked = (
        src.select(*quoted(keys), F.lit(True).alias(_IS_SRC), F.col(SRC).alias(_RECORD))
        .unionByName(tgt.select(*quoted(keys), F.lit(False).alias(_IS_SRC), F.col(TGT).alias(_RECORD)))
    )
    hot, row_cnt = hot_keys_and_rows(stacked, keys, hot_rows)
    if hot is None:
        return _pair_in_key(stacked, keys, row_cnt)
    usual, _ = split_hot(stacked, hot, keys)
    sides = []
    for df, name in ((src, SRC), (tgt, TGT)):
        _, large = split_hot(df, hot, keys)
        sides.append(number_in_hot_key(large, keys, [name], OCCURRENCE))
    paired = join_sides(*sides, [*keys, OCCURRENCE], null_safe=True)
    return _pair_in_key(usual, keys, row_cnt).unionByName(paired)


def _pair_in_key(stacked: DataFrame, keys: Sequence[str], row_cnt: int) -> DataFrame:
    numbered = number_in_key(by_key(stacked, keys, row_cnt), [*keys, _IS_SRC], [_RECORD], OCCURRENCE)
    return numbered.groupBy(*quoted(keys), OCCURRENCE).agg(
        F.max(F.when(F.col(_IS_SRC), F.col(_RECORD))).alias(SRC),
        F.max(F.when(~F.col(_IS_SRC), F.col(_RECORD))).alias(TGT),
    )


def match_rows(
    src: DataFrame, tgt: DataFrame, keys: Sequence[str], values: Sequence[str], primary_key: bool, hot_rows: int | None
) -> DataFrame:
    a, b = _records(src, keys, values, SRC), _records(tgt, keys, values, TGT)
    return join_sides(a, b, keys) if primary_key else pair_occurrences(a, b, keys, hot_rows)


def field(side: str, name: str) -> Column:
    return F.col(side).getField(name)


def unequal_columns(joined: DataFrame, values: Sequence[str], abs_tol: float, rel_tol: float) -> dict[str, Column]:
    if not values:
        return {}
    types = {f.name: f.dataType for f in joined.schema[SRC].dataType.fields}
    return {v: ~values_equal(field(SRC, v), field(TGT, v), types[v], abs_tol, rel_tol) for v in values}


def compare_rows(
    src: DataFrame,
    tgt: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    abs_tol: float = 0.0,
    rel_tol: float = 0.0,
    primary_key: bool = False,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Every row of either side, matched by key, with its class.

    ``(keys, occurrence, diff_type, src, tgt, diff_columns)``, where ``diff_type`` is
    match, mismatch, src_only or tgt_only, ``src``/``tgt`` hold the compared values
    and ``diff_columns`` names the unequal ones of a mismatch. What is not asked for
    downstream is not computed.

    ``primary_key`` states that on both sides no key repeats and none is NULL, as a
    database's primary key does. Then one full outer join does it, there is no
    ``occurrence``, and tables bucketed by the key are not shuffled at all.
    """
    a, b, values = prepare(src, tgt, keys, columns)
    return classified(match_rows(a, b, keys, values, primary_key, hot_rows), values, abs_tol, rel_tol)


def classified(joined: DataFrame, values: Sequence[str], abs_tol: float = 0.0, rel_tol: float = 0.0) -> DataFrame:
    """Matched records with their class and the names of their unequal columns."""
    unequal = unequal_columns(joined, values, abs_tol, rel_tol)
    kind = (
        F.when(F.col(TGT).isNull(), SRC_ONLY)
        .when(F.col(SRC).isNull(), TGT_ONLY)
        .when(any_of(list(unequal.values())), MISMATCH)
        .otherwise(MATCH)
    )
    names = F.array_compact(F.array(*[F.when(c, F.lit(v)) for v, c in unequal.items()])) if unequal else F.array()
    both = F.col(SRC).isNotNull() & F.col(TGT).isNotNull()
    return joined.select(
        *quoted([c for c in joined.columns if c not in (SRC, TGT)]),
        kind.alias(DIFF_TYPE),
        SRC,
        TGT,
        F.when(both, names).otherwise(F.array()).cast("array<string>").alias(DIFF_COLUMNS),
    )


@dataclass(frozen=True)
class LeastDiff:
    """The differing rows, as ``compare_rows`` gives them, and the number of pairs that agree."""

    rows: DataFrame
    match_cnt: int


def compare_least(
    src: DataFrame,
    tgt: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    abs_tol: float = 0.0,
    rel_tol: float = 0.0,
    hot_rows: int | None = HOT_ROWS,
) -> LeastDiff:
    """The comparison with the fewest differing rows where keys repeat.

    Rows of a key that are equal on both sides cancel out first, each as often as both
    have it; the k-th of what is left of the source, in value order, then meets the k-th
    of the target, and ``occurrence`` counts within that. So a missing row is one
    difference, also in the middle of others, and the differences are those that
    ``apply_repair`` would write. Keys may be NULL or repeat at will.

    One shuffle by key and values brings equal rows together, counted before they travel:
    no key is hot there, nothing has to be known of the keys beforehand, and only what is
    left over, which is written down, is looked at again. A tolerance decides about rows
    left over.
    """
    a, b, values = prepare(src, tgt, keys, columns)
    sides = [
        _records(df, keys, values, _RECORD).withColumn(_IS_SRC, F.lit(is_src)) for df, is_src in ((a, True), (b, False))
    ]
    stacked = sides[0].unionByName(sides[1])
    # Grouping makes 0.0 of -0.0; a record of either side keeps its own.
    own = [F.first(F.when(flag, F.col(_RECORD)), ignorenulls=True) for flag in (F.col(_IS_SRC), ~F.col(_IS_SRC))]
    counted = stacked.groupBy(*quoted(keys), _RECORD).agg(
        F.count_if(_IS_SRC).alias("_s"), F.count_if(~F.col(_IS_SRC)).alias("_t"), own[0].alias(SRC), own[1].alias(TGT)
    )
    seen = Observation()
    counted = counted.observe(seen, F.coalesce(F.sum(F.least("_s", "_t")), F.lit(0)).alias("match_cnt"))
    left = materialize(counted.where("_s <> _t").drop(_RECORD), "left-over")

    def rest(side: str, more: Column) -> DataFrame:
        # Many copies of one row are put back in steps, by many tasks.
        steps = F.explode(F.expr(f"sequence(0L, (_n - 1) div {COPY_STEP}L)")).alias("_step")
        runs = left.withColumn("_n", more).where("_n > 0").select(*quoted(keys), side, "_n", steps).repartition(*quoted(keys), "_step")
        copies = F.explode(F.expr(f"sequence(1L, least({COPY_STEP}L, _n - _step * {COPY_STEP}L))"))
        return runs.select(*quoted(keys), side, copies).select(*quoted(keys), side)

    paired = pair_occurrences(rest(SRC, F.expr("_s - _t")), rest(TGT, F.expr("_t - _s")), keys, hot_rows)
    return LeastDiff(classified(paired, values, abs_tol, rel_tol), seen.get["match_cnt"])


def key_only_compare(
    src: DataFrame, tgt: DataFrame, keys: Sequence[str], primary_key: bool = False, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """``(keys[, occurrence], diff_type)`` of the rows that one side lacks; only keys are read."""
    rows = compare_rows(src, tgt, keys, [], primary_key=primary_key, hot_rows=hot_rows)
    return rows.where(F.col(DIFF_TYPE) != MATCH).drop(SRC, TGT, DIFF_COLUMNS)


def src_only_rows(
    src: DataFrame,
    tgt: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    primary_key: bool = False,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Full source rows that the target lacks. With a primary key, only keys of the target are read."""
    a, b, values = prepare(src, tgt, keys, columns)
    if primary_key:
        left, right = a.alias("s"), b.select(*quoted(keys)).alias("t")
        return left.join(right, same_keys(keys, "s", "t", null_safe=False), "left_anti")
    paired = match_rows(a, b, keys, values, primary_key, hot_rows)
    return paired.where(F.col(TGT).isNull()).select(*quoted(keys), *[field(SRC, v).alias(v) for v in values])


def tgt_only_keys(
    src: DataFrame, tgt: DataFrame, keys: Sequence[str], primary_key: bool = False, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Keys of target rows that the source lacks."""
    return src_only_rows(tgt, src, keys, [], primary_key, hot_rows)


def mismatch_pairs(
    src: DataFrame,
    tgt: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    abs_tol: float = 0.0,
    rel_tol: float = 0.0,
    primary_key: bool = False,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """``(keys[, occurrence], src, tgt)`` of rows on both sides whose values differ."""
    a, b, values = prepare(src, tgt, keys, columns)
    if primary_key:
        joined = join_sides(_records(a, keys, values, SRC), _records(b, keys, values, TGT), keys, "inner")
    else:
        joined = match_rows(a, b, keys, values, False, hot_rows).where(F.col(SRC).isNotNull() & F.col(TGT).isNotNull())
    return joined.where(any_of(list(unequal_columns(joined, values, abs_tol, rel_tol).values())))


def mismatch_keys(
    src: DataFrame,
    tgt: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    abs_tol: float = 0.0,
    rel_tol: float = 0.0,
    primary_key: bool = False,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Keys of rows on both sides whose values differ."""
    return mismatch_pairs(src, tgt, keys, columns, abs_tol, rel_tol, primary_key, hot_rows).select(*quoted(keys))


def lookup_target(
    wanted: DataFrame, tgt: DataFrame, keys: Sequence[str], columns: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Target rows, unfiltered, of the wanted keys: ``(keys, columns)``.

    Only the named columns are read. A small written-down ``wanted`` is broadcast, and
    then the target is scanned without being shuffled. Keys come back in the type they
    are wanted in.
    """
    others = [c for c in dict.fromkeys(columns) if c not in keys]
    typed = [c.alias(k) for c, k in zip(_keys_as(tgt, wanted, keys), keys)]
    return rows_of_keys(tgt.select(*typed, *quoted(others)), wanted, keys, null_safe)


def _keys_as(df: DataFrame, wanted: DataFrame, keys: Sequence[str], prefix: str = "") -> list[Column]:
    """The key columns of ``df`` in the types of ``wanted``, untouched where they agree."""
    out = []
    for k in keys:
        column, goal = F.col(f"{prefix}`{k}`"), wanted.schema[k].dataType
        out.append(column if df.schema[k].dataType == goal else column.cast(goal))
    return out


def rows_of_keys(df: DataFrame, wanted: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """The rows whose whole key is among the wanted ones; no key wanted, no row."""
    condition = F.lit(True)
    for k, column in zip(keys, _keys_as(df, wanted, keys, "rows.")):
        other = F.col(f"wanted.`{k}`")
        condition = condition & (column.eqNullSafe(other) if null_safe else column == other)
    return df.alias("rows").join(wanted.select(*quoted(keys)).alias("wanted"), condition, "left_semi")
