"""Counts, rates, per-column statistics and the report of a comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from rowmend.functions.types import is_numeric
from rowmend.operators.compare import (
    DIFF_COLUMNS,
    DIFF_TYPE,
    KEY_ONLY,
    MATCH,
    MISMATCH,
    SRC,
    SRC_ONLY,
    TGT,
    TGT_ONLY,
    difference,
    field,
)
from rowmend.operators.keys import OCCURRENCE
from rowmend.sources.storage import materialize


def kind_count(*kinds: str) -> Column:
    listed = ", ".join(f"'{kind}'" for kind in kinds)
    return F.expr(f"count_if({DIFF_TYPE} IN ({listed}))")


def count_columns() -> list[Column]:
    """Aggregates over compared rows; every row of a side is in exactly one class."""
    return [
        kind_count(MATCH, MISMATCH, SRC_ONLY).alias("src_cnt"),
        kind_count(MATCH, MISMATCH, TGT_ONLY).alias("tgt_cnt"),
        kind_count(MATCH).alias("match_cnt"),
        kind_count(MISMATCH).alias("mismatch_cnt"),
        kind_count(SRC_ONLY).alias("src_only_cnt"),
        kind_count(TGT_ONLY).alias("tgt_only_cnt"),
        kind_count(MISMATCH, SRC_ONLY, TGT_ONLY).alias("diff_cnt"),
    ]


def rate(match_cnt: Column, src_cnt: Column, tgt_cnt: Column) -> Column:
    """Matched rows over the larger side; 1.0 when both sides are empty."""
    larger = F.greatest(src_cnt, tgt_cnt)
    return F.when(larger == 0, F.lit(1.0)).otherwise(match_cnt.cast("double") / larger.cast("double"))


def compare_summary(rows: DataFrame, by: Mapping[str, Column] | None = None) -> DataFrame:
    """Counts per class, difference count and matching rate, overall or per group."""
    groups = [column.alias(name) for name, column in (by or {}).items()]
    counted = rows.groupBy(*groups).agg(*count_columns()) if groups else rows.agg(*count_columns())
    return counted.withColumn("matching_rate", rate(F.col("match_cnt"), F.col("src_cnt"), F.col("tgt_cnt")))


def side_counts(src: DataFrame, tgt: DataFrame) -> DataFrame:
    """``(src_cnt, tgt_cnt)`` without a comparison."""
    sides = src.select(F.lit(True).alias("is_src")).unionByName(tgt.select(F.lit(False).alias("is_src")))
    return sides.agg(
        F.count_if(F.col("is_src")).alias("src_cnt"), F.count_if(~F.col("is_src")).alias("tgt_cnt")
    )


def diff_summary(rows: DataFrame) -> DataFrame:
    """``(diff_type, row_cnt)``."""
    return rows.groupBy(DIFF_TYPE).agg(F.count("*").alias("row_cnt"))


def matching_rate(rows: DataFrame) -> DataFrame:
    return compare_summary(rows).select("matching_rate")


def _compared(rows: DataFrame) -> list[tuple[str, bool]]:
    """Compared columns with whether they are numbers."""
    fields = rows.schema[SRC].dataType.fields
    return [(f.name, is_numeric(f.dataType)) for f in fields if KEY_ONLY not in f.metadata]


def column_stats(rows: DataFrame) -> DataFrame:
    """``(column_name, unequal_cnt, null_diff_cnt, max_abs_diff)`` over rows of both sides.

    Each differing row yields one small record per differing value, so the work follows
    the number of differences, not rows times columns. A record per column without
    any difference keeps that column in the result. Differences within the tolerance
    count for ``max_abs_diff`` only.
    """
    cells, none = [], []
    types = {f.name: f.dataType for f in rows.schema[SRC].dataType.fields}
    for name, numeric in _compared(rows):
        a, b = field(SRC, name), field(TGT, name)
        # Exact in the columns' own type; only the result is a double.
        gap = difference(a, b, types[name]).cast("double") if numeric else F.lit(None).cast("double")
        cell = [F.array_contains(F.col(DIFF_COLUMNS), name), a.isNull() != b.isNull(), gap]
        cells.append(F.when(~a.eqNullSafe(b), _cell(name, *cell)))
        none.append(_cell(name, F.lit(False), F.lit(False), F.lit(0.0 if numeric else None).cast("double")))
    if not cells:
        raise ValueError("no compared columns")
    differing = rows.where(F.col(DIFF_TYPE).isin(MATCH, MISMATCH) & ~F.col(SRC).eqNullSafe(F.col(TGT)))
    found = differing.select(F.inline(F.array_compact(F.array(*cells))))
    every = rows.sparkSession.range(1).select(F.inline(F.array(*none)))
    return (
        found.unionByName(every)
        .groupBy("column_name")
        .agg(
            F.count_if("unequal").alias("unequal_cnt"),
            F.count_if("null_differs").alias("null_diff_cnt"),
            F.max("gap").alias("max_abs_diff"),
        )
    )


def _cell(name: str, unequal: Column, null_differs: Column, gap: Column) -> Column:
    return F.struct(
        F.lit(name).alias("column_name"), unequal.alias("unequal"), null_differs.alias("null_differs"), gap.alias("gap")
    )


# Sentence of a comparison without data.
EMPTY_SENTENCE = "no data on either side"


def compare_sentence() -> Column:
    """The report in one sentence, over the columns of ``compare_summary``."""
    return F.when(F.greatest("src_cnt", "tgt_cnt") == 0, F.lit(EMPTY_SENTENCE)).otherwise(
        F.format_string(
            "compared: source %d rows, target %d rows, different %d",
            F.col("src_cnt"),
            F.col("tgt_cnt"),
            F.col("diff_cnt"),
        )
    )


def top_diffs(rows: DataFrame, keys: Sequence[str], n: int = 10) -> DataFrame:
    """The first differing keys in key order, with class and unequal columns."""
    keys = [*keys, *([OCCURRENCE] if OCCURRENCE in rows.columns else [])]
    return (
        rows.where(F.col(DIFF_TYPE) != MATCH)
        .select(*[F.col(f"`{k}`") for k in keys], DIFF_TYPE, F.array_join(DIFF_COLUMNS, ",").alias(DIFF_COLUMNS))
        .orderBy(*[F.col(f"`{k}`") for k in keys])
        .limit(n)
    )


SUMMARY_ITEMS = (
    "src_cnt",
    "tgt_cnt",
    "match_cnt",
    "mismatch_cnt",
    "src_only_cnt",
    "tgt_only_cnt",
    "diff_cnt",
    "matching_rate",
)


def compare_report(rows: DataFrame, keys: Sequence[str], sample: int = 10) -> DataFrame:
    """The report as rows ``(section, item, value)``.

    Section ``summary`` has the counts and the rate, ``column`` the statistics of
    each compared column, ``sample`` the first differing keys. The comparison runs once:
    rows that differ in any value are written down while all are counted, and the rest
    of the report starts from them.
    """

    def entry(section: str, item: Column, value: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), item.alias("item"), value.cast("double").alias("value"))

    counts = Observation()
    differs = (F.col(DIFF_TYPE) != MATCH) | ~F.col(SRC).eqNullSafe(F.col(TGT))
    rows = materialize(rows.observe(counts, *count_columns()).where(differs), "differences")
    seen = counts.get
    listed = {n: F.lit(v) for n, v in seen.items()}
    listed["matching_rate"] = rate(listed["match_cnt"], listed["src_cnt"], listed["tgt_cnt"])
    totals = rows.sparkSession.range(1).select(
        F.inline(F.array(*[entry("summary", F.lit(n), listed[n]) for n in SUMMARY_ITEMS]))
    )
    parts = [totals]
    if _compared(rows):
        names = ("unequal_cnt", "null_diff_cnt", "max_abs_diff")
        entries = [entry("column", F.concat(F.col("column_name"), F.lit(f".{n}")), F.col(n)) for n in names]
        # A column without numbers has no largest difference.
        stats = column_stats(rows).select(F.inline(F.array(*entries)))
        parts.append(stats.where(F.col("value").isNotNull()))
    first = top_diffs(rows, keys, sample)
    shown = [F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("NULL")) for k in keys]
    text = F.concat_ws(" ", F.concat_ws(",", *shown), F.col(DIFF_TYPE), F.nullif(F.col(DIFF_COLUMNS), F.lit("")))
    parts.append(
        first.select(F.lit("sample").alias("section"), text.alias("item"), F.lit(None).cast("double").alias("value"))
    )
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report
