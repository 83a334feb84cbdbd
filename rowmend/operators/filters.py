"""Restricting a comparison in time, and picking the results worth an alert."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmend.functions.times import in_window, parse_range, window_bounds


def incremental_filter(df: DataFrame, column: str | None, days: float | None, end: datetime) -> DataFrame:
    """Rows updated in the last ``days`` days before ``end``; all rows when off.

    The bounds are literals of the column's own type, so the filter reaches the scan.
    """
    if not column or days is None:
        return df
    return df.where(in_window(column, df.schema[column].dataType, *window_bounds(days, end)))


def range_filter(df: DataFrame, column: str, text: str) -> DataFrame:
    """Rows inside a recorded window ``[start,end)``; a malformed one is an error, not a full read."""
    return df.where(in_window(column, df.schema[column].dataType, *parse_range(text)))


def delete_where(df: DataFrame, predicate: Column | str) -> DataFrame:
    """The table without the rows that meet the predicate; an unknown outcome keeps the row."""
    met = F.expr(predicate) if isinstance(predicate, str) else predicate
    return df.where(~F.coalesce(met, F.lit(False)))


def needs_alert_compare(results: DataFrame, threshold: float = 0.0) -> DataFrame:
    """Result rows that failed or match less than ``1 - threshold``, with a message."""
    text = F.format_string(
        "table %s: %s.%s against %s.%s, status %s, different rows %d, matching rate %.2f%%, %s",
        F.col("table_id"),
        F.col("src_db_name"),
        F.col("src_table_name"),
        F.col("tgt_db_name"),
        F.col("tgt_table_name"),
        F.col("compare_status"),
        F.coalesce(F.col("diff_cnt"), F.lit(0)),
        F.coalesce(F.col("matching_rate"), F.lit(1.0)) * 100,
        F.coalesce(F.col("compare_msg"), F.lit("")),
    )
    low = F.coalesce(F.col("matching_rate"), F.lit(1.0)) < F.lit(1.0 - threshold)
    failed = F.coalesce(F.col("compare_status") == "fail", F.lit(False))
    return results.where(failed | low).withColumn("alert", text)


def needs_alert_repair(results: DataFrame) -> DataFrame:
    """Result rows whose repair failed, with a message."""
    text = F.format_string(
        "table %s: %s.%s into %s.%s, repair %s, repaired rows %d, %s",
        F.col("table_id"),
        F.col("src_db_name"),
        F.col("src_table_name"),
        F.col("tgt_db_name"),
        F.col("tgt_table_name"),
        F.col("repair_status"),
        F.coalesce(F.col("repair_cnt"), F.lit(0)),
        F.coalesce(F.col("repair_msg"), F.lit("")),
    )
    return results.where(F.col("repair_status") == "fail").withColumn("alert", text)
