"""Scans, column choice, windows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

import rowmend as rm
from catalog import tables as t
from rowmend.functions.times import format_range

KEY = ["o_orderkey"]
START, END = datetime(1998, 1, 1), datetime(1998, 7, 1)
DAYS = (END - START).days
KEY_LOW, KEY_HIGH, SLICES = 0, 999_999, 8


def scan_table(spark, sf):
    spec = t.file_table(spark, sf, "lineitem")
    return rm.scan_table(
        spark, spec, ["l_orderkey", "l_linenumber", "l_shipdate"], "l_quantity >= 25 AND l_shipdate >= '1998-01-01'"
    )


def scan_partitioned(spark, sf):
    spec = t.file_table(spark, sf, "lineitem")
    df = rm.scan_partitioned(spark, spec, "l_orderkey", KEY_LOW, KEY_HIGH, SLICES, ["l_orderkey"])
    return rm.slice_counts(df, "l_orderkey", KEY_LOW, KEY_HIGH, SLICES)


def first_rows(spark, sf):
    return rm.first_rows(t.orders(spark, sf), 50, ["o_totalprice", "o_orderkey"])


def row_count(spark, sf):
    return rm.row_count(t.orders(spark, sf), "o_totalprice >= 1000 AND o_orderdate < '1998-01-01'")


def table_metadata(spark, sf):
    return rm.table_metadata(t.orders_target(spark, sf), counts=True)


def schema_diff(spark, sf):
    return rm.schema_diff(t.orders(spark, sf), t.orders_drifted(spark, sf), counts=True)


def compare_columns(spark, sf):
    """The comparable columns of a table, read."""
    everything = t.table(spark, sf, "lineitem")
    roles = rm.compare_columns(everything.schema, ["l_orderkey", "l_linenumber"], "l_shipdate", "l_tax, l_discount")
    return everything.select(*roles.all)


def drop_sensitive(spark, sf):
    return rm.drop_sensitive(t.customer(spark, sf), " c_name , c_acctbal", ["c_custkey"])


def common_columns(spark, sf):
    src, tgt = t.orders(spark, sf), t.orders_drifted(spark, sf)
    return src.select(*rm.common_columns(src, tgt, KEY))


def fold_names(spark, sf):
    df = t.customer(spark, sf)
    return rm.fold_names(df.toDF(*[c.upper() for c in df.columns]))


def encrypt_roundtrip(spark, sf):
    key = F.rpad(F.lit("sixteen byte key"), 16, "0")
    sealed = t.customer(spark, sf).select("c_custkey", rm.encrypt_column(F.col("c_name"), key).alias("sealed"))
    return sealed.select(
        "c_custkey",
        F.length(F.unbase64("sealed")).cast("bigint").alias("sealed_bytes"),
        rm.decrypt_column(F.col("sealed"), key).alias("opened"),
    )


def incremental_compare(spark, sf):
    src = rm.incremental_filter(t.orders(spark, sf), "o_orderdate", DAYS, END)
    tgt = rm.incremental_filter(t.orders_target(spark, sf), "o_orderdate", DAYS, END)
    return rm.compare_summary(rm.compare_rows(src, tgt, KEY))


def range_compare(spark, sf):
    text = format_range(START, END)
    src = rm.range_filter(t.orders(spark, sf), "o_orderdate", text)
    tgt = rm.range_filter(t.orders_target(spark, sf), "o_orderdate", text)
    return rm.diff_summary(rm.compare_rows(src, tgt, KEY))


def recorded_ranges(spark, sf):
    """The span of each customer's orders as a recorded window; a single moment is written without brackets."""
    first, last = F.min("o_orderdate"), F.max("o_orderdate")
    text = F.when(
        F.col("first") < F.col("last"),
        F.concat(F.lit("["), F.col("first").cast("string"), F.lit(","), F.col("last").cast("string"), F.lit(")")),
    ).otherwise(F.col("first").cast("string"))
    spans = t.orders(spark, sf).groupBy("o_custkey").agg(first.alias("first"), last.alias("last"))
    return rm.with_range_bounds(spans.select("o_custkey", text.alias("check_range")))


def composite_slices(spark, sf):
    """Lines in slices of equal numbers of rows by order and line number, whose pairs repeat."""
    lines = t.lineitem(spark, sf)
    keys = ["l_orderkey", "l_linenumber"]
    return rm.count_slices(lines, rm.slice_conditions(rm.equal_cuts(lines, keys, COMPOSITE), keys))


def composite_slices_flag(spark, sf):
    """A first column of three values, each with a third of the rows: the second one cuts inside them."""
    lines = t.table(spark, sf, "lineitem", ["l_returnflag", "l_shipdate"])
    keys = ["l_returnflag", "l_shipdate"]
    return rm.count_slices(lines, rm.slice_conditions(rm.equal_cuts(lines, keys, COMPOSITE), keys))


COMPOSITE = 16

QUERIES = {
    "scan_table": scan_table,
    "scan_partitioned": scan_partitioned,
    "first_rows": first_rows,
    "row_count": row_count,
    "table_metadata": table_metadata,
    "schema_diff": schema_diff,
    "compare_columns": compare_columns,
    "drop_sensitive": drop_sensitive,
    "common_columns": common_columns,
    "fold_names": fold_names,
    "encrypt_roundtrip": encrypt_roundtrip,
    "incremental_compare": incremental_compare,
    "range_compare": range_compare,
    "recorded_ranges": recorded_ranges,
    "composite_slices": composite_slices,
    "composite_slices_flag": composite_slices_flag,
}


def _slices_sql(a: str, b: str) -> str:
    """Slices between the keys at equal steps of all rows in order, each key once."""
    return f"""
        WITH r AS (SELECT {a} AS a, {b} AS b, row_number() OVER (ORDER BY {a}, {b}) - 1 AS p, count(*) OVER () AS n FROM lineitem),
        starts AS (SELECT DISTINCT a, b FROM r JOIN range({COMPOSITE}) k(i) ON p = i * (n // {COMPOSITE}) + least(i, n % {COMPOSITE})),
        cuts AS (SELECT a, b, row_number() OVER (ORDER BY a, b) - 1 AS slice FROM starts),
        counts AS (SELECT a, b, count(*) AS c FROM r GROUP BY a, b)
        SELECT max(slice)::INTEGER AS slice, sum(c)::BIGINT AS row_cnt, 1::INTEGER AS hits FROM (
            SELECT k.a, k.b, k.c, max(s.slice) AS slice FROM counts k JOIN cuts s ON s.a < k.a OR (s.a = k.a AND s.b <= k.b)
            GROUP BY k.a, k.b, k.c) GROUP BY slice"""

WINDOW = "o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1998-07-01'"
WITH_WINDOW = f"""WITH whole_src AS (SELECT {', '.join(t.ORDERS_COLUMNS)} FROM orders),
    src AS (SELECT * FROM whole_src WHERE {WINDOW}),
    whole_tgt AS ({t.ORDERS_TARGET.format(orders='orders')}),
    tgt AS (SELECT * FROM whole_tgt WHERE {WINDOW}), {t.SQL_JOINED}"""

SQL = {
    "scan_table": """SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem
        WHERE l_quantity >= 25 AND l_shipdate >= TIMESTAMP '1998-01-01'""",
    "scan_partitioned": """
        SELECT CAST(least(greatest(coalesce(l_orderkey, 0), 0) // 125000, 7) AS INTEGER) AS slice, count(*) AS row_cnt
        FROM lineitem GROUP BY 1""",
    "first_rows": f"""SELECT {', '.join(t.ORDERS_COLUMNS)} FROM orders
        ORDER BY o_totalprice ASC NULLS FIRST, o_orderkey LIMIT 50""",
    "row_count": """SELECT count(*) AS row_cnt FROM orders
        WHERE o_totalprice >= 1000 AND o_orderdate < TIMESTAMP '1998-01-01'""",
    "table_metadata": f"""WITH {t.SQL_TGT}
        SELECT 1::INTEGER AS position, 'o_orderkey' AS name, 'bigint' AS type, count(o_orderkey) AS non_null_cnt FROM tgt
        UNION ALL SELECT 2, 'o_custkey', 'bigint', count(o_custkey) FROM tgt
        UNION ALL SELECT 3, 'o_totalprice', 'double', count(o_totalprice) FROM tgt
        UNION ALL SELECT 4, 'o_orderdate', 'timestamp_ntz', count(o_orderdate) FROM tgt""",
    "schema_diff": f"""WITH {t.SQL_SRC}, {t.SQL_TGT}, drifted AS ({t.ORDERS_DRIFTED.format(target='tgt')})
        SELECT 'o_custkey' AS name, 'src_only' AS difference, 'bigint' AS src_type, NULL::VARCHAR AS tgt_type,
               (SELECT count(o_custkey) FROM src) AS src_filled, 0::BIGINT AS tgt_filled
        UNION ALL SELECT 'o_totalprice', 'type_differs', 'double', 'string',
               (SELECT count(o_totalprice) FROM src), (SELECT count(o_totalprice) FROM drifted)
        UNION ALL SELECT 't_mark', 'tgt_only', NULL, 'bigint', 0, (SELECT count(t_mark) FROM drifted)""",
    "compare_columns": """SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice
        FROM lineitem""",
    "drop_sensitive": "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer",
    "common_columns": "SELECT o_orderkey, o_totalprice, o_orderdate FROM orders",
    "fold_names": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "encrypt_roundtrip": """SELECT c_custkey, CAST(16 + 16 * (strlen(c_name) // 16 + 1) AS BIGINT) AS sealed_bytes,
        c_name AS opened FROM customer""",
    "incremental_compare": f"{WITH_WINDOW} {t.summary_sql()}",
    "recorded_ranges": """
        WITH spans AS (SELECT o_custkey, min(o_orderdate) AS a, max(o_orderdate) AS b FROM orders GROUP BY o_custkey),
        texts AS (SELECT *, strftime(a, '%Y-%m-%d %H:%M:%S') AS ta, strftime(b, '%Y-%m-%d %H:%M:%S') AS tb FROM spans)
        SELECT o_custkey, CASE WHEN a < b THEN '[' || ta || ',' || tb || ')' ELSE ta END AS check_range,
               CASE WHEN a < b THEN a END AS range_start, CASE WHEN a < b THEN b END AS range_end,
               CASE WHEN a < b THEN NULL ELSE 'not a check range: ' || ta END AS range_error
        FROM texts""",
    "range_compare": f"{WITH_WINDOW} SELECT diff_type, count(*) AS row_cnt FROM joined GROUP BY diff_type",
}

SQL |= {
    "composite_slices": _slices_sql("l_orderkey", "l_linenumber"),
    "composite_slices_flag": _slices_sql("l_returnflag", "l_shipdate"),
}
