"""Row comparison and its summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

import rowmend as rm
from catalog import tables as t

KEY = ["o_orderkey"]
LINE_KEY = ["l_orderkey", "l_linenumber"]
VALUES = [c for c in t.ORDERS_COLUMNS if c not in KEY]


def compared_orders(spark, sf, primary_key=False):
    rows = rm.compare_rows(t.orders(spark, sf), t.orders_target(spark, sf), KEY, primary_key=primary_key)
    return rows.drop("occurrence")


def flat(rows, values):
    """Both records as columns ``src_*`` and ``tgt_*``; keys of customers as text, since one side may lack them."""
    columns = [(side, v, F.col(f"{side}.{v}")) for side in ("src", "tgt") for v in values]
    records = [(c.cast("string") if v == "o_custkey" else c).alias(f"{side}_{v}") for side, v, c in columns]
    others = [c for c in rows.columns if c not in ("src", "tgt", "diff_columns")]
    listed = [F.array_join("diff_columns", ",").alias("diff_columns")] if "diff_columns" in rows.columns else []
    return rows.select(*others, *records, *listed)


def compare_summary(spark, sf):
    return rm.compare_summary(compared_orders(spark, sf))


def compare_summary_primary_key(spark, sf):
    """The same by one join, the key being declared unique."""
    return rm.compare_summary(compared_orders(spark, sf, primary_key=True))


def compare_all_rows(spark, sf):
    return flat(compared_orders(spark, sf), VALUES)


def matching_rate(spark, sf):
    return rm.matching_rate(compared_orders(spark, sf))


def diff_summary(spark, sf):
    return rm.diff_summary(compared_orders(spark, sf))


def side_counts(spark, sf):
    return rm.side_counts(t.orders(spark, sf), t.orders_target(spark, sf))


def summary_by_customer(spark, sf):
    who = F.coalesce(F.col("src.o_custkey"), F.col("tgt.o_custkey"))
    return rm.compare_summary(compared_orders(spark, sf), {"custkey": who})


def src_only_rows(spark, sf):
    return rm.src_only_rows(t.orders(spark, sf), t.orders_target(spark, sf), KEY)


def tgt_only_keys(spark, sf):
    return rm.tgt_only_keys(t.orders(spark, sf), t.orders_target(spark, sf), KEY)


def mismatch_keys(spark, sf):
    return rm.mismatch_keys(t.orders(spark, sf), t.orders_target(spark, sf), KEY)


def mismatch_pairs(spark, sf):
    return flat(rm.mismatch_pairs(t.orders(spark, sf), t.orders_target(spark, sf), KEY).drop("occurrence"), VALUES)


def mismatch_pairs_primary_key(spark, sf):
    return flat(rm.mismatch_pairs(t.orders(spark, sf), t.orders_target(spark, sf), KEY, primary_key=True), VALUES)


def src_only_rows_primary_key(spark, sf):
    return rm.src_only_rows(t.orders(spark, sf), t.orders_target(spark, sf), KEY, primary_key=True)


def key_only_compare(spark, sf):
    return rm.key_only_compare(t.orders(spark, sf), t.orders_target(spark, sf), KEY).drop("occurrence")


def composite_key_compare(spark, sf):
    rows = rm.compare_rows(t.lineitem(spark, sf), t.lineitem_target(spark, sf), LINE_KEY)
    return rm.compare_summary(rows)


def duplicate_pairing(spark, sf):
    rows = rm.compare_rows(t.lineitem(spark, sf), t.lineitem_target(spark, sf), LINE_KEY)
    return flat(rows, ["l_quantity", "l_extendedprice"])


def duplicate_pairing_hot(spark, sf):
    """Three keys, each with a third of the table: numbered across tasks."""
    columns = ["l_returnflag", "l_quantity", "l_discount", "l_tax"]
    src = t.table(spark, sf, "lineitem", columns)
    tgt = t.table(spark, sf, "lineitem", [*columns, "l_partkey"])
    tgt = tgt.withColumn("l_tax", F.expr("CASE WHEN l_partkey % 53 = 0 THEN NULL ELSE l_tax END")).drop("l_partkey")
    rows = rm.compare_rows(src, tgt, ["l_returnflag"], hot_rows=1000)
    return flat(rows, columns[1:])


def key_audit(spark, sf):
    return rm.key_audit(t.lineitem(spark, sf), LINE_KEY)


def occurrence_numbers(spark, sf):
    src = t.table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"])
    return rm.number_occurrences(src, LINE_KEY)


def tolerance_compare(spark, sf):
    rows = rm.compare_rows(t.events(spark, sf), t.events_target(spark, sf), ["event_id"], abs_tol=0.01, rel_tol=1e-6)
    return rows.select("event_id", "diff_type", F.array_join("diff_columns", ",").alias("diff_columns"))


def unify_types(spark, sf):
    a, b = rm.unify_types(t.orders(spark, sf), t.orders_retyped(spark, sf))
    return rm.compare_summary(rm.compare_rows(a, b, KEY))


def column_stats(spark, sf):
    return rm.column_stats(compared_orders(spark, sf))


def compare_report(spark, sf):
    return rm.compare_report(compared_orders(spark, sf), KEY, 10)


def top_diffs(spark, sf):
    return rm.top_diffs(compared_orders(spark, sf), KEY, 20)


def duplicate_pairing_least(spark, sf):
    """The differing lines once equal ones have cancelled out, with all compared values."""
    found = rm.compare_least(t.lineitem(spark, sf), t.lineitem_target(spark, sf), LINE_KEY)
    return flat(found.rows, LINE_VALUES)


def least_counts(spark, sf):
    found = rm.compare_least(t.lineitem(spark, sf), t.lineitem_target(spark, sf), LINE_KEY)
    return rm.diff_summary(found.rows).unionByName(spark.range(1).select(F.lit("match").alias("diff_type"), F.lit(found.match_cnt).cast("long").alias("row_cnt")))


def digest_compare(spark, sf):
    """The differing orders, found by digests of ranges first."""
    found = rm.digest_compare(t.orders(spark, sf), t.orders_target(spark, sf), KEY)
    return flat(found.differences().drop("occurrence"), VALUES)


def digest_summary(spark, sf):
    return rm.digest_compare(t.lineitem(spark, sf), t.lineitem_target(spark, sf), LINE_KEY).summary()


def digest_compare_local(spark, sf):
    """A target that differs in a stretch of its keys only: the other ranges are read once."""
    tgt = spark.sql(LOCAL_TARGET, orders=t.orders(spark, sf))
    return flat(rm.digest_compare(t.orders(spark, sf), tgt, KEY, leaf_rows=100).differences().drop("occurrence"), VALUES)


def confirmed_differences(spark, sf):
    """Orders that differed, looked at again in a target that was written to meanwhile."""
    src, first = t.orders(spark, sf), t.orders_target(spark, sf)
    rows = rm.materialize(rm.compare_rows(src, first, KEY, primary_key=True).where("diff_type <> 'match'"), "diff")
    later = spark.sql(LATER_TARGET, orders=src, target=first)
    found = rm.confirm_differences(rows, src, later, KEY, primary_key=True)
    return flat(found, VALUES)


# The copy caught up with some orders, and others were changed once more.
LATER_TARGET = """
SELECT t.o_orderkey, t.o_custkey,
       CASE WHEN t.o_orderkey % 3 = 0 THEN s.o_totalprice WHEN t.o_orderkey % 3 = 1 AND t.o_orderkey % 53 = 0 THEN t.o_totalprice + 1
            ELSE t.o_totalprice END AS o_totalprice,
       CASE WHEN t.o_orderkey % 3 = 0 THEN s.o_orderdate ELSE t.o_orderdate END AS o_orderdate
FROM {target} t LEFT JOIN {orders} s ON s.o_orderkey = t.o_orderkey
"""
LINE_VALUES = [c for c in t.LINEITEM_COLUMNS if c not in LINE_KEY]
LOCAL_TARGET = """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 5 = 0 AND o_orderkey < 700 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
       o_orderdate FROM {orders} WHERE o_orderkey NOT BETWEEN 300 AND 320
"""

QUERIES = {
    "compare_summary": compare_summary,
    "compare_summary_primary_key": compare_summary_primary_key,
    "compare_rows": compare_all_rows,
    "matching_rate": matching_rate,
    "diff_summary": diff_summary,
    "side_counts": side_counts,
    "compare_summary_by_customer": summary_by_customer,
    "src_only_rows": src_only_rows,
    "tgt_only_keys": tgt_only_keys,
    "mismatch_keys": mismatch_keys,
    "mismatch_pairs": mismatch_pairs,
    "mismatch_pairs_primary_key": mismatch_pairs_primary_key,
    "src_only_rows_primary_key": src_only_rows_primary_key,
    "key_only_compare": key_only_compare,
    "composite_key_compare": composite_key_compare,
    "duplicate_pairing": duplicate_pairing,
    "duplicate_pairing_hot": duplicate_pairing_hot,
    "occurrence_numbers": occurrence_numbers,
    "key_audit": key_audit,
    "tolerance_compare": tolerance_compare,
    "unify_types": unify_types,
    "column_stats": column_stats,
    "compare_report": compare_report,
    "top_diffs": top_diffs,
    "duplicate_pairing_least": duplicate_pairing_least,
    "least_counts": least_counts,
    "digest_compare": digest_compare,
    "digest_summary": digest_summary,
    "digest_compare_local": digest_compare_local,
    "confirmed_differences": confirmed_differences,
}

DIFF_COLUMNS_SQL = """
CASE WHEN diff_type <> 'mismatch' THEN '' ELSE concat_ws(',',
  CASE WHEN src_o_custkey IS DISTINCT FROM tgt_o_custkey THEN 'o_custkey' END,
  CASE WHEN src_o_totalprice IS DISTINCT FROM tgt_o_totalprice THEN 'o_totalprice' END,
  CASE WHEN src_o_orderdate IS DISTINCT FROM tgt_o_orderdate THEN 'o_orderdate' END) END AS diff_columns
"""
AS_TEXT = "* REPLACE (src_o_custkey::VARCHAR AS src_o_custkey, tgt_o_custkey::VARCHAR AS tgt_o_custkey)"
BOTH = "diff_type IN ('match', 'mismatch')"


def _paired_sql(source: str, target: str, keys: list[str], values: list[str]) -> str:
    """Common table expression `paired`: rows of both sides matched by key and occurrence."""
    order = ", ".join(f"{v} ASC NULLS FIRST" for v in values)
    number = f"row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {order}) AS occurrence"
    on = " AND ".join(f"s.{k} = t.{k}" for k in [*keys, "occurrence"])
    same = " OR ".join(f"s.{v} IS DISTINCT FROM t.{v}" for v in values)
    shown = ", ".join(f"s.{v} AS src_{v}, t.{v} AS tgt_{v}" for v in values)
    unequal = ", ".join(f"CASE WHEN s.{v} IS DISTINCT FROM t.{v} THEN '{v}' END" for v in values)
    absent = f"s.{keys[0]} IS NULL OR t.{keys[0]} IS NULL"
    return f"""
    s AS (SELECT *, {number} FROM ({source})), t AS (SELECT *, {number} FROM ({target})),
    paired AS (
      SELECT {', '.join(f'coalesce(s.{k}, t.{k}) AS {k}' for k in [*keys, 'occurrence'])},
             CASE WHEN t.{keys[0]} IS NULL THEN 'src_only' WHEN s.{keys[0]} IS NULL THEN 'tgt_only'
                  WHEN {same} THEN 'mismatch' ELSE 'match' END AS diff_type,
             CASE WHEN {absent} THEN '' ELSE concat_ws(',', {unequal}) END AS diff_columns,
             {shown}
      FROM s FULL JOIN t ON {on})
    """


LINES = f"SELECT {', '.join(t.LINEITEM_COLUMNS)} FROM lineitem"
PAIRED_LINES = _paired_sql(LINES, t.LINEITEM_TARGET.format(lineitem="lineitem"), LINE_KEY, LINE_VALUES)


def _least_sql(source: str, target: str, keys: list[str], values: list[str]) -> str:
    """Common table expression `least`: what is left of both sides after equal rows, paired by value order within a key."""
    text = _paired_sql("SELECT * FROM src_left", "SELECT * FROM tgt_left", keys, values)
    return f"src_all AS ({source}), tgt_all AS ({target}), src_left AS (SELECT * FROM src_all EXCEPT ALL SELECT * FROM tgt_all), " + (
        f"tgt_left AS (SELECT * FROM tgt_all EXCEPT ALL SELECT * FROM src_all), {text}"
    )


LEAST_LINES = _least_sql(LINES, t.LINEITEM_TARGET.format(lineitem="lineitem"), LINE_KEY, LINE_VALUES)
LOCAL_JOINED = f"WITH {t.SQL_SRC}, tgt AS ({LOCAL_TARGET.format(orders='orders')}), {t.SQL_JOINED}"
HOT_LINES = _paired_sql(
    "SELECT l_returnflag, l_quantity, l_discount, l_tax FROM lineitem",
    "SELECT l_returnflag, l_quantity, l_discount, CASE WHEN l_partkey % 53 = 0 THEN NULL ELSE l_tax END AS l_tax FROM lineitem",
    ["l_returnflag"],
    ["l_quantity", "l_discount", "l_tax"],
)

STAT_SQL = """
SELECT '{c}' AS column_name, count(*) FILTER (WHERE {both} AND src_{c} IS DISTINCT FROM tgt_{c}) AS unequal_cnt,
       count(*) FILTER (WHERE {both} AND (src_{c} IS NULL) <> (tgt_{c} IS NULL)) AS null_diff_cnt,
       {gap} AS max_abs_diff
FROM joined
"""


def _stat(column: str, numeric: bool) -> str:
    largest = f"coalesce(max(abs(src_{column}::DOUBLE - tgt_{column}::DOUBLE)) FILTER (WHERE {BOTH}), 0)"
    gap = largest if numeric else "NULL::DOUBLE"
    return STAT_SQL.format(c=column, both=BOTH, gap=gap)


STATS = " UNION ALL ".join([_stat("o_custkey", True), _stat("o_totalprice", True), _stat("o_orderdate", False)])

RETYPED_JOINED = """
joined AS (
  SELECT CASE WHEN r.o_orderkey IS NULL THEN 'src_only' WHEN s.o_orderkey IS NULL THEN 'tgt_only'
              WHEN CAST(s.o_custkey AS VARCHAR) IS DISTINCT FROM r.o_custkey
                OR s.o_totalprice IS DISTINCT FROM CAST(r.o_totalprice AS DOUBLE)
                OR s.o_orderdate IS DISTINCT FROM CAST(r.o_orderdate AS TIMESTAMP) THEN 'mismatch'
              ELSE 'match' END AS diff_type
  FROM src s FULL JOIN retyped r ON s.o_orderkey = r.o_orderkey)
"""

SQL = {
    "compare_summary": f"{t.WITH_ORDERS} {t.summary_sql()}",
    "compare_rows": f"{t.WITH_ORDERS} SELECT {AS_TEXT}, {DIFF_COLUMNS_SQL} FROM joined",
    "matching_rate": f"{t.WITH_ORDERS} SELECT matching_rate FROM ({t.summary_sql()})",
    "diff_summary": f"{t.WITH_ORDERS} SELECT diff_type, count(*) AS row_cnt FROM joined GROUP BY diff_type",
    "side_counts": f"WITH {t.SQL_TGT} SELECT (SELECT count(*) FROM orders) AS src_cnt, (SELECT count(*) FROM tgt) AS tgt_cnt",
    "compare_summary_by_customer": f"""{t.WITH_ORDERS},
        by_customer AS (SELECT *, coalesce(src_o_custkey, tgt_o_custkey) AS custkey FROM joined)
        {t.summary_sql('by_customer', 'custkey')}""",
    "src_only_rows": f"WITH {t.SQL_SRC}, {t.SQL_TGT} SELECT * FROM src WHERE o_orderkey NOT IN (SELECT o_orderkey FROM tgt)",
    "tgt_only_keys": f"WITH {t.SQL_TGT} SELECT o_orderkey FROM tgt WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders)",
    "mismatch_keys": f"{t.WITH_ORDERS} SELECT o_orderkey FROM joined WHERE diff_type = 'mismatch'",
    "compare_summary_primary_key": f"{t.WITH_ORDERS} {t.summary_sql()}",
    "mismatch_pairs_primary_key": f"""{t.WITH_ORDERS}
        SELECT {AS_TEXT} FROM (SELECT * EXCLUDE (diff_type) FROM joined WHERE diff_type = 'mismatch')""",
    "src_only_rows_primary_key": f"""WITH {t.SQL_SRC}, {t.SQL_TGT}
        SELECT * FROM src WHERE o_orderkey NOT IN (SELECT o_orderkey FROM tgt)""",
    "mismatch_pairs": f"""{t.WITH_ORDERS}
        SELECT {AS_TEXT} FROM (SELECT * EXCLUDE (diff_type) FROM joined WHERE diff_type = 'mismatch')""",
    "key_only_compare": f"""{t.WITH_ORDERS}
        SELECT o_orderkey, diff_type FROM joined WHERE diff_type IN ('src_only', 'tgt_only')""",
    "composite_key_compare": f"WITH {PAIRED_LINES} {t.summary_sql('paired')}",
    "duplicate_pairing": f"""WITH {PAIRED_LINES}
        SELECT l_orderkey, l_linenumber, occurrence, diff_type, diff_columns, src_l_quantity, tgt_l_quantity,
               src_l_extendedprice, tgt_l_extendedprice FROM paired""",
    "duplicate_pairing_hot": f"WITH {HOT_LINES} SELECT * FROM paired",
    "occurrence_numbers": """
        SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
               row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                  ORDER BY l_quantity ASC NULLS FIRST, l_extendedprice ASC NULLS FIRST) AS occurrence
        FROM lineitem""",
    "key_audit": """
        SELECT l_orderkey, l_linenumber, count(*) AS row_cnt, l_orderkey IS NULL OR l_linenumber IS NULL AS has_null
        FROM lineitem GROUP BY l_orderkey, l_linenumber
        HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""",
    "tolerance_compare": f"""
        WITH s AS (SELECT event_id, user_id, ts, value FROM events),
        t AS ({t.EVENTS_TARGET.format(events="events")}),
        j AS (SELECT coalesce(s.event_id, t.event_id) AS event_id,
                     s.event_id IS NULL AS no_src, t.event_id IS NULL AS no_tgt,
                     s.user_id IS DISTINCT FROM t.user_id AS user_differs, s.ts IS DISTINCT FROM t.ts AS ts_differs,
                     s.value IS DISTINCT FROM t.value
                       AND NOT coalesce(abs(s.value - t.value) <= 0.01::DOUBLE + 1e-6::DOUBLE * abs(t.value), FALSE)
                       AS value_differs
              FROM s FULL JOIN t ON s.event_id = t.event_id)
        SELECT event_id,
               CASE WHEN no_tgt THEN 'src_only' WHEN no_src THEN 'tgt_only'
                    WHEN user_differs OR ts_differs OR value_differs THEN 'mismatch' ELSE 'match' END AS diff_type,
               CASE WHEN no_src OR no_tgt THEN '' ELSE concat_ws(',',
                 CASE WHEN user_differs THEN 'user_id' END, CASE WHEN ts_differs THEN 'ts' END,
                 CASE WHEN value_differs THEN 'value' END) END AS diff_columns
        FROM j""",
    "unify_types": f"""WITH {t.SQL_SRC}, {t.SQL_TGT}, retyped AS ({t.ORDERS_RETYPED.format(target="tgt")}),
        {RETYPED_JOINED} {t.summary_sql()}""",
    "column_stats": f"{t.WITH_ORDERS} {STATS}",
    "compare_report": f"""{t.WITH_ORDERS},
        totals AS ({t.summary_sql()}), stats AS ({STATS}),
        listed AS (SELECT o_orderkey, diff_type, {DIFF_COLUMNS_SQL} FROM joined
                   WHERE diff_type <> 'match' ORDER BY o_orderkey LIMIT 10)
        {' UNION ALL '.join(
            f"SELECT 'summary' AS section, '{n}' AS item, {n}::DOUBLE AS value FROM totals"
            for n in ('src_cnt', 'tgt_cnt', 'match_cnt', 'mismatch_cnt', 'src_only_cnt', 'tgt_only_cnt', 'diff_cnt',
                      'matching_rate'))}
        UNION ALL SELECT 'column', column_name || '.unequal_cnt', unequal_cnt::DOUBLE FROM stats
        UNION ALL SELECT 'column', column_name || '.null_diff_cnt', null_diff_cnt::DOUBLE FROM stats
        UNION ALL SELECT 'column', column_name || '.max_abs_diff', max_abs_diff FROM stats
                  WHERE column_name <> 'o_orderdate'
        UNION ALL SELECT 'sample', concat_ws(' ', o_orderkey::VARCHAR, diff_type, nullif(diff_columns, '')), NULL::DOUBLE
                  FROM listed""",
    "top_diffs": f"""{t.WITH_ORDERS}
        SELECT o_orderkey, diff_type, {DIFF_COLUMNS_SQL} FROM joined WHERE diff_type <> 'match'
        ORDER BY o_orderkey LIMIT 20""",
}

SQL |= {
    "duplicate_pairing_least": f"WITH {LEAST_LINES} SELECT * FROM paired",
    "least_counts": f"""WITH {LEAST_LINES} SELECT diff_type, count(*) AS row_cnt FROM paired GROUP BY diff_type
        UNION ALL SELECT 'match', (SELECT count(*) FROM src_all) - (SELECT count(*) FROM src_left)""",
    "digest_compare": f"{t.WITH_ORDERS} SELECT {AS_TEXT}, {DIFF_COLUMNS_SQL} FROM joined WHERE diff_type <> 'match'",
    "digest_summary": SQL["composite_key_compare"],
    "digest_compare_local": f"{LOCAL_JOINED} SELECT {AS_TEXT}, {DIFF_COLUMNS_SQL} FROM joined WHERE diff_type <> 'match'",
    "confirmed_differences": f"""{t.WITH_ORDERS}, later AS ({LATER_TARGET.format(target='tgt', orders='src')}),
        again AS (
          SELECT j.*, l.o_orderkey IS NULL AS no_tgt, l.o_custkey AS c, l.o_totalprice AS p, l.o_orderdate AS d,
                 CASE WHEN l.o_orderkey IS NULL THEN 'src_only' WHEN j.diff_type = 'tgt_only' THEN 'tgt_only'
                      WHEN src_o_custkey IS DISTINCT FROM l.o_custkey OR src_o_totalprice IS DISTINCT FROM l.o_totalprice
                        OR src_o_orderdate IS DISTINCT FROM l.o_orderdate THEN 'mismatch' ELSE 'match' END AS now
          FROM joined j LEFT JOIN later l ON l.o_orderkey = j.o_orderkey WHERE j.diff_type <> 'match'),
        states AS (
          SELECT *, CASE WHEN now = 'match' OR (now = 'src_only' AND diff_type = 'tgt_only') THEN 'resolved'
                         WHEN c IS NOT DISTINCT FROM tgt_o_custkey AND p IS NOT DISTINCT FROM tgt_o_totalprice
                          AND d IS NOT DISTINCT FROM tgt_o_orderdate THEN 'confirmed' ELSE 'changed' END AS state FROM again)
        SELECT o_orderkey, CASE WHEN state = 'changed' THEN now ELSE diff_type END AS diff_type,
               src_o_custkey::VARCHAR AS src_o_custkey, src_o_totalprice, src_o_orderdate,
               CASE WHEN state = 'changed' THEN c ELSE tgt_o_custkey END::VARCHAR AS tgt_o_custkey,
               CASE WHEN state = 'changed' THEN p ELSE tgt_o_totalprice END AS tgt_o_totalprice,
               CASE WHEN state = 'changed' THEN d ELSE tgt_o_orderdate END AS tgt_o_orderdate, state FROM states""",
}
