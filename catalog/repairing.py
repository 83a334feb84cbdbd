"""Choosing what to repair, and the repaired tables."""

from __future__ import annotations

from pyspark.sql import functions as F

import rowmend as rm
from catalog import tables as t
from catalog.reading import END, START, WINDOW

KEY = ["o_orderkey"]
TIME = "o_orderdate"
BATCH = 100


def diff(spark, sf, windowed=False):
    """The differing rows, written down once: selection, patch and checks all start from them."""
    src, tgt = t.orders(spark, sf), t.orders_target(spark, sf)
    if windowed:
        days = (END - START).days
        src, tgt = (rm.incremental_filter(side, TIME, days, END) for side in (src, tgt))
    return rm.materialize(rm.compare_rows(src, tgt, KEY).where("diff_type <> 'match'").drop("occurrence"), "diff")


def chosen(spark, sf, windowed=False, time_filter=True):
    rows = diff(spark, sf, windowed)
    return rm.repair_keys(rows, t.orders_target(spark, sf), KEY, TIME, 0.0, time_filter)


def patch_of(spark, sf, target, time_filter=True):
    wanted = rm.materialize(chosen(spark, sf, time_filter=time_filter), "keys")
    return rm.materialize(rm.repair_rows(t.orders(spark, sf), target, wanted, KEY), "patch"), wanted


def mismatch_to_repair(spark, sf):
    return rm.mismatch_to_repair(diff(spark, sf), KEY, TIME)


def src_only_recheck(spark, sf):
    return rm.src_only_to_repair(diff(spark, sf, windowed=True), t.orders_target(spark, sf), KEY, TIME)


def repair_keys(spark, sf):
    return chosen(spark, sf, time_filter=False)


def repair_keys_time_filtered(spark, sf):
    return chosen(spark, sf, windowed=True)


def lookup_target(spark, sf):
    wanted = diff(spark, sf, windowed=True).where("diff_type = 'src_only'")
    return rm.lookup_target(wanted, t.orders_target(spark, sf), KEY, [TIME])


def repair_gate(spark, sf):
    rows = rm.compare_rows(t.orders(spark, sf), t.orders_target(spark, sf), KEY)
    who = F.coalesce(F.col("src.o_custkey"), F.col("tgt.o_custkey"))
    gated = rm.repair_gate(rm.compare_summary(rows, {"custkey": who}), True, 2)
    return gated.select("custkey", "diff_cnt", "repair_status", "repair_msg")


def repair_batches(spark, sf):
    return rm.assign_batches(chosen(spark, sf), KEY, BATCH)


def global_rank(spark, sf):
    return rm.global_rank(t.orders(spark, sf).select("o_totalprice", "o_orderkey"), ["o_totalprice", "o_orderkey"])


def repair_predicates(spark, sf):
    return rm.repair_predicates(rm.assign_batches(chosen(spark, sf), KEY, BATCH), KEY)


def repair_predicates_composite(spark, sf):
    keys = ["l_orderkey", "l_linenumber"]
    src, tgt = t.lineitem(spark, sf), t.lineitem_target(spark, sf)
    rows = rm.materialize(rm.compare_rows(src, tgt, keys).where("diff_type <> 'match'"), "diff")
    wanted = rm.repair_keys(rows, tgt, keys, time_filter=False)
    return rm.repair_predicates(rm.assign_batches(wanted, keys, BATCH), keys)


def repair_rows(spark, sf):
    return patch_of(spark, sf, t.orders_drifted(spark, sf))[0]


def empty_selection(spark, sf):
    """No key survives a tolerance of 100 years, so no source row is read for repair; without it there are some."""
    rows = diff(spark, sf).where("tgt.o_orderdate IS NOT NULL")
    found = []
    for name, tolerance in (("none", 100 * 365 * 86400.0), ("some", 0.0)):
        wanted = rm.materialize(rm.mismatch_to_repair(rows, KEY, TIME, tolerance), "keys")
        found.append(rm.row_count(rm.rows_of_keys(t.orders(spark, sf), wanted, KEY)).withColumn("tolerance", F.lit(name)))
    return found[0].unionByName(found[1])


def repair_window_scope(spark, sf):
    src, tgt = t.orders(spark, sf), t.orders_marked(spark, sf)
    return rm.repair_window(src, tgt, KEY, "window", TIME, (START, END))


def repair_full_scope(spark, sf):
    return rm.repair_window(t.orders(spark, sf), t.orders_drifted(spark, sf), KEY, "full")


def _applied(spark, sf, mode):
    target = t.orders_marked(spark, sf)
    patch, _ = patch_of(spark, sf, target)
    return rm.apply_repair(target, patch, KEY, mode, primary_key=True)


def apply_insert(spark, sf):
    return _applied(spark, sf, "insert")


def apply_update(spark, sf):
    return _applied(spark, sf, "update")


def apply_replace(spark, sf):
    return _applied(spark, sf, "replace")


def delete_where(spark, sf):
    return rm.delete_where(t.orders_target(spark, sf), "o_totalprice < 50000")


def _verified(spark, sf):
    """Source and target after an insert repair: rows to be updated still differ."""
    target = t.orders_target(spark, sf)
    patch, wanted = patch_of(spark, sf, target)
    repaired = rm.materialize(rm.apply_repair(target, patch, KEY, "insert", primary_key=True), "repaired")
    checked = rm.verify_repair(t.orders(spark, sf), repaired, wanted, KEY, primary_key=True)
    return rm.materialize(checked.select(*KEY, "diff_type"), "checked"), wanted


def verify_repair(spark, sf):
    return rm.diff_summary(_verified(spark, sf)[0])


def verify_update(spark, sf):
    target = t.orders_target(spark, sf)
    patch, wanted = patch_of(spark, sf, target)
    repaired = rm.materialize(rm.apply_repair(target, patch, KEY, primary_key=True), "repaired")
    return rm.diff_summary(rm.verify_repair(t.orders(spark, sf), repaired, wanted, KEY, primary_key=True))


def batch_outcome(spark, sf):
    checked, wanted = _verified(spark, sf)
    return rm.batch_outcome(checked, rm.assign_batches(wanted, KEY, BATCH), KEY)


def repair_outcome(spark, sf):
    return rm.repair_outcome(batch_outcome(spark, sf))


def _in_files(spark, rows, parts):
    """The rows as a table of files ordered by key, to be changed file by file."""
    table = rm.VersionedTable(rm.new_path(spark, "files"), rows.schema)
    rows.repartitionByRange(parts, *KEY).sortWithinPartitions(*KEY).write.parquet(table.path)
    return table


def _touched(spark, sf, mode):
    target = t.orders_marked(spark, sf)
    table = _in_files(spark, target, 16)
    patch, _ = patch_of(spark, sf, target)
    rm.repair_files(spark, table, patch, KEY, mode, primary_key=True)
    return rm.scan_table(spark, table)


def repair_touched_files(spark, sf):
    return _touched(spark, sf, "update")


def repair_touched_insert(spark, sf):
    return _touched(spark, sf, "insert")


def repair_touched_replace(spark, sf):
    return _touched(spark, sf, "replace")


def lookup_by_ranges(spark, sf):
    wanted = rm.materialize(diff(spark, sf, windowed=True).where("diff_type = 'src_only'").select(*KEY), "keys")
    return rm.lookup_by_ranges(t.orders_target(spark, sf), wanted, KEY).select(*KEY, TIME)


QUERIES = {
    "mismatch_to_repair": mismatch_to_repair,
    "src_only_recheck": src_only_recheck,
    "repair_keys": repair_keys,
    "repair_keys_time_filtered": repair_keys_time_filtered,
    "lookup_target": lookup_target,
    "repair_gate": repair_gate,
    "repair_batches": repair_batches,
    "global_rank": global_rank,
    "repair_predicates": repair_predicates,
    "repair_predicates_composite": repair_predicates_composite,
    "repair_rows": repair_rows,
    "empty_selection": empty_selection,
    "repair_window_scope": repair_window_scope,
    "repair_full_scope": repair_full_scope,
    "apply_insert": apply_insert,
    "apply_update": apply_update,
    "apply_replace": apply_replace,
    "delete_where": delete_where,
    "verify_repair": verify_repair,
    "verify_update": verify_update,
    "batch_outcome": batch_outcome,
    "repair_outcome": repair_outcome,
    "repair_touched_files": repair_touched_files,
    "repair_touched_insert": repair_touched_insert,
    "repair_touched_replace": repair_touched_replace,
    "lookup_by_ranges": lookup_by_ranges,
}

ALLOWED = "(src_o_orderdate IS NULL OR tgt_o_orderdate IS NULL OR src_o_orderdate >= tgt_o_orderdate)"
MISMATCHED = f"SELECT o_orderkey FROM joined WHERE diff_type = 'mismatch' AND {ALLOWED}"
# Without a window, source-only keys are absent from the target, so all are written.
WITH_CHOSEN = f"""{t.WITH_ORDERS},
    chosen AS ({MISMATCHED} UNION SELECT o_orderkey FROM joined WHERE diff_type = 'src_only')"""
WITH_WINDOW_DIFF = f"""WITH whole_src AS (SELECT {', '.join(t.ORDERS_COLUMNS)} FROM orders),
    src AS (SELECT * FROM whole_src WHERE {WINDOW}),
    whole_tgt AS ({t.ORDERS_TARGET.format(orders='orders')}),
    tgt AS (SELECT * FROM whole_tgt WHERE {WINDOW}), {t.SQL_JOINED},
    rechecked AS (
      SELECT j.o_orderkey FROM joined j LEFT JOIN whole_tgt w ON j.o_orderkey = w.o_orderkey
      WHERE j.diff_type = 'src_only' AND (w.o_orderkey IS NULL OR j.src_o_orderdate IS NULL
            OR w.o_orderdate IS NULL OR j.src_o_orderdate >= w.o_orderdate))"""
BATCHES = f"""batches AS (
    SELECT o_orderkey, CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // {BATCH} + 1 AS BIGINT) AS batch FROM chosen)"""
MARKED = f"{WITH_CHOSEN}, {t.SQL_MARKED}, patch AS (SELECT * FROM src WHERE o_orderkey IN (SELECT o_orderkey FROM chosen))"
INSERTED = f"""repaired AS (
    SELECT * FROM tgt UNION ALL
    SELECT * FROM src WHERE o_orderkey IN (SELECT o_orderkey FROM chosen)
      AND o_orderkey NOT IN (SELECT o_orderkey FROM tgt))"""
CHECKED = """checked AS (
    SELECT c.o_orderkey,
           CASE WHEN r.o_orderkey IS NULL THEN 'src_only'
                WHEN s.o_custkey IS DISTINCT FROM r.o_custkey OR s.o_totalprice IS DISTINCT FROM r.o_totalprice
                  OR s.o_orderdate IS DISTINCT FROM r.o_orderdate THEN 'mismatch' ELSE 'match' END AS diff_type
    FROM chosen c JOIN src s ON c.o_orderkey = s.o_orderkey LEFT JOIN repaired r ON c.o_orderkey = r.o_orderkey)"""
OUTCOME = """outcome AS (
    SELECT batch, count(*) AS key_cnt, count(*) FILTER (WHERE diff_type = 'match') AS repaired_cnt,
           count(*) FILTER (WHERE diff_type = 'match') < count(*) AS failed
    FROM batches JOIN checked USING (o_orderkey) GROUP BY batch)"""
LINE_DIFF = """
    s AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) AS n FROM ({source})),
    t AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) AS n FROM ({target})),
    chosen AS (
      SELECT DISTINCT s.l_orderkey, s.l_linenumber
      FROM s LEFT JOIN t ON s.l_orderkey = t.l_orderkey AND s.l_linenumber = t.l_linenumber AND s.n = t.n
      WHERE t.l_orderkey IS NULL OR {differs})
"""
_LINE_VALUES = [c for c in t.LINEITEM_COLUMNS if c not in ("l_orderkey", "l_linenumber")]
LINE_CHOSEN = LINE_DIFF.format(
    order=", ".join(f"{v} ASC NULLS FIRST" for v in _LINE_VALUES),
    source=f"SELECT {', '.join(t.LINEITEM_COLUMNS)} FROM lineitem",
    target=t.LINEITEM_TARGET.format(lineitem="lineitem"),
    differs=" OR ".join(f"s.{v} IS DISTINCT FROM t.{v}" for v in _LINE_VALUES),
)

SQL = {
    "mismatch_to_repair": f"{t.WITH_ORDERS} {MISMATCHED}",
    "src_only_recheck": f"{WITH_WINDOW_DIFF} SELECT o_orderkey FROM rechecked",
    "repair_keys": f"{t.WITH_ORDERS} SELECT o_orderkey FROM joined WHERE diff_type IN ('mismatch', 'src_only')",
    "repair_keys_time_filtered": f"{WITH_WINDOW_DIFF} {MISMATCHED} UNION SELECT o_orderkey FROM rechecked",
    "lookup_target": f"""{WITH_WINDOW_DIFF} SELECT o_orderkey, o_orderdate FROM whole_tgt
        WHERE o_orderkey IN (SELECT o_orderkey FROM joined WHERE diff_type = 'src_only')""",
    "repair_gate": f"""{t.WITH_ORDERS},
        g AS (SELECT coalesce(src_o_custkey, tgt_o_custkey) AS custkey,
                     count(*) FILTER (WHERE diff_type <> 'match') AS diff_cnt FROM joined GROUP BY 1)
        SELECT custkey, diff_cnt,
               CASE WHEN diff_cnt = 0 THEN 'skip' WHEN diff_cnt > 2 THEN 'fail' ELSE 'run' END AS repair_status,
               CASE WHEN diff_cnt = 0 THEN 'no difference, nothing to repair'
                    WHEN diff_cnt > 2 THEN diff_cnt || ' different rows exceed the repair limit of 2'
                    ELSE '' END AS repair_msg FROM g""",
    "repair_batches": f"{WITH_CHOSEN}, {BATCHES} SELECT o_orderkey, batch FROM batches",
    "global_rank": """SELECT o_totalprice, o_orderkey,
        row_number() OVER (ORDER BY o_totalprice ASC NULLS FIRST, o_orderkey) AS position FROM orders""",
    "repair_predicates": f"""{WITH_CHOSEN}, {BATCHES}
        SELECT batch, count(*) AS key_cnt,
               'o_orderkey IN (' || string_agg(o_orderkey::VARCHAR, ', ' ORDER BY o_orderkey) || ')' AS predicate
        FROM batches GROUP BY batch""",
    "repair_predicates_composite": f"""WITH {LINE_CHOSEN},
        batches AS (SELECT *, CAST((row_number() OVER (ORDER BY l_orderkey, l_linenumber) - 1) // {BATCH} + 1 AS BIGINT)
                    AS batch FROM chosen)
        SELECT batch, count(*) AS key_cnt,
               string_agg('(l_orderkey = ' || l_orderkey || ' AND l_linenumber = ' || l_linenumber || ')', ' OR '
                          ORDER BY l_orderkey, l_linenumber) AS predicate
        FROM batches GROUP BY batch""",
    "repair_rows": f"""{WITH_CHOSEN} SELECT o_orderkey, o_totalprice, o_orderdate FROM src
        WHERE o_orderkey IN (SELECT o_orderkey FROM chosen)""",
    "empty_selection": f"""{t.WITH_ORDERS} SELECT 'none' AS tolerance, 0::BIGINT AS row_cnt
        UNION ALL SELECT 'some', count(*) FROM ({MISMATCHED} AND tgt_o_orderdate IS NOT NULL)""",
    "repair_window_scope": f"WITH {t.SQL_SRC} SELECT * FROM src WHERE {WINDOW}",
    "repair_full_scope": "SELECT o_orderkey, o_totalprice, o_orderdate FROM orders",
    "apply_insert": f"""{MARKED} SELECT * FROM marked UNION ALL
        SELECT *, NULL::DOUBLE AS t_mark FROM patch WHERE o_orderkey NOT IN (SELECT o_orderkey FROM marked)""",
    "apply_update": f"""{MARKED}
        SELECT coalesce(m.o_orderkey, p.o_orderkey) AS o_orderkey,
               CASE WHEN p.o_orderkey IS NOT NULL THEN p.o_custkey ELSE m.o_custkey END AS o_custkey,
               CASE WHEN p.o_orderkey IS NOT NULL THEN p.o_totalprice ELSE m.o_totalprice END AS o_totalprice,
               CASE WHEN p.o_orderkey IS NOT NULL THEN p.o_orderdate ELSE m.o_orderdate END AS o_orderdate, m.t_mark
        FROM marked m FULL JOIN patch p ON m.o_orderkey = p.o_orderkey""",
    "apply_replace": f"""{MARKED} SELECT * FROM marked WHERE o_orderkey NOT IN (SELECT o_orderkey FROM patch)
        UNION ALL SELECT *, NULL::DOUBLE AS t_mark FROM patch""",
    "delete_where": f"WITH {t.SQL_TGT} SELECT * FROM tgt WHERE o_totalprice IS NULL OR o_totalprice >= 50000",
    "verify_repair": f"""{WITH_CHOSEN}, {INSERTED}, {CHECKED}
        SELECT diff_type, count(*) AS row_cnt FROM checked GROUP BY diff_type""",
    "verify_update": f"{WITH_CHOSEN} SELECT 'match' AS diff_type, count(*) AS row_cnt FROM chosen",
    "batch_outcome": f"{WITH_CHOSEN}, {BATCHES}, {INSERTED}, {CHECKED}, {OUTCOME} SELECT * FROM outcome",
    "repair_outcome": f"""{WITH_CHOSEN}, {BATCHES}, {INSERTED}, {CHECKED}, {OUTCOME}
        SELECT *, CASE WHEN batch_count = 0 THEN 'skip' WHEN failed_batches = 0 THEN 'success'
                       WHEN failed_batches < batch_count THEN 'partial_fail' ELSE 'fail' END AS repair_status
        FROM (SELECT count(*) AS batch_count, CAST(coalesce(sum(repaired_cnt), 0) AS BIGINT) AS repair_cnt,
                     count(*) FILTER (WHERE failed) AS failed_batches FROM outcome)""",
}

SQL |= {
    "repair_touched_files": SQL["apply_update"],
    "repair_touched_insert": SQL["apply_insert"],
    "repair_touched_replace": SQL["apply_replace"],
    "lookup_by_ranges": SQL["lookup_target"],
}
