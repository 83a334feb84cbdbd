"""Repairs where keys repeat or are NULL, claims about keys, and exact literals and statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

import rowmend as rm
from catalog import tables as t
from catalog.repairing import LINE_CHOSEN

LINE_KEY = ["l_orderkey", "l_linenumber"]
BATCH = 100


def _lines(spark, sf):
    """Source, target, and the wanted keys and patch of lines, whose keys repeat."""
    src, tgt = t.lineitem(spark, sf), t.lineitem_target(spark, sf)
    rows = rm.materialize(rm.compare_rows(src, tgt, LINE_KEY).where("diff_type <> 'match'"), "diff")
    wanted = rm.materialize(rm.repair_keys(rows, tgt, LINE_KEY, time_filter=False), "keys")
    return src, tgt, wanted, rm.materialize(rm.repair_rows(src, tgt, wanted, LINE_KEY), "patch")


def _applied(spark, sf, mode):
    _, tgt, _, patch = _lines(spark, sf)
    return rm.apply_repair(tgt, patch, LINE_KEY, mode)


def apply_insert_repeated(spark, sf):
    return _applied(spark, sf, "insert")


def apply_update_repeated(spark, sf):
    return _applied(spark, sf, "update")


def apply_replace_repeated(spark, sf):
    return _applied(spark, sf, "replace")


def verify_repair_repeated(spark, sf):
    src, tgt, wanted, patch = _lines(spark, sf)
    repaired = rm.materialize(rm.apply_repair(tgt, patch, LINE_KEY), "repaired")
    return rm.diff_summary(rm.verify_repair(src, repaired, wanted, LINE_KEY))


# Each 103rd key is unknown on either side.
UNKNOWN_KEYS = """
SELECT CASE WHEN o_orderkey % 103 = 0 THEN NULL ELSE o_orderkey END AS o_orderkey, o_custkey, o_totalprice, o_orderdate
FROM {orders}
"""


def repair_null_keys(spark, sf):
    """What differs after an update: rows of NULL keys are found, written and counted like others."""
    src = spark.sql(UNKNOWN_KEYS, orders=t.orders(spark, sf))
    tgt = spark.sql(UNKNOWN_KEYS, orders=t.orders_target(spark, sf))
    keys = ["o_orderkey"]
    rows = rm.materialize(rm.compare_rows(src, tgt, keys).where("diff_type <> 'match'"), "diff")
    wanted = rm.materialize(rm.repair_keys(rows, tgt, keys, "o_orderdate", time_filter=False), "keys")
    patch = rm.materialize(rm.repair_rows(src, tgt, wanted, keys), "patch")
    repaired = rm.materialize(rm.apply_repair(tgt, patch, keys), "repaired")
    return rm.diff_summary(rm.compare_rows(src, repaired, keys))


def primary_key_claim_audit(spark, sf):
    """Lines are not identified by order and line number, orders are by their key."""
    lines = rm.primary_key_audit(t.lineitem(spark, sf), t.lineitem_target(spark, sf), LINE_KEY)
    orders = rm.primary_key_audit(t.orders(spark, sf), t.orders_target(spark, sf), ["o_orderkey"])
    return lines.withColumn("tables", F.lit("lines")).unionByName(orders.withColumn("tables", F.lit("orders")))


def lookup_by_predicates(spark, sf):
    """Orders of the customers in debt, fetched by conditions on their keys."""
    wanted = t.customer(spark, sf).where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    batches = rm.assign_batches(wanted, ["o_custkey"], BATCH)
    return rm.lookup_by_predicates(spark, t.file_table(spark, sf, "orders"), batches, ["o_custkey"], t.ORDERS_COLUMNS)


# Text keys with quotes and backslashes, and a name that needs quotes itself.
NAMED = r"SELECT concat(c_name, '''', '\\', c_mktsegment) AS `the name` FROM {customer}"


def repair_predicates_text(spark, sf):
    keys = spark.sql(NAMED, customer=t.customer(spark, sf))
    batches = rm.assign_batches(keys, ["the name"], BATCH)
    spark_text = rm.repair_predicates(batches, ["the name"])
    return spark_text.join(
        rm.repair_predicates(batches, ["the name"], "oracle").select("batch", F.col("predicate").alias("oracle")), "batch"
    )


def repair_predicates_time(spark, sf):
    """Times keep their microseconds, where they have any."""
    keys = t.events(spark, sf).select(F.expr("ts + make_dt_interval(0, 0, 0, (event_id % 3) * 0.000250)").alias("ts")).distinct()
    return rm.repair_predicates(rm.assign_batches(keys, ["ts"], BATCH), ["ts"])


WIDE = """
SELECT o_orderkey, CAST(9007199254740992 AS BIGINT) + o_orderkey + {add} AS big,
       CAST(o_totalprice AS DECIMAL(15, 2)) * CAST(100000000000 AS DECIMAL(12, 0)) + {add} AS exact, o_custkey + {add} AS present
FROM {orders}
"""


def column_stats_exact(spark, sf):
    """Differences of one in numbers that a double cannot tell apart; one column has a name used inside."""
    orders = t.orders(spark, sf)
    src = spark.sql(WIDE.replace("{add}", "0"), orders=orders)
    tgt = spark.sql(WIDE.replace("{add}", "CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END"), orders=orders)
    return rm.column_stats(rm.compare_rows(src, tgt, ["o_orderkey"], primary_key=True))


QUERIES = {
    "apply_insert_repeated": apply_insert_repeated,
    "apply_update_repeated": apply_update_repeated,
    "apply_replace_repeated": apply_replace_repeated,
    "verify_repair_repeated": verify_repair_repeated,
    "repair_null_keys": repair_null_keys,
    "primary_key_claim_audit": primary_key_claim_audit,
    "lookup_by_predicates": lookup_by_predicates,
    "repair_predicates_text": repair_predicates_text,
    "repair_predicates_time": repair_predicates_time,
    "column_stats_exact": column_stats_exact,
}

COLUMNS = ", ".join(t.LINEITEM_COLUMNS)
ORDER = ", ".join(f"{c} ASC NULLS FIRST" for c in t.LINEITEM_COLUMNS)
WITH_LINES = f"""WITH {LINE_CHOSEN},
    lines AS (SELECT {COLUMNS} FROM lineitem),
    target AS ({t.LINEITEM_TARGET.format(lineitem='lineitem')}),
    patch AS (SELECT l.* FROM lines l SEMI JOIN chosen USING (l_orderkey, l_linenumber)),
    touched AS (SELECT l.* FROM target l SEMI JOIN chosen USING (l_orderkey, l_linenumber)),
    rest AS (SELECT l.* FROM target l ANTI JOIN chosen USING (l_orderkey, l_linenumber))"""
# No wanted key has more rows in the target than in the source, so an update leaves the source's rows.
REPLACED = f"{WITH_LINES} SELECT * FROM rest UNION ALL SELECT {COLUMNS} FROM patch"

SQL = {
    "apply_insert_repeated": f"""{WITH_LINES},
        fresh AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {ORDER}) AS nr
                  FROM (SELECT * FROM patch EXCEPT ALL SELECT * FROM touched)),
        open AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM (SELECT * FROM touched EXCEPT ALL SELECT * FROM patch) GROUP BY 1, 2)
        SELECT * FROM target UNION ALL
        SELECT {COLUMNS} FROM fresh LEFT JOIN open USING (l_orderkey, l_linenumber) WHERE nr > coalesce(n, 0)""",
    "apply_update_repeated": REPLACED,
    "apply_replace_repeated": REPLACED,
    "verify_repair_repeated": f"{WITH_LINES} SELECT 'match' AS diff_type, count(*) AS row_cnt FROM patch",
    "repair_null_keys": """SELECT 'match' AS diff_type, count(*) AS row_cnt FROM orders
        UNION ALL SELECT 'tgt_only', count(*) FROM orders WHERE o_orderkey % 101 = 0 AND (o_orderkey + 1) % 103 <> 0""",
    "primary_key_claim_audit": f"""WITH rows AS (
          SELECT 'lines' AS tables, 'src' AS side, l_orderkey AS a, l_linenumber AS b FROM lineitem
          UNION ALL SELECT 'lines', 'tgt', l_orderkey, l_linenumber FROM ({t.LINEITEM_TARGET.format(lineitem='lineitem')})
          UNION ALL SELECT 'orders', 'src', o_orderkey, 0 FROM orders
          UNION ALL SELECT 'orders', 'tgt', o_orderkey, 0 FROM ({t.ORDERS_TARGET.format(orders='orders')})),
        counted AS (SELECT tables, side, a, b, count(*) AS n FROM rows GROUP BY ALL)
        SELECT tables, side, sum(n)::BIGINT AS row_cnt, sum(CASE WHEN n > 1 THEN n ELSE 0 END)::BIGINT AS repeated_cnt,
               sum(CASE WHEN a IS NULL OR b IS NULL THEN n ELSE 0 END)::BIGINT AS null_cnt,
               max(n) = 1 AND NOT bool_or(a IS NULL OR b IS NULL) AS is_key
        FROM counted GROUP BY tables, side""",
    "lookup_by_predicates": f"""SELECT {', '.join(t.ORDERS_COLUMNS)} FROM orders
        WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
    "repair_predicates_text": rf"""WITH k AS (SELECT DISTINCT c_name || '''' || '\' || c_mktsegment AS name FROM customer),
        b AS (SELECT name, CAST((row_number() OVER (ORDER BY name) - 1) // {BATCH} + 1 AS BIGINT) AS batch FROM k)
        SELECT batch, count(*) AS key_cnt,
               '`the name` IN (' || string_agg('''' || replace(replace(name, '\', '\\'), '''', '''''') || '''', ', ' ORDER BY name) || ')'
                 AS predicate,
               '"THE NAME" IN (' || string_agg('''' || replace(name, '''', '''''') || '''', ', ' ORDER BY name) || ')' AS oracle
        FROM b GROUP BY batch""",
    "repair_predicates_time": f"""WITH k AS (SELECT DISTINCT ts + to_microseconds((event_id % 3) * 250) AS ts FROM events),
        b AS (SELECT ts, CAST((row_number() OVER (ORDER BY ts) - 1) // {BATCH} + 1 AS BIGINT) AS batch FROM k)
        SELECT batch, count(*) AS key_cnt, 'ts IN (' || string_agg('''' || ts::VARCHAR || '''', ', ' ORDER BY ts) || ')' AS predicate
        FROM b GROUP BY batch""",
    "column_stats_exact": """WITH n AS (SELECT count(*) FILTER (o_orderkey % 5 = 0) AS n FROM orders)
        SELECT unnest(['big', 'exact', 'present']) AS column_name, n AS unequal_cnt, 0::BIGINT AS null_diff_cnt, 1.0::DOUBLE AS max_abs_diff
        FROM n""",
}
