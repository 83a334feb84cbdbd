"""Task tables, many comparisons in one go, the result log and alerts."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

import rowmend as rm
from catalog import tables as t
from catalog.comparing import compared_orders
from rowmend.plans.tasks import REQUIRED_FIELDS
from rowmend.sources.sinks import RESULT_LOG
from rowmend.sources.storage import new_path

LIMIT = 0.05
def active_tasks(spark, sf):
    return rm.active_tasks(t.tasks(spark, sf)).select("id", "src_db_type", "src_host", "is_delete")


def validate_tasks(spark, sf):
    checked = rm.validate_tasks(t.tasks(spark, sf))
    return checked.select("id", F.array_join("missing_fields", ",").alias("missing_fields"), "is_valid")


def _tasks(sf):
    def pair(name, source, target, keys, **more):
        return rm.CompareTask(
            table_id=name,
            source=partial(source, sf_dir=sf),
            target=partial(target, sf_dir=sf),
            keys=keys,
            src_db_name="live",
            src_table_name=name,
            tgt_db_name="copy",
            tgt_table_name=name,
            **more,
        )

    return [
        pair("orders", t.orders, t.orders_target, ["o_orderkey"], update_column="o_orderdate"),
        pair("lineitem", t.lineitem, t.lineitem_target, ["l_orderkey", "l_linenumber"]),
        pair("events", t.events, t.events_target, ["event_id"], abs_tol=0.01, rel_tol=1e-6),
        pair("customer", t.customer, t.customer_target, ["c_custkey"], sensitive="c_acctbal"),
        pair("broken", t.customer, t.customer_target, ["c_missing"]),
    ]


def compare_many(spark, sf):
    return rm.compare_many(spark, _tasks(sf)).drop("compare_msg")


def task_result(spark, sf):
    task = _tasks(sf)[0]
    src, tgt = task.source(spark), task.target(spark)
    summary = rm.repair_gate(rm.compare_summary(task.compare(src, tgt)), True, 3000)
    result = rm.as_result_log(rm.task_result(task, summary, task.roles(src)))
    return result.select(
        "table_id", "compare_status", "src_table_name", "check_column", "src_cnt", "tgt_cnt", "diff_cnt",
        "compare_report", "repair_status", "repair_msg", "is_delete",
    )


def _results(spark, sf):
    """One comparison result per customer, as if each customer's orders were a table."""
    who = F.coalesce(F.col("src.o_custkey"), F.col("tgt.o_custkey")).cast("string")
    summary = rm.compare_summary(compared_orders(spark, sf), {"table_id": who})
    return rm.repair_gate(summary, True, 2).withColumns(
        {
            "src_db_name": F.lit("live"),
            "src_table_name": F.lit("orders"),
            "tgt_db_name": F.lit("copy"),
            "tgt_table_name": F.lit("orders"),
            "compare_status": F.lit("success"),
            "compare_msg": F.lit("compared"),
            "repair_cnt": F.lit(0).cast("bigint"),
        }
    )


def result_log(spark, sf):
    spec = rm.FileTable(new_path(spark, "log"))
    # Times and names as given, so that all fields of the log have a known value.
    moment = F.lit("2026-03-01 12:00:00.25").cast("timestamp_ntz")
    given = {f.name: moment for f in RESULT_LOG.fields if f.name.endswith("_time")}
    given |= {f.name: F.lit(0.5) for f in RESULT_LOG.fields if f.name.endswith("_minute")}
    given |= {n: F.lit(n) for n in ("src_db_id", "check_range", "check_column", "compare_report", "html_report", "repair_job_file")}
    rm.append_result_log(_results(spark, sf).withColumns(given | {"is_delete": F.lit(0)}), spec)
    return rm.scan_table(spark, spec)


def alerts_compare(spark, sf):
    return rm.needs_alert_compare(_results(spark, sf), LIMIT).select("table_id", "matching_rate", "alert")


def alerts_repair(spark, sf):
    return rm.needs_alert_repair(_results(spark, sf)).select("table_id", "repair_status", "alert")


QUERIES = {
    "active_tasks": active_tasks,
    "validate_tasks": validate_tasks,
    "compare_many": compare_many,
    "task_result": task_result,
    "result_log": result_log,
    "alerts_compare": alerts_compare,
    "alerts_repair": alerts_repair,
}

TASKS = t.TASKS.format(customer="customer")
WITH_RESULTS = f"""{t.WITH_ORDERS},
    keyed AS (SELECT *, CAST(coalesce(src_o_custkey, tgt_o_custkey) AS VARCHAR) AS table_id FROM joined),
    results AS ({t.summary_sql('keyed', 'table_id')})"""
GATE = "CASE WHEN diff_cnt = 0 THEN 'skip' WHEN diff_cnt > 2 THEN 'fail' ELSE 'run' END"


GATE_MESSAGE = """CASE WHEN diff_cnt = 0 THEN 'no difference, nothing to repair'
    WHEN diff_cnt > 2 THEN diff_cnt || ' different rows exceed the repair limit of 2' ELSE '' END"""
LOGGED_TIMES = ", ".join(f"TIMESTAMP '2026-03-01 12:00:00.25' AS {f.name}" for f in RESULT_LOG.fields if f.name.endswith("_time"))
LOGGED_MINUTES = ", ".join(f"0.5::DOUBLE AS {f.name}" for f in RESULT_LOG.fields if f.name.endswith("_minute"))


def _kinds(source: str, target: str, keys: list[str], differs: str) -> str:
    on = " AND ".join(f"s.{k} = t.{k}" for k in keys)
    return f"""SELECT CASE WHEN t.{keys[0]} IS NULL THEN 'src_only' WHEN s.{keys[0]} IS NULL THEN 'tgt_only'
        WHEN {differs} THEN 'mismatch' ELSE 'match' END AS diff_type
        FROM ({source}) s FULL JOIN ({target}) t ON {on}"""


# Compared in the order of the table's columns.
LINE_VALUES = [c for c in t.LINEITEM_COLUMNS if c not in ("l_orderkey", "l_linenumber")]


def _numbered(source: str) -> str:
    return f"""SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY {', '.join(f'{c} ASC NULLS FIRST' for c in LINE_VALUES)}) AS n FROM ({source})"""


def _differs(columns: list[str]) -> str:
    return " OR ".join(f"s.{c} IS DISTINCT FROM t.{c}" for c in columns)


MANY = {
    "orders": _kinds(
        f"SELECT {', '.join(t.ORDERS_COLUMNS)} FROM orders",
        t.ORDERS_TARGET.format(orders="orders"),
        ["o_orderkey"],
        _differs(["o_custkey", "o_totalprice", "o_orderdate"]),
    ),
    "lineitem": _kinds(
        _numbered(f"SELECT {', '.join(t.LINEITEM_COLUMNS)} FROM lineitem"),
        _numbered(t.LINEITEM_TARGET.format(lineitem="lineitem")),
        ["l_orderkey", "l_linenumber", "n"],
        _differs(LINE_VALUES),
    ),
    "events": _kinds(
        "SELECT event_id, user_id, ts, value FROM events",
        t.EVENTS_TARGET.format(events="events"),
        ["event_id"],
        _differs(["user_id", "ts"])
        + """ OR (s.value IS DISTINCT FROM t.value
              AND NOT coalesce(abs(s.value - t.value) <= 0.01::DOUBLE + 1e-6::DOUBLE * abs(t.value), FALSE))""",
    ),
    "customer": _kinds(
        "SELECT * FROM customer", t.CUSTOMER_TARGET.format(customer="customer"), ["c_custkey"], _differs(["c_nationkey"])
    ),
}
MISSING = ", ".join(f"CASE WHEN {n} IS NULL THEN '{n}' END" for n in REQUIRED_FIELDS)

SQL = {
    "active_tasks": f"SELECT id, src_db_type, src_host, is_delete FROM ({TASKS}) WHERE is_delete = 0",
    "validate_tasks": f"""SELECT id, concat_ws(',', {MISSING}) AS missing_fields, concat_ws(',', {MISSING}) = '' AS is_valid
        FROM ({TASKS})""",
    "compare_many": " UNION ALL ".join(
        f"SELECT '{name}' AS table_id, 'success' AS compare_status, * FROM ({t.summary_sql(f'({kinds})')})"
        for name, kinds in MANY.items()
    )
    + " UNION ALL SELECT 'broken', 'fail', 0, 0, 0, 0, 0, 0, 0, 0.0",
    "task_result": f"""{t.WITH_ORDERS}, result AS ({t.summary_sql()})
        SELECT 'orders' AS table_id, 'success' AS compare_status, 'orders' AS src_table_name,
               'key_columns: [''o_orderkey''], update_column: [''o_orderdate''], '
               || 'extra_columns: [''o_custkey'', ''o_totalprice'']' AS check_column,
               src_cnt, tgt_cnt, diff_cnt,
               'compared: source ' || src_cnt || ' rows, target ' || tgt_cnt || ' rows, different ' || diff_cnt
                 AS compare_report,
               CASE WHEN diff_cnt = 0 THEN 'skip' WHEN diff_cnt > 3000 THEN 'fail' ELSE 'run' END AS repair_status,
               CASE WHEN diff_cnt = 0 THEN 'no difference, nothing to repair'
                    WHEN diff_cnt > 3000 THEN diff_cnt || ' different rows exceed the repair limit of 3000'
                    ELSE '' END AS repair_msg,
               0::INTEGER AS is_delete
        FROM result""",
    "result_log": f"""{WITH_RESULTS}
        SELECT table_id, {LOGGED_TIMES}, {LOGGED_MINUTES}, 'success' AS compare_status, 'compared' AS compare_msg, 'src_db_id' AS src_db_id,
               'live' AS src_db_name, 'orders' AS src_table_name, 'copy' AS tgt_db_name, 'orders' AS tgt_table_name,
               'check_range' AS check_range, 'check_column' AS check_column, src_cnt, tgt_cnt, diff_cnt,
               'compare_report' AS compare_report, 'html_report' AS html_report, {GATE} AS repair_status,
               0::BIGINT AS repair_cnt, 'repair_job_file' AS repair_job_file, 0::INTEGER AS is_delete, {GATE_MESSAGE} AS repair_msg
        FROM results""",
    "alerts_compare": f"""{WITH_RESULTS}
        SELECT table_id, matching_rate,
               'table ' || table_id || ': live.orders against copy.orders, status success, different rows ' || diff_cnt
               || ', matching rate ' || format('{{:.2f}}', round(matching_rate * 100, 2)) || '%, compared' AS alert
        FROM results WHERE matching_rate < {1.0 - LIMIT}::DOUBLE""",
    "alerts_repair": f"""{WITH_RESULTS}
        SELECT table_id, 'fail' AS repair_status,
               'table ' || table_id || ': live.orders into copy.orders, repair fail, repaired rows 0, ' || diff_cnt
               || ' different rows exceed the repair limit of 2' AS alert
        FROM results WHERE diff_cnt > 2""",
}
