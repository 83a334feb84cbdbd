"""Source tables, and the drifted targets they are compared with.

A target is its whole source table with differences worked in: some rows missing,
some added, some values changed, some times moved. The remainders below only choose
where the differences go; every query compares all rows of both sides. The text is
valid in Spark and in the SQL used for checking, so both see the same target.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from rowmend import FileTable, scan_table

ORDERS_COLUMNS = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"]
# All columns that are compared by default: numbers and times.
LINEITEM_COLUMNS = [
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_shipdate",
]

ORDERS_TARGET = """
SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderkey % 59 = 0 THEN NULL
            WHEN o_orderkey % 53 = 0 THEN o_totalprice + 1
            ELSE o_totalprice END AS o_totalprice,
       CASE WHEN o_orderkey % 61 = 0 THEN o_orderdate - INTERVAL '45' DAY
            WHEN o_orderkey % 67 = 0 THEN o_orderdate + INTERVAL '45' DAY
            WHEN o_orderkey % 71 = 0 THEN NULL
            ELSE o_orderdate END AS o_orderdate
FROM {orders} WHERE o_orderkey % 97 <> 0
UNION ALL
SELECT -(o_orderkey + 1) AS o_orderkey, o_custkey, o_totalprice, o_orderdate
FROM {orders} WHERE o_orderkey % 101 = 0
"""

LINEITEM_TARGET = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN l_orderkey % 53 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity,
       CASE WHEN l_orderkey % 59 = 0 THEN NULL ELSE l_extendedprice END AS l_extendedprice,
       l_discount, CASE WHEN l_orderkey % 61 = 0 THEN CAST(0.5 AS DOUBLE) ELSE l_tax END AS l_tax, l_shipdate
FROM {lineitem} WHERE l_partkey % 97 <> 0
UNION ALL
SELECT -(l_orderkey + 1) AS l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate
FROM {lineitem} WHERE l_partkey % 101 = 0
"""

EVENTS_TARGET = """
SELECT event_id, user_id, ts,
       CASE WHEN event_id % 7 = 0 THEN value * 1.0000001
            WHEN event_id % 11 = 0 THEN value + 0.001
            WHEN event_id % 13 = 0 THEN value + 5
            WHEN event_id % 17 = 0 THEN NULL
            ELSE value END AS value
FROM {events} WHERE event_id % 97 <> 0
"""

CUSTOMER_TARGET = """
SELECT c_custkey, c_name,
       CASE WHEN c_custkey % 23 = 0 THEN c_nationkey + 1 ELSE c_nationkey END AS c_nationkey,
       CASE WHEN c_custkey % 29 = 0 THEN -c_acctbal ELSE c_acctbal END AS c_acctbal,
       CASE WHEN c_custkey % 31 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END AS c_mktsegment
FROM {customer} WHERE c_custkey % 97 <> 0
"""

# A target whose schema has drifted too: other types, one column missing, one more.
ORDERS_RETYPED = """
SELECT o_orderkey, CAST(o_custkey AS STRING) AS o_custkey,
       CAST(o_totalprice AS DECIMAL(15, 2)) AS o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate
FROM {target}
"""
ORDERS_DRIFTED = """
SELECT o_orderkey, CAST(o_totalprice AS STRING) AS o_totalprice, o_orderdate, o_custkey * 2 AS t_mark
FROM {target}
"""
# The target with a column that only it has.
ORDERS_MARKED = "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_totalprice / 2 AS t_mark FROM {target}"

# A task table with a row per customer.
TASKS = """
SELECT c_custkey AS id,
       CASE WHEN c_nationkey % 4 = 0 THEN 'mysql' WHEN c_nationkey % 4 = 1 THEN 'oracle'
            WHEN c_nationkey % 4 = 2 THEN 'postgresql' ELSE 'sqlserver' END AS src_db_type,
       concat('host', CAST(c_nationkey AS STRING)) AS src_host, 3306 AS src_port,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE 'reader' END AS src_username, c_name AS src_password,
       c_mktsegment AS src_db_name, 'orders' AS src_table_name,
       'mysql' AS tgt_db_type, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE 'copy' END AS tgt_host, 3306 AS tgt_port,
       'writer' AS tgt_username, c_name AS tgt_password, c_mktsegment AS tgt_db_name, 'orders_copy' AS tgt_table_name,
       CASE WHEN c_mktsegment = 'MACHINERY' THEN 1 ELSE 0 END AS is_delete
FROM {customer}
"""


@cache
def schema(spark: SparkSession, path: str) -> StructType:
    """Read from the files once, not for each of the many queries."""
    return scan_table(spark, FileTable(path)).schema


def file_table(spark: SparkSession, sf_dir: str, name: str) -> FileTable:
    path = f"{sf_dir}/{name}.parquet"
    return FileTable(path, schema=schema(spark, path))


def table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    return scan_table(spark, file_table(spark, sf_dir, name), columns)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders", ORDERS_COLUMNS)


def orders_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(ORDERS_TARGET, orders=table(spark, sf_dir, "orders"))


def orders_marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(ORDERS_MARKED, target=orders_target(spark, sf_dir))


def orders_retyped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(ORDERS_RETYPED, target=orders_target(spark, sf_dir))


def orders_drifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(ORDERS_DRIFTED, target=orders_target(spark, sf_dir))


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem", LINEITEM_COLUMNS)


def lineitem_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(LINEITEM_TARGET, lineitem=table(spark, sf_dir, "lineitem"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events", ["event_id", "user_id", "ts", "value"])


def events_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(EVENTS_TARGET, events=table(spark, sf_dir, "events"))


def customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer")


def customer_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CUSTOMER_TARGET, customer=table(spark, sf_dir, "customer"))


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(TASKS, customer=table(spark, sf_dir, "customer"))


# The same tables as common table expressions for the checking SQL.
SQL_SRC = f"src AS (SELECT {', '.join(ORDERS_COLUMNS)} FROM orders)"
SQL_TGT = f"tgt AS ({ORDERS_TARGET.format(orders='orders')})"
SQL_MARKED = f"marked AS ({ORDERS_MARKED.format(target='tgt')})"
SQL_JOINED = """
joined AS (
  SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey,
         CASE WHEN t.o_orderkey IS NULL THEN 'src_only' WHEN s.o_orderkey IS NULL THEN 'tgt_only'
              WHEN s.o_custkey IS DISTINCT FROM t.o_custkey OR s.o_totalprice IS DISTINCT FROM t.o_totalprice
                OR s.o_orderdate IS DISTINCT FROM t.o_orderdate THEN 'mismatch'
              ELSE 'match' END AS diff_type,
         s.o_custkey AS src_o_custkey, t.o_custkey AS tgt_o_custkey,
         s.o_totalprice AS src_o_totalprice, t.o_totalprice AS tgt_o_totalprice,
         s.o_orderdate AS src_o_orderdate, t.o_orderdate AS tgt_o_orderdate
  FROM src s FULL JOIN tgt t ON s.o_orderkey = t.o_orderkey)
"""
WITH_ORDERS = f"WITH {SQL_SRC}, {SQL_TGT}, {SQL_JOINED}"

COUNTS_SQL = """
count(*) FILTER (WHERE diff_type <> 'tgt_only') AS src_cnt,
count(*) FILTER (WHERE diff_type <> 'src_only') AS tgt_cnt,
count(*) FILTER (WHERE diff_type = 'match') AS match_cnt,
count(*) FILTER (WHERE diff_type = 'mismatch') AS mismatch_cnt,
count(*) FILTER (WHERE diff_type = 'src_only') AS src_only_cnt,
count(*) FILTER (WHERE diff_type = 'tgt_only') AS tgt_only_cnt,
count(*) FILTER (WHERE diff_type <> 'match') AS diff_cnt
"""
RATE_SQL = """
CASE WHEN greatest(src_cnt, tgt_cnt) = 0 THEN 1.0::DOUBLE
     ELSE match_cnt::DOUBLE / greatest(src_cnt, tgt_cnt)::DOUBLE END AS matching_rate
"""


def summary_sql(joined: str = "joined", group: str = "") -> str:
    by = f"GROUP BY {group}" if group else ""
    head = f"{group}, " if group else ""
    return f"SELECT *, {RATE_SQL} FROM (SELECT {head}{COUNTS_SQL} FROM {joined} {by})"
