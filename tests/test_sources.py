"""Scans, slices, reader options, storage."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import rowmend as rm
from conftest import rows
from rowmend.sources import dialects, jdbc, storage
from rowmend.sources.sinks import RESULT_LOG
from rowmend.sources.tables import slice_predicates


def spec(dialect, **more):
    return rm.JdbcTable(dialect, "db1", 1234, "shop", "orders", "reader", "pw", **more)


@pytest.mark.parametrize(
    "dialect, url, driver",
    [
        ("mysql", "jdbc:mysql://db1:1234/shop?useUnicode=true&characterEncoding=utf8", "com.mysql.cj.jdbc.Driver"),
        ("oracle", "jdbc:oracle:thin:@db1:1234:shop", "oracle.jdbc.driver.OracleDriver"),
        ("sqlserver", "jdbc:sqlserver://db1:1234;DatabaseName=shop", "com.microsoft.sqlserver.jdbc.SQLServerDriver"),
        ("postgresql", "jdbc:postgresql://db1:1234/shop", "org.postgresql.Driver"),
    ],
)
def test_connection_options(dialect, url, driver):
    options = jdbc.connection_options(spec(dialect))
    assert (options["url"], options["driver"], options["user"]) == (url, driver, "reader")
    assert "pw" not in repr(spec(dialect))


def test_unknown_database():
    with pytest.raises(ValueError, match="unsupported"):
        spec("dbase")


def test_sliced_options():
    options = jdbc.table_options(spec("mysql"), "id", 1, 1000, 8)
    assert options["dbtable"] == "`shop`.`orders`"
    assert (options["partitionColumn"], options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("id", "1", "1000", "8")
    with pytest.raises(ValueError, match="slices"):
        jdbc.table_options(spec("mysql"), "id")


def test_bounds_are_whole_numbers():
    options = jdbc.table_options(spec("oracle"), "ID", Decimal("1.5000000000"), Decimal("9.5000000000"), 2)
    assert (options["dbtable"], options["lowerBound"], options["upperBound"]) == ('"SHOP"."ORDERS"', "1", "10")


def test_limits():
    words = {d: jdbc.limited_query(spec(d), ["id", "v"], 5, "v > 1") for d in dialects.URLS}
    assert words["mysql"] == "SELECT `id`, `v` FROM `shop`.`orders` WHERE (v > 1) LIMIT 5"
    assert words["postgresql"] == 'SELECT "id", "v" FROM "shop"."orders" WHERE (v > 1) LIMIT 5'
    assert words["sqlserver"] == "SELECT TOP 5 [id], [v] FROM [shop].[dbo].[orders] WHERE (v > 1)"
    assert words["oracle"] == 'SELECT "ID", "V" FROM "SHOP"."ORDERS" WHERE (v > 1) AND ROWNUM <= 5'


def test_scan_by_key_asks_for_bounds(spark, monkeypatch):
    from rowmend.sources import tables

    asked = {}
    monkeypatch.setattr(tables, "_open", lambda spark, spec: spark.createDataFrame([], "id bigint, k string"))
    monkeypatch.setattr(tables, "scan_partitioned", lambda *a: asked.setdefault("slices", a[2:]))
    for bounds in ((None, None), (3, 90)):
        frame = spark.createDataFrame([bounds], "low bigint, high bigint")
        monkeypatch.setattr(tables, "load_query", lambda s, spec, q, f=frame: asked.update(query=q) or f)
        tables.scan_by_key(spark, spec("mysql"), "id", 8)
    assert asked == {"query": "SELECT MIN(`id`) AS low, MAX(`id`) AS high FROM `shop`.`orders`", "slices": ("id", 3, 90, 8)}
    frame = spark.createDataFrame([(2, "m"), (1, "a"), (3, "m"), (4, "t'")], "part int, cut string")
    monkeypatch.setattr(tables, "load_query", lambda s, spec, q: asked.update(query=q) or frame)
    monkeypatch.setattr(tables, "scan_slices", lambda s, spec, predicates: predicates)
    conditions = tables.scan_by_key(spark, spec("mysql"), "k", 4)
    assert "NTILE(4) OVER (ORDER BY `k`)" in asked["query"]
    assert conditions == ["`k` < 'm' OR `k` IS NULL", "`k` >= 'm' AND `k` < 't'''", "`k` >= 't'''"]


def test_upserts():
    staging = {d: rm.JdbcTable(d, "h", 1, "shop", "staged", "u", "p") for d in dialects.URLS}
    text = {d: rm.upsert_query(spec(d), staging[d], ["id"], ["id", "v"], "r'1") for d in dialects.URLS}
    assert all("'r''1'" in t for t in text.values())
    assert text["mysql"].endswith("ON DUPLICATE KEY UPDATE `v` = VALUES(`v`)")
    assert text["postgresql"].endswith('ON CONFLICT ("id") DO UPDATE SET "v" = EXCLUDED."v"')
    assert text["oracle"].startswith('MERGE INTO "SHOP"."ORDERS" t USING (SELECT "ID", "V" FROM "SHOP"."STAGED" WHERE "RUN_ID" =')
    assert text["sqlserver"].endswith("WHEN NOT MATCHED THEN INSERT ([id], [v]) VALUES (s.[id], s.[v]);")
    kept = {d: rm.upsert_query(spec(d), staging[d], ["id"], ["id", "v"], "r", "insert") for d in dialects.URLS}
    assert kept["mysql"].endswith("UPDATE `id` = `id`") and kept["postgresql"].endswith("DO NOTHING")
    assert "MATCHED THEN UPDATE" not in kept["oracle"] + kept["sqlserver"]


def test_merge_replaces_whole_rows(spark, monkeypatch):
    """A replaced row keeps nothing that only the target has; an updated one does."""
    from rowmend.sources.sinks import merge_into

    spark.createDataFrame([(1, 2, 3)], "id int, v int, mark int").createOrReplaceTempView("merged_view")
    seen = {}

    class Writer:
        def __getattr__(self, name):
            return lambda values=None: seen.update({name: sorted(values)} if values else {}) or self

    monkeypatch.setattr(type(spark.range(1)), "mergeInto", lambda self, table, condition: Writer())
    patch = spark.createDataFrame([(1, 5)], "id int, v int")
    for mode, columns in {"update": ["id", "v"], "replace": ["id", "mark", "v"]}.items():
        merge_into(patch, "merged_view", ["id"], mode)
        assert seen == {"update": columns, "insert": ["id", "mark", "v"]}


def test_catalog_queries_name_the_table():
    for dialect in dialects.URLS:
        for text in (jdbc.metadata_query(spec(dialect)), jdbc.primary_key_query(spec(dialect))):
            assert "'orders'" in text and "'shop'" in text
    assert "'o''rders'" in jdbc.metadata_query(rm.JdbcTable("mysql", "h", 1, "d", "o'rders", "u", "p"))


def test_slices_cover_each_row_once(spark):
    df = spark.createDataFrame([(i,) for i in [None, -5, *range(0, 100), 1000]], "k int")
    for slices in (1, 3, 7, 200):
        conditions = slice_predicates("k", 0, 99, slices)
        hits = df.select("k", sum(F.when(F.expr(c), 1).otherwise(0) for c in conditions).alias("n"))
        assert hits.where("n <> 1").count() == 0
        assert rm.slice_counts(df, "k", 0, 99, slices).agg(F.sum("row_cnt")).first()[0] == 103


def test_files_and_catalog_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    target = rm.FileTable(str(tmp_path / "t"))
    rm.write_table(df, target)
    assert rows(rm.scan_table(spark, target, ["v"], "id > 1")) == [("b",)]
    assert rm.scan_table(spark, target, limit=1).count() == 1
    assert rows(rm.scan_slices(spark, target, ["v < 'b'", "v >= 'b'"], ["v"])) == [("a",), ("b",)]
    df.createOrReplaceTempView("some_view")
    assert rows(rm.scan_table(spark, rm.CatalogTable("some_view"), ["id", "id"])) == [(1,), (2,)]
    with pytest.raises(Exception, match="(?i)exists"):
        rm.write_table(df, target)
    text = rm.FileTable(str(tmp_path / "c"), "csv", {"header": "true"})
    rm.write_table(df, text)
    assert rm.scan_table(spark, text).columns == ["id", "v"]


def test_metadata(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "id int, v string")
    assert rows(rm.table_metadata(df, counts=True)) == [(1, "id", "int", 2), (2, "v", "string", 1)]
    assert rows(rm.table_metadata(df)) == [(1, "id", "int"), (2, "v", "string")]


def test_schema_diff(spark):
    a = spark.createDataFrame([(1, 2, 3)], "id int, v int, gone int")
    b = spark.createDataFrame([(1, "2", 3)], "id int, v string, extra int")
    for counts in (False, True):
        got = {r["name"]: r["difference"] for r in rm.schema_diff(a, b, counts).collect()}
        assert got == {"v": "type_differs", "gone": "src_only", "extra": "tgt_only"}


def test_first_rows(spark):
    df = spark.createDataFrame([(3,), (1,), (2,)], "v int")
    assert rows(rm.first_rows(df, 2, ["v"])) == [(1,), (2,)]
    assert rm.first_rows(df, 2).count() == 2


def test_work_dir_is_the_cluster_setting(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert storage.work_dir(spark) == named.rstrip("/")
    assert storage.new_path(spark, "x") != storage.new_path(spark, "x")


def test_no_private_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return None

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage.work_dir(Session())


def test_log_columns(spark, tmp_path):
    log = rm.FileTable(str(tmp_path / "log"))
    for i in (1, 2):
        row = spark.range(1).select(F.lit(str(i)).alias("table_id"), F.lit(i).alias("diff_cnt"), F.lit("?").alias("unknown"))
        rm.append_result_log(row, log)
    logged = rm.scan_table(spark, log)
    assert [f.name for f in logged.schema] == RESULT_LOG.fieldNames() and len(RESULT_LOG) == 30
    assert rows(logged.select("table_id", "diff_cnt", "repair_msg")) == [("1", 1, None), ("2", 2, None)]
