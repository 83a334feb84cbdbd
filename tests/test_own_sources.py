"""Databases and stores that the package does not know by itself, and a second look at differences."""

import pytest
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

import rowmend as rm
from conftest import rows
from rowmend.functions.literals import column_name, sql_literal
from rowmend.sources import dialects, jdbc


@pytest.fixture
def fifth():
    rm.register_dialect(rm.Dialect("newbase", "jdbc:newbase:{database}@{host}/{port}", "org.newbase.Driver", quotes="<>"))
    yield lambda **more: rm.JdbcTable("newbase", "h", 7, "shop", "orders", "u", "p", **more)
    del dialects.DIALECTS["newbase"]


def test_a_fifth_database(spark, fifth):
    table = fifth()
    assert jdbc.connection_options(table)["url"] == "jdbc:newbase:shop@h/7" and table.qualified == "<shop>.<orders>"
    assert jdbc.limited_query(table, ["id"], 3, "v > 1") == "SELECT <id> FROM <shop>.<orders> WHERE (v > 1) FETCH FIRST 3 ROWS ONLY"
    assert jdbc.bounds_query(table, "i>d") == "SELECT MIN(<i>>d>) AS low, MAX(<i>>d>) AS high FROM <shop>.<orders>"
    assert "table_schema = 'shop' AND table_name = 'orders'" in jdbc.metadata_query(table)
    assert "k.table_schema = 'audit'" in jdbc.primary_key_query(fifth(schema="audit"))
    merged = rm.upsert_query(table, fifth(schema="stage"), ["id"], ["id", "v"], "r'1")
    assert merged == (
        "MERGE INTO <shop>.<orders> t USING (SELECT <id>, <v> FROM <stage>.<orders> WHERE <run_id> = 'r''1') s ON (t.<id> = s.<id>)"
        " WHEN MATCHED THEN UPDATE SET t.<v> = s.<v> WHEN NOT MATCHED THEN INSERT (<id>, <v>) VALUES (s.<id>, s.<v>)"
    )
    df = spark.createDataFrame([("a\\'b",)], "k string")
    assert df.select(sql_literal(df.k, df.schema["k"].dataType, "newbase")).first()[0] == "'a\\''b'"
    assert column_name("k", "newbase") == "<k>"
    batches = rm.assign_batches(df, ["k"])
    assert rm.repair_predicates(batches, ["k"], "newbase").first()["predicate"] == "<k> IN ('a\\''b')"


def test_a_database_nobody_made_known():
    with pytest.raises(ValueError, match="unsupported"):
        rm.JdbcTable("newbase", "h", 7, "shop", "orders", "u", "p")


def squares():
    """Defined here, so that it travels to Spark's own processes."""

    class Squares(DataSource):
        """A store of numbers and their squares, a partition for each ten; one of them may be wrong."""

        @classmethod
        def name(cls):
            return "squares"

        def schema(self):
            return "id int, v int"

        def reader(self, schema):
            wrong = int(self.options.get("wrong", "-1"))

            class Reader(DataSourceReader):
                def partitions(self):
                    return [InputPartition(k) for k in range(4)]

                def read(self, partition):
                    first = partition.value * 10
                    yield from ((i, i * i + (i == wrong)) for i in range(first, first + 10))

            return Reader()

    return Squares


def test_a_store_without_jdbc_is_compared_and_copied(spark, tmp_path):
    spark.dataSource.register(squares())
    right, wrong = rm.SourceTable("squares"), rm.SourceTable("squares", {"wrong": "17"})
    assert rm.scan_table(spark, right, ["v"], "id = 5").first()["v"] == 25
    assert rm.scan_table(spark, right).rdd.getNumPartitions() == 4
    output = rm.FileTable(str(tmp_path / "copy"))
    task = rm.CompareTask("1", lambda s: rm.scan_table(s, right), lambda s: rm.scan_table(s, wrong), ["id"], primary_key=True, enable_repair=True, output=output)
    row = rm.run_task(spark, task).first()
    assert (row.diff_cnt, row.repair_status, row.repair_cnt) == (1, "success", 1)
    assert rows(rm.scan_table(spark, output)) == rows(rm.scan_table(spark, right))


def test_states_of_a_second_look(spark):
    src = spark.createDataFrame([(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (None, 1)], "id int, v int")
    tgt = spark.createDataFrame([(1, 9), (2, 9), (3, 9), (6, 6), (7, 7), (5, 5), (None, 2)], "id int, v int")
    first = rm.materialize(rm.compare_rows(src, tgt, ["id"]).where("diff_type <> 'match'"), "diff")
    later = spark.createDataFrame([(1, 9), (2, 2), (3, 8), (4, 4), (6, 6), (5, 6), (None, 2)], "id int, v int")
    found = rm.confirm_differences(first, src, later, ["id"])
    states = {r["id"]: (r["state"], r["diff_type"]) for r in found.collect()}
    assert states == {
        1: ("confirmed", "mismatch"),
        2: ("resolved", "mismatch"),
        3: ("changed", "mismatch"),
        4: ("resolved", "src_only"),
        6: ("confirmed", "tgt_only"),
        7: ("resolved", "tgt_only"),
        None: ("confirmed", "mismatch"),
    }
    # A second row of a key that was looked at is new; keys that agreed are not looked at.
    more = later.unionByName(spark.createDataFrame([(1, 10)], "id int, v int"))
    fresh = [tuple(r)[:3] for r in rm.confirm_differences(first, src, more, ["id"]).where("id = 1").collect()]
    assert (1, 2, "tgt_only") in fresh and len(fresh) == 2


def test_nothing_to_confirm(spark):
    src = spark.createDataFrame([(1, 1)], "id int, v int")
    none = rm.compare_rows(src, src, ["id"])
    assert rm.confirm_differences(none, src, src, ["id"]).count() == 0


@pytest.mark.parametrize("unique", [True, False])
def test_a_task_leaves_alone_what_agrees_by_the_second_look(spark, tmp_path, unique):
    """The copy catches up with row 2 between both looks; only row 3 is written."""
    source = lambda s: s.createDataFrame([(1, 1), (2, 2), (3, 3)], "id int, v int")
    states = [[(1, 1), (2, 9), (3, 9)], [(1, 1), (2, 2), (3, 9)]]
    opened = []

    def target(s):
        opened.append(len(opened))
        return s.createDataFrame(states[min(len(opened), 2) - 1], "id int, v int")

    output = rm.FileTable(str(tmp_path / "out"))
    task = rm.CompareTask("1", source, target, ["id"], primary_key=unique, enable_repair=True, output=output, confirm=True)
    row = rm.run_task(spark, task).first()
    assert (row.diff_cnt, row.repair_status, row.repair_cnt, len(opened)) == (2, "success", 1, 2)
    assert rows(rm.scan_table(spark, output)) == [(1, 1), (2, 2), (3, 3)]
    # With nothing left there is nothing to repair.
    states[:] = [[(1, 9)], [(1, 1), (2, 2), (3, 3)]]
    opened.clear()
    assert rm.run_task(spark, task.__class__(**{**task.__dict__, "output": rm.FileTable(str(tmp_path / "none"))})).first().repair_status == "skip"
