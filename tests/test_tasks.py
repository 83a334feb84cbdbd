"""Task tables, whole tasks, alerts."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import rowmend as rm
from conftest import rows
from rowmend.plans.tasks import REQUIRED_FIELDS, total_cost

SCHEMA = "id int, v int, at timestamp_ntz"
NOW = datetime(2026, 3, 1)


def frame(data):
    return lambda spark: spark.createDataFrame(data, SCHEMA)


SRC = [(1, 1, datetime(2026, 2, 28)), (2, 2, datetime(2026, 2, 27)), (3, 3, datetime(2026, 1, 1)), (4, 4, datetime(2026, 2, 1))]
TGT = [(1, 1, datetime(2026, 2, 28)), (2, 9, datetime(2026, 2, 26)), (3, 9, datetime(2026, 2, 1)), (5, 5, datetime(2026, 2, 1))]


def task(**more):
    defaults = dict(
        table_id="7", source=frame(SRC), target=frame(TGT), keys=["id"], src_db_name="a", src_table_name="t",
        tgt_db_name="b", tgt_table_name="t", update_column="at",
    )
    return rm.CompareTask(**(defaults | more))


def test_task_table(spark, tmp_path):
    entries = [dict.fromkeys(REQUIRED_FIELDS, "x") | {"id": i, "is_delete": i % 2} for i in range(4)]
    del entries[2]["tgt_host"]
    entries[3]["src_password"] = None
    path = tmp_path / "tasks.json"
    path.write_text(json.dumps(entries))
    tasks = rm.read_tasks(spark, str(path))
    assert rows(rm.active_tasks(tasks).select("id")) == [(0,), (2,)]
    assert rows(rm.active_tasks(tasks, 2).select("id")) == [(2,)]
    missing = {r["id"]: r["missing_fields"] for r in rm.validate_tasks(tasks).collect()}
    assert missing == {0: [], 1: [], 2: ["tgt_host"], 3: ["src_password"]}
    lacking = rm.validate_tasks(tasks.drop("tgt_port"))
    assert lacking.where("is_valid").count() == 0


def test_one_object_is_one_task(spark, tmp_path):
    path = tmp_path / "task.json"
    path.write_text(json.dumps(dict.fromkeys(REQUIRED_FIELDS, "x"), indent=2))
    assert rm.validate_tasks(rm.read_tasks(spark, str(path))).first()["is_valid"]


def test_run_without_repair(spark):
    row = rm.run_task(spark, task()).first()
    assert (row.src_cnt, row.tgt_cnt, row.diff_cnt, row.matching_rate) == (4, 4, 4, 0.25)
    assert (row.compare_status, row.repair_status, row.repair_cnt) == ("success", None, 0)
    assert row.check_range is None
    assert row.check_column == "key_columns: ['id'], update_column: ['at'], extra_columns: ['v']"
    assert row.compare_report == "compared: source 4 rows, target 4 rows, different 4"


def test_run_with_repair(spark, tmp_path):
    output = rm.FileTable(str(tmp_path / "repaired"))
    row = rm.run_task(spark, task(enable_repair=True, time_filter=True, output=output, batch_size=1)).first()
    assert (row.repair_status, row.repair_cnt, row.repair_msg) == ("success", 2, "repaired in 2 batches")
    assert row.compare_total_cost_minute == pytest.approx(row.compare_cost_minute + row.repair_cost_minute, abs=2e-6)
    repaired = {r["id"]: r["v"] for r in rm.scan_table(spark, output).collect()}
    assert repaired == {1: 1, 2: 2, 3: 9, 4: 4, 5: 5}


def test_windowed_run_does_not_overwrite_newer_rows(spark, tmp_path):
    output = rm.FileTable(str(tmp_path / "repaired"))
    windowed = task(
        incremental_days=60, as_of=datetime(2026, 1, 15), enable_repair=True, time_filter=True, output=output
    )
    row = rm.run_task(spark, windowed).first()
    assert row.check_range == "[2025-11-16 00:00:00,2026-01-15 00:00:00)"
    assert (row.src_cnt, row.diff_cnt, row.repair_status) == (1, 1, "skip")
    assert "not newer" in row.repair_msg


def test_other_scopes_and_deletion_before_writing(spark, tmp_path):
    full = rm.FileTable(str(tmp_path / "full"))
    row = rm.run_task(spark, task(enable_repair=True, repair_scope="full", delete_before="id = 5", output=full)).first()
    assert (row.repair_status, row.repair_cnt) == ("success", 4)
    assert {r["id"]: r["v"] for r in rm.scan_table(spark, full).collect()} == {1: 1, 2: 2, 3: 3, 4: 4}
    window = rm.FileTable(str(tmp_path / "window"))
    windowed = task(
        enable_repair=True, repair_scope="window", incremental_days=7, as_of=datetime(2026, 2, 28), output=window
    )
    assert rm.run_task(spark, windowed).first().repair_cnt == 1
    assert {r["id"]: r["v"] for r in rm.scan_table(spark, window).collect()} == {1: 1, 2: 2, 3: 9, 5: 5}


def test_keys_of_different_types(spark, tmp_path):
    output = rm.FileTable(str(tmp_path / "typed"))
    texts = task(
        source=lambda spark: spark.createDataFrame([("1", 1), ("2", 2), ("3", 3)], "id string, v int"),
        target=lambda spark: spark.createDataFrame([(1, 1), (2, 9)], "id int, v bigint"),
        update_column=None,
        enable_repair=True,
        output=output,
    )
    row = rm.run_task(spark, texts).first()
    assert (row.diff_cnt, row.repair_status, row.repair_cnt) == (2, "success", 2)
    assert rows(rm.scan_table(spark, output)) == [(1, 1), (2, 2), (3, 3)]


@pytest.mark.parametrize("mode", ["insert", "update", "replace"])
def test_repeated_and_null_keys_lose_nothing(spark, tmp_path, mode):
    """Every source row of a repaired key is in the target afterwards, and rows of other keys stay."""
    at = SRC[0][2]
    src = [(1, 10, at), (1, 20, at), (None, 5, at), (None, 6, at), (2, 1, at)]
    tgt = [(1, 10, at), (None, 6, at), (2, 1, at), (9, 9, at)]
    output = rm.FileTable(str(tmp_path / "repeated"))
    repeated = task(source=frame(src), target=frame(tgt), enable_repair=True, write_mode=mode, output=output)
    row = rm.run_task(spark, repeated).first()
    assert (row.repair_status, row.repair_cnt) == ("success", 2), row.repair_msg
    written = rows(rm.scan_table(spark, output).select("id", "v"))
    assert written == sorted([(1, 10), (1, 20), (None, 5), (None, 6), (2, 1), (9, 9)], key=repr)


def test_more_target_rows_than_source_rows(spark, tmp_path):
    at = SRC[0][2]
    src, tgt = [(1, 10, at), (1, 20, at)], [(1, 10, at), (1, 5, at), (1, 7, at)]
    output = rm.FileTable(str(tmp_path / "more"))
    row = rm.run_task(spark, task(source=frame(src), target=frame(tgt), enable_repair=True, output=output)).first()
    assert rows(rm.scan_table(spark, output).select("v")) == [(10,), (20,), (7,)]
    assert row.repair_status == "fail"  # the key still has a row that the source lacks


def test_a_false_primary_key_fails_loudly(spark):
    """Three copies in the target would multiply in the join and look equal."""
    wrong = task(source=frame(SRC[:1]), target=frame(SRC[:1] * 3), primary_key=True)
    with pytest.raises(ValueError, match="no primary key"):
        rm.run_task(spark, wrong)
    assert rm.compare_many(spark, [wrong]).first()["compare_status"] == "fail"
    nulls = task(source=frame([(None, 1, None)]), target=frame([]), primary_key=True)
    with pytest.raises(ValueError, match="NULL keys"):
        rm.run_task(spark, nulls)
    assert rm.run_task(spark, task(primary_key=True)).first().diff_cnt == 4


def test_no_limit_unless_one_is_given(spark, tmp_path):
    many = lambda spark: spark.range(4000).selectExpr("int(id) id", "int(id) v", "timestamp_ntz'2026-02-01' at")
    output = rm.FileTable(str(tmp_path / "many"))
    row = rm.run_task(spark, task(source=many, target=frame([]), enable_repair=True, output=output)).first()
    assert (row.repair_status, row.repair_cnt, row.repair_msg) == ("success", 4000, "repaired in 2 batches")
    none = rm.FileTable(str(tmp_path / "none"))
    row = rm.run_task(spark, task(enable_repair=True, max_repair_rows=0, output=none)).first()
    assert row.repair_status == "fail"
    assert rm.task_from_config(CONFIG | {"max_repair_records_threshold": 0}, NOW).max_repair_rows == 0
    assert rm.task_from_config(CONFIG, NOW).max_repair_rows is None


def test_working_tables_go_with_the_task(spark, tmp_path):
    from rowmend.sources import storage

    def left():
        files, place = storage._folder(spark, storage.run_dir(spark))
        return [f.getPath().getName() for f in files.listStatus(place) if f.getPath().getName().startswith("task-")]

    rm.run_task(spark, task(enable_repair=True, output=rm.FileTable(str(tmp_path / "a"))))
    with pytest.raises(Exception, match="nope"):
        rm.run_task(spark, task(keys=["nope"], enable_repair=True, output=rm.FileTable(str(tmp_path / "b"))))
    assert left() == []


def test_output_is_looked_at_first_and_checks_afterwards(spark, tmp_path):
    output = rm.FileTable(str(tmp_path / "taken"))
    rm.write_table(frame(SRC)(spark), output)
    with pytest.raises(ValueError, match="exists already"):
        rm.run_task(spark, task(enable_repair=True, output=output))
    other = rm.FileTable(str(tmp_path / "checked"))
    row = rm.run_task(spark, task(enable_repair=True, output=other, check_after="v < 5")).first()
    assert row.repair_status == "fail" and "v < 5" in row.repair_msg


def test_one_failure_at_run_time_leaves_the_others(spark):
    def unreadable(spark):
        return spark.createDataFrame([(1, 1, "soon")], "id int, v int, at string")

    tasks = [task(table_id="1"), task(table_id="2", source=unreadable), task(table_id="3", target=frame(SRC))]
    got = rows(rm.compare_many(spark, tasks).select("table_id", "compare_status", "diff_cnt"))
    assert got == [("1", "success", 4), ("2", "fail", 0), ("3", "success", 0)]


def test_stored_passwords(spark):
    from rowmend.plans.tasks import with_passwords

    key = F.lit("0123456789abcdef")
    stored = spark.range(1).select(rm.encrypt_column(F.lit("a"), key).alias("src_password"), rm.encrypt_column(F.lit("b"), key).alias("tgt_password"))
    assert rows(with_passwords(stored, key)) == [("a", "b")]


CONFIG = {
    "id": 9, "src_db_type": "MySQL", "src_host": "h", "src_port": "3306", "src_username": "u", "src_password": "p",
    "src_db_name": "a", "src_table_name": "t", "tgt_db_type": "oracle", "tgt_host": "h", "tgt_port": 1521,
    "tgt_username": "u", "tgt_password": "p", "tgt_db_name": "b", "tgt_table_name": "t", "update_time_str": "AT",
    "sensitive_str": "SECRET, ", "incremental": "true", "incremental_days": 7, "enable_repair": True,
    "enable_time_filter": True, "time_tolerance": 0,
}


def test_task_from_config(spark, tmp_path, monkeypatch):
    """Reads are replaced by local tables: no database is reachable here."""
    from rowmend.plans import tasks as module

    def scan(spark, spec, column, slices):
        assert column == "ID" and slices == 32
        data = frame(SRC if spec.dialect == "mysql" else TGT)(spark).withColumn("secret", F.lit(spec.dialect))
        return data.toDF(*[c.upper() for c in data.columns]) if spec.dialect == "oracle" else data

    monkeypatch.setattr(module, "scan_by_key", scan)
    monkeypatch.setattr(module, "primary_keys", lambda spark, spec: ["ID"])
    patch = rm.FileTable(str(tmp_path / "patch"))
    task = rm.task_from_config(CONFIG, datetime(2026, 2, 28), patch_output=patch)
    assert task.resolved(spark).primary_key and task.update_column == "at"
    row = rm.run_task(spark, task).first()
    assert (row.table_id, row.check_range) == ("9", "[2026-02-21 00:00:00,2026-02-28 00:00:00)")
    assert row.check_column == "key_columns: ['id'], update_column: ['at'], extra_columns: ['v']"
    assert (row.src_cnt, row.diff_cnt, row.repair_status, row.repair_cnt) == (1, 1, "success", 1)
    assert [r["id"] for r in spark.read.parquet(patch.path).collect()] == [2]


def test_incomplete_config():
    with pytest.raises(ValueError, match="tgt_host"):
        rm.task_from_config(CONFIG | {"tgt_host": None}, NOW)
    with pytest.raises(ValueError, match="unsupported"):
        rm.task_from_config(CONFIG | {"tgt_db_type": "dbase"}, NOW)
    off = rm.task_from_config(CONFIG | {"incremental": "false", "enable_repair": 0}, NOW, ["ID"])
    assert (off.incremental_days, off.enable_repair, off.keys, off.primary_key) == (None, False, ["id"], False)


def test_gate_stops_large_repairs(spark, tmp_path):
    row = rm.run_task(
        spark, task(enable_repair=True, max_repair_rows=3, output=rm.FileTable(str(tmp_path / "none")))
    ).first()
    assert row.repair_status == "fail" and not (tmp_path / "none").exists()


def test_equal_and_empty_tables(spark):
    row = rm.run_task(spark, task(target=frame(SRC), enable_repair=True, output=rm.FileTable("/nowhere"))).first()
    assert (row.diff_cnt, row.matching_rate, row.repair_status) == (0, 1.0, "skip")
    row = rm.run_task(spark, task(source=frame([]), target=frame([]))).first()
    assert (row.src_cnt, row.matching_rate, row.compare_report) == (0, 1.0, "no data on either side")


def test_tasks_are_logged_one_by_one(spark, tmp_path):
    log = rm.FileTable(str(tmp_path / "log"))
    tasks = [task(table_id="1"), task(table_id="2", keys=["nope"]), task(table_id="3", target=frame(SRC))]
    report = rm.run_tasks(spark, tasks, log, concurrency=2)
    assert (report.failures, report.unlogged) == (1, ())
    assert sorted(a.split(":")[0] for a in report.alerts) == ["table 1", "table 2", "table 2"]
    logged = {r["table_id"]: r for r in rm.scan_table(spark, log).collect()}
    assert {k: r["compare_status"] for k, r in logged.items()} == {"1": "success", "2": "fail", "3": "success"}
    assert "nope" in logged["2"]["compare_msg"]


def test_a_log_that_cannot_be_written_loses_its_rows_only(spark, tmp_path):
    (tmp_path / "log").write_text("no folder")
    report = rm.run_tasks(spark, [task(table_id="1"), task(table_id="2")], rm.FileTable(str(tmp_path / "log")))
    assert (report.failures, sorted(report.unlogged)) == (0, ["1", "2"])


def test_keys_of_both_catalogs(spark, monkeypatch):
    from rowmend.plans import tasks as module

    def named(theirs):
        def primary_keys(spark, spec):
            found = ["ID"] if spec.dialect == "mysql" else theirs
            if not found:
                raise LookupError("no primary key")
            return found

        monkeypatch.setattr(module, "primary_keys", primary_keys)
        return rm.task_from_config(CONFIG, NOW).resolved(spark)

    assert named(["id"]).primary_key and named(["id"]).keys == ["id"]
    assert not named(["id", "v"]).primary_key
    assert not named([]).primary_key


def test_compare_many(spark):
    got = rm.compare_many(spark, [task(table_id="1"), task(table_id="2", update_column="nope"), task(table_id="3", target=frame(SRC))])
    assert rows(got.select("table_id", "compare_status", "diff_cnt")) == [("1", "success", 4), ("2", "fail", 0), ("3", "success", 0)]


def test_alerts(spark):
    data = [("1", "success", 0, 1.0), ("2", "success", 4, 0.96), ("3", "success", 6, 0.94), ("4", "fail", None, None)]
    results = spark.createDataFrame(data, "table_id string, compare_status string, diff_cnt bigint, matching_rate double")
    for name in ("src_db_name", "src_table_name", "tgt_db_name", "tgt_table_name", "compare_msg", "repair_msg"):
        results = results.withColumn(name, F.lit(name))
    alerts = rm.needs_alert_compare(results, 0.05)
    assert rows(alerts.select("table_id")) == [("3",), ("4",)]
    assert "94.00%" in alerts.where("table_id = '3'").first()["alert"]
    assert rows(rm.needs_alert_compare(results).select("table_id")) == [("2",), ("3",), ("4",)]
    repairs = results.withColumn("repair_status", F.when(F.col("table_id") == "2", "fail").when(F.col("table_id") == "3", "success"))
    failed = rm.needs_alert_repair(repairs.withColumn("repair_cnt", F.lit(0)))
    assert rows(failed.select("table_id")) == [("2",)]


def test_total_cost(spark):
    assert spark.range(1).select(total_cost(F.lit(0.1234564), F.lit(None))).first()[0] == 0.123456
