"""Runs that stop and start again, and tasks that take too long."""

import threading
import time

import pytest

import rowmend as rm
from conftest import rows
from rowmend.plans import ledger as ledgers
from rowmend.plans import limits
from rowmend.plans import tasks as module
from rowmend.sources.sinks import RESULT_LOG

DATA = [(i, i) for i in range(40)]
SCHEMA = "id int, v int"


class Stopped(BaseException):
    """The process is gone: nothing catches this."""


def in_place(spark, tmp_path):
    df = spark.createDataFrame(DATA, SCHEMA)
    df.repartitionByRange(4, "id").write.parquet(str(tmp_path / "target"))
    return rm.VersionedTable(str(tmp_path / "target"), df.schema)


def source(spark):
    return spark.createDataFrame([(i, i + (i == 7) * 100) for i in range(42)], SCHEMA)


def tables(spark, tmp_path):
    log = rm.VersionedTable(str(tmp_path / "log"), RESULT_LOG)
    patch = rm.VersionedTable(str(tmp_path / "patch"), spark.createDataFrame([], SCHEMA).schema)
    return log, patch


@pytest.mark.parametrize("phase", ledgers.PHASES)
@pytest.mark.parametrize("when", ["before", "after"])
def test_a_second_start_goes_on(spark, tmp_path, monkeypatch, phase, when):
    """Stopped just before or just after a phase is noted, the work of each phase is there once."""
    target, (log, patch) = in_place(spark, tmp_path), tables(spark, tmp_path)
    task = rm.CompareTask(
        "a/1", source, lambda s: rm.scan_table(s, target), ["id"], primary_key=True, enable_repair=True, in_place=target, patch_output=patch
    )
    other = rm.CompareTask("2", source, source, ["id"], primary_key=True)
    kept, compared = ledgers.TaskLedger.end, []

    def end(self, name, content):
        if when == "after":
            kept(self, name, content)
        if name == phase and "a_2f_1" in self.path:
            raise Stopped
        if when == "before":
            kept(self, name, content)

    monkeypatch.setattr(ledgers.TaskLedger, "end", end)
    start = lambda: rm.run_tasks(spark, [task, other], log, concurrency=1, ledger=str(tmp_path / "ledger"), run_id="run 1")
    with pytest.raises(Stopped):
        start()
    monkeypatch.setattr(ledgers.TaskLedger, "end", kept)
    counted = module.compare_counts
    monkeypatch.setattr(module, "compare_counts", lambda *a: compared.append(a[1].table_id) or counted(*a))
    report = start()
    assert report.failures == 0 and report.unlogged == ()
    # What was compared is not compared again.
    noted = phase != ledgers.COMPARED or when == "after"
    assert ("a/1" not in compared) == noted
    assert rows(rm.scan_table(spark, target)) == rows(source(spark))
    assert rm.versions(spark, target) == [1]
    assert rows(rm.scan_table(spark, patch)) == [(40, 40), (41, 41), (7, 107)]
    logged = {r["table_id"]: r for r in rm.scan_table(spark, log).collect()}
    assert rm.scan_table(spark, log).count() == 2 and set(logged) == {"a/1", "2"}
    assert (logged["a/1"]["repair_status"], logged["a/1"]["repair_cnt"], logged["a/1"]["diff_cnt"]) == ("success", 3, 3)
    # A third start has nothing to do.
    compared.clear()
    assert start().failures == 0 and compared == [] and rm.scan_table(spark, log).count() == 2


def test_output_of_an_earlier_start_stays(spark, tmp_path):
    log, _ = tables(spark, tmp_path)
    output = rm.FileTable(str(tmp_path / "out"))
    task = rm.CompareTask("1", source, lambda s: s.createDataFrame(DATA, SCHEMA), ["id"], enable_repair=True, output=output)
    for _ in range(2):
        one = rm.TaskLedger(spark, str(tmp_path / "ledger"), "r", "1")
        assert rm.run_task(spark, task, one).first()["repair_status"] == "success"
    assert rows(rm.scan_table(spark, output)) == rows(source(spark))


def test_a_failed_task_is_logged_for_each_start_and_tried_again(spark, tmp_path):
    log, _ = tables(spark, tmp_path)
    broken = rm.CompareTask("1", source, source, ["nope"])
    mended = rm.CompareTask("1", source, source, ["id"])
    for task in (broken, broken, mended, broken):
        rm.run_tasks(spark, [task], log, ledger=str(tmp_path / "ledger"), run_id="r")
    assert sorted(r["compare_status"] for r in rm.scan_table(spark, log).collect()) == ["fail", "fail", "success"]


def test_a_start_thought_dead_publishes_nothing_more(spark, tmp_path):
    first = rm.TaskLedger(spark, str(tmp_path), "r", "1")
    first.end(ledgers.COMPARED, {})
    second = rm.TaskLedger(spark, str(tmp_path), "r", "1")
    with pytest.raises(rm.Overtaken):
        first.end(ledgers.STAGED, {})
    second.end(ledgers.STAGED, {"n": 1})
    assert second.done(ledgers.STAGED) == {"n": 1} and second.done(ledgers.WRITTEN) is None
    assert ledgers.safe_name("a/b") != ledgers.safe_name("a_b")


def test_appends_at_the_same_time_are_all_there_once(spark, tmp_path):
    log = rm.VersionedTable(str(tmp_path / "log"), spark.range(0).schema)
    threads = [threading.Thread(target=rm.append_once, args=(spark.range(k, k + 1), log, f"m{k}")) for k in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert rows(rm.scan_table(spark, log)) == [(0,), (1,), (2,), (3,)]
    assert not rm.append_once(spark.range(9), log, "m2") and rm.scan_table(spark, log).count() == 4


def sleeping(spark):
    """A job of one task that would take a minute."""

    def sleep(parts):
        time.sleep(60)
        yield from parts

    return spark.range(0, 1, 1, 1).mapInArrow(sleep, "id bigint").selectExpr("int(id) id", "1 v")


def test_a_task_beyond_its_time_is_logged_and_its_jobs_are_gone(spark, tmp_path):
    log = rm.FileTable(str(tmp_path / "log"))
    slow = rm.CompareTask("slow", sleeping, source, ["id"])
    quick = [rm.CompareTask(str(k), source, source, ["id"]) for k in range(3)]
    began = time.monotonic()
    report = rm.run_tasks(spark, [slow, *quick], log, concurrency=2, time_limit=6)
    assert time.monotonic() - began < 45 and report.failures == 1
    logged = {r["table_id"]: r for r in rm.scan_table(spark, log).collect()}
    assert "longer than 6 seconds" in logged["slow"]["compare_msg"]
    assert [logged[str(k)]["compare_status"] for k in range(3)] == ["success"] * 3
    tracker = spark.sparkContext.statusTracker()
    assert not tracker.getActiveJobsIds()


def test_a_task_that_hangs_outside_of_spark_holds_nobody_up(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(limits, "GRACE", 0.5)
    log, gone = rm.FileTable(str(tmp_path / "log")), threading.Event()

    def hangs(spark):
        gone.wait(60)
        raise RuntimeError("too late")

    report = rm.run_tasks(spark, [rm.CompareTask("1", hangs, source, ["id"]), rm.CompareTask("2", source, source, ["id"])], log, 1, time_limit=4)
    gone.set()
    assert report.failures == 1 and rm.scan_table(spark, log).count() == 2


def test_short_tasks_beside_a_long_repair(spark, tmp_path):
    """Working tables of one task are not taken away by the end of another."""
    many = lambda s: s.range(3000).selectExpr("int(id) id", "int(id * 2) v")
    long = rm.CompareTask("long", many, lambda s: many(s).where("id % 3 > 0"), ["id"], enable_repair=True, output=rm.FileTable(str(tmp_path / "out")), batch_size=10)
    short = [rm.CompareTask(str(k), source, lambda s: s.createDataFrame(DATA, SCHEMA), ["id"], enable_repair=True, output=rm.FileTable(str(tmp_path / f"out{k}"))) for k in range(6)]
    report = rm.run_tasks(spark, [long, *short], rm.FileTable(str(tmp_path / "log")), concurrency=4)
    assert report.failures == 0
    assert {r["repair_status"] for r in rm.scan_table(spark, rm.FileTable(str(tmp_path / "log"))).collect()} == {"success"}
