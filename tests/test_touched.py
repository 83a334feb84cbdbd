"""Repair file by file: what is rewritten, what is published, and when a change is refused."""

import os

import pytest

import rowmend as rm
from conftest import rows
from rowmend.operators.lookup import covering_ranges
from rowmend.sources import storage

SCHEMA = "id int, v int, only_here int"


def table_of(spark, path, data, files=4):
    """A table of several files, ordered by id."""
    df = spark.createDataFrame(data, SCHEMA)
    df.repartitionByRange(files, "id").sortWithinPartitions("id").write.parquet(str(path))
    return rm.VersionedTable(str(path), df.schema)


def stamps(spark, table, names):
    return {n: (os.stat(f"{table.path}/{n}").st_mtime_ns, os.stat(f"{table.path}/{n}").st_ino) for n in names}


DATA = [(i, i, -i) for i in range(100)]


@pytest.mark.parametrize("mode", ["insert", "update", "replace"])
@pytest.mark.parametrize("unique", [True, False])
def test_rows_are_those_of_a_whole_rewrite(spark, tmp_path, mode, unique):
    more = [] if unique else [(5, 7, 0), (5, 8, 0), (None, 1, 1), (None, 2, 2)]
    table = table_of(spark, tmp_path / "t d", [*DATA, *more])
    patch = spark.createDataFrame([(3, 30), (5, 50), (200, 1), *([] if unique else [(5, 7), (None, 3)])], "id int, v int")
    wanted = rows(rm.apply_repair(rm.open_version(spark, table), patch, ["id"], mode, unique))
    before = rm.table_files(spark, table)
    times = stamps(spark, table, before)
    done = rm.repair_files(spark, table, patch, ["id"], mode, unique)
    assert rows(rm.scan_table(spark, table)) == wanted
    after = rm.table_files(spark, table)
    kept = set(before) & set(after)
    assert done.version == 1 and len(kept) == done.kept and set(before) - kept == set(done.rewritten)
    assert len(done.rewritten) == (0 if mode == "insert" else 1 if unique else len(done.rewritten))
    assert len(kept) >= 2 and stamps(spark, table, kept) == {n: times[n] for n in kept}
    # The first version, and a reader that knows of none, see the old rows.
    assert rows(rm.open_version(spark, rm.VersionedTable(table.path, version=0))) == rows(spark.createDataFrame([*DATA, *more], SCHEMA))
    assert spark.read.parquet(table.path).count() == len(DATA) + len(more)


def test_deletion_touches_its_files_too(spark, tmp_path):
    for mode in ("insert", "update"):
        table = table_of(spark, tmp_path / mode, DATA)
        patch = spark.createDataFrame([(3, 30), (90, 9)], "id int, v int")
        rest = rm.delete_where(rm.open_version(spark, table), "v = 99 OR v = 90")
        wanted = rows(rm.apply_repair(rest, patch, ["id"], mode, True))
        rm.repair_files(spark, table, patch, ["id"], mode, True, delete="v = 99 OR v = 90")
        assert rows(rm.scan_table(spark, table)) == wanted


def test_nothing_to_write_leaves_all_files(spark, tmp_path):
    table = table_of(spark, tmp_path / "t", DATA)
    files = rm.table_files(spark, table)
    done = rm.repair_files(spark, table, spark.createDataFrame([], "id int, v int"), ["id"])
    assert done.rewritten == () and set(files) <= set(rm.table_files(spark, table))
    assert rows(rm.scan_table(spark, table)) == sorted(DATA, key=repr)


def test_empty_table(spark, tmp_path):
    table = rm.VersionedTable(str(tmp_path / "none"), spark.createDataFrame([], SCHEMA).schema)
    assert rm.scan_table(spark, table).count() == 0
    rm.repair_files(spark, table, spark.createDataFrame([(1, 2)], "id int, v int"), ["id"], "update", True)
    assert rows(rm.scan_table(spark, table)) == [(1, 2, None)]


def test_changes_of_one_version_exclude_each_other(spark, tmp_path):
    table = table_of(spark, tmp_path / "t", DATA)
    patch = spark.createDataFrame([(3, 30)], "id int, v int")
    rm.repair_files(spark, table, patch, ["id"], base=0)
    with pytest.raises(rm.ChangedMeanwhile):
        rm.repair_files(spark, table, patch, ["id"], base=0)
    assert rm.versions(spark, table) == [1]
    # Even if both passed the first look, only one list gets the name.
    os.makedirs(f"{table.path}/_versions", exist_ok=True)
    files = rm.table_files(spark, table)
    from rowmend.sources import versions

    seen = versions.versions
    try:
        versions.versions = lambda *a: []
        with pytest.raises(rm.ChangedMeanwhile):
            rm.publish(spark, table, 0, [])
    finally:
        versions.versions = seen
    assert rm.table_files(spark, table) == files


def test_a_change_that_stops_before_publication_is_not_seen_and_goes(spark, tmp_path):
    table = table_of(spark, tmp_path / "t", DATA)
    patch = spark.createDataFrame([(3, 1030)], "id int, v int")
    rm.repair_files(spark, table, patch, ["id"])
    kept = rm.table_files(spark, table)
    lost = rm.write_files(patch, table)
    assert rm.table_files(spark, table) == kept
    rm.repair_files(spark, table, spark.createDataFrame([(4, 1040)], "id int, v int"), ["id"])
    gone = rm.remove_unreferenced(spark, table)
    assert set(lost) <= set(gone) and rm.versions(spark, table) == [2]
    assert rm.scan_table(spark, table).where("v IN (1030, 1040)").count() == 2 and rm.scan_table(spark, table).count() == 100


def test_sub_folders_are_refused(spark, tmp_path):
    spark.range(4).selectExpr("id", "id % 2 p").write.partitionBy("p").parquet(str(tmp_path / "t"))
    with pytest.raises(ValueError, match="sub-folders"):
        rm.table_files(spark, rm.VersionedTable(str(tmp_path / "t")))


def test_run_task_repairs_in_place(spark, tmp_path):
    table = table_of(spark, tmp_path / "t", DATA)
    source = lambda spark: spark.createDataFrame([(i, i + 100 * (i == 42)) for i in range(101)], "id int, v int")
    task = rm.CompareTask("1", source, lambda s: rm.scan_table(s, table), ["id"], primary_key=True, enable_repair=True, in_place=table)
    row = rm.run_task(spark, task).first()
    assert (row.repair_status, row.repair_cnt, row.diff_cnt) == ("success", 2, 2)
    assert row.repair_msg.endswith("1 of 4 files rewritten")
    assert rm.scan_table(spark, table).where("id = 42 AND v = 142 OR id = 100").count() == 2
    assert rm.run_task(spark, task).first().repair_status == "skip"


def test_run_task_refuses_a_target_that_changed_meanwhile(spark, tmp_path):
    table = table_of(spark, tmp_path / "t", DATA)

    def target(spark):
        opened = rm.scan_table(spark, table)
        rm.publish(spark, table, 0, rm.table_files(spark, table))
        return opened

    task = rm.CompareTask("1", lambda s: s.range(3).selectExpr("int(id) id", "9 v"), target, ["id"], enable_repair=True, in_place=table)
    with pytest.raises(rm.ChangedMeanwhile):
        rm.run_task(spark, task)


def test_ranges_cover_and_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("id", "id * 2 v").write.parquet(path)
    df = spark.read.parquet(path)
    wanted = spark.createDataFrame([(5,), (7,), (900,), (None,)], "id bigint")
    ranges = covering_ranges(wanted, ["id"], 2)
    assert len(ranges.bounds) == 2 and ranges.nulls
    found = rm.lookup_by_ranges(df, wanted, ["id"], ranges=ranges)
    assert rows(found) == [(5, 10), (7, 14), (900, 1800)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id," in plan.split("PushedFilters")[1]
    # Each key its own condition while there are few; none wanted, nothing read.
    assert covering_ranges(wanted, ["id"]).bounds == ((5, 5), (7, 7), (900, 900))
    assert rm.lookup_by_ranges(df, wanted.where("id < 0"), ["id"]).count() == 0
    # A key of another type, or one without an order shared with the scan, is looked up without ranges.
    assert rows(rm.lookup_by_ranges(df, spark.createDataFrame([(5.0,)], "id double"), ["id"])) == [(5, 10)]
    assert rows(rm.lookup_by_ranges(df, spark.createDataFrame([("5",)], "id string"), ["id"])) == [(5, 10)]


def test_working_folders_of_threads_are_their_own(spark):
    """A task that ends must not take the tables of another one with it."""
    import threading

    opened, ended, result = threading.Event(), threading.Event(), []

    def long_task():
        with storage.working_tables(spark, "long"):
            opened.wait(30)
            kept = rm.materialize(spark.range(7), "kept")
            ended.wait(30)
            result.append(kept.count())

    thread = threading.Thread(target=long_task)
    thread.start()
    with storage.working_tables(spark, "short"):
        opened.set()
        rm.materialize(spark.range(3), "other")
        import time

        time.sleep(1.5)
    ended.set()
    thread.join()
    assert result == [7]
