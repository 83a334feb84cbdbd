"""Repair selection and repaired tables."""

from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import rowmend as rm
from conftest import rows
from rowmend.operators import repair

DAY = datetime(2026, 2, 26)
SCHEMA = "id int, v int, at timestamp_ntz"


def at(hours):
    return DAY + timedelta(hours=hours)


def selected(spark, src, tgt, tolerance=0.0, window=None, schema=SCHEMA, time_filter=True):
    a, b = spark.createDataFrame(src, schema), spark.createDataFrame(tgt, schema)
    narrow = (lambda d: d.where((F.col("at") >= F.lit(window[0])) & (F.col("at") < F.lit(window[1])))) if window else (lambda d: d)
    compared = rm.compare_rows(narrow(a), narrow(b), ["id"])
    return rows(rm.repair_keys(compared, b, ["id"], "at", tolerance, time_filter))


def test_scenarios_of_the_time_filter(spark):
    today = (at(0), at(24))
    # Updated at the source only: both rows exist, the target's lies outside the window.
    assert selected(spark, [(1, 2, at(10))], [(1, 1, at(-4))], window=today) == [(1,)]
    # Updated at the target only: target-only in the window, never repaired.
    assert selected(spark, [(2, 1, at(-4))], [(2, 2, at(10))], window=today) == []
    # Source-only in yesterday's window, but the target has a newer row.
    assert selected(spark, [(3, 1, at(-4))], [(3, 2, at(10))], window=(at(-24), at(0))) == []
    # Source-only, and the target has no such row at all.
    assert selected(spark, [(4, 1, at(10))], [], window=today) == [(4,)]


def test_time_rule(spark):
    src = [(1, 1, at(1)), (2, 1, at(1)), (3, 1, at(1)), (4, 1, None), (5, 1, at(1))]
    tgt = [(1, 2, at(0)), (2, 2, at(1)), (3, 2, at(2)), (4, 2, at(2)), (5, 2, None)]
    assert selected(spark, src, tgt) == [(1,), (2,), (4,), (5,)]
    assert selected(spark, src, tgt, tolerance=1.0) == [(1,), (4,), (5,)]
    assert selected(spark, src, tgt, tolerance=3601.0) == [(4,), (5,)]
    assert selected(spark, src, tgt, time_filter=False) == [(1,), (2,), (3,), (4,), (5,)]


def test_fractions_of_a_second_count(spark):
    src, tgt = [(1, 1, at(1) + timedelta(milliseconds=400))], [(1, 2, at(1))]
    assert selected(spark, src, tgt, tolerance=0.4) == [(1,)]
    assert selected(spark, src, tgt, tolerance=0.400001) == []


def test_unreadable_times(spark):
    """Text that is no time: a mismatch is repaired, a source-only row is skipped."""
    text = "id int, v int, at string"
    src = [(1, 1, "2026-02-26 10:00:00"), (2, 1, "2026-02-26 10:00:00")]
    tgt = [(1, 2, "soon"), (2, 2, "soon")]
    a, b = spark.createDataFrame(src, text), spark.createDataFrame(tgt, text)
    compared = rm.compare_rows(a, b.where("id = 1"), ["id"])
    assert rows(rm.mismatch_to_repair(compared, ["id"], "at")) == [(1,)]
    assert rows(rm.src_only_to_repair(compared, b, ["id"], "at")) == []
    empty = b.withColumn("at", F.lit(""))
    assert rows(rm.src_only_to_repair(compared, empty, ["id"], "at")) == [(2,)]


def test_source_only_looks_at_the_latest_target_row(spark):
    a = spark.createDataFrame([(1, 1, at(5))], SCHEMA)
    b = spark.createDataFrame([(1, 1, at(1)), (1, 2, at(9))], SCHEMA)
    compared = rm.compare_rows(a, b.limit(0), ["id"])
    assert rows(rm.src_only_to_repair(compared, b, ["id"], "at")) == []


@pytest.mark.parametrize(
    "enabled, diff, left, status",
    [(False, 5, None, "skip"), (True, 0, None, "skip"), (True, 3001, None, "fail"), (True, 3000, None, "run"), (True, 5, 0, "skip"), (True, 5, 2, "run")],
)
def test_gate(spark, enabled, diff, left, status):
    summary = spark.range(1).select(F.lit(diff).cast("bigint").alias("diff_cnt"))
    gated = rm.repair_gate(summary, enabled, 3000, None if left is None else F.lit(left)).first()
    assert gated["repair_status"] == status
    if diff > 3000:
        assert "3001" in gated["repair_msg"] and "3000" in gated["repair_msg"]


def predicates(spark, data, schema, keys, size=3000):
    df = rm.assign_batches(spark.createDataFrame(data, schema), keys, size)
    return {r["batch"]: r["predicate"] for r in rm.repair_predicates(df, keys).collect()}


def test_predicates(spark):
    assert predicates(spark, [(10,), (9,), (2,)], "id int", ["id"], 2) == {1: "id IN (2, 9)", 2: "id IN (10)"}
    assert predicates(spark, [("it's",), ("b",)], "k string", ["k"]) == {1: "k IN ('b', 'it''s')"}
    assert predicates(spark, [(1,), (None,)], "id int", ["id"]) == {1: "id IN (1) OR id IS NULL"}
    assert predicates(spark, [(None,)], "id int", ["id"]) == {1: "id IS NULL"}


def test_composite_predicate_selects_exactly_its_keys(spark):
    keys = [(1, "a"), (2, "b"), (3, None)]
    text = predicates(spark, keys, "u int, o string", ["u", "o"])[1]
    assert text == "(u = 1 AND o = 'a') OR (u = 2 AND o = 'b') OR (u = 3 AND o IS NULL)"
    everything = spark.createDataFrame([(u, o) for u in (1, 2, 3) for o in ("a", "b", None)], "u int, o string")
    assert rows(everything.where(text)) == sorted(keys, key=repr)


def test_predicates_select_exactly_texts_and_times(spark):
    texts = ["it's", "back\\slash", "end\\", "'", "plain"]
    df = spark.createDataFrame([(t,) for t in [*texts, "other"]], "`a b` string")
    wanted = rm.assign_batches(df.where("`a b` <> 'other'"), ["a b"])
    text = rm.repair_predicates(wanted, ["a b"]).first()["predicate"]
    assert rows(df.where(text)) == sorted([(t,) for t in texts], key=repr)
    times = [datetime(2026, 1, 1, 0, 0, 0, us) for us in (0, 250000, 1)]
    df = spark.createDataFrame([(t,) for t in times], "at timestamp_ntz")
    for chosen in times:
        wanted = rm.assign_batches(df.where(F.col("at") == F.lit(chosen)), ["at"])
        assert rows(df.where(rm.repair_predicates(wanted, ["at"]).first()["predicate"])) == [(chosen,)]
    quoted = {"mysql": "`k` IN ('a\\\\''')", "oracle": "\"K\" IN ('a\\''')"}
    for dialect, expected in quoted.items():
        wanted = rm.assign_batches(spark.createDataFrame([("a\\'",)], "k string"), ["k"])
        assert rm.repair_predicates(wanted, ["k"], dialect).first()["predicate"] == expected


@pytest.fixture(scope="module")
def tables(spark):
    tgt = spark.createDataFrame([(1, 10, "x", 100), (2, 20, "y", 200)], "id int, v int, w string, only_tgt int")
    patch = spark.createDataFrame([(2, 21, "z"), (3, 31, None)], "id bigint, v bigint, w string")
    return tgt, patch


def test_insert(tables):
    assert rows(rm.apply_repair(*tables, ["id"], "insert")) == [(1, 10, "x", 100), (2, 20, "y", 200), (3, 31, None, None)]


@pytest.mark.parametrize("mode", ["update", "UPDATE", "unheard-of", None])
def test_update(tables, mode):
    repaired = rm.apply_repair(*tables, ["id"], mode)
    assert rows(repaired) == [(1, 10, "x", 100), (2, 21, "z", 200), (3, 31, None, None)]
    assert repaired.schema == tables[0].schema


def test_update_writes_nulls(spark, tables):
    patch = spark.createDataFrame([(1, None)], "id int, v int")
    assert rows(rm.apply_repair(tables[0], patch, ["id"])) == [(1, None, "x", 100), (2, 20, "y", 200)]


def test_replace(tables):
    assert rows(rm.apply_repair(*tables, ["id"], "replace")) == [(1, 10, "x", 100), (2, 21, "z", None), (3, 31, None, None)]


def test_repeated_patch_keys_are_all_written(spark, tables):
    patch = spark.createDataFrame([(3, 1), (3, 2), (2, 5), (2, 4)], "id int, v int")
    expected = {
        "insert": [(1, 10), (2, 20), (2, 5), (3, 1), (3, 2)],
        "update": [(1, 10), (2, 4), (2, 5), (3, 1), (3, 2)],
        "replace": [(1, 10), (2, 4), (2, 5), (3, 1), (3, 2)],
    }
    for mode, written in expected.items():
        assert rows(rm.apply_repair(tables[0], patch, ["id"], mode).select("id", "v")) == written


def test_a_row_overwrites_one_row(spark):
    """Target rows of a key beyond those of the patch stay as they are."""
    tgt = spark.range(500).select(F.lit(1).alias("id"), F.col("id").alias("v"))
    patch = spark.createDataFrame([(1, -1)], "id int, v bigint")
    repaired = rm.apply_repair(tgt, patch, ["id"])
    assert (repaired.count(), repaired.where("v = -1").count()) == (500, 1)


def test_delete_where_keeps_unknown(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "v int")
    assert rows(rm.delete_where(df, "v > 3")) == [(1,), (None,)]


def test_scopes(spark):
    src = spark.createDataFrame([(1, 1, at(0)), (2, 1, at(30))], SCHEMA)
    assert rm.repair_window(src, src, ["id"], "full").count() == 2
    assert rows(rm.repair_window(src, src, ["id"], "window", "at", (at(0), at(24))).select("id")) == [(1,)]
    with pytest.raises(ValueError, match="scope"):
        rm.repair_window(src, src, ["id"], "window")


@pytest.mark.parametrize("seed", range(2))
def test_repair_leaves_no_difference(spark, seed):
    """After an update repair without time filter, no repaired key differs."""
    src = spark.range(300).select(F.col("id"), (F.rand(seed) * 5).cast("int").alias("v"))
    tgt = spark.range(50, 350).select(F.col("id"), (F.rand(seed + 10) * 5).cast("int").alias("v"))
    src, tgt = rm.materialize(src, "t"), rm.materialize(tgt, "t")
    compared = rm.compare_rows(src, tgt, ["id"])
    wanted = rm.materialize(rm.repair_keys(compared, tgt, ["id"]), "t")
    repaired = rm.apply_repair(tgt, rm.repair_rows(src, tgt, wanted, ["id"]), ["id"])
    after = {r["diff_type"]: r["row_cnt"] for r in rm.diff_summary(rm.compare_rows(src, repaired, ["id"])).collect()}
    assert set(after) == {"match", "tgt_only"}
    assert set(rows(rm.diff_summary(rm.verify_repair(src, repaired, wanted, ["id"])).select("diff_type"))) == {("match",)}


def test_outcome(spark):
    batches = spark.createDataFrame([(1, 1), (2, 1), (3, 2)], "id int, batch bigint")

    def outcome(kinds):
        checked = spark.createDataFrame(kinds, "id int, diff_type string")
        return tuple(rm.repair_outcome(rm.batch_outcome(checked, batches, ["id"])).first())

    assert outcome([(1, "match"), (2, "match"), (3, "match")]) == (2, 3, 0, "success")
    assert outcome([(1, "match"), (2, "mismatch"), (3, "match")]) == (2, 2, 1, "partial_fail")
    assert outcome([(1, "src_only"), (2, "match")]) == (2, 1, 2, "fail")


def test_lookup_in_files_tests_rows_against_few_conditions(spark, tmp_path):
    """The scan's condition does not grow with the batches; NULL keys and columns without the key are served as before."""
    data = [(k if k % 50 else None, k % 7) for k in range(600)]
    spark.createDataFrame(data, "k bigint, v int").repartition(2).write.parquet(f"{tmp_path}/t")
    keys = spark.createDataFrame([(k,) for k in range(0, 600, 3)] + [(None,), (10_000,)], "k bigint")
    wanted = {None, *range(0, 600, 3)}
    expected = sorted((r for r in data if r[0] in wanted), key=repr)
    for size, joined in ((2, True), (60, False)):
        found = rm.lookup_by_predicates(spark, rm.FileTable(f"{tmp_path}/t"), rm.assign_batches(keys, ["k"], size), ["k"])
        assert rows(found) == expected
        assert ("LeftSemi" in found._jdf.queryExecution().optimizedPlan().toString()) == joined
    batches = rm.assign_batches(keys, ["k"], 2)
    narrow = rm.lookup_by_predicates(spark, rm.FileTable(f"{tmp_path}/t"), batches, ["k"], ["v"])
    assert narrow.columns == ["v"] and rows(narrow) == sorted([(v,) for _, v in expected], key=repr)


def test_equal_rows_of_both_sides_are_told_in_one_shuffle(spark):
    mine = [(k % 5 if k % 6 else None, (0.0, -0.0, 1.5, float("nan"))[k % 4], k) for k in range(120)]
    theirs = [(k % 7 if k % 5 else None, (0.0, -0.0, 1.5, float("nan"))[k % 3]) for k in range(150)]
    a = spark.createDataFrame(mine, "id int, v double, extra int")
    b = spark.createDataFrame(theirs, "id int, v double")
    plain = lambda rs: Counter(("" if r[0] is None else r[0], repr(r[1] + 0.0)) for r in rs)
    both = plain(mine) & plain(theirs)
    # Of equal rows those with the smallest extra value have a partner.
    kept, seen = [], Counter()
    for r in sorted(mine, key=lambda r: r[2]):
        value = next(iter(plain([r])))
        seen[value] += 1
        kept += [r[2]] if seen[value] <= both[value] else []
    for hot_rows in (None, 15):
        marked = repair._marked_equals(a, b, ["id", "v"], hot_rows)
        found = marked.collect()
        assert plain([r for r in found if r["_mine"]]) == plain(mine) and plain([r for r in found if not r["_mine"]]) == plain(theirs)
        assert plain([r for r in found if not r["_mine"] and r["_equal"]]) == both
        assert sorted(r["extra"] for r in found if r["_mine"] and r["_equal"]) == sorted(kept)
        assert Counter(repr(r["v"]) for r in found if r["_mine"]) == Counter(repr(r[1]) for r in mine)
    plan = repair._marked_equals(a, b, ["id", "v"], None)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_more_rows_are_sorted_in_more_partitions(spark, monkeypatch):
    """A task's share of rows does not grow with the table, whatever number of partitions the session names."""
    a = spark.range(40_000).selectExpr("id", "id % 9 AS v")
    b = spark.range(40_000).selectExpr("id", "id % 8 AS v")
    cut = lambda: rm.compare_rows(a, b, ["id"], hot_rows=1000)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" not in cut()
    monkeypatch.setattr("rowmend.operators.keys.TASK_ROWS", 4_000)
    assert "REPARTITION_BY_NUM" in cut()
    counted = {r[0]: r[1] for r in rm.diff_summary(rm.compare_rows(a, b, ["id"], hot_rows=1000)).collect()}
    same = sum(k % 9 == k % 8 for k in range(40_000))
    assert counted == {"match": same, "mismatch": 40_000 - same}
