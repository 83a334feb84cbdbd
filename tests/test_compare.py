"""Row comparison on small literal tables."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import rowmend as rm
from conftest import rows

SCHEMA = "id int, name string, age int, update_time timestamp_ntz, salary double"
SRC = [
    (1, "Ann", 30, datetime(2026, 1, 1), 1000.0),
    (2, "Bob", 25, datetime(2026, 1, 2), 2000.0),
    (3, "Cid", 35, datetime(2026, 1, 3), 3000.0),
]
TGT = [(1, "Ann", 30, datetime(2026, 1, 1), 1000.0), (2, "Rob", 26, datetime(2026, 1, 5), 2100.0)]


def kinds(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r["diff_type"] for r in df.collect()}


@pytest.fixture(scope="module")
def pair(spark):
    return spark.createDataFrame(SRC, SCHEMA), spark.createDataFrame(TGT, SCHEMA)


def test_classes(pair):
    compared = rm.compare_rows(*pair, ["id"])
    assert kinds(compared, "id") == {1: "match", 2: "mismatch", 3: "src_only"}
    changed = compared.where("id = 2").first()
    assert changed["diff_columns"] == ["name", "age", "update_time", "salary"]
    assert (changed["src"]["age"], changed["tgt"]["age"]) == (25, 26)


def test_declared_primary_key_gives_the_same(pair):
    plain = rm.compare_rows(*pair, ["id"]).drop("occurrence")
    declared = rm.compare_rows(*pair, ["id"], primary_key=True)
    assert rows(plain) == rows(declared) and plain.columns == declared.columns
    for operator in (rm.mismatch_keys, rm.src_only_rows, rm.tgt_only_keys):
        assert rows(operator(*pair, ["id"])) == rows(operator(*pair, ["id"], primary_key=True))


def test_summary(pair):
    row = rm.compare_summary(rm.compare_rows(*pair, ["id"])).first()
    assert (row.src_cnt, row.tgt_cnt, row.diff_cnt) == (3, 2, 2)
    assert row.matching_rate == pytest.approx(1 / 3)


def test_swapped_sides(pair):
    src, tgt = pair
    assert kinds(rm.compare_rows(tgt, src, ["id"]), "id")[3] == "tgt_only"
    assert rows(rm.tgt_only_keys(tgt, src, ["id"])) == [(3,)]
    assert rows(rm.src_only_rows(src, tgt, ["id"])) == [SRC[2]]


def test_empty_sides(spark, pair):
    none = spark.createDataFrame([], SCHEMA)
    row = rm.compare_summary(rm.compare_rows(none, none, ["id"])).first()
    assert (row.src_cnt, row.tgt_cnt, row.diff_cnt, row.matching_rate) == (0, 0, 0, 1.0)
    row = rm.compare_summary(rm.compare_rows(pair[0], none, ["id"])).first()
    assert (row.src_only_cnt, row.matching_rate) == (3, 0.0)


def test_null_equals_null(spark):
    data = [(1, None, 1), (2, "x", None)]
    a = spark.createDataFrame(data, "id int, name string, age int")
    assert set(kinds(rm.compare_rows(a, a, ["id"]), "id").values()) == {"match"}


def test_one_sided_row_of_nulls_is_not_absent(spark):
    """A row whose values are all NULL still counts as a row of its side."""
    a = spark.createDataFrame([(1, None), (2, 5)], "id int, v int")
    b = spark.createDataFrame([(2, 5), (3, None)], "id int, v int")
    assert kinds(rm.compare_rows(a, b, ["id"]), "id") == {1: "src_only", 2: "match", 3: "tgt_only"}


def test_null_keys_match_each_other(spark):
    a = spark.createDataFrame([(None, 1), (1, 1)], "id int, v int")
    b = spark.createDataFrame([(None, 2), (1, 1)], "id int, v int")
    assert kinds(rm.compare_rows(a, b, ["id"]), "id") == {None: "mismatch", 1: "match"}


def test_special_doubles(spark):
    a = spark.createDataFrame([(1, float("nan")), (2, 0.0), (3, float("inf")), (4, float("nan"))], "id int, v double")
    b = spark.createDataFrame([(1, float("nan")), (2, -0.0), (3, float("inf")), (4, 1.0)], "id int, v double")
    for tolerance in (0.0, 0.5):
        got = kinds(rm.compare_rows(a, b, ["id"], abs_tol=tolerance), "id")
        assert got == {1: "match", 2: "match", 3: "match", 4: "mismatch"}


def test_tolerance(spark):
    a = spark.createDataFrame([(1, 100.0, 2**62), (2, 100.0, 5), (3, None, 5)], "id int, v double, n bigint")
    b = spark.createDataFrame([(1, 100.4, -(2**62)), (2, 100.4, 6), (3, 1.0, 5)], "id int, v double, n bigint")
    exact = rm.compare_rows(a, b, ["id"], ["id", "v"])
    assert set(kinds(exact, "id").values()) == {"mismatch"}
    loose = rm.compare_rows(a, b, ["id"], ["id", "v"], abs_tol=0.5)
    assert kinds(loose, "id") == {1: "match", 2: "match", 3: "mismatch"}
    relative = rm.compare_rows(a, b, ["id"], ["id", "v"], rel_tol=0.005)
    assert kinds(relative, "id") == {1: "match", 2: "match", 3: "mismatch"}
    wide = rm.compare_rows(a, b, ["id"], ["id", "n"], abs_tol=1.0)
    assert kinds(wide, "id") == {1: "mismatch", 2: "match", 3: "match"}


def test_mixed_types(spark):
    a = spark.createDataFrame([("1", "25", "2026-01-01 00:00:00")], "id string, age string, at string")
    b = spark.createDataFrame([(1, 25, datetime(2026, 1, 1))], "id int, age int, at timestamp_ntz")
    assert kinds(rm.compare_rows(a, b, ["id"]), "id") == {"1": "match"}


def test_wide_table(spark):
    columns = ", ".join(f"col_{i} int" for i in range(100))
    a = spark.createDataFrame([(1, *range(100))], f"id int, {columns}")
    b = a.withColumn("col_99", F.lit(-1))
    compared = rm.compare_rows(a, b, ["id"])
    assert compared.first()["diff_columns"] == ["col_99"]
    stats = {r["column_name"]: r for r in rm.column_stats(compared).collect()}
    assert len(stats) == 100
    assert (stats["col_99"]["unequal_cnt"], stats["col_99"]["max_abs_diff"]) == (1, 100.0)
    assert stats["col_0"]["unequal_cnt"] == 0


def test_column_stats_with_tolerance(spark):
    a = spark.createDataFrame([(1, 1.0, 5, "x"), (2, 2.0, None, "x"), (3, 3.0, 7, "x")], "id int, v double, n int, s string")
    b = spark.createDataFrame([(1, 1.25, 5, "x"), (2, 4.0, 6, "x"), (4, 9.0, 9, "y")], "id int, v double, n int, s string")
    stats = rm.column_stats(rm.compare_rows(a, b, ["id"], abs_tol=0.5))
    assert rows(stats) == [("n", 1, 1, 0.0), ("s", 0, 0, None), ("v", 1, 0, 2.0)]
    stats = rm.column_stats(rm.compare_rows(a.where("id = 1"), b, ["id"], abs_tol=0.5))
    assert rows(stats) == [("n", 0, 0, 0.0), ("s", 0, 0, None), ("v", 0, 0, 0.25)]


def test_duplicates_pair_by_occurrence(spark):
    a = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id int, name string")
    b = spark.createDataFrame([(1, "a"), (2, "c"), (2, "d")], "id int, name string")
    got = kinds(rm.compare_rows(a, b, ["id"]), "id", "occurrence")
    assert got == {(1, 1): "match", (1, 2): "src_only", (2, 1): "match", (2, 2): "tgt_only"}


def test_duplicates_never_multiply(spark):
    a = spark.range(1000).select(F.lit(7).alias("id"), (F.col("id") % 3).alias("v"))
    compared = rm.compare_rows(a, a, ["id"])
    assert compared.count() == 1000
    assert rm.compare_summary(compared).first()["match_cnt"] == 1000


def test_key_only(spark):
    a = spark.createDataFrame([(1,), (2,)], "id int")
    b = spark.createDataFrame([(2,), (3,)], "id int")
    assert kinds(rm.key_only_compare(a, b, ["id"]), "id") == {1: "src_only", 3: "tgt_only"}


def test_only_common_columns_count(spark):
    a = spark.createDataFrame([(1, 1, "x")], "id int, v int, only_a string")
    b = spark.createDataFrame([(1, 1, "y")], "id int, v int, only_b string")
    assert kinds(rm.compare_rows(a, b, ["id"]), "id") == {1: "match"}
    with pytest.raises(ValueError, match="missing"):
        rm.compare_rows(a, b, ["only_a"])


def test_odd_column_names(spark):
    a = spark.createDataFrame([(1, 2)], T.StructType().add("the id", T.IntegerType()).add("a.b", T.IntegerType()))
    b = a.withColumn("a.b", F.lit(3))
    got = rm.compare_rows(a, b, ["the id"]).first()
    assert (got["diff_type"], got["diff_columns"]) == ("mismatch", ["a.b"])


def test_key_audit(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (None, 1)], "a int, b int")
    assert rows(rm.key_audit(df, ["a", "b"])) == [(1, 1, 2, False), (None, 1, 1, True)]


def test_report_sentence_and_rows(spark, pair):
    report = rm.compare_report(rm.compare_rows(*pair, ["id"]), ["id"], 5)
    items = {(r["section"], r["item"]): r["value"] for r in report.collect()}
    assert items[("summary", "diff_cnt")] == 2.0
    assert items[("column", "salary.max_abs_diff")] == 100.0
    assert ("sample", "3 src_only") in items


def test_decimals_compare_by_value(spark):
    a = spark.createDataFrame([(1, Decimal("1.5"))], "id int, v decimal(10,1)")
    b = spark.createDataFrame([(1, Decimal("1.50"))], "id int, v decimal(12,2)")
    assert kinds(rm.compare_rows(a, b, ["id"]), "id") == {1: "match"}
