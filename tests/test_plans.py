"""What the plans look like: pruned and pushed-down scans, few shuffles, no all-pairs joins."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import rowmend as rm
from catalog import comparing, reading, repairing, repeated, tasking
from catalog import tables as t

SF = "/root/testdata/sf0.01"


@pytest.fixture(autouse=True, scope="module")
def whole_lines(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", 10000)
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text):
    return re.findall(r"ReadSchema: struct<([^>]*)>", text)


@pytest.mark.parametrize("name", [n for module in (comparing, reading, repairing, repeated, tasking) for n in module.QUERIES])
def test_no_all_pairs_and_no_python(spark, name):
    text = plan(entry.queries()[name](spark, "/root/testdata/sf0.001"))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "Scan ExistingRDD"):
        assert word not in text


def test_scan_reads_only_what_it_needs(spark):
    text = plan(reading.scan_table(spark, SF))
    assert scans(text) == ["l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_shipdate:timestamp_ntz"]
    assert "GreaterThanOrEqual(l_quantity,25.0)" in text


def test_window_reaches_the_scan(spark):
    src = rm.incremental_filter(t.orders(spark, SF), "o_orderdate", reading.DAYS, reading.END)
    text = plan(src)
    assert "GreaterThanOrEqual(o_orderdate,1998-01-01" in text and "LessThan(o_orderdate,1998-07-01" in text


def test_unique_keys_shuffle_each_side_once(spark):
    src = t.orders(spark, SF)
    rows = rm.compare_rows(src, src.withColumn("o_totalprice", F.col("o_totalprice") + 1), ["o_orderkey"], primary_key=True)
    text = plan(rows.where("diff_type <> 'match'"))
    assert text.count("Exchange hashpartitioning") == 2
    assert "FullOuter" in text and "Window" not in text


def test_unknown_keys_shuffle_once(spark):
    """Both sides go through one exchange; numbering and pairing work on it."""
    src = t.orders(spark, SF)
    rows = rm.compare_rows(src, src.withColumn("o_totalprice", F.col("o_totalprice") + 1), ["o_orderkey"])
    text = plan(rows.where("diff_type <> 'match'"))
    assert text.count("Exchange") == 1 and "Join" not in text


def test_summary_does_not_build_records_it_drops(spark):
    text = plan(rm.key_only_compare(t.orders(spark, SF), t.orders(spark, SF), ["o_orderkey"], True))
    assert set(scans(text)) == {"o_orderkey:bigint"}


def test_source_only_reads_target_keys_only(spark):
    text = plan(rm.src_only_rows(t.orders(spark, SF), t.orders(spark, SF), ["o_orderkey"], primary_key=True))
    assert "o_orderkey:bigint" in scans(text)


def test_audit_reads_keys_only(spark):
    assert scans(plan(rm.key_audit(t.lineitem(spark, SF), ["l_orderkey", "l_linenumber"]))) == ["l_orderkey:bigint,l_linenumber:int"]


def test_small_repair_does_not_shuffle_the_tables(spark):
    """A written-down key set is small enough for Spark to broadcast it; the big side is only scanned."""
    src = t.orders(spark, SF)
    wanted = rm.materialize(src.where("o_totalprice < 2000").select("o_orderkey"), "keys")
    patch = rm.repair_rows(src, src, wanted, ["o_orderkey"])
    assert "BroadcastHashJoin" in plan(patch) and "hashpartitioning" not in plan(patch)
    stored = rm.materialize(patch, "patch")
    repaired = plan(rm.apply_repair(src, stored, ["o_orderkey"], "update", primary_key=True))
    # The patch has all columns and keys are unique: the target is read once, and not shuffled.
    assert "LeftAnti, BuildRight" in repaired and "SortMergeJoin" not in repaired
    assert repaired.count("orders.parquet") == 1


def test_large_key_sets_are_not_broadcast(spark):
    src = t.orders(spark, SF)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
        wanted = rm.materialize(src.select("o_orderkey"), "keys")
        assert "BroadcastHashJoin" not in plan(rm.repair_rows(src, src, wanted, ["o_orderkey"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_bucketed_tables_compare_without_a_shuffle(spark, tmp_path):
    for name in ("bucketed_src", "bucketed_tgt"):
        (
            t.orders(spark, SF)
            .write.bucketBy(4, "o_orderkey")
            .sortBy("o_orderkey")
            .option("path", str(tmp_path / name))
            .mode("overwrite")
            .saveAsTable(name)
        )
    src, tgt = spark.table("bucketed_src"), spark.table("bucketed_tgt")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        text = plan(rm.compare_rows(src, tgt, ["o_orderkey"], primary_key=True))
        assert "FullOuter" in text and "Exchange" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        for name in ("bucketed_src", "bucketed_tgt"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
