"""Every registered query against its SQL, on whole tables."""

import pytest

import __spark_entry__ as entry
import check
from catalog import comparing, reading, repairing, repeated, tasking

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return check.oracle(SF)


def test_each_query_has_sql():
    """All queries of this folder's subject; others state in their own tests how they are checked."""
    ours = {name for module in (comparing, reading, repairing, repeated, tasking) for name in module.QUERIES}
    assert ours <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    row = entry.entry(spark).first()
    assert row["src_cnt"] == row["match_cnt"] + row["mismatch_cnt"] + row["src_only_cnt"]


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_agrees_with_sql(spark, db, name):
    assert check.compare(spark, db, name, SF) is None


def test_known_counts(spark):
    sf = "/root/testdata/sf0.01"
    whole = {r[0]: r[1] for r in entry.queries()["diff_summary"](spark, sf).collect()}
    assert whole == {"match": 13673, "mismatch": 1172, "src_only": 155, "tgt_only": 149}
    window = {r[0]: r[1] for r in entry.queries()["range_compare"](spark, sf).collect()}
    assert window == {"match": 992, "mismatch": 68, "src_only": 42, "tgt_only": 9}
    assert entry.queries()["mismatch_to_repair"](spark, sf).count() == 954
    assert entry.queries()["src_only_recheck"](spark, sf).count() == 13 + 4 + 23
    assert entry.queries()["repair_keys_time_filtered"](spark, sf).count() == 57 + 40
