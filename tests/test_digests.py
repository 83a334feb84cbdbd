"""Comparison by digests and pairing with fewest differences, against comparing all rows."""

import datetime
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import rowmend as rm
from conftest import rows
from rowmend.operators import digests
from rowmend.operators.repair import MODES


def scans(df):
    """The conditions the scans of a frame got."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [p.split("]")[0] for p in plan.split("PushedFilters: [")[1:]]


def table(spark, path, data, schema):
    spark.createDataFrame(data, schema).repartitionByRange(6, "id").write.parquet(str(path))
    return spark.read.parquet(str(path))


def agree(src, tgt, keys=("id",), **options):
    """Differences and counts are those of a whole comparison."""
    keys = list(keys)
    found = rm.digest_compare(src, tgt, keys, **options)
    whole = rm.compare_rows(src, tgt, keys)
    # As text: NaN is no value of its own in Python.
    assert repr(rows(found.differences().drop("occurrence"))) == repr(rows(whole.where("diff_type <> 'match'").drop("occurrence")))
    assert rows(found.summary()) == rows(rm.compare_summary(whole))
    return found


def test_equal_ranges_are_not_read_twice(spark, tmp_path):
    data = [(i, i * 2) for i in range(10_000)]
    src = table(spark, tmp_path / "s", data, "id bigint, v bigint")
    tgt = table(spark, tmp_path / "t", [(i, v + (i in (5_000, 5_003))) for i, v in data if i != 7_777], "id bigint, v bigint")
    found = agree(src, tgt, parts=10, leaf_rows=50)
    # Ten ranges of 1,000 keys, then five in each of two that differ, and five in each of two again: two ranges of 40 keys.
    assert [(s.low, s.high) for s in found.spans] == [(5000, 5040), (7760, 7800)] and found.looked_at == 159
    assert found.equal_rows == 10_000 - 80
    spark.conf.set("spark.sql.maxMetadataStringLength", 10000)
    pushed = scans(found.rows)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert len(pushed) == 2 and all("GreaterThanOrEqual(id,5000)" in p and "LessThan(id,7800)" in p for p in pushed)


def test_equal_tables_and_empty_ones(spark, tmp_path):
    data = [(i, None if i % 3 else float(i)) for i in range(500)] + [(None, 1.0), (3, 3.5), (3, 3.5)]
    src = table(spark, tmp_path / "s", data, "id int, v double")
    found = agree(src, src)
    assert found.looked_at == 0 and found.spans == () and found.equal_rows == 503
    none = src.where("id < 0 AND id > 5")
    agree(none, none)
    agree(src, none)
    agree(none, src)


KEYS = {
    "tinyint": lambda i: i % 256 - 128,
    "bigint": lambda i: (i - 150) * 61_000_000_000_000_000,
    "decimal(20,2)": lambda i: Decimal(i * 37 - 5000) / 100,
    "date": lambda i: datetime.date(1969, 6, 1) + datetime.timedelta(days=i),
    "timestamp_ntz": lambda i: datetime.datetime(1969, 12, 31, 23, 58) + datetime.timedelta(milliseconds=i * 801, microseconds=i),
    "timestamp": lambda i: datetime.datetime(1969, 12, 31, 23, 58, tzinfo=datetime.timezone.utc) + datetime.timedelta(microseconds=i * 801_003),
    "string": lambda i: f"k{i}",
    "double": lambda i: i / 7,
}


@pytest.mark.parametrize("kind", KEYS)
@pytest.mark.parametrize("drift", ["few", "many"])
def test_keys_of_all_kinds(spark, kind, drift):
    rng = random.Random(kind + drift)
    data = [(KEYS[kind](i), rng.choice([None, 1, 2]), rng.choice([0.0, -0.0, float("nan"), 2.5])) for i in range(300) for _ in range(rng.choice([1, 1, 2]))]
    data += [(None, 1, 1.0)] * 2
    changed = {5, 6, 299} if drift == "few" else set(range(0, 300, 2))
    other = [(k, None if v and i in changed else v, x) for i, (k, v, x) in enumerate(data) if i not in (17, 290)] + [(None, 2, 1.0)]
    schema = f"id {kind}, v int, x double"
    agree(spark.createDataFrame(data, schema), spark.createDataFrame(other, schema), parts=16, leaf_rows=3)


def test_nulls_in_different_columns_differ(spark):
    a, b = spark.createDataFrame([(1, None, 5)], "id int, a int, b int"), spark.createDataFrame([(1, 5, None)], "id int, a int, b int")
    assert agree(a, b).looked_at == 2


def test_composite_keys_and_types_that_are_unified(spark):
    a = spark.createDataFrame([(i // 3, i % 3, str(i)) for i in range(90)], "id int, k int, v string")
    b = spark.createDataFrame([(i // 3, i % 3, i + (i == 50)) for i in range(90)], "id bigint, k int, v bigint")
    agree(a, b, ["id", "k"], parts=8, leaf_rows=1)


def test_parts_follow_the_conditions_of_their_spans(spark):
    """A place's part and the bounds that are later read for it are the same, also at the ends of 64 bits."""
    low, high = -(2**63), 2**63
    places = [low, low + 1, -1, 0, 1, 12345678901234567, high - 2, high - 1]
    for spans, parts in (([(low, high)], 7), ([(low, -5), (0, 9), (10, high)], 3)):
        df = spark.createDataFrame([(p,) for p in places], "p bigint")
        bounds = [s for a, b in spans for s in digests._bounds(a, b, parts)]
        for place, part in df.select("p", digests._parts(F.col("p"), spans, parts)).collect():
            if any(a <= place < b for a, b in spans):
                assert bounds[part][0] <= place < bounds[part][1]


# Pairing with fewest differences


def random_side(rng, n):
    return [(rng.choice([1, 2, 3, None]), rng.choice([10, 20, 30, None]), rng.choice([0.0, -0.0, 1.5])) for _ in range(n)]


def test_only_the_missing_row_differs(spark):
    src = spark.createDataFrame([(1, 10), (1, 20), (1, 30)], "id int, v int")
    found = rm.compare_least(src, src.where("v > 10"), ["id"])
    assert found.match_cnt == 2
    assert [(r["diff_type"], r["occurrence"], r["src"]["v"]) for r in found.rows.collect()] == [("src_only", 1, 10)]


@pytest.mark.parametrize("hot_rows", [None, 2])
def test_counts_are_those_of_multisets(spark, hot_rows):
    from collections import Counter

    rng = random.Random(5)
    for n in (0, 1, 30, 80):
        a, b = random_side(rng, n), random_side(rng, n + 3)
        schema = "id int, v int, x double"
        found = rm.compare_least(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), ["id"], hot_rows=hot_rows)
        left, right = Counter((k, v, x + 0.0) for k, v, x in a), Counter((k, v, x + 0.0) for k, v, x in b)
        assert found.match_cnt == sum((left & right).values())
        kinds = Counter(r["diff_type"] for r in found.rows.collect())
        per_key = lambda c: Counter(k for (k, _, _), m in c.items() for _ in range(m))
        src, tgt = per_key(left - right), per_key(right - left)
        assert kinds["mismatch"] == sum((src & tgt).values())
        assert (kinds["src_only"], kinds["tgt_only"]) == (sum((src - tgt).values()), sum((tgt - src).values()))


@pytest.mark.parametrize("mode", MODES)
def test_differences_are_what_a_repair_changes(spark, mode):
    rng = random.Random(8)
    schema = "id int, v int, x double"
    src, tgt = (spark.createDataFrame(random_side(rng, 40), schema) for _ in range(2))
    before = rm.compare_least(src, tgt, ["id"])
    wanted = before.rows.where("diff_type <> 'tgt_only'").select("id").distinct()
    patch = rm.materialize(rm.repair_rows(src, tgt, wanted, ["id"]), "patch")
    after = rm.compare_least(src, rm.apply_repair(tgt, patch, ["id"], mode), ["id"])
    kinds = {r["diff_type"] for r in after.rows.collect()}
    assert kinds <= ({"mismatch", "tgt_only"} if mode == "insert" else {"tgt_only"})
    if mode == "update":
        written = before.rows.where("diff_type IN ('mismatch', 'src_only')").count()
        assert after.match_cnt == before.match_cnt + written


def test_tolerance_decides_about_what_is_left(spark):
    src = spark.createDataFrame([(1, 1.0), (1, 2.0)], "id int, v double")
    tgt = spark.createDataFrame([(1, 1.0), (1, 2.001)], "id int, v double")
    found = rm.compare_least(src, tgt, ["id"], abs_tol=0.01)
    assert found.match_cnt == 1 and [r["diff_type"] for r in found.rows.collect()] == ["match"]


def test_no_job_looks_at_the_keys_first(spark, tmp_path):
    """The comparison's own pass is the only one that reads the tables."""
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("id", "id v").write.parquet(path)
    df, reads = spark.read.parquet(path), []
    sample = type(df).sample
    try:
        type(df).sample = lambda self, *a, **k: reads.append(self.inputFiles()) or sample(self, *a, **k)
        rm.compare_least(df, df.withColumn("v", F.col("v") + (F.col("id") == 3).cast("int")), ["id"]).rows.collect()
    finally:
        type(df).sample = sample
    assert all(path not in f for files in reads for f in files)


def test_slices_of_composite_keys(spark):
    rng = random.Random(2)
    data = [(rng.choice([None, 1, 1, 1, 2]), rng.choice([None, "a", "b'c", "d\\e", "z"])) for _ in range(200)]
    df = spark.createDataFrame(data, "a int, b string")
    for slices in (1, 3, 7, 300):
        conditions = rm.slice_conditions(rm.equal_cuts(df, ["a", "b"], slices), ["a", "b"])
        got = rm.count_slices(df, conditions).collect()
        assert sum(r["row_cnt"] for r in got) == 200 and all(r["hits"] == 1 and r["slice"] is not None for r in got)
    assert rm.slice_conditions(rm.equal_cuts(df.where("a > 5"), ["a", "b"], 4), ["a", "b"]) == ["1 = 1"]
    unique = spark.range(103).selectExpr("id % 2 a", "id b")
    conditions = rm.slice_conditions(rm.equal_cuts(unique, ["a", "b"], 10), ["a", "b"])
    assert sorted(r["row_cnt"] for r in rm.count_slices(unique, conditions).collect()) == [10] * 7 + [11] * 3


def test_database_numbers_its_own_composite_keys(spark, monkeypatch):
    from rowmend.operators import slices
    from rowmend.sources import jdbc

    spec = rm.JdbcTable("postgresql", "h", 1, "d", "t", "u", "p")
    text = jdbc.tuple_cuts_query(spec, ["a", "b"], 4)
    assert 'NTILE(4) OVER (ORDER BY "a", "b") AS "part"' in text and 'WHERE "place" = 1' in text
    cuts = spark.createDataFrame([(2, 5, "x'y"), (1, 1, "k"), (3, 5, "z")], "part int, a int, b string")
    asked = []
    monkeypatch.setattr(slices, "load_query", lambda s, p, q: asked.append(q) or cuts)
    monkeypatch.setattr(slices, "scan_slices", lambda s, p, conditions, columns: conditions)
    assert slices.scan_by_keys(spark, spec, ["a", "b"], 4) == [
        "\"a\" < 5 OR \"a\" IS NULL OR (\"a\" = 5 AND (\"b\" < 'x''y' OR \"b\" IS NULL))",
        "(\"a\" > 5 OR (\"a\" = 5 AND (\"b\" >= 'x''y'))) AND (\"a\" < 5 OR \"a\" IS NULL OR (\"a\" = 5 AND (\"b\" < 'z' OR \"b\" IS NULL)))",
        "\"a\" > 5 OR (\"a\" = 5 AND (\"b\" >= 'z'))",
    ]
    assert asked == [text]
