"""Numbering against brute force."""

import random

import pytest
from pyspark.sql import functions as F

import rowmend as rm
from conftest import rows
from rowmend.operators import ranks
from rowmend.operators.keys import number_occurrences
from rowmend.operators.ranks import assign_batches, global_rank, number_in_hot_key


def first(value):
    return (value is not None, value)


def brute_force(data):
    """(key, value) pairs with their occurrence inside the key, in value order."""
    groups = {}
    for key, value in data:
        groups.setdefault(key, []).append(value)
    return sorted(
        ((k, v, i + 1) for k, vs in groups.items() for i, v in enumerate(sorted(vs, key=first))), key=repr
    )


def sample(seed, n=400):
    rng = random.Random(seed)
    keys = [1] * 6 + [2, 3, None]
    return [(rng.choice(keys), rng.choice([None, *range(rng.choice([3, 200]))])) for _ in range(n)]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("hot_rows", [1, 60, 10**6])
def test_occurrences(spark, monkeypatch, seed, hot_rows):
    monkeypatch.setattr(ranks, "COPY_STEP", 7)
    data = sample(seed)
    df = spark.createDataFrame(data, "k int, v int").repartition(5)
    got = number_occurrences(df, ["k"], hot_rows)
    assert rows(got) == brute_force(data)


def test_all_rows_are_copies(spark, monkeypatch):
    monkeypatch.setattr(ranks, "COPY_STEP", 10)
    df = spark.range(95).select(F.lit("a").alias("k"), F.lit(1).alias("v"))
    assert rows(number_in_hot_key(df, ["k"], ["v"], "n")) == sorted((("a", 1, i) for i in range(1, 96)), key=repr)


def test_keys_without_values(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    for hot_rows in (1, 100):
        assert rows(number_occurrences(df, ["k"], hot_rows)) == [(1, 1), (1, 2), (2, 1)]


def test_hot_keys(spark):
    df = spark.createDataFrame([(1,)] * 50 + [(None,)] * 30 + [(i,) for i in range(2, 40)], "k int")
    assert rows(rm.hot_keys(df, ["k"], 20)) == [(1,), (None,)]
    assert rm.hot_keys(df, ["k"], 1000) is None
    assert rm.hot_keys(df, ["k"], None) is None


def test_hot_keys_are_found_in_a_sample(spark):
    skewed = spark.range(300_000).select((F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id"))).alias("k"))
    assert rows(rm.hot_keys(skewed, ["k"], 50_000)) == [(-1,)]


def test_hot_comparison_equals_plain_comparison(spark):
    a = spark.createDataFrame(sample(7), "k int, v int")
    b = spark.createDataFrame(sample(8), "k int, v int")
    plain, hot = (rm.compare_rows(a, b, ["k"], hot_rows=n) for n in (10**6, 20))
    assert rows(plain) == rows(hot)


def test_global_rank(spark):
    values = random.Random(1).sample(range(10**6), 3000)
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(7)
    assert rows(global_rank(df, ["v"])) == sorted(((v, i + 1) for i, v in enumerate(sorted(values))), key=repr)


@pytest.mark.parametrize("n, batches", [(0, 0), (1, 1), (3000, 1), (3001, 2), (3500, 2), (6500, 3)])
def test_batches(spark, n, batches):
    keys = spark.range(1, n + 1).withColumnRenamed("id", "k").repartition(6)
    counts = {r["batch"]: r["count"] for r in assign_batches(keys, ["k"]).groupBy("batch").count().collect()}
    assert sorted(counts) == list(range(1, batches + 1))
    assert sum(counts.values()) == n
    assert all(counts[b] == 3000 for b in list(sorted(counts))[:-1])


def test_batches_of_composite_and_repeated_keys(spark):
    data = [(a, b) for a in (3, 1, 2) for b in "zyx"]
    keys = spark.createDataFrame(data + data, "a int, b string")
    got = rows(assign_batches(keys, ["a", "b"], 4))
    assert got == [(a, b, i // 4 + 1) for i, (a, b) in enumerate(sorted(data))]
    with pytest.raises(ValueError):
        assign_batches(keys, ["a", "b"], 0)


def test_hot_keys_keep_the_sign_of_zero(spark):
    data = [(1, v, [v], (w,)) for v in (0.0, -0.0, 1.5, None) for w in (0.0, -0.0) for _ in range(3)] + [(-0.0, float("nan"), [-0.0], (1.0,))]
    df = spark.createDataFrame([(float(k), *r) for k, *r in data], "k double, v double, l array<float>, s struct<w:double>")
    usual, hot = (number_occurrences(df, ["k"], n) for n in (10**6, 1))
    numbers = lambda df: sorted(r["occurrence"] for r in df.where("k = 1").collect())
    assert numbers(hot) == numbers(usual) == list(range(1, 25))
    # As text, since -0.0 == 0.0.
    assert repr(rows(hot.drop("occurrence"))) == repr(rows(usual.drop("occurrence"))) == repr(rows(df))
