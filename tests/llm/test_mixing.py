"""Mixing against a seat-by-seat apportionment, and odd tables."""

import heapq
import math
import re

from pyspark.sql import functions as F

from llm.conftest import DOCS, ODD, document
from rowmend.llm import mixing


def one_by_one(weights, seats):
    """Sainte-Laguë as it is defined: the next seat goes to the highest quotient."""
    won = [0] * len(weights)
    heap = [(-w, i) for i, w in enumerate(weights) if w > 0]
    heapq.heapify(heap)
    for _ in range(seats if heap else 0):
        _, i = heapq.heappop(heap)
        won[i] += 1
        heapq.heappush(heap, (-weights[i] / (2 * won[i] + 1), i))
    return won


def test_apportionment_is_highest_quotients(spark):
    groups = [([10.0, 7.0, 3.0, 0.0, 1.0], 9), ([1.0] * 7, 3), ([5.0, 5.0, 5.0], 10), ([100.0, 1.0, 1.0], 50), ([2.0], 0), ([0.0], 4)]
    data = [(g, s, i, w) for g, (ws, s) in enumerate(groups) for i, w in enumerate(ws)]
    df = spark.createDataFrame(data, "g int, seats int, place int, w double")
    got = {(r["g"], r["place"]): r["won"] for r in mixing.apportion(df, "g", "seats", "w", "place", "won").collect()}
    for g, (weights, seats) in enumerate(groups):
        assert [got[g, i] for i in range(len(weights))] == one_by_one(weights, seats), g


def mixed(docs, **more):
    return [r.asDict() for r in mixing.mix_sources(docs, **more).collect()]


def test_targets_and_what_is_taken(spark):
    sizes = {"a": [5, 40, 3, 17], "b": [200, 100, 1], "c": [7] * 30, None: [64]}
    data = [document(i, "w " * n, "en", s) for i, (s, n) in enumerate((s, n) for s, ns in sizes.items() for n in ns)]
    for shard in (2, 4096):
        got = mixed(spark.createDataFrame(data, DOCS), rows_per_shard=shard)
        totals = {s: sum(ns) for s, ns in sizes.items()}
        assert math.isclose(sum({r["source_size"]: r["target"] for r in got}.values()), 1.5 * sum(totals.values()))
        for size in set(totals.values()):
            own = [r for r in got if r["source_size"] == size]
            assert own[0]["target"] <= 2 * size
            assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= mixing.BLOCK_WORDS * (len(own) if shard == 2 else 1)
        assert all(0 <= r["taken"] <= 2 * r["size"] and 0 <= r["copies"] <= 2 for r in got)
        assert got == mixed(spark.createDataFrame(data, DOCS), rows_per_shard=shard)


def test_odd_tables(spark, odd, empty):
    got = mixed(odd)
    assert len(got) == len(ODD)
    sizes = sorted((r["doc_id"] or -1, r["size"]) for r in got)
    assert sizes == sorted((d[0] or -1, len(re.findall(r"[^\x20\x09-\x0D]+", d[1] or ""))) for d in ODD)
    assert mixed(empty) == []
    assert sum(r["taken"] for r in mixed(spark.createDataFrame([document(1, None)], DOCS))) == 0


def test_source_order_and_weights(spark):
    """By code point, null last; the fourth source weighs as much as the first."""
    sources = ["Z", "a", "é", None]
    data = [document(i, "w " * 1000, "en", s) for i, s in enumerate(sources)]
    got = {r["doc_id"]: r["target"] for r in mixed(spark.createDataFrame(data, DOCS))}
    # 6000 words by 3 : 1 : 2 : 3, none above 2000.
    assert [round(got[i]) for i in range(4)] == [2000, 667, 1333, 2000]


def test_shards_follow_the_rows(spark):
    docs = spark.range(500).select(
        F.col("id").alias("doc_id"), F.lit("w w w").alias("text"), F.lit("hot").alias("source")
    )
    got = mixed(docs, rows_per_shard=50)
    assert abs(sum(r["taken"] for r in got) - 2250) <= mixing.BLOCK_WORDS and {r["size"] for r in got} == {3}
