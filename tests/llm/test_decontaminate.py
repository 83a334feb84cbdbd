"""Benchmark windows against a search over all places."""

import random
import re

from pyspark.sql import functions as F

from llm.conftest import ODD
from rowmend.llm import decontaminate, rows

WORD = re.compile(decontaminate.WORD)
ITEMS = "item_id bigint, text string, said string"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def said(text):
    return WORD.findall((text or "").translate(FOLD))


def expected(text, items):
    words, hit, found = said(text), set(), set()
    for item, item_text in items:
        own = said(item_text)
        size = min(13, len(own))
        windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in windows:
                hit.update(range(i, i + size))
                found.add("" if item is None else str(item))
    return len(words), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(words)


def check(spark, docs, items):
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], ITEMS)
    got = decontaminate.benchmark_hits(docs, benchmark).collect()
    wanted = [(r["doc_id"], *expected(r["text"], items)) for r in docs.collect()]
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], list(r["items"]), r["contaminated"]) for r in got), key=repr) == sorted(wanted, key=repr)


def test_random_texts(spark, make):
    rng = random.Random(5)
    words = "a b c d e É é x1".split()
    items = [(i % 40, " ".join(rng.choices(words, k=rng.choice([0, 1, 2, 3, 12, 13, 14, 30])))) for i in range(60)]
    texts = []
    for _ in range(60):
        text = rng.choices(words, k=rng.randint(0, 60))
        if rng.random() < 0.6:
            text += rng.choice(items)[1].upper().replace("É", "É").split() + rng.choices(words, k=5)
        texts.append(rng.choice([" ", ", ", "\n"]).join(text))
    check(spark, make(texts), [i for i in items if len(said(i[1])) > 2])
    check(spark, make(texts[:20]), items)


def test_odd_tables(spark, odd, empty, make):
    items = [(None, "one"), (2, "naïve ünïcode 中文"), (2, "the same words twice over and over again"), (3, None), (4, "lorem ipsum dolor sit amet " * 6)]
    check(spark, odd, items)
    check(spark, odd, [])
    check(spark, empty, items)
    assert len(ODD) == odd.count()


def test_shuffled_instead_of_broadcast(spark, make, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    check(spark, make(["a b c d", "x a b c", "b c"]), [(1, "a b c"), (2, "b c")])


def test_contaminated_rows_go(spark, make):
    docs = make(["a b c d", "x y z", "a b c d"])
    found = decontaminate.benchmark_hits(docs, spark.createDataFrame([(1, "b c", "")], ITEMS))
    kept = rows.without(docs, found.where("contaminated").select(rows.row_key()).distinct())
    assert kept.columns == docs.columns and [r["doc_id"] for r in kept.orderBy(F.col("doc_id")).collect()] == [1]
