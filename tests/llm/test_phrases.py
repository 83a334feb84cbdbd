"""Phrase mining against counting all runs of words in memory."""

import random
import re
from collections import Counter, defaultdict

import numpy as np

from llm.conftest import DOCS, document
from rowmend.llm import phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=10, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals["und" if lang is None else lang] += len(words)
            for size in (1, 2, 3):
                counts["und" if lang is None else lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        chosen = {p: n for p, n in f.items() if len(p) > 1 and n >= least}
        rows = []
        for p, a in chosen.items():
            cuts = [(1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            if any(len(q) > len(p) and 100 * n >= 50 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, n in chosen.items()):
                continue
            rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:top], 1):  # noqa: E741
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def collocations(docs, **options):
    return sorted(map(tuple, phrases.collocations(docs, **options).collect()))


def corpus(n, seed):
    rng = random.Random(seed)
    words = ["a", "B", "b", "cé", "\x1cd", "É", "e f", "1", "-", "g", "中"]
    marks = [" ", " ", " ", "  ", "\t", ". ", "\n", ",", "\r", " ! ", "\x0b"]
    text = lambda: "".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randint(0, 40)))
    return [(text(), rng.choice(["en", "en", "fr", None])) for _ in range(n)]


def test_small_corpora(spark, odd, empty):
    rows = corpus(400, 3)
    docs = spark.createDataFrame([document(i, t, lang) for i, (t, lang) in enumerate(rows)], DOCS).repartition(5)
    assert collocations(docs) == brute(rows)
    assert collocations(docs, least=3, top=7) == brute(rows, 3, 7)
    assert collocations(odd) == brute([(r["text"], r["lang"]) for r in odd.collect()])
    assert collocations(empty) == []


def test_bursts_spills_and_merges(spark, monkeypatch):
    rows = corpus(300, 5)
    monkeypatch.setattr(phrases, "BURST", 3)
    monkeypatch.setattr(phrases, "MOST_ENTRIES", 40)
    monkeypatch.setattr(phrases, "SLICE_BYTES", 64)
    monkeypatch.setattr(phrases, "MERGED", 5)
    monkeypatch.setattr(phrases, "MOST_WORDS", 8)
    monkeypatch.setattr(phrases, "ROWS_AT_ONCE", 20)
    # One task of each kind, in this process, where the limits are changed.
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"lang": [lang for _, lang in rows], "text": [t for t, _ in rows]})
    sent = pa.Table.from_batches(list(phrases._counted(3)(iter([batch]))))
    assert sent.num_rows > 50
    sent = sent.sort_by([("partition", "ascending"), ("lang", "ascending"), ("kind", "ascending")])
    got = pa.Table.from_batches(list(phrases._merged(4)(iter(sent.to_batches()))))
    counts = {(r["lang"], r["phrase"]): r["f"] for r in got.to_pylist() if r["size"]}
    totals = Counter()
    for r in got.to_pylist():
        totals[r["lang"]] += r["f"] * (r["size"] == 0)
    wanted, all_words = Counter(), Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text.translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            all_words[lang or "und"] += len(words)
            for size in (1, 2, 3):
                wanted.update((lang or "und", " ".join(words[i : i + size])) for i in range(len(words) - size + 1))
    assert counts == {k: n for k, n in wanted.items() if n >= 4}
    assert totals == all_words


def test_containers_burst_at_prefixes_and_spill_whole(monkeypatch):
    monkeypatch.setattr(phrases, "BURST", 5)
    rng, trie, wanted = random.Random(7), phrases.Trie(), Counter()
    for _ in range(40):
        keys = [rng.choice([1, 1, 2, 9]) << 42 | rng.choice([0, 3, 3, 4]) << 21 | rng.randrange(8) for _ in range(20)]
        found, counts = np.unique(np.array(keys), return_counts=True)
        trie.add(found, counts)
        wanted.update(keys)
        assert trie.entries == sum(map(len, trie.below)) == len(wanted)
    assert len(trie.below) > 4 and (np.diff(trie.bounds) > 0).all()
    for k, (low, container) in enumerate(zip(trie.bounds, trie.below)):
        high = trie.bounds[k + 1] if k + 1 < len(trie.bounds) else 1 << 62
        assert all(low <= key < high for key in container)
    # A container with one prefix of two words is as large as it has to be, any other one is not.
    assert all(len({key >> 21 for key in c}) == 1 for c in trie.below if len(c) > 10)
    total, got = len(wanted), Counter()
    for room in (total // 2, 0):
        keys, counts = trie.take(room)
        assert trie.entries <= room
        got.update(dict(zip(keys.tolist(), counts.tolist())))
    assert got == wanted


def test_exact_beyond_64_bits(spark):
    big = spark.createDataFrame([(4_000_000_000_000, 5_000_000_000_000, 6_000_000_000_000)], "a bigint, l bigint, r bigint")
    upper, lower = phrases._score(big.a, big.l, big.r)
    got = big.select(upper.alias("u"), lower.alias("w")).selectExpr("u div w AS score").first()["score"]
    assert got == 1000000 * 4_000_000_000_000**2 // (5_000_000_000_000 * 6_000_000_000_000)


def test_long_texts_are_counted_whole(spark):
    rows = [("one two three " * 20_000 + ". one two", "en"), ("x" * 3_000_000 + " one two", "en")]
    docs = spark.createDataFrame([document(i, t, lang) for i, (t, lang) in enumerate(rows)], DOCS)
    assert collocations(docs) == brute(rows)
