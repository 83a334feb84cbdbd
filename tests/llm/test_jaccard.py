"""Jaccard links against all pairs."""

import random
from collections import Counter

import numpy as np
import pytest

from llm.conftest import DOCS, ODD, document
from rowmend.llm import components, jaccard


def shingles(text, size):
    words = [w.lower() for w in (text or "").encode().split()]
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if len(words) >= size else {tuple(words)} if words else set()


def expected(data, size, percent):
    sets = [shingles(t, size) for _, t in data]
    a, b = [], []
    for i in range(len(data)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and common * 100 >= percent * len(sets[i] | sets[j]):
                a.append(i)
                b.append(j)
    label = components.labels(len(data), np.array(a, int), np.array(b, int))
    found = []
    for k, (doc_id, _) in enumerate(data):
        ids = [data[m][0] for m in range(len(data)) if label[m] == label[k] and data[m][0] is not None]
        found.append((doc_id, len(sets[k]), min(ids) if ids else None))
    return sorted(found, key=repr)


def got(docs, *args, **more):
    return sorted((tuple(r) for r in jaccard.jaccard_components(docs, *args, **more).collect()), key=repr)


def variants(rng, n):
    """Texts with copies, near copies of all degrees, and shared passages."""
    words = [f"w{i}" for i in range(60)]
    passage = rng.choices(words, k=25)
    texts = []
    for _ in range(n):
        kind = rng.random()
        if texts and kind < 0.6:
            own = rng.choice(texts).split()
            for _ in range(rng.choice([0, 1, 1, 2, 4, 8])):
                if own:
                    own[rng.randrange(len(own))] = rng.choice(words)
            if rng.random() < 0.3:
                own += rng.choices(words, k=rng.randint(1, 4))
        else:
            own = rng.choices(words, k=rng.choice([1, 2, 3, 5, 9, 12, 30, 80, 200]))
            if kind > 0.8:
                own += passage
        texts.append(rng.choice([" ", "\n", " \t"]).join(w.upper() if rng.random() < 0.1 else w for w in own))
    return texts


@pytest.mark.parametrize("size, percent, blocks", [(3, 90, 1 << 20), (5, 80, 400), (3, 90, 300), (1, 50, 500)])
def test_all_links(make, size, percent, blocks):
    texts = variants(random.Random(size * percent), 260)
    assert got(make(texts), size, percent, block_tokens=blocks, bucket=500) == expected(list(enumerate(texts)), size, percent)


def test_slices_never_miss_a_similar_set():
    rng = np.random.default_rng(2)
    for percent in (90, 80, 50):
        cuts = jaccard.Slices(percent)
        for _ in range(400):
            n = int(rng.integers(1, 200))
            s = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
            common = s[rng.random(len(s)) < rng.uniform(percent / 100, 1)]
            t = np.unique(np.concatenate([common, rng.integers(0, 2**63, int(rng.integers(0, 12)), dtype=np.uint64)]))
            shared = len(np.intersect1d(s, t))
            if len(t) and shared * 100 >= percent * (len(s) + len(t) - shared) and not np.array_equal(s, t):
                assert len(np.intersect1d(cuts.signatures(s), cuts.signatures(t)))


def test_similar_sets_meet_in_the_cut_of_the_larger_one():
    rng = np.random.default_rng(6)
    for percent in (90, 80, 50):
        cuts, met = jaccard.Slices(percent), Counter()
        for _ in range(600):
            s = np.unique(rng.integers(0, 2**63, int(rng.integers(1, 200)), dtype=np.uint64))
            common = s[rng.random(len(s)) < rng.uniform(percent / 100, 1)]
            t = np.unique(np.concatenate([common, rng.integers(0, 2**63, int(rng.integers(0, 12)), dtype=np.uint64)]))
            shared = len(np.intersect1d(s, t))
            if len(t) and shared * 100 >= percent * (len(s) + len(t) - shared) and not np.array_equal(s, t):
                small, large = sorted((s, t), key=len)
                apart = cuts.range_of(len(large)) - cuts.range_of(len(small))
                assert len(np.intersect1d(cuts.by_cut(large)[0], cuts.by_cut(small)[apart]))
                met[apart] += 1
        assert met[0] and met[1]


@pytest.mark.parametrize("most", [None, 2])
def test_nodes_of_the_lower_range_wait_for_one_of_the_upper(most):
    """Dealt to tasks in any way, a signature links what it would at once, if one of its nodes is even."""
    rng = np.random.default_rng(7)
    signatures, nodes = rng.integers(0, 60, 300).astype(np.uint64), rng.integers(0, 200, 300)
    parts = [jaccard._runs(signatures[k::3], nodes[k::3], most) for k in range(3)]
    left, right, *last = jaccard._runs(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
    links = list(zip(np.concatenate([last[0], *[p[2] for p in parts]]).tolist(), np.concatenate([last[1], *[p[3] for p in parts]]).tolist()))
    label = components.labels(200, *np.array(links, int).T)
    for value in set(signatures.tolist()):
        own = nodes[signatures == value]
        if (own % 2 == 0).any():
            assert len(set(label[own])) == 1
    if most is None:
        odd = [v for v in set(signatures.tolist()) if (nodes[signatures == v] % 2).all()]
        assert odd and all(set(right[left == v]) == set(nodes[signatures == v]) for v in odd)
    empty = jaccard._runs(np.zeros(0, np.uint64), np.zeros(0, np.int64), most)
    assert [len(x) for x in empty] == [0] * 4


def test_common_phrases_bring_few_together(make, monkeypatch):
    """What single shingles link must not become one group of most documents, whose blocks are walked in pairs."""
    rng, largest, kept = random.Random(8), [], jaccard.materialize

    def noted(df, label):
        table = kept(df, label)
        if label == "candidates":
            largest.append(max((r["count"] for r in table.groupBy("component").count().collect()), default=0))
        return table

    monkeypatch.setattr(jaccard, "materialize", noted)
    words, phrases = [f"w{i}" for i in range(5000)], [" ".join(f"p{k}x{i}" for i in range(24)) for k in range(8)]
    texts = [" ".join([*rng.choices(words, k=rng.randint(250, 400)), *rng.sample(phrases, 2)]) for _ in range(500)]
    assert all(d == c for d, _, c in got(make(texts), 5, 80))
    assert largest[-1] < 50


def test_trees_prune_and_lose_nothing():
    rng = np.random.default_rng(3)
    base = [np.unique(rng.integers(0, 2**63, 120, dtype=np.uint64)) for _ in range(40)]
    sets = [np.unique(np.concatenate([b[rng.random(len(b)) > 0.03], rng.integers(0, 2**63, 3, dtype=np.uint64)])) for b in base for _ in range(6)]
    levels = jaccard.tree(sets, 1024)
    assert len(levels) >= 3 and [len(x.least) for x in levels] == sorted((len(x.least) for x in levels), reverse=True)
    walk, seen = jaccard.Walk(levels, levels, 0, sets, 80), Counter()
    compare = walk.compare
    walk.compare = lambda x, y: (seen.update(pairs=len(x)), compare(x, y))
    label = walk.run()
    a, b = zip(*[(i, j) for i in range(len(sets)) for j in range(i) if len(np.intersect1d(sets[i], sets[j])) * 100 >= 80 * len(np.union1d(sets[i], sets[j]))])
    assert (components.labels(len(sets), label, np.arange(len(sets))) == components.labels(len(sets), np.array(a), np.array(b))).all()
    assert seen["pairs"] < len(sets) ** 2 / 10


def test_one_python_worker_a_task(make, monkeypatch):
    """Python steps of one stage run beside each other, each in a worker with memory of its own."""
    stages = []
    for module in (jaccard, components):
        kept = module.materialize

        def noted(df, label, kept=kept):
            plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
            stages.extend(plan.replace("BroadcastExchange", "Exchange").split("Exchange"))
            return kept(df, label)

        monkeypatch.setattr(module, "materialize", noted)
    texts = variants(random.Random(4), 60)
    assert got(make(texts)) == expected(list(enumerate(texts)), 3, 90)
    counts = Counter(s.count("InArrow") for s in stages)
    assert counts[1] >= 6 and set(counts) <= {0, 1}


def test_sets_are_marked_a_few_at_a_time(monkeypatch):
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 2**63, int(n), dtype=np.uint64)) for n in rng.integers(1, 90, 70)]
    whole = jaccard.tree(sets, 512)
    for few in (1, 7, 70):
        monkeypatch.setattr(jaccard, "MARKED", few)
        for a, b in zip(whole, jaccard.tree(sets, 512), strict=True):
            assert (a.bits == b.bits).all() and (a.extra == b.extra).all()


def test_odd_tables(spark, odd, empty):
    data = [(d[0], d[1]) for d in ODD]
    assert got(odd) == expected(data, 3, 90)
    assert got(empty) == []


def test_one_of_each_group_stays(spark, odd, empty):
    text = " ".join(f"word{i}" for i in range(60))
    data = [document(5, text), document(3, text.upper()), document(3, text.upper()), document(9, text + " more"), document(None, text), document(1, "other")]
    kept = jaccard.one_per_component(spark.createDataFrame(data, DOCS), 5, 80)
    assert kept.columns == spark.createDataFrame(data, DOCS).columns
    assert sorted((r["doc_id"] for r in kept.collect())) == [1, 3]
    # Documents without words are not alike; equal rows are.
    left = Counter(r["doc_id"] for r in jaccard.one_per_component(odd, 5, 80).collect())
    assert left == Counter({1: 1, 2: 1, 3: 1, 4: 1, 5: 1, None: 1, 6: 1, 7: 1, 8: 1, 9: 1})
    assert jaccard.one_per_component(empty, 5, 80).count() == 0
