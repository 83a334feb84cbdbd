"""Embedding links against all pairs in double precision."""

import numpy as np
import pytest

from rowmend.llm import components, embeddings

SCHEMA = "vec_id bigint, embedding array<float>, label int, links string, raw string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, "a", "b") for i, v in rows], SCHEMA)


def expected(rows, threshold):
    ids = [i for i, _ in rows]
    unit = []
    for _, v in rows:
        x = np.array([np.nan if a is None else np.float32(a) for a in v] if v else [np.nan], np.float64)
        unit.append(x / np.linalg.norm(x) if np.isfinite(x).all() and x.any() else None)
    a, b = [], []
    for i in range(len(rows)):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                a.append(i)
                b.append(j)
    label = components.labels(len(rows), np.array(a, int), np.array(b, int))
    links = np.bincount(a + b, minlength=len(rows))
    found = []
    for k in range(len(rows)):
        members = [ids[m] for m in range(len(rows)) if label[m] == label[k] and ids[m] is not None]
        component = min(members) if members else None
        found.append((ids[k], int(links[k]), component, ids[k] == component))
    return sorted(found, key=repr)


def got(df, **more):
    return sorted((tuple(r) for r in embeddings.near_duplicates(df, **more).collect()), key=repr)


@pytest.mark.parametrize("more", [{}, {"block_rows": 20, "pivots": 5}])
def test_all_links(spark, more):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16))
    rows = []
    for i in range(150):
        v = centres[i % 12] + rng.normal(size=16) * rng.choice([0.02, 0.2, 0.35])
        rows.append((i, (v * rng.choice([0.001, 1, 50])).tolist()))
    rows += [(200 + i, rows[i][1]) for i in range(20)]
    df = frame(spark, rows)
    for threshold in (0.95, 0.9):
        assert got(df, threshold=threshold, **more) == expected(rows, threshold)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1, 0]), (2, [2, 0]), (3, None), (4, [0, 0]), (5, [nan, 1]), (6, [inf, 1]), (7, [None, 1]), (8, []), (9, [1, 0, 0]), (10, [1, 0, 0])]
    rows += [(None, [0, 1]), (None, [0, 3]), (11, [0, -1]), (1, [1, 0]), (12, [1e-30, 0]), (13, [0.95, 0.3122499])]
    assert got(frame(spark, rows)) == expected(rows, 0.95)
    assert got(frame(spark, [])) == []
    assert got(frame(spark, [(1, None)])) == [(1, 0, 1, True)]


def test_error_bounds_hold():
    rng = np.random.default_rng(0)
    for dims in (3, 64, 2000):
        rows = rng.normal(size=(50, dims))
        rows /= np.linalg.norm(rows, axis=1, keepdims=True)
        q, scale, error = embeddings.quantised(rows)
        near = embeddings.product(q, q) * scale[:, None] * scale[None, :]
        assert (np.abs(near - rows @ rows.T) <= error[:, None] + error[None, :] * (1 + error[:, None]) + embeddings.ROUNDING).all()
        assert (embeddings.product(q, q) == q.astype(np.int64) @ q.astype(np.int64).T).all()


@pytest.mark.parametrize("local", [0, 1000])
def test_components(spark, local):
    rng = np.random.default_rng(1)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (170, 2))] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    df = spark.createDataFrame(pairs, "a bigint, b bigint").repartition(5)
    found = {r["node"]: r["component"] for r in components.components(df, local).collect()}
    real = [p for p in pairs if p[0] != p[1]]
    nodes = sorted({n for p in real for n in p})
    at = {n: i for i, n in enumerate(nodes)}
    label = components.labels(len(nodes), np.array([at[a] for a, _ in real]), np.array([at[b] for _, b in real]))
    assert found == {n: nodes[label[i]] for n, i in at.items()}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint"), local).count() == 0
