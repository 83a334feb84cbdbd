"""Embedding near-dedup: int8 tile products with rigorous bounds, doubts settled in double precision.

Equal vectors are one class, found by grouping. Classes are dealt to blocks of neighbouring
vectors (nearest of a few pivots, cut by hash where a pivot has many). Two blocks are
compared unless their centres lie farther apart than both radii and the threshold's angle.

A unit vector u is s q + e with an int8 vector q, and |e| is computed. Then
|u.v - s s' q.q'| <= |e| + |e'| + |e||e'|, and only pairs for which the threshold lies
inside that bound are computed in double precision. A task adds up each class's links
and keeps one link per class into the component it found, so a group of many near copies
is never written out pair by pair.

Without structure in the data all blocks meet: the work is then n^2 / 2 int8 products,
and a vector travels to every block. That is the price of losing no link.

Nulls: vectors that are null, empty, zero, or hold null or non-finite components link with
nothing; vectors of different lengths do not link. Each row is a vector of its own, also
where a vec_id repeats or is null; component_id is the smallest id that is not null. An
empty table has no rows. Other columns, labels included, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmend.llm.components import components, labels
from rowmend.sources.storage import materialize

THRESHOLD = 0.95
BLOCK_ROWS = 4096
MAX_BLOCKS = 2048  # beyond BLOCK_ROWS * MAX_BLOCKS vectors the blocks grow instead
PIVOTS = 256
TILE = 1024
EXACT_DIMS = 1024  # 127 * 127 * 1024 < 2^24: sums of products are exact in single precision
ROUNDING = 1e-6  # of scaling a product in single precision, and more

PREPARED = "vec_id bigint, key binary, dim int, raw binary"


def _prepared(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors that can link as bytes of doubles, with a digest; nulls for the others."""
    for part in parts:
        raw = []
        for vector in part.column("embedding").to_pylist() if part.num_rows else []:
            values = np.array([] if vector is None else vector, np.float64)  # None becomes NaN
            raw.append((values + 0.0).tobytes() if len(values) and np.isfinite(values).all() and values.any() else None)
        keys = [None if r is None else hashlib.blake2b(r, digest_size=16).digest() for r in raw]
        dims = [None if r is None else len(r) // 8 for r in raw]
        columns = [part.column("vec_id"), pa.array(keys, pa.binary()), pa.array(dims, pa.int32()), pa.array(raw, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["vec_id", "key", "dim", "raw"])


def unit_rows(raw: list[bytes]) -> np.ndarray:
    rows = np.stack([np.frombuffer(r, np.float64) for r in raw])
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # so that no square vanishes or overflows
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _celled(pivots: dict[int, np.ndarray]):
    """Number of the nearest pivot of the same length; -1 if there is none."""

    def assign(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            dims = part.column("dim").to_numpy(zero_copy_only=False)
            cells = np.full(part.num_rows, -1, np.int32)
            raw = part.column("raw").to_pylist()
            for dim in np.unique(dims):
                if int(dim) in pivots:
                    chosen = np.flatnonzero(dims == dim)
                    cells[chosen] = np.argmax(unit_rows([raw[i] for i in chosen]) @ pivots[int(dim)].T, axis=1)
            columns = [part.column(c) for c in ("class_id", "copies", "dim", "raw")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(cells)], ["class_id", "copies", "dim", "raw", "cell"])

    return assign


def _centre(table: pa.Table) -> pa.Table:
    rows = unit_rows(table.column("raw").to_pylist())
    centre = rows.mean(axis=0)
    centre = centre / max(np.linalg.norm(centre), 1e-300)
    radius = float(np.arccos(np.clip(rows @ centre, -1, 1)).max()) if centre.any() else np.pi
    block, dim = table.column("block")[0].as_py(), table.column("dim")[0].as_py()
    return pa.table({"block": pa.array([block], pa.int64()), "dim": pa.array([dim], pa.int32()), "centre": [centre.tobytes()], "radius": [radius]})


def quantised(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 vectors, their scales, and upper bounds of the errors' lengths."""
    scale = np.abs(rows).max(axis=1) / 127
    q = np.rint(rows / scale[:, None]).astype(np.int8)
    return q, scale, np.linalg.norm(rows - q * scale[:, None], axis=1) * (1 + 1e-9) + 1e-12


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of int8 rows."""
    total = 0.0
    for first in range(0, a.shape[1], EXACT_DIMS):
        part = slice(first, first + EXACT_DIMS)
        tile = a[:, part].astype(np.float32) @ b[:, part].astype(np.float32).T
        total = tile if a.shape[1] <= EXACT_DIMS else total + tile.astype(np.float64)
    return total


def tile_links(a, b, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of linked pairs of two tiles; a tile is (unit rows, int8 rows, scales, errors)."""
    (u, qa, sa, ea), (v, qb, sb, eb) = a, b
    near = product(qa, qb) * sa.astype(np.float32)[:, None] * sb.astype(np.float32)[None, :]
    doubt = ea + eb.max() * (1 + ea) + ROUNDING
    r, c = np.nonzero(near >= (threshold - doubt).astype(np.float32)[:, None])
    if same:
        r, c = r[r < c], c[r < c]
    bound = ea[r] + eb[c] * (1 + ea[r]) + ROUNDING
    about = near[r, c].astype(np.float64)
    linked = about - bound >= threshold
    open_ = np.flatnonzero(~linked & (about + bound >= threshold))
    for first in range(0, len(open_), 1 << 16):
        some = open_[first : first + (1 << 16)]
        linked[some] = np.einsum("ij,ij->i", u[r[some]], v[c[some]]) >= threshold
    return r[linked], c[linked]


def _compared(threshold: float):
    """Links of two blocks, or inside one: per class their number and a class of the same component."""

    def compare(table: pa.Table) -> pa.Table:
        # Rows of the first block come first, in an order that does not depend on the shuffle.
        table = table.sort_by([("side", "ascending"), ("class_id", "ascending")])
        ids, copies = table.column("class_id").to_numpy(), table.column("copies").to_numpy()
        first = int((table.column("side").to_numpy() == 0).sum())
        unit = unit_rows(table.column("raw").to_pylist())
        parts = unit, *quantised(unit)
        tiles = lambda a, z: [(x, tuple(p[x : min(x + TILE, z)] for p in parts)) for x in range(a, z, TILE)]
        left = tiles(0, first)
        inner = first == len(ids)
        links, a, b = np.zeros(len(ids), np.int64), [], []
        for x, tile in left:
            for y, other in left if inner else tiles(first, len(ids)):
                if inner and y < x:
                    continue
                r, c = tile_links(tile, other, threshold, inner and x == y)
                r, c = r + x, c + y
                links += np.bincount(r, copies[c], len(ids)).astype(np.int64) + np.bincount(c, copies[r], len(ids)).astype(np.int64)
                if len(r):  # one link per row is enough from here on
                    rows, where = np.unique(np.concatenate([r, c]), return_inverse=True)
                    a.append(rows)
                    b.append(rows[labels(len(rows), where[: len(r)], where[len(r) :])])
        label = labels(len(ids), np.concatenate([*a, np.zeros(0, int)]).astype(int), np.concatenate([*b, np.zeros(0, int)]).astype(int))
        with_links = links > 0
        found = {"class_id": ids[with_links], "links": links[with_links], "root": ids[label[with_links]]}
        return pa.table({k: pa.array(x, pa.int64()) for k, x in found.items()})

    return compare


def _pairs(blocks, threshold: float) -> tuple[list[int], list[int]]:
    """Blocks that may hold a link, by centres and radii."""
    reach = float(np.arccos(threshold)) + 1e-6
    i, j = [], []
    for dim in sorted({b["dim"] for b in blocks}):
        own = sorted((b for b in blocks if b["dim"] == dim), key=lambda b: b["block"])
        centres = np.stack([np.frombuffer(b["centre"], np.float64) for b in own])
        radii, names = np.array([b["radius"] for b in own]), np.array([b["block"] for b in own])
        for k in range(len(own)):
            apart = np.arccos(np.clip(centres[k:] @ centres[k], -1, 1))
            meets = names[k:][(apart <= radii[k:] + radii[k] + reach) | (np.arange(len(own) - k) == 0)]
            i += [int(names[k])] * len(meets)
            j += meets.tolist()
    return i, j


def near_duplicates(
    vectors: DataFrame, threshold: float = THRESHOLD, block_rows: int = BLOCK_ROWS, pivots: int = PIVOTS
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept. ``threshold`` is the least cosine of a link."""
    spark = vectors.sparkSession
    prepared = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(_prepared, PREPARED)
    prepared = materialize(prepared, "vectors")
    classes = prepared.where("key IS NOT NULL").groupBy("key", "dim", "raw")
    classes = classes.agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    classes = materialize(classes.withColumn("class_id", F.monotonically_increasing_id()), "classes")

    rows = classes.count()
    block_rows = max(block_rows, -(-rows // MAX_BLOCKS))
    drawn = classes.orderBy(F.xxhash64("key"), "key").select("dim", "raw").limit(min(pivots, -(-rows // block_rows) or 1)).collect()
    chosen = {d: unit_rows([bytes(r["raw"]) for r in drawn if r["dim"] == d]) for d in {r["dim"] for r in drawn}}
    celled = classes.select("class_id", "copies", "dim", "raw").mapInArrow(
        _celled(chosen), "class_id bigint, copies bigint, dim int, raw binary, cell int"
    )
    celled = materialize(celled, "cells")
    # One row per pivot and length of vectors.
    sizes = sorted(tuple(r) for r in celled.groupBy("dim", "cell").count().collect())
    cut, blocks = [], 0
    for dim, cell, size in sizes:
        cut.append((dim, cell, blocks, -(-size // block_rows)))
        blocks += cut[-1][-1]
    cut = spark.createDataFrame(cut, "dim int, cell int, first bigint, parts bigint")
    dealt = celled.join(F.broadcast(cut), ["dim", "cell"])
    dealt = dealt.withColumn("block", F.col("first") + F.pmod(F.xxhash64("class_id"), "parts")).drop("cell", "first", "parts")
    centres = dealt.groupBy("block").applyInArrow(_centre, "block bigint, dim int, centre binary, radius double").collect()
    i, j = _pairs(centres, threshold)
    pairs = spark.createDataFrame(pa.table({"i": pa.array(i, pa.int64()), "j": pa.array(j, pa.int64())}))
    sent = dealt.join(pairs.withColumn("block", F.col("i")), "block").withColumn("side", F.lit(0))
    other = dealt.join(pairs.where("i <> j").withColumn("block", F.col("j")), "block").withColumn("side", F.lit(1))
    sent = sent.unionByName(other).select("i", "j", "side", "class_id", "copies", "raw")
    found = materialize(sent.groupBy("i", "j").applyInArrow(_compared(threshold), "class_id bigint, links bigint, root bigint"), "tile-links")

    links = found.groupBy("class_id").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("class_id").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "class_id")
    known = classes.select("key", "class_id", "copies", "least").join(links, "class_id", "left").join(joined, "class_id", "left")
    known = known.withColumn("component", F.coalesce("component", "class_id"))
    least = known.groupBy("component").agg(F.min("least").alias("component_id"))
    known = known.join(least, "component").select(
        "key", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
    )
    known = materialize(known, "vector-classes")
    component_id = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return prepared.select("vec_id", "key").join(known, "key", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component_id.alias("component_id"),
        F.col("vec_id").eqNullSafe(component_id).alias("kept"),
    )
