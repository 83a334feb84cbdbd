"""Connected components of links between numbered nodes, without gathering them anywhere."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmend.sources.storage import materialize

LOCAL_LINKS = 500_000  # so many links, 8 MB, are joined by a single task; more go through rounds of joins
EDGES = "a bigint, b bigint"


def labels(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0 to size - 1 the smallest node of their component."""
    label = np.arange(size)
    while True:
        x, y = label[a], label[b]
        if (x == y).all():
            return label
        low = np.minimum(x, y)
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        while (label[label] != label).any():
            label = label[label]


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same components by one link from every other node to the smallest one."""
    nodes, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    label = labels(len(nodes), where[: len(a)], where[len(a) :])
    other = label != np.arange(len(nodes))
    return nodes[other], nodes[label[other]]


def _contracted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for part in parts:
        a = np.concatenate([a, part.column(0).to_numpy()])
        b = np.concatenate([b, part.column(1).to_numpy()])
        if len(a) >= LOCAL_LINKS:
            a, b = stars(a, b)
            if len(a) >= LOCAL_LINKS // 2:
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
                a, b = a[:0], b[:0]
    a, b = stars(a, b)
    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def components(links: DataFrame, local_links: int = LOCAL_LINKS) -> DataFrame:
    """(node, component) of every linked node; a component is named by its smallest node.

    ``links`` has bigint columns a and b. Each task first joins what it has. If few links
    are left one task finishes; else large-star and small-star rounds replace links by
    links to the smallest neighbour until nothing changes. Neighbourhoods are only
    aggregated and joined, so a hub is split like any other skewed key.
    """
    # Written before they are joined: Python that makes them in the same task would need a worker beside the joining one,
    # and all that were ever needed at once take turns afterwards, each with memory of its own.
    links = materialize(links.select("a", "b").where("a <> b"), "links")
    links = materialize(links.mapInArrow(_contracted, EDGES), "links")
    if links.count() <= local_links:
        links = materialize(links.repartition(1).mapInArrow(_contracted, EDGES), "links")
    else:
        state = None
        while True:
            both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
            least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
            large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
            large = materialize(large.distinct(), "links")
            # Links lead from a node to a smaller one.
            least = large.groupBy("a").agg(F.min("b").alias("least"))
            small = large.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
            links = materialize(small.union(least.select("a", F.col("least").alias("b"))).distinct(), "links")
            seen = tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
            if seen == state:
                break
            state = seen
    named = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return named.union(links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
