"""N-gram Jaccard join by signature trees: documents linked by similar sets of word shingles.

Equal sets are one class, found by grouping. To give trees to tasks, token space is cut
into more slices than two similar sets may differ in tokens; some slice then holds the
same tokens in both (pigeonhole; where slices are small, two of a group of three), and
classes that share it, directly or by others, are brought together. How many slices follows
from the range of sizes, so each set is cut for its own range and the next one. A class is
brought together with others once for each of the two cuts, so that groups do not grow
together over all sizes. A set sends no slice of fewer tokens than it has to: what a single
common shingle links by chance would grow into one group of most classes.

A task builds a tree over the classes it got: every node holds the OR of the token bitmaps
below it, the range of their set sizes, and the largest number of tokens that share a bit
with another one. Two trees, or a tree and itself, are walked down together. A pair of
nodes is left out when its sizes cannot be similar or when the overlap can be at most
bits in common + tokens that share bits, and that is too little. Pairs of classes that
are left, and not connected yet, are compared exactly. Groups of classes too large for a
task are cut by size and hash into blocks, and each pair of blocks of similar size is
walked by a task of its own.

Nulls: a null text, or one without words, has an empty set and links with nothing; a null
doc_id names a component only if it holds no other id. Each row is a document, also
where an id repeats. Fewer words than a shingle form one shingle. An empty table has no
rows. Other columns are ignored. Texts are hashed whole; a long one only makes a larger set.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import exp, floor, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmend.llm.components import components, stars
from rowmend.llm.rows import release, repeated, row_key, small, text_hash, without, worker_cache
from rowmend.sources.storage import materialize

SHINGLE_WORDS = 3
PERCENT = 90
CACHED_WORDS = 100_000  # words whose hash a task keeps
PACKED = 1 << 18  # slices a task gathers before it sends them; a few copies of 16 bytes each
BUCKET = 1 << 19  # slices a task compares
LOWER = 16  # nodes of a lower range that a task sends one by one for a signature
BLOCK_TOKENS = 1 << 20  # tokens of the classes in one tree
BROADCAST_WALKS = 1_000_000  # places of candidate classes, 20 bytes each, that go to all executors to fetch their texts; more are shuffled
LEAF, FANOUT, CHUNK = 8, 8, 16_384
MARKED = 256  # sets whose tokens are put into bitmaps at once

_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Hasher:
    """Sets of 64-bit hashes of word shingles; a word's hash is kept in a cache of bounded size."""

    def __init__(self, size: int) -> None:
        worker_cache("jaccard")  # nothing is kept between tasks, and nothing of other operators either
        self.size = size
        self.known: dict[bytes, int] = {}

    def tokens(self, text: str | None) -> np.ndarray:
        """Sorted hashes of the distinct shingles. A-Z count as a-z; words are cut at ASCII white space."""
        words = (text or "").encode().lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        missing = set(words).difference(self.known)
        if len(self.known) + len(missing) > CACHED_WORDS:
            self.known.clear()
            missing = set(words)
        self.known.update((w, xxhash.xxh3_64_intdigest(w)) for w in missing)
        hashes = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        size = min(self.size, len(words))
        places = len(words) - size + 1
        # Runs of different lengths start differently.
        total = np.full(places, size * _ODD[-1] % 2**64, np.uint64)
        for k in range(size):
            total = mixed(total * np.uint64(_ODD[0])) + hashes[k : k + places] * np.uint64(_ODD[1 + k % 4])
        return np.unique(mixed(total))

    def rest(self) -> None:
        """At the end of a task: a worker that waits holds nothing."""
        self.known = {}
        release()


@dataclass(frozen=True)
class Slices:
    """How sets are cut into slices for a least similarity of ``percent`` per cent.

    Sizes of similar sets are at most a factor 100 / percent apart, so they lie in the
    same size range or in neighbouring ones; cut number t is shared by ranges t - 1 and t.
    """

    percent: int

    @property
    def step(self) -> float:
        return log(100 / self.percent) * (1 + 1e-9)

    def range_of(self, size: int) -> int:
        return floor(log(size) / self.step)

    def largest(self, cut: int) -> int:
        return floor(exp((cut + 1) * self.step)) + 1

    def difference(self, cut: int) -> int:
        """Most tokens that two similar sets of this cut have not in common."""
        return 2 * self.largest(cut) * (100 - self.percent) // (100 + self.percent)

    @property
    def paired(self) -> bool:
        """Whether a slice, of as many tokens as sets hold per differing one, would be too small to tell sets apart."""
        return 100 / (100 - self.percent) < 8

    def count(self, cut: int) -> int:
        """More slices than that: some may hold no token, and those tell nothing.

        Paired, slices come in groups of three, and there are more groups than differing tokens
        could spoil by two each: in some group two slices are the same.
        """
        d = self.difference(cut)
        return 3 * (d // 2 + 2 + d // 25) if self.paired else d + 2 + d * (100 - self.percent) ** 2 // 2000

    def by_cut(self, tokens: np.ndarray) -> list[np.ndarray]:
        """Hashes of the set's slices, or pairs of slices, each with the number of the cut and its place.

        First those of the cut in whose upper range the set lies, then those of the next cut, where it lies in
        the lower one. More slices, or groups of three, than differing tokens can spoil hold ``least`` tokens or
        more, whichever two of a group are the same; what holds fewer is left out. A similar set has
        a least number of its own. One of the slices that count for the set with the higher one is the same in
        both, and both send it.
        """
        size = len(tokens)
        own = size * (100 - self.percent) // self.percent
        if own == 0:  # only an equal set is similar
            return [np.zeros(0, np.uint64)] * 2
        found = []
        scrambled = mixed(tokens ^ np.uint64(_ODD[5]))
        for cut in (self.range_of(size), self.range_of(size) + 1):
            n, most = self.count(cut), min(own, self.difference(cut))
            slices = (tokens % np.uint64(n)).astype(np.int64)
            sums, held = np.zeros(n, np.uint64), np.bincount(slices, minlength=n)
            np.add.at(sums, slices, scrambled)
            spoiled, sure = most, held
            if self.paired:
                sums, held = sums.reshape(-1, 3), held.reshape(-1, 3)
                spoiled, sure = most // 2, held.sum(axis=1) - held.max(axis=1)
                first, second = [0, 0, 1], [1, 2, 2]
                sums = (mixed(sums[:, first] + np.uint64(_ODD[4])) + mixed(sums[:, second]) * np.uint64(_ODD[1])).ravel()
                held = (held[:, first] + held[:, second]).ravel()
            least = np.partition(sure, len(sure) - 1 - spoiled)[len(sure) - 1 - spoiled]
            place = np.flatnonzero(held >= least)
            found.append(mixed(sums[place] + mixed(place.astype(np.uint64) * np.uint64(_ODD[2]) + np.uint64(cut * _ODD[3] % 2**64))))
        return found

    def signatures(self, tokens: np.ndarray) -> np.ndarray:
        return np.concatenate(self.by_cut(tokens))


SETS = "doc_id bigint, text_hash bigint, n bigint, class binary, node bigint"


def _node(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def _by_cut(node):
    """A class's node in the cut where it lies in the upper range, an even number, and in the next cut, an odd one."""
    return (node & -2, node | 1) if isinstance(node, int) else (node.bitwiseAND(F.lit(-2)), node.bitwiseOR(F.lit(1)))


def _classed(size: int):
    """Size of each document's set and a digest of it: 16 bytes, of which 8 number the candidates."""

    def classed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(size)
        for part in small(parts):
            sets = [hasher.tokens(t) for t in part.column("text").to_pylist()]
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            columns = [
                part.column("doc_id"),
                part.column("text_hash"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(digests, pa.binary()),
                pa.array([None if d is None else _node(d) for d in digests], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "n", "class", "node"])
        hasher.rest()

    return classed


def _runs(signatures: np.ndarray, nodes: np.ndarray, most: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links of the nodes of a signature to its first one, and the signatures, each with the nodes that later ones may link with.

    Two sets of one range meet in the cut where they lie in the upper one; so nodes of a lower range (odd
    numbers) need no links among each other, and are kept until one of the upper range comes. More than
    ``most`` of them are linked all the same, so that a common signature stays small.
    """
    order = np.lexsort((nodes, nodes & 1, signatures))
    signatures, nodes = signatures[order], nodes[order]
    if not len(nodes):
        return signatures, nodes, nodes, nodes
    starts = np.concatenate([[True], signatures[1:] != signatures[:-1]])
    fresh = starts | np.concatenate([[True], nodes[1:] != nodes[:-1]])
    run, begins = np.cumsum(starts) - 1, np.flatnonzero(starts)
    first = nodes[begins]
    joined = first & 1 == 0
    if most is not None:
        joined = joined | (np.add.reduceat(fresh.astype(np.int64), begins) > most)
    first, joined = first[run], joined[run]
    other = joined & (nodes != first)
    a, b = stars(nodes[other], first[other])
    kept = starts | (fresh & ~joined)
    return signatures[kept], nodes[kept], a, b


def _sliced(size: int, cuts: Slices, buckets: int):
    """Packed (signature, node) arrays by bucket; what a task can already link it sends as links instead."""

    def packed(signatures: np.ndarray, nodes: np.ndarray) -> pa.RecordBatch:
        signatures, nodes, a, b = _runs(signatures, nodes, LOWER)
        rows = []
        for kind, keys, values in ((0, signatures, nodes), (1, a.view(np.uint64), b)):
            bucket = ((keys >> np.uint64(24)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            present, firsts = np.unique(bucket[order], return_index=True)
            for at, first, last in zip(present.tolist(), firsts, [*firsts[1:], len(keys)]):
                chosen = order[first:last]
                rows.append((at, kind, keys[chosen].tobytes(), values[chosen].tobytes()))
        columns = list(zip(*rows)) if rows else [(), (), (), ()]
        kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["bucket", "kind", "keys", "nodes"])

    def sliced(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        signatures: list[np.ndarray] = []
        nodes: list[np.ndarray] = []
        held = 0
        hasher = Hasher(size)
        for part in small(parts):
            for text in part.column("text").to_pylist():
                tokens = hasher.tokens(text)
                if not len(tokens):
                    continue
                node = _node(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest())
                if node in seen:  # copies met by the same task are sent once
                    continue
                if len(seen) >= CACHED_WORDS:
                    seen.clear()
                seen.add(node)
                for own, at in zip(cuts.by_cut(tokens), _by_cut(node)):
                    signatures.append(own)
                    nodes.append(np.full(len(own), at, np.int64))
                    held += len(own)
                if held >= PACKED:
                    yield packed(np.concatenate(signatures), np.concatenate(nodes))
                    signatures, nodes, held = [], [], 0
        if held:
            yield packed(np.concatenate(signatures), np.concatenate(nodes))
        hasher.rest()

    return sliced


def _linked(table: pa.Table) -> pa.Table:
    """Links of the nodes that share a signature of this bucket."""
    worker_cache("jaccard")
    joined = lambda column, kind, dtype: np.frombuffer(
        b"".join(x for x, k in zip(table.column(column).to_pylist(), table.column("kind").to_pylist()) if k == kind), dtype
    )
    _, _, a, b = _runs(joined("keys", 0, np.uint64), joined("nodes", 0, np.int64))
    a, b = stars(np.concatenate([a, joined("keys", 1, np.int64)]), np.concatenate([b, joined("nodes", 1, np.int64)]))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


class Level:
    """Nodes of one level: bitmaps, ranges of set sizes, and the most tokens that share a bit with another one."""

    def __init__(self, bits: np.ndarray, least: np.ndarray, most: np.ndarray, extra: np.ndarray) -> None:
        self.bits, self.least, self.most, self.extra = bits, least, most, extra

    def above(self, width: int) -> Level:
        firsts = np.arange(0, len(self.least), width)
        return Level(
            np.bitwise_or.reduceat(self.bits, firsts),
            np.minimum.reduceat(self.least, firsts),
            np.maximum.reduceat(self.most, firsts),
            np.maximum.reduceat(self.extra, firsts),
        )


def tree(sets: list[np.ndarray], bits: int) -> list[Level]:
    """Levels from the sets themselves up to few nodes."""
    words = np.zeros((len(sets), bits // 64), np.uint64)
    sizes = np.array([len(s) for s in sets], np.int64)
    for first in range(0, len(sets), MARKED):  # a place, an owner and a bit of each token, for few sets at a time
        some = slice(first, first + MARKED)
        owner = np.repeat(np.arange(len(sets))[some], sizes[some])
        places = np.concatenate(sets[some]) % np.uint64(bits)
        np.bitwise_or.at(words, (owner, (places >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (places & np.uint64(63)))
    levels = [Level(words, sizes, sizes, sizes - np.bitwise_count(words).sum(axis=1, dtype=np.int64))]
    while len(levels[-1].least) > FANOUT:
        levels.append(levels[-1].above(LEAF if len(levels) == 1 else FANOUT))
    return levels


def needed(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Least overlap of similar sets of these sizes."""
    return -(-(a + b) * percent // (100 + percent))


class Walk:
    """Walks two trees down together and joins similar sets in ``label``."""

    def __init__(self, left: list[Level], right: list[Level], offset: int, sets: list[np.ndarray], percent: int) -> None:
        self.left, self.right, self.offset, self.sets, self.percent = left, right, offset, sets, percent
        self.label = np.arange(len(sets))

    def possible(self, a: Level, b: Level, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Pairs of nodes that may hold a similar pair."""
        p = self.percent
        similar = (a.most[i] * 100 >= b.least[j] * p) & (b.most[j] * 100 >= a.least[i] * p)
        common = np.bitwise_count(a.bits[i] & b.bits[j]).sum(axis=1, dtype=np.int64)
        overlap = common + np.minimum(a.extra[i], b.extra[j])
        return similar & (overlap >= needed(a.least[i], b.least[j], p))

    def run(self) -> np.ndarray:
        # Trees of different heights meet at the level of the lower one.
        top = min(len(self.left), len(self.right)) - 1
        i, j = np.meshgrid(np.arange(len(self.left[top].least)), np.arange(len(self.right[top].least)), indexing="ij")
        self.down(top, i.ravel(), j.ravel())
        return self.label

    def down(self, level: int, i: np.ndarray, j: np.ndarray) -> None:
        a, b = self.left[level], self.right[level]
        if self.left is self.right:
            i, j = i[i <= j], j[i <= j]
        for first in range(0, len(i), CHUNK):
            x, y = i[first : first + CHUNK], j[first : first + CHUNK]
            if level == 0:
                apart = self.label[x] != self.label[y + self.offset]
                x, y = x[apart], y[apart]
            keep = self.possible(a, b, x, y)
            x, y = x[keep], y[keep]
            if level == 0:
                self.compare(x, y + self.offset)
            elif len(x):
                width = LEAF if level == 1 else FANOUT
                step = np.arange(width)
                below = (x[:, None, None] * width + step[None, :, None]) + 0 * step[None, None, :]
                beside = (y[:, None, None] * width + step[None, None, :]) + 0 * step[None, :, None]
                below, beside = below.ravel(), beside.ravel()
                real = (below < len(self.left[level - 1].least)) & (beside < len(self.right[level - 1].least))
                self.down(level - 1, below[real], beside[real])

    def compare(self, x: np.ndarray, y: np.ndarray) -> None:
        """Exact comparison; pairs that others have connected meanwhile are skipped."""
        while len(x):
            for k, l in zip(x[:64].tolist(), y[:64].tolist()):
                if self.label[k] == self.label[l]:
                    continue
                s, t = self.sets[k], self.sets[l]
                at = np.minimum(np.searchsorted(t, s), len(t) - 1)
                common = int((t[at] == s).sum())
                if common * 100 >= self.percent * (len(s) + len(t) - common):
                    low, high = sorted((self.label[k], self.label[l]))
                    self.label[self.label == high] = low
            x, y = x[64:], y[64:]
            apart = self.label[x] != self.label[y]
            x, y = x[apart], y[apart]


def _walked(percent: int):
    """Links of the similar classes of one block, or of two, as one link per class into its component."""

    def walk(table: pa.Table) -> pa.Table:
        worker_cache("jaccard")
        # Places are sorted, not the sets: those are copied once, when they are taken.
        by = ["side", "component", "n", "member"]
        order = pc.sort_indices(table.select(by), [(name, "ascending") for name in by]).to_numpy()
        members, sides = table.column("member").to_numpy()[order], table.column("side").to_numpy()[order]
        # A text that occurs in several rows of one id was fetched several times.
        chosen = np.sort(np.unique(np.stack([sides.astype(np.int64), members]), axis=1, return_index=True)[1])
        members, first = members[chosen], int((sides[chosen] == 0).sum())
        taken = table.column("tokens").take(pa.array(order[chosen])).combine_chunks()
        del table
        # Sets as views of one buffer, not as copies.
        taken = taken if isinstance(taken, pa.Array) else pa.concat_arrays(taken.chunks)
        wide = pa.types.is_large_binary(taken.type)
        ends = np.frombuffer(taken.buffers()[1], np.int64 if wide else np.int32)[taken.offset : taken.offset + len(taken) + 1]
        whole = np.frombuffer(taken.buffers()[2], np.uint8)
        sets = [whole[a:b].view(np.uint64) for a, b in zip(ends.tolist(), ends[1:].tolist())]
        bits = 1 << int(np.clip(np.ceil(np.log2(4 * max(np.median([len(s) for s in sets]), 1))), 9, 16))
        left = tree(sets[:first], bits)
        both = first < len(sets)
        label = Walk(left, tree(sets[first:], bits) if both else left, first if both else 0, sets, percent).run()
        other = label != np.arange(len(label))
        return pa.table({"a": pa.array(members[other], pa.int64()), "b": pa.array(members[label[other]], pa.int64())})

    return walk


def _tokens(size: int):
    def tokens(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(size)
        for part in small(parts):
            sets = [hasher.tokens(t).tobytes() for t in part.column("text").to_pylist()]
            names = [n for n in part.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*[part.column(n) for n in names], pa.array(sets, pa.binary())], [*names, "tokens"])
        hasher.rest()

    return tokens


def _placed(members: DataFrame, block_tokens: int) -> DataFrame:
    """Adds to each member the pairs of blocks it takes part in, as array<struct<i, j, side>>.

    Components of up to a block's tokens share blocks with others by hash. Larger ones get
    blocks of their own, cut by size range and hash; blocks of ranges next to each other meet.
    """
    totals = members.groupBy("component").agg(F.sum("n").alias("total"))
    small = totals.where(F.col("total") <= block_tokens)
    shared = small.agg(F.ceil(F.coalesce(F.sum("total"), F.lit(0)) / block_tokens)).first()[0] or 1
    placed = members.join(totals, "component")
    own = F.col("total") > block_tokens
    ranged = materialize(
        placed.select(
            *members.columns,
            F.when(own, F.col("component")).otherwise(F.pmod(F.xxhash64("component"), F.lit(int(shared)))).alias("group"),
            own.alias("own"),
            F.when(own, F.col("size_range")).otherwise(0).alias("range"),
        ),
        "members",
    )
    cells = ranged.groupBy("own", "group", "range").agg(F.sum("n").alias("total"))
    parts = F.when(F.col("own"), F.ceil(F.col("total") / block_tokens)).otherwise(F.lit(1))
    cells = materialize(cells.select("own", "group", "range", parts.alias("parts")), "cells")
    blocks = cells.select("own", "group", "range", F.explode(F.expr("sequence(0L, parts - 1L)")).alias("part"))
    blocks = materialize(blocks.withColumn("block", F.monotonically_increasing_id()), "blocks")
    one = blocks.select("own", "group", "range", F.col("part").alias("p"), F.col("block").alias("i"))
    near = one.withColumn("range", F.explode(F.when(F.col("own"), F.array("range", F.col("range") + 1)).otherwise(F.array("range"))))
    two = blocks.select("own", "group", "range", F.col("block").alias("j"))
    same = one.select("i", F.col("range").alias("range_i"))
    pairs = near.join(two, ["own", "group", "range"]).join(same, "i").where("range > range_i OR i <= j").select("i", "j")
    pairs = materialize(pairs.distinct(), "block-pairs")
    roles = pairs.select(F.col("i").alias("block"), "i", "j", F.lit(0).alias("side")).union(
        pairs.where("i <> j").select(F.col("j").alias("block"), "i", "j", F.lit(1).alias("side"))
    )
    roles = roles.groupBy("block").agg(F.collect_list(F.struct("i", "j", "side")).alias("walks"))
    part = F.pmod(F.xxhash64("member"), F.col("parts"))
    named = ranged.join(cells, ["own", "group", "range"]).withColumn("part", part)
    named = named.join(blocks, ["own", "group", "range", "part"]).join(roles, "block")
    return materialize(named.select(*members.columns, "walks"), "placed")


def _walks(placed: DataFrame) -> DataFrame:
    """One row per member with the walks of both its cuts; blocks where both bring it to are walked once."""
    of = ["member", "n", "doc_id", "text_hash"]
    each = placed.select(*of, "component", F.explode("walks").alias("w")).select(*of, "component", "w.i", "w.j", "w.side")
    each = each.groupBy(*of, "i", "j", "side").agg(F.min("component").alias("component"))
    return materialize(each.groupBy(*of).agg(F.collect_list(F.struct("i", "j", "side", "component")).alias("walks")), "walks")


def _classified(docs: DataFrame, shingle_words: int, percent: int, block_tokens: int, bucket: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, text_hash, n, class), and of each class the component_id and the first row of its component."""
    cuts = Slices(percent)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_hash())
    sets = materialize(texts.mapInArrow(_classed(shingle_words), SETS), "sets")

    # Candidates: classes that share a slice. About one slice per differing token, for two ranges of sizes.
    tokens = sets.agg(F.sum("n")).first()[0] or 0
    buckets = int(tokens * (5 if cuts.paired else 3) * (100 - percent) / percent // bucket) + 1
    sliced = texts.select("text").mapInArrow(_sliced(shingle_words, cuts, buckets), "bucket int, kind int, keys binary, nodes binary")
    edges = sliced.groupBy("bucket").applyInArrow(_linked, "a bigint, b bigint")
    candidates = components(edges)

    classes = sets.where("n > 0").groupBy("class", "node", "n").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("first"))
    classes = classes.select("class", "node", "n", F.col("first.doc_id").alias("doc_id"), F.col("first.text_hash").alias("text_hash"))
    classes = materialize(classes.withColumn("member", F.monotonically_increasing_id()), "classes")
    noded = classes.withColumn("node", F.explode(F.array(*_by_cut(F.col("node")))))
    members = noded.join(candidates, "node").select("member", "n", "component", "doc_id", "text_hash").distinct()
    size_range = F.floor(F.log(F.col("n")) / F.lit(cuts.step)).cast("long")
    members = materialize(members.withColumn("size_range", size_range), "candidates")
    several = members.groupBy("component").count().where("count > 1").select("component")
    members = materialize(members.join(several, "component"), "candidates")

    placed = _walks(_placed(members, block_tokens))
    fetched = placed.select(row_key(), "member", "n", "walks")
    if (placed.agg(F.sum(F.size("walks"))).first()[0] or 0) <= BROADCAST_WALKS:
        fetched = F.broadcast(fetched)
    found = texts.select("text", row_key()).join(fetched, "key").drop("key")
    found = found.mapInArrow(
        _tokens(shingle_words),
        "member bigint, n bigint, walks array<struct<i:bigint,j:bigint,side:int,component:bigint>>, tokens binary",
    )
    found = found.select("member", "n", F.explode("walks").alias("w"), "tokens")
    found = found.select("member", "n", "w.component", "w.i", "w.j", "w.side", "tokens")
    links = found.groupBy("i", "j").applyInArrow(_walked(percent), "a bigint, b bigint")
    joined = components(links).withColumnRenamed("node", "member")

    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    known = classes.select("class", "member", first.alias("first")).join(joined, "member", "left")
    known = known.withColumn("component", F.coalesce("component", "member"))
    least = known.groupBy("component").agg(F.min("first").alias("first"))
    known = known.select("class", "component").join(least, "component").select("class", "first")
    return sets, materialize(known, "class-components")


def jaccard_components(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT, block_tokens: int = BLOCK_TOKENS, bucket: int = BUCKET
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Documents link when 100 * |intersection| >= ``percent`` * |union|; component_id is the smallest doc_id reachable by links.
    """
    sets, known = _classified(docs, shingle_words, percent, block_tokens, bucket)
    component_id = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id"))
    return sets.join(known, "class", "left").select("doc_id", F.col("n").alias("n_shingles"), component_id.alias("component_id"))


def one_per_component(docs: DataFrame, shingle_words: int, percent: int, block_tokens: int = BLOCK_TOKENS, bucket: int = BUCKET) -> DataFrame:
    """The documents without those linked, directly or by others, to one of a smaller id. Documents without words all stay."""
    sets, known = _classified(docs, shingle_words, percent, block_tokens, bucket)
    rows = sets.where("class IS NOT NULL").join(known, "class").withColumn("key", row_key())
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    kept = without(docs, rows.where(~stays).select("key").distinct())
    # Equal rows of one id: all of them would stay.
    twins = rows.where(stays).groupBy("key").count().where("count > 1").select("key")
    if twins.isEmpty():
        return kept
    return without(kept, twins).unionByName(repeated(kept, twins.withColumn("copies", F.lit(1))))
