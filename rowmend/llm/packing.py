"""Best-fit packing of documents into sequences of a fixed length, by large-item matching.

Documents are encoded, get an end id, and only those longer than a sequence are cut. Pieces
of equal length are interchangeable, so how to pack is decided on the number of pieces of
each length, a table of at most ``capacity`` rows, whatever the corpus holds:

* pieces above a third of the capacity are large; a sequence holds two of them at most. From
  the longest on, each is matched with the longest other one that still fits beside it;
* the smaller ones, the longest first, go where they leave the smallest gap, and into new
  sequences when no gap is left.

Runs of equal pieces and equal gaps are handled as one, so the result is a list of kinds of
sequences, each with the number of its sequences. Its size, too, is bounded by the capacity
alone: a kind is added when a length or a kind is used up. Each piece then finds its place in
it by its length and its number among the pieces of that length. Those numbers are running
numbers of each written partition plus the counts of earlier partitions.

Nulls: a null text is empty and has only its end id; a null doc_id is kept. Each row is a
document, also where an id or a whole row repeats: all copies are packed. An empty table
gives no sequences. A very long text is encoded whole and cut into pieces. Ties, pieces of
one length, are placed by where their rows lie; that changes neither the number of sequences
nor any column but sequence_id and offset. Other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowmend.llm.rows import sized, small
from rowmend.llm.tokenizing import IdEncoder, loaded
from rowmend.sources.storage import materialize

CAPACITY = 4096
END_ID = 1
MOST_PIECES = 1 << 44  # of one length
ENCODED_AT_ONCE = 4000  # documents whose pieces are looked up together

PIECES = "doc_id bigint, piece int, start bigint, length int, ids binary, part int, nr bigint"
PACKED = "doc_id bigint, piece int, start bigint, length int, ids binary, sequence_id bigint, offset int"


def _pieces(tokenizer: str, capacity: int):
    """Pieces of each document, with the partition and the running number among its pieces of that length."""

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part_id = loaded(IdEncoder, tokenizer), TaskContext.get().partitionId()
        end, dtype = END_ID.to_bytes(encoder.width, "little"), f"<u{encoder.width}"
        seen: dict[int, int] = defaultdict(int)
        for part in small(parts, ENCODED_AT_ONCE):
            rows: list[tuple] = []
            for doc_id, ids in zip(part.column("doc_id").to_pylist(), encoder.encode([t or "" for t in part.column("text").to_pylist()])):
                whole = np.frombuffer(ids + end, dtype).astype("<u4")
                for piece, start in enumerate(range(0, len(whole), capacity)):
                    held = whole[start : start + capacity]
                    rows.append((doc_id, piece, start, len(held), held.tobytes(), part_id, seen[len(held)]))
                    seen[len(held)] += 1
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int64())
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids", "part", "nr"])
        encoder.rest()

    return cut


def match_large(counts: Mapping[int, int], capacity: int) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Kinds of sequences of the pieces above a third of the capacity, as ((length, times), ...) with their number."""
    left = {length: n for length, n in counts.items() if 3 * length > capacity and n}
    lengths = sorted(left)
    kinds = []
    for long in reversed(lengths):
        at = len(lengths)
        while left[long]:
            # The longest partner that fits and is left; a piece may meet its equal.
            at = min(at, bisect_left(lengths, min(long, capacity - long) + 1))
            while at and not left[lengths[at - 1]]:
                at -= 1
            if not at:
                kinds.append((((long, 1),), left[long]))
                left[long] = 0
                continue
            other = lengths[at - 1]
            if other == long:
                pairs, both = left[long] // 2, ((long, 2),)
                if not pairs:
                    at -= 1
                    continue
            else:
                pairs, both = min(left[long], left[other]), ((long, 1), (other, 1))
                left[other] -= pairs
            left[long] -= pairs * (1 + (other == long))
            kinds.append((both, pairs))
    return kinds


def fill_gaps(kinds: list[tuple[tuple[tuple[int, int], ...], int]], counts: Mapping[int, int], capacity: int) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """The kinds after the smaller pieces, longest first, went where they leave the smallest gap."""
    gaps: list[int] = []  # those that some kind leaves, ascending
    by_gap: dict[int, list] = {}

    def put(kind: tuple, times: int) -> None:
        if times:
            gap = capacity - sum(length * n for length, n in kind)
            if gap not in by_gap:
                insort(gaps, gap)
                by_gap[gap] = []
            by_gap[gap].append((kind, times))

    for kind, times in kinds:
        put(kind, times)
    for length in sorted((c for c, n in counts.items() if 3 * c <= capacity and n), reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(gaps, length)
            if at < len(gaps):
                gap = gaps[at]
                kind, times = by_gap[gap].pop()
                if not by_gap[gap]:
                    del by_gap[gap], gaps[at]
            else:
                gap, kind, times = capacity, (), left
            # A piece in the smallest gap makes it smaller still, so the next one goes there too while it fits.
            each = gap // length
            full = min(times, left // each)
            put((*kind, (length, each)), full)
            left -= full * each
            rest = times - full
            if rest and left:
                put((*kind, (length, left)), 1)
                left, rest = 0, rest - 1
            if kind:
                put(kind, rest)
    return [(kind, times) for gap in gaps for kind, times in by_gap[gap]]


class Places:
    """Where the n-th piece of a length goes."""

    def __init__(self, kinds: list[tuple[tuple[tuple[int, int], ...], int]]) -> None:
        rows, used, base = [], defaultdict(int), 0
        for kind, times in kinds:
            offset = 0
            for length, each in kind:
                rows.append((length, used[length], each, base, offset))
                used[length] += each * times
                offset += each * length
            base += times
        self.sequences = base
        rows.sort()
        self.length, self.first, self.each, self.base, self.offset = np.array(rows, np.int64).reshape(-1, 5).T

    def find(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces by their length and their number among those of that length."""
        row = np.searchsorted(self.length * MOST_PIECES + self.first, length * MOST_PIECES + number, "right") - 1
        place = number - self.first[row]
        return self.base[row] + place // self.each[row], self.offset[row] + place % self.each[row] * length


def _placed(shared):
    def place(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = shared.value
        for part in parts:
            number = part.column("before").to_numpy() + part.column("nr").to_numpy()
            sequence, offset = places.find(part.column("length").to_numpy().astype(np.int64), number)
            kept = ["doc_id", "piece", "start", "length", "ids"]
            columns = [*[part.column(c) for c in kept], pa.array(sequence, pa.int64()), pa.array(offset.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "sequence_id", "offset"])

    return place


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids (unsigned 32-bit little-endian), sequence_id, offset."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = materialize(texts.mapInArrow(_pieces(tokenizer, capacity), PIECES), "pieces")
    held = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = materialize(held.select("part", "length", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")), "before")
    # One row per length: bounded by the capacity.
    counts = {r["length"]: r["n"] for r in before.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = Places(fill_gaps(match_large(counts, capacity), counts, capacity))
    shared = docs.sparkSession.sparkContext.broadcast(places)
    numbered = pieces.join(sized(before.select("part", "length", "before")), ["part", "length"])
    return numbered.mapInArrow(_placed(shared), PACKED)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences: sequence_id, n_ids, ids, and where in it each document lies."""
    row = F.struct("offset", "length", "doc_id", "piece", "ids")
    held = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(row)).alias("held"))  # a capacity of ids at most
    joined = F.aggregate("held", F.lit(b"").cast("binary"), lambda a, r: F.concat(a, r["ids"]))
    documents = F.transform("held", lambda r: F.struct(r["doc_id"].alias("doc_id"), r["piece"].alias("piece"), r["offset"].alias("offset"), r["length"].alias("length")))
    total = F.aggregate("held", F.lit(0), lambda a, r: a + r["length"])
    return held.select("sequence_id", total.alias("n_ids"), joined.alias("ids"), documents.alias("documents"))
