"""Phrase collocation mining by HAT-trie counting.

Texts are cut into pieces at sentence marks and into words at blanks. Each task counts the
runs of three words (fewer at the end of a piece) that begin at each word in a trie over the
task's word ids. Its two levels, first and second word, end in hash containers, one for a
range of prefixes; a container that grows large bursts at a prefix. Phrases of two words need
no entry: they are the sums of their subtrees. Single words are counted by id beside.

A task that holds too much spills its largest containers whole, as sorted runs: the words in
order and packed keys with their counts. A run's rows go to the partitions of their prefixes of
two words, where all runs are merged in order as they arrive; so a phrase of two or three words
is counted in one place, and a frequent one has been added up before it travels. Only phrases with at least ``least`` places leave
the partitions: a candidate's parts are at least as frequent as the candidate itself.

Scores are exact integers in decimal(38): counts below 10^15 are assumed.

Nulls: a null text is empty, a null lang is ``und``. A text without words adds nothing, an
empty table gives no rows. Repeated rows count each time; very long texts are counted whole.
Ties in score and count are ordered by the phrase's bytes. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowmend.llm.rows import small
from rowmend.sources.storage import materialize

LEAST = 10
TOP = 2000
BURST = 4096  # entries of a container before it becomes a node
MOST_ENTRIES = 700_000  # of a task's tries; about 80 MB
WORD_BITS = 21
MOST_WORDS = 400_000  # of a task's vocabulary, after a slice of text; never 2 to the power of WORD_BITS
MOST_PLACES = 4_000_000  # counters of single words, over all langs
SLICE_BYTES = 2 << 20  # of text counted at once
ROWS_AT_ONCE = 2000  # documents in hand
PARTITION_CHARS = 8 << 20  # of text counted in one prefix partition
MERGED = 1 << 20  # entries of runs gathered before they are merged

# What ends a piece becomes a line break, a tab becomes a blank, A-Z become a-z; the rest stays.
_TABLE = bytes.maketrans(b".,;:!?\x0b\x0c\r\tABCDEFGHIJKLMNOPQRSTUVWXYZ", b"\n" * 9 + b" abcdefghijklmnopqrstuvwxyz")
_MASK = (1 << WORD_BITS) - 1
_END = 0  # id of the end of a piece


class Trie:
    """Counts of runs of three word ids, packed as first, second, third.

    A container holds the keys of a range of prefixes, at first of all. Full, it bursts: at the
    first word nearest to its middle or, where all its keys begin with one word, at a second
    word. So frequent words get containers of their own, and rare ones share theirs.
    """

    def __init__(self) -> None:
        self.bounds = np.zeros(1, np.int64)  # the least key of each container
        self.below: list[dict[int, int]] = [{}]
        self.full: list[int] = [BURST]  # entries at which it bursts
        self.entries = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Keys in ascending order, each once."""
        cuts = [0, *np.searchsorted(keys, self.bounds[1:]).tolist(), len(keys)]
        listed, numbers, large = keys.tolist(), counts.tolist(), []
        for at, (container, first, last) in enumerate(zip(self.below, cuts, cuts[1:])):
            if first == last:
                continue
            get, held = container.get, len(container)
            for key, n in zip(listed[first:last], numbers[first:last]):
                container[key] = get(key, 0) + n
            self.entries += len(container) - held
            if len(container) > self.full[at]:
                large.append(at)
        for at in reversed(large):
            self._burst(at)

    def _burst(self, at: int) -> None:
        container = self.below[at]
        keys, counts = (np.fromiter(x, np.int64, len(container)) for x in (container.keys(), container.values()))
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        open_, done = [(0, len(keys))], []
        while open_:
            first, last = open_.pop()
            cut = _middle(keys[first:last]) if last - first > BURST else None
            if cut is None:
                done.append((first, last))
            else:
                open_ += [(first + cut, last), (first, first + cut)]
        # A bound is the prefix a container begins with, so that later keys of that prefix come to it.
        starts = np.array([keys[first] >> WORD_BITS << WORD_BITS for first, _ in done[1:]], np.int64)
        self.bounds = np.concatenate([self.bounds[: at + 1], starts, self.bounds[at + 1 :]])
        self.below[at : at + 1] = [dict(zip(keys[a:z].tolist(), counts[a:z].tolist())) for a, z in done]
        # One prefix with more third words than that stays as it is.
        self.full[at : at + 1] = [BURST if z - a <= BURST else 2 * (z - a) for a, z in done]

    def take(self, room: int) -> tuple[np.ndarray, np.ndarray]:
        """Empties the largest containers until at most ``room`` entries are left; their keys and counts."""
        keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for at in sorted(range(len(self.below)), key=lambda k: len(self.below[k]), reverse=True):
            container = self.below[at]
            if self.entries <= room:
                break
            keys.append(np.fromiter(container.keys(), np.int64, len(container)))
            counts.append(np.fromiter(container.values(), np.int64, len(container)))
            self.entries -= len(container)
            self.below[at] = {}
        return np.concatenate(keys), np.concatenate(counts)


def _middle(keys: np.ndarray) -> int | None:
    """Where, nearest to the middle of sorted keys, a prefix of one word begins, or else one of two; None if there is one prefix only."""
    for shift in (2 * WORD_BITS, WORD_BITS):
        prefixes = keys >> shift
        starts = np.flatnonzero(prefixes[1:] != prefixes[:-1]) + 1
        if len(starts):
            return int(starts[np.argmin(np.abs(starts - len(keys) // 2))])
    return None


class Words:
    """Ids of a task's words, in order of their first use."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.ids: dict[bytes, int] = {b"\n": _END}
        self.listed: list[bytes] = [b""]

    def of(self, found: list[bytes]) -> np.ndarray:
        fresh = set(found).difference(self.ids)
        self.ids.update(zip(fresh, range(len(self.listed), len(self.listed) + len(fresh))))
        self.listed.extend(fresh)
        return np.fromiter(map(self.ids.__getitem__, found), np.int64, len(found))


def slices(texts: Iterator[bytes]) -> Iterator[list[bytes]]:
    """The texts' words, a line break behind each piece, some at a time; two words more than are to be counted."""
    before: list[bytes] = []
    for text in texts:
        text = text.translate(_TABLE) + b"\n"
        first = 0
        while first < len(text):
            last = text.find(b" ", first + SLICE_BYTES)
            last = len(text) if last < 0 else last
            # A word may hold other white space; words are what stands between blanks.
            before += filter(None, text[first:last].replace(b"\n", b" \n ").split(b" "))
            first = last
            if len(before) * 4 > SLICE_BYTES:
                yield before
                before = before[-2:]
    yield [*before, b"\n", b"\n"]


RUNS = "partition int, lang string, kind int, words binary, keys binary, counts binary"
PHRASES, SINGLES, TOTAL = 3, 1, 0


class Spiller:
    """Runs of what a task takes out of its tries, by partition."""

    def __init__(self, partitions: int) -> None:
        self.partitions = partitions

    def _targets(self, mixed: np.ndarray) -> np.ndarray:
        return ((mixed * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(33)) % np.uint64(self.partitions)).astype(np.int64)

    def runs(self, lang: str, kind: int, words: Words, columns: list[np.ndarray], counts: np.ndarray) -> Iterator[tuple]:
        """A sorted run for each partition that has some of the rows; a row's partition follows from its first two words."""
        if not len(counts):
            return
        known = np.zeros(len(words.listed), bool)
        for c in columns:
            known[c] = True
        used = np.flatnonzero(known)
        listed = [words.listed[i] for i in used.tolist()]
        order = sorted(range(len(listed)), key=listed.__getitem__)
        listed = [listed[i] for i in order]
        rank = np.empty(len(words.listed), np.int64)
        rank[used[order]] = np.arange(len(order))
        # Ranks follow the words' bytes, so keys of ranks are in the order every run has.
        ranks = [rank[c] for c in columns]
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, listed), np.uint64, len(listed))
        mixed = hashes[ranks[0]] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(xxhash.xxh3_64_intdigest(lang))
        target = self._targets(mixed if kind == SINGLES else mixed ^ hashes[ranks[1]])
        in_order = np.lexsort([*ranks[::-1], target])
        ranks, counts, target = [r[in_order] for r in ranks], counts[in_order], target[in_order]
        firsts = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]]))
        for first, last in zip(firsts.tolist(), [*firsts[1:].tolist(), len(target)]):
            known = np.zeros(len(listed), bool)
            own = [r[first:last] for r in ranks]
            for r in own:
                known[r] = True
            place, mine = np.cumsum(known) - 1, np.flatnonzero(known)
            # Words hold no line break.
            blob = b"\n".join([listed[i] for i in mine.tolist()])
            keys = np.concatenate([place[r] for r in own]).astype("<u4").tobytes()
            yield int(target[first]), lang, kind, blob, keys, counts[first:last].astype("<i8").tobytes()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    names = [c.split()[0] for c in RUNS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def _counted(partitions: int):
    """Runs of the phrases of a task's texts."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, tries, spiller = Words(), {}, Spiller(partitions)
        singles: dict[str, np.ndarray] = {}  # places of each word by id

        def spill(room: int) -> Iterator[pa.RecordBatch]:
            """Containers are spilled until ``room`` entries are left in all; with none the vocabulary starts anew."""
            total = sum(t.entries for t in tries.values())
            for lang, trie in tries.items():
                keys, counts = trie.take(room * trie.entries // max(total, 1))
                columns = [keys >> 2 * WORD_BITS, keys >> WORD_BITS & _MASK, keys & _MASK]
                rows = list(spiller.runs(lang, PHRASES, words, columns, counts))
                if not room and lang in singles:
                    used = np.flatnonzero(singles[lang])
                    rows += spiller.runs(lang, SINGLES, words, [used], singles[lang][used])
                for k in range(0, len(rows), 64):
                    yield _batch(rows[k : k + 64])
            if not room:
                tries.clear()
                singles.clear()
                words.clear()

        for part in small(parts, ROWS_AT_ONCE):
            langs, texts = part.column("lang").to_pylist(), part.column("text").to_pylist()
            for lang in dict.fromkeys(langs):
                name = "und" if lang is None else lang
                for found in slices((t or "").encode() for t, own in zip(texts, langs) if own == lang):
                    if len(words.listed) + len(found) >= 1 << WORD_BITS:
                        yield from spill(0)
                    ids = words.of(found)
                    first, second, third = ids[:-2], ids[1:-1], ids[2:]
                    third = np.where(second == _END, _END, third)
                    begins = first != _END
                    keys = (first << 2 * WORD_BITS | second << WORD_BITS | third)[begins]
                    tries.setdefault(name, Trie()).add(*np.unique(keys, return_counts=True))
                    places = np.bincount(first[begins], minlength=len(words.listed))
                    before = singles.get(name, places[:0])
                    places[: len(before)] += before
                    singles[name] = places
                    if len(words.listed) > MOST_WORDS or sum(map(len, singles.values())) > MOST_PLACES:
                        yield from spill(0)
                    elif sum(t.entries for t in tries.values()) > MOST_ENTRIES:
                        yield from spill(MOST_ENTRIES // 2)
        yield from spill(0)

    return count


class Merger:
    """Runs of one partition, language and kind, merged as they arrive: words in byte order, keys and counts."""

    def __init__(self, width: int) -> None:
        self.width = width
        self.words: list[bytes] = []
        self.rows = np.zeros((0, width), np.int64)
        self.counts = np.zeros(0, np.int64)
        self.waiting: list[tuple[list[bytes], np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, words: bytes, keys: bytes, counts: bytes) -> None:
        self.waiting.append((words.split(b"\n"), np.frombuffer(keys, "<u4").reshape(self.width, -1).T, np.frombuffer(counts, "<i8")))
        self.held += len(counts) // 8
        if self.held > max(MERGED, len(self.counts)):
            self.merge()

    def merge(self) -> None:
        runs = [(self.words, self.rows, self.counts), *self.waiting]
        self.waiting, self.held = [], 0
        every = sorted(set().union(*[r[0] for r in runs]))
        place = dict(zip(every, range(len(every))))
        # Numbers follow the order of the words, so each run stays in order.
        rows = np.concatenate([np.fromiter(map(place.__getitem__, w), np.int64, len(w))[k] if len(w) else k.astype(np.int64) for w, k, _ in runs])
        counts = np.concatenate([c for _, _, c in runs])
        order = np.lexsort(rows.T[::-1])
        rows, counts = rows[order], counts[order]
        self.words, self.rows, self.counts = every, *summed(rows, counts)


def summed(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted rows, each once, with the sum of their counts."""
    if not len(rows):
        return rows, counts
    starts = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)]))
    return rows[starts], np.add.reduceat(counts, starts)


COUNTS = "lang string, size int, phrase string, f bigint"


def _frequent(lang: str, kind: int, merger: Merger, least: int) -> Iterator[tuple]:
    """Phrases of a merged partition with enough places; of single words also how many there are."""
    merger.merge()
    text = lambda row: b" ".join(merger.words[i] for i in row).decode()
    if kind == SINGLES:
        yield lang, TOTAL, "", int(merger.counts.sum())
        levels = [(1, merger.rows, merger.counts)]
    else:
        two = summed(merger.rows[:, :2], merger.counts)
        levels = [(2, *two), (3, merger.rows, merger.counts)]
    # The end of a piece counts as the empty word, which comes first in byte order.
    none = 0 if merger.words and merger.words[0] == b"" else -1
    for size, rows, counts in levels:
        good = np.flatnonzero((counts >= least) & (rows[:, size - 1] != none))
        for row, n in zip(rows[good].tolist(), counts[good].tolist()):
            yield lang, size, text(row), n


def _merged(least: int):
    def merge(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by partition, language and kind, so one merger is held at a time."""
        at, merger, rows = None, None, []
        names = [c.split()[0] for c in COUNTS.split(", ")]
        kinds = (pa.string(), pa.int32(), pa.string(), pa.int64())

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for part in small(parts, 64):
            for partition, lang, kind, words, keys, counts in zip(*(part.column(c).to_pylist() for c in range(6))):
                if at != (partition, lang, kind):
                    if at is not None:
                        rows += _frequent(*at[1:], merger, least)
                        if len(rows) > 10_000:
                            yield done()
                            rows = []
                    at, merger = (partition, lang, kind), Merger(kind)
                merger.add(words, keys, counts)
        if at is not None:
            rows += _frequent(*at[1:], merger, least)
        if rows:
            yield done()

    return merge


def phrase_counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """lang, size, phrase, f: phrases of one to three words with ``least`` places or more; size 0 has all words of the lang."""
    texts = docs.select("lang", "text")
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    partitions = max(8, -(-chars // PARTITION_CHARS))
    runs = texts.mapInArrow(_counted(partitions), RUNS)
    sent = runs.repartition(int(partitions), "partition").sortWithinPartitions("partition", "lang", "kind")
    counts = materialize(sent.mapInArrow(_merged(least), COUNTS), "phrases")
    totals = counts.where("size = 0").groupBy("lang").agg(F.sum("f").alias("f"))
    return counts.where("size > 0").unionByName(totals.select("lang", F.lit(TOTAL).alias("size"), F.lit("").alias("phrase"), "f"))


def _score(a, l, r):  # noqa: E741
    wide = lambda c: c.cast("decimal(16,0)")
    return F.expr("CAST(1000000 AS DECIMAL(7,0))") * (wide(a) * wide(a)), wide(l) * wide(r)


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """Each lang's ``top`` phrases by score: lang, rank, phrase, a, l, r, n, score."""
    counts = materialize(phrase_counts(docs, least), "counts")
    known = counts.where("size > 0").select("lang", "phrase", "f")
    parts = F.split("phrase", " ")
    phrases = counts.where("size > 1").select("lang", "size", "phrase", F.col("f").alias("a"), parts.alias("words"))
    cut = F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    cuts = phrases.select("lang", "size", "phrase", "a", "words", cut)
    joined = lambda first, n: F.array_join(F.slice("words", first, n), " ")
    cuts = cuts.select("lang", "size", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("first"), joined(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"))
    for side, name in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(known.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side])
    upper, lower = _score(F.col("a"), F.col("l"), F.col("r"))
    cuts = cuts.withColumn("upper", upper).withColumn("lower", lower).withColumn("score", F.expr("upper div lower"))
    # A phrase's cuts are two at most.
    least_cut = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("lang", "size", "phrase", "a").agg(least_cut)

    words = F.col("words")
    inner = F.transform(F.sequence(F.lit(0), F.col("size") - 2), lambda i: F.array_join(F.slice(words, i + 1, F.col("size") - 1), " "))
    longer = phrases.where("size > 2").select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), F.col("a").alias("longer"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = scored.join(longer, ["lang", "phrase"], "left").where("longer IS NULL OR 100 * longer < 50 * a")

    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    flat = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score", F.pmod(F.xxhash64("phrase"), F.lit(64)).alias("share"))
    # The first of each share of a lang, then the first of those: no task sees all phrases of a lang.
    best = flat.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).where(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    totals = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
