"""Packing: every id of the library's once, in as few sequences as a lower bound allows, and matching against brute force."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rowmend.llm import packing

WORDS = public_tokenizers.path("word_bpe_49k.json")


def laid_out(docs, capacity):
    library = Tokenizer.from_file(WORDS)
    rows = docs.select("doc_id", "text").collect()
    wanted = []
    for doc_id, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, packing.END_ID], "<u4")
        wanted += [(doc_id, k, at, ids[at : at + capacity].tobytes()) for k, at in enumerate(range(0, len(ids), capacity))]
    return wanted


def check(docs, capacity):
    got = packing.pack(docs, WORDS, capacity).collect()
    assert sorted(((r["doc_id"], r["piece"], r["start"], bytes(r["ids"])) for r in got), key=repr) == sorted(laid_out(docs, capacity), key=repr)
    held = {}
    for r in got:
        assert r["length"] * 4 == len(r["ids"])
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in held.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


def test_every_id_once(make, odd, empty):
    rng = random.Random(4)
    texts = [" ".join(rng.choices(["ab", "Wort", "l'été", "12", "x,y", "中"], k=rng.choice([0, 1, 3, 9, 30, 70]))) for _ in range(300)]
    docs = make(texts)
    total = sum(len(ids) // 4 for *_, ids in laid_out(docs, 40))
    assert -(-total // 40) <= check(docs, 40) <= -(-total // 40) * 1.05 + 1
    check(odd, 16)
    check(odd, packing.CAPACITY)
    assert packing.pack(empty, WORDS).count() == 0


def test_sequences_hold_their_documents(make):
    packed = packing.pack(make(["a b c", "d", None, "e f g h i j"]), WORDS, 5)
    for row in packing.sequences(packed).collect():
        assert len(row["ids"]) == 4 * row["n_ids"] <= 20
        assert sum(d["length"] for d in row["documents"]) == row["n_ids"]
        for d in row["documents"]:
            piece = packed.where((packed.doc_id == d["doc_id"]) & (packed.piece == d["piece"])).first()
            assert bytes(row["ids"])[4 * d["offset"] :][: 4 * d["length"]] == bytes(piece["ids"])


def most_pairs(lengths, capacity):
    """Largest number of pairs that fit, by trying all."""
    if len(lengths) < 2:
        return 0
    best = most_pairs(lengths[1:], capacity)
    for k in range(1, len(lengths)):
        if lengths[0] + lengths[k] <= capacity:
            best = max(best, 1 + most_pairs(lengths[1:k] + lengths[k + 1 :], capacity))
    return best


def test_greedy_matching_makes_the_most_pairs():
    rng = random.Random(9)
    for _ in range(300):
        capacity = rng.randint(9, 30)
        lengths = [rng.randint(capacity // 3 + 1, capacity) for _ in range(rng.randint(0, 7))]
        counts = {c: lengths.count(c) for c in lengths}
        kinds = packing.match_large(counts, capacity)
        assert sorted(c for kind, n in kinds for c, k in kind for _ in range(n * k)) == sorted(lengths)
        assert all(sum(c * k for c, k in kind) <= capacity and sum(k for _, k in kind) <= 2 for kind, _ in kinds)
        assert sum(n for kind, n in kinds if sum(k for _, k in kind) == 2) == most_pairs(lengths, capacity)


def best_fit(kinds, small, capacity):
    """One piece after the other, each into the bin it leaves the smallest gap in."""
    gaps = [capacity - sum(c * k for c, k in kind) for kind, n in kinds for _ in range(n)]
    for piece in sorted(small, reverse=True):
        fits = [g for g in gaps if g >= piece]
        gap = min(fits) if fits else capacity
        if fits:
            gaps.remove(gap)
        gaps.append(gap - piece)
    return sorted(gaps)


@pytest.mark.parametrize("seed", range(8))
def test_runs_are_filled_as_single_pieces_would_be(seed):
    rng = random.Random(seed)
    for _ in range(40):
        capacity = rng.randint(6, 60)
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 60))]
        counts = {c: lengths.count(c) for c in lengths}
        large = packing.match_large(counts, capacity)
        kinds = packing.fill_gaps(large, counts, capacity)
        small = [c for c in lengths if 3 * c <= capacity]
        assert sorted(capacity - sum(c * k for c, k in kind) for kind, n in kinds for _ in range(n)) == best_fit(large, small, capacity)
        places = packing.Places(kinds)
        assert places.sequences == sum(n for _, n in kinds)
        if lengths:
            number = [lengths[:k].count(c) for k, c in enumerate(lengths)]
            sequence, offset = places.find(np.array(lengths, np.int64), np.array(number, np.int64))
            spans = sorted(zip(sequence.tolist(), offset.tolist(), lengths))
            assert all(a[0] != b[0] or a[1] + a[2] == b[1] for a, b in zip(spans, spans[1:]))


def test_query_digests(spark):
    from rowmend.llm import queries

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    wanted = [(d, p, s, len(i) // 4, zlib.crc32(i)) for d, p, s, i in laid_out(docs, packing.CAPACITY)]
    got = queries.op11_pack_documents(spark, sf).select("doc_id", "piece", "start", "length", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == sorted(wanted)


def test_two_of_a_kind():
    assert packing.match_large({5: 5}, 10) == [(((5, 2),), 2), (((5, 1),), 1)]
