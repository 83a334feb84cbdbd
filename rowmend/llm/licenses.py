"""License scans: short notices found with a bounded number of edits.

A notice of n letters may differ by n // 12 edits, but short ones by none. It is split into
one more seed than edits: a text within the bound has at least one seed unchanged
(pigeonhole). One automaton finds all seeds; around each, bounded-error matching of the
``regex`` library verifies the notice between word borders and counts the edits. A match
that overlaps one of fewer edits and about its length is given up for it; exact places of
base phrases always stay.

Words are lower-cased in A-Z only, and everything else that is ASCII but no letter or
digit separates them.

Nulls: a null text is empty and has no word. Rows are independent of each other, so
repeated rows and ids give repeated results. An empty table has no rows. Other columns
are ignored. A long text is worked on whole; equal surroundings are verified once.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import cache
from itertools import groupby

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from rowmend.llm.rows import small

# Phrases of the contract and their labels.
BASE = (
    ("mit", "mit license"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
)
# Further notices, as their first words read once lower-cased.
NOTICES = (
    ("agpl", "gnu affero general public license"),
    ("apache", "licensed under the apache license version 2 0"),
    ("artistic", "the artistic license 2 0"),
    ("boost", "boost software license version 1 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "licensed under the bsd license"),
    ("cc-by", "creative commons attribution"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc0", "cc0 1 0 universal"),
    ("epl", "eclipse public license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu"),
    ("gpl", "licensed under the gnu general public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose"),
    ("lgpl", "gnu lesser general public license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "released under the mit license"),
    ("mpl", "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)
LETTERS_PER_EDIT = 12
CACHED_WINDOWS = 20_000

_BLANK = 0x20
_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else _BLANK for c in range(256)
)

FOUND = (
    "doc_id bigint, n_words bigint, matches array<struct<label:string,base:boolean,first_word:bigint,n_words:bigint,edits:int,score:double>>"
)
_MATCH = pa.struct(
    [("label", pa.string()), ("base", pa.bool_()), ("first_word", pa.int64())]
    + [("n_words", pa.int64()), ("edits", pa.int32()), ("score", pa.float64())]
)


def folded(text: str | None) -> str:
    """The text's words, each after one blank, and a blank at the end."""
    words = (text or "").encode().translate(_FOLD).split()
    return b" ".join([b"", *words, b""]).decode() if words else " "


def seeds(notice: str, edits: int) -> list[tuple[int, str]]:
    """The notice cut into edits + 1 pieces of about equal length, with their offsets."""
    cuts = [len(notice) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


class Scanner:
    def __init__(self, notices=(*BASE, *NOTICES)) -> None:
        self.notices = [(label, phrase, len(phrase) // LETTERS_PER_EDIT) for label, phrase in notices]
        self.patterns = [regex.compile(f" ((?:{regex.escape(p)}){{e<={k}}}) ", regex.BESTMATCH) for _, p, k in self.notices]
        starts: dict[str, list[tuple[int, int]]] = {}
        for number, (_, phrase, edits) in enumerate(self.notices):
            for offset, seed in seeds(phrase, edits):
                starts.setdefault(seed, []).append((number, offset))
        self.automaton = ahocorasick.Automaton()
        for seed, places in starts.items():
            self.automaton.add_word(seed, (len(seed), places))
        self.automaton.make_automaton()
        self.verified: dict[tuple[int, str], tuple[int, int, int] | None] = {}

    def verify(self, number: int, window: str) -> tuple[int, int, int] | None:
        """(start, end, edits) of the best match between two blanks of the window."""
        key = number, window
        if key not in self.verified:
            if len(self.verified) >= CACHED_WINDOWS:
                self.verified.clear()
            m = self.patterns[number].search(window)
            self.verified[key] = (m.start(1), m.end(1), sum(m.fuzzy_counts)) if m else None
        return self.verified[key]

    def exact(self, said: str) -> set[tuple[str, int, int]]:
        """Label and the blanks around each place of a base phrase: candidates with no edit, overlaps included."""
        found = set()
        for last, (size, places) in self.automaton.iter(said):
            for number, offset in places:
                label, phrase, _ = self.notices[number]
                begin = last - size - offset  # the blank before the phrase
                if (label, phrase) in BASE and begin >= 0 and said.startswith(f" {phrase} ", begin):
                    found.add((label, begin, begin + len(phrase) + 1))
        return found

    def fuzzy(self, said: str) -> dict[tuple[str, int, int], tuple[int, float]]:
        """Edits and score by label, start and end; the best notice of a label counts."""
        found: dict[tuple[str, int, int], tuple[int, float]] = {}
        for last, (size, places) in self.automaton.iter(said):
            for number, offset in places:
                label, phrase, edits = self.notices[number]
                begin = max(last + 1 - size - offset - edits - 1, 0)
                match = self.verify(number, said[begin : last + 1 - size - offset + len(phrase) + edits + 1])
                if match:
                    place = label, begin + match[0], begin + match[1]
                    found[place] = min(found.get(place, (len(phrase), 0.0)), (match[2], 1 - match[2] / len(phrase)))
        return found

    @staticmethod
    def closest(found: dict[tuple[str, int, int], tuple[int, float]]) -> dict[tuple[str, int, int], tuple[int, float]]:
        """Without matches that overlap one of fewer edits and about their length: notices that differ in a word are told apart."""
        kept: dict[tuple[str, int, int], tuple[int, float]] = {}
        taken: dict[int, list[tuple[int, int]]] = {}  # places of matches of fewer edits by their length, in order
        for edits, level in groupby(sorted(found.items(), key=lambda f: (f[1][0], f[0])), key=lambda f: f[1][0]):
            fresh = []
            for (label, begin, end), how in level:
                beaten = False
                for length, places in taken.items():
                    if length >= end - begin - edits and not beaten:
                        # Places of one length that end after this one's begin: the first of them begins earliest.
                        i = bisect_right(places, (begin - length, end))
                        beaten = i < len(places) and places[i][0] < end
                if not beaten:
                    kept[label, begin, end] = how
                    fresh.append((begin, end))
            for begin, end in fresh:
                taken.setdefault(end - begin, []).append((begin, end))
            for places in taken.values():
                places.sort()
        return kept

    def scan(self, text: str | None) -> tuple[int, list[dict]]:
        """Number of words, and matches by place."""
        said = folded(text)
        found = [(at, end, label, True, 0, 1.0) for label, at, end in self.exact(said)]
        found += [(a - 1, b, label, False, edits, score) for (label, a, b), (edits, score) in self.closest(self.fuzzy(said)).items()]
        matches, counted, words = [], 0, 0
        for at, end, label, base, edits, score in sorted(found):
            words, counted = words + said.count(" ", counted, at), at
            row = {"label": label, "base": base, "first_word": words, "n_words": said.count(" ", at, end), "edits": edits}
            matches.append(row | {"score": score})
        return said.count(" ") - 1, matches


@cache
def _scanner() -> Scanner:
    return Scanner()


def _scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scanner = _scanner()
    for part in small(parts):
        results = [scanner.scan(text) for text in part.column("text").to_pylist()]
        columns = [
            part.column("doc_id"),
            pa.array([n for n, _ in results], pa.int64()),
            pa.array([m for _, m in results], pa.list_(_MATCH)),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "matches"])


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id, n_words and matches: label, first_word, n_words, edits and score (1 for no edit), base for exact base phrases."""
    return docs.select("doc_id", "text").mapInArrow(_scan, FOUND)
