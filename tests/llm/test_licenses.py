"""License scans against plain search, edits against a brute-force distance."""

import random
import re

import ahocorasick
import pytest

from llm.conftest import ODD
from rowmend.llm import licenses
from rowmend.llm.queries import op2_licenses

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))


def base(text):
    own = words(text)
    places = [(label, i) for label, p in licenses.BASE for i in range(len(own)) if own[i : i + len(p.split())] == p.split()]
    return len(own), sorted(places)


def scanned(docs):
    return {r["doc_id"]: r for r in licenses.scan_licenses(docs).collect()}


def test_base_places(make):
    texts = [
        "MIT License, mit license; the MIT\nLICENSE",
        "gnu General Public License general public license",
        "mit licenses are no mit-license? mit_license",
        "Apache License Apache Apache License",
        "É mit license é",
        "submit license",
    ]
    got = scanned(make(texts))
    for i, text in enumerate(texts):
        n, places = base(text)
        assert got[i]["n_words"] == n
        assert sorted((m["label"], m["first_word"]) for m in got[i]["matches"] if m["base"]) == places


@pytest.mark.parametrize(
    "text, label, edits",
    [
        ("Permision is herby granted, free of charge, to any person obtaining a copy of this software", "mit", 2),
        ("Licensed under the Apache License, Version 2.0", "apache", 0),
        ("Licenced under the Apache Licence, Version 2.0", "apache", 2),
        ("Licensed under CC BY-NC 4.0.", "cc-by-nc", 0),
        ("GNU Leser General Public License", "lgpl", 1),
        ("This is free and unencumbered software released in to the public domain", "unlicense", 1),
    ],
)
def test_edits(text, label, edits):
    _, found = licenses.Scanner().scan(f"before {text} after")
    match = next(m for m in found if m["label"] == label and not m["base"] and m["edits"] == edits)
    assert match["first_word"] == 1 and match["n_words"] == len(words(text))


def test_notices_apart_by_a_word():
    _, found = licenses.Scanner().scan("licensed under cc by sa 4 0")
    assert {m["label"] for m in found} == {"cc-by-sa"}


def test_too_many_edits_and_short_notices():
    scan = licenses.Scanner().scan
    assert scan("with it license")[1] == []
    assert scan("permission was never granted for a fee to a person who made copies of software")[1] == []


def test_seeds_cover_the_notice():
    for _, phrase in licenses.NOTICES:
        for edits in range(8):
            pieces = licenses.seeds(phrase, edits)
            assert len(pieces) == edits + 1 and "".join(s for _, s in pieces) == phrase
            assert all(phrase[o : o + len(s)] == s for o, s in pieces)


def test_odd_tables(odd, empty):
    rows = licenses.scan_licenses(odd).collect()
    assert sorted(r["n_words"] for r in rows) == sorted(len(words(d[1])) for d in ODD)
    assert all(not r["matches"] for r in rows)
    assert licenses.scan_licenses(empty).count() == 0


def test_many_matches_in_a_long_text(make):
    found = scanned(make(["mit license apache licence " * 5000]))[0]["matches"]
    assert sum(m["base"] for m in found) == 5000
    assert sum(m["label"] == "apache" and m["edits"] == 1 for m in found) == 5000


def plain_search(said):
    """Each place of a base phrase by str.find."""
    for label, phrase in licenses.BASE:
        at = said.find(f" {phrase} ")
        while at >= 0:
            yield label, at, at + len(phrase) + 1
            at = said.find(f" {phrase} ", at + 1)


def test_base_places_come_from_the_automaton():
    rng = random.Random(5)
    parts = [w for _, p in licenses.BASE for w in p.split()] + [p for _, p in licenses.BASE] + ["x", "licenses"]
    for _ in range(300):
        said = licenses.folded(" ".join(rng.choices(parts, k=rng.randint(0, 30))))
        assert licenses._scanner().exact(said) == set(plain_search(said))
    blind = licenses.Scanner()
    blind.automaton = ahocorasick.Automaton()
    blind.automaton.add_word("qqq", (3, []))
    blind.automaton.make_automaton()
    assert blind.scan("the mit license")[1] == []


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in op2_licenses(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    for r in docs:
        n, places = base(r["text"])
        starts = [at for _, at in places]
        expected = (n, len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for label, _ in places})))
        assert tuple(got[r["doc_id"]][c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels")) == expected


def distance(a, b):
    """Edits between two texts, by the whole table."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def spans(text):
    """Every notice and run of words within its bound: (label, edits, length of the notice)."""
    own, found = words(text), []
    for label, phrase in (*licenses.BASE, *licenses.NOTICES):
        most, size = len(phrase) // licenses.LETTERS_PER_EDIT, len(phrase.split())
        for i in range(len(own)):
            for j in range(max(i + 1, i + size - most), min(len(own), i + size + most) + 1):
                said = " ".join(own[i:j])
                if abs(len(said) - len(phrase)) <= most and (edits := distance(said, phrase)) <= most:
                    found.append((label, edits, len(phrase)))
    return found


def test_labels_and_scores_against_edit_distances():
    """Notices with random edits among other words: no label without a run of words in its bound, and the closest one is found with its edits."""
    rng = random.Random(21)
    for label, phrase in [*licenses.BASE, *licenses.NOTICES]:
        for _ in range(4):
            letters = list(phrase)
            for _ in range(rng.randint(0, len(phrase) // licenses.LETTERS_PER_EDIT + 1)):
                k = rng.randrange(len(letters))
                kind = rng.choice(["drop", "change", "add"])
                letters[k : k + (kind != "add")] = [] if kind == "drop" else [rng.choice("abcxyz ")]
            text = "quite other words " + "".join(letters) + " follow here"
            every = spans(text)
            found = [m for m in licenses.Scanner().scan(text)[1] if not m["base"]]
            assert {m["label"] for m in found} <= {name for name, _, _ in every}, text
            assert min((m["edits"] for m in found), default=None) == min((e for _, e, _ in every), default=None), text
            known = {(name, round(1 - e / n, 9)) for name, e, n in every}
            assert {(m["label"], round(m["score"], 9)) for m in found} <= known, text
