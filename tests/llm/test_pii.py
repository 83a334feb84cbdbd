"""Personal data against plain patterns in Python."""

import random
import re

from llm.conftest import ODD
from rowmend.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def plain_spans(text):
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if valid(k, m[0])]


def spans(docs):
    rows = pii.find_personal_data(docs).collect()
    return {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in rows}


def test_random_texts(make):
    rng = random.Random(7)
    bits = ["a@b.c", "a.b+c@d-e.f.g", "@", ".", "x", "4111 1111 1111 1111", "4111-1111", "1", "255", "256", ".", "-", " ", "+1 (555) 010-9999", "+", "(", "é", "😀", "_", "10.0.0.1", "00012"]
    texts = ["".join(rng.choices(bits, k=rng.randint(1, 14))) for _ in range(400)]
    got = spans(make(texts))
    for i, text in enumerate(texts):
        assert [s for s in got[i] if s[0] in pii.BASE] == plain_spans(text), text


def test_checksums_and_context(make):
    texts = [
        "IBAN DE89 3704 0044 0532 0130 00 please",
        "IBAN DE89 3704 0044 0532 0130 01 please",
        "GB82WEST12345698765432",
        "social security 078-05-1120",
        "number 078-05-1120",
        "ssn 000-05-1120",
        "card 4111111111111111",
        "4111111111111111",
    ]
    rows = {r["doc_id"]: r["spans"] for r in pii.find_personal_data(make(texts)).collect()}
    kinds = [[s["kind"] for s in rows[i]] for i in range(len(texts))]
    assert kinds == [["iban"], [], ["iban"], ["ssn"], [], [], ["card"], ["card"]]
    assert (rows[0][0]["start"], rows[0][0]["end"]) == (5, 32)
    assert rows[6][0]["score"] > rows[7][0]["score"]


def test_odd_tables(odd, empty):
    rows = pii.find_personal_data(odd).collect()
    assert len(rows) == len(ODD) and all(not r["spans"] for r in rows)
    assert pii.find_personal_data(empty).count() == 0


def test_long_runs_neither_fail_nor_stall(make):
    texts = ["a" * 200_000, "1" * 200_000, "a." * 60_000, "a@b" + ".c" * 60_000, "1 " * 60_000, "+1" + "(" * 100_000, "1.2.3.4 " * 5_000]
    got = spans(make(texts))
    assert [len(got[i]) for i in range(len(texts))] == [0, 0, 0, 1, 0, 0, 5_000]
