"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust their score.

Matches are leftmost and do not overlap within a kind; a match that its check refuses is
dropped, and the search goes on behind it. Places are code points, the end exclusive.
The possessive forms and the look-behinds accept the same matches as the plain patterns,
in time proportional to the text and without recursion, however long a run of characters is.

Nulls: a null text is empty and has no spans. An empty table has no rows. Rows are
independent of each other, so repeated rows and ids give repeated results. Other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTEXT = 40  # code points on either side
RAISE = 0.1
LOWER = "abcdefghijklmnopqrstuvwxyz"

SPAN = "struct<kind:string,start:int,end:int,score:double>"


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def passes_luhn(number: Column) -> Column:
    """Luhn's checksum of a string of digits."""
    places = F.sequence(F.lit(1), F.length(number))

    def worth(i: Column) -> Column:
        digit = F.substring(number, F.length(number) + 1 - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, digit * 2 - F.when(digit > 4, 9).otherwise(0)).otherwise(digit)

    return F.aggregate(places, F.lit(0), lambda total, i: total + worth(i)) % 10 == 0


def passes_mod97(code: Column) -> Column:
    """ISO 7064 mod 97 of a code of A-Z and 0-9 whose first four characters go to the end."""
    turned = F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, F.lit(1), F.lit(4)))

    def step(rest: Column, i: Column) -> Column:
        letter = F.substring(turned, i, F.lit(1))
        return F.when(letter < "A", rest * 10 + F.ascii(letter) - 48).otherwise(rest * 100 + F.ascii(letter) - 55) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def has_digits(least: int, most: int) -> Callable[[Column], Column]:
    return lambda match: F.length(digits(match)).between(least, most)


@dataclass(frozen=True)
class Kind:
    """``near`` are words that raise the score; spans that score below ``least`` are dropped."""

    name: str
    pattern: str
    valid: Callable[[Column], Column]
    score: float
    near: str
    needs: str = ""  # text without this has no match
    least: float = 0.0


# The base kinds of the contract in their order, then the method's own.
KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda m: F.lit(True),
        0.85,
        "e-?mail|mail|contact|write",
        "@",
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        lambda m: m.rlike(r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])){3}$"),
        0.6,
        "ip|address|host|server|login",
        ".",
    ),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?[0-9])++",
        lambda m: F.when(has_digits(16, 19)(m), passes_luhn(digits(m))).otherwise(False),
        0.8,
        "card|visa|mastercard|payment|credit",
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        has_digits(8, 15),
        0.7,
        "phone|tel|call|mobile|fax",
        "+",
    ),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        lambda m: passes_mod97(F.regexp_replace(m, " ", "")),
        0.9,
        "iban|account|bank|konto|compte|cuenta",
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        lambda m: ~m.rlike("^(?:000|666|9)|-00-|-0000$"),
        0.4,
        "ssn|social security",
        "-",
        0.5,
    ),
)
BASE = ("email", "ip", "card", "phone")


def _located(text: Column, found: Column, kind: Kind) -> Column:
    """The valid ones of ``found`` as spans: what lies between the matches tells where they are."""
    gaps = F.slice(F.split(text, kind.pattern, -1), F.lit(1), F.size(found))
    pairs = F.zip_with(found, gaps, lambda m, gap: F.struct(m.alias("match"), F.length(gap).alias("gap")))

    def near(start: Column, end: Column) -> Column:
        around = F.substring(text, F.greatest(start - CONTEXT, F.lit(0)) + 1, end - F.greatest(start - CONTEXT, F.lit(0)) + CONTEXT)
        return F.translate(around, LOWER.upper(), LOWER).rlike(rf"(?:^|[^a-z])(?:{kind.near})(?:$|[^a-z])")

    def add(state: Column, pair: Column) -> Column:
        start = state["at"] + pair["gap"]
        end = start + F.length(pair["match"])
        score = F.lit(kind.score) + F.when(near(start, end), RAISE).otherwise(0.0)
        span = F.struct(F.lit(kind.name).alias("kind"), start.alias("start"), end.alias("end"), score.alias("score"))
        kept = F.when(kind.valid(pair["match"]), F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(end.alias("at"), kept.alias("spans"))

    first = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans"))
    spans = F.aggregate(pairs, first, add, lambda state: F.filter(state["spans"], lambda s: s["score"] >= kind.least))
    return F.when(F.size(found) > 0, spans).otherwise(F.array().cast(f"array<{SPAN}>"))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id and spans: kind, start, end and score (0 to 1), by kind in the order of KINDS, then by start."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    text = F.col("text")
    found = []
    for kind in KINDS:
        matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
        none = F.array().cast("array<string>")
        found.append((F.when(F.contains(text, F.lit(kind.needs)), matches).otherwise(none) if kind.needs else matches).alias(f"_{kind.name}"))
    proposed = texts.select("doc_id", "text", *found)
    return proposed.select("doc_id", F.concat(*[_located(text, F.col(f"_{k.name}"), k) for k in KINDS]).alias("spans"))
