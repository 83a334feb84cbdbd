"""Conversation repair against all edits of small conversations, in one piece and in many."""

import hashlib
import random
import re
from itertools import product

from rowmend.llm import conversations as c

ROWS = "conv_id bigint, turn bigint, role string, text string, edits string, fault string, place string"


def faults_of(rows):
    seen, found = set(), []
    for role, text in rows:
        kept = text.rstrip(" \t\n\x0b\x0c\r")
        found.append("blank" if not kept else "duplicate" if (role, text) in seen else None if kept[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def brute(rows):
    """Cheapest and then least audit over all edits, with up to two inserts before each row and at the end."""
    faults, best = faults_of(rows), None
    ways = []
    for (role, text), fault in zip(rows, faults):
        own = [("D", 2, [])]
        if fault not in ("blank", "duplicate"):
            more = 5 if fault == "truncated" else 0
            own += [("K", more, [(role, text)])] + [("R", 1 + more, [(r, text)]) for r in ("user", "assistant")]
        ways.append(own)
    inserted = [("", 0, [])] + [("I" * n, 5 * n, [(r, "") for r in roles]) for n in (1, 2) for roles in product(("user", "assistant"), repeat=n)]
    states = {("", ()): 0}
    for own in [*ways, None]:
        reached = {}
        for (audit, out), cost in states.items():
            for before, extra, added in inserted:
                for edit, price, made in own or [("", 0, [])]:
                    # Only the last initial decides what may follow; texts are kept to be hashed.
                    said = (*out, *added, *made)
                    initials = "".join(r[:1] or "-" for r, _ in said)  # no role is one that may not stay
                    if not re.fullmatch("(s?(ua)*u?)?", initials):
                        continue
                    key = (audit + before + edit, said)
                    if key not in reached or cost + extra + price < reached[key]:
                        reached[key] = cost + extra + price
        least = sorted(reached.items(), key=lambda x: (x[1], x[0][0]))
        states, kept = {}, {}
        for (audit, said), cost in least:  # of each way to go on the best one only
            state = ("".join(r[:1] for r, _ in said)[-1:], not said)
            if own is None:
                if re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in said)):
                    best = min(best, (cost, audit, said)) if best else (cost, audit, said)
            elif state not in kept:
                kept[state] = True
                states[(audit, said)] = cost
    return best, faults


def summary(rows):
    """What the operator should say of one conversation's (turn, role, text) in order."""
    (cost, audit, said), faults = brute([r[1:] for r in rows])
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest()
    return (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest)


def random_rows(rng, n):
    roles = ["system", "user", "user", "assistant", "assistant", "tool", ""]
    texts = ["Yes.", "No.", "", " \n", "cut", "Why?", "One. ", "x!"]
    turns = sorted(rng.choices([None, *range(8)], k=n), key=lambda t: (t is not None, t))
    return sorted(((t, rng.choice(roles), rng.choice(texts)) for t in turns), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def check(spark, talks, piece):
    rows = [(k, t, r, x, "e", "f", "p") for k, talk in talks.items() for t, r, x in talk]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, ROWS)
    every = spark.createDataFrame([(k,) for k in talks], "conv_id bigint")
    got = {r["conv_id"]: tuple(r)[1:] for r in c.summarize(df, every, piece).collect()}
    for k, talk in talks.items():
        assert got[k] == summary([(t, " " if r is None else r, " " if x is None else x) for t, r, x in talk]), (k, talk)


def test_small_conversations_in_one_piece_and_in_many(spark):
    rng = random.Random(11)
    talks = {k: random_rows(rng, rng.randint(0, 7)) for k in range(150)}
    talks[None] = random_rows(rng, 5)
    talks[1000] = [(0, None, None), (1, "user", None), (2, "user", "Is it?"), (2, "user", "Is it?"), (3, "assistant", "long " * 50_000 + ".")]
    check(spark, talks, c.PIECE)
    check(spark, talks, 2)


def test_long_conversations(spark):
    rng = random.Random(12)
    check(spark, {k: random_rows(rng, 60) for k in range(4)}, 7)


def test_repaired_messages_alternate(spark):
    rng = random.Random(13)
    rows = [(k, t, r, x, "e", "f", "p") for k in range(30) for t, r, x in random_rows(rng, 6)]
    edited = c.edit_conversations(spark.createDataFrame(rows, ROWS), 3)
    assert edited.count() > 0
    said = {}
    for r in sorted(c.repaired(edited).collect(), key=lambda r: (r["conv"], r["part"], r["place"], r["nr"])):
        said.setdefault(r["conv"], []).append(r)
    digests = {r["conv"]: r["repaired_sha256"] for r in c.summaries(edited).collect()}
    for conv, messages in said.items():
        assert re.fullmatch("(s?(ua)+)?", "".join(m["role"][:1] for m in messages))
        assert digests[conv] == hashlib.sha256("\n".join(f"{m['role']}:{m['text']}" for m in messages).encode()).hexdigest()


def test_empty(spark):
    none = spark.createDataFrame([], ROWS)
    assert c.summarize(none, none.select("conv_id")).count() == 0
    lost = c.summarize(none, spark.range(1).selectExpr("id AS conv_id")).first()
    assert tuple(lost) == (0, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())


def test_steps_in_halves_agree_with_one_pass():
    rng = random.Random(3)
    for _ in range(200):
        codes = tuple(rng.randrange(12) for _ in range(rng.randint(1, 40)))
        edits, roles, tail = c.solve(codes, c.START, None, True)
        cost, audit, state = 0, "", {c.START: (0, "")}
        for code in codes:
            state_after = {}
            for s, (cost, audit) in state.items():
                for t, step in enumerate(c._ROW_STEPS[code][s]):
                    if step is not None:
                        way = (cost + step[0], audit + step[1])
                        state_after[t] = min(way, state_after.get(t, way))
            state = state_after
        best = min((cost + 5 * len(c._ENDS[s]), audit + "I" * len(c._ENDS[s])) for s, (cost, audit) in state.items())
        assert "".join(edits) + "I" * len(tail) == best[1]
