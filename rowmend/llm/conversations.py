"""Conversation structure repair: the cheapest edits that make roles alternate, by Hirschberg's divide and conquer.

The rows of a conversation, in order of turn, become a system message at most and then user
and assistant in turns. The edits are Keep, Rerole, Delete and Insert, with the costs below;
the audit, their initials in order, is the ASCII-least one of lowest cost. What roles may
follow depends on four states: nothing yet, after system, after user, after assistant.

Forward, a vector holds for each state the lowest cost of reaching it and the rank of its
least audit among the four; backward, the lowest cost of ending well from it. They meet in
the middle. Audits up to the same row never begin one another, each row giving exactly one
initial after its inserts, so among the states of lowest total cost the one of least rank is
the crossing of the least audit. Both halves are then solved alike, in memory that grows
with the rows only.

Conversations of any length are cut into pieces of PIECE rows. A piece that is a whole
conversation is solved at once. Of the others, four forward passes give what each state on
entering costs to leave it in each other one: pieces are then steps of the same search, which
finds the states between them, and each piece is solved between its two states by a task of
its own. Equal rows travel as one row with a count.

A row's first fault counts: blank (nothing but ASCII white space), duplicate (role and text
occurred earlier in the conversation), truncated (the last other character ends no sentence).

Nulls: a null role or text is one space; an empty role cannot stay, like any other than the three;
a null conv_id is a conversation; null turns come
first. Empty texts are blank; very long texts are handled whole. Rows of equal turn are taken
by role and text; repeated rows are adjacent, all but the first being duplicates. An empty
table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmend.llm.rows import small
from rowmend.operators.ranks import sorted_places
from rowmend.sources.storage import materialize

PIECE = 4096  # rows solved together
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

START, SYSTEM, USER, ASSISTANT = range(4)
NAMES = {"u": "user", "a": "assistant"}
# What it costs to end in each state, by inserting what is missing.
_ENDS = ("", "ua", "a", "")
_NEVER = float("inf")
_MUST_GO, _CUT_SHORT = 1, 2  # faults as the search sees them, 0 being none


def _next_role(state: int) -> str:
    return "a" if state == USER else "u"


def _row_steps(role: str, fault: int) -> tuple:
    """For a row, by state before and after it: (cost, initials, roles of what comes out), or None."""
    table: list[list] = [[None] * 4 for _ in range(4)]
    for before in range(4):
        state, inserted = before, ""
        for n in range(3):
            extra = TRUNCATED if fault == _CUT_SHORT else 0
            follows = _next_role(state)
            options = [(DELETE, "D", "", state)]
            if fault != _MUST_GO:
                options.append((REROLE + extra, "R", follows, USER if follows == "u" else ASSISTANT))
                if role == follows:
                    options.append((extra, "K", role, USER if role == "u" else ASSISTANT))
                elif role == "s" and state == START:
                    options.append((extra, "K", role, SYSTEM))
            for cost, initial, out, after in options:
                step = (n * INSERT + cost, "I" * n + initial, inserted + out)
                if table[before][after] is None or step < table[before][after]:
                    table[before][after] = step
            inserted += follows
            state = USER if follows == "u" else ASSISTANT
    return tuple(map(tuple, table))


# Steps of a row by 3 * role + fault; the last one stands for any other role.
_ROW_STEPS = [_row_steps(role, fault) for role in "sua-" for fault in range(3)]


def forward(steps: Sequence, start: int) -> tuple[list, list]:
    """Lowest cost of reaching each state, and the ranks of the least edits that do."""
    costs, ranks = [_NEVER] * 4, [0] * 4
    costs[start] = 0
    for table in steps:
        found: list = [None] * 4
        for before in range(4):
            if costs[before] == _NEVER:
                continue
            for after in range(4):
                step = table[before][after]
                if step is not None:
                    way = (costs[before] + step[0], ranks[before], step[1])
                    if found[after] is None or way < found[after]:
                        found[after] = way
        order = sorted(way[1:] for way in found if way is not None)
        costs = [_NEVER if way is None else way[0] for way in found]
        ranks = [0 if way is None else order.index(way[1:]) for way in found]
    return costs, ranks


def backward(steps: Sequence, ends: Sequence) -> list:
    """Lowest cost of going on from each state, given what each last state costs."""
    costs = list(ends)
    for table in reversed(steps):
        costs = [min((step[0] + cost for step, cost in zip(row, costs) if step is not None), default=_NEVER) for row in table]
    return costs


def crossing(costs: Sequence, ranks: Sequence, rest: Sequence) -> int:
    """The state through which the least of the cheapest edits go."""
    return min(range(4), key=lambda s: (costs[s] + rest[s], ranks[s]))


def states_after(steps: Sequence, start: int, end: int) -> list[int]:
    """The state after each step of the least of the cheapest ways from one state to another."""
    if len(steps) == 1:
        return [end]
    middle = len(steps) // 2
    left, right = steps[:middle], steps[middle:]
    at = crossing(*forward(left, start), backward(right, [0 if s == end else _NEVER for s in range(4)]))
    return states_after(left, start, at) + states_after(right, at, end)


def last_state(steps: Sequence) -> int:
    return crossing(*forward(steps, START), [INSERT * len(missing) for missing in _ENDS])


def solve(codes: tuple[int, ...], start: int, end: int | None, is_last: bool) -> tuple[tuple[str, ...], tuple[str, ...], str]:
    """Edits of each row, the roles that come out of each, and those inserted at the end. No ``end``: a whole conversation."""
    steps = [_ROW_STEPS[c] for c in codes]
    last = last_state(steps) if end is None else end
    states = [start, *states_after(steps, start, last)]
    taken = [table[a][b] for table, a, b in zip(steps, states, states[1:])]
    return tuple(t[1] for t in taken), tuple(t[2] for t in taken), _ENDS[last] if is_last else ""


_known = lru_cache(maxsize=50_000)(solve)
SOLVED = "part bigint, first bigint, edits array<string>, roles array<string>, tail string"


def _solved(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in small(parts):
        found = []
        for r in part.to_pylist():
            way = _known if len(r["codes"]) <= 64 else solve
            found.append(way(tuple(r["codes"]), r["before"], r["after"], r["is_last"]))
        listed = pa.list_(pa.string())
        columns = [part.column("part"), part.column("first"), *[pa.array([f[k] for f in found], listed) for k in (0, 1)], pa.array([f[2] for f in found], pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["part", "first", "edits", "roles", "tail"])


SUMMARIES = "conv string, part bigint, first bigint, costs array<double>, ranks array<int>"


def _summaries(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each piece, by entering and leaving state, cost and rank."""
    for part in small(parts):
        costs, ranks = [], []
        for codes in part.column("codes").to_pylist():
            steps = [_ROW_STEPS[c] for c in codes]
            ways = [forward(steps, s) for s in range(4)]
            costs.append([float(c) for way in ways for c in way[0]])
            ranks.append([r for way in ways for r in way[1]])
        kept = [part.column(c) for c in ("conv", "part", "first")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(costs, pa.list_(pa.float64())), pa.array(ranks, pa.list_(pa.int32()))], ["conv", "part", "first", "costs", "ranks"])


def _between(table: pa.Table) -> pa.Table:
    """States before and after each piece of one conversation."""
    table = table.sort_by([("part", "ascending"), ("first", "ascending")])
    steps = []
    for costs, ranks in zip(table.column("costs").to_pylist(), table.column("ranks").to_pylist()):
        at = lambda s, t: None if costs[4 * s + t] == _NEVER else (costs[4 * s + t], ranks[4 * s + t])  # noqa: E731, B023
        steps.append([[at(s, t) for t in range(4)] for s in range(4)])
    after = states_after(steps, START, last_state(steps))
    states = {"before": pa.array([START, *after[:-1]], pa.int32()), "after": pa.array(after, pa.int32())}
    last = pa.array([k == len(after) - 1 for k in range(len(after))], pa.bool_())
    return pa.table({"part": table.column("part"), "first": table.column("first"), **states, "is_last": last})


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows in order of conversation and turn, each once with its copies and its fault."""
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit("none"))
    filled = rows.select("conv_id", conv.alias("conv"), "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    each = filled.groupBy("conv_id", "conv", "turn", "role", "text").agg(F.count("*").alias("copies"))
    said = F.sha2(F.concat("conv", F.lit(":"), F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    each = each.withColumn("said", said)
    earlier = each.groupBy("said").agg(F.min(F.struct("turn")).alias("earliest"), F.count("*").alias("n")).where("n > 1").drop("n")
    kept = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    is_later = F.col("earliest").isNotNull() & ~F.struct("turn").eqNullSafe(F.col("earliest"))
    fault = F.when(kept == "", "blank").when(is_later, "duplicate").when(~F.right(kept, F.lit(1)).isin(".", "!", "?"), "truncated")
    initial = F.left("role", F.lit(1))
    code = 3 * F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    marked = each.join(earlier, "said", "left").withColumn("fault", fault).drop("said", "earliest")
    seen = F.when(F.col("fault") == "truncated", _CUT_SHORT).when(F.col("fault").isNotNull(), _MUST_GO).otherwise(0)
    marked = marked.withColumn("code", (code + seen).cast("int"))
    return sorted_places(marked, ["conv", "turn", "role", "text"])


def edit_conversations(rows: DataFrame, piece: int = PIECE) -> DataFrame:
    """What to do with each row of ``rows`` (conv_id, turn, role, text).

    Gives conv_id, conv, part and place (the order), turn, role, text, copies, fault, edits (inserts before
    the row, and its own edit; further copies are deleted), roles (initials of the messages that come out)
    and tail (those inserted after the conversation's last row).
    """
    placed = _ordered(rows).withColumnsRenamed({"_part": "part", "_place": "place"})
    first = F.expr(f"place div {int(piece)} * {int(piece)}")
    pieces = placed.select("conv", "part", first.alias("first"), "place", "code").groupBy("conv", "part", "first")
    # At most `piece` numbers each.
    pieces = pieces.agg(F.array_sort(F.collect_list(F.struct("place", "code"))).alias("held"))
    pieces = pieces.select("conv", "part", F.col("held")[0]["place"].alias("first"), F.col("held.code").alias("codes"))
    pieces = materialize(pieces, "pieces")
    several = pieces.groupBy("conv").count().where("count > 1").select("conv")
    whole = pieces.join(several, "conv", "left_anti").withColumns(
        {"before": F.lit(START), "after": F.lit(None).cast("int"), "is_last": F.lit(True)}
    )
    long = pieces.join(several, "conv", "left_semi")
    states = long.mapInArrow(_summaries, SUMMARIES).groupBy("conv")
    states = states.applyInArrow(_between, "part bigint, first bigint, before int, after int, is_last boolean")
    inner = ["part", "first", "codes", "before", "after", "is_last"]
    todo = whole.select(*inner).union(long.drop("conv").join(states, ["part", "first"]).select(*inner))
    solved = todo.mapInArrow(_solved, SOLVED)
    size = F.size("edits") - 1
    each = solved.select("part", "first", "tail", size.alias("most"), F.posexplode(F.arrays_zip("edits", "roles")).alias("k", "edit"))
    tail = F.when(F.col("k") == F.col("most"), F.col("tail")).otherwise(F.lit(""))
    each = each.select("part", (F.col("first") + F.col("k")).alias("place"), F.col("edit.edits").alias("edits"), F.col("edit.roles").alias("roles"), tail.alias("tail"))
    return placed.drop("code").join(each, ["part", "place"])


def repaired(edited: DataFrame) -> DataFrame:
    """The messages of the repaired conversations: conv_id, conv, part, place, nr (their order), role, text, edit."""
    n = F.length("edits") - 1
    names = F.create_map(*[F.lit(x) for pair in NAMES.items() for x in pair])
    message = lambda initial, role, text, edit: F.struct(
        F.coalesce(role, names[initial]).alias("role"), text.alias("text"), edit.alias("edit")
    )
    none = F.lit(None).cast("string")
    inserted = lambda initials: F.transform(
        F.filter(F.split(initials, ""), lambda i: i != ""), lambda i: message(i, none, F.lit(""), F.lit("I"))
    )
    own = F.right("edits", F.lit(1))
    initial = F.right("roles", F.lit(1))
    kept = F.when(own == "K", F.array(message(initial, F.col("role"), F.col("text"), own))).when(
        own == "R", F.array(message(initial, none, F.col("text"), own))
    )
    none_kept = F.filter(F.array(message(initial, none, F.col("text"), own)), lambda m: F.lit(False))
    messages = F.concat(inserted(F.substring("roles", F.lit(1), n)), F.coalesce(kept, none_kept), inserted(F.col("tail")))
    listed = edited.select("conv_id", "conv", "part", "place", F.posexplode(messages).alias("nr", "message"))
    return listed.select("conv_id", "conv", "part", "place", "nr", "message.*")


SUMMARY = (
    "conv string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "cost bigint, audit string, repaired_sha256 string"
)
_LEGAL = ("su", "ua", "au")
_COST = {"K": 0, "R": REROLE, "D": DELETE}


class _Summary:
    """What the rows of one conversation, met in order, come to; texts are hashed as they pass."""

    def __init__(self, conv: str) -> None:
        self.conv, self.least, self.most, self.turns, self.initial = conv, None, None, 0, None
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = self.cost = 0
        self.audit: list[str] = []
        self.digest, self.empty = hashlib.sha256(), True

    def say(self, role: str, text: str) -> None:
        self.digest.update(f"{'' if self.empty else chr(10)}{role}:{text}".encode())
        self.empty = False

    def add(self, r: dict) -> None:
        if r["turn"] is not None and r["turn"] != self.most:
            self.least = r["turn"] if self.least is None else self.least
            self.most, self.turns = r["turn"], self.turns + 1
        more, initial = r["copies"] - 1, r["role"][:1]
        self.illegal += (self.initial is not None and self.initial + initial not in _LEGAL) + more * (initial + initial not in _LEGAL)
        self.initial = initial
        if r["fault"] is not None:
            self.faults[r["fault"]] += 1
        self.faults["blank" if r["fault"] == "blank" else "duplicate"] += more
        edits, roles, tail = r["edits"], r["roles"], r["tail"]
        own, before = edits[-1], len(edits) - 1
        self.cost += INSERT * (before + len(tail)) + _COST[own] + DELETE * more
        self.cost += TRUNCATED * (r["fault"] == "truncated" and own != "D")
        self.audit.append(edits + "D" * more + "I" * len(tail))
        for initial in roles[:before]:
            self.say(NAMES[initial], "")
        if own != "D":
            self.say(r["role"] if own == "K" else NAMES[roles[-1]], r["text"])
        for initial in tail:
            self.say(NAMES[initial], "")

    def row(self) -> tuple:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return (self.conv, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest())


def _summed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), *[pa.int64()] * 6, pa.string(), pa.string()]
    names = [c.split()[0] for c in SUMMARY.split(", ")]
    batch = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
    now, done = None, []
    for part in small(parts):
        for r in part.to_pylist():
            if now is None or r["conv"] != now.conv:
                if now is not None:
                    done.append(now.row())
                now = _Summary(r["conv"])
            now.add(r)
        if len(done) > 1000:
            yield batch(done)
            done = []
    if now is not None:
        yield batch([*done, now.row()])


def summaries(edited: DataFrame) -> DataFrame:
    """Faults, cost, audit and the repaired text's digest of each conversation.

    A digest of a text needs that text in order: a task goes over its conversations row by
    row, sorted by Spark, and holds one audit and one running hash.
    """
    rows = edited.select("conv", "part", "place", "turn", "role", "text", "copies", "fault", "edits", "roles", "tail")
    return rows.repartition("conv").sortWithinPartitions("conv", "part", "place").mapInArrow(_summed, SUMMARY)


def summarize(conversations: DataFrame, original: DataFrame, piece: int = PIECE) -> DataFrame:
    """One row per conversation of ``original``; those without any row left are empty and have no fault."""
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit("none"))
    found = summaries(edit_conversations(conversations, piece))
    every = original.select("conv_id", conv.alias("conv")).distinct().join(found, "conv", "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    empty = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts]
    digest = F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256")
    return every.select("conv_id", *empty, F.coalesce("audit", F.lit("")).alias("audit"), digest)


def damage(rows: DataFrame) -> DataFrame:
    """The rows with faults worked in, by the remainder of a checksum of conversation and turn."""
    space = F.lit(" ")
    filled = rows.select("conv_id", "turn", *[F.coalesce(c, space).alias(c) for c in ("role", "text")])
    named = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    kind = F.crc32(named) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(kind == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return filled.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), times)).alias("_copy")).drop("_copy")
