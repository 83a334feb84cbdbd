"""Chat formatting: conversations picked from reply trees and written as one text each.

Messages form trees by their parents. Self-joins that double the distance covered in
each round find, for every message, its distance from the root and the score of the path
to it, so a tree of depth d takes log2(d) joins. Leaves are ranked by path score, and the
path of each chosen leaf is found by the same doubled steps. No path is carried along
while joining.

Template: ``<|im_start|>role<|im_sep|>text<|im_end|>`` and a line feed per turn. Inside
roles and texts a backslash goes into every ``<|``, and one more into ``<\\|`` and so on,
so that no control string can appear there and taking one backslash out restores the text.

Nulls: a null text or role is empty, a null conversation id is a conversation of its own,
a null score is 0. A message whose parent is null or unknown is a root. Messages on a
circle of parents, or below one, have no root; each is then a path of its own. An empty
table gives no conversation. A very long text is escaped and written whole. Other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowmend.sources.storage import materialize

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def chained(turns: DataFrame) -> DataFrame:
    """Messages (conv_id, turn, role, text) as trees without branches: each one replies to the turn before it.

    Rows of one turn follow each other by role and text.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return turns.select(
        "conv_id",
        F.row_number().over(order).cast("long").alias("msg_id"),
        (F.row_number().over(order) - 1).cast("long").alias("parent_id"),
        "role",
        "text",
        F.lit(0.0).alias("score"),
    )


def _doubled(messages: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(conv, msg, depth, total) of each message, and per round its ancestor 2^round steps up."""
    known = messages.select("_conv", F.col("msg_id").alias("parent_id"), F.col("msg_id").alias("up")).distinct()
    linked = messages.join(known, ["_conv", "parent_id"], "left")
    steps = linked.select(
        "_conv",
        "msg_id",
        "up",
        F.lit(1).cast("long").alias("depth"),
        F.coalesce("score", F.lit(0.0)).cast("double").alias("total"),
    )
    rounds, steps = [], materialize(steps, "replies")
    # A path without circles is no longer than its conversation has messages.
    most = messages.groupBy("_conv").count().agg(F.max("count")).first()[0] or 0
    while (1 << len(rounds)) <= most and not steps.where("up IS NOT NULL").isEmpty():
        rounds.append(steps.where("up IS NOT NULL").select("_conv", "msg_id", "up"))
        above = steps.select(
            F.col("_conv").alias("_c"), F.col("msg_id").alias("_m"), F.col("up").alias("_u"), F.col("depth").alias("_d"), F.col("total").alias("_t")
        )
        # Only messages that have not reached their root take another step.
        climbing = steps.where("up IS NOT NULL").join(above, (F.col("_conv") == F.col("_c")) & (F.col("up") == F.col("_m")))
        climbed = climbing.select(
            "_conv",
            "msg_id",
            F.col("_u").alias("up"),
            (F.col("depth") + F.col("_d")).alias("depth"),
            (F.col("total") + F.col("_t")).alias("total"),
        )
        steps = materialize(climbed.unionByName(steps.where("up IS NULL")), "replies")
    return steps, rounds


def chosen_paths(messages: DataFrame, paths: int | None = 1) -> DataFrame:
    """The ``paths`` best root-to-leaf paths of each conversation (None: all), one row per message on them.

    Best is the highest total score, then the longer path, then the smaller leaf. Columns: conv_id, path (its leaf),
    rank, depth, role, text.
    """
    # Null ids become a key that joins; "i" before the others keeps them apart from it.
    keyed = messages.select(
        F.coalesce(F.concat(F.lit("i"), F.col("conv_id").cast("string")), F.lit("null")).alias("_conv"),
        "msg_id",
        "parent_id",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        "score",
    )
    keyed = materialize(keyed, "messages")
    places, rounds = _doubled(keyed)
    circular = F.col("up").isNotNull()
    parents = keyed.select("_conv", F.col("parent_id").alias("msg_id")).distinct()
    ends = places.where(~circular).join(parents, ["_conv", "msg_id"], "left_anti")
    best = Window.partitionBy("_conv").orderBy(F.desc("total"), F.desc("depth"), "msg_id")
    ends = ends.withColumn("rank", F.row_number().over(best))
    if paths is not None:
        ends = ends.where(F.col("rank") <= paths)
    alone = places.where(circular).select("_conv", F.col("msg_id").alias("path"), F.lit(None).cast("int").alias("rank"), "msg_id")
    taken = ends.select("_conv", F.col("msg_id").alias("path"), "rank", "msg_id")
    for step in reversed(rounds):
        # What is 2^k steps above a message found so far belongs to the path as well.
        higher = taken.join(step, ["_conv", "msg_id"]).select("_conv", "path", "rank", F.col("up").alias("msg_id"))
        taken = materialize(taken.unionByName(higher).distinct(), "paths")
    rows = taken.unionByName(alone).join(keyed.select("_conv", "msg_id", "role", "text"), ["_conv", "msg_id"])
    rows = rows.join(places.select("_conv", "msg_id", "depth"), ["_conv", "msg_id"])
    conv_id = F.when(F.col("_conv") != "null", F.expr("substring(_conv, 2)")).cast(messages.schema["conv_id"].dataType)
    return rows.select(conv_id.alias("conv_id"), "path", "rank", "depth", "role", "text")


def formatted(rows: DataFrame) -> DataFrame:
    """One row per path: conv_id, path, text, and loss_spans, the (start, end) of assistant texts in it, in code points."""
    turn = F.struct(
        "depth",
        F.concat(F.lit(START), escaped(F.col("role")), F.lit(SEP)).alias("head"),
        escaped(F.col("text")).alias("body"),
        (F.col("role") == "assistant").alias("learned"),
    )
    grouped = rows.groupBy("conv_id", "path").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    whole = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))))
    begin = lambda acc, t: acc["at"] + F.length(t["head"])
    spans = F.aggregate(
        "turns",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")),
        lambda acc, t: F.struct(
            (begin(acc, t) + F.length(t["body"]) + len(END)).alias("at"),
            F.when(
                t["learned"],
                F.concat(
                    acc["spans"],
                    F.array(F.struct(begin(acc, t).alias("start"), (begin(acc, t) + F.length(t["body"])).alias("end"))),
                ),
            )
            .otherwise(acc["spans"])
            .alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return grouped.select("conv_id", "path", whole.alias("text"), spans.alias("loss_spans"))


def read_back(output: DataFrame) -> DataFrame:
    """Turns and learned texts as the formatted text and its loss mask give them."""
    parts = F.filter(F.split("text", r"<\|im_start\|>"), lambda _, i: i > 0)
    turns = F.transform(
        parts,
        lambda p: F.struct(
            unescaped(F.substring_index(p, SEP, 1)).alias("role"),
            unescaped(F.substring_index(F.substring_index(p, SEP, -1), END, 1)).alias("text"),
        ),
    )
    learned = F.transform("loss_spans", lambda s: unescaped(F.substring(F.col("text"), s["start"] + 1, s["end"] - s["start"])))
    return output.select("conv_id", "path", F.length("text").cast("long").alias("formatted_chars"), turns.alias("turns"), learned.alias("learned"))


def format_chats(messages: DataFrame, paths: int | None = 1) -> DataFrame:
    """The formatted conversations, written once and read again from there."""
    return materialize(formatted(chosen_paths(messages, paths)), "chats")
