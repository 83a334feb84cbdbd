"""Mixing sources to target weights: equal-token blocks apportioned by highest quotients.

A source's documents lie in shards, in seeded order, as one run of words that is cut
into blocks of equal size. Sainte-Laguë apportionment (quotients weight / (2 seats + 1))
deals all blocks of the mix to the sources, then each source's blocks to its shards.
A shard takes as many blocks as it was dealt, starting at a seeded block and going
round; a second round repeats words, a third one never happens.

Nulls: a null text has no words, a null source is a source of its own that comes last,
a null doc_id is an id like any other. Ties: rows of one id are ordered by size, equal
rows are interchangeable. An empty table gives an empty mix. A very long text counts
with all its words, and a block may end inside it. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowmend.llm.rows import text_hash
from rowmend.sources.storage import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)  # repeated over the sources in their order
SHARE = (3, 2)  # the mix has 3/2 of all words
MAX_REPEATS = 2
BLOCK_WORDS = 8
ROWS_PER_SHARD = 4096
SEED = "mix"


def apportion(df: DataFrame, group: str, seats: str, weight: str, order: str, name: str) -> DataFrame:
    """Deals each group's ``seats`` to its rows by Sainte-Laguë: the highest weight / (2 k + 1) come first.

    The divisor that gives all seats lies between weights / (seats + n/2) and
    weights / (seats - n/2) for n rows. Seats above the upper divisor are counted, those
    between both, about 2 n, are ranked. Ties go by ``order``.
    """
    whole = Window.partitionBy(group)
    total, rows = F.sum(weight).over(whole), F.count("*").over(whole)
    spare = F.col(seats) - rows / 2 - 1
    bounds = df.withColumn("_high", F.when(spare > 0, total / spare)).withColumn(
        "_low", total / (F.col(seats) + rows / 2 + 1)
    )
    upto = lambda divisor: F.floor(F.coalesce(F.try_divide(F.col(weight), F.col(divisor)), F.lit(0.0)) + 0.5)
    counted = bounds.withColumn("_sure", upto("_high")).withColumn("_most", upto("_low"))
    left = counted.withColumn("_left", F.col(seats) - F.sum("_sure").over(whole))
    between = left.where("_most > _sure").select(
        group, order, "_left", weight, F.explode(F.expr("sequence(_sure, _most - 1)")).alias("_seat")
    )
    rank = F.row_number().over(
        Window.partitionBy(group).orderBy(((2 * F.col("_seat") + 1) / F.col(weight)).asc(), order)
    )
    won = between.withColumn("_rank", rank).where("_rank <= _left").groupBy(group, order).agg(F.count("*").alias("_won"))
    return (
        counted.join(won, [group, order], "left")
        .withColumn(name, (F.col("_sure") + F.coalesce("_won", F.lit(0))).cast("long"))
        .select(*df.columns, name)
    )


def source_targets(
    sources: DataFrame, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = SHARE, repeats: int = MAX_REPEATS
) -> DataFrame:
    """Adds ``weight`` and ``target`` to a table of (place, source_size).

    Targets are in proportion to the weights and stop at ``repeats`` times a source's
    words; what is over goes to the other sources until none is above. Each round raises
    the words given per unit of weight, so the loop ends after at most one per source.
    """
    listed = F.array(*[F.lit(float(w)) for w in weights])
    weighted = sources.withColumn("weight", F.get(listed, ((F.col("place") - 1) % len(weights)).cast("int")))
    weighted = materialize(weighted, "weighted")
    limit = F.col("source_size") * repeats
    per_weight = 0.0
    while True:
        above = F.col("weight") * per_weight > limit
        wanted, full, open_weight = weighted.agg(
            F.sum("source_size") * share[0] / share[1],
            F.coalesce(F.sum(F.when(above, limit)), F.lit(0)),
            F.sum(F.when(~above, F.col("weight"))),
        ).first()
        level = (wanted - full) / open_weight if open_weight else per_weight
        if level <= per_weight:
            break
        per_weight = level
    return weighted.withColumn("target", F.least(F.col("weight") * per_weight, limit.cast("double")))


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: tuple[int, int] = SHARE,
    repeats: int = MAX_REPEATS,
    block: int = BLOCK_WORDS,
    rows_per_shard: int = ROWS_PER_SHARD,
    seed: str = SEED,
) -> DataFrame:
    """One row per document: doc_id, text_hash, size, source_size, target, taken (words) and copies (whole documents).

    ``copies`` rounds to documents: it counts the rounds that take the document's first word.
    Texts are read once; what follows is on the words' number. The number of shards follows
    the source's rows, so a source of any size is spread over many tasks.
    """
    sized = docs.select(
        "doc_id",
        text_hash(),
        "source",
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id"))).alias("_draw"),
    )
    sized = materialize(sized, "sized")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_rows"))
    # One row per source, not per document: a window and a join with a table of this size.
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    sources = source_targets(sources.withColumn("place", place), weights, share, repeats)
    words = F.sum("source_size").over(Window.partitionBy("_all")) * min(share[0], repeats * share[1]) / share[1]
    sources = sources.withColumn("_all", F.lit(0)).withColumn("_seats", F.floor(words / block + 0.5))
    dealt = materialize(apportion(sources, "_all", "_seats", "target", "place", "quota"), "source-quotas")

    shards = F.ceil(F.col("_rows") / rows_per_shard)
    number = F.conv(F.substring("_draw", 1, 8), 16, 10).cast("long")
    known = dealt.select(F.col("source").alias("_source"), "place", "source_size", "target", "quota", "_rows")
    placed = sized.join(known, F.col("source").eqNullSafe(F.col("_source"))).withColumn("shard", F.pmod(number, shards))

    cells = placed.groupBy("place", "shard").agg(F.sum("size").alias("_words"), F.first("quota").alias("quota"))
    cells = apportion(cells.withColumn("_weight", F.col("_words").cast("double")), "place", "quota", "_weight", "shard", "_blocks")
    drawn = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), "place", "shard")), 1, 8), 16, 10).cast("long")
    first = F.pmod(drawn, F.greatest(F.ceil(F.col("_words") / block), F.lit(1))) * block
    take = F.least(F.col("_blocks") * block, F.col("_words") * repeats)
    cells = cells.select(
        "place",
        "shard",
        "_words",
        first.alias("_first"),
        F.floor(take / F.greatest("_words", F.lit(1))).alias("_rounds"),
        (take % F.greatest("_words", F.lit(1))).alias("_rest"),
    )

    inside = Window.partitionBy("place", "shard").orderBy("_draw", "doc_id", "size")
    runs = placed.withColumn("_end", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    runs = runs.withColumn("_start", F.col("_end") - F.col("size")).join(cells, ["place", "shard"])
    last = F.col("_first") + F.col("_rest")
    common = lambda a, b: F.greatest(F.least(F.col("_end"), b) - F.greatest(F.col("_start"), a), F.lit(0))
    partial = common(F.col("_first"), F.least(last, "_words")) + common(F.lit(0), last - F.col("_words"))
    begins = ((F.col("_start") >= F.col("_first")) & (F.col("_start") < last)) | (F.col("_start") < last - F.col("_words"))
    return runs.select(
        "doc_id",
        "text_hash",
        "size",
        "source_size",
        "target",
        (F.col("_rounds") * F.col("size") + partial).cast("long").alias("taken"),
        (F.col("_rounds") + F.when(begins & (F.col("size") > 0), 1).otherwise(0)).cast("int").alias("copies"),
    )
