"""Benchmark decontamination: documents that contain a window of consecutive benchmark words.

A window is 13 consecutive words of an item; an item of fewer words is one window. A
document contains a window only if it contains each of its shingles (three words, or the
whole window if shorter). As all are needed, a prefix of one shingle per window suffices:
its rarest one over all documents, of equally rare ones the first in the window. Places of that shingle whose window would stick out
of the document are left out, and the others are verified word by word.

Nulls: a null text has no words; a null item id counts as the empty id. Items of one id
count once, repeated documents and ids are each judged on their own. Empty tables give no
rows, or documents without hits. Of a very long text no more than the places that hold a
shingle of the benchmark leave the first pass. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowmend.llm.rows import text_hash
from rowmend.sources.storage import materialize

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER = "abcdefghijklmnopqrstuvwxyz"
WINDOW_WORDS = 13
SHINGLE_WORDS = 3
SHARE = 20  # contaminated from one hit word in so many
BROADCAST_ROWS = 1_000_000  # shingles or windows of a benchmark that go to all executors; more are shuffled


def words(text: Column) -> Column:
    """ASCII letters in lower case, no others: what is not ASCII is kept as it is."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), LOWER.upper(), LOWER), F.lit(WORD), F.lit(0))


def shingles(said: Column, n: int) -> Column:
    """Each place's n words, joined by blanks, which no word contains."""
    none = F.array().cast("array<struct<at:int,n:int,gram:string>>")

    def at(i: Column) -> Column:
        joined = F.concat_ws(" ", *[F.get(said, i + k) for k in range(n)])
        return F.struct(i.alias("at"), F.lit(n).alias("n"), joined.alias("gram"))

    return F.when(F.size(said) >= n, F.transform(F.sequence(F.lit(0), F.size(said) - n), at)).otherwise(none)


def benchmark_windows(benchmark: DataFrame, size: int = WINDOW_WORDS) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (window, words, grams) and which items have them (item, window)."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words(F.col("text")).alias("said"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("said") - size + 1, F.lit(1)))
    cut = F.transform(starts, lambda i: F.slice("said", i, F.lit(size)))
    cut = items.where(F.size("said") > 0).select("item", F.explode(cut).alias("part"))
    cut = materialize(cut.withColumn("text", F.array_join("part", " ")).distinct(), "items")
    distinct = cut.groupBy("text").agg(F.first("part").alias("part")).withColumn("window", F.monotonically_increasing_id())
    own = [F.when(F.size("part") == n, shingles(F.col("part"), n)) for n in range(1, SHINGLE_WORDS)]
    grams = F.coalesce(*own, shingles(F.col("part"), SHINGLE_WORDS))
    distinct = materialize(distinct.select("window", "text", F.size("part").alias("words"), grams.alias("grams")), "windows")
    return distinct.drop("text"), materialize(cut.join(distinct.select("text", "window"), "text").select("item", "window"), "items")


def benchmark_hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: doc_id, text_hash, n_words, n_hit, items (sorted ids of items that occur), contaminated.

    Texts are read once. What leaves that pass is a row per document and a row per place that
    holds a shingle of the benchmark.
    """
    windows, items = benchmark_windows(benchmark)
    grams = windows.select(F.explode("grams").alias("g")).select("g.n", "g.gram").distinct()
    sizes = sorted(r["n"] for r in grams.select("n").distinct().collect())  # of 1, 2 and 3
    small = grams.count() <= BROADCAST_ROWS
    spread = F.broadcast if small else (lambda df: df)

    # The empty shingle stands for the document itself; it brings the number of words.
    always = grams.sparkSession.range(1).select(F.lit("").alias("gram"))
    said = docs.select("doc_id", text_hash(), F.monotonically_increasing_id().alias("row"), words(F.col("text")).alias("said"))
    whole = F.array(F.struct(F.size("said").alias("at"), F.lit(0).alias("n"), F.lit("").alias("gram")))
    places = F.concat(whole, *[shingles(F.col("said"), n) for n in sizes])
    rows = said.select("doc_id", "text_hash", "row", F.explode(places).alias("p"))
    rows = rows.select("doc_id", "text_hash", "row", "p.at", "p.n", "p.gram")
    seen = materialize(rows.join(spread(grams.select("gram").union(always)), "gram", "left_semi"), "shingles")

    texts = seen.where("n = 0").select("row", "doc_id", "text_hash", F.col("at").cast("long").alias("n_words"))
    hits = seen.where("n > 0").select("row", "n", "at", "gram")
    in_order = Window.partitionBy("row", "n").orderBy("at")
    hits = materialize(hits.withColumn("place", F.row_number().over(in_order)), "hits")

    # The rarest shingle of each window; a window with a shingle that no document has cannot occur.
    counts = hits.groupBy("gram").agg(F.count("*").alias("times"))
    listed = windows.select("window", "words", "grams", F.explode("grams").alias("g")).select(
        "window", "words", "grams", F.col("g.at").alias("offset"), F.col("g.gram").alias("gram")
    )
    rare = Window.partitionBy("window").orderBy(F.coalesce("times", F.lit(0)), "offset")
    prefix = listed.join(counts, "gram", "left").withColumn("nr", F.row_number().over(rare))
    prefix = materialize(prefix.where("nr = 1 AND times > 0").drop("nr", "times"), "prefixes")

    begun = hits.join(spread(prefix), "gram").join(texts.select("row", "n_words"), "row")
    begun = begun.withColumn("start", F.col("at") - F.col("offset"))
    begun = begun.where("start >= 0 AND start + words <= n_words")
    own = hits.groupBy("row", "n").agg(F.sort_array(F.collect_list(F.struct("at", "gram"))).alias("own"))
    # Places that follow each other in the text follow each other in the list, if all are there.
    found = F.slice("own", F.col("place") - F.col("offset"), F.size("grams"))
    same = F.transform(found, lambda f: F.struct(f["at"], f["gram"])) == F.transform(
        "grams", lambda g: F.struct((g["at"] + F.col("start")).alias("at"), g["gram"])
    )
    inside = begun.where(F.col("place") > F.col("offset")).join(own, ["row", "n"]).where(same)
    inside = materialize(inside.select("row", "window", "start", (F.col("start") + F.col("words")).alias("stop")), "occurrences")

    before = Window.partitionBy("row").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.col("stop") - F.greatest("start", F.coalesce(F.max("stop").over(before), F.lit(0))), F.lit(0))
    covered = inside.select("row", "start", "stop").distinct().withColumn("fresh", fresh)
    covered = covered.groupBy("row").agg(F.sum("fresh").alias("n_hit"))
    named = inside.select("row", "window").distinct().join(items, "window").groupBy("row")
    named = named.agg(F.sort_array(F.collect_set("item")).alias("items"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return (
        texts.join(covered, "row", "left")
        .join(named, "row", "left")
        .select(
            "doc_id",
            "text_hash",
            "n_words",
            n_hit.alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            ((n_hit > 0) & (n_hit * SHARE >= F.col("n_words"))).alias("contaminated"),
        )
    )
