"""From documents to token ids: known languages, one of each near-duplicate group, no benchmark text, mixed sources.

Each stage takes the documents its predecessor kept and returns documents; the last one
returns what it wrote. Nulls, empty tables and other columns are handled as each operator
says; rows keep all their columns up to the last stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmend.llm import decontaminate, jaccard, language, mixing, rows, token_output
from rowmend.sources.storage import materialize

LEAST_SCORE = 0.1  # of a language; a text that is in none of them has score 0
SHINGLE_WORDS = 5
PERCENT = 80
TOKENIZER = "byte_bpe_50k.json"
# Pieces a worker keeps, documents it has in hand and rows it is sent: fewer than by default, as it works beside a heap that earlier stages have filled.
CACHED, AT_ONCE, BATCH = 60_000, 250, 1000


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or in no language, go."""
    return language.known_language(docs, LEAST_SCORE)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by Jaccard similarity the one with the smallest id stays."""
    return jaccard.one_per_component(docs, SHINGLE_WORDS, PERCENT)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the contamination rule names go."""
    found = decontaminate.benchmark_hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return rows.without(docs, found.where("contaminated").select(rows.row_key()).distinct())


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, to whole documents."""
    taken = mixing.mix_sources(docs).groupBy(rows.row_key()).agg(F.sum("copies").cast("int").alias("copies"))
    return rows.repeated(docs, materialize(taken, "copies"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids written as binary output and read back from there."""
    with rows.small_batches(spark, BATCH):
        read = token_output.token_output(docs, public_tokenizers.path(TOKENIZER), cached=CACHED, at_once=AT_ONCE)
    return read.select("doc_id", "start", F.col("n_ids").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


STAGES = [
    ("language_id", known_language),
    ("jaccard_join", one_of_each_group),
    ("decontamination", clean_of_benchmark),
    ("mixing", mixed),
    ("token_output", token_ids),
]

# Support vector machines and a tokenizer have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again before the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
SQL = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
