"""Token counts by a digest cache: texts whose count is stored are not encoded again.

The cache is a Parquet table (version, digest, n_tokens). ``version`` is the digest of the
tokenizer file and the library's version, ``digest`` that of the content. Content is
normalised only by what cannot change a count: a null is the empty text. Digests of the
corpus that the cache lacks are found by an anti join of digests alone; then one text of each
is fetched and encoded, and the counts are appended. Afterwards every document joins the cache.

Nulls: a null text counts as empty, a null doc_id is an id. Repeated rows each get their count;
a text whose rows also agree in doc_id may be encoded by several tasks, with the same result.
An empty table appends nothing and gives no rows. A very long text is hashed and encoded whole.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from importlib.metadata import version as installed

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmend.llm.rows import sized, small
from rowmend.llm.tokenizing import IdCounter, loaded
from rowmend.sources.storage import materialize, new_path

LIMIT = 4096
REMEMBERED = 100_000  # digests a task has in hand
CACHE = "version string, digest binary, n_tokens bigint"


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer's file with the version of its library. The file is the same on all machines."""
    library = "tokenizers" if path.endswith(".json") else "sentencepiece"
    with open(path, "rb") as file:
        return hashlib.sha256(file.read() + f"{library} {installed(library)}".encode()).hexdigest()


def read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """(digest, n_tokens) of one version; empty if nothing was stored there yet."""
    place = spark._jvm.org.apache.hadoop.fs.Path(cache)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], CACHE).select("digest", "n_tokens")
    return spark.read.schema(CACHE).parquet(cache).where(F.col("version") == version).select("digest", "n_tokens")


def _counts(path: str):
    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, done = loaded(IdCounter, path), set()
        for part in small(parts):
            # Equal rows of one id all come here; a task encodes a text once, as long as it remembers its digest.
            digests = part.column("digest").to_pylist()
            fresh = {d: k for k, d in enumerate(digests) if d not in done}
            done = done.union(fresh) if len(done) < REMEMBERED else set(fresh)
            texts = part.column("text").take(pa.array(list(fresh.values()), pa.int64())).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array(list(fresh), pa.binary()), pa.array(list(counter.count(texts)), pa.int64())], ["digest", "n_tokens"])
        counter.rest()

    return count


def count_tokens(docs: DataFrame, tokenizer: str, cache: str | None = None, limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit. Without ``cache`` it starts from an empty one."""
    spark = docs.sparkSession
    cache = cache or new_path(spark, "token-counts")
    version = tokenizer_version(tokenizer)
    text = F.coalesce("text", F.lit(""))
    content = docs.select(F.col("doc_id").cast("string").alias("id"), "doc_id", text.alias("text"), F.unhex(F.sha2(text, 256)).alias("digest"))
    stored = read_cache(spark, cache, version)
    # Digests alone are grouped and looked up; each miss names one of its documents, and only their texts are fetched.
    named = content.select("digest", F.coalesce("id", F.lit("")).alias("id")).groupBy("digest").agg(F.min("id").alias("first"))
    misses = materialize(named.join(stored, "digest", "left_anti"), "misses")
    fetched = content.join(sized(misses), "digest").where(F.coalesce("id", F.lit("")) == F.col("first")).select("digest", "text")
    encoded = fetched.mapInArrow(_counts(tokenizer), "digest binary, n_tokens bigint")
    encoded.select(F.lit(version).alias("version"), "digest", "n_tokens").write.mode("append").parquet(cache)

    # Writers that ran at the same time may both have stored a count; it is the same one.
    counts = materialize(read_cache(spark, cache, version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")), "counts")
    measured = content.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "digest")
    return measured.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
