"""Token ids as binary output: each document compressed by itself with one shared dictionary.

The output is a Parquet table of segments in ascending doc_id order, written by Spark's
writers so that a lost executor or a repeated task leaves no half file. A segment holds

* ``frames``: one zstandard frame per document, of its ids as little-endian integers,
* ``index``: per document its id, the frame's offset and the number of ids,
* ``dictionary``: digest of the shared dictionary; the dictionary lies in a table beside,
* ``first``: how many ids its part, one written file, holds before it.

A single document is read by its index entry and its frame alone. The dictionary is
trained on a bounded sample of documents (SAMPLE_DOCS, one stretch of SAMPLE_IDS ids of
each); a sample too small to train on gives none, and frames are then plain.

Nulls: a null text is empty and has only the end id; a null doc_id comes first. Documents
of one id follow each other by number of ids and content. An empty table gives an empty
output. Other columns are ignored. A very long text is encoded whole and is one frame, in a
segment that ends with it.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowmend.llm.rows import release, small, worker_cache
from rowmend.llm.tokenizing import IdEncoder, loaded
from rowmend.sources.storage import materialize, new_path

END_ID = 0
LEVEL = 3
DICTIONARY_BYTES = 1 << 16
SAMPLE_DOCS = 1000
SAMPLE_IDS = 4096
SEGMENT_BYTES = 4 << 20
ENCODED_AT_ONCE = 4000  # documents whose pieces are looked up together
READ_AT_ONCE = 250  # documents whose ids a reading worker has in hand

ENTRY = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("offset", "<u8"), ("n_ids", "<u4")])
ENCODED = "doc_id bigint, n_ids bigint, frame binary"
SEGMENTS = "part int, seq bigint, first bigint, dictionary string, width int, n_docs bigint, n_ids bigint, index binary, frames binary"
DOCUMENTS = "doc_id bigint, start bigint, n_ids bigint, ids binary"


def _with_end(encoder: IdEncoder, texts: list) -> Iterator[bytes]:
    end = END_ID.to_bytes(encoder.width, "little")
    for ids in encoder.encode([t or "" for t in texts]):
        yield ids + end


def _stretch(tokenizer: str, cached: int | None):
    """A stretch of each document's ids to train on; the digest of its ids says where."""

    def take(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = loaded(IdEncoder, tokenizer, cached)
        size = SAMPLE_IDS * encoder.width
        for part in small(parts):
            taken = []
            for ids in _with_end(encoder, part.column("text").to_pylist()):
                first = zlib.crc32(ids) % (len(ids) // size + 1) * size
                taken.append(ids[first : first + size])
            yield pa.RecordBatch.from_arrays([pa.array(taken, pa.binary())], ["ids"])

    return take


def train_dictionary(docs: DataFrame, tokenizer: str, sample: int = SAMPLE_DOCS, cached: int | None = None) -> bytes:
    """The shared dictionary, of at most DICTIONARY_BYTES; empty if the sample is too small."""
    # The documents with the smallest hashes of id and text, whatever order they are read in.
    picked = docs.select("text", F.xxhash64("doc_id", "text").alias("place")).orderBy("place", "text").limit(sample).select("text")
    samples = sorted(bytes(r["ids"]) for r in picked.mapInArrow(_stretch(tokenizer, cached), "ids binary").collect())
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    if not dictionary:
        return zstandard.ZstdCompressor(level=LEVEL)
    shared = zstandard.ZstdCompressionDict(dictionary)
    shared.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)


def _decompressor(dictionary: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary else zstandard.ZstdDecompressor()


def _encoded(tokenizer: str, dictionary: bytes, cached: int | None, at_once: int):
    def encode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, compressor = loaded(IdEncoder, tokenizer, cached), _compressor(dictionary)
        for part in small(parts, at_once):
            counts, frames = [], []
            for ids in _with_end(encoder, part.column("text").to_pylist()):
                counts.append(len(ids) // encoder.width)
                frames.append(compressor.compress(ids))
            columns = [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(frames, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_ids", "frame"])
        encoder.rest()

    return encode


def _segments(digest: str, width: int):
    """Packs sorted documents into segments of about SEGMENT_BYTES."""
    fields = pa.schema(
        [("part", pa.int32()), ("seq", pa.int64()), ("first", pa.int64()), ("dictionary", pa.string()), ("width", pa.int32())]
        + [("n_docs", pa.int64()), ("n_ids", pa.int64()), ("index", pa.binary()), ("frames", pa.binary())]
    )

    def pack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("segments")  # no tokenizer beside what is packed
        part_id, seq, first = TaskContext.get().partitionId(), 0, 0
        entries: list[tuple] = []
        frames: list[bytes] = []
        held = 0

        def segment() -> pa.RecordBatch:
            index = np.array(entries, ENTRY)
            row = [part_id, seq, first, digest, width, len(entries), int(index["n_ids"].sum()), index.tobytes(), b"".join(frames)]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, fields)], schema=fields)

        for part in parts:
            for doc_id, n_ids, frame in zip(*[part.column(c).to_pylist() for c in ("doc_id", "n_ids", "frame")]):
                entries.append((doc_id or 0, doc_id is None, held, n_ids))
                frames.append(frame)
                held += len(frame)
                if held >= SEGMENT_BYTES:
                    yield segment()
                    first += sum(e[3] for e in entries)
                    entries, frames, held, seq = [], [], 0, seq + 1
        if entries:
            yield segment()

    return pack


def write_tokens(docs: DataFrame, tokenizer: str, path: str, cached: int | None = None, at_once: int = ENCODED_AT_ONCE) -> None:
    """Writes ``path``/segments and ``path``/dictionary.

    Pieces kept by a worker (``cached``) and documents in hand (``at_once``) trade its time for its memory; the ids are the same.
    """
    spark = docs.sparkSession
    texts = docs.select("doc_id", "text")
    dictionary = train_dictionary(texts, tokenizer, cached=cached)
    digest, width = hashlib.sha256(dictionary).hexdigest(), loaded(IdEncoder, tokenizer, cached).width
    # Not by createDataFrame, whose rows go through Python workers of a kind of their own, which then wait beside the others.
    spark.range(1, numPartitions=1).select(F.lit(digest).alias("digest"), F.lit(dictionary).alias("content")).write.parquet(f"{path}/dictionary")
    # Kept before the sort, which looks at its input twice.
    encoded = materialize(texts.mapInArrow(_encoded(tokenizer, dictionary, cached, at_once), ENCODED), "frames")
    in_order = ["doc_id", "n_ids", "frame"]
    ranged = encoded.repartitionByRange(*in_order).sortWithinPartitions(*in_order)
    ranged.mapInArrow(_segments(digest, width), SEGMENTS).write.parquet(f"{path}/segments")


def read_document(segment, place: int, dictionary: bytes) -> np.ndarray:
    """Ids of one document of a segment row: only its index entry and its frame are looked at."""
    entry = np.frombuffer(segment["index"], ENTRY, count=1, offset=place * ENTRY.itemsize)[0]
    frame = memoryview(segment["frames"])[int(entry["offset"]) :]
    reader = _decompressor(dictionary).decompressobj()
    return np.frombuffer(reader.decompress(frame), f"<u{segment['width']}")


def _documents(dictionary: bytes, digest: str):
    def unpack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("segments")
        reader = _decompressor(dictionary)
        for part in parts:
            for row in range(part.num_rows):
                segment = part.slice(row, 1).to_pylist()[0]
                if segment["dictionary"] != digest:
                    raise ValueError(f"segment {segment['part']}/{segment['seq']} was written with another dictionary")
                index, frames = np.frombuffer(segment["index"], ENTRY), memoryview(segment["frames"])
                stops = [*index["offset"][1:].tolist(), len(frames)]
                counts = index["n_ids"].astype(np.int64)
                starts = segment["start"] + np.cumsum(counts) - counts
                places = list(zip(index["offset"].tolist(), stops))
                for first in range(0, len(places), READ_AT_ONCE):
                    some = slice(first, first + READ_AT_ONCE)
                    ids = [np.frombuffer(reader.decompress(frames[a:b]), f"<u{segment['width']}").astype("<u4").tobytes() for a, b in places[some]]
                    columns = [
                        pa.array(index["doc_id"][some], pa.int64(), mask=index["null"][some].astype(bool)),
                        pa.array(starts[some]),
                        pa.array(counts[some]),
                        pa.array(ids, pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_ids", "ids"])
        release()

    return unpack


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: doc_id, start (ids of all documents before it), n_ids, ids (unsigned 32-bit little-endian)."""
    digest, dictionary = spark.read.parquet(f"{path}/dictionary").first()
    segments = spark.read.schema(SEGMENTS).parquet(f"{path}/segments")
    # One row per written file: small enough for one window and a broadcast.
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    placed = segments.join(F.broadcast(parts), "part").withColumn("start", F.col("before") + F.col("first"))
    wanted = placed.select("part", "seq", "dictionary", "width", "start", "index", "frames")
    return wanted.mapInArrow(_documents(bytes(dictionary), digest), DOCUMENTS)


def token_output(
    docs: DataFrame, tokenizer: str, path: str | None = None, cached: int | None = None, at_once: int = ENCODED_AT_ONCE
) -> DataFrame:
    """Writes the documents' ids and reads them back from there."""
    path = path or new_path(docs.sparkSession, "tokens")
    write_tokens(docs, tokenizer, path, cached, at_once)
    return read_tokens(docs.sparkSession, path)
