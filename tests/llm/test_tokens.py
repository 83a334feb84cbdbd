"""Token counts and token output against the libraries on whole texts."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm.conftest import ODD
from rowmend.llm import rows, token_counts, token_output, tokenizing
from rowmend.llm.rows import small_batches
from rowmend.sources.storage import new_path

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
BITS = list("ab cd'st ., \n\t\r!?)(;:0129é ÉñßøɏλΩ中   \x1c\x85​▁-_<|>") + [
    "<|endoftext|>", " the", "'re", "  ", "\n\n", "ﬁ", "😀", "<s>", "</s>", "é",
]


def texts(n, seed=2):
    rng = random.Random(seed)
    return ["".join(rng.choices(BITS, k=rng.randint(0, 30))) for _ in range(n)]


def test_pieces_give_the_ids_of_whole_texts():
    library = Tokenizer.from_file(BYTES)
    encoder = tokenizing.IdEncoder(BYTES)
    assert encoder.cuts and encoder.width == 2
    some = texts(4000)
    got = [np.frombuffer(ids, "<u2").tolist() for ids in encoder.encode(some)]
    assert got == [e.ids for e in library.encode_batch(some, add_special_tokens=False)]


def test_ids_of_pieces_without_space_and_case():
    path = public_tokenizers.path("word_bpe_49k.json")
    library, encoder = Tokenizer.from_file(path), tokenizing.IdEncoder(path)
    assert encoder.drops and not encoder.cuts
    some = texts(4000, 6) + ["İstanbul ΣΑΣ Σας", "a\u00a0b\u2003c", "e\u0301 E\u0301 \u0301x", "DON'T, we'll.", "<|endoftext|> <|STARTOFTEXT|>x"]
    got = [np.frombuffer(ids, "<u2").tolist() for ids in encoder.encode(some)]
    assert got == [e.ids for e in library.encode_batch(some, add_special_tokens=False)]


@pytest.mark.parametrize("path", [PIECES, BYTES, public_tokenizers.path("word_bpe_49k.json")])
def test_counts_of_pieces(path):
    some = texts(3000, 3)
    if path.endswith(".json"):
        wanted = [len(e.ids) for e in Tokenizer.from_file(path).encode_batch(some, add_special_tokens=False)]
    else:
        wanted = [len(ids) for ids in sentencepiece.SentencePieceProcessor(model_file=path).encode(some)]
    assert list(tokenizing.IdCounter(path).count(some)) == wanted


def test_cache_of_pieces_is_bounded(monkeypatch):
    monkeypatch.setattr(tokenizing, "CACHED_PIECES", 50)
    monkeypatch.setattr(tokenizing, "BATCH_CHARS", 100)
    counter, some = tokenizing.IdCounter(PIECES), texts(500, 5)
    wanted = [len(ids) for ids in counter.model.encode(some)]
    assert list(counter.count(some)) == wanted and len(counter.known) < 200


def test_token_counts(spark, odd, empty):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = token_counts.count_tokens(odd, PIECES, limit=20).collect()
    wanted = [(d[0], len((d[1] or "").encode()), len(library.encode(d[1] or "")), len(library.encode(d[1] or "")) > 20) for d in ODD]
    assert sorted(map(tuple, got), key=repr) == sorted(wanted, key=repr)
    assert token_counts.count_tokens(empty, PIECES).count() == 0


def test_only_misses_are_encoded_and_appended(spark, make):
    cache = new_path(spark, "cache")
    token_counts.count_tokens(make(["a b", "a b", "c"]), PIECES, cache).collect()
    first = spark.read.parquet(cache)
    assert first.count() == 2
    # Stored counts are used: a wrong one comes back.
    digest = F.unhex(F.sha2(F.lit("d"), 256))
    wrong = spark.range(1).select(F.lit(token_counts.tokenizer_version(PIECES)).alias("version"), digest.alias("digest"), F.lit(77).cast("long").alias("n_tokens"))
    wrong.write.mode("append").parquet(cache)
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(make(["c", "d", "new", None]), PIECES, cache).collect()}
    assert got[1] == 77 and got[3] == 0
    stored = spark.read.parquet(cache)
    assert stored.count() == 2 + 1 + 2 and stored.select("digest").distinct().count() == 5
    # Another tokenizer does not see these counts.
    other = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(make(["d"]), BYTES, cache).collect()}
    assert other[0] == 1


def written(docs):
    library = Tokenizer.from_file(BYTES)
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    ids = [[*library.encode(t, add_special_tokens=False).ids, 0] for _, t in rows]
    return [(d, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for (d, _), i in zip(rows, ids)]


def check(docs):
    read = token_output.token_output(docs, BYTES).orderBy("start").collect()
    assert sorted(((r["doc_id"], r["n_ids"], zlib.crc32(r["ids"])) for r in read), key=repr) == sorted(written(docs), key=repr)
    ids = [r["doc_id"] for r in read]
    assert ids == sorted(ids, key=lambda d: (d is not None, d))
    assert [r["start"] for r in read] == [sum(x["n_ids"] for x in read[:i]) for i in range(len(read))]


def test_round_trip(make, odd, empty, monkeypatch):
    monkeypatch.setattr(token_output, "SEGMENT_BYTES", 300)
    check(make([f"{t} {i % 7} some words that repeat in many documents" for i, t in enumerate(texts(300, 8))]))
    check(odd)
    assert token_output.token_output(empty, BYTES).count() == 0


def test_the_dictionary_follows_from_the_documents_alone(spark, make, monkeypatch):
    """However the rows lie, and with more documents than are drawn."""
    monkeypatch.setattr(token_output, "SAMPLE_DOCS", 60)
    docs = make([f"the {i} words of a text that is like the others {i * i} and some more of them" for i in range(300)] + [None, ""])
    first, second = (token_output.train_dictionary(d.select("doc_id", "text"), BYTES, 60) for d in (docs.repartition(3), docs.orderBy("n_chars", "text").repartition(7)))
    assert first and first == second


def test_cache_of_ids_is_bounded(monkeypatch):
    monkeypatch.setattr(tokenizing, "CACHED_PIECES", 40)
    encoder, library = tokenizing.IdEncoder(BYTES), Tokenizer.from_file(BYTES)
    some = texts(600, 9)
    assert [np.frombuffer(i, "<u2").tolist() for i in encoder.encode(some)] == [e.ids for e in library.encode_batch(some, add_special_tokens=False)]
    assert len(encoder.known.known) <= 41 and len(encoder.known.older) <= 41


def test_single_documents_and_the_dictionary(spark, make):
    docs = make([f"the {i} words of a text that is like the others {i * i}" for i in range(400)])
    path = new_path(spark, "tokens")
    token_output.write_tokens(docs, BYTES, path)
    dictionary = spark.read.parquet(f"{path}/dictionary").first()
    assert len(dictionary["content"]) > 1000
    segment = spark.read.parquet(f"{path}/segments").orderBy("part", "seq").first()
    assert segment["dictionary"] == dictionary["digest"] and segment["first"] == 0
    whole = {r["doc_id"]: r["ids"] for r in token_output.read_tokens(spark, path).collect()}
    index = np.frombuffer(segment["index"], token_output.ENTRY)
    for place in (0, len(index) // 2, len(index) - 1):
        ids = token_output.read_document(segment, place, bytes(dictionary["content"]))
        assert ids.astype("<u4").tobytes() == whole[int(index["doc_id"][place])]
    plain = token_output._compressor(b"")
    assert len(segment["frames"]) < sum(len(plain.compress(np.frombuffer(w, "<u4").astype("<u2").tobytes())) for w in whole.values())


def test_less_memory_gives_the_same_ids(make):
    docs = make(texts(60, 8) + [" ".join(texts(300, 9))])
    wanted = sorted(tuple(r) for r in token_output.token_output(docs, BYTES).collect())
    assert sorted(tuple(r) for r in token_output.token_output(docs, BYTES, cached=20, at_once=3).collect()) == wanted
    assert tokenizing.loaded(tokenizing.IdEncoder, BYTES, 20).known.most == 20


def test_small_batches_hold_meanwhile(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)

    def sizes(parts):
        for part in parts:
            yield pa.RecordBatch.from_arrays([pa.array([part.num_rows])], ["n"])

    rows_in = spark.range(0, 1000, numPartitions=1)
    with small_batches(spark, 300):
        assert sorted(r["n"] for r in rows_in.mapInArrow(sizes, "n bigint").collect()) == [100, 300, 300, 300]
    with pytest.raises(ValueError), small_batches(spark, 10**9):
        assert spark.conf.get(name) == before
        raise ValueError
    assert spark.conf.get(name) == before


def test_reading_has_few_documents_in_hand(make, monkeypatch):
    """A segment of many documents is read back a few at a time, by a worker without tokenizers."""
    read = token_output.token_output(make(texts(40)), BYTES).orderBy("start").collect()
    frames = [token_output._compressor(b"").compress(np.frombuffer(r["ids"], "<u4").astype("<u2").tobytes()) for r in read]
    packed = pa.table({"doc_id": [r["doc_id"] for r in read], "n_ids": [r["n_ids"] for r in read], "frame": pa.array(frames, pa.binary())})
    monkeypatch.setattr(token_output.TaskContext, "get", classmethod(lambda cls: type("Task", (), {"partitionId": lambda self: 0})()))
    segments = pa.Table.from_batches(token_output._segments("d", 2)(iter(packed.to_batches())))
    assert segments.num_rows == 1
    monkeypatch.setattr(token_output, "READ_AT_ONCE", 7)
    tokenizing.loaded(tokenizing.IdEncoder, BYTES)
    parts = list(token_output._documents(b"", "d")(iter(segments.append_column("start", pa.array([0])).to_batches())))
    assert [p.num_rows for p in parts] == [7, 7, 7, 7, 7, 5] and list(rows._KEPT) == ["segments"]
    assert pa.Table.from_batches(parts).to_pylist() == [r.asDict() | {"ids": bytes(r["ids"])} for r in read]
