"""Language ID: held-out accuracy, and odd tables."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from corpus_pipeline import LEAST_SCORE
from llm.conftest import DOCS, LONG, ODD, document
from rowmend.llm import language, rows

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: r for r in language.identify(docs).collect()}
    right = [got[r["doc_id"]]["lang_pred"] == r["lang"] for r in docs.collect() if got[r["doc_id"]]["held_out"]]
    assert len(right) > 250 and np.mean(right) >= 0.98
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_labels_and_sources_are_no_input(spark):
    """Held-out rows get the same answer whatever their label says, and so do other columns."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300)
    model = language.fit(docs)
    first = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(docs, model).collect()}
    blank = docs.selectExpr("doc_id", "text", "string(null) lang", "'x' source")
    assert first == {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(blank, model).collect()}
    assert model.families == ["germanic", "romance"] and ("de", "en") in model.pairs and ("es", "fr") in model.pairs


def test_odd_tables(spark, odd, empty):
    got = language.identify(odd).collect()
    assert len(got) == len(ODD)
    none = {1, 2, 3, 8}
    assert {r["doc_id"] for r in got if r["lang_pred"] == language.UNKNOWN} == none
    assert all(r["score"] == 0 for r in got if r["doc_id"] in none)
    assert language.identify(empty).count() == 0
    unlabelled = spark.createDataFrame([document(1, "some text", None)], DOCS)
    assert language.identify(unlabelled).first()["lang_pred"] == language.UNKNOWN


def test_one_language(spark):
    docs = spark.createDataFrame([document(i, f"words of one kind {i}", "xx") for i in range(9)], DOCS)
    assert {r["lang_pred"] for r in language.identify(docs).collect()} == {"xx"}


def test_chunks_count_like_the_whole(monkeypatch):
    text = LONG[:50_000] + "Ünï 中文 123 " * 50
    whole = language.counts(text)
    monkeypatch.setattr(language, "CHUNK", 997)
    chunked = language.counts(text)
    # A chunk's edge repeats up to two letters of the one before.
    assert np.abs(whole - chunked).sum() <= 12 * (len(text) // 997 + 1)


def test_svm_separates():
    rng = np.random.default_rng(0)
    rows = np.vstack([rng.normal(1, 0.3, (40, 5)), rng.normal(-1, 0.3, (10, 5))]).astype(np.float32)
    weights = language.linear_svm(rows, np.arange(50) < 40)
    assert (((rows @ weights[:-1] + weights[-1]) > 0) == (np.arange(50) < 40)).all()
    some = np.arange(50) % 3 > 0
    assert np.array_equal(language.linear_svm(rows, np.arange(50) < 40, some), language.linear_svm(rows[some], (np.arange(50) < 40)[some]))


def test_unknown_documents_go_and_columns_stay(spark, odd):
    kept = language.known_language(odd, 0.0)
    assert kept.columns == odd.columns
    assert {r["doc_id"] for r in kept.collect()} == {4, 5, None, 6, 7, 9}


def test_texts_in_no_language_go_and_clean_ones_stay(spark):
    """Random strings of three words or more and scripts that were not learned, against held-out documents and their first words."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rng = random.Random(3)
    scripts = ("abcdefghijklmnopqrstuvwxyz", "αβγδεζηθικλμνξοπρστυφχψω", "абвгдежзийклмнопрстуфхцч", "".join(map(chr, range(0x4E00, 0x5000))))
    said = lambda abc, n: " ".join("".join(rng.choices(abc, k=rng.randint(5, 10))) for _ in range(n))
    foreign = ["中文", *[said(abc, n) for k, abc in enumerate(scripts) for n in (1 if k else 3, 20, 500) for _ in range(10)]]
    held = docs.where(language.held_out(F.col("doc_id"))).limit(200).collect()
    short = [" ".join(r["text"].split()[:n]) for r in held for n in (1, 2, 3)]
    short = [t for t in short if any(map(str.isalpha, t))]
    added = [(10**6 + i, t) for i, t in enumerate(foreign)] + [(2 * 10**6 + i, t) for i, t in enumerate(short)]
    planted = spark.createDataFrame(added, "doc_id bigint, text string")
    kept = {r["doc_id"] for r in language.known_language(docs.unionByName(planted, allowMissingColumns=True), LEAST_SCORE).collect()}
    assert not [t for i, t in added if i < 2 * 10**6 and i in kept]
    assert len(short) > 500 and not [t for i, t in added if i >= 2 * 10**6 and i not in kept]
    assert {r["doc_id"] for r in docs.collect()} <= kept


def test_every_label_is_learned(spark, monkeypatch):
    """More labels than ever had a place, and a frequent one among them."""
    monkeypatch.setattr(language, "linear_svm", lambda rows, positive, chosen=None: np.zeros(rows.shape[1] + 1))
    labels = [f"l{i // 2}" for i in range(1000)] + ["frequent"] * 3000
    docs = spark.createDataFrame([document(i, f"some words of {lang}", lang) for i, lang in enumerate(labels)], DOCS)
    model = language.fit(docs)
    assert set(model.known) == {lang for i, lang in enumerate(labels) if zlib.crc32(str(i).encode()) % 3 != 1}


def test_repeated_rows_crowd_out_no_label(spark):
    """40,000 equal rows of one label beside 60 documents of another."""
    many = spark.range(40_000).selectExpr("bigint(null) doc_id", "'the same words again and again' text", "'en' lang")
    few = spark.createDataFrame([(i, f"ganz andere wörter {i} und {i * i}", "de") for i in range(60)], "doc_id bigint, text string, lang string")
    model = language.fit(many.unionByName(few))
    assert set(model.known) == {"en", "de"}
    # The repeated row is learned once, and so leaves the other documents of its own label their share.
    own = spark.createDataFrame([(i, f"some other text {i}", "en") for i in range(60)], "doc_id bigint, text string, lang string")
    seen = language.fit(many.unionByName(own)).known["en"]
    once = language.fit(many.limit(1).unionByName(own)).known["en"]
    assert np.array_equal(seen.runs[1], once.runs[1]) and len(seen.runs[1]) > 20


def test_prediction_is_what_the_weights_say(spark):
    """Family of the largest margin, then the language with most wins inside it, over counts taken letter by letter."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(200)
    model = language.fit(docs)
    for r in language.predicted(docs, model).join(docs.select("doc_id", "text"), "doc_id").limit(60).collect():
        letters = "".join(c if c.isalpha() else " " for c in r["text"].lower())
        letters = re.sub(" +", " ", letters)
        row = np.zeros(1 << language.BITS)
        for n in (1, 2, 3):
            for k in range(len(letters) - n + 1):
                hashed = 0
                for c in letters[k : k + n]:
                    hashed = (hashed * 0x01000193 & 0xFFFFFFFF) ^ (ord(c) * 0x9E3779B1 & 0xFFFFFFFF)
                row[(hashed * 0x85EBCA6B & 0xFFFFFFFF) >> (32 - language.BITS)] += 1
        row = np.sqrt(row)
        row /= np.linalg.norm(row)
        margins = row @ model.family_weights[:-1] + model.family_weights[-1]
        family = model.families[int(np.argmax(margins))]
        wins = {lang: 0 for lang in model.languages[family]}
        for k, (a, b) in enumerate(model.pairs):
            if a in wins:
                wins[a if row @ model.pair_weights[:-1, k] + model.pair_weights[-1, k] > 0 else b] += 1
        assert r["lang_pred"] in [lang for lang, n in wins.items() if n == max(wins.values())]


def test_learning_drops_what_other_operators_keep():
    rows.worker_cache("tokenizers")["kept"] = "words"
    part = pa.RecordBatch.from_pydict({"lang": ["en"], "text": ["some words that are learned"]})
    learned = list(language._training_rows(iter([part])))
    assert "tokenizers" not in rows._KEPT and [p.num_rows for p in learned] == [2]
