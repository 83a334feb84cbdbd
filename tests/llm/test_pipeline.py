"""The stages one after another against brute force on a small table, and odd tables through all of them."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from llm.conftest import document
from llm.test_decontaminate import expected as contaminated
from llm.test_jaccard import expected as grouped
from llm.test_jaccard import variants
from rowmend.llm import language, mixing
from rowmend.sources.storage import materialize


def columns(df):
    return [tuple(r) for r in df.collect()]


def test_stages(spark, tmp_path):
    rng = random.Random(11)
    items = [(i, " ".join(rng.choices([f"b{k}" for k in range(30)], k=20))) for i in range(5)]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    texts = variants(rng, 120)
    texts = [t + " " + rng.choice(items)[1] if rng.random() < 0.1 else t for t in texts] + [None, "123 !", "", *["same text here, all of it"] * 3]
    data = [document(i, t, "en", rng.choice(["a", "b", None]))[:5] for i, t in enumerate(texts)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, lang string, source string, n_chars bigint")

    known = materialize(pipeline.known_language(spark, docs, str(tmp_path)), "t")
    told = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(docs).collect()}
    left = [d for d in data if told[d[0]][0] != "und" and told[d[0]][1] >= pipeline.LEAST_SCORE]
    assert Counter(columns(known)) == Counter(left) and len(left) == len(data) - 3

    single = materialize(pipeline.one_of_each_group(spark, known, str(tmp_path)), "t")
    first = {d for d, _, c in grouped([d[:2] for d in left], 5, 80) if d == c}
    left = [d for d in left if d[0] in first]
    assert Counter(columns(single)) == Counter(left)

    clean = materialize(pipeline.clean_of_benchmark(spark, single, str(tmp_path)), "t")
    left = [d for d in left if not contaminated(d[1], items)[3]]
    assert Counter(columns(clean)) == Counter(left) and len(left) < len(first)

    mix = materialize(pipeline.mixed(spark, clean, str(tmp_path)), "t")
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix_sources(clean).collect()}
    assert Counter(columns(mix)) == Counter({d: copies[d[0]] for d in left if copies[d[0]]})
    words = sum(len(re.findall(r"[^\x20\x09-\x0D]+", d[1])) * n for d, n in Counter(columns(mix)).items())
    assert abs(words / sum(len(d[1].split()) for d in left) - 1.5) < 0.25

    library = Tokenizer.from_file(public_tokenizers.path(pipeline.TOKENIZER))
    ids = [(d[0], [*library.encode(d[1], add_special_tokens=False).ids, 0]) for d in columns(mix)]
    out = columns(pipeline.token_ids(spark, mix, str(tmp_path)))
    assert Counter((d, n, c) for d, _, n, c in out) == Counter((d, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for d, i in ids)


def test_run_is_its_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = docs.columns
    for _, stage in pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf), "t")
        assert docs.columns == names
    last = pipeline.STAGES[-1][1](spark, docs, sf)
    assert Counter(columns(last)) == Counter(columns(entry.queries()["pipeline"](spark, sf)))


def test_odd_tables(spark, odd, empty):
    sf = "/root/testdata/sf0.001"
    for docs in (odd, empty):
        names = docs.columns
        for _, stage in pipeline.STAGES[:-1]:
            docs = materialize(stage(spark, docs, sf), "t")
            assert docs.columns == names
        pipeline.STAGES[-1][1](spark, docs, sf).collect()


def test_each_operator_has_a_query():
    names = entry.queries()
    assert [n for k in range(1, 11) for n in names if n.startswith(f"op{k}_")] == [n for n in names if n.startswith("op")]
    assert sum(n.startswith("op") for n in names) == 10
    assert {n for n in entry.oracle_sql() if n.startswith("op")} == {"op3_mix_sources", "op5_personal_data", "op8_benchmark_hits", "op9_format_chats"}
