"""Language ID in two steps: the family first, then one-versus-one linear SVMs inside it.

Features are counts of hashed runs of one to three letters over the whole text, square
roots taken, in unit length. They come from the text alone. Linear support vector machines
are fitted by dual coordinate descent on a bounded sample of labelled rows: about SAMPLE_DOCS
documents, or LEAST_EACH a language where that is more, and never twice as many; an equal
share of each language and at least one document of it, each once whole and once as a short
stretch, so that short texts are learned as well. Every label is learned.

``score`` is the product of the logistic margins of the winning family and of the
narrowest comparison inside it. A comparison always has a winner, so margins cannot tell
that a text is in none of the languages. For that its letters and its runs of three letters
are looked up among those of the winner's learned documents. How many of them a document
of that language usually shares with the others is learned as well. A text that has less
than FAMILIAR of that, and less than FAMILIAR of its runs in any other language, has score
0, and ``lang_pred`` is then only the nearest one. One short word of learned letters is too
little to tell and stays, and so does what is nearest to a language of a single learned
document, which has no usual share.

Nulls: a null text, or one without a letter, is ``und`` with score 0; so is every text if
no row is labelled. Rows with a null label are predicted but not learned from. Rows are
judged one by one, so repeated rows and ids give repeated results. An empty table has no
rows. Other columns are ignored. Long texts are counted in stretches of CHUNK characters,
so memory does not grow with them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from rowmend.llm.rows import row_key, sized, small, text_hash, without, worker_cache
from rowmend.sources.storage import materialize

UNKNOWN = "und"
BITS = 13
RUNS = 3
CHUNK = 1 << 20
SAMPLE_DOCS = 1600
LEAST_EACH = 8  # documents of a label that are expected in the sample at least, if it has as many
SHORT = (20, 200)  # characters of a short stretch
SEEN = 1 << 14  # characters of a learned document whose runs are kept
FAMILIAR = 0.5  # of the usual share of known runs; a text with less is in no language
GIVEN = 2  # runs of three letters that count as usual before a text's own, so that single odd words decide nothing
EPOCHS = 30
PENALTY = 10.0
STEEP = 4.0
BATCH = 128

# Families of closely related languages. A language not listed is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "baltic": ("lt", "lv"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "ky", "tr", "tt", "uz"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
    "iranian": ("fa", "ku", "ps", "tg"),
    "semitic": ("ar", "he", "mt"),
    "malay": ("id", "jv", "ms", "tl"),
    "sinitic": ("yue", "zh"),
}
_FAMILY = {lang: family for family, langs in FAMILIES.items() for lang in langs}


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


@cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def _hashed(text: str) -> Iterator[tuple[int, np.ndarray]]:
    """Length and hashes of the letter runs, stretch by stretch. What is no letter counts as one blank."""
    for first in range(0, len(text), CHUNK):
        codes = np.frombuffer(text[max(first - RUNS + 1, 0) : first + CHUNK].lower().encode("utf-32-le", "replace"), np.uint32)
        codes = np.where(_letters()[codes], codes, 32)
        blank = codes == 32
        codes = codes[~(blank & np.concatenate([[False], blank[:-1]]))].astype(np.uint32)
        mixed = np.zeros(len(codes), np.uint32)
        for n in range(RUNS):
            mixed = (mixed[: len(codes) - n] * np.uint32(0x01000193)) ^ (codes[n:] * np.uint32(0x9E3779B1))
            yield n + 1, mixed * np.uint32(0x85EBCA6B)


def counts(text: str) -> np.ndarray:
    """Counts of hashed letter runs; all zero if there is no letter."""
    total = np.zeros(1 << BITS)
    if not any(map(str.isalpha, text)):
        return total
    for _, hashed in _hashed(text):
        total += np.bincount(hashed >> np.uint32(32 - BITS), minlength=1 << BITS)
    return total


def seen_runs(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of the text's letters and of its runs of three."""
    runs = list(_hashed(text))
    kinds = [np.unique(np.concatenate([hashed for n, hashed in runs if n == size])) for size in (1, RUNS)]
    return kinds[0][kinds[0] != _BLANK], kinds[1]


_BLANK = np.uint32(32 * 0x9E3779B1 * 0x85EBCA6B & 0xFFFFFFFF)


def features(text: str) -> np.ndarray:
    root = np.sqrt(counts(text))
    return (root / max(np.linalg.norm(root), 1e-12)).astype(np.float32)


def linear_svm(rows: np.ndarray, positive: np.ndarray, chosen: np.ndarray | None = None) -> np.ndarray:
    """Weights, the last one the bias, by dual coordinate descent on the hinge loss, in a fixed random order.

    Only the ``chosen`` rows are learned from, if they are named; they are looked at in place.
    """
    place = np.arange(len(rows)) if chosen is None else np.flatnonzero(chosen)
    positive = positive[place]
    sign = np.where(positive, 1.0, -1.0)
    # The rarer class weighs as much as the other.
    limit = PENALTY * np.where(positive, len(sign) / (2 * max(positive.sum(), 1)), len(sign) / (2 * max((~positive).sum(), 1)))
    alpha, weights, bias = np.zeros(len(place)), np.zeros(rows.shape[1], np.float32), 0.0
    norms = np.einsum("ij,ij->i", rows, rows)[place] + 1
    order = np.random.default_rng(1)
    for _ in range(EPOCHS):
        for i in order.permutation(len(place)):
            row = rows[place[i]]
            gradient = sign[i] * (float(row @ weights) + bias) - 1
            step = min(max(alpha[i] - gradient / norms[i], 0.0), limit[i])
            if step != alpha[i]:
                change = (step - alpha[i]) * sign[i]
                weights += np.float32(change) * row
                bias += change
                alpha[i] = step
    return np.append(weights, bias)


@dataclass
class Known:
    """Sorted hashes of a language's letters and runs of three, and the share of them that its documents have in common with others."""

    runs: tuple[np.ndarray, np.ndarray]
    usual: tuple[float, float]

    @staticmethod
    def learn(documents: list[tuple[np.ndarray, np.ndarray]]) -> Known:
        runs, usual = [], []
        for kind in zip(*documents):
            hashes, times = np.unique(np.concatenate(kind), return_counts=True)
            others = hashes[times > 1]  # those of a document that some other one has, too
            runs.append(hashes)
            usual.append(float(np.median([_among(own, others).mean() if len(own) else 0.0 for own in kind])))
        return Known(tuple(runs), tuple(usual))

    def familiar(self, text: str, usual: tuple[float, float]) -> bool:
        found, every = [0, 0], [0, 0]
        for n, hashed in _hashed(text):
            if n in (1, RUNS):
                hashed = hashed[hashed != _BLANK] if n == 1 else hashed
                found[n == RUNS] += int(_among(hashed, self.runs[n == RUNS]).sum())
                every[n == RUNS] += len(hashed)
        letters, threes = usual
        return found[0] >= FAMILIAR * letters * every[0] and found[1] + GIVEN * threes >= FAMILIAR * threes * (every[1] + GIVEN)


def _among(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of the hashes are in the sorted ``known``."""
    if not len(known):
        return np.zeros(len(hashes), bool)
    return known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes


@dataclass
class Model:
    """``family_weights`` has a column per family, ``pair_weights`` one per pair of languages of a family."""

    families: list[str]
    languages: dict[str, list[str]]
    pairs: list[tuple[str, str]]
    family_weights: np.ndarray
    pair_weights: np.ndarray
    known: dict[str, Known]

    def judge(self, texts: list[str], rows: np.ndarray) -> list[tuple[str, float]]:
        """The nearest language of each text and its score, which is 0 for a text in none."""
        return [(lang, score if self._familiar(text, lang) else 0.0) for text, (lang, score) in zip(texts, self.predict(rows))]

    def _familiar(self, text: str, lang: str) -> bool:
        """The others are asked as well, for a full share: the nearest language of a few words is often another one than theirs."""
        own = self.known[lang]
        return own.familiar(text, own.usual) or any(k.familiar(text, (1.0, 1.0)) for other, k in self.known.items() if other != lang)

    def predict(self, rows: np.ndarray) -> list[tuple[str, float]]:
        of_family = rows @ self.family_weights[:-1] + self.family_weights[-1]
        of_pair = rows @ self.pair_weights[:-1] + self.pair_weights[-1]
        results = []
        for family_margins, pair_margins in zip(of_family, of_pair):
            best = int(np.argmax(family_margins))
            sure = logistic(family_margins[best]) if len(self.families) > 1 else 1.0
            margins = {pair: float(m) for pair, m in zip(self.pairs, pair_margins)}
            results.append(self._inside(self.families[best], margins, sure))
        return results

    def _inside(self, family: str, margins: dict, sure: float) -> tuple[str, float]:
        """The language with the most wins; equal wins go by the sum of margins, then by name."""
        langs = self.languages[family]
        won = {a: [margins[a, b] if (a, b) in margins else -margins[b, a] for b in langs if b != a] for a in langs}
        best = max(langs, key=lambda a: (sum(m > 0 for m in won[a]), sum(won[a]), [-ord(c) for c in a]))
        return best, float(sure * min([logistic(m) for m in won[best]], default=1.0))


def logistic(margin: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(STEEP * margin, -30, 30))))


def _training_rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    worker_cache("language")
    for part in small(parts):
        langs, rows, seen = [], [], []
        for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
            place = zlib.crc32(text.encode())
            size = SHORT[0] + place % (SHORT[1] - SHORT[0])
            first = place // 7 % max(len(text) - size, 1)
            begin = place // 7 % max(len(text) - SEEN, 1)
            runs = [kind.tobytes() for kind in seen_runs(text[begin : begin + SEEN])] if text else [None, None]
            for said in (text, text[first : first + size]):
                row = features(said)
                if row.any():
                    langs.append(lang)
                    rows.append(row.astype(np.float16).tobytes())
                    seen.append(runs)
                    runs = [None, None]  # once a document
        columns = [pa.array(langs, pa.string()), pa.array(rows, pa.binary()), *[pa.array([s[k] for s in seen], pa.binary()) for k in range(2)]]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "row", "letters", "threes"])


def fit(docs: DataFrame, sample: int = SAMPLE_DOCS) -> Model | None:
    """The model of labelled documents that are not held out; None if there are none."""
    labelled = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    labelled = labelled.where(F.col("text").rlike(r"\p{L}")).withColumn("_place", F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)))
    # Equal rows have one place. About how many places a label has is enough to draw its share.
    labels = labelled.groupBy("lang").agg(F.approx_count_distinct("_place").alias("n"), F.min("_place").alias("first"))
    labels = materialize(labels, "labels")
    sample = max(sample, LEAST_EACH * labels.count())
    each = sample // max(labels.count(), 1)
    # The first document is always drawn; further ones as long as their places are in the label's share.
    upto = F.greatest(F.lit(each) / F.col("n") * float(1 << 40), F.col("first") + 1.0)
    drawn = labelled.join(sized(labels.select("lang", upto.alias("_upto"))), "lang").where("_place < _upto")
    once = drawn.groupBy("lang", "_place").agg(F.min("text").alias("text"))
    # Never more than twice a label's share, the smallest places of it: the window is over drawn rows only.
    place = F.row_number().over(Window.partitionBy("lang").orderBy("_place"))
    once = once.withColumn("_nr", place).where(F.col("_nr") <= 2 * each)
    chosen = once.select("lang", "text").mapInArrow(_training_rows, "lang string, row binary, letters binary, threes binary")
    picked = chosen.collect()  # two rows a document
    if not picked:
        return None
    picked.sort(key=lambda r: (r["lang"], bytes(r["row"])))
    documents: dict[str, list] = {r["lang"]: [] for r in picked}
    for r in picked:
        if r["letters"] is not None:
            documents[r["lang"]].append(tuple(np.frombuffer(r[kind], np.uint32) for kind in ("letters", "threes")))
    seen = {lang: Known.learn(listed or [(np.zeros(0, np.uint32),) * 2]) for lang, listed in documents.items()}
    del documents
    langs = np.array([r["lang"] for r in picked])
    rows = np.empty((len(picked), 1 << BITS), np.float32)
    for k in range(len(picked)):
        rows[k], picked[k] = np.frombuffer(picked[k]["row"], np.float16), None
    known = sorted(set(langs.tolist()))
    family_of = np.array([_FAMILY.get(lang, lang) for lang in langs])
    families = sorted(set(family_of.tolist()))
    languages = {f: [lang for lang in known if _FAMILY.get(lang, lang) == f] for f in families}
    pairs = [pair for f in families for pair in combinations(languages[f], 2)]

    none = np.zeros((rows.shape[1] + 1, 0))
    family_weights = [linear_svm(rows, family_of == f) if len(families) > 1 else np.zeros(rows.shape[1] + 1) for f in families]
    pair_weights = [linear_svm(rows, langs == a, (langs == a) | (langs == b)) for a, b in pairs]
    stacked = lambda columns: np.stack(columns, axis=1).astype(np.float32) if columns else none.astype(np.float32)
    return Model(families, languages, pairs, stacked(family_weights), stacked(pair_weights), seen)


def _predict(model):
    def predict(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("language")
        fitted = model.value
        for part in small(parts):
            texts = part.column("text").to_pylist()
            results: list[tuple[str, float]] = []
            for first in range(0, len(texts), BATCH):
                said = [t or "" for t in texts[first : first + BATCH]]
                rows = np.stack([features(t) for t in said])
                guessed = fitted.judge(said, rows) if fitted else [(UNKNOWN, 0.0)] * len(rows)
                results += [g if row.any() else (UNKNOWN, 0.0) for g, row in zip(guessed, rows)]
            columns = [pa.array([r[0] for r in results], pa.string()), pa.array([r[1] for r in results], pa.float64())]
            kept = [part.column(c) for c in part.schema.names if c != "text"]
            names = [c for c in part.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*kept, *columns], [*names, "lang_pred", "score"])

    return predict


def predicted(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, text_hash, lang_pred and score of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size depends on the languages, not on the documents
    rows = docs.select("doc_id", text_hash(), "text")
    kinds = [rows.schema["doc_id"], rows.schema["text_hash"], StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    return rows.mapInArrow(_predict(shared), StructType(kinds))


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document; without ``model`` one is fitted on ``docs``."""
    found = predicted(docs, model or fit(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def known_language(docs: DataFrame, least: float) -> DataFrame:
    """The documents whose language is told with a score of ``least`` or more."""
    found = predicted(docs, fit(docs))
    told = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)
    return without(docs, materialize(found.where(~told).select(row_key()).distinct(), "unknown-language"))
