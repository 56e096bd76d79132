"""Operator 4: language identification by hierarchical discrimination.

A text becomes a vector of hashed character 1-, 2- and 3-gram counts (square
roots, length one). Linear support vector machines, one family against the
rest, choose the language family; inside it, one-versus-one machines separate
each pair of related languages and the votes decide.

Fitting uses a bounded sample: at most ``per_language`` labelled documents of
each language, the first in the order of a hash of their id. That bound is
the only one: every text is predicted from all its characters. Documents
whose crc32(doc_id) mod 3 is 1 are held out and never learned from; only the
text is an input of a prediction.

The model is a few vectors per family and pair of languages, sent to the
tasks with the function. Prediction happens where the rows are read, with no
shuffle.

Defined results: a NULL text, or one without a letter, is ``und`` with score
0; so is every text if no labelled document can be learned from; with one
learned language all other texts get it with score 1; ties between languages
go to the first in code-point order; repeated rows get equal results; an empty
table gives an empty result; other columns are ignored by ``identify`` and kept by
``keep_known``, whatever their names.

A text in a script or language that was never learned still gets the nearest
learned language, with a low score (0.3 to 0.5 on such texts, 0.9 on usual ones);
some short clean texts score as low, so ``keep_known`` rejects by score only if it
is given ``min_score``.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import packed

PER_LANGUAGE = 500
FEATURES = 4096
STEPS = 300
PENALTY = 1e-3
SHARPNESS = 4.0  # of the score: logistic of the margin times this
UNKNOWN = "und"

# fixed values: language families by ISO 639-1 code; a code that is not
# listed is a family of its own
FAMILIES = {
    "germanic": ["da", "de", "en", "is", "nl", "no", "sv"],
    "romance": ["ca", "es", "fr", "gl", "it", "pt", "ro"],
    "slavic": ["bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
    "uralic": ["et", "fi", "hu"],
    "indic": ["bn", "hi", "mr", "ne", "ur"],
}

_LETTER = re.compile(r"[^\W\d_]")
_CHUNK = 1 << 20


def features(text: str, size: int = FEATURES) -> np.ndarray:
    """Length-one vector of the square roots of hashed 1- to 3-gram counts."""
    counts = np.zeros(size, np.float64)
    low = text.lower()
    for at in range(0, len(low), _CHUNK):  # n-grams overlap into the next chunk
        codes = np.frombuffer(low[at:at + _CHUNK + 2].encode("utf-32-le", "surrogatepass"),
                              np.uint32)
        codes = np.where((codes < 33) | ((codes >= 48) & (codes < 58)), np.uint32(32), codes)
        end = min(_CHUNK, len(low) - at)
        gram = np.zeros(len(codes), np.uint32)
        for n in (1, 2, 3):
            m = len(codes) - n + 1
            if m <= 0:
                break
            gram = (gram[:m] * np.uint32(0x01000193)) ^ (codes[n - 1:] * np.uint32(0x9E3779B1))
            counts += np.bincount(((gram ^ (gram >> np.uint32(15))) % np.uint32(size))[:end],
                                  minlength=size)
    counts = np.sqrt(counts)
    norm = np.linalg.norm(counts)
    return (counts / norm if norm else counts).astype(np.float32)


def linear_svm(x: np.ndarray, y: np.ndarray, steps: int = STEPS,
               penalty: float = PENALTY) -> np.ndarray:
    """Squared-hinge linear SVM by accelerated full-batch gradient steps.

    ``x`` has a constant last column; ``y`` is -1 or 1, or 0 for rows that take
    no part (so no machine needs a copy of its rows); both classes weigh
    the same. The step size follows from unit rows, so nothing is random.
    """
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    w = ahead = np.zeros(x.shape[1], np.float64)
    rate = 1.0 / (4.0 + penalty)
    for k in range(steps):
        slack = np.maximum(0.0, 1.0 - y * (x @ ahead.astype(x.dtype)))
        grad = penalty * ahead - 2.0 * (x.T @ (weight * y * slack).astype(x.dtype))
        new = ahead - rate * grad
        ahead = new + (k / (k + 3.0)) * (new - w)
        w = new
    return w


@dataclass
class Model:
    """Vectors of the machines; ``families`` maps a family to its languages."""

    families: dict[str, list[str]]
    family_names: list[str]
    family_vectors: np.ndarray  # family x (features + 1)
    pairs: dict[str, list[tuple[str, str]]]
    pair_vectors: dict[str, np.ndarray]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.family_names or not _LETTER.search(text):
            return UNKNOWN, 0.0
        x = np.append(features(text), np.float32(1.0)).astype(np.float64)
        score = 1.0
        family = self.family_names[0]
        if len(self.family_names) > 1:
            margins = self.family_vectors @ x
            best = int(np.argmax(margins))
            family = self.family_names[best]
            others = np.delete(margins, best).max()
            score = _logistic((margins[best] - others) / 2)
        languages = self.families[family]
        if len(languages) == 1:
            return languages[0], score
        votes = dict.fromkeys(languages, 0.0)
        margins = self.pair_vectors[family] @ x
        for (a, b), m in zip(self.pairs[family], margins):
            votes[a if m >= 0 else b] += 1.0
        best = max(languages, key=lambda c: (votes[c], -languages.index(c)))
        own = [m if a == best else -m for (a, b), m in zip(self.pairs[family], margins)
               if best in (a, b)]
        return best, score * _logistic(min(own))


def _logistic(margin: float) -> float:
    return float(1.0 / (1.0 + np.exp(-np.clip(SHARPNESS * margin, -30, 30))))


def family_of(language: str) -> str:
    return next((f for f, codes in FAMILIES.items() if language in codes), language)


def train(x: np.ndarray, languages: Sequence[str]) -> Model:
    """Fit all machines on feature rows (constant last column) and their languages."""
    known = sorted(set(languages))
    families: dict[str, list[str]] = {}
    for code in known:
        families.setdefault(family_of(code), []).append(code)
    names = sorted(families)
    lang = np.array(languages, dtype=object)
    fam = np.array([family_of(c) for c in languages], dtype=object)
    vectors = [linear_svm(x, np.where(fam == f, 1.0, -1.0)) for f in names] if len(names) > 1 else []
    pairs, pair_vectors = {}, {}
    for f in names:
        pairs[f] = list(combinations(families[f], 2))
        rows = []
        for a, b in pairs[f]:
            rows.append(linear_svm(x, np.where(lang == a, 1.0, np.where(lang == b, -1.0, 0.0))))
        pair_vectors[f] = np.array(rows)
    return Model(families, names, np.array(vectors), pairs, pair_vectors)


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def training_sample(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """(doc_id, lang, text, place) of at most ``per_language`` labelled documents per language.

    Counts per language first give the share of hashes that holds enough
    rows, so only a few times the bound is ever moved or sorted.
    """
    labelled = docs.filter(~is_held_out(F.col("doc_id")) & F.col("lang").isNotNull()
                           & F.col("text").isNotNull())
    counts = {r["lang"]: r["n"] for r in
              labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    part = F.lit(0.0)
    for code, n in sorted(counts.items()):
        part = F.when(F.col("lang") == code, F.lit(min(1.0, 2.0 * per_language / n + 20 / n))
                      ).otherwise(part)
    place = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("language sample")), F.lit(1 << 30)) \
        / F.lit(float(1 << 30))
    some = labelled.select(F.col("doc_id").cast("string").alias("doc_id"), "lang", "text",
                           place.alias("place")).filter(F.col("place") < part)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place", "doc_id"))
    return some.withColumn("_rank", rank).filter(F.col("_rank") <= per_language).drop("_rank")


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Fit on the bounded sample, inside one task: feature rows (16 KB each, at
    most ``per_language`` a language) go there and only the model comes back."""
    def vectors(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            part = part[part["text"].map(lambda t: bool(_LETTER.search(t)))]
            yield pd.DataFrame({"place": part["place"], "doc_id": part["doc_id"],
                                "lang": part["lang"],
                                "v": [features(t).tobytes() for t in part["text"]]})

    def fitted(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [r for part in parts for r in part.itertuples(index=False)]
        rows.sort(key=lambda r: (r.lang, r.place, r.v))
        x = np.ones((len(rows), FEATURES + 1), np.float32)
        for k, r in enumerate(rows):
            x[k, :-1] = np.frombuffer(r.v, np.float32)
        yield pd.DataFrame({"model": [pickle.dumps(train(x, [r.lang for r in rows]))]})

    made = training_sample(docs, per_language).mapInPandas(
        vectors, "place double, doc_id string, lang string, v binary").repartition(1).mapInPandas(
        fitted, "model binary").first()
    return pickle.loads(made["model"]) if made else train(np.ones((0, FEATURES + 1), np.float32), [])


def predictor(model: Model):
    """Column function: struct<lang, score> of a text column."""
    @F.pandas_udf("lang string, score double")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in texts:
            yield pd.DataFrame([model.predict(t) for t in part], columns=["lang", "score"])

    return predict


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    predict = predictor(model or fit(docs))
    doc_id = F.col("doc_id")
    return docs.select(doc_id.cast("long").alias("doc_id"), is_held_out(doc_id).alias("held_out"),
                       predict("text").alias("_p")).select(
        "doc_id", "held_out", F.col("_p.lang").alias("lang_pred"), F.col("_p.score").alias("score"))


def keep_known(docs: DataFrame, model: Model | None = None,
               languages: Sequence[str] | None = None, min_score: float = 0.0) -> DataFrame:
    """``docs`` without the rows that are ``und``, below ``min_score`` or, if
    ``languages`` is given, in another language."""
    predict = predictor(model or fit(docs))
    good = (F.col("_p.lang") != UNKNOWN) & (F.col("_p.score") >= min_score)
    if languages is not None:
        good = good & F.col("_p.lang").isin(list(languages))
    return docs.select(packed(docs), predict("text").alias("_p")).filter(good).select("_doc.*")
