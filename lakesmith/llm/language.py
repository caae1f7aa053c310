"""Language ID in two steps: the language family first, then one-versus-one linear SVMs within it.

Features are hashed byte trigrams of the whole lower-cased text, non-letters of ASCII as spaces,
as square roots of the counts scaled to length one. A family is chosen by one-versus-rest linear SVMs; its
languages are then told apart by a linear SVM for each pair, by votes (ties: sum of margins).

Learning reads the text and language of rows outside the held-out fold, with non-null language and id;
of each language at most ``per_language`` rows, those of least id hash (a documented bound: their
feature vectors go to the driver), and of rows with equal id and language the one of least text hash. All rows are predicted, whole.

Defined results: a null text or one without a letter is ``und`` with score 0; so is every row if
nothing can be learned; a single learned language is predicted for all texts with letters. A
null id is not held out. Repeated rows are predicted one by one; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import in_fold, logistic, slices, staged

#: Families of languages; a language not listed is a family of its own.
FAMILIES = {
    "germanic": ["da", "de", "en", "is", "nl", "no", "sv"],
    "romance": ["ca", "es", "fr", "gl", "it", "pt", "ro"],
    "slavic": ["bg", "cs", "hr", "pl", "ru", "sk", "sl", "sr", "uk"],
    "uralic": ["et", "fi", "hu"],
    "baltic": ["lt", "lv"],
    "turkic": ["az", "kk", "tr"],
    "semitic": ["ar", "he", "mt"],
    "indo-aryan": ["bn", "hi", "mr", "ur"],
    "sinitic": ["zh"],
    "japonic": ["ja"],
    "koreanic": ["ko"],
}
BITS = 12
#: Letters, and numerals like one half, which are told apart by ``isalpha``.
WORD_CHARACTER = re.compile(r"[^\W\d_]")
TABLE = np.array([b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256)], np.uint32)


def has_letter(text: str) -> bool:
    """Whether the text has a character of Unicode's letter categories; marks and numerals are none."""
    return any(found.group().isalpha() for found in WORD_CHARACTER.finditer(text))


def family_of(lang: str) -> str:
    return next((f for f, own in FAMILIES.items() if lang in own), lang)


def features(texts: list[str]) -> np.ndarray:
    """One row a text: square roots of trigram counts, of length one."""
    found = np.zeros((len(texts), 1 << BITS), np.float32)
    for i, text in enumerate(texts):
        a = TABLE[np.frombuffer(b" " + text.lower().encode() + b"  ", np.uint8)]
        codes = (a[:-2] << np.uint32(16)) + (a[1:-1] << np.uint32(8)) + a[2:]
        codes = codes[codes != 0x202020]
        found[i] = np.bincount((codes * np.uint32(2654435761)) >> np.uint32(32 - BITS), minlength=1 << BITS)
    found = np.sqrt(found)
    return found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-9)


def fit_svm(x: np.ndarray, y: np.ndarray, c: float = 20.0, rounds: int = 150) -> np.ndarray:
    """Weights (the last one a bias) of a linear SVM with squared hinge loss; y is +1 or -1."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    w = v = np.zeros(x.shape[1])
    step = 1 / (1 + 2 * c * 2)
    for k in range(rounds):  # accelerated gradient descent
        slack = np.maximum(0, 1 - y * (x @ v))
        new = v - step * (v - 2 * c * (x.T @ (weight * slack * y)))
        v = new + k / (k + 3) * (new - w)
        w = new
    return w.astype(np.float32)


@dataclass
class LanguageModel:
    """``families``: weights by family; ``pairs``: weights by pair of languages, positive for the first."""

    languages: dict[str, list[str]]
    families: dict[str, np.ndarray] = field(default_factory=dict)
    pairs: dict[tuple[str, str], np.ndarray] = field(default_factory=dict)

    @classmethod
    def fit(cls, x: np.ndarray, langs: list[str]) -> LanguageModel:
        names = np.array(langs, object)
        families = np.array([family_of(n) for n in names], object)
        model = cls({f: sorted(set(names[families == f])) for f in sorted(set(families))})
        if len(model.languages) > 1:
            model.families = {f: fit_svm(x, np.where(families == f, 1, -1)) for f in model.languages}
        for own in model.languages.values():
            for a, b in combinations(own, 2):
                at = (names == a) | (names == b)
                model.pairs[a, b] = fit_svm(x[at], np.where(names[at] == a, 1, -1))
        return model

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """The language and a score (0 to 1) of each row."""
        if not self.languages:
            return ["und"] * len(x), np.zeros(len(x))
        names = list(self.languages)
        margin = np.zeros((len(x), len(names)))
        for i, f in enumerate(names):
            if f in self.families:
                margin[:, i] = x @ self.families[f][:-1] + self.families[f][-1]
        chosen = margin.argmax(axis=1)
        sure = np.exp(4 * (margin - margin.max(axis=1, keepdims=True)))
        score = sure.max(axis=1) / sure.sum(axis=1)
        langs = np.empty(len(x), object)
        for i, f in enumerate(names):
            at, own = np.flatnonzero(chosen == i), self.languages[f]
            votes, sums, least = np.zeros((len(at), len(own))), np.zeros((len(at), len(own))), np.ones((len(at), len(own)))
            for (a, b), w in ((p, w) for p, w in self.pairs.items() if p[0] in own):
                m = x[at] @ w[:-1] + w[-1]
                for lang, sign in ((a, 1), (b, -1)):
                    k = own.index(lang)
                    votes[:, k] += sign * m > 0
                    sums[:, k] += sign * m
                    least[:, k] = np.minimum(least[:, k], logistic(4 * sign * m))
            best = np.lexsort((sums, votes), axis=1)[:, -1] if len(at) else np.zeros(0, int)
            langs[at] = np.array(own, object)[best]
            score[at] *= least[np.arange(len(at)), best]
        return langs.tolist(), np.clip(score, 0, 1)


def learn(docs: DataFrame, per_language: int = 500, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", fold: int = 2, folds: int = 4) -> LanguageModel:
    """A model from at most ``per_language`` rows of each language outside the held-out fold."""
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"), F.col(lang_column).alias("lang"))
    rows = rows.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~in_fold(F.col("doc_id"), fold, folds))
    keys = rows.select("doc_id", "lang", F.xxhash64("doc_id").alias("hash"), F.pmod(F.xxhash64("doc_id", "lang"), F.lit(64)).alias("part")).distinct()
    for group in (["lang", "part"], ["lang"]):  # the first of each part, then of the language: no task gets a whole language
        nth = F.row_number().over(Window.partitionBy(*group).orderBy("hash", "doc_id"))
        keys = keys.withColumn("nth", nth).where(F.col("nth") <= per_language).drop("nth")
    chosen = staged(keys.select("doc_id", "lang"), "language-sample")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            x = features(batch.column(1).to_pylist()).astype(np.float16)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([v.tobytes() for v in x], pa.binary())], names=["lang", "x"])

    sample = rows.join(F.broadcast(chosen), ["doc_id", "lang"])  # bounded by per_language
    sample = sample.groupBy("doc_id", "lang").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least")).select("lang", "least.text")  # of repeated ids, one row
    got = sample.mapInArrow(run, "lang string, x binary").collect()
    got.sort(key=lambda r: (r["lang"], r["x"]))
    x = np.array([np.frombuffer(r["x"], np.float16) for r in got], np.float32).reshape(len(got), 1 << BITS)
    return LanguageModel.fit(x, [r["lang"] for r in got]) if got else LanguageModel({})


def identify(docs: DataFrame, model: LanguageModel, id_column: str = "doc_id", text_column: str = "text", fold: int = 2, folds: int = 4) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [t if t is not None and has_letter(t) else None for t in part.column(2).to_pylist()]
                langs, scores = model.predict(features([t or "" for t in texts]))
                langs = ["und" if t is None else lang for t, lang in zip(texts, langs, strict=True)]
                scores = [0.0 if t is None else float(s) for t, s in zip(texts, scores, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(id_column).alias("doc_id"), in_fold(F.col(id_column), fold, folds).alias("held_out"), F.col(text_column).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
