"""Toxicity: gradient-boosted trees over dense features of a text, calibrated by isotonic regression.

Features of a whole text: densities of a learned lexicon (words whose document frequency is raised
in toxic rows, weighted by log odds), how near its words stand to second-person words, rates of capitals, of
punctuation and its runs, of disguised words (digits or signs for letters, inner signs,
stretched letters), repeated words, and length. Words are compared with disguises undone.

Learning reads labelled rows outside the held-out fold: at most ``most_rows`` of them, those of least id hash
(a documented bound: their features go to the driver), and of rows with equal id the one of least text hash. Two thirds grow the trees and one
third, kept apart by hash, calibrates their margins. A document's label is 1 if any of its labels is.

Defined results: a null or empty text has all-zero features and is scored like any other;
without labels every score is 0; with one class alone every score is that class. A null id is neither
held out nor learned from. Repeated rows are scored one by one; extra columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_fold, logistic, slices, staged

#: Second-person words of the languages in hand.
SECOND_PERSON = set(
    "you your yours yourself yourselves u ur du dich dir dein deine deinen deiner ihr euch euer eure "
    "tu te toi ton ta tes vous votre vos tú ti tuyo tuya usted ustedes vosotros vuestro".split()
)
#: Signs and digits that stand for letters in disguised words.
PLAIN_LETTERS = str.maketrans("013457@$!|", "oieastasil")
EDGES = ".,;:!?\"'()[]{}<>#%&*$|-_/\\~+=`^…«»“”„¡¿"
STRETCHED = re.compile(r"(.)\1{2,}")
SIGNS = re.compile(r"[^\w]+")
RUNS = re.compile(r"[!?]{2,}|[#$%&*@]{2,}")
NEAR = 5
N_FEATURES = 16


def plain(word: str) -> tuple[str, bool]:
    """A word lower-cased with disguises undone, and whether it was disguised."""
    bare = word.strip(EDGES).lower()
    if not bare or bare.isalpha():
        short = STRETCHED.sub(r"\1", bare)
        return short, short != bare
    if not any(c.isalpha() for c in bare):
        return bare, False
    undone = STRETCHED.sub(r"\1", SIGNS.sub("", bare.translate(PLAIN_LETTERS)).replace("_", ""))
    return undone, undone != bare


class _Words(dict):
    """word -> (lexicon weight, flags), computed at first sight; bounded.

    Flags: 1 disguised, 2 second person, 4 all capitals, 8 ends in ! or ?."""

    def __init__(self, lexicon: dict[str, float]) -> None:
        self.lexicon = lexicon

    def __missing__(self, word: str) -> tuple[float, int]:
        key, disguised = plain(word)
        letters = [c for c in word if c.isalpha()]
        shout = len(letters) > 1 and all(c.isupper() for c in letters)
        value = (self.lexicon.get(key, 0.0), disguised + 2 * (key in SECOND_PERSON) + 4 * shout + 8 * (word[-1] in "!?"))
        if len(self) > 200_000:
            self.clear()
        self[word] = value
        return value


def features(texts: list[str], words: _Words) -> np.ndarray:
    """One row of N_FEATURES a text."""
    found = np.zeros((len(texts), N_FEATURES))
    for row, text in zip(found, texts, strict=True):
        parts = text.split()
        n = len(parts)
        if not n:
            continue
        weight, flags = (np.array(v) for v in zip(*map(words.__getitem__, parts), strict=True))
        hits = np.flatnonzero(weight)
        you = np.flatnonzero(flags & 2)
        near = 0
        if len(hits) and len(you):
            at = np.searchsorted(you, hits)
            gap = np.minimum(np.abs(you[np.minimum(at, len(you) - 1)] - hits), np.abs(hits - you[np.maximum(at - 1, 0)]))
            near = (gap <= NEAR).sum()
        chars = len(text)
        row[:] = (
            len(hits) / n, weight.sum() / n, len(hits), weight.sum(), weight.max(), len({parts[i].lower() for i in hits.tolist()}),
            near / n, len(you) / n, (flags & 1).astype(bool).sum() / n, ((flags & 1).astype(bool) & (weight > 0)).sum(),
            (flags & 4).astype(bool).sum() / n, (flags & 8).astype(bool).sum() / n,
            len(RUNS.findall(text)) / n, (text.count("!") + text.count("?") + text.count("*")) / chars, len(set(parts)) / n, np.log1p(n),
        )
    return found


@dataclass
class Trees:
    """Boosted trees of fixed depth: per tree the features and cuts of its inner nodes, and leaf values."""

    depth: int = 3
    base: float = 0.0
    feature: list[np.ndarray] = field(default_factory=list)
    cut: list[np.ndarray] = field(default_factory=list)
    leaf: list[np.ndarray] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += leaf[node - (2**self.depth - 1)]
        return total

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, rounds: int = 80, rate: float = 0.15, bins: int = 64, least: float = 4.0, ridge: float = 1.0) -> Trees:
        """Second-order boosting of the logistic loss with histogram splits."""
        model = cls(base=float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))))
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)], 1)
        margin, inner = np.full(len(y), model.base), 2**model.depth - 1
        for _ in range(rounds):
            p = logistic(margin)
            g, h = p - y, np.maximum(p * (1 - p), 1e-6)
            feature, cut, node = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(len(y), np.int64)
            for level in range(model.depth):
                first = 2**level - 1
                best = np.full(2**level, 1e-6)
                split = np.full(2**level, bins)
                for f, e in enumerate(edges):
                    if not len(e):
                        continue
                    at = (node - first) * bins + binned[:, f]
                    gs, hs = (np.bincount(at, v, 2**level * bins).reshape(-1, bins) for v in (g, h))
                    gl, hl = gs.cumsum(1), hs.cumsum(1)
                    gt, ht = gl[:, -1:], hl[:, -1:]
                    gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
                    gain[(hl < least) | (ht - hl < least)] = 0
                    gain[:, len(e) :] = 0
                    k = gain.argmax(1)
                    top = gain[np.arange(len(k)), k]
                    for i in np.flatnonzero(top > best):
                        best[i], feature[first + i], cut[first + i], split[i] = top[i], f, e[k[i]], k[i]
                node = 2 * node + 1 + (binned[np.arange(len(y)), feature[node]] > split[node - first])
            leaves = node - inner
            size = 2**model.depth
            value = -rate * np.bincount(leaves, g, size) / (np.bincount(leaves, h, size) + ridge)
            margin += value[leaves]
            model.feature.append(feature)
            model.cut.append(cut)
            model.leaf.append(value)
        return model


def isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least-squares non-decreasing steps (margin, probability), by pooling adjacent violators."""
    order = np.argsort(margin, kind="stable")
    x, inverse, counts = np.unique(margin[order], return_inverse=True, return_counts=True)
    sums = np.bincount(inverse, y[order])
    blocks: list[list[float]] = []  # sum, count, first, last
    for i, (s, c) in enumerate(zip(sums.tolist(), counts.tolist(), strict=True)):
        blocks.append([s, c, i, i])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s2, c2, _, last = blocks.pop()
            blocks[-1][0] += s2
            blocks[-1][1] += c2
            blocks[-1][3] = last
    at = [v for b in blocks for v in (x[int(b[2])], x[int(b[3])])]
    return np.array(at), np.repeat([b[0] / b[1] for b in blocks], 2)


@dataclass
class ToxicityModel:
    lexicon: dict[str, float] = field(default_factory=dict)
    trees: Trees | None = None
    steps: tuple[np.ndarray, np.ndarray] | None = None
    constant: float = 0.0

    def score(self, texts: list[str], words: _Words) -> np.ndarray:
        if self.trees is None:
            return np.full(len(texts), self.constant)
        return np.clip(np.interp(self.trees.margin(features(texts, words)), *self.steps), 0, 1)


def learn(docs: DataFrame, labels: DataFrame, most_rows: int = 20_000, most_words: int = 300, least_docs: int = 3, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic", fold: int = 2, folds: int = 4) -> ToxicityModel:
    """A model from at most ``most_rows`` labelled rows outside the held-out fold."""
    marks = labels.select(F.col(id_column).alias("doc_id"), F.col(label_column).alias("toxic")).dropna().where(~in_fold(F.col("doc_id"), fold, folds))
    marks = marks.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    chosen = staged(marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows), "toxicity-sample")
    texts = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    sample = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least"))
    sample = staged(sample.select("doc_id", "least.text", "toxic"), "toxicity-texts")  # bounded by most_rows: of repeated ids, one row

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            seen = {0: Counter(), 1: Counter()}
            known: dict[str, str] = {}
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                parts = set(text.split())
                for w in parts - known.keys():
                    known[w] = plain(w)[0]
                seen[int(toxic > 0)].update({known[w] for w in parts})
            keys = [w for w in seen[0].keys() | seen[1].keys() if w]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *(pa.array([seen[k][w] for w in keys], pa.int64()) for k in (0, 1))], names=["word", "clean", "toxic"])

    totals = {r["t"]: r["n"] for r in sample.groupBy((F.col("toxic") > 0).cast("int").alias("t")).agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return ToxicityModel(constant=float(next(iter(totals), 0)))
    words = sample.select("text", "toxic").mapInArrow(count, "word string, clean long, toxic long")
    words = words.groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where(F.col("toxic") >= least_docs)
    odds = F.log((F.col("toxic") + 0.5) / (totals[1] + 1)) - F.log((F.col("clean") + 0.5) / (totals[0] + 1))
    sure = odds / F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    words = words.select("word", odds.alias("odds"), sure.alias("sure")).where("odds > 0.7 AND sure > 3.3")
    lexicon = {r["word"]: float(r["odds"]) for r in words.orderBy(F.desc("sure"), "word").limit(most_words).collect()}

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _Words(lexicon)
        for batch in slices(batches, "text", 4 << 20):
            x = features(batch.column(1).to_pylist(), own)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), batch.column(2), pa.array([v.tobytes() for v in x], pa.binary())], names=["doc_id", "toxic", "x"])

    got = sample.select("doc_id", "text", "toxic").mapInArrow(measure, "doc_id string, toxic int, x binary").withColumn("part", F.crc32(F.concat(F.lit("calibrate"), "doc_id").cast("binary")) % 3).collect()
    got.sort(key=lambda r: (r["doc_id"], r["x"]))
    x = np.array([np.frombuffer(r["x"]) for r in got])
    y = np.array([float(r["toxic"] > 0) for r in got])
    apart = np.array([r["part"] == 0 for r in got])
    if min(y[apart].sum(), (1 - y[apart]).sum(), y[~apart].sum(), (1 - y[~apart]).sum()) < 1:
        apart[:] = False  # too few rows to keep some apart
    trees = Trees.fit(x[~apart], y[~apart])
    calibrate = apart if apart.any() else ~apart
    return ToxicityModel(lexicon, trees, isotonic(trees.margin(x[calibrate]), y[calibrate]))


def score(docs: DataFrame, model: ToxicityModel, threshold: float = 0.3, id_column: str = "doc_id", text_column: str = "text", fold: int = 2, folds: int = 4) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from ``threshold``) of every row."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _Words(model.lexicon)
        for batch in slices(batches, "text", 4 << 20):
            scores = pa.array(model.score([t or "" for t in batch.column(2).to_pylist()], own))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), scores], names=["doc_id", "held_out", "score"])

    rows = docs.select(F.col(id_column).alias("doc_id"), in_fold(F.col(id_column), fold, folds).alias("held_out"), F.col(text_column).alias("text"))
    scored = rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def without_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = 0.3, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores below ``threshold``, all columns unchanged."""
    at = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _Words(model.lexicon)
        for batch in slices(batches, text_column, 4 << 20):
            yield batch.filter(pa.array(model.score([t or "" for t in batch.column(at).to_pylist()], own) < threshold))

    return docs.mapInArrow(run, docs.schema)
