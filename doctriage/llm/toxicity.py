"""Toxicity (operator 3): cumulative-link ordinal regression over sparse text features.

A feature is a word or the beginning of one (``idiot``, ``idio-``), which also meets inflected
and compound forms.

The labels say toxic or not.  Ordered grades come from them: 0 for a clean document; a toxic
one gets 1, 2 or 3, by thirds of the number of its features that tell the classes apart.  The
model is P(grade >= k) = s(w.x - t_k): one weight a feature, shared by the ordered thresholds
t_1 <= t_2 <= t_3.  The expected severity is the sum of the three probabilities.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import codes_of, column, text_slices, words_of

TRAIN_DOCUMENTS = 8000  # labelled documents that the model is fitted on at most: half of each label, by a hash of the id
MIN_DOCUMENTS = 5       # in which a feature of the model occurs
PREFIXES = (4, 5, 6, 7)  # characters
PER_WORDS = 500         # a feature has two values: log of 1 plus its times, and plus its times in so many words
LEAST_WORDS = 50        # a shorter text counts as of this length
MIN_LOG_ODDS = 1.0
MIN_CHI2 = 20.0
GRADES = 3              # above 0
RIDGE = 3e-4
STEPS = 400
FLAG_AT = 0.5           # probability of grade 1 or more


@dataclass
class Model:
    features: list[str]
    weights: np.ndarray
    thresholds: np.ndarray

    def at_least(self, score: np.ndarray) -> np.ndarray:
        """(document, grade 1..): probability of that grade or more."""
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.thresholds[None, :], -60, 60)))


def _terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(text of each word, its code, distinct words); lower case, without what is no letter or digit at its ends."""
    words, counts = words_of(pc.utf8_lower(texts))
    codes, distinct = codes_of(words)
    again, distinct = codes_of(pc.replace_substring_regex(distinct, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""))
    return np.repeat(np.arange(len(texts)), counts), (again[codes] if len(codes) else codes), distinct


def features(word: str) -> list[str]:
    """The word, and its beginnings marked by a hyphen; nothing for an empty word."""
    return [word, *[word[:n] + "-" for n in PREFIXES if n < len(word)]] if word else []


def _expand(codes: np.ndarray, starts: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position in codes, value) of all values of each code; values[starts[c]:starts[c + 1]] are those of c."""
    n = starts[codes + 1] - starts[codes]
    at = np.repeat(np.arange(len(codes)), n)
    inner = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
    return at, values[starts[codes][at] + inner]


def _counts(owner: np.ndarray, codes: np.ndarray, by_word: list[list[int]], size: int):
    """(text, feature, times) that are not zero; ``by_word``: the features of each distinct word."""
    starts = np.cumsum([0, *map(len, by_word)])
    values = np.array([f for fs in by_word for f in fs], np.int64)
    if not len(values):
        return (np.zeros(0, np.int64),) * 3
    at, feature = _expand(codes, starts, values)
    pairs, times = np.unique(owner[at] * size + feature, return_counts=True)
    return pairs // size, pairs % size, times


def _entries(texts: pa.Array, index: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, column, value) that are not zero, by text; a feature's columns are 2i (times) and 2i + 1 (density)."""
    owner, codes, distinct = _terms(texts)
    by_word = [[index[f] for f in features(w) if f in index] for w in distinct.to_pylist()]
    doc, feature, times = _counts(owner, codes, by_word, max(1, len(index)))
    words = np.maximum(np.bincount(owner, minlength=len(texts)), LEAST_WORDS)
    values = np.log1p(np.stack([times, PER_WORDS * times / words[doc]], axis=1)).astype("<f4")
    return np.repeat(doc, 2), np.repeat(2 * feature, 2) + np.tile([0, 1], len(doc)), values.ravel()


def _document_features(batches):
    for rows, texts in text_slices(batches):
        owner, codes, distinct = _terms(texts)
        names: dict[str, int] = {}
        by_word = [[names.setdefault(f, len(names)) for f in features(w)] for w in distinct.to_pylist()]
        doc, feature, _ = _counts(owner, codes, by_word, max(1, len(names)))
        toxic = rows.column(rows.schema.get_field_index("toxic")).to_numpy(zero_copy_only=False).astype(np.int64)
        n = np.bincount(feature, minlength=len(names))
        a = np.bincount(feature, weights=toxic[doc], minlength=len(names)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(names), pa.string()), pa.array(a), pa.array(n - a)],
                                         ["feature", "a", "b"])


def _vocabulary(sample: DataFrame, toxic: int, clean: int) -> list[str]:
    """All features whose log-odds between toxic and clean documents of the bounded sample are large and certain."""
    words = (sample.mapInArrow(_document_features, "feature string, a long, b long")
             .groupBy("feature").agg(F.sum("a").alias("a"), F.sum("b").alias("b")))
    a, b = F.col("a"), F.col("b")
    odds = (F.log((a + 0.5) / (F.lit(toxic + 1.0) - a - 0.5)) - F.log((b + 0.5) / (F.lit(clean + 1.0) - b - 0.5)))
    n = float(max(1, toxic + clean))
    chi2 = (n * F.pow(a * (F.lit(float(clean)) - b) - b * (F.lit(float(toxic)) - a), F.lit(2))
            / (F.lit(max(1.0, float(toxic) * clean)) * (a + b) * F.greatest(F.lit(n) - a - b, F.lit(1.0))))
    found = (words.filter(a + b >= MIN_DOCUMENTS).withColumn("odds", odds).withColumn("chi2", chi2)
             .filter((F.abs("odds") >= MIN_LOG_ODDS) & (F.col("chi2") >= MIN_CHI2)))
    return sorted(r["feature"] for r in found.select("feature").collect())


@dataclass
class Sparse:
    """A matrix as (row, column, value) of its entries."""
    row: np.ndarray
    col: np.ndarray
    value: np.ndarray
    shape: tuple[int, int]

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=self.value * w[self.col], minlength=self.shape[0])

    def summed(self, by_row: np.ndarray) -> np.ndarray:
        """Column sums of the rows times their numbers."""
        return np.bincount(self.col, weights=self.value * by_row[self.row], minlength=self.shape[1])


def sparse(x: np.ndarray) -> Sparse:
    row, col = np.nonzero(x)
    return Sparse(row, col, x[row, col].astype(float), x.shape)


def _matrix(sample: DataFrame, words: list[str]) -> tuple[Sparse, np.ndarray]:
    """(document, column) values and the labels of the bounded sample."""
    index = {w: i for i, w in enumerate(words)}

    def run(batches):
        for rows, texts in text_slices(batches):
            doc, feature, value = _entries(texts, index)
            cuts = np.searchsorted(doc, np.arange(len(texts) + 1))
            packed = [feature[a:b].astype("<i4").tobytes() + value[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [rows.column(rows.schema.get_field_index("toxic")), pa.array(packed, pa.binary())], ["toxic", "x"])

    rows = sample.mapInArrow(run, "toxic int, x binary").collect()
    half = [len(r["x"]) // 2 for r in rows]
    col = np.concatenate([np.zeros(0, "<i4"), *[np.frombuffer(r["x"][:n], "<i4") for r, n in zip(rows, half)]])
    value = np.concatenate([np.zeros(0, "<f4"), *[np.frombuffer(r["x"][n:], "<f4") for r, n in zip(rows, half)]])
    row = np.repeat(np.arange(len(rows)), np.array(half, int) // 4)
    return (Sparse(row, col.astype(int), value.astype(float), (len(rows), 2 * len(words))),
            np.array([r["toxic"] for r in rows], np.int64))


def fit_ordinal(x: Sparse, grades: np.ndarray, levels: int = GRADES, steps: int = STEPS,
                weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds of the cumulative logit model, by gradient steps with momentum.

    ``weight``: how many documents each row stands for, on average 1.
    """
    n, k = x.shape
    share = (np.ones(n) if weight is None else weight) / max(1, n)
    above = (grades[:, None] >= np.arange(1, levels + 1)).astype(float)
    rate = np.clip(share @ above, 1e-4, 1 - 1e-4) if n else np.full(levels, 0.5)
    w, first, gaps = np.zeros(k), np.log((1 - rate[0]) / rate[0]), np.full(levels - 1, np.log(0.5))
    m = v = np.zeros(k + levels)
    for step in range(1, steps + 1 if n else 1):
        t = first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
        c = 1 / (1 + np.exp(-np.clip(x.times(w)[:, None] - t, -60, 60)))  # P(grade >= k)
        c = np.hstack([np.ones((n, 1)), c, np.zeros((n, 1))])
        row = np.arange(n)
        p = np.maximum(c[row, grades] - c[row, grades + 1], 1e-9)      # P(grade)
        d = c * (1 - c)
        by_t = np.zeros((n, levels + 2))                               # d(-log p) / d t_k
        by_t[row, grades] += d[row, grades] / p
        by_t[row, grades + 1] -= d[row, grades + 1] / p
        by_t = by_t[:, 1:-1] * share[:, None]
        g_w = -x.summed(by_t.sum(axis=1)) + RIDGE * w
        g_t = by_t.sum(axis=0)
        g_gap = np.exp(gaps) * np.array([g_t[i:].sum() for i in range(1, levels)])
        g = np.concatenate([g_w, [g_t.sum()], g_gap])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w, first, gaps = w - move[:k], first - move[k], gaps - move[k + 1:]
    return w, first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])


def grades_of(x: Sparse, toxic: np.ndarray, levels: int = GRADES) -> np.ndarray:
    """0 for clean; toxic documents in equal parts by how many telling words they hold."""
    if not len(toxic) or not toxic.any() or toxic.all():
        return toxic.astype(np.int64)
    times = x.col % 2 == 0
    mean = [np.bincount(x.col, weights=x.value * (times & (toxic[x.row] == y)), minlength=x.shape[1]) / (toxic == y).sum() for y in (0, 1)]
    telling = times & (mean[1] > mean[0])[x.col]
    evidence = np.bincount(x.row, weights=np.expm1(x.value) * telling, minlength=x.shape[0])
    cuts = np.quantile(evidence[toxic == 1], np.arange(1, levels) / levels)
    return np.where(toxic == 1, 1 + np.searchsorted(cuts, evidence, side="left"), 0)


def fit(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCUMENTS, doc_id: str = "doc_id",
        text: str = "text") -> Model:
    """The model, fitted on ``limit`` labelled documents at most, half of them of each label where there are so many.

    The documents of a label that are fitted on stand for all documents with it, so a sample with
    more toxic ones than the corpus does not make all others look toxic.  Labels that are null,
    or of no document, are left out.
    """
    given = (labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int").alias("toxic"))
             .filter(F.col("_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("_id").agg(F.max("toxic").alias("toxic")))
    rows = docs.select(column(docs, doc_id).cast("long").alias("_id"), column(docs, text).cast("string").alias("text"))
    there = materialize(given.join(rows.select("_id"), "_id", "left_semi"), "labels")
    whole = {r["toxic"]: r["count"] for r in there.groupBy("toxic").count().collect()}
    order = F.md5(F.col("_id").cast("string"))
    chosen = None  # ``limit`` rows at most
    for label in (0, 1):
        half = there.filter(F.col("toxic") == label).orderBy(order).limit(max(1, limit // 2))
        chosen = half if chosen is None else chosen.union(half)
    sample = materialize(rows.join(F.broadcast(chosen), "_id").select("toxic", "text"), "sample")
    n = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    words = _vocabulary(sample, n.get(1, 0), n.get(0, 0))
    x, toxic = _matrix(sample, words)
    weight = np.array([whole.get(y, 0) / max(1, n.get(y, 0)) for y in (0, 1)])[toxic]
    weight = weight / weight.mean() if len(weight) else weight
    return Model(words, *fit_ordinal(x, grades_of(x, toxic), weight=weight))


def severity(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, severity (expected, 0 to 3), grade (most probable), p_toxic, toxic.

    A null or empty text has no words, and gets what the thresholds alone say.
    """
    index = {f: i for i, f in enumerate(model.features)}

    def run(batches):
        for rows, texts in text_slices(batches):
            doc, feature, value = _entries(texts, index)
            score = np.bincount(doc, weights=model.weights[feature] * value, minlength=len(texts))
            p = model.at_least(score)
            full = np.hstack([np.ones((len(p), 1)), p, np.zeros((len(p), 1))])
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(p.sum(axis=1)), pa.array((full[:, :-1] - full[:, 1:]).argmax(axis=1), pa.int32()),
                 pa.array(p[:, 0]), pa.array(p[:, 0] >= FLAG_AT)], ["doc_id", "severity", "grade", "p_toxic", "toxic"])

    rows = docs.select(column(docs, doc_id).cast("long").alias("doc_id"), column(docs, text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, severity double, grade int, p_toxic double, toxic boolean")
