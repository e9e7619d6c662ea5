"""Language ID (operator 6): each document is a mixture of languages over its words.

Letter trigrams of labelled documents give each language's trigram probabilities, hence the
likelihood of a word under it.  Expectation-maximisation estimates a document's language
proportions; languages then leave its set, the least first, while the likelihood penalised
by half the logarithm of its words for each language gets better.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import codes_of, column, let_go, text_slices, words_of

UNKNOWN = "und"
TRAIN_DOCUMENTS = 8000  # labelled documents that the model is fitted on at most: as many of each language, by a hash of the id
SLICE_BYTES = 2 << 20   # of text that is judged at once: several numbers a word and language
BUCKETS = 1 << 16       # trigrams are hashed; a constant bounds the model
SMOOTHING = 0.1
ROUNDS = 12             # of expectation-maximisation over all languages
REFINE = 5              # after a language has left
HELD_OUT = 2            # documents with this crc32(doc_id) mod 4 are never learned from


@dataclass
class Model:
    langs: list[str]
    log_p: np.ndarray  # (BUCKETS, languages)


def held_out(doc_id):
    """crc32 of the id as text, mod 4, is 2 (a null id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == HELD_OUT


def _letters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(text of each word, code of each word, distinct words); words hold letters alone, in lower case."""
    words, counts = words_of(pc.utf8_lower(texts))
    owner = np.repeat(np.arange(len(texts)), counts)
    codes, distinct = codes_of(words)
    letters = pc.replace_substring_regex(distinct, r"[^\p{L}]+", "")
    again, distinct = codes_of(letters)
    full = pc.greater(pc.binary_length(distinct), 0).to_numpy(zero_copy_only=False)
    codes = again[codes] if len(codes) else codes
    keep = full[codes] if len(codes) else np.zeros(0, bool)
    return owner[keep], codes[keep], distinct


def _grams(distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte trigrams of each word with its ends, and the number of them by word."""
    raw = "\0".join(["", *distinct.to_pylist(), ""]).encode("utf-8", "replace")
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    h = (b[:-2] * np.uint32(0x9E3779B1)) ^ (b[1:-1] * np.uint32(0x85EBCA77)) ^ (b[2:] * np.uint32(0xC2B2AE3D))
    h = (h * np.uint32(0x27D4EB2F)) >> np.uint32(16)
    inside = b[1:-1] != 0  # trigrams centred on a byte of a word
    word = np.cumsum(b[:-2] == 0)[inside] - 1
    return h[inside].astype(np.int64), np.bincount(word, minlength=len(distinct))


def _counter(batches):
    for rows, texts in text_slices(batches):
        lang = np.array(rows.column(rows.schema.get_field_index("lang")).to_pylist(), object)
        names, of = np.unique(lang, return_inverse=True)
        owner, codes, distinct = _letters(texts)
        grams, per = _grams(distinct)
        for k, name in enumerate(names):
            times = np.bincount(codes[of[owner] == k], minlength=len(distinct))
            n = np.bincount(grams, weights=np.repeat(times, per), minlength=BUCKETS)
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at),
                                              pa.array(n[at].astype(np.int64))], ["lang", "gram", "n"])


def fit(docs: DataFrame, limit: int = TRAIN_DOCUMENTS, doc_id: str = "doc_id", text: str = "text",
        lang: str = "lang") -> Model:
    """Trigram probabilities by language, from ``limit`` documents at most that are labelled and not held out.

    Each language gets an equal share of them, so a rare one is learned from what there is of it.
    Rows without an id are not learned from.
    """
    rows = docs.select(column(docs, doc_id).cast("string").alias("_id"), column(docs, lang).cast("string").alias("lang"),
                       column(docs, text).cast("string").alias("text"))
    usable = F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("_id"))
    n_langs = rows.filter(usable).agg(F.count_distinct("lang")).first()[0]
    each = max(1, limit // max(1, n_langs))
    ids = rows.filter(usable & F.col("_id").isNotNull()).select("lang", "_id", F.md5("_id").alias("_order")).distinct()
    for part in (F.substring("_order", 31, 2), F.lit("")):  # the first of each part of a language, then of all its parts
        ids = ids.withColumn("_at", F.row_number().over(Window.partitionBy("lang", part).orderBy("_order"))).filter(F.col("_at") <= each)
    chosen = ids.select("lang", "_id")  # ``limit`` at most, or one a language
    sample = rows.filter(usable).join(F.broadcast(chosen), ["lang", "_id"], "left_semi").select("lang", "text")
    counts = (sample.mapInArrow(_counter, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas())
    langs = sorted(set(counts["lang"]))
    n = np.zeros((BUCKETS, len(langs)))
    n[counts["gram"].to_numpy(np.int64), np.searchsorted(langs, counts["lang"]) if langs else []] = counts["n"]
    p = (n + SMOOTHING) / (n.sum(axis=0) + SMOOTHING * BUCKETS)
    return Model(langs, np.log(p).astype(np.float32))


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts, axis=0)


def _em(like: np.ndarray, starts: np.ndarray, sizes: np.ndarray, share: np.ndarray, rounds: int):
    """Proportions by document after ``rounds``, and the log-likelihood of the words under the last but one."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    for _ in range(rounds):
        joint = like * share[owner]
        total = np.maximum(joint.sum(axis=1), 1e-30)
        share = _sums(joint / total[:, None], starts) / sizes[:, None]
    return share, _sums(np.log(total), starts)


def mixtures(model: Model, texts: pa.Array) -> np.ndarray:
    """(text, language) proportions over each text's selected languages; a text without a letter has none."""
    k = len(model.langs)
    out = np.zeros((len(texts), k))
    owner, codes, distinct = _letters(texts)
    if not len(owner) or not k:
        return out
    grams, per = _grams(distinct)
    full = per > 0
    log_word = np.zeros((len(distinct), k), np.float32)
    log_word[full] = _sums(model.log_p[grams], (np.cumsum(per) - per)[full])
    # relative to the best language of each word: the constant cancels in every comparison
    like = np.exp(log_word - log_word.max(axis=1, keepdims=True))[codes]
    docs, sizes = np.unique(owner, return_counts=True)
    starts = np.cumsum(sizes) - sizes
    share, fit_now = _em(like, starts, sizes, np.full((len(docs), k), 1 / k, np.float32), ROUNDS)
    active = np.ones((len(docs), k), bool)
    price = 0.5 * np.log(np.maximum(sizes, 2))
    going = np.arange(len(docs)) if k > 1 else np.zeros(0, int)
    while len(going):
        least = np.where(active[going], share[going], np.inf).argmin(axis=1)
        fewer = active[going].copy()
        fewer[np.arange(len(going)), least] = False
        rest = np.maximum(share[going], 1e-6) * fewer
        words = np.repeat(starts[going] - (np.cumsum(sizes[going]) - sizes[going]), sizes[going])
        words += np.arange(len(words))
        n = sizes[going]
        new, fit_new = _em(like[words], np.cumsum(n) - n, n, rest / rest.sum(axis=1, keepdims=True), REFINE)
        better = fit_new + price[going] >= fit_now[going]
        took = going[better]
        share[took], fit_now[took], active[took] = new[better], fit_new[better], fewer[better]
        going = took[active[took].sum(axis=1) > 1]
    out[docs] = share * active
    return out


def _predict(model: Model, texts: pa.Array) -> tuple[list[str], np.ndarray, list[list[str]]]:
    share = mixtures(model, texts)
    score = share.max(axis=1) if share.shape[1] else np.zeros(len(texts))
    best = share.argmax(axis=1) if share.shape[1] else []
    names = [model.langs[b] if s > 0 else UNKNOWN for b, s in zip(best, score)] if share.shape[1] else [UNKNOWN] * len(texts)
    sets = [[model.langs[i] for i in np.flatnonzero(row > 0)] for row in share]
    return names, np.clip(score, 0, 1), sets


def identify(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score, langs.

    ``lang_pred`` has the largest proportion (``score``); ``langs`` is the selected set.  A
    text that is null or has no letter, or a model without languages, gives ``und`` with
    score 0 and an empty set.  Only the text is read for a prediction.
    """
    def run(batches):
        let_go()
        for rows, texts in text_slices(batches, limit=SLICE_BYTES):
            names, score, sets = _predict(model, texts)
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(names, pa.string()),
                                              pa.array(score), pa.array(sets, pa.list_(pa.string()))],
                                             ["doc_id", "held_out", "lang_pred", "score", "langs"])
    key = column(docs, doc_id)
    rows = docs.select(key.cast("long").alias("doc_id"), held_out(key).alias("held_out"),
                       column(docs, text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, langs array<string>")


def keep_identified(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` for which a set of languages is found, all columns as they are.

    The selected set accounts for the whole text, so no share of a single language is asked for: a
    text in three languages stays though none has half of it.  Rows are filtered where they lie: nothing is shuffled, ids need not be unique.
    A model without languages (no row has a label) rejects nothing: all rows stay.
    """
    if not model.langs:
        return docs
    place = docs.columns.index(text)

    def run(batches):
        let_go()
        for batch in batches:
            named = batch.rename_columns([f"c{i}" for i in range(batch.num_columns)])
            for rows, texts in text_slices([named], f"c{place}", SLICE_BYTES):
                keep = pa.array([len(s) > 0 for s in _predict(model, texts)[2]], pa.bool_())
                yield rows.filter(keep).rename_columns(batch.schema.names)
    return docs.mapInArrow(run, docs.schema)
