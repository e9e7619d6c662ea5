"""Quality rules (operator 5): repeated substrings from a suffix array over a text's words.

The suffixes of each text's word sequence are sorted by prefix doubling; neighbours in that
order give the longest common prefixes, whose intervals are the maximal repeated substrings.
A text is rejected if the later occurrences of repeats cover too much of it, or if a repeat is
too long; what is told for the first time is no repeat yet, so a line told twice counts once.
Whole slices of texts are sorted together: a text's number is part of each of its words, so
suffixes never meet those of another text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import codes_of, column, text_slices, words_of

MIN_REPEAT = 8        # words; shorter repeats do not count as covered
MAX_COVERED = 0.15    # fraction of the words in later occurrences; Gopher's limits: 0.12 for 8 words to 0.15 for 5, 0.20 for lines
MAX_REPEAT = 40       # words of the longest repeat; about the 50 tokens of Lee et al. (2022)
MIN_WORDS = 50
WINDOW = 3
MAX_WINDOW_PERCENT = 50
SYMBOLS = "#*$%&|<>"


def suffix_array(owner: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, common prefix of each with the one before) of word sequences laid end to end.

    ``owner`` (ascending) says which text a word belongs to; prefixes end with their text.
    """
    n = len(codes)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends = np.searchsorted(owner, owner, side="right")
    _, inverse, counts = np.unique(owner * (int(codes.max()) + 1) + codes, return_inverse=True, return_counts=True)
    rank = (np.cumsum(counts) - counts)[inverse]  # the place of the first suffix that is equal so far
    levels, width = [rank.astype(np.int32)], 1
    active = np.flatnonzero(counts[inverse] > 1)
    while len(active):
        follow = active + width
        inside = follow < ends[active]
        second = np.where(inside, rank[np.minimum(follow, n - 1)] + 1, 0)
        key = rank[active] * (n + 1) + second
        order = np.argsort(key, kind="stable")
        active, key = active[order], key[order]
        base = rank[active]
        place = np.arange(len(active))
        new_group = np.r_[True, base[1:] != base[:-1]]
        first = np.maximum.accumulate(np.where(new_group, place, 0))      # of the old group
        new_key = np.r_[True, key[1:] != key[:-1]]
        start = np.maximum.accumulate(np.where(new_key, place, 0))        # of the new one
        rank = rank.copy()
        rank[active] = base + start - first
        single = new_key & np.r_[new_key[1:], True]
        active = active[~single]
        levels.append(rank.astype(np.int32))
        width *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    a, b = order[:-1], order[1:]
    common = np.zeros(n - 1, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + common, b + common
        inside = np.flatnonzero((x < ends[a]) & (y < ends[b]))
        same = levels[k][x[inside]] == levels[k][y[inside]]
        common[inside[same]] += 1 << k
    return order, np.r_[0, common]


def repeats(owner: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word, of the substrings that start there: (length of the longest that occurs again in
    its text, whether the one of MIN_REPEAT words occurs earlier in it).
    """
    order, common = suffix_array(owner, codes)
    longest, later = np.zeros(len(codes), np.int64), np.zeros(len(codes), bool)
    if len(codes):
        longest[order] = np.maximum(common, np.r_[common[1:], 0])
        # suffixes that share their first MIN_REPEAT words are neighbours
        starts = np.flatnonzero(np.r_[True, common[1:] < MIN_REPEAT])
        first = np.minimum.reduceat(order, starts)
        later[order] = order != np.repeat(first, np.diff(np.r_[starts, len(order)]))
    return longest, later


def covered(lengths: np.ndarray) -> np.ndarray:
    """Whether each word lies in one of the spans [i, i + lengths[i])."""
    at = np.flatnonzero(lengths)
    delta = np.zeros(len(lengths) + 1, np.int64)
    np.add.at(delta, at, 1)
    np.add.at(delta, at + lengths[at], -1)
    return np.cumsum(delta)[:-1] > 0


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


def measures(texts: pa.Array) -> dict[str, np.ndarray]:
    """The base columns and the repeats' measures of each text."""
    return _measures(texts)[0]


def _measures(texts: pa.Array) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """``measures``, and the words that later occurrences of repeats of MIN_REPEAT words cover."""
    n = len(texts)
    words, n_words = words_of(texts)
    owner = np.repeat(np.arange(n), n_words)
    codes, distinct = codes_of(words)
    chars = pc.utf8_length(distinct).to_numpy(zero_copy_only=False)
    longest, later = repeats(owner, codes)
    by_text = lambda x: np.bincount(owner, weights=x, minlength=n).astype(np.int64)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, owner, longest)
    symbols = pc.binary_length(pc.replace_substring_regex(texts, f"[^{SYMBOLS}]+", ""))
    return {
        "n_words": n_words, "word_chars": by_text(chars[codes]) if len(codes) else np.zeros(n, np.int64),
        "n_symbols": symbols.to_numpy(zero_copy_only=False).astype(np.int64),
        "n_dup_lines": np.array([duplicate_lines(t) for t in texts.to_pylist()], np.int64),
        # a window occurs again exactly where the longest repeat is no shorter than it
        "n_repeat_words": by_text(covered(np.where(longest >= WINDOW, WINDOW, 0))),
        "covered_words": by_text(covered(np.where(longest >= MIN_REPEAT, longest, 0))),
        "longest_repeat": top,
    }, by_text(covered(np.where(later, MIN_REPEAT, 0)))


def quality(docs: DataFrame, max_covered: float = MAX_COVERED, max_repeat: int = MAX_REPEAT,
            doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, the base columns, base_failed, kept, covered_words,
    longest_repeat, later_words.

    ``kept`` is false if the base rules fail, or if later occurrences of repeats of 8 words or
    more cover more than ``max_covered`` of the words (``later_words``; ``covered_words`` has the
    first ones too), or if the longest repeat has more than ``max_repeat`` words.  A null text
    has no words, and fails the base rules.
    """
    def run(batches):
        for rows, texts in text_slices(batches):
            m, later = _measures(texts)
            failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_WINDOW_PERCENT * m["n_words"])
            kept = ~failed & (later <= max_covered * m["n_words"]) & (m["longest_repeat"] <= max_repeat)
            names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), *[pa.array(m[k]) for k in names], pa.array(failed), pa.array(kept),
                 pa.array(m["covered_words"]), pa.array(m["longest_repeat"]), pa.array(later)],
                ["doc_id", *names, "base_failed", "kept", "covered_words", "longest_repeat", "later_words"])
    rows = docs.select(column(docs, doc_id).cast("long").alias("doc_id"), column(docs, text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                                "n_repeat_words long, base_failed boolean, kept boolean, covered_words long, "
                                "longest_repeat long, later_words long")
