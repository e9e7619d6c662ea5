"""Phrase collocation mining (operator 11): an FM-index over word ids for each shard, summed across shards.

A shard is a block of documents.  Its words, numbered by lang and spelling, form one text with a
separator before each piece; the index has the Burrows-Wheeler transforms of this text and of
its reverse.  Interval extension in both directions enumerates all n-grams up to a depth:
extending an n-gram to the left gives every (n+1)-gram that ends with it and its count, to the
right every one that begins with it.

Counts of all shards are summed in two steps.  First each shard asks, by hashed keys
(``blocks``), which of its n-grams may be frequent over all shards: a key's sum is at least its
n-gram's, so no frequent one is missed.  Then it tells the words and counts of these alone, and
exact sums decide.  Scores join each phrase to its first and its last words; a phrase's
extensions are the rows that it is the beginning or the end of.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize
from . import blocks as B
from .common import codes_of, column, text_slices, words_of

DEPTH = 3          # words of a phrase at most
LEAST = 10         # occurrences of a phrase
ABSORBED = 50      # percent: a longer phrase with so many of its occurrences replaces it
TOP = 2000         # phrases of a lang
SCALE = 1_000_000
NO_LANG = "und"
KEY_BITS = 48      # of a hashed n-gram: others with the same key cost a row, no result
_SEPARATOR = "."
_SPLIT = r"[.,;:!?\x0A-\x0D]+"
_PARTS = 64        # of a lang, each giving its own best
_BLOCK = "block long, tokens long, codes binary, words binary, of binary, langs array<string>"


def _index_blocks(batches):
    part, at = TaskContext.get().partitionId(), 0
    for rows, texts in text_slices(batches, limit=B.BLOCK_BYTES):
        lang, langs = codes_of(rows.column(rows.schema.get_field_index("lang")).cast(pa.string()))
        words, counts = words_of(pc.replace_substring_regex(pc.ascii_lower(texts), _SPLIT, f" {_SEPARATOR} "))
        codes, distinct = codes_of(words)
        del words
        cut = pc.equal(distinct, _SEPARATOR).to_numpy(zero_copy_only=False)
        # ids from 1 by falling frequency, of pairs of lang and word; 0 separates pieces and documents
        pair = np.repeat(lang, counts) * len(distinct) + codes
        pair[cut[codes] if len(codes) else []] = -1
        pair += 1
        pairs, place = B.distinct_places(pair)
        del pair
        pairs, often = pairs - 1, np.bincount(place)
        of_cut = len(pairs) and pairs[0] == -1
        pairs, often = pairs[int(of_cut):], often[int(of_cut):]
        order = np.argsort(-often, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(1, len(order) + 1)
        rank = np.concatenate([np.zeros(int(of_cut), np.int64), rank])
        text = np.zeros(len(codes) + len(counts) + 1, "<u4")
        inside = np.ones(len(text), bool)
        inside[np.cumsum(counts + 1) - counts - 1] = False
        inside[-1] = False
        text[inside] = rank[place] if len(place) else []
        del codes, place, inside
        text = text[np.r_[True, (text[1:] != 0) | (text[:-1] != 0)]]  # one separator is enough
        yield pa.RecordBatch.from_arrays(
            [pa.array([(part << 33) + at]), pa.array([len(text)]), pa.array([B.squeeze(text)], pa.binary()),
             pa.array([B.squeeze_words(distinct.take(pa.array(pairs[order] % max(1, len(distinct)))).to_pylist())], pa.binary()),
             pa.array([B.squeeze((pairs[order] // max(1, len(distinct))).astype("<u4"))], pa.binary()),
             pa.array([langs.to_pylist()], pa.list_(pa.string()))],
            ["block", "tokens", "codes", "words", "of", "langs"])
        at += 1


def _bits(n: int) -> int:
    return max(1, int(n).bit_length())


def _number(most: int) -> type:
    """The signed type of numbers up to ``most``: half the memory where 32 bits do."""
    return np.int32 if most < 1 << 31 else np.int64


def _order(rank: np.ndarray, then: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The positions in the order of (rank, then), and the rank of each position in it."""
    n = len(rank)
    a, b, c = _bits(rank.max(initial=0)), _bits(then.max(initial=0)), _bits(n)
    if a + b + c <= 64:  # a plain sort of one number each
        packed = rank.astype(np.uint64)
        packed <<= np.uint64(b)
        packed |= then.astype(np.uint64)
        packed <<= np.uint64(c)
        packed |= np.arange(n, dtype=np.uint64)
        packed.sort()
        by = (packed & np.uint64((1 << c) - 1)).astype(_number(n))
        packed >>= np.uint64(c)
        new = np.zeros(n, bool)
        np.not_equal(packed[1:], packed[:-1], out=new[1:])
        del packed
    else:
        by = np.lexsort([then, rank])
        new = np.r_[False, (np.diff(rank[by]) != 0) | (np.diff(then[by]) != 0)]
    out = np.empty(n, _number(n))
    out[by] = np.cumsum(new, dtype=out.dtype)
    return by, out


class FmIndex:
    """Intervals of n-grams of a coded text, of up to ``depth`` words, that can be extended to either side.

    Suffixes are ordered by their first ``depth`` words, which fixes the intervals of all n-grams
    that short; the same holds for the reverse.  Code 0 separates pieces and is in no n-gram; the
    text begins and ends with it.
    """

    def __init__(self, text: np.ndarray, depth: int):
        n = len(text)
        self.size = _bits(n)
        counts = np.bincount(text)
        text = text.astype(_number(len(counts)))
        self.first = np.concatenate([[0], np.cumsum(counts)])  # of each symbol's interval
        self.left = text[self._sorted(text, depth) - 1]              # BWT
        self.right = text[(n - self._sorted(text[::-1], depth)) % n]  # of the reverse

    @cached_property
    def left_at(self) -> np.ndarray:
        return self._places(self.left)

    @cached_property
    def right_at(self) -> np.ndarray:
        return self._places(self.right)

    @staticmethod
    def _sorted(text: np.ndarray, depth: int) -> np.ndarray:
        by, rank = _order(text, np.roll(text, -1))
        for k in range(2, depth):
            del by  # not needed while the next one is made
            by, rank = _order(rank, np.roll(text, -k))
        return by

    def _places(self, bwt: np.ndarray) -> np.ndarray:
        """All (symbol, place) as one ascending number each: rank queries are binary searches in it."""
        return np.sort((bwt.astype(np.uint64) << np.uint64(self.size)) | np.arange(len(bwt), dtype=np.uint64))

    def _rank(self, places: np.ndarray, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the interval of ``symbol`` put before (the reverse: after) an interval that starts at ``at`` starts."""
        return np.searchsorted(places, (symbol.astype(np.uint64) << np.uint64(self.size)) | at.astype(np.uint64))

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(word, start, start in the reverse, count) of all single words."""
        w = np.arange(1, len(self.first) - 1)
        return w, self.first[w], self.first[w], self.first[w + 1] - self.first[w]

    def extend(self, start: np.ndarray, back: np.ndarray, count: np.ndarray, to_left: bool):
        """(owner, word, start, back, count): all n-grams with one word more on that side than those of the intervals.

        ``start`` and ``back`` are the starts of the intervals in the index and in the reverse.
        """
        near, far = (start, back) if to_left else (back, start)
        owner, word, smaller, n = self._extended(near, count, to_left)
        near, far = self._moved(word, near[owner], to_left), far[owner] + smaller
        return (owner, word, *((near, far) if to_left else (far, near)), n)

    def _extended(self, near: np.ndarray, count: np.ndarray, to_left: bool):
        """(owner, word, shift of the interval in the other index, count) of the n-grams with one word more on that side."""
        bwt, bits = self.left if to_left else self.right, _bits(len(self.first))
        begins = np.cumsum(count) - count
        at = np.repeat(near - begins, count)
        at += np.arange(len(at))
        pairs = np.repeat(np.arange(len(count)) << bits, count)
        pairs |= bwt[at]
        del at
        pairs.sort()
        new = np.ones(len(pairs), bool)
        np.not_equal(pairs[1:], pairs[:-1], out=new[1:])
        firsts = np.flatnonzero(new)
        n, pair = np.diff(np.append(firsts, len(pairs))), pairs[firsts]
        del pairs, new
        real = (pair & ((1 << bits) - 1)) > 0
        pair, n, firsts = pair[real], n[real], firsts[real]
        owner, word = pair >> bits, (pair & ((1 << bits) - 1)).astype(bwt.dtype)
        return owner, word, firsts - begins[owner], n  # the shift: symbols before this one in the interval

    def _moved(self, word: np.ndarray, near: np.ndarray, to_left: bool) -> np.ndarray:
        return self._rank(self.left_at if to_left else self.right_at, word, near)

    def ngrams(self, depth: int):
        """(rows of words, counts) of all n-grams of each length, by extension to the left and to the right in turn.

        A length's starts are found where a later length needs them: the next one extends on the
        other side, the one after it on this side again.
        """
        word, near, far, count = self.words()
        rows = word[:, None].astype(self.left.dtype)
        yield rows, count
        for m in range(2, depth + 1):
            to_left = m % 2 == 0
            owner, word, shift, count = self._extended(near, count, to_left)
            rows = np.column_stack([word, rows[owner]] if to_left else [rows[owner], word])
            if m < depth:  # this side's turn is over: its starts are the far ones now
                near, far = far[owner] + shift, self._moved(word, near[owner], to_left) if m + 1 < depth else None
            del owner, word, shift
            yield rows, count


def _ngrams(row: dict, depth: int):
    """Words, langs, and an iterator of the n-grams of a stored block: of each length rows of words, counts and keys."""
    words, of = B.expand_words(row["words"]), B.expand(row["of"], "<u4").astype(np.int64)

    def levels():
        seeds = [xxhash.xxh3_64_intdigest(x) for x in row["langs"]]
        base = np.fromiter((xxhash.xxh3_64_intdigest(w, seed=seeds[k]) for w, k in zip(words, of.tolist())), np.uint64, len(words))
        base = np.concatenate([np.zeros(1, np.uint64), base])
        for rows, count in FmIndex(B.expand(row["codes"], "<u4"), depth).ngrams(depth):
            key = base[rows[:, 0]]
            for k in range(1, rows.shape[1]):
                key = B.mixed(key, base[rows[:, k]])
            yield rows, count.astype(_number(count.max(initial=0))), key >> np.uint64(64 - KEY_BITS)
    return words, of, levels()


def _asker(depth: int, buckets: int):
    def run(batches):
        for row in B.rows(batches):
            counts, keys = zip(*((c, k) for _, c, k in _ngrams(row, depth)[2]))
            counts, keys = np.concatenate(counts), np.concatenate(keys)
            distinct, place = B.distinct_places(keys)
            del keys
            counts = np.bincount(place, weights=counts, minlength=len(distinct)).astype(np.int64)
            del place
            yield from B.ask(row["block"], distinct, counts, buckets, KEY_BITS)
    return run


def _teller(depth: int):
    """Rows (lang, size, phrase, n) of the n-grams that may be frequent; size 0 has all words of a lang."""
    def run(batches):
        for row in B.rows(batches):
            words, of, levels = _ngrams(row, depth)
            grams, keys = [], []
            for rows, count, key in levels:
                grams.append((rows, count))
                keys.append(key)
            rows = count = key = None
            keys = np.concatenate(keys)
            frequent = B.joined(row["replies"], "u1").astype(bool)[B.distinct_places(keys)[1]]
            del keys
            langs, names = pa.array(row["langs"], pa.string()), pa.array(["", *words], pa.string())
            n_lang = np.bincount(of[grams[0][0][:, 0] - 1], weights=grams[0][1], minlength=len(langs)).astype(np.int64)
            yield _told(langs, np.zeros(len(langs), np.int32), pa.array([""] * len(langs), pa.string()), n_lang)
            at = 0
            for m, (rows, count) in enumerate(grams, 1):
                rows, count, at = rows[here := frequent[at:at + len(rows)]], count[here], at + len(rows)
                for a in range(0, len(rows), 1 << 16):
                    some = rows[a:a + (1 << 16)]
                    phrase = names.take(pa.array(some[:, 0]))
                    for k in range(1, m):
                        phrase = pc.binary_join_element_wise(phrase, names.take(pa.array(some[:, k])), " ")
                    yield _told(langs.take(pa.array(of[some[:, 0] - 1])), np.full(len(some), m, np.int32), phrase, count[a:a + (1 << 16)])
    return run


def _told(lang, size, phrase, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([lang, pa.array(size), phrase, pa.array(np.ascontiguousarray(n, np.int64))],
                                      ["lang", "size", "phrase", "n"])


def counts(docs: DataFrame, depth: int = DEPTH, least: int = LEAST, text: str = "text", lang: str = "lang") -> DataFrame:
    """Rows (lang, size, phrase, n): the n-grams of up to ``depth`` words with ``least`` occurrences or more in a lang.

    A row of size 0 has the number of all words of the lang.  A null text is empty, a null lang ``und``.
    """
    rows = docs.select(F.coalesce(column(docs, lang).cast("string"), F.lit(NO_LANG)).alias("lang"), column(docs, text).cast("string").alias("text"))
    stored = materialize(rows.mapInArrow(_index_blocks, _BLOCK), "shards")
    asked = stored.mapInArrow(_asker(depth, B.bucket_count(stored, depth)), B.QUESTIONS)
    replies = B.answers(asked, lambda total, first: (total >= least).astype("u1"))
    told = B.with_answers(stored, replies).mapInArrow(_teller(depth), "lang string, size int, phrase string, n long")
    total = told.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))
    return total.filter((F.col("size") == 0) | (F.col("n") >= least))


def _scored(found: DataFrame, depth: int) -> DataFrame:
    """Rows (lang, phrase, a, l, r, score, longer); ``longer`` is the largest count among the extensions, or null.

    ``_heads`` and ``_rests`` hold the counts of a phrase's first words, and of the words after them, by cut.
    """
    none = F.array().cast("array<long>")
    below = found.filter("size = 1").select("lang", "phrase", "n", none.alias("_heads"), none.alias("_rests"))
    levels = []
    for m in range(2, depth + 1):
        here = found.filter(F.col("size") == m).select(
            "lang", "phrase", "n", F.regexp_replace("phrase", " [^ ]*$", "").alias("_head"), F.regexp_replace("phrase", "^[^ ]* ", "").alias("_tail"))
        head = below.select("lang", F.col("phrase").alias("_head"), F.concat("_heads", F.array("n")).alias("_heads"))
        tail = below.select("lang", F.col("phrase").alias("_tail"), F.concat(F.array("n"), "_rests").alias("_rests"))
        below = materialize(here.join(head, ["lang", "_head"]).join(tail, ["lang", "_tail"]), f"phrases-{m}")
        levels.append(below)
    out = []
    for i, level in enumerate(levels):
        big = lambda c: c.cast("decimal(19,0)")
        # the score, then the cut, ascending: the smallest is the first lowest score
        cuts = F.transform("_heads", lambda head, k: F.struct(
            F.call_function("div", (big(F.col("n")) * big(F.col("n")) * F.lit(SCALE).cast("decimal(7,0)")).cast("decimal(38,0)"),
                            big(head) * big(F.element_at("_rests", k + 1))).alias("score"),
            k.alias("cut"), head.alias("l"), F.element_at("_rests", k + 1).alias("r")))
        level = level.withColumn("_cut", F.array_min(cuts))
        scored = level.select("lang", "phrase", F.col("n").alias("a"), F.col("_cut.l").alias("l"), F.col("_cut.r").alias("r"), F.col("_cut.score").alias("score"))
        if i + 1 < len(levels):
            above = levels[i + 1]
            longer = (above.select("lang", F.col("_head").alias("phrase"), "n").union(above.select("lang", F.col("_tail").alias("phrase"), "n"))
                      .groupBy("lang", "phrase").agg(F.max("n").alias("longer")))
            scored = scored.join(longer, ["lang", "phrase"], "left")
        else:
            scored = scored.withColumn("longer", F.lit(None).cast("long"))
        out.append(scored)
    whole = out[0]
    for x in out[1:]:
        whole = whole.unionByName(x)
    return whole


def collocations(docs: DataFrame, depth: int = DEPTH, least: int = LEAST, absorbed: int = ABSORBED, top: int = TOP,
                 text: str = "text", lang: str = "lang") -> DataFrame:
    """Rows lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each lang by score.

    ``a``, ``l`` and ``r`` are the occurrences of the phrase, of its first part and of the rest at
    the cut with the lowest score, ``n`` all words of the lang.  A phrase is left out where a
    longer one that holds it has ``absorbed`` percent of its occurrences or more: the longest
    ones decide, as each holds all shorter ones between.  Ties go by occurrences, then by the
    phrase's bytes.  Null texts are empty, a null lang is ``und``, repeated rows count; langs
    without a phrase, and an empty table, give no rows.
    """
    found = materialize(counts(docs, depth, least, text, lang), "ngrams")
    kept = _scored(found, depth).filter(F.col("longer").isNull() | (100 * F.col("longer") < absorbed * F.col("a")))
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the best of each of some parts of a lang first: a large lang never meets in one task whole
    by_part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(_PARTS))).orderBy(*best)
    some = kept.withColumn("_at", F.row_number().over(by_part)).filter(F.col("_at") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).filter(F.col("rank") <= top)
    words = found.filter("size = 0").select("lang", F.col("n").alias("_n"))
    return ranked.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                                             F.col("_n").alias("n"), F.col("score").cast("long").alias("score"))


ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
split AS (
  SELECT lang, row_number() OVER () AS id, [x for x in regexp_split_to_array(piece, '[\x20\x09]+') if x <> ''] AS ws FROM pieces),
w AS (SELECT lang, id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM split),
near AS (
  SELECT lang, w AS w1, lead(w) OVER piece AS w2, lead(w, 2) OVER piece AS w3 FROM w WINDOW piece AS (PARTITION BY id ORDER BY i)),
g AS (
  SELECT lang, 1 AS m, w1 AS phrase, count(*) AS a FROM near GROUP BY ALL
  UNION ALL
  SELECT lang, 2, w1 || ' ' || w2, count(*) FROM near WHERE w2 IS NOT NULL GROUP BY ALL
  UNION ALL
  SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) FROM near WHERE w3 IS NOT NULL GROUP BY ALL),
total AS (SELECT lang, sum(a)::BIGINT AS n FROM g WHERE m = 1 GROUP BY lang),
c AS (SELECT * FROM g WHERE m >= 2 AND a >= 10),
parts AS (
  SELECT c.*, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS head, array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS rest
  FROM c, range(1, 3) AS t(k) WHERE k < m),
cuts AS (
  SELECT parts.*, h.a AS l, r.a AS r, (1000000::HUGEINT * parts.a * parts.a) // (h.a::HUGEINT * r.a) AS score
  FROM parts JOIN g h ON h.lang = parts.lang AND h.phrase = parts.head JOIN g r ON r.lang = parts.lang AND r.phrase = parts.rest),
low AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
  SELECT lang, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '), array_to_string(string_split(phrase, ' ')[2:3], ' ')]) AS phrase, a
  FROM c WHERE m = 3),
kept AS (
  SELECT low.* FROM low LEFT JOIN (SELECT lang, phrase, max(a) AS most FROM longer GROUP BY ALL) x USING (lang, phrase)
  WHERE most IS NULL OR 100 * most < 50 * a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT ranked.lang, rank, phrase, a, l, r, n, score::BIGINT AS score
FROM ranked JOIN total ON total.lang = ranked.lang WHERE rank <= 2000
"""
