"""LM scoring (operator 13): a weighted backoff automaton over n-grams of all training documents.

A token is a lower-cased word or the end of a text.  The probability of a token after a
history h is (1 - g) * c(h token) / c(h) + g * P(token after h without its first word); g is the
part of unseen events after histories as frequent as h, estimated from the n-grams that occur
once (a class for each power of two of c(h)).  Below one word it is the token's share, less what
unseen words get; these are one further token.

As an automaton: a state for each history, an arc for each n-gram that was seen, with its
probability, and a failure arc to the next shorter history, with weight g.  Each block of
documents gets the part of the automaton that its own n-grams can meet: it asks for the
corpus counts of its n-grams (``blocks``), builds states and arcs from the answers, and walks
each text once from left to right, carrying the state and adding up logarithms.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import blocks as B
from .common import codes_of, column, text_slices, words_of

ORDER = 2            # words of an n-gram at most
HELD_OUT = 2         # documents with this crc32(doc_id) mod 7 are never learned from
END = 0              # code of the end of a text; words have codes from 1
_END_KEY = 0x5851F42D4C957F2D
KEY_BITS = 56        # of an n-gram's key
_WALK = 512          # tokens of a piece of a long text, walked beside others
_BLOCK = ("block long, tokens long, doc_ids array<long>, held_out array<boolean>, sizes array<long>, "
          "codes binary, words binary")


def held_out(doc_id):
    """crc32 of the id as text, mod 7, is 2 (a null id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 7 == HELD_OUT


def _tokenise(batches):
    part, at = TaskContext.get().partitionId(), 0
    for rows, texts in text_slices(batches, limit=B.BLOCK_BYTES):
        words, counts = words_of(pc.ascii_lower(texts))
        codes, distinct = codes_of(words)
        often = np.bincount(codes, minlength=len(distinct))
        order = np.argsort(-often, kind="stable")  # frequent words get small codes, which compress
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(1, len(order) + 1)
        ends = np.cumsum(counts + 1) - 1
        tokens = np.full(int(ends[-1]) + 1, -1, np.int64)
        tokens[ends] = END
        tokens[tokens < 0] = rank[codes] if len(codes) else codes
        yield pa.RecordBatch.from_arrays(
            [pa.array([(part << 33) + at]), pa.array([len(tokens)]), pa.array([rows.column(0).to_pylist()], pa.list_(pa.int64())),
             pa.array([rows.column(1).to_pylist()], pa.list_(pa.bool_())), pa.array([(counts + 1).tolist()], pa.list_(pa.int64())),
             pa.array([B.squeeze(tokens.astype("<u4"))], pa.binary()),
             pa.array([B.squeeze_words(distinct.take(pa.array(order)).to_pylist())], pa.binary())],
            ["block", "tokens", "doc_ids", "held_out", "sizes", "codes", "words"])
        at += 1


@dataclass
class Level:
    """The distinct n-grams of a block of one length: keys, own training counts, and by place in the level below
    the n-gram without its last and without its first word; ``word`` is the last word's code."""
    keys: np.ndarray
    counts: np.ndarray
    prefix: np.ndarray
    suffix: np.ndarray
    word: np.ndarray


class Block:
    """The tokens of a stored block, and its n-grams of 1 to ``order`` words."""

    def __init__(self, row: dict, order: int, counted: bool = False, suffixes: bool = True):
        self.tokens = B.expand(row["codes"], "<u4").astype(np.int64)
        self.sizes = np.array(row["sizes"], np.int64)
        words = B.expand_words(row["words"])
        base = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))
        base = np.concatenate([np.array([_END_KEY], np.uint64), base])
        learned = np.repeat(~np.array(row["held_out"], bool), self.sizes)
        n = len(base)
        own = np.bincount(self.tokens[learned], minlength=n) if counted else np.zeros(n, np.int64)
        none = np.zeros(n, np.int64)
        self.levels = [Level(base, own, none, none, np.arange(n))]
        starts = np.cumsum(self.sizes) - self.sizes
        inside = np.arange(len(self.tokens)) - np.repeat(starts, self.sizes)  # tokens before each in its text
        at = self.tokens  # place in the level of the n-gram that ends at each token (where it fits)
        for m in range(2, order + 1):
            here = np.flatnonzero(inside >= m - 1)
            pair = at[here - 1] * n + self.tokens[here]
            if m == order and not (counted or suffixes):
                distinct, place = np.sort(pair), None
                distinct = distinct[np.diff(distinct, prepend=-1) != 0]
            else:
                distinct, place = B.distinct_places(pair)
            before, word = distinct // n, distinct % n
            suffix = np.zeros(len(distinct), np.int64)
            if place is not None:
                suffix[place] = at[here]
            own = np.bincount(place[learned[here]], minlength=len(distinct)) if counted else np.zeros(len(distinct), np.int64)
            self.levels.append(Level(B.mixed(self.levels[-1].keys[before], base[word]), own, before, suffix, word))
            if m < order:
                at = np.full(len(self.tokens), -1, np.int64)
                at[here] = place

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """All keys, ascending and distinct, and the place of each n-gram's key among them, level after level."""
        return B.distinct_places(np.concatenate([x.keys for x in self.levels]) >> np.uint64(64 - KEY_BITS))

    def learn(self, replies) -> list[tuple[np.ndarray, np.ndarray]]:
        """Corpus counts, and whether this block speaks for the n-gram, by level."""
        found = B.joined(replies, "<i8")[self.keys()[1]]
        cuts = np.cumsum([len(x.keys) for x in self.levels])[:-1]
        return [(x >> 1, (x & 1) == 1) for x in np.split(found, cuts)]


def _classes(counts: np.ndarray) -> np.ndarray:
    return np.frexp(counts.astype(float))[1]  # of 1, 2 to 3, 4 to 7, ...


def _asker(order: int, buckets: int):
    def run(batches):
        for row in B.rows(batches):
            b = Block(row, order, counted=True, suffixes=False)
            keys, place = b.keys()
            counts = np.bincount(place, weights=np.concatenate([x.counts for x in b.levels]), minlength=len(keys))
            yield from B.ask(row["block"], keys, counts.astype(np.int64), buckets, KEY_BITS)
    return run


def _reply(total: np.ndarray, first: np.ndarray) -> np.ndarray:
    return (2 * total + first).astype("<i8")


def _statistics(order: int):
    """Rows (level, class, tokens, types, once) of the n-grams that the block speaks for, by the class of their history."""
    def run(batches):
        sums: dict[tuple[int, int], np.ndarray] = {}
        for row in B.rows(batches):
            b = Block(row, order, suffixes=False)
            known = b.learn(row["replies"])
            for m, (x, (c, first)) in enumerate(zip(b.levels, known), 1):
                own = first & (c > 0)
                of = _classes(known[m - 2][0][x.prefix[own]]) if m > 1 else np.zeros(int(own.sum()), int)
                for k in np.unique(of):
                    n = c[own][of == k]
                    sums[m, int(k)] = sums.get((m, int(k)), 0) + np.array([n.sum(), len(n), (n == 1).sum()], np.int64)
        if sums:
            at = list(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in at], pa.int32()), pa.array([k for _, k in at], pa.int32()),
                 *[pa.array([int(sums[x][i]) for x in at], pa.int64()) for i in range(3)]],
                ["level", "class", "tokens", "types", "once"])
    return run


@dataclass
class Smoothing:
    """Training tokens, distinct ones, the part of unseen words, and the part g by (level, class of history)."""
    tokens: int
    types: int
    unseen: float
    backoff: dict[tuple[int, int], float]

    def parts(self, level: int, counts: np.ndarray) -> np.ndarray:
        table = np.array([self.backoff.get((level, k), 0.5) for k in range(66)])
        return table[_classes(counts)]


def smoothing(rows: list[dict]) -> Smoothing:
    """From the sums by level and class (a few numbers whatever the corpus)."""
    part = {(r["level"], r["class"]): (r["once"] + 1) / (r["tokens"] + 2) for r in rows}
    base = next((r for r in rows if r["level"] == 1), {"tokens": 0, "types": 0, "once": 0})
    unseen = part[1, 0] if base["tokens"] else 1.0
    return Smoothing(base["tokens"], base["types"], unseen, {k: v for k, v in part.items() if k[0] > 1})


class Automaton:
    """States 0 (no history) and one a history; arcs by (state, code); failure arcs."""

    def __init__(self, b: Block, counts: list[np.ndarray], model: Smoothing):
        order, self.width = len(b.levels), len(b.levels[0].keys)
        c = counts[0]
        p = np.where(c > 0, (1 - model.unseen) * c / max(1, model.tokens), model.unseen)
        state, self.fail, self.weight, n_states = None, [np.zeros(1, np.int64)], [np.zeros(1)], 1
        arcs, logs, to = [], [], []
        for m, x in enumerate(b.levels, 1):
            c = counts[m - 1]
            if m > 1:
                seen = np.flatnonzero(c > 0)
                h = x.prefix[seen]
                g = model.parts(m, counts[m - 2][h])
                q = np.zeros(len(c))
                q[seen] = (1 - g) * c[seen] / counts[m - 2][h] + g * p[x.suffix[seen]]
                p = q
            short = state[x.suffix] if m > 1 else np.zeros(len(c), np.int64)
            own = short  # the state after the n-gram: its own, or that of the longest shorter history
            if m < order:
                is_state = (c > 0) & (x.word != END)
                own = short.copy()
                own[is_state] = n_states + np.arange(int(is_state.sum()))
                n_states += int(is_state.sum())
                self.fail.append(short[is_state])
                self.weight.append(np.log10(model.parts(m + 1, c[is_state])))
            if m == 1:
                self.root_log, self.root_to = np.log10(p), own
            else:
                arcs.append(state[x.prefix[seen]] * self.width + x.word[seen])
                logs.append(np.log10(p[seen]))
                to.append(own[seen])
            state = own
        self.fail, self.weight = np.concatenate(self.fail), np.concatenate(self.weight)
        arcs = np.concatenate([*arcs, np.array([np.iinfo(np.int64).max])])
        by = np.argsort(arcs)
        self.arcs = arcs[by]
        self.arc_log, self.arc_to = np.concatenate([*logs, np.zeros(1)])[by], np.concatenate([*to, np.zeros(1, np.int64)])[by]

    def step(self, state: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(next state, log10 probability): an arc of the state, else its failure arc and again."""
        log, out, state = np.zeros(len(state)), np.zeros(len(state), np.int64), state.copy()
        todo = np.arange(len(state))
        while len(todo):
            s, w = state[todo], code[todo]
            at = np.searchsorted(self.arcs, s * self.width + w)
            hit, root = self.arcs[at] == s * self.width + w, s == 0
            log[todo[root]] += self.root_log[w[root]]
            out[todo[root]] = self.root_to[w[root]]
            hit &= ~root
            log[todo[hit]] += self.arc_log[at[hit]]
            out[todo[hit]] = self.arc_to[at[hit]]
            miss = ~(hit | root)
            todo, s = todo[miss], s[miss]
            log[todo] += self.weight[s]
            state[todo] = self.fail[s]
        return out, log

    def walk(self, tokens: np.ndarray, sizes: np.ndarray, order: int, piece: int = _WALK) -> np.ndarray:
        """The log10 probability of each text.

        All texts advance by one token at a time.  A text of over ``piece`` tokens goes in pieces: the
        state before a piece depends on the ``order`` - 1 tokens before it alone, so it comes from walking these.
        """
        starts = np.cumsum(sizes) - sizes
        n = -(-sizes // piece)
        text = np.repeat(np.arange(len(sizes)), n)
        first = starts[text] + piece * (np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n))
        length = np.minimum(first + piece, (starts + sizes)[text]) - first
        by = np.argsort(-length, kind="stable")
        text, first, length = text[by], first[by], length[by]
        state = np.zeros(len(text), np.int64)
        for back in range(order - 1, 0, -1):
            here = np.flatnonzero(first - back >= starts[text])
            state[here] = self.step(state[here], tokens[first[here] - back])[0]
        total = np.zeros(len(text))
        going = np.searchsorted(-length, -np.arange(1, int(length.max(initial=0)) + 1), side="right")
        for t, k in enumerate(going):
            state[:k], log = self.step(state[:k], tokens[first[:k] + t])
            total[:k] += log
        return np.bincount(text, weights=total, minlength=len(sizes))


def _scorer(order: int, model: Smoothing):
    def run(batches):
        for row in B.rows(batches):
            b = Block(row, order)
            counts = [c for c, _ in b.learn(row["replies"])]
            of = counts[0][b.tokens]
            starts = np.cumsum(b.sizes) - b.sizes
            base = np.log10((of + 1) / (model.tokens + model.types + 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), pa.array(row["held_out"], pa.bool_()), pa.array(b.sizes),
                 pa.array(np.add.reduceat((of > 0).astype(np.int64), starts)),
                 pa.array(np.full(len(b.sizes), model.tokens, np.int64)), pa.array(np.add.reduceat(base, starts)),
                 pa.array(Automaton(b, counts, model).walk(b.tokens, b.sizes, order))],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


def score(docs: DataFrame, order: int = ORDER, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The model is of all rows that are not held out, whole texts; ``score`` is the log10 probability
    of the text and its end, ``base_score`` that of single words with one added to each count.  A
    null or empty text is its end alone.  Rows that repeat an id, or have none, are rows like
    others (no id counts as training).  Without training rows every token is unseen and has
    probability 1.  An empty table gives no rows.  N-grams are told apart by 56-bit keys.
    """
    key = column(docs, doc_id)
    rows = docs.select(key.cast("long").alias("doc_id"), held_out(key).alias("held_out"),
                       column(docs, text).cast("string").alias("text"))
    stored = materialize(rows.mapInArrow(_tokenise, _BLOCK), "blocks")
    asked = stored.mapInArrow(_asker(order, B.bucket_count(stored, order)), B.QUESTIONS)
    known = materialize(B.with_answers(stored, B.answers(asked, _reply)), "known")
    sums = known.mapInArrow(_statistics(order), "level int, class int, tokens long, types long, once long")
    sums = sums.groupBy("level", "class").agg(*[F.sum(x).alias(x) for x in ("tokens", "types", "once")]).collect()
    model = smoothing([r.asDict() for r in sums])  # at most 64 classes a level
    return known.mapInArrow(_scorer(order, model), "doc_id long, held_out boolean, n_tokens long, n_known long, "
                                                   "train_tokens long, base_score double, score double")
