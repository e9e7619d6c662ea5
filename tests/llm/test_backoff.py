"""The backoff automaton against a dictionary model that scores token by token."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from doctriage.llm import backoff


def tokens_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in lower.replace("\t", " ").replace("\n", " ").replace("\v", " ").replace("\f", " ")
            .replace("\r", " ").split(" ") if w] + [None]


def is_held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def brute(rows, order):
    """(score of a token list, base score, N, V, probability)."""
    grams = Counter()
    for d, text, *_ in rows:
        if not is_held(d):
            t = tokens_of(text)
            grams.update(tuple(t[i:i + m]) for m in range(1, order + 1) for i in range(len(t) - m + 1))
    words = {g[0]: c for g, c in grams.items() if len(g) == 1}
    n = sum(words.values())
    once, total = Counter(), Counter()
    for g, c in grams.items():
        k = (len(g), grams[g[:-1]].bit_length() if len(g) > 1 else 0)
        once[k] += c == 1
        total[k] += c
    part = {k: (once[k] + 1) / (total[k] + 2) for k in total}
    unseen = part[1, 0] if n else 1.0

    def p(h, w):
        if not h:
            return (1 - unseen) * words[w] / n if w in words else unseen
        c = grams[h] if h[-1] is not None else 0
        if not c:
            return p(h[1:], w)
        g = part.get((len(h) + 1, c.bit_length()), 0.5)
        return (1 - g) * grams[(*h, w)] / c + g * p(h[1:], w)

    def log(t):
        return sum(math.log10(p(tuple(t[max(0, i - order + 1):i]), w)) for i, w in enumerate(t))

    def base(t):
        return sum(math.log10((words.get(w, 0) + 1) / (n + len(words) + 1)) for w in t)
    return log, base, n, words, p


def small_rows():
    rng = np.random.default_rng(7)
    words = [f"w{i}" for i in range(40)] + ["The", "the", "ÜB", "a"]
    odds = 1 / np.arange(1, len(words) + 1)
    rows = [(i, " ".join(rng.choice(words, size=rng.integers(0, 60), p=odds / odds.sum()))) for i in range(60)]
    rows += [(200 + i, rows[3][1] + " the a") for i in range(5)] + [(300, "only here novel\twords\nThe the")]
    return rows


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_against_dictionary_model(frame, odd_rows, order, monkeypatch):
    rows = small_rows() + [(r[0], r[1]) for r in odd_rows]
    log, base, n, words, p = brute(rows, order)
    got = backoff.score(frame(rows), order).collect()
    assert len(got) == len(rows) and {r.train_tokens for r in got} == {n}
    want = {}
    for d, text in rows:
        t = tokens_of(text)
        want.setdefault((d, is_held(d), len(t), sum(w in words for w in t)), []).append((base(t), log(t)))
    for r in got:
        options = want[r.doc_id, r.held_out, r.n_tokens, r.n_known]
        assert any(math.isclose(r.base_score, b, rel_tol=1e-9, abs_tol=1e-9) and math.isclose(r.score, s, rel_tol=1e-9, abs_tol=1e-9)
                   for b, s in options)
    # probabilities after a history sum to one over all words and the unseen one
    for h in [(), ("w0",), ("the",), ("w1", "w0")][: order]:
        h = h[-(order - 1):] if order > 1 else ()
        assert math.isclose(sum(p(h, w) for w in [*words, "unseen word"]), 1, rel_tol=1e-9)


def test_pieces_carry_the_state():
    rng = np.random.default_rng(1)
    tokens = rng.integers(1, 6, 500)
    sizes = np.array([200, 1, 299])
    tokens[np.cumsum(sizes) - 1] = 0
    row = {"codes": backoff.B.squeeze(tokens.astype("<u4")), "sizes": sizes.tolist(), "held_out": [False] * 3,
           "words": backoff.B.squeeze_words(list("abcde"))}
    b = backoff.Block(row, 3, True)
    model = backoff.Smoothing(500, 6, 0.01, {})
    a = backoff.Automaton(b, [x.counts for x in b.levels], model)
    whole = a.walk(b.tokens, b.sizes, 3)
    for piece in (1, 2, 7, 199, 200):
        assert np.allclose(a.walk(b.tokens, b.sizes, 3, piece), whole, rtol=1e-12)


def test_held_out_documents_are_likelier_than_by_single_words(spark):
    got = backoff.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    assert len(got) == 1000
    held = [r for r in got if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)
    learned = [r for r in got if not r.held_out]
    assert sum(r.n_tokens for r in learned) == got[0].train_tokens and all(r.n_known == r.n_tokens for r in learned)


def test_odd_tables(frame):
    assert backoff.score(frame([])).count() == 0
    none = next(i for i in range(100) if is_held(i))
    got = backoff.score(frame([(none, "a b c"), (none, None)])).collect()
    assert {(r.train_tokens, r.n_known, r.base_score, r.score) for r in got} == {(0, 0, 0.0, 0.0)}
    alone = backoff.score(frame([(None, None), (None, "")])).collect()
    assert {(r.n_tokens, r.n_known, r.train_tokens) for r in alone} == {(1, 1, 2)}
