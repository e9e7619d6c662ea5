"""Operators 3 and 6 on small tables, word by word in plain Python."""

import math
import re
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pytest

from doctriage.llm import language, toxicity

WORD = re.compile("[^\x20\x09-\x0D]+")


def is_kind(c, *kinds):
    return unicodedata.category(c)[0] in kinds


def gram_hashes(word):
    """The three bytes around each byte of a word with its ends, hashed to 16 bits."""
    raw = b"\0" + word.encode() + b"\0"
    mask = 0xFFFFFFFF
    for a, b, c in zip(raw, raw[1:], raw[2:]):
        h = (a * 0x9E3779B1 & mask) ^ (b * 0x85EBCA77 & mask) ^ (c * 0xC2B2AE3D & mask)
        yield (h * 0x27D4EB2F & mask) >> 16


def letters(text):
    """The text's words as runs of letters alone, in lower case."""
    words = ("".join(c for c in w if is_kind(c, "L")) for w in WORD.findall((text or "").lower()))
    return [w for w in words if w]


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def brute_identify(rows):
    """{doc_id: (language, score, set)} by a model counted and applied one word at a time."""
    counts = {}
    for d, text, lang in rows:
        if lang is not None and text is not None and not held(d):
            for w in letters(text):
                counts.setdefault(lang, Counter()).update(gram_hashes(w))
    langs = sorted(counts)
    total = {k: sum(counts[k].values()) for k in langs}

    def log_p(lang, g):
        return math.log((counts[lang][g] + language.SMOOTHING) / (total[lang] + language.SMOOTHING * language.BUCKETS))

    def em(like, share, rounds):
        for _ in range(rounds):
            sums, fit = dict.fromkeys(langs, 0.0), 0.0
            for p in like:
                whole = max(sum(p[k] * share[k] for k in langs), 1e-30)
                fit += math.log(whole)
                for k in langs:
                    sums[k] += p[k] * share[k] / whole
            share = {k: v / len(like) for k, v in sums.items()}
        return share, fit

    out = {}
    for d, text, _ in rows:
        words = letters(text)
        if not words:
            out[d] = ("und", 0.0, set())
            continue
        like = []
        for w in words:
            logs = {k: sum(log_p(k, g) for g in gram_hashes(w)) for k in langs}
            best = max(logs.values())
            like.append({k: math.exp(v - best) for k, v in logs.items()})
        share, fit = em(like, dict.fromkeys(langs, 1 / len(langs)), language.ROUNDS)
        active = set(langs)
        price = 0.5 * math.log(max(len(words), 2))
        while len(active) > 1:
            least = min(sorted(active), key=lambda k: share[k])
            rest = {k: max(share[k], 1e-6) if k in active and k != least else 0.0 for k in langs}
            new, fit_new = em(like, {k: v / sum(rest.values()) for k, v in rest.items()}, language.REFINE)
            if fit_new + price < fit:
                break
            share, fit = new, fit_new
            active.remove(least)
        best = max(sorted(active), key=lambda k: share[k])
        out[d] = (best, share[best], {k for k in active if share[k] > 0})
    return out


def language_rows():
    rng = np.random.default_rng(8)
    words = {"en": "the of and with that this from were house", "de": "der und nicht für schön haus ein wird dass",
             "fr": "le les dans été maison avec être où ça", "eo": "kaj estas domo ĉiuj ankaŭ dum ĝi"}
    text = lambda k, n: " ".join(rng.choice(words[k].split(), n))
    rows = [(i, text(k, int(rng.integers(3, 30))).capitalize() + ".", k) for i in range(60) for k in [list(words)[i % 4]]]
    rows += [(100, text("en", 15) + " " + text("fr", 15), "en"), (101, text("de", 12) + "\n" + text("eo", 9) + ", " + text("fr", 11), None),
             (102, None, "en"), (103, "12 34 !", "en"), (104, "", None), (105, "the", None), (106, "1st the 2nd—of", None)]
    return rows


def test_language_equals_a_word_by_word_model(frame):
    rows = language_rows()
    docs = frame(rows)
    want = brute_identify(rows)
    got = language.identify(docs, language.fit(docs)).collect()
    assert len(got) == len(rows)
    for r in got:
        lang, score, chosen = want[r.doc_id]
        assert (r.lang_pred, set(r.langs)) == (lang, chosen) and r.score == pytest.approx(score, abs=2e-3)
        assert r.held_out == held(r.doc_id)
    kept = {r.doc_id for r in language.keep_identified(docs, language.fit(docs)).collect()}
    assert kept == {d for d, (lang, *_) in want.items() if lang != "und"}


def brute_values(text):
    """{feature: (times, density)} of a text, logged."""
    words = WORD.findall((text or "").lower())
    found = Counter()
    for w in words:
        while w and not is_kind(w[0], "L", "N"):
            w = w[1:]
        while w and not is_kind(w[-1], "L", "N"):
            w = w[:-1]
        found.update([w] + [w[:n] + "-" for n in toxicity.PREFIXES if n < len(w)] if w else [])
    n = max(len(words), toxicity.LEAST_WORDS)
    return {f: (math.log1p(k), math.log1p(toxicity.PER_WORDS * k / n)) for f, k in found.items()}


def toxic_rows():
    rng = np.random.default_rng(4)
    plain = [f"word{i}" for i in range(120)]
    bad = ["Vile", "vilest", "hateful,", "hatefully", "scum!"]
    rows, labels = [], []
    for i in range(400):
        toxic = int(i % 5 == 0)
        words = list(rng.choice(plain, int(rng.integers(5, 60)))) + list(rng.choice(bad, int(rng.integers(1, 5)))) * toxic
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    return rows + [(900, None), (901, ""), (902, "— ! …")], labels


def test_toxicity_equals_a_word_by_word_model(spark, frame):
    rows, labels = toxic_rows()
    docs = frame(rows)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    # features: all whose documents tell the labels apart, by the definition of the two tests
    y, n = dict(labels), Counter(t for _, t in labels)
    seen = {0: Counter(), 1: Counter()}
    for d, text in rows:
        if d in y:
            seen[y[d]].update(brute_values(text).keys())
    want = set()
    for f in {*seen[0], *seen[1]}:
        a, b = seen[1][f], seen[0][f]
        odds = math.log((a + .5) / (n[1] - a + .5)) - math.log((b + .5) / (n[0] - b + .5))
        rest = sum(n.values()) - a - b
        chi2 = sum(n.values()) * (a * (n[0] - b) - b * (n[1] - a)) ** 2 / (n[0] * n[1] * (a + b) * max(1, rest))
        if a + b >= toxicity.MIN_DOCUMENTS and abs(odds) >= toxicity.MIN_LOG_ODDS and chi2 >= toxicity.MIN_CHI2:
            want.add(f)
    assert set(model.features) == want and len(want) > 5
    place = {f: i for i, f in enumerate(model.features)}
    got = {r.doc_id: r for r in toxicity.severity(docs, model).collect()}
    assert len(got) == len(rows)
    for d, text in rows:
        x = sum(model.weights[2 * place[f]] * t + model.weights[2 * place[f] + 1] * s for f, (t, s) in brute_values(text).items() if f in place)
        p = [1 / (1 + math.exp(-(x - t))) for t in model.thresholds]
        by_grade = [a - b for a, b in zip([1.0, *p], [*p, 0.0])]
        r = got[d]
        assert r.severity == pytest.approx(sum(p), abs=1e-4) and r.p_toxic == pytest.approx(p[0], abs=1e-4)
        assert r.toxic == (p[0] >= toxicity.FLAG_AT) and r.grade == by_grade.index(max(by_grade))
    assert {d for d, r in got.items() if r.toxic} == {d for d, t in labels if t}
