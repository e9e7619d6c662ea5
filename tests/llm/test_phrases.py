"""Collocations against counts of all n-grams in plain Python."""

import re
from collections import Counter

import numpy as np
import pytest

from doctriage.llm import phrases


def pieces(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for piece in re.split("[.,;:!?\n\v\f\r]", lower):
        words = [w for w in re.split("[ \t]+", piece) if w]
        if words:
            yield words


def brute(rows, depth=3, least=10, absorbed=50, top=2000):
    grams, n = {}, Counter()
    for _, text, lang, *_ in rows:
        lang = lang or "und"
        for words in pieces(text):
            n[lang] += len(words)
            for m in range(1, depth + 1):
                for i in range(len(words) - m + 1):
                    grams.setdefault(lang, Counter())[tuple(words[i:i + m])] += 1
    out = []
    for lang, f in grams.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in found.items():
            if any(len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q))) and 100 * b >= absorbed * a
                   for q, b in found.items()):
                continue
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def told(df):
    return sorted(map(tuple, df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


def some_rows():
    rng = np.random.default_rng(3)
    words = ["the", "The", "a", "new", "york", "city", "ünï", "字", "of", "x.y", " ", "b\x1cc"] + [f"w{i}" for i in range(12)]
    rows = []
    for i in range(150):
        t = " ".join(rng.choice(words, size=rng.integers(0, 40)))
        if i % 3 == 0:
            t += " new york city, new\tyork  city. in new york"
        rows.append((i, t.replace(" of ", rng.choice([" of\n", ". of! ", " of "])), ["en", "de", None][i % 3], "a"))
    return rows


@pytest.mark.parametrize("depth,least,absorbed,top", [(3, 10, 50, 2000), (2, 3, 50, 7), (4, 4, 80, 2000), (5, 12, 30, 40)])
def test_against_plain_counts(frame, odd_rows, depth, least, absorbed, top):
    rows = some_rows() + odd_rows
    want = brute(rows, depth, least, absorbed, top)
    assert want and told(phrases.collocations(frame(rows), depth, least, absorbed, top)) == want


def test_many_shards_give_the_same(frame, monkeypatch):
    rows = some_rows()
    want = brute(rows)
    assert told(phrases.collocations(frame(rows, 11))) == want


def test_index_extends_to_both_sides():
    rng = np.random.default_rng(5)
    text = np.concatenate([[0], rng.integers(0, 7, 400), [0]])
    index = phrases.FmIndex(text, 4)
    seen = {m: Counter() for m in range(1, 5)}
    for i in range(len(text)):
        for m in range(1, 5):
            g = tuple(text[i:i + m].tolist())
            if len(g) == m and 0 not in g:
                seen[m][g] += 1
    for m, (rows, n) in enumerate(index.ngrams(4), 1):
        assert dict(zip(map(tuple, rows.tolist()), n.tolist())) == seen[m]
    # any order of directions gives the same n-grams
    for sides in ([0, 0, 0], [1, 1, 1], [0, 1, 1], [1, 0, 0]):
        word, start, back, count = index.words()
        rows = word[:, None]
        for left in sides:
            owner, word, start, back, count = index.extend(start, back, count, bool(left))
            rows = np.column_stack([word, rows[owner]] if left else [rows[owner], word])
        assert dict(zip(map(tuple, rows.tolist()), count.tolist())) == seen[4]


def test_wide_numbers_sort_alike():
    rng = np.random.default_rng(6)
    rank, then = rng.integers(0, 5, 300), rng.integers(0, 5, 300)
    by, out = phrases._order(rank, then)
    wide = phrases._order(rank << 40, then << 20)
    assert (out == wide[1]).all() and (rank[by] == rank[wide[0]]).all() and (then[by] == then[wide[0]]).all()


def test_counts_over_64_bits(spark):
    a, l, r = 3_000_000_000_000, 4_000_000_000_000, 7_000_000_000_001
    found = spark.createDataFrame([("en", 1, "x", l), ("en", 1, "y", r), ("en", 2, "x y", a)], "lang string, size int, phrase string, n long")
    assert phrases._scored(found, 2).first().score == 10**6 * a * a // (l * r)


def test_odd_tables(frame):
    assert phrases.collocations(frame([])).count() == 0
    assert phrases.collocations(frame([(1, None, "en"), (2, "", None), (3, ".,;", "en"), (4, "one", "en")])).count() == 0
    got = told(phrases.collocations(frame([(i, "a b", None, "x") for i in range(10)])))
    assert got == [("und", 1, "a b", 10, 10, 10, 20, 1_000_000)]


def test_memory_of_a_block(monkeypatch):
    import tracemalloc

    import pyarrow as pa

    class Task:
        get, partitionId = staticmethod(lambda: Task), staticmethod(lambda: 0)

    monkeypatch.setattr(phrases, "TaskContext", Task)
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{x}" for x in rng.zipf(1.3, 400) % 30_000) for _ in range(500)]
    block, = phrases._index_blocks([pa.record_batch({"lang": ["en"] * len(texts), "text": texts})])
    tokens, peaks = block.column(1)[0].as_py(), []
    told = pa.record_batch([*block.columns, pa.array([[]], pa.list_(pa.binary()))], [*block.schema.names, "replies"])
    monkeypatch.setattr(phrases.B, "joined", lambda *_: np.ones(3 * tokens, "u1"))
    for run, at in ((phrases._asker(3, 16), block), (phrases._teller(3), told)):
        tracemalloc.start()
        for _ in run([at]):
            peaks.append(tracemalloc.get_traced_memory()[1])
            break
        tracemalloc.stop()
    assert max(peaks) < 100 * tokens  # bytes a word
