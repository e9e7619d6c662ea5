"""Suffix arrays and fingerprints against brute force."""

import hashlib
import itertools
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from doctriage.llm import components, repetition, simhash, suffix_dedup


def base_columns(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    n = len(w)
    c = Counter(tuple(w[i:i + 3]) for i in range(n - 2))
    in_window, longest = [False] * n, [0] * n
    for i in range(n - 2):
        if c[tuple(w[i:i + 3])] > 1:
            in_window[i:i + 3] = [True] * 3
    for i, j in itertools.permutations(range(n), 2):
        k = 0
        while max(i, j) + k < n and w[i + k] == w[j + k]:
            k += 1
        longest[i] = max(longest[i], k)
    in_repeat = [False] * n
    for i, k in enumerate(longest):
        if k >= repetition.MIN_REPEAT:
            in_repeat[i:i + k] = [True] * k
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, sum(in_window), sum(in_repeat),
            max(longest, default=0))


def test_repetition_measures():
    rng = np.random.default_rng(1)
    texts = ["", "  ", " a b\n a b\n\n c", "x " * 50, "é|字 " * 9]
    texts += [" ".join(rng.choice(["a", "b", "c", "é|", "#"], rng.integers(0, 70)))
              + ("\n" + " ".join("pqrstuvwxyz")) * int(rng.integers(0, 3)) for _ in range(40)]
    m = repetition.measures(pa.array(texts, pa.large_string()))
    for i, t in enumerate(texts):
        assert tuple(int(v[i]) for v in m.values()) == base_columns(t)


def test_suffix_array_order():
    rng = np.random.default_rng(4)
    owner = np.sort(rng.integers(0, 5, 200))
    codes = rng.integers(0, 2, 200)
    order, common = repetition.suffix_array(owner, codes)
    end = [int(np.searchsorted(owner, o, side="right")) for o in owner]
    suffix = lambda i: (int(owner[i]), codes[i:end[i]].tolist())
    assert [suffix(i) for i in order] == sorted(suffix(i) for i in range(200))
    for k in range(1, 200):
        (a, x), (b, y) = suffix(order[k - 1]), suffix(order[k])
        same = 0 if a != b else len(list(itertools.takewhile(lambda p: p[0] == p[1], zip(x, y))))
        assert common[k] == same


def test_quality_verdicts(frame, odd_rows):
    fresh = " ".join(f"w{i}" for i in range(300))
    rows = odd_rows + [(90, fresh), (91, fresh[:600] + " " + fresh[:600]), (92, " ".join(f"v{i}" for i in range(49)))]
    got = {r.doc_id: r for r in repetition.quality(frame(rows)).collect()}
    assert got[90].kept and not got[91].kept and got[92].base_failed and got[1].base_failed
    assert all(not (r.kept and r.base_failed) for r in got.values())
    assert repetition.quality(frame(rows)).count() == len(rows) and repetition.quality(frame([])).count() == 0
    line = " ".join(f"u{i}" for i in range(120))
    m = repetition.quality(frame([(1, fresh + " " + line + " " + fresh.replace("w", "y") + " " + line)])).first()
    assert m.longest_repeat == 120 and not m.base_failed and not m.kept


def plain_later(text):
    w, seen, later = text.split(), set(), set()
    for i in range(len(w) - repetition.MIN_REPEAT + 1):
        run = tuple(w[i:i + repetition.MIN_REPEAT])
        later |= set(range(i, i + repetition.MIN_REPEAT)) if run in seen else set()
        seen.add(run)
    return len(later)


def test_quality_by_later_occurrences(frame):
    rng = np.random.default_rng(8)
    fresh = lambda n, c: [f"{c}{i}" for i in range(n)]
    passage, line = fresh(60, "p"), " ".join(fresh(12, "l"))
    blocks = [fresh(20, f"b{k}_") for k in range(60)]
    texts = {
        1: " ".join(passage + fresh(180, "w") + passage),                                    # covered 0.40, later 0.20
        2: " ".join(sum(blocks, []) + fresh(4000, "w") + sum(blocks[::-1], [])),             # later 0.19, longest 20
        3: "\n".join([line, " ".join(fresh(76, "w")), line]),                                # covered 0.24, later 0.12
        4: " ".join(fresh(300, "w")),
        5: " ".join(passage + fresh(2000, "w") + passage),                                   # one long repeat
    }
    texts |= {10 + i: " ".join(rng.choice(["a", "b"], 90)) for i in range(10)}
    got = {r.doc_id: r for r in repetition.quality(frame(list(texts.items()))).collect()}
    assert all(got[d].later_words == plain_later(t) for d, t in texts.items())
    assert not any(got[d].base_failed for d in range(1, 6))
    assert [got[d].kept for d in range(1, 6)] == [False, False, True, True, False]


def plain_fingerprint(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    runs = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    ones = Counter(i for r in runs for i in range(64) if xxhash.xxh64_intdigest(r.encode(), 42) >> i & 1)
    return sum(1 << i for i in range(64) if 2 * ones[i] > len(runs))


def test_code_covers_and_pairs_meet():
    rng = np.random.default_rng(7)
    for (bits, poly, radius), (_, errors) in zip(simhash.BLOCKS, simhash._TABLES):
        weights = [int(e).bit_count() for e in errors]
        assert max(weights) == radius and len(set(errors.tolist())) == 1 << (poly.bit_length() - 1)  # perfect
    x = rng.integers(0, 2**64, 400, dtype=np.uint64)
    y = x ^ np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 3), replace=False)) for _ in x], np.uint64)
    rx, ax = simhash.anchors(x)
    ry, ay = simhash.anchors(y)
    for i in range(len(x)):
        assert set(ax[rx == i].tolist()) & set(ay[ry == i].tolist())


@pytest.mark.parametrize("n", [5, 40, 300])
def test_links_of_an_anchor(n):
    rng = np.random.default_rng(n)
    fps = np.unique(np.array([sum(1 << int(b) for b in rng.choice(12, 6)) for _ in range(n)], np.uint64))
    label = simhash.least_linked(fps)
    want = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i, j in itertools.combinations(range(len(fps)), 2):
            if int(fps[i] ^ fps[j]).bit_count() <= 2 and want[i] != want[j]:
                want = [min(want[i], want[j]) if v in (want[i], want[j]) else v for v in want]
                changed = True
    assert label.tolist() == want


def test_near_duplicates(frame, odd_rows):
    rng = np.random.default_rng(0)
    base = [f"w{i}" for i in rng.integers(0, 500, 300)]
    near = [(200 + i, " ".join(base[:i * 7] + ["zz"] + base[i * 7 + 1:])) for i in range(40)]
    rows = odd_rows + near + [(300 + i, " ".join(f"q{j}" for j in rng.integers(0, 999, 30))) for i in range(40)]
    got = simhash.near_duplicates(frame(rows)).collect()
    fp = [plain_fingerprint(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in itertools.combinations(range(len(rows)), 2):
        if (fp[i] ^ fp[j]).bit_count() <= 2:
            root[find(i)] = find(j)
    key = lambda d: 2**63 - 1 if d is None else d
    want = Counter((r[0], f"{f:016x}", min((rows[j][0] for j in range(len(rows)) if find(j) == find(i)), key=key))
                   for i, (r, f) in enumerate(zip(rows, fp)))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == want
    docs = frame(rows)
    kept = simhash.keep_one(docs)
    assert kept.dtypes == docs.dtypes and {r.doc_id for r in kept.collect()} == {w[2] for w in want}
    assert simhash.near_duplicates(frame([])).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (500, 400), (400, 500)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {i: 0 for i in range(61)} | {i: 100 for i in range(100, 160)} | {400: 400, 500: 400}
    assert got == want
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_deep_shallow_sorts():
    rng = np.random.default_rng(3)
    x = rng.integers(97, 99, (400, 50)).astype(np.uint8)
    x[100:300], x[300:380, :40] = x[:200], x[5, :40]
    group = np.sort(rng.integers(0, 4, 400))
    for shallow in (0, 8, 24, 48):
        order, cls = suffix_dedup.deep_shallow(x, group, shallow)
        names = [(group[i], bytes(x[i])) for i in order]
        assert names == sorted(names)
        assert [a == b for a, b in zip(names, names[1:])] == [a == b for a, b in zip(cls, cls[1:])]


def plain_repeats(rows):
    key = lambda d: 2**63 - 1 if d is None else d
    first = {}
    for d, t, *_ in sorted(rows, key=lambda r: key(r[0])):
        b = (t or "").encode()
        for i in range(len(b) - 49):
            first.setdefault(b[i:i + 50], key(d))
    out = Counter()
    for d, t, *_ in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - 49):
            if first[b[i:i + 50]] < key(d):
                gone[i:i + 50] = [True] * 50
        left = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[d, len(b), sum(gone), spans, hashlib.sha256(left).hexdigest()] += 1
    return out


@pytest.mark.parametrize("hot", [4096, 1])
def test_repeats_go(frame, odd_rows, hot):
    rng = np.random.default_rng(9)
    word = lambda n: " ".join(f"w{i}é" for i in rng.integers(0, 4000, n))
    shared = [word(9), word(12), word(40), "ab" * 60, "a" * 130]
    rows = [(d, (t or "")[:3000] if t else t, *x) for d, t, *x in odd_rows]
    for i in range(60):
        rows.append((100 + i, " ".join(str(x) for p in range(4) for x in (word(4), shared[int(rng.integers(5))]))))
    rows += [(170, shared[2][:49]), (171, shared[2][:50]), (172, shared[2][1:51]), (100, word(30)), (100, shared[2])]
    got = suffix_dedup.remove_repeats(frame(rows), hot=hot).collect()
    assert Counter(tuple(r) for r in got) == plain_repeats(rows)


def test_common_line_is_split_by_default(frame, monkeypatch):
    """A line of all documents: its edges have a context a document, in few slices."""
    rng = np.random.default_rng(11)
    line = " This very common line stands in every document of the table, whatever else it tells. "
    n = suffix_dedup.HOT + 1000
    rows = [(i, "".join(rng.choice(list("abcdefgh"), 20)) + line + "".join(rng.choice(list("abcdefgh"), 20)))
            for i in range(n)]
    lists = []
    contexts = suffix_dedup._contexts
    monkeypatch.setattr(suffix_dedup, "_contexts", lambda b, hot: lists.append(hot.value) or contexts(b, hot))
    got = suffix_dedup.remove_repeats(frame(rows)).collect()
    assert Counter(tuple(r) for r in got) == plain_repeats(rows)
    inside = suffix_dedup._hashes(np.frombuffer(line.encode(), np.uint8)) & np.uint64((1 << 48) - 1)
    assert 0 < len(lists[0]) < len(inside) and np.isin(lists[0], inside).all()


def test_repeats_of_nothing(frame):
    assert suffix_dedup.remove_repeats(frame([])).count() == 0
    got = suffix_dedup.remove_repeats(frame([(1, None), (2, ""), (3, "short"), (4, "short")]), with_text=True).collect()
    assert sorted((r.doc_id, r.n_removed, bytes(r.kept_bytes)) for r in got) == [
        (1, 0, b""), (2, 0, b""), (3, 0, b"short"), (4, 0, b"short")]


def test_rows_without_an_id_whose_texts_share_a_checksum(frame):
    import zlib

    seen = {}
    for i in itertools.count():  # two texts of equal crc32
        text = f"{i:09d} " + " ".join(f"{(i * 7919 + j * 104729) % 99991:05d}" for j in range(12))
        other = seen.setdefault(zlib.crc32(text.encode()), text)
        if other != text:
            break
    rows = [(1, text), (None, text), (None, other)]
    got = {(r.doc_id, r.n_removed) for r in suffix_dedup.remove_repeats(frame(rows)).collect()}
    n = len(text)
    shared = max((k for k in range(n) for a in range(n - k + 1) if text[a:a + k] in other), default=0)
    assert shared < 50 and got == {(1, 0), (None, n), (None, 0)}
