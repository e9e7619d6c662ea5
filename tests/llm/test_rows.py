"""Exact dedup, mixing and sharding against plain Python."""

import hashlib
import math
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from doctriage.llm import exact_dedup, mixing, sharding
from doctriage.llm.common import numbered

SPACE = re.compile(r"[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def norm(t):
    return SPACE.sub("", t or "")


def classes(rows):
    by = defaultdict(list)
    for d, t, *_ in rows:
        by[norm(t)].append((-len(t or ""), d is None, d))
    return {k: (min(v)[2], len(v)) for k, v in by.items()}


@pytest.mark.parametrize("weak", [None, "one", "first"])
def test_exact_classes_whatever_the_hash(frame, odd_rows, weak):
    hash_of = {None: exact_dedup.content_hash, "one": lambda c: F.lit(1), "first": lambda c: F.substring(c, 1, 1)}[weak]
    got = exact_dedup.exact_duplicates(frame(odd_rows), hash_of=hash_of).collect()
    want = classes(odd_rows)
    assert sorted(map(str, got)) == sorted(str(type(got[0])(
        doc_id=d, keep_id=want[norm(t)][0], group_size=want[norm(t)][1], kept=d == want[norm(t)][0],
        text_sha256=hashlib.sha256(norm(t).encode()).hexdigest())) for d, t, *_ in odd_rows)


def test_exact_keep_one_has_all_columns(frame, odd_rows):
    docs = frame(odd_rows)
    kept = exact_dedup.keep_one(docs)
    assert kept.dtypes == docs.dtypes
    want = {k for k, _ in classes(odd_rows).values()}
    assert {r.doc_id for r in kept.collect()} == want
    assert exact_dedup.keep_one(frame([])).count() == 0


def targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    budget, capped = 1.5 * sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in capped]
        if not rest:
            return {s: float(v) for s, v in capped.items()}
        level = (budget - sum(capped.values())) / sum(weight[s] for s in rest)
        over = [s for s in rest if weight[s] * level >= 2 * sizes[s]]
        if not over:
            return {s: float(capped.get(s, weight[s] * level)) for s in names}
        capped |= {s: 2 * sizes[s] for s in over}


def test_mix_against_a_plain_queue(frame, odd_rows):
    rows = odd_rows + [(100 + i, "w " * (1 + i * 7 % 40), "en", ["a", "b", "c", None][i % 4]) for i in range(200)]
    got = mixing.mix(frame(rows)).collect()
    sizes = defaultdict(int)
    for _, t, _, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    want, by_source = targets(sizes), defaultdict(int)
    source_of = {(d, len(WORD.findall(t or ""))): s for d, t, _, s in rows}
    assert len(got) == len(rows)
    for r in got:
        s = source_of[r.doc_id, r.size]
        assert math.isclose(r.target, want[s], rel_tol=1e-12) and r.source_size == sizes[s]
        assert 0 <= r.taken <= 2 * r.size
        by_source[s] += r.taken
    assert all(by_source[s] == math.floor(want[s]) for s in sizes)
    assert [r.finish_time for r in got] == sorted(r.finish_time for r in got)
    again = mixing.mix(frame(rows, 5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_closed_form_is_the_merge_cut_at_time_one(frame):
    """Copies of all sources merged by virtual finish time, cut at 1, against what each row gives."""
    rows = [(i, "w " * (1 + i * 11 % 37), "en", ["a", "b", "c", None][i * i % 4 or i % 3]) for i in range(150)]
    got = {r.doc_id: r for r in mixing.mix(frame(rows)).collect()}
    queues, copies = defaultdict(list), []
    for d, _, _, s in sorted(rows, key=lambda r: hashlib.md5(f"mix:{r[0]}".encode()).hexdigest()):
        queues[s].append(d)
    for s, queue in queues.items():
        done = 0
        for d in queue * 2:
            done += got[d].size
            copies.append((done / got[d].target, d, s, done - got[d].size))
    taken, progress = defaultdict(int), set()
    for finish, d, s, before in sorted(copies, key=lambda c: c[0]):
        if finish <= 1:
            taken[d] += got[d].size
        elif s not in progress:
            progress.add(s)
            taken[d] += math.floor(got[d].target) - before
    assert {d: r.taken for d, r in got.items()} == {d: taken[d] for d in got}


def test_mix_has_no_python_stage(frame, odd_rows):
    plan = mixing.mix(frame(odd_rows))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_mixed_documents(frame):
    rows = [(i, " ".join(f"w{j}" for j in range(5 + i)), "en", "ab"[i % 2]) for i in range(20)]
    docs = frame(rows)
    out = mixing.mixed_documents(docs)
    assert out.dtypes == docs.dtypes
    taken = defaultdict(int)
    for r in out.collect():
        taken[r.doc_id] += len(r.text.split())
        assert rows[r.doc_id][1].startswith(r.text)
    assert {r.doc_id: r.taken for r in mixing.mix(docs).collect() if r.taken} == dict(taken)


def test_mix_empty(frame):
    assert mixing.mix(frame([])).count() == 0 and mixing.mixed_documents(frame([])).count() == 0
    only_blank = mixing.mix(frame([(1, None), (2, " ", "en", "a")])).collect()
    assert [(r.size, r.target, r.taken) for r in only_blank] == [(0, 0.0, 0)] * 2


def winner(key, weights):
    def draw(i, w):
        return -math.log((int(hashlib.md5(f"{key}:{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52) / w
    return min((draw(i, w), i) for i, w in enumerate(weights) if w)[1]


@pytest.mark.parametrize("weights", [[1.0] * 16, [1, 0, 2, 5]])
def test_shards(frame, odd_rows, weights):
    rows = odd_rows + [(1000 + i, "t") for i in range(300)]
    got = sharding.shard_rows(frame(rows), weights).collect()
    texts = {r[0]: r[1] or "" for r in rows}
    slots = defaultdict(list)
    for r in got:
        key, body = ("null" if r.doc_id is None else r.doc_id), texts[r.doc_id].encode()
        assert r.shard == winner(key, weights)
        assert r.grown_shard == winner(key, [*weights, sum(weights) / len(weights)])
        assert r.grown_shard in (r.shard, len(weights))
        assert (r.size, r.text_crc32, r.law) == (len(body) + 1, zlib.crc32(body), "key")
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and len(got) == len(rows)
    assert sharding.shard_rows(frame([])).count() == 0


def test_shard_weights_are_checked(frame):
    for bad in ([0.0, 0.0], [1.0, -1.0], []):
        with pytest.raises((ValueError, ZeroDivisionError)):
            sharding.shard_rows(frame([(1, "a")]), bad)


def test_numbered_is_gapless_in_order(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("g"), "id")
    rows = numbered(df, ["g", "id"], "n").collect()
    assert [(r.g, r.id) for r in sorted(rows, key=lambda r: r.n)] == sorted((r.g, r.id) for r in rows)
    assert sorted(r.n for r in rows) == list(range(1000))
