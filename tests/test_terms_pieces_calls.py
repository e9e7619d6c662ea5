"""Terms by automaton, long texts in pieces, calls that can be ended."""

import os
import random
import re
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from doctriage.operators import long_texts as LT
from doctriage.operators import terms as TM
from doctriage.operators.calls import CallPool
from doctriage.operators.score import function_scorer, classify, lexicon_score, lexicon_score_join, one_per_key, recorded_scorer

LEXICON = [("order", "purchase order", 2.0), ("order", "order", 1.0), ("doctor", "ärzte", 1.5), ("doctor", "ÄRZTE", 0.5),
           ("money", "10 €", 1.0), ("money", "€", 0.25), ("order", "purchase  order", 0.5), ("word", "an", 1.0), ("cjk", "契約", 1.0)]


def plain_search(text):
    """Every place of every term, tried one by one."""
    t = " ".join((text or "").lower().split())
    sums, terms = defaultdict(float), set()
    for kind, term, w in LEXICON:
        x = " ".join(term.lower().split())
        for i in range(len(t) - len(x) + 1):
            if t[i:i + len(x)] != x:
                continue
            before, after = t[i - 1:i] if i else "", t[i + len(x):i + len(x) + 1]
            if re.fullmatch("[a-z]+", x):
                alone = not re.fullmatch("[a-z]", before) and not re.fullmatch("[a-z]", after)
            else:
                alone = not (before.isalnum() and x[0].isalnum()) and not (after.isalnum() and x[-1].isalnum())
            if alone:
                sums[kind] += w
                terms.add(term)
    total = sum(sums.values())
    best = max(((w, k) for k, w in sums.items()), default=(0.0, "unknown"))
    return (best[1], best[0] / total if total else 0.0, total, sorted(terms))


def texts():
    rnd = random.Random(4)
    parts = ["purchase order", "Purchase\n Order", "purchase, order", "reorder", "orders", "order", "Ärzte", "ärzten", "10 €", "110 €", "€€",
             "an", "än", "the an.an", "契約", "契約書", " ", "x", "purchase order purchase order"]
    return [(i, " ".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12)))) for i in range(200)] + [(900, None), (901, "")]


@pytest.mark.parametrize("part_terms", [1000, 2])
def test_terms_equal_a_plain_search(spark, part_terms):
    rows = texts()
    docs = spark.createDataFrame([(*r, "extra") for r in rows], "doc_id long, text string, note string").repartition(3)
    if part_terms == 1000:
        scored = lexicon_score(docs, LEXICON)
    else:
        lex = spark.createDataFrame(LEXICON, "t string, term string, w double")
        scored = TM.term_score(docs, lex, part_terms=part_terms)
    assert scored.columns == ["doc_id", "note", "predicted_type", "primary_score", "evidence", "key_terms"]
    got = {r.doc_id: (r.predicted_type, pytest.approx(r.primary_score), pytest.approx(r.evidence), r.key_terms) for r in scored.collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        assert plain_search(t) == got[i], t


def test_terms_as_a_table_and_plain_terms_as_before(spark):
    docs = spark.createDataFrame(texts(), "doc_id long, text string")
    table = spark.createDataFrame(LEXICON, "document_type string, term string, weight double")
    rows = lambda df: sorted(map(str, df.select("doc_id", "predicted_type", F.round("evidence", 6), "key_terms").collect()))
    assert rows(lexicon_score(docs, table)) == rows(lexicon_score(docs, LEXICON))
    ascii_only = [x for x in LEXICON if re.fullmatch("[a-z]+", x[1])]
    lex = spark.createDataFrame(ascii_only, "t string, term string, w double")
    assert rows(TM.term_score(docs, lex)) == rows(lexicon_score(docs, ascii_only))
    assert lexicon_score_join(docs, spark.createDataFrame(ascii_only, "document_type string, term string, weight double")).count() == docs.count()


def plain_merge(pieces):
    """(type, score) of [(chars, type, score) or None]."""
    votes, chars = defaultdict(float), 0.0
    for p in pieces:
        if p:
            votes[p[1]] += max(p[0], 1) * p[2]
            chars += max(p[0], 1)
    if not votes:
        return "unknown", 0.0
    t = min(votes, key=lambda k: (-votes[k], k))
    return t, votes[t] / chars


def test_long_texts_in_pieces(spark):
    rnd = random.Random(2)
    types = ["invoice", "memo", "report"]
    rows = [(f"k{i}", "é" * rnd.randint(0, 95)) for i in range(60)] + [("none", None), ("empty", "")]
    answers, plain = [], {}
    for k, t in rows:
        pieces = []
        for j in range(max(1, -(-len(t or "") // 10))):
            chars = len((t or "")[10 * j:10 * j + 10])
            if rnd.random() < 0.2 or k == "k7":
                pieces.append(None)
                continue
            kind, s = rnd.choice(types), rnd.randint(0, 4) / 4
            answers.append((f"{k}#piece-{j}", f'{{"predicted_type": "{kind}", "confidence_score": {s}}}'))
            pieces.append((chars, kind, s))
        plain[k] = (*plain_merge(pieces), len(pieces), sum(p is None for p in pieces))
    req = spark.createDataFrame([(k, k, t) for k, t in rows], "request_key string, document_id string, document_content string")
    scorer = recorded_scorer(spark.createDataFrame(answers, "request_key string, response_text string"))
    got = LT.classify_long(req.union(req).repartition(3), scorer, limit=10).collect()
    assert len(got) == len(rows)
    for r in got:
        t, s, n, failed = plain[r.request_key]
        assert (r.predicted_type, r.pieces, r.failed_pieces) == (t, n, failed) and r.primary_score == pytest.approx(s)
        assert r.status == ("error" if failed == n else "success") and (r.error is None) == (r.status == "success")
    cut = LT.cut_pieces(req, 10).orderBy("document_key", "piece").collect()
    joined = defaultdict(str)
    for r in cut:
        joined[r.document_key] += r.document_content or ""
        assert len(r.document_content or "") <= 10 and r.request_key == f"{r.document_key}#piece-{r.piece}"
    assert joined == {k: t or "" for k, t in rows}


def test_one_row_a_key_whatever_the_order(spark):
    rows = [("k", f"text {i}", i) for i in range(9)] + [("other", None, 1), ("other", None, 0)]
    df = spark.createDataFrame(rows, "request_key string, document_content string, n int")
    runs = [sorted(map(tuple, one_per_key(df.orderBy(F.rand(seed)).repartition(p)).collect())) for seed, p in ((1, 2), (2, 5), (3, 1))]
    assert runs[0] == runs[1] == runs[2] and len(runs[0]) == 2


def alive(pid):
    try:
        with open(f"/proc/{pid}/stat") as f:
            return f.read().split()[2] != "Z"
    except FileNotFoundError:
        return False


def test_a_call_that_never_returns_is_ended(spark, tmp_path):
    def fn(prompt):
        if "hang" in prompt:
            (tmp_path / f"{os.getpid()}.pid").write_text("")
            while True:
                time.sleep(1)
        if "die" in prompt:
            os._exit(3)
        if "raise" in prompt:
            raise ValueError("no")
        return '{"predicted_type": "invoice", "confidence_score": 0.9}'

    rows = [(f"k{i}", t) for i, t in enumerate(["ok one", "hang here", "ok two", "die now", "raise it", "hang again", "ok three"])]
    req = spark.createDataFrame(rows, "request_key string, document_content string").coalesce(1)
    began = time.monotonic()
    got = {r.request_key: (r.status, r.stage, r.error) for r in classify(
        req, function_scorer(fn, timeout_s=1.5, threads_per_task=2, processes=True)).collect()}
    assert time.monotonic() - began < 30
    assert [got[k][1] for k in ("k0", "k2", "k6")] == ["ok"] * 3
    assert got["k1"][0] == got["k5"][0] == "timeout" and "1.5 seconds" in got["k1"][2]
    assert got["k3"][0] == "error" and "ended" in got["k3"][2] and got["k4"][0] == "error"
    pids = [int(p.stem) for p in tmp_path.glob("*.pid")]
    assert len(pids) == 2 and not any(map(alive, pids))


def test_pool_keeps_order_and_lets_children_go():
    pool = CallPool(lambda: lambda p: (f"{p} {os.getpid()}", "ok", None), 3, 5.0)
    out = pool.run([str(i) if i % 4 else None for i in range(40)])
    assert [o[1] for o in out] == ["ok" if i % 4 else "skipped" for i in range(40)]
    assert all(o[0].split()[0] == str(i) for i, o in enumerate(out) if i % 4)
    pids = {int(o[0].split()[1]) for o in out if o[0]}
    assert len(pids) <= 3
    pool.close()
    assert not any(map(alive, pids))
