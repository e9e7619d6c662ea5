"""Whitening against a dense eigensolver and exact integers."""

import math

import numpy as np
import pytest

from doctriage.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, n long, whitened string, component int"


def brute(rows):
    kept = [(i, [math.floor(1024 * c) + 100000 for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([v for _, v in kept], object)
    n, s = len(kept), x.sum(axis=0)
    y = (x * n - s).astype(float) / n
    values, vectors = np.linalg.eigh(y.T @ y / n)
    return kept, n, s, y, values[::-1], vectors.T[::-1]


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 7, "x", 9) for i, v in rows], SCHEMA).repartition(parts)


def rows_of(seed=3, n=200, d=12):
    rng = np.random.default_rng(seed)
    v = rng.standard_normal((n, d)) @ rng.standard_normal((d, d)) * 0.3
    rows = [(int(i), [float(np.float32(c)) for c in v[i]]) for i in range(n)]
    rows += [rows[0], rows[0], (None, rows[5][1]), (900, None), (901, [None] + rows[1][1][1:]),
             (902, [float("nan")] + rows[1][1][1:]), (903, [float("inf")] + rows[1][1][1:]), (904, rows[2][1][:5])]
    return rows


def test_against_dense_eigensolver(spark):
    rows = rows_of()
    kept, n, s, y, values, vectors = brute([r for r in rows if r[0] != 904])
    got = whitening.whiten(frame(spark, rows)).collect()
    assert len(got) == 8 * n and {r.n for r in got} == {n}
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9
    for r in got:
        assert abs(r.explained / (values[r.component - 1] / values.sum()) - 1) < 1e-9
    place = {}
    for at, (i, x) in enumerate(kept):
        place.setdefault(i, at)
    sign = {}
    for r in got:
        at, k = place[r.vec_id], r.component - 1
        assert r.deviation == sum((n * a - b) ** 2 for a, b in zip(kept[at][1], s))
        want = float(y[at] @ vectors[k]) / math.sqrt(values[k])
        if abs(want) > 1e-3:
            sign.setdefault(k, math.copysign(1, want * r.whitened))
        assert abs(r.whitened - sign.get(k, 1) * want) < 1e-8


def test_whole_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    got = whitening.whiten(table).collect()
    assert len(got) == 8 * table.count() and got[0].identity_error < 1e-9
    *_, values, _ = brute([(r.vec_id, list(r.embedding)) for r in table.collect()])
    assert all(abs(r.explained / (values[r.component - 1] / values.sum()) - 1) < 1e-9 for r in got)


@pytest.mark.parametrize("values", [
    [9, 5, 5, 5, 2, 1, 0, 0], [3, 3, 3, 3], [1e9, 1, 1e-3], [4], [2, 2 - 1e-13, 1], [7, 6.9999999, 6.9999998, 1],
])
def test_leading_with_repeated_and_close_values(values):
    rng = np.random.default_rng(1)
    q, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
    v = (q * np.array(values, float)) @ q.T
    v = (v + v.T) / 2
    got, vectors = whitening.leading(v, 8)
    want = sorted((x for x in values if x > 1e-12 * sum(values)), reverse=True)
    assert len(got) == len(want) and np.allclose(got, want, rtol=1e-7, atol=1e-9 * values[0])
    assert np.abs(vectors @ vectors.T - np.eye(len(got))).max() < 1e-9
    assert np.abs(vectors @ v - got[:, None] * vectors).max() < 1e-9 * max(values)


def test_inertia_counts_negative_eigenvalues():
    rng = np.random.default_rng(4)
    for n in range(1, 14):
        for _ in range(20):
            a = rng.standard_normal((n, n))
            a = a + a.T
            if rng.random() < 0.3:
                np.fill_diagonal(a, 0)  # asks for blocks of two
            values = np.linalg.eigvalsh(a)
            if np.abs(values).min() > 1e-9:
                assert whitening.ldl_negative(a) == (values < 0).sum()


def test_odd_tables(spark):
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, None), (2, [None])])).count() == 0
    assert whitening.whiten(frame(spark, [(1, [0.5, 0.25])])).count() == 0
    assert whitening.whiten(frame(spark, [(i, [0.5, 0.25]) for i in range(9)])).count() == 0
    got = whitening.whiten(frame(spark, [(i, [float(i), 0.25]) for i in range(9)])).collect()
    assert len(got) == 9 and all(abs(r.explained - 1) < 1e-12 for r in got)
    wide = whitening.whiten(frame(spark, [(i, [float(1 << 12) * i, 3.0 * (i % 2)]) for i in range(9)])).collect()
    assert len(wide) == 18 and max(r.identity_error for r in wide) < 1e-6
    # variance below the least part of the trace gives no component; a deviation beyond a long is null
    large = whitening.whiten(frame(spark, [(i, [float(1 << 24) * i, 3.0 * (i % 2)]) for i in range(9)])).collect()
    assert len(large) == 9 and {r.deviation for r in large if r.vec_id == 8} == {None}
