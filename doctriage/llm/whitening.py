"""Embedding whitening (operator 12): leading components by spectrum slicing.

Two aggregations gather the count, the sums and the centred second moments of all vectors, as
exact integers; what reaches the driver is a matrix of dimension x dimension.  There, LDL^T
factorisations of the shifted covariance count the eigenvalues above a shift (its inertia).
Bisection by these counts isolates the k-th eigenvalue, Rayleigh quotient iteration refines it
and its vector at cubic rate, and two further counts, just below and just above the value
found, certify that it is the k-th.  A third aggregation measures the covariance of the
whitened rows; the last pass gives them out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000  # an entry c becomes the integer floor(1024 * c) + 100000
LEAST = 1e-12                 # of the trace: components of smaller eigenvalues are not given
_ROWS = 1 << 12               # vectors that a Python stage holds at once
LARGEST = 2**52               # 1024 * c counts as this at most, so that all sums stay exact
_LONG = 2**63 - 1


def _vectors(docs: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """_id, _v of the rows whose vector has no null or non-finite entry."""
    v = column(docs, vector).cast("array<double>")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    return docs.select(column(docs, vec_id).cast("long").alias("_id"), v.alias("_v")).filter(F.col("_v").isNotNull() & finite)


def _blocks(batches):
    """(ids, matrix of the integers x) of up to ``_ROWS`` vectors of one length."""
    for batch in batches:
        for a in range(0, batch.num_rows, _ROWS):
            rows = batch.slice(a, _ROWS)
            lists = rows.column(rows.schema.get_field_index("_v"))
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            for d in np.unique(sizes).tolist():
                some = pa.array(np.flatnonzero(sizes == d))
                c = lists.take(some).flatten().to_numpy(zero_copy_only=False).reshape(len(some), d)
                yield rows.column(0).take(some), np.clip(np.floor(SCALE * c), -LARGEST, LARGEST).astype(np.int64) + SHIFT


def _products(y: np.ndarray) -> np.ndarray:
    """Exact integer sums of the products of all pairs of columns."""
    top = int(np.abs(y).max(initial=0))
    if top * top * max(1, len(y)) < 2**53:  # every partial sum of a float product is exact
        f = y.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    y = y.astype(object)
    return y.T.dot(y)


def _sums(batches):
    """Rows (d, i, s, n): a task's sums by dimension of its vectors of length d, and their number."""
    sums: dict[int, list] = {}
    for _, x in _blocks(batches):
        n, s = sums.get(x.shape[1], (0, 0))
        sums[x.shape[1]] = n + len(x), s + x.astype(object).sum(axis=0)
    for d, (n, s) in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array([str(v) for v in s], pa.string()),
             pa.array([n] * d, pa.int64())], ["d", "i", "s", "n"])


def _moments(centre: list[int]):
    """Rows (i, j, s): the sums (j = -1), the number (i = j = -1) and the products about ``centre`` of a task's vectors."""
    def run(batches):
        d = len(centre)
        c = np.array(centre, np.int64)
        n, sums, products = 0, np.zeros(d, object), np.zeros((d, d), object)
        for _, x in _blocks(batches):
            y = x - c
            n, sums, products = n + len(y), sums + y.sum(axis=0).astype(object), products + _products(y)
        if n:
            i, j = np.triu_indices(d)
            ij = np.concatenate([np.r_[-1, np.arange(d), i]]), np.concatenate([np.r_[-1, np.full(d, -1), j]])
            s = [str(v) for v in (n, *sums.tolist(), *products[i, j].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(ij[0].astype(np.int32)), pa.array(ij[1].astype(np.int32)),
                                              pa.array(s, pa.string())], ["i", "j", "s"])
    return run


def _gather(parts: DataFrame) -> dict[tuple[int, int], int]:
    """Sums by (i, j) over all tasks: one number for each pair of dimensions."""
    total = parts.groupBy("i", "j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    return {(r["i"], r["j"]): int(r["s"]) for r in total.collect()}


def ldl_negative(a: np.ndarray) -> int:
    """Negative eigenvalues of the symmetric matrix ``a``: the inertia of D in P a P^T = L D L^T.

    Diagonal pivoting with blocks of one and two rows (Bunch and Kaufman) bounds the growth; a
    pivot of zero counts as positive.
    """
    a, n, k, negative = a.copy(), len(a), 0, 0
    alpha = (1 + 17**0.5) / 8

    def swap(p: int, q: int) -> None:
        if p != q:
            a[[p, q]] = a[[q, p]]
            a[:, [p, q]] = a[:, [q, p]]

    while k < n:
        below = np.abs(a[k + 1:, k])
        r = k + 1 + int(below.argmax()) if len(below) else k
        most = abs(a[r, k]) if len(below) else 0.0
        two = False
        if abs(a[k, k]) < alpha * most:
            others = np.abs(np.delete(a[k:, r], r - k)).max()
            if abs(a[k, k]) * others < alpha * most * most:
                if abs(a[r, r]) >= alpha * others:
                    swap(k, r)
                else:
                    swap(k + 1, r)
                    two = True
        if two:
            e = a[k:k + 2, k:k + 2]
            negative += int((np.linalg.eigvalsh(e) < 0).sum())  # a block of two rows
            c = a[k + 2:, k:k + 2]
            det = e[0, 0] * e[1, 1] - e[0, 1] * e[1, 0]
            inverse = np.array([[e[1, 1], -e[0, 1]], [-e[1, 0], e[0, 0]]]) / det
            a[k + 2:, k + 2:] -= c @ inverse @ c.T
            k += 2
        else:
            if a[k, k] != 0:
                c = a[k + 1:, k]
                a[k + 1:, k + 1:] -= np.outer(c, c / a[k, k])
                negative += int(a[k, k] < 0)
            k += 1
    return negative


def above(v: np.ndarray, shift: float) -> int:
    """Eigenvalues of ``v`` over ``shift``."""
    return ldl_negative(shift * np.eye(len(v)) - v)


def _solve(v: np.ndarray, shift: float, x: np.ndarray) -> np.ndarray:
    try:
        return np.linalg.solve(v - shift * np.eye(len(v)), x)
    except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
        return np.linalg.solve(v - (shift * (1 + 1e-15) + 1e-300) * np.eye(len(v)), x)


def _apart(x: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for w in found:
            x = x - (w @ x) * w
    return x / np.linalg.norm(x)


def leading(v: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, vectors by row) of the ``wanted`` largest eigenvalues over ``LEAST`` of the trace, largest first.

    Eigenvalues that no shift tells apart (equal to rounding) give orthogonal vectors of their
    common space.
    """
    d, trace = len(v), float(np.trace(v)) if len(v) else 0.0
    values: list[float] = []
    vectors: list[np.ndarray] = []
    if trace <= 0:
        return np.zeros(0), np.zeros((0, d))
    top = float(np.abs(v).sum(axis=1).max()) * (1 + 1e-12)  # no eigenvalue is larger
    eps = 4e-15 * top
    rng = np.random.default_rng(12)
    for k in range(1, min(wanted, d) + 1):
        low, high = LEAST * trace, top * (1 + 1e-12)
        if above(v, low) < k:
            break
        start = rng.standard_normal(d)
        while True:
            # above(low) >= k > above(high): halve until the k-th is alone between them, then try
            n_low, n_high = above(v, low), above(v, high)
            narrow = high - low <= 8 * eps
            if narrow or (n_low == k and n_high == k - 1 and high - low <= 0.25 * high):
                value, x = (low + high) / 2, _apart(start, vectors)
                for _ in range(40):
                    x = _apart(_solve(v, value, x), vectors)
                    last, value = value, float(x @ v @ x)
                    if not low - eps <= value <= high + eps and not narrow:
                        break  # another eigenvalue took it
                    if np.linalg.norm(v @ x - value * x) <= 16 * eps or value == last:
                        break
                if narrow or (low <= value <= high and above(v, value - 4 * eps) >= k > above(v, value + 4 * eps)):
                    values.append(value)
                    vectors.append(x)
                    break
            middle = (low + high) / 2
            low, high = (middle, high) if above(v, middle) >= k else (low, middle)
    return np.array(values), np.array(vectors).reshape(len(values), d)


@dataclass
class Whitening:
    """A fit: number of vectors, sums, eigenvalues, components by row, explained fractions."""
    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    explained: np.ndarray

    def apply(self, x: np.ndarray) -> np.ndarray:
        """(vector, component) whitened coordinates of integer vectors."""
        centre = [s // self.n for s in self.sums]
        rest = np.array([(s - c * self.n) / self.n for s, c in zip(self.sums, centre)])
        y = (x - np.array(centre, np.int64)).astype(np.float64) - rest
        return (y @ self.components.T) / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums over the dimensions of (n * x - sums)^2; None beyond a long."""
        most = max((abs(s) for s in self.sums), default=0) + self.n * int(np.abs(x).max(initial=0))
        if most < 2**31 and most * most * max(1, x.shape[1]) < 2**63:
            y = self.n * x - np.array(self.sums, np.int64)
            return (y * y).sum(axis=1).tolist()
        y = self.n * x.astype(object) - np.array(self.sums, object)
        return [s if s <= _LONG else None for s in (y * y).sum(axis=1).tolist()]


def _fit_rows(rows: DataFrame, wanted: int) -> Whitening:
    sums = (rows.mapInArrow(_sums, "d int, i int, s string, n long").groupBy("d", "i")
            .agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).collect())  # a row a dimension
    if not sums:
        return Whitening(0, [], np.zeros(0), np.zeros((0, 0)), np.zeros(0))
    n, d = max((r["n"], r["d"]) for r in sums)  # the length of most vectors, or the longer of two as frequent
    same = rows.filter(F.size("_v") == d)
    total = [int(r["s"]) for r in sorted(sums, key=lambda r: r["i"]) if r["d"] == d]
    centre = [s // n for s in total]
    got = _gather(same.mapInArrow(_moments(centre), "i int, j int, s string"))
    v = np.zeros((d, d))
    for i in range(d):
        for j in range(i, d):
            # (sum of y y' - s s' / n) / n as one exact fraction
            v[i, j] = v[j, i] = (got[i, j] * n - got[i, -1] * got[j, -1]) / n**2
    values, components = leading(v, wanted)
    return Whitening(n, total, values, components, values / np.trace(v) if len(values) else values)


def fit(docs: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", vector: str = "embedding") -> Whitening:
    """The whitening of all vectors without null or non-finite entries."""
    return _fit_rows(_vectors(docs, vec_id, vector), components)


def _second_moments(model: Whitening):
    def run(batches):
        k = len(model.values)
        n, sums, products = 0, np.zeros(k), np.zeros((k, k))
        for _, x in _blocks(batches):
            w = model.apply(x)
            n, sums, products = n + len(w), sums + w.sum(axis=0), products + w.T @ w
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(v) for v in np.r_[-1, np.full(k, -1), np.repeat(np.arange(k), k)]], pa.int32()),
                 pa.array([int(v) for v in np.r_[-1, np.arange(k), np.tile(np.arange(k), k)]], pa.int32()),
                 pa.array(np.concatenate([[float(n)], sums, products.ravel()]))], ["i", "j", "s"])
    return run


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the covariance of the whitened rows minus the identity."""
    k = len(model.values)
    parts = rows.mapInArrow(_second_moments(model), "i int, j int, s double")
    s = {(r["i"], r["j"]): r["s"] for r in parts.groupBy("i", "j").agg(F.sum("s").alias("s")).collect()}  # a row a pair
    if not s:
        return 0.0
    n, mean = s[-1, -1], np.array([s[-1, j] for j in range(k)]) / s[-1, -1]
    cov = np.array([[s[i, j] for j in range(k)] for i in range(k)]) / n - np.outer(mean, mean)
    return float(np.abs(cov - np.eye(k)).max())


def whiten(docs: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Rows vec_id, component (from 1), n, deviation, whitened, explained, identity_error.

    Rows whose vector is null or holds null or non-finite entries are dropped, and those whose
    vector has not the length of most of them.  Rows that repeat an id, or have none, are rows
    like others.  Components with no variance (a constant or fewer than two vectors) are not
    given, so such a table, like an empty one, gives no rows.  A deviation beyond a long is null; an entry beyond
    2^42 counts as that.
    """
    rows = _vectors(docs, vec_id, vector)
    model = _fit_rows(rows, components)
    rows = rows.filter(F.size("_v") == len(model.sums))
    error = identity_error(rows, model) if len(model.values) else 0.0

    def run(batches):
        k = len(model.values)
        for ids, x in _blocks(batches):
            if not k:
                continue
            w, m = model.apply(x), len(x)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, model.n)), pa.array([v for v in model.deviations(x) for _ in range(k)], pa.int64()),
                 pa.array(w.ravel()), pa.array(np.tile(model.explained, m)), pa.array(np.full(m * k, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return rows.mapInArrow(run, "vec_id long, component int, n long, deviation long, whitened double, "
                                "explained double, identity_error double")
