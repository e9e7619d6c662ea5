"""SimHash near-dedup (operator 9): anchor points of a covering code.

The code is a direct product over the 64 bits: Golay (23 bits) twice, Hamming (15 bits) and
repetition (3 bits).  All four are perfect, so every fingerprint lies within the covering
radius 3 + 3 + 1 + 1 = 8 of exactly one nearest anchor.  Two fingerprints at distance 2 or
less have a point at distance 1 or less from both; that point's nearest anchor is within
covering radius plus threshold of both.  Replicating a fingerprint to the nearest anchors of
all points at distance 1 or less from it (about 18 of the 65 differ) therefore brings every
such pair together at some anchor, and only fingerprints of one anchor are compared.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import NO_ID, column, kept_rows, let_go, own_rows, text_slices
from .components import components

SHINGLE = 3
MAX_BITS = 2
SEED = 42
# fixed values: (bits, generator polynomial, radius) of the cyclic blocks, lowest bits first
BLOCKS = ((23, 0xAE3, 3), (23, 0xAE3, 3), (15, 0x13, 1), (3, 0x7, 1))
_DIRECT = 64  # anchors with more fingerprints are linked by way of the points between them


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64 bits: each is 1 if it is set in over half the hashes of the word shingles."""
    words = text.encode("utf-8", "replace").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    runs = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    hashes = np.fromiter((xxhash.xxh64_intdigest(r, SEED) for r in runs), np.uint64)
    ones = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 1 << 16):
        part = hashes[a:a + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches):
        let_go()
        for rows, texts in text_slices(batches):
            found = np.array([fingerprint(t, shingle) for t in texts.to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*rows.columns[:-1], pa.array(found.view(np.int64))],
                                             [*rows.schema.names[:-1], "_fp"])
    return run


def _block_tables(bits: int, poly: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Syndrome of each bit, and the error of least weight for each syndrome."""
    degree = poly.bit_length() - 1
    syndromes = []
    x = 1
    for _ in range(bits):
        syndromes.append(x)
        x <<= 1
        if x >> degree:
            x ^= poly
    errors = np.zeros(1 << degree, np.uint64)
    for n in range(1, radius + 1):
        for flips in itertools.combinations(range(bits), n):
            s = 0
            for i in flips:
                s ^= syndromes[i]
            errors[s] = sum(1 << i for i in flips)
    return np.array(syndromes, np.int64), errors


_TABLES = [_block_tables(*b) for b in BLOCKS]


def anchors(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor) of the distinct anchors to which each fingerprint is replicated."""
    parts, moves, shift, at = [], [], 0, 0
    for (bits, poly, _), (syndromes, errors) in zip(BLOCKS, _TABLES):
        degree = poly.bit_length() - 1
        x = (fps >> np.uint64(at)) & np.uint64((1 << bits) - 1)
        s = np.zeros(len(fps), np.int64)
        for i in range(bits):
            s ^= np.where((x >> np.uint64(i)) & np.uint64(1), syndromes[i], 0)
        # a word of the code is known by the bits above its check bits
        name = lambda y: (y >> np.uint64(degree)) << np.uint64(shift)  # noqa: E731, B023
        own = name(x ^ errors[s])
        parts.append(own)
        moves.append([own ^ name(x ^ np.uint64(1 << i) ^ errors[s ^ syndromes[i]]) for i in range(bits)])
        at, shift = at + bits, shift + bits - degree
    nearest = parts[0] | parts[1] | parts[2] | parts[3]
    keys = np.stack([nearest, *[nearest ^ m for block in moves for m in block]], axis=1)
    keys.sort(axis=1)
    first = np.ones(keys.shape, bool)
    first[:, 1:] = keys[:, 1:] != keys[:, :-1]
    rows, cols = np.nonzero(first)
    return rows, keys[rows, cols].view(np.int64)


def _replicate(batches):
    for b in batches:
        fps = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for a in range(0, len(fps), 1 << 13):
            rows, keys = anchors(fps[a:a + (1 << 13)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array(fps[a:a + (1 << 13)][rows].view(np.int64))], ["anchor", "_fp"])


def least_linked(fps: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """For each of the distinct fingerprints of an anchor, the position of the first in its component.

    Few are compared with each other.  Many are linked through the points at distance 1 or
    less from them, which two share exactly if they differ in 2 bits or less: 65 points each,
    so a large group costs in proportion to its size.
    """
    n = len(fps)
    label = np.arange(n)
    if n <= _DIRECT or max_bits < 2:
        step = max(1, (1 << 22) // n)
        while True:
            new = label.copy()
            for a in range(0, n, step):
                near = np.bitwise_count(fps[a:a + step, None] ^ fps[None, :]) <= max_bits
                new[a:a + step] = np.where(near, label[None, :], n).min(axis=1)
            new = new[new]
            if np.array_equal(new, label):
                return label
            label = new
    points = np.concatenate([fps, *[fps ^ np.uint64(1 << i) for i in range(64)]])
    place = np.unique(points, return_inverse=True)[1]
    while True:
        at = np.full(place.max() + 1, n)
        np.minimum.at(at, place, np.tile(label, 65))
        new = np.minimum(label, at[place].reshape(65, n).min(axis=0))
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _link(max_bits: int):
    def links(keys: np.ndarray, fps: np.ndarray):
        """A link from each fingerprint to the first of its component, over whole anchors."""
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[starts, len(keys)])
        two = starts[sizes == 2]
        two = two[np.bitwise_count(fps[two] ^ fps[two + 1]) <= max_bits]
        us, vs = [fps[two + 1]], [fps[two]]
        for a, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            own = fps[a:a + n]
            least = least_linked(own, max_bits)
            far = least != np.arange(n)
            us.append(own[far])
            vs.append(own[least[far]])
        return np.concatenate(us), np.concatenate(vs)

    def run(batches):
        keys, fps = [], []  # the last anchor's rows may go on in the next batch

        def flush(upto=None):
            k, f = np.concatenate(keys), np.concatenate(fps)
            cut = len(k) if upto is None else int(np.searchsorted(k, upto))
            u, v = links(k[:cut], f[:cut]) if cut else (f[:0], f[:0])
            keys[:], fps[:] = [k[cut:]], [f[cut:]]
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

        for b in batches:
            if not b.num_rows:
                continue
            keys.append(b.column(0).to_numpy(zero_copy_only=False))
            fps.append(b.column(1).to_numpy(zero_copy_only=False).view(np.uint64))
            if keys[-1][-1] != keys[0][0]:
                yield flush(keys[-1][-1])
        if keys:
            yield flush()
    return run


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id.

    Fingerprints link at ``max_bits`` (0 to 2) or fewer differing bits; ``component_id`` is
    the smallest id reachable.  Null, empty and blank texts have fingerprint zero, linked like
    any other.  A null id counts as larger than all others, and a component of null ids alone
    has a null id.  Rows that repeat an id are rows of their own.  Work goes by distinct
    fingerprints: copies, however many, are one.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("max_bits must be 0, 1 or 2")
    return _linked(docs, shingle, max_bits, doc_id, text).select(
        "doc_id", F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id")


def _linked(docs: DataFrame, shingle: int, max_bits: int, doc_id: str, text: str, *more: str) -> DataFrame:
    """doc_id, _fp, component_id, _root (the component's own number) and the columns ``more`` (long) of ``docs``."""
    rows = docs.select(column(docs, doc_id).cast("long").alias("doc_id"), *more, column(docs, text).cast("string").alias("text"))
    schema = ", ".join(f"{c} long" for c in ("doc_id", *more, "_fp"))
    marked = materialize(rows.mapInArrow(_fingerprints(shingle), schema), "fingerprints")
    distinct = materialize(marked.groupBy("_fp").agg(F.min(F.coalesce("doc_id", F.lit(NO_ID))).alias("_first")), "distinct")
    spread = distinct.select("_fp").mapInArrow(_replicate, "anchor long, _fp long")
    met = spread.repartition("anchor").sortWithinPartitions("anchor", "_fp")
    linked = components(met.mapInArrow(_link(max_bits), "u long, v long"))
    rooted = (distinct.join(linked, distinct["_fp"] == linked["node"], "left")
              .select("_fp", "_first", F.coalesce("root", "_fp").alias("_root")))
    least = rooted.groupBy("_root").agg(F.min("_first").alias("_least"))
    classes = rooted.join(least, "_root").select("_fp", "_root", F.nullif(F.col("_least"), F.lit(NO_ID)).alias("component_id"))
    return marked.join(classes, "_fp")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
             doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The row of ``docs`` with the smallest id of each component, with all its columns.

    Of rows that repeat that id, or where none has an id, the first stays.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("max_bits must be 0, 1 or 2")
    stored = own_rows(docs)
    name = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    found = _linked(stored, shingle, max_bits, name[doc_id], name[text], "_row")
    kept = (found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
            .groupBy("_root").agg(F.min("_row").alias("_row")).select("_row"))
    return kept_rows(stored, kept, docs)
