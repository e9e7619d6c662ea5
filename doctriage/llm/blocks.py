"""Blocks of words, and questions about their n-grams (operators 11 and 13).

A block is a slice of the documents, stored as one row of coded words.  About its n-grams it
asks by 64-bit keys: distinct, sorted, dealt by their leading bits to buckets.  A bucket adds
up what all blocks say of a key and answers each block in the order of its keys.  An n-gram
reaches its bucket once a block however often it occurs, and keys spread evenly, so no word,
lang or passage makes a hot bucket; the number of buckets follows the number of words.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 8 << 20      # of text (one longer text: alone)
BUCKET_KEYS = 2 << 20      # that a bucket should get
_CODEC = "zstd"
QUESTIONS = "bucket long, block long, keys binary, counts binary"
_ANSWERS = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("answer", pa.binary())])


def rows(batches):
    """The rows of the batches as dictionaries, one in memory at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]
    pa.default_memory_pool().release_unused()  # the worker lives on


def squeeze(a: np.ndarray) -> bytes:
    """The integers of ``a`` by byte planes, compressed; ``expand`` reads them."""
    raw = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()
    return len(raw).to_bytes(8, "little") + (pa.compress(raw, _CODEC, asbytes=True) if raw else b"")


def expand(blob: bytes, dtype) -> np.ndarray:
    n = int.from_bytes(blob[:8], "little")
    if not n:
        return np.zeros(0, dtype)
    raw = np.frombuffer(pa.decompress(blob[8:], n, _CODEC), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()


def squeeze_words(words: list[str]) -> bytes:
    raw = "\n".join(words).encode()  # no word holds a line break
    return len(raw).to_bytes(8, "little") + (pa.compress(raw, _CODEC, asbytes=True) if raw else b"")


def expand_words(blob: bytes) -> list[str]:
    n = int.from_bytes(blob[:8], "little")
    return pa.decompress(blob[8:], n, _CODEC, asbytes=True).decode().split("\n") if n else []


def distinct_places(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of ``a`` (not negative), ascending, and each one's place among them.

    One plain sort of numbers whose low bits are the place in ``a``: several times as fast as a sort of places.
    """
    n = max(1, len(a)).bit_length()
    low = np.uint64((1 << n) - 1)
    values = a.astype(np.uint64, copy=False)
    fits = int(values.max(initial=0)).bit_length() + n <= 64
    packed = values << np.uint64(n) if fits else values & ~low  # else by the leading bits, almost never equal in two different values
    packed |= np.arange(len(a), dtype=np.uint64)
    packed.sort()
    packed &= low
    by = packed.view(np.int64)
    ordered = a[by]
    if not fits and (ordered[1:] < ordered[:-1]).any():
        by = np.argsort(values)
        ordered = a[by]
    new = np.ones(len(a), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    distinct = ordered[new]
    del ordered
    place = np.empty(len(a), np.int64)
    ranks = np.cumsum(new)
    ranks -= 1
    place[by] = ranks
    return distinct, place


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The key of what has key ``a`` with one more word of key ``b``."""
    h = a * np.uint64(0x9E3779B97F4A7C15) + b
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xC2B2AE3D27D4EB4F)
    return h ^ (h >> np.uint64(32))


def bucket_count(blocks: DataFrame, levels: int) -> int:
    """Buckets for all keys of stored ``blocks`` (column tokens): at most ``levels`` n-grams a word."""
    tokens = blocks.agg(F.sum("tokens")).first()[0] or 0
    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(2 * parts, levels * tokens // BUCKET_KEYS + 1)


def ask(block: int, keys: np.ndarray, counts: np.ndarray, buckets: int, bits: int = 64):
    """Rows of ``QUESTIONS`` about distinct ascending keys of so many bits."""
    to = ((keys >> np.uint64(bits - 32)) * np.uint64(buckets)) >> np.uint64(32)
    cuts = np.r_[0, np.flatnonzero(np.diff(to)) + 1, len(to)] if len(to) else np.zeros(1, int)
    rows = []
    for a, b in zip(cuts, cuts[1:]):
        steps = np.diff(keys[a:b], prepend=np.uint64(0))
        rows.append((int(to[a]), squeeze(steps), squeeze(counts[a:b].astype("<i8"))))
    names = QUESTIONS.replace(" long", "").replace(" binary", "").split(", ")
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int64()), pa.array([block] * len(rows), pa.int64()),
         pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())], names)


def answers(questions: DataFrame, reply: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """Rows (block, bucket, answer) for each question.

    ``reply(total, first)`` has, for each key of each question in turn, the sum of all blocks'
    counts, and whether this block is the first that asks; its numbers go back in the same order.
    """
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        keys = [np.cumsum(expand(k.as_py(), "<u8"), dtype=np.uint64) for k in table.column("keys")]
        ends = np.cumsum([len(k) for k in keys])
        every = np.concatenate(keys)
        del keys
        distinct, place = distinct_places(every)
        del every
        counts = np.concatenate([expand(c.as_py(), "<i8") for c in table.column("counts")])
        total = np.bincount(place, weights=counts, minlength=len(distinct)).astype(np.int64)
        del counts
        first = np.zeros(len(distinct), np.int64)
        first[place[::-1]] = np.arange(len(place) - 1, -1, -1)
        found = reply(total[place], first[place] == np.arange(len(place)))
        parts = [squeeze(found[a:b]) for a, b in zip(np.r_[0, ends[:-1]], ends)]
        return pa.table([table.column("block"), table.column("bucket"), pa.array(parts, pa.binary())], schema=_ANSWERS)
    return questions.groupBy("bucket").applyInArrow(run, "block long, bucket long, answer binary")


def with_answers(blocks: DataFrame, replies: DataFrame) -> DataFrame:
    """``blocks`` with ``replies``: a block's answers by ascending bucket, hence in the order of its keys."""
    mine = replies.groupBy("block").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("bucket", "answer"))), lambda x: x["answer"]).alias("replies"))
    return blocks.join(mine, "block", "left")


def joined(replies: list[bytes] | None, dtype) -> np.ndarray:
    return np.concatenate([expand(r, dtype) for r in replies or []] or [np.zeros(0, dtype)])
