"""Packing (operator 7): shortest-pack-first over the length histogram.

Documents are tokenised and cut at every full sequence; what is left of each is one piece.
Only the histogram of piece lengths (one count a length, at most as many as a sequence has
ids) comes to the driver.  There the lengths are placed longest first, each into the
shortest pack that has room, by counts: a packing pattern and how many packs follow it.
Pieces are then numbered by length, and a piece's place among those of its length says which
pack of which pattern it fills.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import tokens
from .common import column, numbered, text_slices

SEQUENCE = 2048


def _cutter(vocabulary: str, end_id: int, sequence: int):
    def cut(batches):
        with tokens.encoder(vocabulary) as encode:
            yield from encoded(batches, encode)

    def encoded(batches, encode):
        end = np.array([end_id], "<u4").tobytes()
        for rows, texts in text_slices(batches):
            out: dict[str, list] = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")}
            for doc, ids in zip(rows.column(0).to_pylist(), encode(texts.to_pylist())):
                raw = memoryview(ids + end)
                n = len(raw) // 4
                for a in range(0, n, sequence):
                    out["doc_id"].append(doc)
                    out["start"].append(a)
                    out["length"].append(min(sequence, n - a))
                    out["ids_crc32"].append(zlib.crc32(raw[4 * a:4 * (a + sequence)]))
                    out["doc_tokens"].append(n)
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in out.values()], list(out))
    return cut


def pieces(docs: DataFrame, vocabulary: str = tokens.BYTE_BPE, end_id: int = tokens.END_ID,
           sequence: int = SEQUENCE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens of each piece: full sequences, then the rest."""
    rows = docs.select(column(docs, doc_id).cast("long").alias("doc_id"), column(docs, text).cast("string").alias("text"))
    return rows.mapInArrow(_cutter(vocabulary, end_id, sequence),
                           "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def pack_histogram(counts: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[tuple[int, ...], int]]:
    """Packing patterns (lengths in the order placed) and their counts, shortest pack first.

    A step either uses up a length or an open pattern, so there are no more patterns than a
    few times the distinct lengths, whatever the counts.
    """
    open_packs: list[tuple[int, tuple[int, ...], int]] = []  # a heap by pack length
    done: list[tuple[tuple[int, ...], int]] = []
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if open_packs and open_packs[0][0] + length <= sequence:
                total, pattern, n = heapq.heappop(open_packs)
                if n > left:
                    heapq.heappush(open_packs, (total, pattern, n - left))
                n = min(n, left)
            else:  # fresh packs; more of this length may join them later
                total, pattern, n = 0, (), max(1, -(-left // (sequence // length)))
            left -= n
            if total + length == sequence:
                done.append(((*pattern, length), n))
            else:
                heapq.heappush(open_packs, (total + length, (*pattern, length), n))
    return done + [(p, n) for _, p, n in sorted(open_packs)]


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows (first place, first sequence id, offset), by place among all pieces ordered by length."""
    rows, sequence_id = [], 0
    for pattern, n in patterns:
        offset = 0
        for length in pattern:
            rows.append((length, sequence_id, offset, n))
            offset += length
        sequence_id += n
    rows.sort()
    place, out = 0, []
    for _, sequence_id, offset, n in rows:
        out.append((place, sequence_id, offset))
        place += n
    return np.array(out, np.int64).reshape(-1, 3)


def _placer(table: np.ndarray):
    def place(batches):
        for b in batches:
            at = b.column(b.schema.get_field_index("_place")).to_numpy(zero_copy_only=False)
            row = table[np.searchsorted(table[:, 0], at, side="right") - 1]
            kept = b.select([c for c in b.schema.names if c != "_place"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(row[:, 1] + at - row[:, 0]), pa.array(row[:, 2])],
                [*kept.schema.names, "sequence_id", "offset"])
    return place


def pack(found: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """``pieces`` with sequence_id and offset.  Sequences shorter than ``sequence`` are to be padded."""
    found = materialize(found, "pieces")
    counts = {r["length"]: r["count"] for r in found.groupBy("length").count().collect()}  # a row a length
    table = slots(pack_histogram(counts, sequence))
    placed = numbered(found, ["length", "doc_id", "start", "ids_crc32", "doc_tokens"], "_place")
    return placed.mapInArrow(_placer(table), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                                             "sequence_id long, offset long")


def pack_documents(docs: DataFrame, vocabulary: str = tokens.BYTE_BPE, end_id: int = tokens.END_ID,
                   sequence: int = SEQUENCE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null or empty text is its end id alone; rows that repeat an id, or have none, are
    packed like others; an empty table gives no rows.  Reruns agree, ties of pieces that are
    equal in all columns aside.
    """
    return pack(pieces(docs, vocabulary, end_id, sequence, doc_id, text), sequence)
