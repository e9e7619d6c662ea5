"""Suffix-array dedup (operator 10): deep-shallow sorting of the suffixes that may repeat.

A byte is removed if a 50-byte string that covers it also starts in a document with a smaller
id.  Three passes, each spread by Spark:

1. Every 50-byte string names an anchor: the leftmost of its 24-byte strings with the least
   hash.  Equal strings name equal anchors, so an anchor found in one document only rules out
   all strings that name it.  Anchors are counted by hash, each map slice first combining its
   own.
2. For anchors of more documents, the bytes around them are dealt by anchor.  There the
   suffixes that begin at the strings' starts are sorted to a depth of 50 bytes: by multikey
   quicksort on 8-byte characters down to a shallow depth, and by blind tries over all that
   still agree there.  Equal suffixes learn the smallest document id.
3. Each document unites its spans and drops their bytes.

Contexts that agree whole are combined in each map slice: the smallest id speaks for them, the
others know at once that all their strings go.  A passage that a third of all documents share
reaches its task as one row a slice.  At the passage's edges contexts differ in each document
and do not combine.  Pass 1 therefore counts each anchor's differing contexts, slice by slice;
an anchor with more than a task should sort is split: its strings are dealt one by one, each by
its own hash.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import NO_ID, column, slices

WIDTH = 50       # bytes of the strings that are compared
GRAM = 24        # bytes of an anchor
SHALLOW = 24     # depth of the multikey quicksort; blind tries go on from there
BUCKET_BYTES = 8 << 20  # of text whose anchors or contexts a task should get
HOT = 4096       # contexts (of 27 strings at most) of an anchor beyond which its strings are dealt one by one ...
HOT_ANCHORS = 1 << 24  # ... or this part of all bytes, which bounds the list of such anchors ...
HOT_MOST = 1 << 16     # ... up to what a task can hold
HASH_BYTES = 6   # of an anchor's hash that are counted: one taken for another is only looked at in vain
_SINGLE = 255    # in place of the anchor's offset: a string dealt alone
_SUFFIXES = 1 << 16      # sorted at once
_SLICE = 4 << 20


def _byte_slices(batches):
    """(the batch's slice, one buffer of all its texts' bytes, the ends of each)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(batch.schema.get_field_index("text")).cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        for a, b in slices(np.diff(offsets), _SLICE):
            yield batch.slice(a, b - a), raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]


def _mix(words) -> np.ndarray:
    """A 64-bit hash of the 8-byte words (arrays, one a place)."""
    h = np.uint64(0x165667B19E3779F9)
    for w, by in zip(words, itertools.cycle((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))):
        h = (h + w) * np.uint64(by)
        h ^= h >> np.uint64(31)
    return h


def _hashes(raw: np.ndarray) -> np.ndarray:
    """A hash of the 24 bytes from each position on."""
    n = len(raw) - GRAM + 1
    words = np.lib.stride_tricks.as_strided(raw, (len(raw) - 7, 8), (1, 1))
    w = np.ascontiguousarray(words).view("<u8").ravel()
    return _mix([w[8 * i:8 * i + n] for i in range(GRAM // 8)])


def _word(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The 8 bytes from each of the positions on, as a number."""
    return np.lib.stride_tricks.sliding_window_view(data, 8)[at].view("<u8").ravel()


def _whole_hash(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A hash of the 50 bytes from each of the positions on."""
    return _mix([_word(data, at + i) for i in (*range(0, WIDTH - 7, 8), WIDTH - 8)])


def _seal(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value; what is dealt is most of what this operator writes to disk."""
    raw = b"".join(x for a in arrays for x in (np.array([a.nbytes], "<i8").tobytes(), a.tobytes()))
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _unseal(blob: bytes, *kinds: str) -> list[np.ndarray]:
    raw = pa.decompress(memoryview(blob)[8:], int.from_bytes(blob[:8], "little"), "zstd")
    out, at = [], 0
    for kind in kinds:
        n = int(np.frombuffer(raw, "<i8", 1, at)[0])
        out.append(np.frombuffer(raw, kind, n // np.dtype(kind).itemsize, at + 8))
        at += 8 + n
    return out


def _members(text: np.ndarray, doc: np.ndarray, key: np.ndarray) -> list[np.ndarray]:
    """(id steps, keys, which entries begin another text) of entries in order of their text."""
    new = np.r_[True, text[1:] != text[:-1]] if len(text) else np.zeros(0, bool)
    return [np.diff(doc[text[new]], prepend=0).astype("<i8"), key[text[new]].astype("<i8"), np.packbits(new)]


def _entries(steps: np.ndarray, keys: np.ndarray, new: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(id, key) of each of the ``n`` entries."""
    at = np.cumsum(np.unpackbits(new, count=n)) - 1
    return np.cumsum(steps)[at], keys.astype(np.int64)[at]


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` hashes, the offset of the leftmost least one."""
    best, at, size = h, np.zeros(len(h), np.uint8), 1
    while size < width:
        step = min(size, width - size)
        left, right = best[:-step], best[step:]
        later = right < left
        at = np.where(later, at[step:] + np.uint8(step), at[:-step])
        best = np.where(later, right, left)
        size += step
    return at


def anchors(raw: np.ndarray, ends: np.ndarray):
    """Runs of the strings that name the same anchor: text, first and last string, anchor, hash."""
    none = np.zeros(0, np.int64)
    n = len(raw) - WIDTH + 1
    if n <= 0:
        return none, none, none, none, np.zeros(0, np.uint64)
    parts = []
    step = 1 << 18  # in cache
    for a in range(0, n, step):
        b = min(n, a + step)
        h = _hashes(raw[a:b + WIDTH - 1])
        place = np.arange(b - a) + _least(h, WIDTH - GRAM + 1)
        new = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        parts.append((a + new, a + place[new], h[place[new]]))
    start = np.concatenate([p[0] for p in parts])
    anchor = np.concatenate([p[1] for p in parts])
    hashed = np.concatenate([p[2] for p in parts])
    last = np.r_[start[1:], n] - 1
    # a run may not leave its text: cut runs at the texts' ends, and drop strings that cross one
    text = np.searchsorted(ends, start, side="right") - 1
    upto = np.minimum(last, ends[text + 1] - WIDTH)
    whole = upto >= start
    rest = np.flatnonzero(last >= ends[text + 1])  # strings of later texts in the same run
    more = [(start[whole], upto[whole], anchor[whole], hashed[whole], text[whole])]
    while len(rest):
        t = text[rest] + 1
        s = ends[t]
        u = np.minimum(last[rest], ends[t + 1] - WIDTH)
        ok = u >= s
        more.append((s[ok], u[ok], anchor[rest][ok], hashed[rest][ok], t[ok]))
        text[rest] = t
        rest = rest[last[rest] >= ends[t + 1]]
    start, last, anchor, hashed, text = (np.concatenate(x) for x in zip(*more))
    order = np.argsort(start, kind="stable")
    return text[order], start[order], last[order], anchor[order], hashed[order]


def _bucket(hashed: np.ndarray, buckets: int) -> np.ndarray:
    return (hashed >> np.uint64(24)).astype(np.int64) % buckets


def _ids(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(rows.column(rows.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(np.int64)
                 for c in ("doc_id", "_key"))


def _by_value(values: np.ndarray):
    """(value, positions that hold it) in order of value."""
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.r_[True, values[order][1:] != values[order][:-1]]) if len(values) else np.zeros(0, int)
    return zip(values[order][cuts].tolist(), np.split(order, cuts[1:])) if len(values) else ()


# --- pass 1: which anchors occur in more than one document ---------------------------------------

def _count_anchors(buckets: int):
    """Rows: bucket, and the sealed ids, hashes, contexts, and whether they are known to repeat, of its anchors.

    The first entry of an anchor has the number of its differing contexts in the slice, others have 0.
    """
    def run(batches):
        for rows, raw, ends in _byte_slices(batches):
            text, start, last, _, hashed = anchors(raw, ends)
            if not len(text):
                continue
            doc, key = _ids(rows)
            order = np.lexsort((doc[text], hashed))
            text, start, last, hashed = text[order], start[order], last[order], hashed[order]
            new = np.r_[True, hashed[1:] != hashed[:-1]]
            first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
            # the slice's smallest id speaks for an anchor; if others hold it, all are known to repeat it
            other = doc[text] != doc[text[first]]
            group = np.cumsum(new) - 1
            repeats = (np.bincount(group, weights=other) > 0)[group]
            speak = doc[text] == doc[text[first]]
            pairs = np.r_[True, (hashed[1:] != hashed[:-1]) | (text[1:] != text[:-1])]
            contexts = np.where(new, _differing(raw, start, last, group)[group], 0).astype("<u4")
            send = (speak | repeats) & pairs
            text, hashed, repeats, speak, contexts = (x[send] for x in (text, hashed, repeats, speak, contexts))
            # what is known already only passes through, so it may go to any bucket
            to = np.where(speak, _bucket(hashed, buckets), (text + doc[text]) % buckets)
            for bucket, at in _by_value(to):
                at = at[np.argsort(text[at], kind="stable")]
                short = hashed[at].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES]
                yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int64()), pa.array([_seal(
                    *_members(text[at], doc, key), np.packbits(repeats[at]), np.ascontiguousarray(short), contexts[at])],
                    pa.binary())], ["bucket", "blob"])
    return run


def _differing(raw: np.ndarray, start: np.ndarray, last: np.ndarray, group: np.ndarray) -> np.ndarray:
    """The number of differing contexts of each group (groups are numbered in order)."""
    sizes = np.bincount(group)
    at = np.flatnonzero(sizes[group] > 1)
    # the first and the last string cover the context
    content = _mix([_whole_hash(raw, start[at]), _whole_hash(raw, last[at]), (last - start)[at].astype(np.uint64)])
    of = group[at]
    order = np.lexsort((content, of))
    content, of = content[order], of[order]
    new = np.r_[True, (of[1:] != of[:-1]) | (content[1:] != content[:-1])] if len(of) else np.zeros(0, bool)
    return np.maximum(np.bincount(of[new], minlength=len(sizes)), 1)


def _blobs_of(batches):
    for b in batches:
        for x in b.column(b.schema.get_field_index("blob")):
            yield x.as_py()


def _joined(parts: list[list[np.ndarray]]):
    """The arrays of each list as one; what is joined is let go at once."""
    while parts:
        yield np.concatenate(parts.pop(0))


def _repeated_anchors(hot: int, buckets: int):
    """Rows by document of its anchors that other documents hold too; bucket -1 has those with more than ``hot`` contexts."""
    def run(batches):
        got = [[], [], [], [], []]
        for blob in _blobs_of(batches):
            steps, keys, new, repeats, short, contexts = _unseal(blob, "<i8", "<i8", "u1", "u1", "u1", "<u4")
            n = len(short) // HASH_BYTES
            wide = np.zeros((n, 8), np.uint8)
            wide[:, :HASH_BYTES] = short.reshape(n, HASH_BYTES)
            doc, key = _entries(steps, keys, new, n)
            for x, v in zip(got, (doc, key, wide.view("<u8").ravel(),
                                  np.unpackbits(repeats, count=n).astype(bool), contexts)):
                x.append(v)
        if not got[0]:
            return
        doc, key, hashed, known, contexts = _joined(got)
        order = np.argsort(hashed)
        hashed = hashed[order]
        starts = np.flatnonzero(np.r_[True, hashed[1:] != hashed[:-1]])
        sizes = np.diff(np.r_[starts, len(hashed)])
        own = doc[order]
        more = ((np.minimum.reduceat(own, starts) != np.maximum.reduceat(own, starts))
                | np.logical_or.reduceat(known[order], starts))
        # slices combine equal contexts when they are dealt, so this is what the anchor's task would get
        many = hashed[starts[more & (np.add.reduceat(contexts[order], starts, dtype=np.int64) > hot)]]
        at = np.flatnonzero(np.repeat(more, sizes))
        # 32 bits are enough to find an anchor in its own text again; one found wrongly does no harm
        hashed, at = hashed[at].astype("<u4"), order[at]
        del order, own, known, contexts
        yield from _deal(doc[at], key[at], hashed, buckets)
        if len(many):
            yield pa.RecordBatch.from_arrays([pa.array([-1]), pa.array([many.astype("<u8").tobytes()], pa.binary())],
                                             ["bucket", "blob"])
    return run


def _deal(doc: np.ndarray, key: np.ndarray, values: np.ndarray, buckets: int):
    """Rows of (bucket, sealed documents and values), a row a bucket, all of a document in one bucket."""
    to = ((doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + key.astype(np.uint64)) >> np.uint64(20)) % np.uint64(buckets)
    for bucket, at in _by_value(to.astype(np.int64)):
        yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int64()), pa.array([_seal(
            doc[at].astype("<i8"), key[at].astype("<i8"), np.ascontiguousarray(values[at]))], pa.binary())],
            ["bucket", "blob"])


def _merge(name: str, kind: str, width: int):
    """One row a document: doc_id, _key, its values as bytes."""
    def run(batches):
        got = [_unseal(x, "<i8", "<i8", kind) for x in _blobs_of(batches)]
        if not got:
            return
        doc, key, values = _joined([list(x) for x in zip(*got)])
        values = values.reshape(-1, width)
        order = np.lexsort((key, doc))
        doc, key, values = doc[order], key[order], values[order]
        cuts = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])])
        stops = np.r_[cuts[1:], len(doc)]
        raw, size = values.tobytes(), values.itemsize * width
        for i in range(0, len(cuts), 1 << 13):
            a, b = cuts[i:i + (1 << 13)], stops[i:i + (1 << 13)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[a]), pa.array(key[a]),
                 pa.array([raw[size * x:size * y] for x, y in zip(a.tolist(), b.tolist())], pa.binary())],
                ["doc_id", "_key", name])
    return run


# --- pass 2: the strings around repeated anchors -------------------------------------------------

def _contexts(buckets: int, hot):
    """Rows of contexts by anchor, and of the spans that are known at once."""
    def run(batches):
        for rows, raw, ends in _byte_slices(batches):
            text, start, last, anchor, hashed = anchors(raw, ends)
            if not len(text):
                continue
            column_of = lambda c: rows.column(rows.schema.get_field_index(c)).to_pylist()  # noqa: E731, B023
            cuts = np.searchsorted(text, np.arange(len(ends)))
            short = hashed.astype("<u4")
            keep = np.concatenate([np.isin(short[a:b], np.frombuffer(x, "<u4"))
                                   for a, b, x in zip(cuts, cuts[1:], column_of("hashes"))])
            text, start, last, hashed = text[keep], start[keep], last[keep], hashed[keep]
            offset = (anchor[keep] - start).astype(np.uint8)
            single = np.isin(hashed & np.uint64((1 << 8 * HASH_BYTES) - 1), hot.value)
            if single.any():  # a run of one string each
                n = np.where(single, last - start + 1, 1)
                of = np.repeat(np.arange(len(n)), n)
                start = start[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
                text, hashed, single = text[of], hashed[of], single[of]
                last, offset = np.where(single, start, last[of]), np.where(single, _SINGLE, offset[of])
                hashed[single] = _whole_hash(raw, start[single])
            doc, key = _ids(rows)
            data = raw.tobytes()
            pieces = [data[a:b + WIDTH] for a, b in zip(start.tolist(), last.tolist())]
            own = doc[text].tolist()
            least: dict[bytes, int] = {}  # the bytes alone say which anchor they name
            for piece, d in zip(pieces, own):
                if least.get(piece, NO_ID + 1) > d:
                    least[piece] = d
            speaks = np.array([least[piece] == d for piece, d in zip(pieces, own)], bool)
            rel = start - ends[text]
            to = np.where(speaks, _bucket(hashed, buckets), (text + doc[text]) % buckets)
            del least, own
            for bucket, at in _by_value(to):
                at = np.sort(at)
                said, sure = at[speaks[at]], at[~speaks[at]]
                size = (last - start + WIDTH).astype("<i4")
                yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int64()), pa.array([_seal(
                    *_members(text[said], doc, key), rel[said].astype("<i4"), size[said].astype("u1"), offset[said],
                    np.frombuffer(b"".join([pieces[i] for i in said.tolist()]), np.uint8),
                    *_members(text[sure], doc, key), rel[sure].astype("<i4"), size[sure])], pa.binary())],
                    ["bucket", "blob"])
    return run


def deep_shallow(suffixes: np.ndarray, group: np.ndarray, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Sort the rows of ``suffixes`` (bytes) within their groups: (order, number of the class of equal rows).

    Shallow: multikey quicksort; each pass splits the classes by their next character of 8 bytes.
    Deep: a blind trie for each class still together, all of a level at a time.  A class skips
    the bytes on which all its members agree, branches on the first byte that differs, and ends
    when none does.
    """
    order = np.argsort(group, kind="stable")
    cls = group[order]
    depth = suffixes.shape[1]
    shallow = min(shallow, depth) // 8 * 8
    for at in range(0, shallow, 8):
        char = np.ascontiguousarray(suffixes[order, at:at + 8]).view(">u8").ravel().astype(np.uint64)
        by = np.lexsort((char, cls))
        order, cls, char = order[by], cls[by], char[by]
        cls = np.cumsum(np.r_[False, (cls[1:] != cls[:-1]) | (char[1:] != char[:-1])])
    else:
        cls = np.cumsum(np.r_[False, cls[1:] != cls[:-1]]) if len(cls) else cls
    # positions in ``order`` that belong to classes of more than one member, in order
    sizes = np.bincount(cls)
    live = np.flatnonzero(sizes[cls] > 1)
    final = np.zeros(len(order), np.int64)  # splits found below, as places where a class begins
    final[:] = np.r_[True, cls[1:] != cls[:-1]] if len(cls) else 0
    while len(live):
        c = cls[live]
        starts = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
        first = np.repeat(starts, np.diff(np.r_[starts, len(c)]))
        rows = suffixes[order[live], shallow:]
        differ = rows != rows[first]
        lcp = np.where(differ.any(axis=1), differ.argmax(axis=1), depth - shallow)
        branch = np.minimum.reduceat(lcp, starts)          # of each class
        split = branch < depth - shallow
        of = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(c)]))
        moving = split[of]
        if not moving.any():
            break
        live, of = live[moving], of[moving]
        byte = rows[moving][np.arange(len(live)), branch[of]]
        by = np.lexsort((byte, of))
        order[live] = order[live][by]                      # live positions of a class are contiguous
        new = np.r_[True, (of[by][1:] != of[by][:-1]) | (byte[by][1:] != byte[by][:-1])]
        final[live[new]] = 1
        cls = np.cumsum(final) - 1
        sizes = np.bincount(cls)
        live = live[sizes[cls[live]] > 1]
    return order, (np.cumsum(final) - 1).astype(np.int64)


def _removed(suffix_of: np.ndarray, offset: np.ndarray, doc: np.ndarray, names: np.ndarray, data: np.ndarray):
    """For each suffix (string), whether it also starts in a smaller document."""
    rows = np.lib.stride_tricks.sliding_window_view(data, WIDTH)[offset]
    order, cls = deep_shallow(rows, names)
    least = np.full(int(cls[-1]) + 1, NO_ID)
    np.minimum.at(least, cls, doc[suffix_of[order]])
    out = np.zeros(len(order), bool)
    out[order] = least[cls] < doc[suffix_of[order]]
    return out


def _spans(buckets: int):
    """Rows by document of the spans (start, end) whose bytes go."""
    return lambda batches: _find_spans(batches, buckets)


def _find_spans(batches, buckets: int):
    got: list[list[np.ndarray]] = [[], [], [], [], [], []]
    found = [np.zeros((0, 4), np.int64)]
    for blob in _blobs_of(batches):
        steps, keys, new, start, size, offset, data, *sure = _unseal(
            blob, "<i8", "<i8", "u1", "<i4", "u1", "u1", "u1", "<i8", "<i8", "u1", "<i4", "<i4")
        for x, v in zip(got, (*_entries(steps, keys, new, len(start)), start, size, offset, data)):
            x.append(v)
        steps, keys, new, start, size = sure
        found.append(np.stack([*_entries(steps, keys, new, len(start)), start, start.astype(np.int64) + size], axis=1))
    if not got[0]:
        return
    if not any(map(len, got[2])):  # all is known already
        got[5] = [np.zeros(WIDTH, np.uint8)]
    doc, key, start, size, offset, data = _joined(got)
    size = size.astype(np.int64)
    at = np.cumsum(size) - size
    # an anchor's bytes name it; a string dealt alone is named by all of its own
    hashed = np.zeros(len(at), np.uint64)
    alone = offset == _SINGLE
    hashed[alone] = _whole_hash(data, at[alone])
    gram = (at + offset)[~alone]
    hashed[~alone] = _mix([_word(data, gram + 8 * i) for i in range(GRAM // 8)])
    del gram
    order = np.argsort(hashed, kind="stable")
    cuts = np.flatnonzero(np.r_[True, hashed[order][1:] != hashed[order][:-1]]) if len(order) else np.zeros(0, int)
    n_strings = size - WIDTH + 1
    # whole anchors at a time, up to so many suffixes (one anchor with more: alone)
    per = np.add.reduceat(n_strings[order], cuts) if len(cuts) else np.zeros(0, int)
    for a, b in slices(per, _SUFFIXES):
        rows = order[cuts[a]:cuts[b] if b < len(cuts) else len(order)]
        n = n_strings[rows]
        of = np.repeat(np.arange(len(rows)), n)
        inner = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        group = np.cumsum(np.r_[False, hashed[rows][1:] != hashed[rows][:-1]])[of]
        gone = _removed(of, at[rows][of] + inner, doc[rows], group, data)
        # runs of strings that go, within each context
        edge = np.flatnonzero(gone & np.r_[True, ~gone[:-1] | (of[1:] != of[:-1])])
        stop = np.flatnonzero(gone & np.r_[~gone[1:] | (of[1:] != of[:-1]), True])
        r = rows[of[edge]]
        found.append(np.stack([doc[r], key[r], start[r] + inner[edge], start[r] + inner[stop] + WIDTH], axis=1))
    spans = np.concatenate(found)
    yield from _deal(spans[:, 0], spans[:, 1], np.ascontiguousarray(spans[:, 2:]).astype("<i8"), buckets)


# --- pass 3: the spans of each document ----------------------------------------------------------

def united(spans: np.ndarray) -> np.ndarray:
    """Disjoint spans, in order, that do not touch."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.r_[True, spans[1:, 0] > reach[:-1]]
    return np.stack([spans[new, 0], reach[np.r_[np.flatnonzero(new)[1:] - 1, len(spans) - 1]]], axis=1)


def _finish(with_text: bool):
    def run(batches):
        for batch in batches:
            bodies = batch.column(batch.schema.get_field_index("text")).cast(pa.large_binary()).to_pylist()
            listed = batch.column(batch.schema.get_field_index("spans")).to_pylist()
            n_bytes, removed, runs, sha, kept = [], [], [], [], []
            for body, blob in zip(bodies, listed):
                spans = united(np.frombuffer(blob, "<i8").reshape(-1, 2)) if blob else ()
                at, left = 0, []
                for a, b in (spans.tolist() if len(spans) else ()):
                    left.append(body[at:a])
                    at = b
                left = b"".join([*left, body[at:]])
                n_bytes.append(len(body))
                removed.append(len(body) - len(left))
                runs.append(len(spans))
                sha.append(hashlib.sha256(left).hexdigest())
                kept.append(left if with_text else None)
            arrays = [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()),
                      pa.array(runs, pa.int64()), pa.array(sha, pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                arrays, names = [*arrays, pa.array(kept, pa.binary())], [*names, "kept_bytes"]
            yield pa.RecordBatch.from_arrays(arrays, names)
    return run


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", with_text: bool = False,
                   hot: int = HOT) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept_bytes).

    Texts are UTF-8 bytes; a null text is empty.  A null id counts as larger than all others.
    Rows that repeat an id are judged against smaller ids only, each by its own text
    (told apart by a 64-bit hash of it).  Texts
    under 50 bytes lose nothing.  Cuts may fall inside a character, so what is left is bytes.
    """
    body = F.coalesce(column(docs, text).cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(column(docs, doc_id).cast("long"), F.lit(NO_ID)).alias("doc_id"),
                       F.xxhash64(body).alias("_key"), body.cast("binary").alias("text"))
    total = docs.agg(F.sum(F.octet_length(body))).first()[0] or 0
    # an anchor for about 14 bytes of text, 12 bytes each; its context, if it repeats, has about 63
    buckets = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(total // BUCKET_BYTES) + 1)
    dealt_rows = "bucket long, blob binary"
    found = materialize(rows.mapInArrow(_count_anchors(buckets), dealt_rows).repartition(buckets, "bucket")
                        .mapInArrow(_repeated_anchors(max(hot, min(total // HOT_ANCHORS, HOT_MOST)), buckets), dealt_rows), "anchors")
    # each has contexts at more than 1 / HOT_ANCHORS of all places, or HOT_MOST
    split = [np.frombuffer(r["blob"], "<u8") for r in found.filter("bucket = -1").select("blob").collect()]
    split = rows.sparkSession.sparkContext.broadcast(np.sort(np.concatenate([np.zeros(0, "<u8"), *split])))
    repeated = (found.filter("bucket >= 0").repartition(buckets, "bucket")
                .mapInArrow(_merge("hashes", "<u4", 1), "doc_id long, _key long, hashes binary"))
    dealt = rows.repartition("doc_id", "_key")  # used twice below: one exchange
    around = dealt.join(repeated, ["doc_id", "_key"]).mapInArrow(_contexts(buckets, split), dealt_rows)
    spans = (around.repartition(buckets, "bucket").mapInArrow(_spans(buckets), dealt_rows).repartition(buckets, "bucket")
             .mapInArrow(_merge("spans", "<i8", 2), "doc_id long, _key long, spans binary"))
    done = dealt.join(spans, ["doc_id", "_key"], "left").select("doc_id", "text", "spans")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    out = done.mapInArrow(_finish(with_text), schema + (", kept_bytes binary" if with_text else ""))
    return out.withColumn("doc_id", F.nullif(F.col("doc_id"), F.lit(NO_ID)))
