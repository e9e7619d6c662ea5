"""JSON array files of any size, read by many tasks.

A file is cut into ranges of bytes.  Whether a range begins inside a string, after a backslash or
how deep in brackets cannot be seen from the range itself, so a first pass gives, for each of the
three ways a range may begin (outside a string, in one, after a backslash in one), how it ends and how the
depth changes.  Composing these from the file's start, over a table of one row a range, tells
each range how it begins.  A second pass cuts the records that start in a range, reading on past its
end for the last one.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize, ship_package
from .files import Opener, open_location, spread

RANGE_BYTES = 16 << 20
_AHEAD = 1 << 20
OUT, IN, ESCAPED = 0, 1, 2  # how a byte is met
BAD_RECORD = "not a JSON record"

_QUOTE, _SLASH = ord('"'), ord("\\")
_OPEN, _CLOSE = np.zeros(256, bool), np.zeros(256, bool)
_OPEN[[ord("["), ord("{")]] = True
_CLOSE[[ord("]"), ord("}")]] = True


def _lexed(data: np.ndarray, state: int) -> tuple[np.ndarray, int]:
    """(which bytes are outside strings, the quotes around them left out; the state after the last)."""
    n = len(data)
    if not n:
        return np.zeros(0, bool), state
    slash = data == _SLASH
    # a backslash escapes the next byte unless it is escaped itself: by its place in its run
    at = np.arange(n)
    run = at - np.maximum.accumulate(np.where(slash, -1, at))  # 1, 2, ... along a run, 0 elsewhere
    if state == ESCAPED:  # the first byte is escaped: a run that begins there counts from one less
        first = int(np.argmin(slash)) if not slash.all() else n
        run[:first] = at[:first]
    else:
        first = int(np.argmin(slash)) if not slash.all() else n
        run[:first] = at[:first] + 1
    escapes = slash & (run % 2 == 1)
    escaped = np.r_[state == ESCAPED, escapes[:-1]]
    quote = (data == _QUOTE) & ~escaped
    inside = (np.cumsum(quote) + (state != OUT)) % 2 == 1  # after the byte
    before = np.r_[state != OUT, inside[:-1]]
    end = int(inside[-1])
    if end == IN and escapes[-1]:
        end = ESCAPED
    return ~(inside | before), end


def summary(data: bytes, state: int) -> tuple[int, int]:
    """(state after ``data``, change of depth), beginning in ``state``."""
    a = np.frombuffer(data, np.uint8)
    out, end = _lexed(a, state)
    return end, int(_OPEN[a[out]].sum()) - int(_CLOSE[a[out]].sum())


def record_starts(data: bytes, state: int, depth: int, single: bool) -> tuple[list[int], list[int]]:
    """(starts, ends) of the records that begin in ``data``; an end of -1 is beyond it.

    Records are what lies between the commas of an array (depth 1), or a whole file (``single``).
    A start is the place after the bracket or comma; an end is that of the comma or bracket.
    """
    a = np.frombuffer(data, np.uint8)
    if single:
        return ([0] if depth == 0 else []), [-1]
    out, _ = _lexed(a, state)
    level = depth + np.cumsum(np.where(out, _OPEN[a].astype(np.int64) - _CLOSE[a], 0))  # after each byte
    start = out & (((a == ord("[")) & (level == 1) & _OPEN[a]) | ((a == ord(",")) & (level == 1)))
    stop = out & (((a == ord(",")) & (level == 1)) | ((a == ord("]")) & (level == 0)))
    starts, stops = np.flatnonzero(start) + 1, np.flatnonzero(stop)
    place = np.searchsorted(stops, starts)
    return starts.tolist(), [int(stops[p]) if p < len(stops) else -1 for p in place]


def _read(opener: Opener, path: str, start: int, size: int) -> bytes:
    fs, at = opener(path)
    with fs.open_input_file(at) as f:
        return f.read_at(size, start)


def _summaries(opener: Opener):
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                data = _read(opener, r["path"], r["start"], r["end"] - r["start"])
                ends = [summary(data, s) for s in (OUT, IN, ESCAPED)]
                head = data.lstrip(b" \t\r\n\xef\xbb\xbf")[:1] if r["piece"] == 0 else b""
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["path"]]), pa.array([r["piece"]], pa.int64()), pa.array([r["start"]], pa.int64()), pa.array([r["end"]], pa.int64()),
                     pa.array([[e for e, _ in ends]], pa.list_(pa.int32())), pa.array([[d for _, d in ends]], pa.list_(pa.int64())),
                     pa.array([bool(head) and head != b"["])],
                    ["path", "piece", "start", "end", "states", "depths", "single"])
    return run


def _record(raw: bytes) -> tuple[str | None, str | None]:
    """(the record's text, or why it is none)."""
    try:
        text = raw.decode("utf-8-sig").strip(" \t\r\n")
        json.loads(text)
        return text, None
    except (ValueError, RecursionError) as e:
        return None, f"{BAD_RECORD}: {e}"


def _records(opener: Opener):
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                data = _read(opener, r["path"], r["start"], r["end"] - r["start"])
                starts, ends = record_starts(data, r["state"], r["depth"], r["single"])
                texts, errors, places = [], [], []
                for a, b in zip(starts, ends):
                    raw = data[a:b] if b >= 0 else data[a:] + _rest(opener, r, a, data)
                    if not raw.strip(b" \t\r\n") and not r["single"] and (b < 0 or data[b:b + 1] == b"]") and data[a - 1:a] == b"[":
                        continue  # an empty array
                    text, error = _record(raw)
                    texts.append(text)
                    errors.append(error)
                    places.append(r["start"] + a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["path"]] * len(texts), pa.string()), pa.array(places, pa.int64()), pa.array(texts, pa.string()),
                     pa.array(errors, pa.string())], ["path", "place", "record", "error"])
    return run


def _rest(opener: Opener, r: dict, start: int, data: bytes) -> bytes:
    """What a record that begins at data[start:] has beyond the range."""
    if r["single"]:
        return _read(opener, r["path"], r["end"], r["length"] - r["end"])
    tail = np.frombuffer(data[start:], np.uint8)
    out, state = _lexed(tail, OUT)
    depth = 1 + int(_OPEN[tail[out]].sum()) - int(_CLOSE[tail[out]].sum())
    parts, at = [], r["end"]
    while at < r["length"]:
        more = _read(opener, r["path"], at, _AHEAD)
        a = np.frombuffer(more, np.uint8)
        out, after = _lexed(a, state)
        level = depth + np.cumsum(np.where(out, _OPEN[a].astype(np.int64) - _CLOSE[a], 0))
        stop = np.flatnonzero(out & (((a == ord(",")) & (level == 1)) | (level == 0)))
        if len(stop):
            parts.append(more[:stop[0]])
            break
        parts.append(more)
        state, depth, at = after, int(level[-1]), at + len(more)
    return b"".join(parts)


def read_json_arrays(files: DataFrame, range_bytes: int = RANGE_BYTES, opener: Opener = open_location) -> DataFrame:
    """path, place, record, error: a row for each element of the array files, or for each file that is one value.

    ``files`` has path and length (``files.list_files``).  ``record`` is the element's JSON text
    (``F.parse_json`` makes it a VARIANT), ``place`` its byte in the file.  What lies between two commas and is no
    JSON is a row with an error; the records beside it are not touched.  Empty files give no rows.
    """
    ship_package(files.sparkSession)
    last = F.floor((F.col("length") - 1) / F.lit(range_bytes)).cast("long")
    ranges = files.where("length > 0").select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece"))
    start = F.col("piece") * F.lit(range_bytes)
    ranges = ranges.select("path", "piece", start.alias("start"), F.least("length", start + F.lit(range_bytes)).alias("end"))
    known = materialize(spread(ranges, "path", "piece").mapInArrow(
        _summaries(opener), "path string, piece long, start long, end long, states array<int>, depths array<long>, single boolean"), "ranges")
    # a row a range: the ranges of a file in one task are few whatever its size
    before = Window.partitionBy("path").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    steps = F.collect_list(F.struct("states", "depths")).over(before)
    begin = F.aggregate(steps, F.struct(F.lit(OUT).alias("state"), F.lit(0).cast("long").alias("depth")),
                        lambda a, x: F.struct(F.element_at(x["states"], a["state"] + 1).alias("state"),
                                              (a["depth"] + F.element_at(x["depths"], a["state"] + 1)).alias("depth")))
    whole = Window.partitionBy("path")
    placed = known.select("path", "piece", "start", "end", begin.alias("b"), F.max("single").over(whole).alias("single"),
                          F.max("end").over(whole).alias("length"))
    placed = placed.select("path", "start", "end", "length", F.col("b.state").alias("state"), F.col("b.depth").alias("depth"), "single")
    placed = placed.where(~F.col("single") | (F.col("start") == 0))  # one value is read by one task
    return spread(placed, "path", "start").mapInArrow(_records(opener), "path string, place long, record string, error string")
