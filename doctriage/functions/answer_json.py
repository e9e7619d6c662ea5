"""Find the JSON answer inside a scorer's free text and read its fields.

Native JSON functions cannot be used: they accept trailing text, reject NaN and
duplicate keys, and never see fenced blocks.  This is an Arrow ``pandas_udf``
(one Python call per batch, not per row).  The returned struct is interpreted by
native expressions in :mod:`doctriage.operators.parse`.

Outcome classes (``kind``):

* ``ok``    - an object was found; ``predicted_type`` and ``score`` are read.
* ``parse`` - no JSON found, or a score string that is not a number.  These
  become parse fallback rows.
* ``batch`` - JSON that is not an object, a type that is not a string, a score
  of the wrong kind.  These escape the single-document parser and become
  batch fallback rows; ``error`` holds Python's message.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import NO_JSON_MESSAGE

# The two fenced-block patterns, tried in this order, first match each.
FENCED_PATTERNS = [
    r"```json\s*(\{.*?\})\s*```",
    r"```\s*(\{.*?\})\s*```",
]

_FENCED = [re.compile(p, re.DOTALL) for p in FENCED_PATTERNS]
_BRACE = re.compile(r"[{}]")

ANSWER_TYPE = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("predicted_type", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("reasoning", T.StringType()),
    T.StructField("extracted_features", T.StringType()),
    T.StructField("error", T.StringType()),
])


class _NoJson(Exception):
    pass


def balanced_spans(text: str, max_depth: int | None = None) -> list[str]:
    """Non-overlapping brace-balanced spans, of nesting depth <= ``max_depth`` where it is given.

    Scans left to right; a ``{`` whose balanced span is deeper than allowed (or
    never closes) is skipped and the scan resumes at the next character.  After a
    span is taken, scanning resumes after its closing brace.  Braces inside JSON
    strings count as braces.  Linear time: partners and depths come from one
    stack pass.
    """
    partner: dict[int, int] = {}
    depth: dict[int, int] = {}
    stack: list[list[int]] = []  # [open_pos, deepest child depth]
    for m in _BRACE.finditer(text):
        pos = m.start()
        if text[pos] == "{":
            stack.append([pos, 0])
        elif stack:
            open_pos, child = stack.pop()
            partner[open_pos] = pos
            depth[open_pos] = child + 1
            if stack and stack[-1][1] < child + 1:
                stack[-1][1] = child + 1
    spans = []
    resume = 0
    for open_pos in sorted(partner.keys() | {p for p, _ in stack}):
        if open_pos < resume:
            continue
        close = partner.get(open_pos)
        if close is not None and (max_depth is None or depth[open_pos] <= max_depth):
            spans.append(text[open_pos:close + 1])
            resume = close + 1
    return spans


def _line_blocks(text: str):
    """Candidate blocks from line accumulation.

    Accumulation starts at a line whose stripped form starts with ``{``; each later
    line is added and, when it ends with ``}`` (and does not itself start with
    ``{``), the block so far is offered.  A failed block restarts the search.
    """
    block: list[str] | None = None
    for line in text.split("\n"):
        s = line.strip()
        if s.startswith("{"):
            if block is None:
                block = []
            block.append(line)
        elif block is not None:
            block.append(line)
            if s.endswith("}"):
                yield "\n".join(block)
                block = None


def find_json(text: str):
    """Return the first JSON value found by the ladder; raise _NoJson if none."""
    try:
        return json.loads(text.strip())
    except json.JSONDecodeError:
        pass
    for rx in _FENCED:
        m = rx.search(text)
        if m:
            try:
                return json.loads(m.group(1))
            except json.JSONDecodeError:
                pass
    for span in balanced_spans(text):
        try:
            return json.loads(span)
        except json.JSONDecodeError:
            pass
    for block in _line_blocks(text):
        try:
            return json.loads(block)
        except json.JSONDecodeError:
            pass
    raise _NoJson(NO_JSON_MESSAGE)


def _as_text(v):
    if v is None or isinstance(v, str):
        return v
    return json.dumps(v)


def _clean(v):
    """Text without lone surrogates, which Arrow cannot carry."""
    return v.encode("utf-8", "replace").decode("utf-8") if isinstance(v, str) else v


def describe_answer(text) -> tuple:
    """(kind, predicted_type, score, reasoning, extracted_features, error) for one answer."""
    if text is None:
        return ("batch", None, None, None, None, "'NoneType' object has no attribute 'strip'")
    try:
        value = find_json(text)
    except _NoJson as e:
        return ("parse", None, None, None, None, str(e))
    except ValueError as e:  # e.g. a number of too many digits
        return ("parse", None, None, None, None, str(e))
    except Exception as e:  # e.g. RecursionError on absurd nesting
        return ("batch", None, None, None, None, str(e))
    try:
        raw_type = value.get("predicted_type", "unknown")
        raw_type.lower()
    except Exception as e:
        return ("batch", None, None, None, None, str(e))
    try:
        score = float(value.get("confidence_score", 0.0))
    except ValueError as e:
        return ("parse", raw_type, None, None, None, str(e))
    except Exception as e:
        return ("batch", raw_type, None, None, None, str(e))
    features = value.get("extracted_features", {})
    return ("ok", raw_type, score, _as_text(value.get("reasoning")),
            None if features is None else json.dumps(features), None)


@F.pandas_udf(ANSWER_TYPE)
def _extract_answer(texts: pd.Series) -> pd.DataFrame:
    rows = [tuple(map(_clean, describe_answer(t))) for t in texts]
    return pd.DataFrame(rows, columns=[f.name for f in ANSWER_TYPE.fields])


# Marked non-deterministic so the optimizer never copies the call into a pushed-down
# filter: each answer is parsed exactly once per row, whatever filters follow.
extract_answer = _extract_answer.asNondeterministic()
