"""Text extraction by file type.

Routing, UTF-8 decoding, OCR block flattening and text resolution are native
expressions.  Only formats that need a parser run in Python: DOCX (stdlib zip +
XML, Arrow-batched) and the caller-supplied PDF/OCR extractor slots.
:func:`extract_documents` feeds each Python stage only the bytes of its own rows
(NULL for the others) from a single scan.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Sequence
from xml.etree import ElementTree

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.paths import path_suffix
from ..functions.text import py_strip
from ..session import ship_package
from ..schemas import EXTRACTION_FAILED_MARKER, IMAGE_SUFFIXES, TEXT_SUFFIXES, UNSUPPORTED_FORMAT

EXTRACTED = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("error", T.StringType()),
])

SLICE_BYTES = 4 << 20  # contents of a batch that are Python objects at once (one larger: alone)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def route_by_suffix(path) -> Column:
    """Extractor for a path by its lower-cased suffix."""
    suf = F.lower(path_suffix(_c(path)))
    return (F.when(suf == ".pdf", F.lit("pdf"))
            .when(suf.isin(TEXT_SUFFIXES), F.lit("text"))
            .when(suf == ".docx", F.lit("docx"))
            .when(suf.isin(IMAGE_SUFFIXES), F.lit("image"))
            .otherwise(F.lit("other")))


def decode_utf8(content) -> Column:
    """Strict UTF-8 decode with universal newlines; NULL when bytes are not UTF-8."""
    s = F.try_validate_utf8(_c(content).cast("string"))
    return F.regexp_replace(s, "\r\n?", "\n")


def _utf8_error(b) -> str | None:
    if b is None:
        return None
    try:
        bytes(b).decode("utf-8")
        return None
    except UnicodeDecodeError as e:
        return str(e)


@F.pandas_udf(T.StringType())
def _utf8_error_udf(content: pd.Series) -> pd.Series:
    return content.map(_utf8_error)


# only bytes that failed native decoding are sent (others pass NULL); never re-evaluated
utf8_error = _utf8_error_udf.asNondeterministic()


def decode_text(df: DataFrame, content_col: str = "content", path_col: str = "path") -> DataFrame:
    """Text and error for the plain-text branches (``text`` and ``other``).

    Decoding is native.  A ``.txt``/``.md`` file that is not UTF-8 gets Python's
    exact decode message (computed in Python for those rows only); any other
    suffix gets the unsupported-format message.
    """
    ship_package(df.sparkSession)
    text = decode_utf8(content_col)
    suffix = path_suffix(F.col(path_col))
    route = route_by_suffix(path_col)
    err = (F.when(text.isNull() & (route == "other"),
                  F.format_string(UNSUPPORTED_FORMAT.replace("{suffix}", "%s"), suffix))
           .when(text.isNull(), utf8_error(F.when(text.isNull() & (route == "text"), F.col(content_col)))))
    return df.withColumns({"text": text, "extraction_error": err})


def _docx_text(data: bytes) -> str:
    ns = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        root = ElementTree.fromstring(z.read("word/document.xml"))
    body = root.find(f"{ns}body")
    paras = []
    for p in (body if body is not None else []):
        if p.tag != f"{ns}p":
            continue
        parts = []
        for el in p.iter():
            if el.tag == f"{ns}t":
                parts.append(el.text or "")
            elif el.tag == f"{ns}tab":
                parts.append("\t")
            elif el.tag in (f"{ns}br", f"{ns}cr"):
                parts.append("\n")
        paras.append("".join(parts))
    return "\n".join(paras).strip()


def _safe(fn: Callable[[bytes], str]):
    def run(b):
        if b is None:
            return (None, "no content")
        try:
            return (fn(bytes(b)), None)
        except Exception as e:  # one bad file never fails the task
            return (None, f"{type(e).__name__}: {e}")
    return run


def by_slices(values: pa.Array, fn: Callable[[list], list], kind: pa.DataType) -> pa.Array:
    """``fn`` of a batch's values, slice by slice: the batch and its results are Arrow's, Python holds the objects of one slice."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    out, a = [pa.array([], kind)], 0
    while a < len(values):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + SLICE_BYTES, side="right")))
        out.append(pa.array(fn(values.slice(a, b - a).to_pylist()), kind))
        a = b
    return pa.concat_arrays(out)


@F.arrow_udf(EXTRACTED)
def _extract_docx(content: pa.Array) -> pa.Array:
    run = _safe(_docx_text)
    return by_slices(content, lambda some: [dict(zip(("text", "error"), run(b))) for b in some],
                     pa.struct([("text", pa.string()), ("error", pa.string())]))


# Python stages are marked non-deterministic so that a filter on their output is
# never evaluated with a second copy of the call (each file is parsed once; a paid
# extractor is never called twice for a row).
extract_docx = _extract_docx.asNondeterministic()
extract_docx.__doc__ = "Body paragraphs of a DOCX joined by newlines, trimmed (C3)."


def extractor_udf(fn: Callable[[bytes], str]):
    """Wrap a caller-supplied ``bytes -> str`` extractor (PDF/OCR slot, C4/C5)."""
    run = _safe(fn)

    @F.pandas_udf(EXTRACTED)
    def _extract(content: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([run(b) for b in content], columns=["text", "error"])

    return _extract.asNondeterministic()


CHAINED = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("extractor", T.StringType()),
    T.StructField("errors", T.ArrayType(T.StringType())),
])


def chain_udf(extractors: Sequence[Callable[[bytes], str]], names: Sequence[str] | None = None):
    """Arrow UDF trying ``extractors`` in order per row: (text, extractor, errors)."""
    names = list(names or [f"extractor_{i}" for i in range(len(extractors))])
    runners = [(_safe(fn), name) for fn, name in zip(extractors, names)]

    @F.pandas_udf(CHAINED)
    def _chain(content: pd.Series) -> pd.DataFrame:
        rows = []
        for b in content:
            if b is None:  # row routed elsewhere
                rows.append((None, None, []))
                continue
            errs = []
            got = (None, None)
            for run, name in runners:
                text, err = run(b)
                if err is None:
                    got = (text, name)
                    break
                errs.append(f"{name}: {err}")
            rows.append((got[0], got[1], errs))
        return pd.DataFrame(rows, columns=["text", "extractor", "errors"])

    return _chain.asNondeterministic()


def extract_with_fallback(df: DataFrame, extractors: Sequence[Callable[[bytes], str]],
                          content_col: str = "content", names: Sequence[str] | None = None) -> DataFrame:
    """Try extractors in order per row; the first success wins, every error is kept.

    One Arrow pass: an extractor is called at most once per row and a later one
    only when the earlier ones failed for that row (no re-evaluation across
    filter branches, so a paid service is never called twice).
    """
    ship_package(df.sparkSession)
    x = chain_udf(extractors, names)(F.col(content_col))
    return (df.withColumn("__x", x)
            .withColumns({"text": F.col("__x.text"), "extractor": F.col("__x.extractor"),
                          "extraction_errors": F.col("__x.errors")})
            .drop("__x"))


def ocr_chain(preference: str, remote: Callable[[bytes], str], local: Callable[[bytes], str]):
    """Ordered image extractors for an OCR preference.

    ``remote`` (also ``textract``) uses only the remote service, ``local`` only the
    local engine, ``auto`` the remote one first and the local one on any failure.
    """
    chains = {"remote": [remote], "textract": [remote], "local": [local], "auto": [remote, local]}
    if preference not in chains:
        raise ValueError(f"unknown OCR preference {preference!r}")
    return chains[preference]


def extract_documents(files: DataFrame, extractors: dict[str, Sequence[Callable[[bytes], str]]] | None = None,
                      path_col: str = "path", content_col: str = "content", keep_content: bool = False) -> DataFrame:
    """Text of every file by its type, in one scan.

    ``text``/``other`` files decode natively (strict UTF-8); DOCX goes through the
    stdlib reader; ``pdf`` and ``image`` use the caller's extractor slots, e.g.
    ``{"pdf": [pdf_fn], "image": [remote_ocr, local_ocr]}`` (tried in order).
    Each Python stage receives bytes only for its own rows (other rows pass
    NULL), so files are read once and nothing else crosses into Python.  Adds
    ``extractor``, ``text`` and ``extraction_error``; the raw bytes are dropped
    unless ``keep_content`` (they would otherwise follow the rows into the scorer).
    """
    ship_package(files.sparkSession)
    extractors = extractors or {}
    route = route_by_suffix(F.col(path_col))
    df = files.withColumn("extractor", route)
    r = F.col("extractor")
    content = F.col(content_col)
    decoded = decode_utf8(content)
    suffix = path_suffix(F.col(path_col))
    cols = {"__docx": extract_docx(F.when(r == "docx", content))}
    for kind in ("pdf", "image"):
        if extractors.get(kind):
            cols[f"__{kind}"] = chain_udf(extractors[kind], [f"{kind}_{i}" for i in
                                                             range(len(extractors[kind]))])(F.when(r == kind, content))
    df = df.withColumns(cols)

    def slot(kind, field):
        if f"__{kind}" not in cols:
            return F.lit(None).cast("string") if field == "text" else F.lit(f"no extractor configured for {kind}")
        x = F.col(f"__{kind}")
        return x.text if field == "text" else F.when(x.text.isNull(), F.array_join(x.errors, "; "))

    text = (F.when(r.isin("text", "other"), decoded)
            .when(r == "docx", F.col("__docx.text"))
            .when(r == "pdf", slot("pdf", "text"))
            .when(r == "image", slot("image", "text")))
    error = (F.when((r == "other") & decoded.isNull(),
                    F.format_string(UNSUPPORTED_FORMAT.replace("{suffix}", "%s"), suffix))
             .when((r == "text") & decoded.isNull(), utf8_error(F.when((r == "text") & decoded.isNull(), content)))
             .when(r == "docx", F.col("__docx.error"))
             .when(r == "pdf", slot("pdf", "error"))
             .when(r == "image", slot("image", "error")))
    out = df.withColumns({"text": text, "extraction_error": error}).drop(*cols.keys())
    return out if keep_content else out.drop(content_col)


def ocr_lines(blocks, trim: bool = False) -> Column:
    """LINE blocks' text joined by newlines, missing text as '' (C6)."""
    lines = F.filter(_c(blocks), lambda b: b["BlockType"] == "LINE")
    text = F.array_join(F.transform(lines, lambda b: F.coalesce(b["Text"], F.lit(""))), "\n")
    return py_strip(text) if trim else text


def ocr_pages(blocks) -> Column:
    """Pages of an OCR response: its PAGE blocks."""
    return F.size(F.filter(_c(blocks), lambda b: b["BlockType"] == "PAGE"))


def resolve_text(content, extracted=None) -> Column:
    """Document text: non-empty content wins, then extracted text, else '' (C7)."""
    parts = [F.nullif(_c(content), F.lit(""))]
    if extracted is not None:
        parts.append(_c(extracted))
    parts.append(F.lit(""))
    return F.coalesce(*parts)


def extraction_failed(reasoning, predicted_type) -> Column:
    """The reference's guess that extraction failed: marker in reasoning and type ``other``."""
    r = _c(reasoning)
    return F.coalesce(r.contains(EXTRACTION_FAILED_MARKER) & (_c(predicted_type) == "other"), F.lit(False))
