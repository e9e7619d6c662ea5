"""The batch entry as DataFrame operations: discover -> limit -> options -> classify -> save -> report.

Mirrors the reference's batch command: documents from a listing or file list,
an optional document limit, run options on every row, one result per document
(status success/error/timeout), result files, a summary and an exit code.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.paths import path_stem
from ..operators import reports as R
from ..operators.catalog import model_id_for
from ..operators.extract import extraction_failed
from ..operators.requests import dispatch_sources, with_run_options
from ..operators.score import classify
from ..session import materialize
from ..sinks import writers as W
from ..sources.files import TOO_LARGE


def documents_to_requests(docs: DataFrame, extracted_col: str | None = None,
                          extraction_error_col: str | None = None) -> DataFrame:
    """Discovered documents (common document schema) as classification requests.

    ``text`` rows carry their text; other rows take ``extracted_col`` when the
    caller extracted them (:func:`~doctriage.operators.extract.extract_documents`),
    else they go to the scorer with empty text, as the reference does when its
    extraction fails.  A row of an unknown kind, and a file over the listing's size
    limit, is an error row that is never scored.  ``request_key`` is the source, or ``source#document_id`` for
    in-line text (the stem alone is not unique).
    """
    kind = F.col("source_type")
    doc_id = F.coalesce(F.col("document_id"), path_stem(F.col("source")))
    content = F.when(kind == "text", F.col("text"))
    if extracted_col:
        content = content.otherwise(F.col(extracted_col))
    # a local file that cannot be read fails its row (object-store text failures
    # fall back to empty text instead, as the reference does)
    failed = F.lit(None).cast("string")
    if extraction_error_col:
        e = F.col(extraction_error_col)
        failed = F.when((kind == "local") | e.startswith(TOO_LARGE), e)
    listed = F.col("list_error") if "list_error" in docs.columns else F.lit(None).cast("string")
    pre_error = F.coalesce(listed, F.col("dispatch_error"), failed)
    return dispatch_sources(docs, "source_type").withColumns({
        "document_id": doc_id,
        "document_content": content,
        "request_key": F.when(kind == "text", F.concat(F.col("source"), F.lit("#"), doc_id))
                        .otherwise(F.col("source")),
        "pre_error": pre_error,
    }).drop("route", "dispatch_error")


def run_batch(docs: DataFrame, scorer: Callable[[DataFrame], DataFrame], model: str,
              max_docs: int | None = None, options: dict | None = None, output_dir: str | None = None,
              fmt: str = "json", extracted_col: str | None = None, threshold: float = 0.7,
              extraction_error_col: str | None = None):
    """Classify a discovered batch; return ``(records, summary, exit_code_df)``.

    The classified rows are materialized once under the checkpoint folder: the
    scorer runs exactly once per document, and the sinks (``output_dir``: JSON
    lines and/or the CSV summary) and the reports read the stored rows.  A lost
    executor later recomputes from those files, never by calling the scorer again.
    """
    req = documents_to_requests(docs, extracted_col, extraction_error_col)
    if max_docs:
        req = R.max_docs(req, max_docs, order=["source", "request_key"])
    req = with_run_options(req, **(options or {}))
    res = classify(req, scorer, model=model_id_for(model), threshold=threshold, error_col="pre_error",
                   extracted_col=extracted_col, drop_cols=["text"])
    records_in = res.select(
        "document_id", "source", "status",
        F.col("predicted_type").alias("document_type"), F.col("primary_score").alias("confidence"),
        "reasoning", F.col("error"), "processing_time_ms", "timestamp",
        extraction_failed("reasoning", "predicted_type").alias("extraction_failed"))
    stored = materialize(records_in, "batch-results")   # the only run of the scorer
    if output_dir:
        W.write_results(stored, output_dir, format=fmt)
    records = W.batch_records(stored, threshold)
    flat = records.select("status", F.col("classification.document_type").alias("document_type"),
                          F.col("classification.confidence").alias("confidence"), "processing_time_ms")
    return records, R.batch_summary(flat), R.batch_outcome(flat)
