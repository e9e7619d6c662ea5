"""Result sinks (B1-B8): JSON lines, CSV summary, hour/day-partitioned records, retry lists.

Writes are distributed (one file per task); nothing is gathered into a single
array or file on the driver.  ``write_results(format="both")`` derives the CSV
from the JSON files it wrote, so its input is computed once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.confidence import confidence_level
from ..functions.results import iso_timestamp, utc_wall
from ..schemas import DEFAULT_THRESHOLD

SUMMARY_COLUMNS = ["document_id", "source", "status", "document_type", "confidence",
                   "confidence_level", "processing_time_ms", "timestamp"]


def summary_projection(df: DataFrame) -> DataFrame:
    """The 8 CSV summary columns; absent classification fields stay NULL (written as '') (B2)."""
    ok = F.col("status") == "success"
    return df.select(
        "document_id", "source", "status",
        F.when(ok, F.col("document_type")).alias("document_type"),
        F.when(ok, F.col("confidence")).alias("confidence"),
        F.when(ok, confidence_level("confidence")).alias("confidence_level"),
        "processing_time_ms",
        iso_timestamp("timestamp").alias("timestamp"),
    )


def write_results_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Detailed results as JSON lines."""
    df.write.mode(mode).json(path)


def write_summary_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV summary with header, '' for NULL (B2)."""
    (summary_projection(df).write.mode(mode)
     .option("header", "true").option("nullValue", "").option("emptyValue", "").option("escape", '"').csv(path))


def write_results(df: DataFrame, path: str, format: str = "json", mode: str = "overwrite") -> None:
    """Format choice ``json``/``csv``/``both``.

    With ``both`` the CSV is derived from the JSON files just written, not from
    ``df`` again, so an expensive input (a scorer) is computed once even if
    executors are lost in between (a cache would be lost with them).
    """
    if format not in ("json", "csv", "both"):
        raise ValueError(f"unknown format {format!r}")
    detailed = path.rstrip("/") + "/detailed"
    if format in ("json", "both"):
        write_results_json(df, detailed, mode)
    if format in ("csv", "both"):
        src = df.sparkSession.read.schema(df.schema).json(detailed) if format == "both" else df
        write_summary_csv(src, path.rstrip("/") + "/summary", mode)


def with_result_location(df: DataFrame, results_prefix: str, output_bucket: str,
                         ts: str = "timestamp", id_col: str = "document_id",
                         origin: str | None = None) -> DataFrame:
    """Output URIs of the per-document result and metadata records, plus time parts.

    With ``origin`` the stored object's tags become columns too: ``tag_document_id``,
    ``tag_classification_timestamp`` (when the record is written) and ``tag_source``.
    """
    if origin is not None:
        df = df.withColumns({"tag_document_id": F.col(id_col),
                             "tag_classification_timestamp": iso_timestamp(F.current_timestamp()),
                             "tag_source": F.lit(origin)})
    t = utc_wall(F.col(ts))
    hour_path = F.date_format(t, "yyyy/MM/dd/HH")
    day_path = F.date_format(t, "yyyy/MM/dd")
    base = f"s3://{output_bucket}/{results_prefix}"
    return df.withColumns({
        "result_uri": F.concat(F.lit(base + "classified/"), hour_path, F.lit("/"), F.col(id_col),
                               F.lit("/result.json")),
        "metadata_uri": F.concat(F.lit(base + "metadata/"), day_path, F.lit("/"), F.col(id_col),
                                 F.lit("/processing.json")),
        "year": F.date_format(t, "yyyy"),
        "month": F.date_format(t, "MM"),
        "day": F.date_format(t, "dd"),
        "hour": F.date_format(t, "HH"),
    })


def write_by_hour(df: DataFrame, path: str, ts: str = "timestamp", mode: str = "overwrite") -> None:
    """Per-document records partitioned year/month/day/hour.

    Four partition columns rather than one slash-containing value (which the
    writer would escape).  Rows are clustered with the ``rebalance`` hint on the
    partition columns: like a repartition, so each task writes few files, but AQE
    splits a hot hour (one hour may hold a third of all rows) over many tasks.
    """
    parts = ["year", "month", "day", "hour"]
    t = utc_wall(F.col(ts))
    d = df.withColumns({"year": F.date_format(t, "yyyy"), "month": F.date_format(t, "MM"),
                        "day": F.date_format(t, "dd"), "hour": F.date_format(t, "HH")})
    d.hint("rebalance", *parts).write.mode(mode).partitionBy(*parts).json(path)


def write_by_day(df: DataFrame, path: str, ts: str = "timestamp", mode: str = "overwrite") -> None:
    """Processing metadata partitioned year/month/day."""
    parts = ["year", "month", "day"]
    t = utc_wall(F.col(ts))
    d = df.withColumns({"year": F.date_format(t, "yyyy"), "month": F.date_format(t, "MM"),
                        "day": F.date_format(t, "dd")})
    d.hint("rebalance", *parts).write.mode(mode).partitionBy(*parts).json(path)


def write_report(report: DataFrame, results: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The batch report with its rows (B5): ``path``/summary has the report, ``path``/results one JSON line a result."""
    base = path.rstrip("/")
    report.coalesce(1).write.mode(mode).json(f"{base}/summary")  # one row
    write_results_json(results, f"{base}/results", mode)


def result_key(results_prefix: str = "") -> Column:
    """The key of a record's object."""
    hour = F.date_format(utc_wall(F.to_timestamp("timestamp")), "yyyy/MM/dd/HH")
    return F.concat(F.lit(results_prefix + "classified/"), hour, F.lit("/"), F.col("document_id"), F.lit("/result.json"))


def write_result_objects(records: DataFrame, root: str, results_prefix: str = "") -> DataFrame:
    """Each record as an object of its own, ``{results_prefix}classified/YYYY/MM/DD/HH/{document_id}/result.json`` below ``root``.

    Committed as a whole (``objects.write_objects``); returns key, bytes, crc32 of the objects.
    """
    from .objects import write_objects

    key = result_key(results_prefix)
    return write_objects(records.select(key.alias("key"), F.to_json(F.struct(*records.columns)).alias("content")), root)


def write_retry_list(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One URI or path per line (B6); input from :func:`reports.retry_list`."""
    df.select("value").write.mode(mode).text(path)


def metadata_rows(df: DataFrame, model: str, threshold: float = 0.7, keep: list[str] | None = None,
                  pages: str | None = None) -> DataFrame:
    """Processing metadata record per result (B4 content); ``keep`` carries extra input columns.

    ``pages`` is the column with the pages that OCR found (``extract.ocr_pages``), NULL where it did not run.
    """
    return df.select(
        "document_id",
        F.col("source").alias("source_uri"),
        iso_timestamp("timestamp").alias("processing_start"),
        F.col("processing_time_ms").alias("processing_duration_ms"),
        (F.col(pages) if pages else F.lit(None)).cast("int").alias("textract_pages"),
        F.lit(model).alias("bedrock_model"),
        F.lit(float(threshold)).alias("confidence_threshold"),
        F.when(F.col("status") == "success", F.lit("completed")).otherwise(F.col("status")).alias("status"),
        *(keep or []),
    )


def batch_records(df: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Batch result records: the flat classification only on successes (B1 content).

    ``needs_review`` follows ``threshold``; ``extraction_failed`` is carried where the rows have it.

    ``cli_exit_code`` is the accept code (0/1) on success, 2 on error, NULL on timeout.
    """
    from ..functions.confidence import accept_code, is_high_confidence, needs_review
    ok = F.col("status") == "success"
    flat = F.struct(
        F.col("document_id"),
        F.col("document_type"),
        F.col("confidence"),
        confidence_level("confidence").alias("confidence_level"),
        is_high_confidence("confidence").alias("high_confidence"),
        needs_review("confidence", F.lit(threshold)).alias("needs_review"),
        (F.col("reasoning") if "reasoning" in df.columns else F.lit(None).cast("string")).alias("reasoning"),
        F.col("processing_time_ms").cast("bigint").alias("processing_time_ms"),
        (F.col("extraction_failed") if "extraction_failed" in df.columns else F.lit(False)).alias("extraction_failed"),
    )
    code = (F.when(ok, accept_code("confidence")).when(F.col("status") == "error", F.lit(2))
            .cast("bigint"))
    return df.select(
        "document_id", "source", "status",
        F.when(ok, flat).alias("classification"),
        F.when(~ok, F.col("error")).alias("error"),
        F.col("processing_time_ms").cast("double").alias("processing_time_ms"),
        code.alias("cli_exit_code"),
        iso_timestamp("timestamp").alias("timestamp"),
    )


def write_json_arrays(df: DataFrame, path: str, per_file: int = 1000, mode: str = "overwrite") -> None:
    """Records as JSON array files of at most ``per_file`` records each (the reference's saved form).

    Arrays are formed inside each input partition (running position / ``per_file``), so none is
    larger than ``per_file`` and nothing is shuffled or passes through the driver; each is a row, and
    each row a file of one line.  Read back with ``read_results(..., multiline=True)``.
    """
    names = df.columns
    rows = df.select(F.to_json(F.struct(*names)).alias("j"))

    def arrays(batches):
        import pyarrow as pa

        held: list[str] = []
        for batch in batches:
            for j in batch.column(0).to_pylist():
                held.append(j)
                if len(held) == per_file:
                    yield pa.RecordBatch.from_arrays([pa.array(["[" + ",".join(held) + "]"])], ["value"])
                    held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(["[" + ",".join(held) + "]"])], ["value"])

    rows.mapInArrow(arrays, "value string").write.mode(mode).option("maxRecordsPerFile", "1").text(path)
