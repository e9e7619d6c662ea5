"""Sources and sinks through files written under the checkpoint folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import paths as P, text as TX
from ..operators import extract as X, reports as R
from ..session import scratch_dir
from ..sinks import writers as W
from ..sinks.objects import drop_objects, portions, spare_folders, stored_together, write_objects
from ..sources import discover as D
from ..sources.files import NOT_FOUND, fetch, list_files, plain, read_text_ranges, spread
from ..streaming.queue import load_requests, messages_to_requests
from . import fixtures as fx
from .registry import PROMPT_FRAME_SQL, PROMPT_TAIL_SQL, REQ, RES, register


# ===========================================================================
# Sources and sinks through files
# ===========================================================================

@register("file_list_csv", f"""
SELECT document_id, source_type, source,
  CASE WHEN source_type = 's3' THEN split_part(substring(source, 6), '/', 1) END AS bucket,
  CASE WHEN source_type = 's3' THEN lang || '/doc_' || CAST(doc_id AS VARCHAR) || '.' || ext END AS key,
  CASE WHEN source_type = 'local' THEN source END AS file_path FROM {REQ}""")
def q_file_list_csv(spark, d):
    path = scratch_dir(spark, "file-list-csv")
    u = P.parse_s3_uri("source")
    s3 = F.col("source_type") == "s3"
    (fx.requests_fx(spark, d).select(
        "document_id", "source_type", "source", F.when(s3, u.bucket).alias("bucket"),
        F.when(s3, u.key).alias("key"),
        F.when(F.col("source_type") == "local", F.col("source")).alias("file_path"))
     .write.option("header", "true").csv(path))
    return D.read_file_list_csv(spark, path).select("document_id", "source_type", "source", "bucket", "key",
                                                    "file_path")


@register("file_list_json", f"""
SELECT document_id, source_type, source, CAST(n_chars AS BIGINT) AS size,
  '{{"note":{{"ids":[' || CAST(doc_id AS VARCHAR) || '],"lang":"' || lang || '"}}}}' AS other_fields, md5(document_content) AS text_md5
FROM {REQ}""")
def q_file_list_json(spark, d):
    """All documents with their whole texts in array files, whose fields beyond the known ones are kept (A4)."""
    path = scratch_dir(spark, "file-list-json")
    note = F.struct("lang", F.array("doc_id").alias("ids"))
    rec = F.struct("document_id", "source_type", "source", F.col("n_chars").alias("size"), F.col("document_content").alias("text"), note.alias("note"))
    W.write_json_arrays(fx.requests_fx(spark, d).select(rec.alias("r")).select("r.*"), path)
    back = D.read_file_list_json(spark, path)
    return back.select("document_id", "source_type", "source", "size", "other_fields", F.md5("text").alias("text_md5"))


@register("file_list_text", f"""
SELECT document_id, source, source_type,
  CASE WHEN source_type = 's3' THEN split_part(substring(source, 6), '/', 1) END AS bucket,
  CASE WHEN source_type = 's3' THEN lang || '/doc_' || CAST(doc_id AS VARCHAR) || '.' || ext END AS key,
  CASE WHEN source_type = 'local' THEN source END AS file_path
FROM {REQ} WHERE source_type IN ('s3', 'local') AND NOT (source_type = 's3' AND doc_id % 17 = 0)""")
def q_file_list_text(spark, d):
    path = scratch_dir(spark, "file-list-text")
    t = F.col("source_type")
    line = (F.when((t == "s3") & (F.col("doc_id") % 17 == 0), F.lit("s3://onlybucket"))
            .when(t == "s3", F.col("source"))
            .when(t == "local", F.concat(F.lit("  "), F.col("source"), F.lit(" \t")))
            .when(F.col("doc_id") % 2 == 0, F.concat(F.lit("# skipped "), F.col("document_id")))
            .otherwise(F.lit("   ")))
    fx.requests_fx(spark, d).select(line.alias("value")).write.text(path)
    return D.read_file_list_text(spark, path).select("document_id", "source", "source_type", "bucket", "key",
                                                     "file_path")


@register("write_results_json", f"""
SELECT document_id, source, status, document_type, confidence,
  CAST(CASE WHEN status = 'success' AND confidence >= 0.7 THEN 0 WHEN status = 'success' THEN 1
       WHEN status = 'error' THEN 2 END AS BIGINT) AS cli_exit_code,
  CASE WHEN status <> 'success' THEN error END AS error FROM {RES}""")
def q_write_results_json(spark, d):
    path = scratch_dir(spark, "results-json")
    W.write_results_json(W.batch_records(fx.results_fx(spark, d)), path)
    back = D.read_results(spark, path)
    return back.select("document_id", "source", "status", F.col("classification.document_type").alias("document_type"),
                       F.col("classification.confidence").alias("confidence"), "cli_exit_code", "error")


@register("records_by_hour", f"""
SELECT strftime(timestamp, '%Y') AS year, strftime(timestamp, '%m') AS month, strftime(timestamp, '%d') AS day,
  strftime(timestamp, '%H') AS hour, CAST(count(*) AS BIGINT) AS n FROM {RES} GROUP BY 1, 2, 3, 4""")
def q_records_by_hour(spark, d):
    path = scratch_dir(spark, "records-by-hour")
    W.write_by_hour(W.batch_records(fx.results_fx(spark, d)).withColumn(
        "ts", F.to_timestamp("timestamp")), path, ts="ts")
    back = spark.read.schema("document_id string, year string, month string, day string, hour string").json(path)
    return back.groupBy("year", "month", "day", "hour").agg(F.count(F.lit(1)).alias("n"))


@register("retry_list_file", f"""
SELECT source AS value FROM {RES} WHERE status <> 'success'""")
def q_retry_list_file(spark, d):
    path = scratch_dir(spark, "retry-list")
    W.write_retry_list(R.retry_list(fx.results_fx(spark, d)), path)
    return spark.read.text(path)


# a name of its own for each document, some hidden; every 29th has a byte that is not UTF-8 at its end
FILE_KEY = ("'lang=' || lang || '/' || CAST(doc_id % 16 AS STRING) || '/' || CASE WHEN doc_id % 11 = 0 THEN '.' "
            "WHEN doc_id % 13 = 0 THEN '_' ELSE '' END || 'doc_' || CAST(doc_id AS STRING) || '.txt'")
FILES = f"(SELECT *, {FILE_KEY} AS key, doc_id % 29 = 0 AS bad, octet_length(encode(text)) AS n FROM documents)"
BAD_BYTE = "'''utf-8'' codec can''t decode byte 0xff in position ' || CAST(n AS VARCHAR) || ': invalid start byte'"
_OBJECTS: dict[tuple[str, str], str] = {}


def _documents_as_objects(spark, d) -> str:
    """A store with every document as an object of its own, written once a session."""
    at = (spark.sparkContext.applicationId, d)
    if at not in _OBJECTS:
        path = scratch_dir(spark, "documents-objects")
        content = F.concat(F.encode("text", "UTF-8"), F.when(F.col("doc_id") % 29 == 0, F.unhex(F.lit("FF"))).otherwise(F.unhex(F.lit(""))))
        write_objects(spark.read.parquet(f"{d}/documents.parquet").select(F.expr(FILE_KEY).alias("key"), content.alias("content")), path)
        _OBJECTS[at] = path
    return _OBJECTS[at]


def _key(path, root: str):
    return F.substring(path, len(plain(root)) + 2, 2**31 - 1)


@register("scan_directory", f"""
SELECT key, regexp_replace(split_part(key, '/', 3), '[.]txt$', '') AS document_id,
  CAST(n + CASE WHEN bad THEN 1 ELSE 0 END AS BIGINT) AS size FROM {FILES}""")
def q_scan_directory(spark, d):
    """Every document's file listed, hidden names and k=v folders too (A2)."""
    root = _documents_as_objects(spark, d)
    files = D.list_directory(spark, root, pattern="*doc_*.txt")
    return files.select(_key(F.col("file_path"), root).alias("key"), "document_id", "size")


@register("scan_store", f"""
SELECT 'docs' AS bucket, key, 's3://docs/' || key AS source,
  CAST(n + CASE WHEN bad THEN 1 ELSE 0 END AS BIGINT) AS size FROM {FILES} WHERE lang LIKE 'e%'""")
def q_scan_store(spark, d):
    """Object listing under a prefix with a suffix pattern; folders outside the prefix are not entered (A1)."""
    objs = D.list_store(spark, _documents_as_objects(spark, d), prefix="lang=e", pattern="*.txt", bucket="docs")
    return objs.select("bucket", "key", "source", "size")


@register("decode_text", f"""
SELECT key, CASE WHEN NOT bad THEN md5(text) END AS text_md5, CASE WHEN bad THEN {BAD_BYTE} END AS error FROM {FILES}""")
def q_decode_text(spark, d):
    """Strict UTF-8 decoding of every file's bytes."""
    root = _documents_as_objects(spark, d)
    out = X.decode_text(fetch(spread(list_files(spark, root), "path"), "path"))
    return out.select(_key(F.col("path"), root).alias("key"), F.md5("text").alias("text_md5"), F.col("extraction_error").alias("error"))


@register("text_ranges", f"""
SELECT key, CASE WHEN NOT bad THEN md5(text) END AS text_md5, CAST(CASE WHEN bad THEN n END AS BIGINT) AS bad_byte,
  CAST(greatest(1, ceil((n + CASE WHEN bad THEN 1 ELSE 0 END) / 1000.0)) AS BIGINT) AS pieces FROM {FILES}""")
def q_text_ranges(spark, d):
    """Files read as ranges of 1000 bytes, cut between characters, and joined again (C2 for files of any size)."""
    root = _documents_as_objects(spark, d)
    rows = read_text_ranges(list_files(spark, root), range_bytes=1000)
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece", "text"))), lambda x: x["text"]), "")
    return rows.groupBy(_key(F.col("path"), root).alias("key")).agg(
        F.when(F.count("reason") == 0, F.md5(whole)).alias("text_md5"), F.min("bad_byte").alias("bad_byte"), F.count("*").alias("pieces"))


RESULT_PORTION = 50_000  # result objects that are there at once, about


@register("result_objects", f"""
SELECT 'out/classified/' || strftime(timestamp, '%Y/%m/%d/%H') || '/' || document_id || '/result.json' AS key, document_id, status
FROM {RES}""")
def q_result_objects(spark, d):
    """One object for each result record, listed and read back.

    An object takes two blocks of a file system, 8 KB, for a record of 0.4 KB: a portion of the keys at a time is written,
    listed and read, and its objects go when its rows are stored.  Their folders serve the next portion's.
    """
    rec = F.from_json(F.col("content").cast("string"), "document_id string, status string")

    def read_back():
        for records in portions(W.batch_records(fx.results_fx(spark, d)), W.result_key("out/"), RESULT_PORTION):
            root = scratch_dir(spark, "result-objects")
            W.write_result_objects(records, root, "out/")
            files = list_files(spark, root)
            found = fetch(spread(files, "path"), "path")
            yield found.select(_key(F.col("path"), root).alias("key"), rec.document_id.alias("document_id"), rec.status.alias("status"))
            drop_objects(files, root)
    with spare_folders(spark):
        return stored_together(read_back(), "result-rows")


LISTED_BY = "CASE doc_id % 4 WHEN 0 THEN 'csv' WHEN 1 THEN 'json' WHEN 2 THEN 'text' ELSE 'message' END"


@register("load_by_uri", f"""
SELECT key AS document, {LISTED_BY} AS listed_by,
  CASE WHEN NOT bad THEN md5('{PROMPT_FRAME_SQL}' || text || '{PROMPT_TAIL_SQL}') END AS prompt_md5,
  CASE WHEN bad THEN {BAD_BYTE} END AS error FROM {FILES}
UNION ALL
SELECT key || '.gone', {LISTED_BY}, NULL, 'Document not found' FROM {FILES}""")
def q_load_by_uri(spark, d):
    """Documents that a CSV list, a JSON list, a text list or a message names, read by URI; beside each, one that is missing."""
    root = _documents_as_objects(spark, d)
    base = scratch_dir(spark, "lists")
    docs = spark.read.parquet(f"{d}/documents.parquet").select(F.expr(FILE_KEY).alias("key"), (F.col("doc_id") % 4).alias("how"))
    named = docs.union(docs.select(F.concat("key", F.lit(".gone")), "how")).withColumn("uri", F.concat(F.lit("s3://docs/"), F.col("key")))
    one = F.struct(F.col("uri").alias("source"), F.lit("s3").alias("source_type"), F.lit("docs").alias("bucket"), "key")
    named.where("how = 0").select(one.alias("x")).select("x.*").write.option("header", "true").csv(f"{base}/csv")
    named.where("how = 1").select(F.to_json(one).alias("value")).write.text(f"{base}/json")
    named.where("how = 2").select("uri").write.text(f"{base}/text")
    body = F.to_json(F.struct(F.col("uri").alias("document_uri"), F.col("key").alias("document_id")))
    named.where("how = 3").select(body.alias("body")).write.json(f"{base}/messages")
    as_lines = spark.read.schema("source string, source_type string, bucket string, key string").json(f"{base}/json")
    listed = (D.read_file_list_csv(spark, f"{base}/csv").withColumn("listed_by", F.lit("csv"))
              .unionByName(D.read_file_list_text(spark, f"{base}/text").withColumn("listed_by", F.lit("text")))
              .unionByName(D.conform(as_lines).withColumn("listed_by", F.lit("json"))))
    where = lambda uri: F.concat(F.lit(plain(root) + "/"), P.parse_s3_uri(uri).key)  # noqa: E731  the bucket's mirror
    loaded = D.load_documents(listed, where(F.col("source")))
    by_list = loaded.select("source", "listed_by", F.col("extracted").alias("text"), F.col("extraction_error").alias("error"))
    messages = messages_to_requests(spark.read.schema("body string").json(f"{base}/messages"))
    by_message = load_requests(messages, where).select("source", F.lit("message").alias("listed_by"),
                                                       F.col("document_content").alias("text"), F.col("message_error").alias("error"))
    found = by_list.unionByName(by_message)
    return found.select(F.substring("source", len("s3://docs/") + 1, 2**31 - 1).alias("document"), "listed_by",
                        F.when(F.col("error").isNull(), F.md5(TX.build_prompt(X.resolve_text(F.lit(""), F.col("text"))))).alias("prompt_md5"),
                        F.when(F.col("error").startswith(NOT_FOUND), F.lit(NOT_FOUND)).otherwise(F.col("error")).alias("error"))


@register("extract_docx", """
SELECT doc_id, CAST(length(trim(text, chr(32) || chr(9) || chr(10) || chr(13) || chr(11) || chr(12))) AS INTEGER)
  AS chars,
  CAST(NULL AS VARCHAR) AS error FROM documents""")
def q_extract_docx(spark, d):
    """DOCX built from each document's lines, then read back."""
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", fx.make_docx("text").alias("content"))
    x = docs.withColumn("__x", X.extract_docx("content"))
    return x.select("doc_id", F.length("__x.text").alias("chars"), F.col("__x.error").alias("error"))


@register("read_results", f"""
SELECT document_id, status, cli_exit_code FROM (
  SELECT document_id, status, CAST(CASE WHEN status = 'success' AND confidence >= 0.7 THEN 0
    WHEN status = 'success' THEN 1 WHEN status = 'error' THEN 2 END AS BIGINT) AS cli_exit_code FROM {RES})""")
def q_read_results(spark, d):
    """Result files holding one JSON array each (the reference's saved form), read back."""
    path = scratch_dir(spark, "results-arrays")
    W.write_json_arrays(W.batch_records(fx.results_fx(spark, d)), path, per_file=1000)
    back = D.read_results(spark, path, multiline=True)
    return back.select("document_id", "status", "cli_exit_code")


@register("extract_documents", f"""
SELECT key, 'text' AS extractor, CASE WHEN NOT bad THEN md5(text) END AS text_md5, CASE WHEN bad THEN {BAD_BYTE} END AS error FROM {FILES}""")
def q_extract_documents(spark, d):
    """Every document file routed by suffix and extracted in one pass."""
    root = _documents_as_objects(spark, d)
    out = X.extract_documents(fetch(spread(list_files(spark, root), "path"), "path"))
    return out.select(_key(F.col("path"), root).alias("key"), "extractor", F.md5("text").alias("text_md5"), F.col("extraction_error").alias("error"))
