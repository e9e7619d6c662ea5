"""Document discovery: store/directory listings, file lists and loading by path or URI.

Listings go folder by folder in tasks (``files.list_files``); contents are read in tasks too,
row by row, whether the documents come from a listing, a file list or messages (``load_documents``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import file_name, glob_to_regex, key_pattern_match, name_glob_match, parse_s3_uri, path_stem, prefix_match
from ..schemas import BATCH_RESULT_SCHEMA, DOCUMENT_SCHEMA
from .files import LIMIT_BYTES, TOO_LARGE, fetch, list_files, plain, spread
from .json_arrays import read_json_arrays

DOCUMENT_COLUMNS = [f.name for f in DOCUMENT_SCHEMA.fields]


def _listed(files: DataFrame, max_size_bytes: int | None, extract: bool, extractors: dict | None) -> DataFrame:
    """``files`` with extraction_error of those over the limit, and with ``extract`` their texts as ``extracted``."""
    if not extract:
        return files if not max_size_bytes else files.withColumn("extraction_error", F.when(
            F.col("length") > max_size_bytes,
            F.format_string(TOO_LARGE + ": %d bytes, limit %d", "length", F.lit(max_size_bytes))))
    return load_documents(files, "path", extractors, max_size_bytes or LIMIT_BYTES)


def load_documents(docs: DataFrame, location: str | Column = "source", extractors: dict | None = None,
                   max_size_bytes: int = LIMIT_BYTES) -> DataFrame:
    """``docs`` with ``extracted`` and ``extraction_error``: the text of the file that each row names.

    ``location`` is where the file is: a column, or an expression over the columns (a bucket's
    mirror, say).  A null location is not read and has neither text nor error (in-line text).
    A missing, unreadable or too large file, and one whose format gives no text, has an error.
    """
    from ..operators.extract import extract_documents

    where = F.col(location) if isinstance(location, str) else location
    # the row itself in one column, so that no name of its meets those of the stages below
    named = docs.select(F.struct("*").alias("__doc"), where.alias("path"))
    # a large folder is one partition of its listing: its files are read by many tasks
    texts = extract_documents(fetch(spread(named, "path"), "path", max_size_bytes), extractors)
    # a file that was not read has its own reason, not that of an extractor without content
    error = F.when(F.col("path").isNotNull(), F.coalesce("fetch_error", "extraction_error"))
    return texts.select("__doc.*", F.col("text").alias("extracted"), error.alias("extraction_error"))


def conform(df: DataFrame) -> DataFrame:
    """Project onto the common document schema, adding absent columns as NULL."""
    cols = []
    for f in DOCUMENT_SCHEMA.fields:
        cols.append(F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns
                    else F.lit(None).cast(f.dataType).alias(f.name))
    extra = [c for c in df.columns if c not in DOCUMENT_COLUMNS]
    return df.select(*cols, *extra)


def list_store(spark: SparkSession, root: str, prefix: str = "", pattern: str = "*",
               bucket: str | None = None, max_size_bytes: int | None = None,
               extract: bool = False, extractors: dict | None = None) -> DataFrame:
    """Objects of a bucket as documents (A1).

    ``root`` is the bucket's location (``s3://bucket`` on a cluster, any folder in
    tests); ``bucket`` defaults to its last path component.  Only folders that
    may hold keys with ``prefix`` are listed.
    ``pattern`` follows the object-store rule: stars removed, suffix match on the
    whole key.  Keys ending in ``/`` are folders and never listed.  With
    ``extract`` each object is also read, and its text extracted (``extracted``,
    ``extraction_error``; see ``load_documents``), ready for ``run_batch``.
    Objects over ``max_size_bytes`` are never read; they are listed with that as
    their ``extraction_error``, and ``run_batch`` makes them error rows.
    """
    base = plain(root)
    name = bucket or base.rsplit("/", 1)[-1]

    def key_of(path: Column) -> Column:  # the path below the bucket's root
        return F.substring(path, len(base) + 2, 2**31 - 1)

    def enter(folder: Column) -> Column:
        key = F.concat(key_of(folder), F.lit("/"))
        return key.startswith(prefix) | F.lit(prefix).startswith(key)

    files = list_files(spark, base, enter=enter if prefix else None)
    wanted = files.where(prefix_match(key_of(F.col("path")), prefix) & key_pattern_match(key_of(F.col("path")), pattern))
    df = _listed(wanted, max_size_bytes, extract, extractors).withColumn("key", key_of(F.col("path")))
    return conform(df.select(
        path_stem(F.col("key")).alias("document_id"),
        F.concat(F.lit(f"s3://{name}/"), F.col("key")).alias("source"),
        F.lit("s3").alias("source_type"),
        F.lit(name).alias("bucket"),
        F.col("key"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("last_modified"),
        *_extracted(df),
    ))


def _extracted(df: DataFrame):
    return [F.col(c) for c in ("extracted", "extraction_error") if c in df.columns]


def list_directory(spark: SparkSession, directory: str, pattern: str = "*", recursive: bool = True,
                   max_size_bytes: int | None = None, extract: bool = False,
                   extractors: dict | None = None) -> DataFrame:
    """Regular files under ``directory`` as documents; ``pattern`` is a name glob (A2).

    ``extract`` and ``max_size_bytes`` as in :func:`list_store`.
    """
    files = list_files(spark, directory, recursive).where(name_glob_match("path", pattern))
    df = _listed(files, max_size_bytes, extract, extractors)
    return conform(df.select(
        path_stem(F.col("path")).alias("document_id"),
        F.col("path").alias("source"),
        F.lit("local").alias("source_type"),
        F.col("path").alias("file_path"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("last_modified"),
        *_extracted(df),
    ))


def read_file_list_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV file list with header; each row is a document as is, all values text (A3).

    Quotes are doubled inside a quoted field, which may hold commas and line breaks.
    """
    return conform(spark.read.option("header", "true").option("inferSchema", "false")
                   .option("quote", '"').option("escape", '"').option("multiLine", "true").csv(path))


def _files_of(spark: SparkSession, path: str) -> DataFrame:
    """The file, the files below the folder, or those that a glob names, with their lengths; names that Spark's writers hide are left out."""
    parts = plain(path).split("/")
    globbed = [i for i, x in enumerate(parts) if any(c in x for c in "*?[")]
    if globbed:  # stars stay within a name
        pattern = glob_to_regex(plain(path)).replace("[\\s\\S]", "[^/]")
        found = list_files(spark, "/".join(parts[:globbed[0]]) or "/", recursive=globbed[0] < len(parts) - 1)
        return found.where(F.col("path").rlike(pattern) & ~file_name("path").rlike("^[._]"))
    if path.rsplit("/", 1)[-1].count("."):
        folder, name = plain(path).rsplit("/", 1)
        one = list_files(spark, folder or "/", recursive=False).where(file_name("path") == name)
        if one.limit(1).count():
            return one
    return list_files(spark, path).where(~file_name("path").rlike("^[._]"))


def read_file_list_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON file list: each file holds an array of document objects or one object (A4).

    A large array is read by many tasks (``json_arrays``).  Fields beyond the document's are kept as a
    JSON object in ``other_fields`` (NULL where there are none).  What is no JSON is a row with
    ``list_error``; ``run_batch`` makes it an error row.
    """
    fields = [f for f in DOCUMENT_SCHEMA.fields if f.name != "last_modified"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields) + ", last_modified string"
    rows = read_json_arrays(_files_of(spark, path))
    known = F.from_json("record", schema)
    every = F.from_json("record", "map<string, variant>")
    rest = F.map_filter(every, lambda k, v: ~k.isin(DOCUMENT_COLUMNS))
    df = rows.select(known.alias("d"), F.when(F.size(rest) > 0, F.to_json(rest)).alias("other_fields"), F.col("error").alias("list_error"))
    df = df.select("d.*", "other_fields", "list_error")
    return conform(df.withColumn("last_modified", F.try_to_timestamp("last_modified")))


def parse_file_list_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Plain-text list lines to documents (A5, H1).

    Lines are trimmed; blank and ``#`` lines are dropped; ``s3://`` lines are split
    into bucket/key (dropped when there is no ``/`` after the bucket); any other
    line is a local path.  The two kinds are one bag (duplicates kept).
    """
    from ..functions.text import py_strip
    line = py_strip(F.col(col))
    df = lines.select(line.alias("line")).where((F.col("line") != "") & ~F.col("line").startswith("#"))
    is_s3 = F.col("line").startswith("s3://")
    parsed = parse_s3_uri(F.col("line"))
    s3 = (df.where(is_s3).where(parsed.error.isNull())
          .select(path_stem(parsed.key).alias("document_id"), F.col("line").alias("source"),
                  F.lit("s3").alias("source_type"), parsed.bucket.alias("bucket"), parsed.key.alias("key")))
    local = (df.where(~is_s3)
             .select(path_stem(F.col("line")).alias("document_id"), F.col("line").alias("source"),
                     F.lit("local").alias("source_type"), F.col("line").alias("file_path")))
    return conform(s3.unionByName(local, allowMissingColumns=True))


def read_file_list_text(spark: SparkSession, path: str) -> DataFrame:
    return parse_file_list_lines(spark.read.text(path))


def read_file_list(spark: SparkSession, path: str) -> DataFrame:
    """Dispatch by the list's suffix: ``.csv``, ``.json``, else plain text (A3-A5)."""
    if path.endswith(".csv"):
        return read_file_list_csv(spark, path)
    if path.endswith(".json"):
        return read_file_list_json(spark, path)
    return read_file_list_text(spark, path)


def read_results(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Batch result records written earlier: JSON lines, or JSON array files of any size."""
    if multiline:
        rows = read_json_arrays(_files_of(spark, path))
        return rows.select(F.from_json("record", BATCH_RESULT_SCHEMA).alias("r")).select("r.*")
    return spark.read.schema(BATCH_RESULT_SCHEMA).json(path)


RECORD_COLUMNS = ("document_id string, source string, status string, error string, processing_time_ms double, "
                  "cli_exit_code bigint, timestamp string")


def read_partitioned_records(spark: SparkSession, path: str, year: str | None = None, month: str | None = None,
                             day: str | None = None, hour: str | None = None) -> DataFrame:
    """Records written by hour/day (B3/B4) read back; the time filters prune partitions.

    Partition columns keep their zero-padded text form (``"01"``), so the schema
    is given rather than inferred.
    """
    parts = [("year", year), ("month", month), ("day", day), ("hour", hour)]
    schema = RECORD_COLUMNS + "".join(f", {p} string" for p, _ in parts)
    df = spark.read.schema(schema).option("basePath", path).json(path)
    for p, v in parts:
        if v is not None:
            df = df.where(F.col(p) == v)
    return df
