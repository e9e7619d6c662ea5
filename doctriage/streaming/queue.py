"""Queue-driven classification with Structured Streaming.

Messages carry a JSON ``body`` with ``document_uri`` and ``document_id``.  The
same batch functions run on the streaming DataFrame: recorded answers are a
stream-static left join, parsing is stateless.  No state, watermark or window is
needed (each message is independent).  ``maxFilesPerTrigger`` /
``maxOffsetsPerTrigger`` bound a micro-batch, which is the concurrency bound the
reference got from its fan-out step.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.score import classify
from ..sources.discover import load_documents

BAD_MESSAGE = "message is not a JSON object with document_uri and document_id"
MESSAGE_SCHEMA = "document_uri string, document_id string, document_content string"


def read_messages(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                  fmt: str = "json", options: dict | None = None) -> DataFrame:
    """Streaming messages with a ``body`` column (file source; Kafka by ``fmt='kafka'``)."""
    r = spark.readStream.format(fmt)
    if fmt == "json":
        r = r.schema("body string")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    df = r.load(path)
    if fmt == "kafka":
        df = df.select(F.col("value").cast("string").alias("body"))
    return df


def messages_to_requests(df: DataFrame) -> DataFrame:
    """Parse message bodies into requests keyed like batch requests.

    A body that is no message with a ``document_id`` and a ``document_uri`` gets ``message_error`` and, as its key,
    a hash of the body.
    """
    m = F.from_json(F.col("body"), MESSAGE_SCHEMA)
    uri = m.document_uri
    return df.select(
        m.document_id.alias("document_id"),
        uri.alias("source"),
        m.document_content.alias("document_content"),
        F.when(m.document_id.isNull() | uri.isNull(), F.concat(F.lit("bad-message:"), F.md5(F.coalesce("body", F.lit("")))))
         .when(uri.startswith("direct://"), F.concat(uri, F.lit("#"), m.document_id))
         .otherwise(uri).alias("request_key"),
        F.when(m.document_id.isNull() | uri.isNull(), F.lit(BAD_MESSAGE)).alias("message_error"),
    )


def load_requests(requests: DataFrame, location: Callable[[Column], Column] = lambda uri: uri,
                  extractors: dict | None = None) -> DataFrame:
    """Message requests with the text of the document that each names.

    A message with ``document_content``, or for in-line text, is left as it is; others are read from
    ``location(uri)`` in their task.  A document that cannot be read becomes that message's error.
    """
    uri = F.col("source")
    named = F.when(F.col("message_error").isNull() & (F.coalesce("document_content", F.lit("")) == "")
                   & ~uri.startswith("direct://"), location(uri))
    loaded = load_documents(requests, named, extractors)
    return loaded.withColumns({
        "document_content": F.coalesce(F.nullif("document_content", F.lit("")), "extracted"),
        "message_error": F.coalesce("message_error", "extraction_error"),
    }).drop("extracted", "extraction_error")


def classify_stream(messages: DataFrame, scorer: Callable[[DataFrame], DataFrame], model: str | None = None,
                    threshold: float = 0.7, load: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Per-message classification with per-message error isolation.

    ``load`` (``load_requests``, say) brings the texts of documents that messages only name.
    """
    requests = messages_to_requests(messages)
    return classify(load(requests) if load else requests, scorer, model=model, threshold=threshold,
                    error_col="message_error").drop("message_error")


def write_stream(df: DataFrame, path: str, checkpoint: str, available_now: bool = True):
    """Append results to a parquet table; ``availableNow`` drains what is queued and stops."""
    w = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w
    return w.outputMode("append").start()


def batch_counts_writer(path: str):
    """``foreachBatch`` function writing per-micro-batch counts.

    Each micro-batch is aggregated on the executors (one row out) and written to
    ``path/batch_id=N`` with dynamic partition overwrite, so a batch delivered
    again after a failure replaces its row instead of adding a second one.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.agg(F.count(F.lit(1)).alias("processed"),
                   F.count_if(F.col("status") == "success").alias("succeeded"))
         .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(path))
    return write


def results_and_counts_writer(results_path: str, counts_path: str):
    """``foreachBatch`` function storing each micro-batch's results and its counts.

    The micro-batch is classified once: its rows are written to
    ``results_path/batch_id=N`` (dynamic partition overwrite, so a batch delivered
    again after a failure replaces its own rows instead of duplicating them) and
    the counts are computed from those stored files, not by re-running the batch.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        (batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(results_path))
        # an empty micro-batch writes no folder: read the whole table's schema, then this batch
        stored = spark.read.schema(T.StructType([*batch.schema.fields, T.StructField("batch_id", T.LongType())])) \
            .parquet(results_path).where(F.col("batch_id") == batch_id)
        (stored.agg(F.count(F.lit(1)).alias("processed"),
                    F.count_if(F.col("status") == "success").alias("succeeded"))
         .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(counts_path))
    return write
