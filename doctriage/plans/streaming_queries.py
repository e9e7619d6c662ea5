"""Queue messages with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.score import recorded_scorer
from ..session import scratch_dir
from . import fixtures as fx
from .registry import EXPECTED, MODEL_ID, PROMPT_MD5_SQL, register


# ===========================================================================
# Streaming
# ===========================================================================

_MESSAGES: dict[tuple[str, str], str] = {}


def _messages(spark, d) -> tuple[str, int]:
    """The folder of all messages, written once a session, and its number of files."""
    at = (spark.sparkContext.applicationId, d)
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if at not in _MESSAGES:
        path = scratch_dir(spark, "messages")
        body = F.to_json(F.struct(F.col("source").alias("document_uri"), "document_id", "document_content"))
        fx.requests_fx(spark, d).select(body.alias("body")).repartition(files).write.json(path)
        _MESSAGES[at] = path
    return _MESSAGES[at], files


@register("stream_classify", f"""
SELECT request_key, document_id, exp_status AS status, exp_stage AS stage, exp_type AS predicted_type,
       exp_score AS primary_score, {PROMPT_MD5_SQL} AS prompt_md5 FROM {EXPECTED}""")
def q_stream_classify(spark, d):
    from ..streaming.queue import classify_stream, read_messages, write_stream
    src, _ = _messages(spark, d)
    out, ckpt = scratch_dir(spark, "stream-out"), scratch_dir(spark, "stream-ckpt")
    msgs = read_messages(spark, src)  # drains the queue in one micro-batch; J3 bounds are shown by stream_batch_counts
    scorer = fx.recorded(spark, d)  # stored once, scanned per batch
    q = write_stream(classify_stream(msgs, scorer, model=MODEL_ID)
                     .drop("timestamp"), out, ckpt)
    q.awaitTermination()
    return spark.read.parquet(out).select("request_key", "document_id", "status", "stage", "predicted_type",
                                          "primary_score", "prompt_md5")


@register("stream_batch_counts", f"""
SELECT CAST(count(*) AS BIGINT) AS processed, CAST(count_if(exp_status = 'success') AS BIGINT) AS succeeded,
  TRUE AS several_batches FROM {EXPECTED}""")
def q_stream_batch_counts(spark, d):
    from ..streaming.queue import classify_stream, read_messages, results_and_counts_writer
    src, files = _messages(spark, d)
    rows, out = scratch_dir(spark, "stream-rows"), scratch_dir(spark, "stream-counts")
    ckpt = scratch_dir(spark, "stream-counts-ckpt")
    msgs = read_messages(spark, src, max_files_per_trigger=-(-files // 4))  # bounded micro-batches (J3)
    res = classify_stream(msgs, fx.recorded(spark, d), model=MODEL_ID)
    q = (res.writeStream.foreachBatch(results_and_counts_writer(rows, out)).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    per_batch = spark.read.parquet(out)
    return per_batch.agg(F.sum("processed").alias("processed"), F.sum("succeeded").alias("succeeded"),
                         (F.countDistinct("batch_id") > 1).alias("several_batches"))
