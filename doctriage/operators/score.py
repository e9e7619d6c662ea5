"""Scoring and batch classification (K1-K7).

A *scorer* is a function ``DataFrame -> DataFrame`` that receives rows with a
``prompt`` column and adds ``response_text`` plus the call outcome
(``call_stage`` in ok/api/batch/missing/timeout, ``call_error``, ``call_ms``,
``call_end_s``).
``classify`` composes text resolution -> prompt -> scorer -> parser, one result
row per request, and never lets one bad row fail the job.

Scorers provided:

* :func:`recorded_scorer` - answers from a table, paired by ``request_key`` with a
  left join (deterministic; used by the oracle queries).
* :func:`function_scorer` - any Python callable (e.g. a remote model client) run
  per partition with ``mapInPandas``: one client per partition, per-row error
  isolation, elapsed time and a time limit per row, optional threads per task
  and a per-minute call limit.
* :func:`lexicon_score` - an offline evidence scorer, pure Spark.
"""

from __future__ import annotations

import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import build_prompt
from ..schemas import (DEFAULT_THRESHOLD, OFFERED_TYPES, SCORER_MAX_TOKENS,
                       SCORER_TEMPERATURE, SCORER_TOP_P)
from ..session import ship_package
from .budget import Budget
from .calls import CallPool
from .extract import resolve_text
from .parse import answer_status, parse_response
from .terms import term_score


def _check_unit(name: str, value: float) -> None:
    if not 0.0 <= value <= 1.0:
        raise ValueError(f"{name} must be between 0.0 and 1.0")


class ScorerApiError(Exception):
    """Raised by a scorer callable for a service-side failure (becomes an API fallback row)."""


CALL_FIELDS = [
    T.StructField("response_text", T.StringType()),
    T.StructField("call_stage", T.StringType()),
    T.StructField("call_error", T.StringType()),
    T.StructField("call_ms", T.DoubleType()),
    T.StructField("call_end_s", T.DoubleType()),  # epoch seconds when the call returned
]


MAX_HOT_KEYS = 10_000  # the hottest keys, salted explicitly; further ones join exactly too, split by AQE alone


def recorded_scorer(answers: DataFrame, key: str = "request_key", response_col: str = "response_text",
                    dedupe: bool = True, hot_key_rows: int | None = None,
                    salt_buckets: int = 32, materialize_answers: bool | None = None, latest_col: str | None = None,
                    carry: list[str] | None = None) -> Callable[[DataFrame], DataFrame]:
    """Pair each request with its recorded answer (K2, E5).

    Both sides are large, so this is a shuffle join on ``key`` (never a broadcast
    of a table that grows with the data; AQE may still pick one at run time from
    measured sizes).  Duplicate answers for a key are reduced to one before the
    join; that aggregate is partitioned on the join key, so it adds no exchange.
    A request without an answer becomes a ``missing`` row.  With ``dedupe=False``
    (answer keys known to be unique) the aggregate and its map-side sort are
    skipped; duplicate keys would then multiply request rows.

    Of several answers for a key the smallest text is taken, or the latest by ``latest_col``.
    ``carry`` names further columns of the answers' table (expectations, say) that come
    along, so that one stored table per key and one join serve both.

    Hot keys: the deduplicated answers are stored once under the checkpoint
    folder (``materialize_answers``, by default where ``dedupe`` is on), so no
    aggregate stands between the join and its shuffles and AQE's skew join splits
    an oversized partition; a streaming query scans that table on every
    micro-batch instead of re-aggregating the answers each time.
    Where AQE cannot be relied on, ``hot_key_rows`` salts explicitly: keys with
    more request rows than that (found by one partial aggregation of the keys; the
    ``MAX_HOT_KEYS`` hottest) have their requests spread over ``salt_buckets``
    buckets, and only those keys' single answer rows are replicated per bucket.
    Results are identical either way.
    """
    carry = carry or []
    if dedupe:
        answer = F.struct(F.col(response_col).alias("__answer"), *carry)
        if latest_col:  # of answers as late, the larger text
            chosen = F.max(F.struct(F.col(latest_col).alias("__when"), answer.alias("__a"))).getField("__a")
        else:
            chosen = F.min(answer)
        one = answers.groupBy(key).agg(chosen.alias("__a")).select(key, "__a.*")
    else:
        one = answers.select(F.col(key), F.col(response_col).alias("__answer"), *carry)
    if dedupe if materialize_answers is None else materialize_answers:
        from ..session import materialize
        one = materialize(one, "answers")

    def score(df: DataFrame) -> DataFrame:
        if hot_key_rows:
            hot = [r[0] for r in (df.where(F.col(key).isNotNull()).groupBy(key).count()
                                  .where(F.col("count") > hot_key_rows)
                                  .orderBy(F.desc("count"), key).select(key).limit(MAX_HOT_KEYS).collect())]
        else:
            hot = []
        if hot:
            is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
            # deterministic per row for a deterministic input, so a retried task re-salts the same way
            salted = df.withColumn("__salt", F.when(is_hot, F.pmod(F.monotonically_increasing_id(),
                                                                   F.lit(salt_buckets))).otherwise(F.lit(0)))
            buckets = F.when(is_hot, F.sequence(F.lit(0), F.lit(salt_buckets - 1))).otherwise(F.array(F.lit(0)))
            replicas = one.withColumn("__salt", F.explode(buckets))
            j = salted.join(replicas, on=[key, "__salt"], how="left").drop("__salt")
        else:
            j = df.join(one, on=key, how="left")
        missing = F.col("__answer").isNull()
        return (j.withColumns({
            "response_text": F.col("__answer"),
            "call_stage": F.when(missing, F.lit("missing")).otherwise(F.lit("ok")),
            "call_error": F.when(missing, F.concat(F.lit("no recorded answer for request "),
                                                     F.coalesce(F.col(key), F.lit("without a key")))),
            "call_ms": F.lit(None).cast("double"),
            "call_end_s": F.lit(None).cast("double"),
        }).drop("__answer"))

    return score


def function_scorer(fn: Callable[[str], str], timeout_s: float = 300.0,
                    partitions: int | None = None,
                    client_factory: Callable[[], object] | None = None,
                    threads_per_task: int = 1,
                    max_calls_per_minute: float | None = None,
                    hard_timeout: bool = False, processes: bool = False,
                    budget: Budget | None = None) -> Callable[[DataFrame], DataFrame]:
    """Run ``fn(prompt) -> answer text`` per row inside ``mapInPandas`` (K1, K6, K7).

    With ``client_factory``, ``fn`` is called as ``fn(prompt, client)`` and the
    client is built once per partition.  ``partitions`` bounds concurrency the way
    the reference's worker count did (round-robin ``repartition``).  Exceptions are isolated per row:
    :class:`ScorerApiError` -> ``api``, anything else -> ``batch``; a call longer
    than ``timeout_s`` -> ``timeout``.  The limit is applied to each call's result;
    give the client the same timeout (e.g. its read timeout) so that a hung call
    cannot hold its task.  With ``hard_timeout`` the task stops waiting instead:
    calls run on daemon threads, in waves of ``threads_per_task``, and a call
    still running ``timeout_s`` after it was sent becomes a ``timeout`` row
    while the task moves on (the stuck thread is abandoned).  Waiting for the call
    rate happens before a call is sent and does not count.  ``threads_per_task`` keeps that many calls
    in flight per task (I/O-bound remote calls), so the concurrency is
    ``partitions x threads_per_task``; results keep their row order.
    With ``processes`` the calls run in ``threads_per_task`` child processes of the task
    instead (``calls.CallPool``), and a call still running after ``timeout_s`` is ended with
    its process: nothing of it goes on.  The client is then built once per child.
    ``max_calls_per_minute`` (a service limit) is split evenly over the
    ``partitions`` tasks, each of which paces its calls to its share.  A ``budget``
    (``budget.Budget``) is shared instead: tasks claim calls and prompt tokens from it as they need them.
    """
    if timeout_s <= 0:
        raise ValueError("Request timeout must be greater than 0")
    if partitions is not None and partitions <= 0:
        raise ValueError("Max concurrent requests must be greater than 0")
    if threads_per_task <= 0:
        raise ValueError("threads_per_task must be greater than 0")
    if max_calls_per_minute is not None and (max_calls_per_minute <= 0 or not partitions):
        raise ValueError("max_calls_per_minute needs partitions and must be greater than 0")
    interval = 60.0 * partitions / max_calls_per_minute if max_calls_per_minute else 0.0

    def score(df: DataFrame) -> DataFrame:
        ship_package(df.sparkSession)
        # Round-robin, not by key: duplicated keys (a source listed many times)
        # must not pile into one task.  Spark sorts before a round-robin
        # repartition, so a retried task sees the same rows.
        src = df.repartition(partitions) if partitions else df
        schema = T.StructType(src.schema.fields + CALL_FIELDS)

        def per_partition(batches):
            import threading
            client = client_factory() if client_factory and not processes else None
            pace = {"next": time.monotonic()}
            lock = threading.Lock()

            spender = budget.spender() if budget else None

            def wait_turn(prompt):
                if spender:
                    with lock:
                        spender.wait(prompt)
                if not interval:
                    return
                with lock:
                    start = max(pace["next"], time.monotonic())
                    pace["next"] = start + interval
                time.sleep(max(0.0, start - time.monotonic()))

            def answered(prompt, client):
                try:
                    return (fn(prompt, client) if client_factory else fn(prompt)), "ok", None
                except ScorerApiError as e:
                    return None, "api", str(e)
                except TimeoutError:
                    return None, "timeout", f"Processing timed out after {timeout_s:g} seconds"
                except Exception as e:
                    return None, "batch", str(e)

            def in_child():
                own = client_factory() if client_factory else None
                return lambda prompt: answered(prompt, own)

            def call(prompt, turn=wait_turn):
                if prompt is None:  # row failed before scoring: never sent
                    return (None, "skipped", None, None, None)
                turn(prompt)
                t0 = time.monotonic()
                text, stage, err = answered(prompt, client)
                ms = (time.monotonic() - t0) * 1000.0
                if stage == "ok" and ms > timeout_s * 1000.0:
                    text, stage = None, "timeout"
                if stage == "timeout":
                    err = f"Processing timed out after {timeout_s:g} seconds"
                return (text, stage, err, ms, time.time())

            def bounded(prompts):
                # waves of daemon threads; a call still running at its own deadline is a timeout
                results = [None] * len(prompts)
                for lo in range(0, len(prompts), threads_per_task):
                    wave = []
                    for i in range(lo, min(lo + threads_per_task, len(prompts))):
                        if prompts[i] is not None:
                            wait_turn(prompts[i])

                        def run(i=i):
                            results[i] = call(prompts[i], turn=lambda _: None)
                        t = threading.Thread(target=run, daemon=True)
                        t.start()
                        wave.append((i, t, time.monotonic() + timeout_s))
                    for i, t, deadline in wave:
                        t.join(max(0.0, deadline - time.monotonic()))
                        if t.is_alive() or results[i] is None:
                            results[i] = (None, "timeout", f"Processing timed out after {timeout_s:g} seconds",
                                          timeout_s * 1000.0, time.time())
                return results

            pool = None
            children = CallPool(in_child, threads_per_task, timeout_s) if processes else None
            if threads_per_task > 1 and not hard_timeout and not processes:
                from concurrent.futures import ThreadPoolExecutor
                pool = ThreadPoolExecutor(max_workers=threads_per_task)
            try:
                for pdf in batches:
                    prompts = list(pdf["prompt"])
                    if children:
                        out = children.run(prompts, wait_turn)
                    elif hard_timeout:
                        out = bounded(prompts)
                    else:
                        out = list(pool.map(call, prompts)) if pool else [call(p) for p in prompts]
                    calls = pd.DataFrame(out, columns=[f.name for f in CALL_FIELDS], index=pdf.index)
                    yield pd.concat([pdf, calls], axis=1)
            finally:
                if pool:
                    pool.shutdown(wait=True)
                if children:
                    children.close()

        return src.mapInPandas(per_partition, schema)

    return score


def scorer_request(prompt, model_id: str, max_tokens: int = SCORER_MAX_TOKENS,
                   temperature: float = SCORER_TEMPERATURE, top_p: float = SCORER_TOP_P):
    """The model call as data: one user message with the prompt, and the inference settings (K1).

    A struct column (``to_json`` it for an HTTP body); a scorer client sends it as is.
    """
    if not model_id:
        raise ValueError("model_id is required")
    _check_unit("Temperature", temperature)
    _check_unit("Top_p", top_p)
    p = F.col(prompt) if isinstance(prompt, str) else prompt
    return F.struct(
        F.lit(model_id).alias("modelId"),
        F.array(F.struct(F.lit("user").alias("role"),
                         F.array(F.struct(p.alias("text"))).alias("content"))).alias("messages"),
        F.struct(F.lit(max_tokens).alias("maxTokens"), F.lit(float(temperature)).alias("temperature"),
                 F.lit(float(top_p)).alias("topP")).alias("inferenceConfig"),
    )


def classify(requests: DataFrame, scorer: Callable[[DataFrame], DataFrame], model: str | None = None,
             threshold: float = DEFAULT_THRESHOLD, offered_types: list[str] | None = None,
             content_col: str = "document_content", extracted_col: str | None = None,
             error_col: str | None = None, drop_cols: list[str] | None = None,
             keep_text: bool = False, prompt_limit: int | None = None) -> DataFrame:
    """Classify every request; exactly one result row per request (K4, K5, K6).

    The prompt holds the whole text, or its first ``prompt_limit`` characters.  Rows with a
    non-NULL ``error_col`` are not sent to the scorer and become error rows
    carrying that message.  The text columns (``content_col``, ``extracted_col``,
    ``drop_cols``) are dropped once the prompt is built unless ``keep_text``.
    Columns added:
    ``prompt_md5`` (of the prompt as sent, NULL where none was), ``predicted_type, primary_score, threshold, reasoning, extracted_features,
    stage, error, status, model_used, processing_time_ms, timestamp``.
    """
    _check_unit("Confidence threshold", threshold)
    text = resolve_text(F.col(content_col), F.col(extracted_col) if extracted_col else None)
    prompt = build_prompt(text, offered_types or OFFERED_TYPES, prompt_limit)
    if error_col:  # rows that already failed (e.g. a local file that could not be read) are not sent
        prompt = F.when(F.col(error_col).isNull(), prompt)
    prompted = requests.withColumn("prompt", prompt).withColumn("prompt_md5", F.md5("prompt"))
    if not keep_text:
        # the text is consumed by the prompt; a scorer under mapInPandas must return
        # every input column, so whole documents would otherwise cross into Python
        # and through its shuffle
        gone = [c for c in [content_col, extracted_col, *(drop_cols or [])] if c and c in requests.columns]
        prompted = prompted.drop(*gone)
    answered = scorer(prompted)
    if error_col:
        failed = F.col(error_col).isNotNull()
        answered = answered.withColumns({
            "call_stage": F.when(failed, F.lit("batch")).otherwise(F.col("call_stage")),
            "call_error": F.when(failed, F.col(error_col)).otherwise(F.col("call_error")),
        })
    parsed = parse_response(answered, "response_text", threshold=threshold,
                            stage_col="call_stage", error_col="call_error")
    return (parsed.withColumns({
        "status": answer_status("stage"),
        "model_used": F.lit(model).cast("string"),
        "processing_time_ms": F.col("call_ms"),
        # when the document's call finished (a scorer that reports it), else the query time
        "timestamp": F.coalesce(F.timestamp_seconds(F.col("call_end_s")), F.current_timestamp()),
    }).drop("prompt", "call_stage", "call_error", "call_ms", "call_end_s"))


# ---------------------------------------------------------------------------
# Offline evidence scorer (K3)
# ---------------------------------------------------------------------------

TOKEN_PATTERN = "[a-z]+"
MAX_INLINE_TERMS = 1000          # lexicon rows collected to the driver (checked by count)
MAX_INLINE_GROUPS = 8            # (type, weight) groups scored in-row; each is one pass over the hits
MAX_BROADCAST_TERMS = 2_000_000  # lexicon rows that may be broadcast (checked by count)


def _tokens(text_col: str):
    return F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(TOKEN_PATTERN), 0)


def _is_token(term: str) -> bool:
    import re
    return re.fullmatch(TOKEN_PATTERN, term) is not None


def lexicon_score(docs: DataFrame, lexicon, id_col: str = "doc_id", text_col: str = "text",
                  type_col: str = "document_type", term_col: str = "term", weight_col: str = "weight",
                  max_inline_groups: int = MAX_INLINE_GROUPS) -> DataFrame:
    """Best type per document from weighted term evidence (K3).

    Tokens are maximal ``[a-z]+`` runs of the lower-cased text.  score = evidence
    of the best type / all evidence; ties go to the larger type name; no evidence
    gives ``unknown`` and 0.0; ``key_terms`` are the matched lexicon terms, sorted.
    The columns are those of ``docs`` without the text, and the result's four.

    ``lexicon`` is a list of (type, term, weight) or a DataFrame; the weights of a
    (type, term) listed several times add up, rows without a type or term do not
    count.  The plan (never the result) is chosen from the lexicon's checked size
    (measured at sf0.1, see README):

    * few (type, weight) groups (<= ``max_inline_groups``): each document's text is
      tokenized once, tokens are kept by hash-set membership (``InSet``) and each
      group is counted over the kept tokens -- narrow, no shuffle, whole texts.
    * a term that is no token (several words, letters beyond a-z):
      :func:`~doctriage.operators.terms.term_score`, an automaton over whole texts; see there for its word ends.
    * otherwise :func:`lexicon_score_join` (broadcast join of exploded tokens and
      one per-document aggregate).
    """
    if isinstance(lexicon, DataFrame):
        summed = _lexicon_sums(lexicon, type_col, term_col, weight_col)
        n_terms = summed.count()
        if summed.where(~F.col(term_col).rlike(f"^{TOKEN_PATTERN}$")).limit(1).count():
            return term_score(docs, summed.toDF("t", "term", "w"), id_col, text_col)
        if n_terms > MAX_INLINE_TERMS:
            return lexicon_score_join(docs, lexicon, id_col, text_col, type_col, term_col, weight_col, n_terms)
        listed = summed.collect()  # bounded by MAX_INLINE_TERMS
    else:
        listed = [(str(t), str(term), float(w)) for t, term, w in lexicon if t is not None and term is not None]
    sums: dict[tuple[str, str], float] = {}
    for t, term, w in listed:
        sums[t, term] = sums.get((t, term), 0.0) + w
    rows = [(t, term, w) for (t, term), w in sums.items()]
    if not all(_is_token(term) for _, term, _ in rows):
        return term_score(docs, docs.sparkSession.createDataFrame(rows, "t string, term string, w double"), id_col, text_col)
    groups: dict[tuple[str, float], list[str]] = {}
    for t, term, w in rows:
        groups.setdefault((t, w), []).append(term)
    if len(groups) > max_inline_groups:
        lex_df = docs.sparkSession.createDataFrame(
            rows, f"{type_col} string, {term_col} string, {weight_col} double")
        return lexicon_score_join(docs, lex_df, id_col, text_col, type_col, term_col, weight_col, len(rows))
    types = sorted({t for t, _, _ in rows})
    terms = sorted({term for ts in groups.values() for term in ts})
    if not terms:
        return docs.drop(text_col).withColumns({"predicted_type": F.lit("unknown"), "primary_score": F.lit(0.0),
                                                "evidence": F.lit(0.0), "key_terms": F.array().cast("array<string>")})
    hits = F.filter(F.coalesce(_tokens(text_col), F.array().cast("array<string>")), _term_in(terms))

    def evidence(t):
        parts = [F.size(F.filter(F.col("__hits"), _term_in(ts))) * F.lit(w)
                 for (gt, w), ts in groups.items() if gt == t]
        return sum(parts[1:], parts[0]) if parts else F.lit(0.0)

    per_type = F.array(*[F.struct(evidence(t).cast("double").alias("w"), F.lit(t).alias("t")) for t in types])
    scored = (docs.withColumn("__hits", hits)
              .withColumn("__per_type", per_type)
              .withColumn("__total", F.aggregate(F.col("__per_type"), F.lit(0.0), lambda a, e: a + e["w"]))
              .withColumn("__best", F.array_max(F.filter(F.col("__per_type"), lambda e: e["w"] > 0))))
    has = F.col("__total") > 0
    return (scored.withColumns({
        "predicted_type": F.when(has, F.col("__best.t")).otherwise(F.lit("unknown")),
        "primary_score": F.when(has, F.col("__best.w") / F.col("__total")).otherwise(F.lit(0.0)),
        "evidence": F.col("__total"),
        "key_terms": F.array_sort(F.array_distinct(F.col("__hits"))),
    }).drop("__hits", "__per_type", "__total", "__best", text_col))


def _lexicon_sums(lexicon: DataFrame, type_col: str, term_col: str, weight_col: str) -> DataFrame:
    """(type, term, summed weight), one row a pair; rows without a type or term do not count."""
    return (lexicon.where(F.col(type_col).isNotNull() & F.col(term_col).isNotNull())
            .groupBy(type_col, term_col).agg(F.coalesce(F.sum(F.col(weight_col).cast("double")), F.lit(0.0)).alias(weight_col)))


def _term_in(terms: list[str]):
    """One-argument predicate (a lambda with a default would be read as ``(x, index)``)."""
    def pred(x):
        return x.isin(terms)
    return pred


def lexicon_score_join(docs: DataFrame, lexicon: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       type_col: str = "document_type", term_col: str = "term",
                       weight_col: str = "weight", n_terms: int | None = None) -> DataFrame:
    """Same result as :func:`lexicon_score` for lexicons with many terms or types.

    Tokens are exploded and joined to the lexicon: a broadcast hash join when the
    counted lexicon fits ``MAX_BROADCAST_TERMS`` (non-lexicon tokens are dropped in
    the scan stage), else a shuffle join on the term with tokens pre-counted per
    (document, term) so a hot term arrives as one row per document (AQE splits any
    remaining skew).  Evidence is summed per (document, type) and then per
    document, both with map-side partial aggregation (measured faster than one
    aggregate of per-type conditional sums).  The result is joined back to the
    documents *without* their text; ``key_terms`` are sorted.
    """
    lexicon = _lexicon_sums(lexicon, type_col, term_col, weight_col)
    n_terms = lexicon.count() if n_terms is None else n_terms
    lex = lexicon.select(F.col(term_col), F.col(type_col).alias("__t"), F.col(weight_col).alias("__w"))
    tokens = docs.select(id_col, F.explode(_tokens(text_col)).alias(term_col))
    if n_terms <= MAX_BROADCAST_TERMS:
        matched = tokens.join(F.broadcast(lex), term_col).withColumn("__n", F.lit(1))
    else:
        counted = tokens.groupBy(id_col, term_col).agg(F.count(F.lit(1)).alias("__n"))
        matched = counted.join(lex, term_col)
    ev = (matched.groupBy(id_col, "__t")
          .agg(F.sum(F.col("__n") * F.col("__w")).alias("__s"), F.collect_set(term_col).alias("__terms")))
    per_doc = ev.groupBy(id_col).agg(
        F.max(F.when(F.col("__s") > 0, F.struct(F.col("__s").alias("w"), F.col("__t").alias("t")))).alias("__best"),
        F.sum("__s").alias("__total"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("__terms")))).alias("key_terms"))
    out = docs.drop(text_col).join(per_doc, id_col, "left")
    has = F.coalesce(F.col("__total"), F.lit(0.0)) > 0
    scored = out.withColumns({
        "predicted_type": F.when(has, F.col("__best.t")).otherwise(F.lit("unknown")),
        "primary_score": F.when(has, F.col("__best.w") / F.col("__total")).otherwise(F.lit(0.0)),
        "evidence": F.coalesce(F.col("__total"), F.lit(0.0)),
        "key_terms": F.coalesce(F.col("key_terms"), F.array().cast("array<string>")),
    })
    return scored.select(*[c for c in docs.columns if c != text_col],
                         "predicted_type", "primary_score", "evidence", "key_terms")


def one_per_key(requests: DataFrame, content_col: str = "document_content", key: str = "request_key") -> DataFrame:
    """One row for each key: of several, the one whose text, then whose whole row, has the smallest hash.

    The choice does not depend on partitions or order, so a re-run chooses the same row.
    """
    text = F.md5(F.coalesce(F.col(content_col).cast("string"), F.lit(""))) if content_col in requests.columns else F.lit("")
    row = F.md5(F.to_json(F.struct("*")))
    return requests.groupBy(F.col(key).alias("__key")).agg(F.min_by(F.struct("*"), F.struct(text, row)).alias("__row")).select("__row.*")


def classify_to_table(requests: DataFrame, scorer: Callable[[DataFrame], DataFrame], table_path: str,
                      model: str | None = None, threshold: float = DEFAULT_THRESHOLD, chunks: int = 1,
                      **kwargs) -> DataFrame:
    """Classify only requests not yet in ``table_path`` and append them; return the table.

    Billing-safe re-runs: requests whose ``request_key`` is already stored are
    removed with a left anti join, so a re-run after a failure never calls the
    scorer again for finished rows.  Each chunk (a hash bucket of the key) is its
    own append job, so a failure loses at most one chunk of work; within a job,
    Spark's commit protocol keeps retried or speculative task attempts from
    writing twice.  Speculation should stay off for jobs with a paid scorer.
    Each chunk re-reads ``requests`` (and the stored keys), so pass a materialized
    or cheaply re-readable input when using many chunks.  A key listed several
    times is scored once, for the row that ``one_per_key`` chooses.  A request without a key raises before anything is
    scored, as it could not be found again; so does a stored table that cannot be read.
    """
    spark = requests.sparkSession
    from pyspark.errors import AnalysisException
    if requests.where(F.col("request_key").isNull()).limit(1).count():
        raise ValueError("every request needs a request_key")
    todo = one_per_key(requests, kwargs.get("content_col", "document_content"))
    try:
        done = spark.read.parquet(table_path).select("request_key")
        todo = todo.join(done, "request_key", "left_anti")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":  # else: no table yet
            raise
    for i in range(chunks):
        part = todo if chunks == 1 else todo.where(F.pmod(F.xxhash64("request_key"), F.lit(chunks)) == i)
        res = classify(part, scorer, model=model, threshold=threshold, **kwargs)
        res.write.mode("append").parquet(table_path)
    return spark.read.parquet(table_path)
