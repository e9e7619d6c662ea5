"""Classification requests as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import REQUEST_SCHEMA

DIRECT_URI = "direct://text-input"
DEFAULT_TEXT_ID = "text-input"
SOURCE_KINDS = ["s3", "local", "text"]


def requests_from_text(df: DataFrame, text_col: str = "text", id_col: str | None = None,
                       default_id: str = DEFAULT_TEXT_ID) -> DataFrame:
    """In-line text as requests: URI ``direct://text-input``, id defaulting to ``text-input``."""
    doc_id = F.coalesce(F.col(id_col), F.lit(default_id)) if id_col else F.lit(default_id)
    return df.select(
        doc_id.alias("document_id"),
        F.lit(DIRECT_URI).alias("document_uri"),
        F.col(text_col).alias("document_content"),
        *[c for c in df.columns if c not in (text_col, id_col, "document_id", "document_uri",
                                             "document_content")],
    )


def request_error(document_id="document_id", document_uri="document_uri") -> Column:
    """Validation message of a request, NULL when valid (D3)."""
    i = F.col(document_id) if isinstance(document_id, str) else document_id
    u = F.col(document_uri) if isinstance(document_uri, str) else document_uri
    return (F.when(i.isNull() | (i == ""), F.lit("Document ID is required"))
            .when(u.isNull() | (u == ""), F.lit("Document URI is required")))


def validate_requests(df: DataFrame, strict: bool = False, **cols) -> DataFrame:
    """Add ``request_error``; with ``strict`` the job fails on the first invalid row."""
    err = request_error(**cols)
    if strict:
        return df.withColumn("request_error", F.when(err.isNotNull(), F.raise_error(err)))
    return df.withColumn("request_error", err)


def request_from_json(df: DataFrame, json_col: str = "value") -> DataFrame:
    """Parse request records with defaults: '' for id/URI, '{}' for the open dicts."""
    schema = ("document_id string, document_uri string, document_content string, "
              "document_metadata variant, classification_config variant, requester_id string")
    r = F.from_json(F.col(json_col), schema)
    return df.select(
        F.coalesce(r.document_id, F.lit("")).alias("document_id"),
        F.coalesce(r.document_uri, F.lit("")).alias("document_uri"),
        r.document_content.alias("document_content"),
        F.coalesce(F.to_json(r.document_metadata), F.lit("{}")).alias("document_metadata"),
        F.coalesce(F.to_json(r.classification_config), F.lit("{}")).alias("classification_config"),
        r.requester_id.alias("requester_id"),
    )


def request_to_json(df: DataFrame) -> DataFrame:
    """Request records as JSON text with every key present."""
    meta = F.coalesce(F.col("document_metadata"), F.lit("{}"))
    conf = F.coalesce(F.col("classification_config"), F.lit("{}"))
    rec = F.struct(
        F.col("document_id"), F.col("document_uri"), F.col("document_content"),
        F.parse_json(meta).alias("document_metadata"),
        F.parse_json(conf).alias("classification_config"),
        F.col("requester_id"),
    )
    return df.withColumn("request_json", F.to_json(rec, {"ignoreNullFields": "false"}))


def dispatch_sources(df: DataFrame, kind_col: str = "source_type") -> DataFrame:
    """Route by source kind; an unknown kind is an error row, not a failure."""
    k = F.col(kind_col)
    return df.withColumns({
        "route": F.when(k.isin(SOURCE_KINDS), k),
        "dispatch_error": F.when(~k.isin(SOURCE_KINDS) | k.isNull(),
                                 F.concat(F.lit("Unsupported source type: "), F.coalesce(k, F.lit("None")))),
    })


def with_run_options(df: DataFrame, **options) -> DataFrame:
    """Run options onto every row, overriding row values (K8); None options are skipped."""
    return df.withColumns({k: F.lit(v) for k, v in options.items() if v is not None})


REQUEST_COLUMNS = [f.name for f in REQUEST_SCHEMA.fields]
