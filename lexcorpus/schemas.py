"""Table shapes shared by the jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- fixed values: column names of documents, notes and records --------------------------
TEXT_FIELDS = (
    "document_id", "source_name", "title", "source_document_id", "summary", "document_type",
    "language", "jurisdiction", "publication_date", "effective_date", "url", "download_url",
    "query", "full_text", "retrieved_at", "checksum", "content_path",
)
PROVENANCE = (
    "_query_id", "_query_origin", "_query_source_path", "_adapter_name",
)
BREADCRUMBS = (
    "_original_title", "_original_document_type", "_original_language", "_original_jurisdiction",
    "_original_publication_date", "_original_effective_date", "_publication_date_precision",
    "_effective_date_precision", "_full_text_removed_reason",
)

# One document: 17 texts, the position in input order, the raw record as JSON, provenance.
DOCUMENT = T.StructType(
    [T.StructField(name, T.StringType()) for name in TEXT_FIELDS]
    + [T.StructField("ord", T.LongType()), T.StructField("raw_record", T.StringType())]
    + [T.StructField(name, T.StringType()) for name in PROVENANCE]
    + [T.StructField("_adapter_result_index", T.LongType())]
)
QUERY = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("query_id", T.StringType()),
        T.StructField("origin", T.StringType()),
        T.StructField("source_path", T.StringType()),
    ]
)
LOCAL_RECORD = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "id", "title", "source_document_id", "summary", "document_type", "language",
            "jurisdiction", "publication_date", "effective_date", "url", "download_url",
            "full_text", "retrieved_at", "checksum", "content_path",
        )
    ]
    + [T.StructField("queries", T.StringType())]
)
CACHE_TEXT = (
    "celex_full", "celex", "celex_version", "lang", "text", "source_url", "retrieval_error",
    "timestamp",
)
NIM_CACHE = (
    "cache_key", "celex", "nim_celex", "national_measure_id", "member_state_iso3",
    "member_state_name", "nim_title", "nim_title_notice", "nim_title_lang", "eurlex_url",
    "nim_resource_uri", "available_expr_langs3", "lang", "lang_detected", "lang_source",
    "available_languages", "page_title", "page_title_lang", "route_used", "text_route_used",
    "source_format", "text", "source_url", "retrieval_status", "retrieval_error", "text_len",
    "timestamp",
)


def with_missing(df: DataFrame, names, default=None, kind: str = "string") -> DataFrame:
    """Add the columns of ``names`` that ``df`` lacks."""
    absent = {n: F.lit(default).cast(kind) for n in names if n not in df.columns}
    return df.withColumns(absent) if absent else df


def as_documents(df: DataFrame) -> DataFrame:
    """``df`` with every document column, in order, further columns kept at the end."""
    known = {f.name: f.dataType for f in DOCUMENT}
    cols = [
        (F.col(n) if n in df.columns else F.lit(None)).cast(t).alias(n) for n, t in known.items()
    ]
    return df.select(*cols, *[F.col(f"`{c}`") for c in df.columns if c not in known])
