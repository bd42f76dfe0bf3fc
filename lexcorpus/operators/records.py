"""Mapping raw records to documents, and cleaning documents for later analysis."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexcorpus import schemas
from lexcorpus.functions import dates, text

REQUIRED = ("document_id", "title")
OPTIONAL = (
    "source_document_id", "summary", "document_type", "language", "jurisdiction",
    "publication_date", "effective_date", "url", "download_url", "full_text", "retrieved_at",
    "checksum", "content_path",
)
REMOVED_TEXT = "source_boilerplate_or_empty_after_cleaning"


def map_fields(df: DataFrame, mapping: dict[str, str], defaults: dict[str, Column] | None = None):
    """Document columns from raw columns. A default replaces a null, never a blank. Column
    ``problem`` names the first required field that is missing; it is null for good rows."""
    defaults = defaults or {}
    cols, problem = {}, F.lit(None).cast("string")
    for name in (*REQUIRED, *OPTIONAL):
        raw = mapping.get(name)
        value = F.col(raw) if raw in df.columns else F.lit(None).cast("string")
        if name in defaults:
            value = F.coalesce(value, defaults[name])
        if name in REQUIRED:
            problem = F.coalesce(
                problem,
                F.when(value.isNull(), f"{name} is required").when(
                    text.strip(value) == "", f"{name} must be non-empty"
                ),
            )
        cols[name] = text.blank_to_null(value)
    raw_record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns if c != "ord"]))
    keep = [F.col("ord")] if "ord" in df.columns else []
    return df.select(
        *keep,
        *[v.alias(k) for k, v in cols.items()],
        raw_record.alias("raw_record"),
        problem.alias("problem"),
    )


def require_mapped(df: DataFrame) -> DataFrame:
    """Fail the job on the first mapped row with a problem."""
    bad = F.col("problem").isNotNull()
    return df.where(
        F.when(bad, F.raise_error(F.concat(F.lit("unusable record: "), F.col("problem"))).cast("boolean"))
        .otherwise(True)
    ).drop("problem")


def normalize(df: DataFrame, source_name: str, adapter: str) -> DataFrame:
    """Documents with provenance, from mapped rows that carry the query columns
    ``query_text``, ``query_id``, ``query_origin`` and ``result_index``."""
    df = schemas.with_missing(
        df, ("query_text", "query_id", "query_origin", "query_source_path", "raw_record")
    )
    df = schemas.with_missing(df, ("result_index",), kind="long")
    df = schemas.with_missing(df, (*REQUIRED, *OPTIONAL))
    body = F.col("full_text")
    body = text.light_text(text.blank_to_null(body)) if adapter == "eurlex" else text.strip(body)
    out = {name: text.blank_to_null(F.col(name)) for name in (*REQUIRED, *OPTIONAL)}
    out["full_text"] = F.nullif(body, F.lit(""))
    out |= {
        "source_name": F.lit(source_name),
        "query": F.col("query_text"),
        "_query_id": F.col("query_id"),
        "_query_origin": F.col("query_origin"),
        "_query_source_path": F.col("query_source_path"),
        "_adapter_name": F.lit(adapter),
        "_adapter_result_index": F.col("result_index"),
    }
    out = df.withColumns(out).drop(
        "query_text", "query_id", "query_origin", "query_source_path", "result_index"
    )
    return schemas.as_documents(out)


_STRINGS = r'"(?:[^"\\]++|\\.)*+"|[^"]++'


def slim_json(raw: Column, drop: Sequence[str] = ()) -> Column:
    """A raw record of any shape, given as JSON, without blank texts and nulls at any depth and
    without the top-level fields of ``drop``. Texts lose white space at their ends; emptied lists and
    objects stay. Null where the text is no JSON object.

    The JSON is cut at its strings. Values are stripped, and all strings are spelled in hexadecimal
    for a while, so that what is between them can be edited as text."""
    framed = raw.rlike(r"^\s*\{") & raw.rlike(r"\}\s*$")
    whole = F.when(framed & F.try_parse_json(raw).isNotNull(), raw)
    if drop:
        fields = F.from_json(whole, "map<string, variant>")
        whole = F.to_json(F.map_filter(fields, lambda k, v: ~k.isin(*drop)))
    tokens = F.regexp_extract_all(whole, F.lit(_STRINGS), F.lit(0))
    inside = lambda t: F.substring(t, F.lit(2), F.length(t) - 2)
    hidden = lambda x: F.concat(F.lit('"'), F.hex(F.encode(x, "UTF-8")), F.lit('"'))
    is_string = lambda t: F.startswith(t, F.lit('"'))

    def value(t: Column) -> Column:
        said = text.strip(F.get(F.from_json(F.concat(F.lit("["), t, F.lit("]")), "array<string>"), F.lit(0)))
        listed = F.transform(F.array(said), lambda v: F.struct(v.alias("v"), F.to_json(F.array(v)).alias("j")))
        spelled = F.transform(
            listed,
            lambda x: F.when(x["v"] == "", F.lit("null")).otherwise(
                hidden(F.substring(x["j"], F.lit(3), F.length(x["j"]) - 4))
            ),
        )
        return F.get(spelled, F.lit(0))

    paired = F.arrays_zip(tokens.alias("t"), F.slice(tokens, F.lit(2), F.greatest(F.size(tokens), F.lit(0))).alias("then"))
    marked = F.transform(
        paired,
        lambda x: F.when(~is_string(x["t"]), F.regexp_replace(x["t"], r"\s+", ""))
        .when(F.startswith(F.ltrim(F.coalesce(x["then"], F.lit(""))), F.lit(":")), hidden(inside(x["t"])))
        .otherwise(value(x["t"])),
    )
    bare = F.regexp_replace(F.array_join(marked, ""), '"[0-9A-F]*":null,?', "")
    bare = F.regexp_replace(F.regexp_replace(bare, r"(?<=[\[,])null,?", ""), r",(?=[}\]])", "")
    shown = F.transform(
        F.regexp_extract_all(bare, F.lit(_STRINGS), F.lit(0)),
        lambda t: F.when(
            is_string(t), F.concat(F.lit('"'), F.decode(F.unhex(inside(t)), "UTF-8"), F.lit('"'))
        ).otherwise(t),
    )
    return F.array_join(shown, "")


def slim_record(df: DataFrame, columns, drop=()) -> Column:
    """JSON of the raw columns, of any kind, without blanks, nulls and the columns of ``drop``."""
    return slim_json(F.to_json(F.struct(*[F.col(c) for c in columns if c not in drop])))


def _kept(original: Column, cleaned: Column) -> Column:
    return F.when(~original.eqNullSafe(cleaned), original)


def clean(df: DataFrame, jurisdiction_code: str | None = None) -> DataFrame:
    """Clean titles, types, languages, jurisdictions, dates and texts; changed values stay
    readable in ``_original_*`` columns."""
    df = schemas.with_missing(df, schemas.TEXT_FIELDS)
    df = dates.with_normalized(
        df,
        {
            "publication_date": ("_new_publication_date", "_publication_date_precision"),
            "effective_date": ("_new_effective_date", "_effective_date_precision"),
        },
    )
    lines = ("title", "summary", "document_type", "language", "jurisdiction")
    df = df.withColumns({f"_in_{c}": text.inline(F.col(c)) for c in lines})
    df = df.withColumn("_body", text.body_lines(F.col("full_text")))
    df = df.withColumns(
        {
            "_new_title": text.title_of(F.col("_in_title")),
            "_new_document_type": text.document_type_of(F.col("_in_document_type")),
            "_new_language": F.lower("_in_language"),
            "_new_jurisdiction": text.jurisdiction_of(F.col("_in_jurisdiction"), jurisdiction_code),
            "_new_summary": F.col("_in_summary"),
            "_new_full_text": text.body_of(F.col("_body")),
        }
    )
    kept = (
        "title", "document_type", "language", "jurisdiction", "publication_date", "effective_date",
    )
    notes = {f"_original_{c}": _kept(F.col(c), F.col(f"_new_{c}")) for c in kept}
    notes["_full_text_removed_reason"] = F.when(
        (F.col("full_text") != "") & F.col("_new_full_text").isNull(), REMOVED_TEXT
    )
    changed = (*kept, "summary", "full_text")
    return (
        df.withColumns(notes)
        .withColumns({c: F.col(f"_new_{c}") for c in changed})
        .drop("_body", *[f"_in_{c}" for c in lines], *[f"_new_{c}" for c in changed])
    )
