"""Documents of jurisdictions outside the EU: hits, consolidation, texts, records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexcorpus import schemas
from lexcorpus.functions import nation, quality, urls
from lexcorpus.functions.text import blank_to_null, empty, parse_list, strip, text_or_empty
from lexcorpus.operators.dedup import keep_first_narrow
from lexcorpus.operators.picks import first_filled, longest, sorted_values

HIT_COLUMNS = (
    "source", "jurisdiction", "url", "doc_url", "text_url", "api_self", "title", "doc_uid", "lang",
    "term", "matched_term", "api_id", "document_id",
)
BACKFILLED = (
    "lang", "celex", "date", "format", "public_timestamp", "description", "doc_url", "text_url",
    "xml_url", "pdf_url", "api_self",
)
FULLTEXT_ROW = (
    "doc_id", "country", "jurisdiction", "doc_uid", "title", "url", "lang", "date", "year",
    "source_file", "full_text_clean", "text_len", "has_text", "retrieval_status", "full_text_url",
    "full_text_error", "full_text_format", "source",
)


def any_url():
    filled = lambda c: F.nullif(F.col(c), empty())
    return F.coalesce(filled("url"), filled("doc_url"), filled("api_self"), empty())


def with_dates(df: DataFrame) -> DataFrame:
    """Document key, cleaned title, year and date of every row."""
    df = schemas.with_missing(
        df, ("source", "jurisdiction", "url", "doc_url", "api_self", "title", "api_id",
             "document_id", "full_text_clean"), "",
    )
    if "country" not in df.columns:
        df = df.withColumn("country", F.col("jurisdiction"))
    df = nation.with_document_key(df.withColumn("_any", any_url()).drop("celex"), "_any", "doc_id")
    df = df.drop("_any")
    df = df.withColumn(
        "title", nation.title(F.col("title"), F.col("jurisdiction"), F.col("full_text_clean"))
    )
    df = nation.with_year(df, "year")
    return df.withColumn("date", F.col("year").cast("string"))


def prepare_hits(hits: DataFrame) -> DataFrame:
    """Hits in one shape: an address, a term, a language, a key, a title and a year."""
    df = schemas.with_missing(hits, HIT_COLUMNS)
    given = lambda c: F.when(strip(F.col(c)) != "", F.col(c))
    df = df.withColumns(
        {
            "matched_term": F.coalesce("matched_term", empty()),
            "term": F.coalesce("term", "matched_term", empty()),
            "url": F.coalesce(
                given("url"), given("text_url"), given("doc_url"), given("api_self"), empty()
            ),
            "lang": F.coalesce("lang", F.lit("en")),
        }
    )
    df = df.withColumn("doc_uid", F.coalesce("doc_uid", "url"))
    return with_dates(df).drop("full_text_clean")


def distinct_hits(hits: DataFrame) -> DataFrame:
    return keep_first_narrow(hits, ["doc_id", "term", "source", "url"])


def docs_from_hits(prepared: DataFrame) -> DataFrame:
    """One row per document and jurisdiction with its sorted terms."""
    kept = prepared.where(F.col("doc_id").isNotNull() & F.col("jurisdiction").isNotNull())
    return kept.withColumn("year", F.col("year").cast("string")).groupBy(
        "doc_id", "jurisdiction"
    ).agg(
        first_filled("country"),
        first_filled("doc_uid"),
        longest("title"),
        first_filled("url"),
        first_filled("lang"),
        first_filled("source"),
        first_filled("date"),
        first_filled("year"),
        sorted_values("term", "matched_terms"),
    )


def one_row_per_doc(hits: DataFrame) -> DataFrame:
    """One row per document key: the first record, the longest title, later values where the
    first has none, and sorted terms and sources."""
    df = schemas.with_missing(hits, (*HIT_COLUMNS, *BACKFILLED))
    filled = lambda c: F.nullif(F.col(c), empty())
    df = nation.with_document_key(df.withColumn("_any", any_url()), "_any", "doc_key")
    keyed = df.drop("_any").withColumn(
        "_term", F.coalesce(filled("term"), filled("matched_term"))
    )
    base_cols = ("source", "jurisdiction", "url", "doc_uid", "api_id", "document_id")
    title = F.when(strip(F.col("title")) != "", F.col("title"))
    first = lambda c: F.min_by(filled(c), F.when(filled(c).isNotNull(), F.col("ord")))
    grouped = keyed.groupBy("doc_key").agg(
        F.min("ord").alias("ord"),
        F.min_by(F.struct(*base_cols), "ord").alias("b"),
        F.coalesce(
            F.min_by(title, F.when(title.isNotNull(), F.struct(-F.length(title), F.col("ord")))),
            empty(),
        ).alias("title"),
        *[first(c).alias(c) for c in BACKFILLED],
        F.array_sort(F.collect_set("_term")).alias("matched_terms"),
        F.array_sort(F.collect_set(filled("source"))).alias("sources"),
    )
    flat = grouped.select(
        "doc_key", "ord", *[F.col(f"b.{c}").alias(c) for c in base_cols], "title", *BACKFILLED,
        "matched_terms", "sources",
    )
    return urls.with_canonical(flat, "url", "url")


KEYED_BY = ("source", "jurisdiction", "url", "doc_url", "api_self", "title", "api_id", "document_id")


def with_terms(docs: DataFrame, found: DataFrame, out: str) -> DataFrame:
    """Documents with the matched terms of ``found`` (``docs_from_hits``), joined before any text is,
    by the id that ``fulltext_docs`` gives them. A document found in two jurisdictions has two term
    rows and so comes twice, as its hits did."""
    df = schemas.with_missing(docs, KEYED_BY, "").withColumn("_any", any_url())
    df = nation.with_document_key(df.drop("celex"), "_any", "_id").drop("_any")
    terms = found.select(F.col("doc_id").alias("_id"), F.col("matched_terms").alias(out))
    return df.join(terms, "_id", "left").drop("_id")


def fulltext_docs(docs: DataFrame, texts: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """Documents with their captured texts (``doc_key, full_text, full_text_error,
    full_text_url, full_text_format``) in the fixed column order, and the columns ``also``."""
    df = docs.join(texts, "doc_key", "left").withColumn(
        "full_text_clean", F.coalesce("full_text", empty())
    )
    df = with_dates(df.drop("full_text"))
    error = F.coalesce("full_text_error", empty())
    df = df.withColumns(
        {
            "country": F.col("jurisdiction"),
            "text_len": F.length("full_text_clean"),
            "has_text": F.length("full_text_clean") > 0,
            "retrieval_status": quality.retrieval_status(F.length("full_text_clean"), error),
            "source_file": F.coalesce("full_text_url", empty()),
            "doc_uid": F.col("doc_id"),
            "url": F.coalesce("url", "doc_url", empty()),
        }
    )
    return schemas.with_missing(df, FULLTEXT_ROW, "").select("ord", *FULLTEXT_ROW, *also)


def to_records(rows: DataFrame, source_name: str) -> DataFrame:
    """Document columns and the raw record of harmonized rows; flags and numbers that come as
    texts are read again."""
    names = (
        "country", "contents_url", "date", "doc_id", "doc_uid", "full_text_clean",
        "full_text_error", "full_text_format", "full_text_url", "has_text", "jurisdiction", "lang",
        "matched_terms", "retrieval_status", "source", "source_file", "text_len", "title", "url",
        "year", "source_log", "retrieved_at",
    )
    df = schemas.with_missing(rows, names)
    kinds = dict(df.dtypes)
    t = lambda c: blank_to_null(F.col(c).cast("string"))
    number = lambda c: F.expr(f"try_cast(trim(cast({c} as string)) as int)")
    flag = F.lower(t("has_text"))
    terms = (
        parse_list(F.col("matched_terms"))
        if kinds["matched_terms"] == "string"
        else F.filter(F.transform("matched_terms", strip), lambda v: v != "")
    )
    text_url = F.coalesce(t("full_text_url"), t("source_file"))
    plain = ("country", "contents_url", "full_text_error", "full_text_format")
    raw = F.to_json(
        F.struct(
            *[t(c).alias(c) for c in plain],
            text_url.alias("full_text_url"),
            F.when(flag.isin("true", "false"), flag == "true").alias("has_text"),
            F.when(F.size(terms) > 0, terms).alias("matched_terms"),
            t("retrieval_status").alias("retrieval_status"),
            t("source").alias("source"),
            F.col("source_log"),
            number("text_len").alias("text_len"),
            number("year").alias("year"),
        )
    )
    uid = F.coalesce(t("doc_uid"), t("doc_id"))
    return df.withColumns(
        {
            "raw_record": raw,
            "document_id": F.concat(F.lit(f"{source_name}:"), t("doc_id")),
            "title": F.coalesce(t("title"), t("doc_id"), t("url")),
            "source_document_id": uid,
            "document_type": F.lit("policy_document"),
            "language": t("lang"),
            "publication_date": t("date"),
            "url": t("url"),
            "download_url": text_url,
            "full_text": t("full_text_clean"),
            "jurisdiction": t("jurisdiction"),
        }
    )


def fill_from_texts(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Fill missing title, date and year of rows from the first full-text row of the document."""
    meta = texts.groupBy("doc_id").agg(
        *[F.min_by(c, "ord").alias(f"_f_{c}") for c in ("title", "date", "year", "retrieval_status")]
    )
    df = rows.join(meta, "doc_id", "left")
    absent = lambda c: F.lower(text_or_empty(F.col(c))).isin("", "nan", "none", "null", "<na>")
    return df.withColumns(
        {
            "title": F.when(absent("title"), F.col("_f_title")).otherwise(F.col("title")),
            "date": F.when(absent("date"), F.col("_f_date")).otherwise(F.col("date")),
            "year": F.coalesce("year", "_f_year"),
            "retrieval_status": F.col("_f_retrieval_status"),
        }
    ).drop("_f_title", "_f_date", "_f_year", "_f_retrieval_status")
