"""EU documents: consolidation of search hits, type filter, full texts, document records."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexcorpus import schemas
from lexcorpus.functions import celex
from lexcorpus.functions.text import blank_to_null, parse_list, strip, text_or_empty
from lexcorpus.operators.picks import first_filled, longest, sorted_values

HIT_URL = "https://eur-lex.europa.eu/legal-content/EN/TXT/?uri=CELEX:"
DEFAULT_TYPE = "eu_legal_document"
# fixed values: names of the columns of captured rows
FULLTEXT_COLUMNS = (
    "text_source_url", "full_text_raw", "full_text_clean", "retrieval_status", "retrieval_error",
    "lang", "fetch_seconds", "fetched_from_cache", "text_path", "route_used", "content_type",
    "celex_variant_used", "fulltext_support",
)
RAW_TEXTS = (
    "source", "celex", "celex_full", "celex_version", "celex_class", "celex_sector",
    "celex_sector_label", "celex_descriptor", "celex_descriptor_label", "celex_notes",
    "celex_variant_used", "fulltext_support", "text_source_url", "text_path", "content_type",
    "route_used", "retrieval_error", "url_fix",
)
RAW_LISTS = ("scopes", "query_langs", "query_term_groups")
RAW_OTHER = (
    "celex_valid", "celex_is_consolidated", "celex_is_corrigendum", "retrieval_status",
    "fetch_seconds", "fetched_from_cache",
)


def with_identifier(hits: DataFrame) -> DataFrame:
    """Usable hits with the identifier split into base and version, and a fixed address."""
    full = F.col("celex_full")
    return (
        hits.where(F.col("celex").isNotNull() & (F.col("celex") != ""))
        .withColumn("celex_full", celex.split_full(F.col("celex")))
        .withColumns(
            {
                "celex": celex.split_base(full),
                "celex_version": celex.split_version(full),
                "doc_key": F.concat(F.lit("EU:"), full),
                "url_fix": F.concat(F.lit(HIT_URL), full),
            }
        )
    )


def docs_from_hits(hits: DataFrame) -> DataFrame:
    """One row per identifier: first filled values, longest title, sorted scopes, languages and
    term groups, and the identifier's class."""
    keyed = with_identifier(hits)
    first = ("source", "celex", "celex_full", "celex_version", "url", "url_fix")
    docs = keyed.groupBy("doc_key").agg(
        F.min("ord").alias("ord"),
        *[first_filled(c) for c in first],
        longest("title"),
        first_filled("date"),
        sorted_values("scope", "scopes"),
        sorted_values("lang", "query_langs"),
        sorted_values("term_group", "query_term_groups"),
    )
    return celex.with_class(docs)


def filter_types(
    docs: DataFrame, mode: str = "all", exclude_descriptors: Iterable[str] = ()
) -> DataFrame:
    """Keep the identifier types of ``mode``; an unknown mode keeps all."""
    if "celex_class" not in docs.columns:
        docs = celex.with_class(docs)
    return docs.where(_of_type(mode, exclude_descriptors))


def types_kept(docs: DataFrame, asked: dict[str, tuple[str, Iterable[str]]]) -> DataFrame:
    """``filter_types`` for several requests (mode and excluded descriptors, by name) at once: a row
    for each request that keeps an identifier, named in ``mode``. Identifiers are classed once."""
    if "celex_class" not in docs.columns:
        docs = celex.with_class(docs)
    names = [F.when(_of_type(*request), F.lit(name)) for name, request in asked.items()]
    # the outer form keeps Spark from deriving a filter that would class each identifier twice
    kept = docs.select("*", F.explode_outer(F.array_compact(F.array(*names))).alias("mode"))
    return kept.where(F.col("mode").isNotNull())


def _of_type(mode: str, exclude_descriptors: Iterable[str] = ()) -> Column:
    mode = (mode or "all").strip().lower()
    kept = F.lit(True)
    if mode == "sector_3_only":
        kept = F.col("celex_sector") == "3"
    elif mode == "sector_0_and_3":
        kept = F.col("celex_sector").isin("0", "3")
    elif mode == "supported_only":
        kept = F.col("fulltext_support") == "supported"
    dropped = sorted({d.strip().upper() for d in exclude_descriptors if d.strip()})
    if dropped:
        kept &= ~F.upper(F.coalesce("celex_descriptor", F.lit(""))).isin(*dropped)
    return kept


def _filled(name: str, kind: str) -> Column:
    value = F.col(f"_t_{name}")
    return F.when(strip(value) != "", value) if kind == "string" else value


def join_fulltext(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """Left join of full texts by identifier, base and version. Where both tables have a column
    the text table's value wins if it is present."""
    keys = ["celex_full", "celex", "celex_version"]
    kinds = dict(texts.dtypes)
    cols = [c for c in FULLTEXT_COLUMNS if c in kinds]
    right = texts.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in cols])
    joined = docs.join(right, keys, "left")
    merged = {
        c: F.coalesce(_filled(c, kinds[c]), F.col(c)) if c in docs.columns else F.col(f"_t_{c}")
        for c in cols
    }
    return joined.withColumns(merged).drop(*[f"_t_{c}" for c in cols])


def to_records(docs: DataFrame, source_name: str, search_lang: str = "en") -> DataFrame:
    """Document columns and the raw record of EU documents."""
    docs = schemas.with_missing(
        docs,
        (*RAW_TEXTS, "title", "url", "lang", "date", "full_text_raw", "full_text_clean",
         "query_text", "retrieved_at"),
    )
    docs = schemas.with_missing(docs, RAW_LISTS, kind="array<string>")
    docs = schemas.with_missing(docs, RAW_OTHER)
    kinds = dict(docs.dtypes)
    t = lambda c: blank_to_null(F.col(c))
    link = F.coalesce(t("url_fix"), t("url"))
    captured = F.when(t("text_source_url") != "CACHE", t("text_source_url"))
    raw = F.to_json(
        F.struct(
            *[t(c).alias(c) for c in RAW_TEXTS],
            *[
                (parse_list(F.col(c)) if kinds[c] == "string" else F.filter(
                    F.transform(F.col(c), strip), lambda v: v != "")).alias(c)
                for c in RAW_LISTS
            ],
            *RAW_OTHER,
        )
    )
    return docs.withColumns(
        {
            "document_id": F.concat(
                F.lit(f"{source_name}:EU:"), text_or_empty(F.col("celex_full"))
            ),
            "source_document_id": t("celex_full"),
            "title": F.coalesce(t("title"), t("celex_full"), t("url_fix")),
            "document_type": F.coalesce(t("celex_descriptor_label"), F.lit(DEFAULT_TYPE)),
            "language": F.coalesce(t("lang"), F.lit(search_lang)),
            "jurisdiction": F.lit("European Union"),
            "publication_date": t("date"),
            "download_url": F.coalesce(captured, link),
            "full_text": F.coalesce(t("full_text_clean"), t("full_text_raw")),
            "content_path": t("text_path"),
            "raw_record": raw,
            "url": link,
        }
    )
