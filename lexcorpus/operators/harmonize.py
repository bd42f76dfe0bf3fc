"""One corpus shape over EU and other documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexcorpus import schemas
from lexcorpus.functions import celex, text
from lexcorpus.functions.text import empty
from lexcorpus.operators.dedup import keep_first_merged, merge_sources


def harmonize(df: DataFrame, jurisdiction: str | None = None) -> DataFrame:
    """Keys, language, text columns and track labels of a document table."""
    have = set(df.columns)
    if jurisdiction is not None:
        df = df.withColumn("jurisdiction", F.lit(jurisdiction))
    df = schemas.with_missing(
        df, ("jurisdiction", "lang", "celex_full", "doc_id", "title", "full_text_clean")
    )
    filled = lambda c: F.nullif(F.col(c).cast("string"), empty())
    if "raw_text" not in have:
        df = df.withColumn("raw_text", F.coalesce("full_text_clean", empty()))
    full = F.coalesce(F.col("celex_full").cast("string"), empty())
    uid = filled("doc_uid" if "doc_uid" in have else "url") if have & {"doc_uid", "url"} else None
    uid = F.coalesce(uid, full) if uid is not None else full
    body = F.col("full_text_clean") if "full_text_clean" in have else F.col("raw_text")
    df = df.withColumns({"celex_full": full, "doc_uid": uid, "full_text_clean": text.single_line(body)})
    own = filled("celex") if "celex" in have else filled("doc_uid")
    df = df.withColumn("celex", F.coalesce(own, celex.token(F.col("doc_uid"))))
    is_eu = F.coalesce(F.col("jurisdiction") == "European Union", F.lit(False))
    clean = F.col("full_text_clean")
    return df.withColumns(
        {
            "lang": text.corpus_language(F.col("lang")),
            "doc_id": F.coalesce(
                filled("doc_id"), filled("celex_full"), filled("celex"), F.col("doc_uid")
            ),
            "title": F.coalesce("title", empty()),
            "text_len": F.length(clean),
            "has_text": clean != "",
            "text_norm": F.lower(clean),
            "text_missing": clean == "",
            "retrieval_track": F.when(is_eu, "EU EUR-Lex retrieval").otherwise(
                "Non-EU jurisdiction retrieval"),
            "raw_cache_note": F.when(is_eu, "from 01A EUR-Lex retrieval layer").otherwise(
                "from 01C non-EU retrieval layer"),
        }
    )


def construct(eu_docs: DataFrame, other_docs: DataFrame) -> DataFrame:
    """All documents once, EU first, with the parts of their identifiers."""
    both = merge_sources([harmonize(eu_docs, "European Union"), harmonize(other_docs)])
    parsed = celex.with_parsed(keep_first_merged(both, ["doc_id"]), "celex", "_c")
    return parsed.withColumns(
        {
            "celex_sector": F.col("_c.sector"),
            "celex_sector_label": F.col("_c.sector_label"),
            "celex_year": F.col("_c.year"),
            "celex_doc_type_code": F.col("_c.descriptor"),
            "celex_doc_type_label": F.col("_c.descriptor_label"),
            "celex_document_number": F.col("_c.document_number"),
            "analysis_year": F.col("_c.year"),
        }
    ).drop("_c")


def english(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("lang") == "en")
