"""Composite jobs. Each takes tables of what was captured and returns documents."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lexcorpus import __version__
from lexcorpus import lookups as L
from lexcorpus.functions.text import text_or_empty
from lexcorpus.operators import cache, dedup, eu, harmonize, matching, nim, noneu, records
from lexcorpus.operators.skew import number_within
from lexcorpus.session import saved, written
from lexcorpus.sinks import writers

LOCAL_FIELDS = {
    "document_id": "id", "source_document_id": "source_document_id", "title": "title",
    "summary": "summary", "document_type": "document_type", "language": "language",
    "jurisdiction": "jurisdiction", "publication_date": "publication_date",
    "effective_date": "effective_date", "url": "url", "download_url": "download_url",
    "full_text": "full_text", "retrieved_at": "retrieved_at", "checksum": "checksum",
    "content_path": "content_path",
}


def eu_documents(
    hits: DataFrame,
    texts: DataFrame,
    source_name: str = "eu-eurlex",
    mode: str = "supported_only",
    search_lang: str = "en",
) -> DataFrame:
    """EU documents from search hits and captured full texts; texts bucketed by identifier, base and
    version stay where they are."""
    docs = eu.filter_types(eu.docs_from_hits(hits), mode)
    rows = eu.to_records(eu.join_fulltext(docs, texts), source_name, search_lang)
    return records.normalize(rows, source_name, "eurlex")


def eu_worklist(
    hits: DataFrame, log: DataFrame, files: DataFrame, mode: str = "supported_only",
    retry_failures: bool = True, min_chars: int = cache.MIN_CHARS,
) -> DataFrame:
    """EU documents of the hits whose full text is still to be fetched."""
    docs = eu.filter_types(eu.docs_from_hits(hits), mode)
    return cache.worklist(docs, cache.state(docs, log, files, min_chars), retry_failures)


def nim_documents(
    docs: DataFrame,
    measures: DataFrame,
    texts: DataFrame | None,
    log: DataFrame | None = None,
    source_name: str = "eu-nim",
    max_rows: int | None = None,
    keyed: bool = False,
) -> DataFrame:
    """National measures of the eligible acts among EU documents, as cleaned documents. ``texts``
    has one row per measure; without it the documents have no full text. ``keyed`` texts have the
    merge keys already, so buckets by them are used. ``max_rows`` caps the measures per act."""
    # one short column is stored, so that the documents' own plan ends here
    seeds = nim.seeds(written(nim.seed_references(docs))).select("celex")
    found = nim.with_merge_keys(measures).join(seeds, "celex", "left_semi")
    found = dedup.keep_first_narrow(found, ["celex", "national_measure_id", "nim_celex"])
    found = nim.enrich(found)
    if log is not None:
        found = nim.fill_from_cache(found, log)
    if max_rows is not None:
        found = dedup.cap_per_key(found, ["celex"], [F.col("ord")], max_rows)
    # one document per state and measure, before any text is joined
    number = F.coalesce(F.nullif("national_measure_id", F.lit("")), F.col("nim_celex"))
    found = found.withColumns({"number": number, "place": F.struct("celex", "ord")})
    found = dedup.keep_first_narrow(found, ["member_state_iso3", "number"], "place")
    found = found.drop("number", "place")
    rows = found if texts is None else nim.join_fulltext(found, texts, keyed)
    rows = nim.to_records(rows, source_name)
    return records.clean(records.normalize(rows, source_name, "eurlex-nim"))


def non_eu_rows(hits: DataFrame, texts: DataFrame, kept: bool = False) -> DataFrame:
    """Harmonized rows of one or more countries from search hits and captured texts. All else is
    joined first, so a text is moved once at most, and not at all if ``texts`` is bucketed by
    ``doc_key``. ``kept`` hits are stored and come from ``noneu.distinct_hits`` already."""
    # hits are short rows that are read three ways from here on, with few columns each: they are stored once
    kept = hits if kept else saved(noneu.distinct_hits(noneu.prepare_hits(hits)), "hits")
    docs = noneu.with_terms(noneu.one_row_per_doc(kept), noneu.docs_from_hits(kept), "_terms")
    full = noneu.fulltext_docs(docs, texts, ("_terms",))
    return harmonize.harmonize(full.withColumnRenamed("_terms", "matched_terms"))


def non_eu_documents(hits: DataFrame, texts: DataFrame, source_name: str, kept: bool = False) -> DataFrame:
    """Documents of one country from search hits and captured texts."""
    rows = noneu.to_records(non_eu_rows(hits, texts, kept), source_name)
    return records.normalize(rows, source_name, "non-eu")


def local_documents(
    rows: DataFrame, queries: Sequence[matching.Query], source_name: str
) -> DataFrame:
    """Documents from records of one source for every query they match. ``rows`` has the record
    columns, ``queries`` (a list or text) and the position ``ord``."""
    matched = matching.match_queries(rows, queries)
    place = matched.select("ord", "query_ord")
    place = number_within(place, ["query_ord"], [F.col("ord")], "result_index")
    matched = matched.join(place, ["ord", "query_ord"])
    provenance = ("query_ord", "query_text", "query_id", "query_origin", "query_source_path")
    mapped = records.require_mapped(
        records.map_fields(
            rows, LOCAL_FIELDS, {"source_document_id": F.col("id")}
        )
    )
    asked = matched.select("ord", *provenance, "result_index")
    named = mapped.withColumn(
        "document_id", F.concat(F.lit(f"{source_name}:"), F.col("document_id"))
    )
    return records.normalize(asked.join(named, "ord"), source_name, "local-file")


def record_build(
    sources: dict[str, DataFrame],
    queries: Sequence[matching.Query],
    dedup_fields: Sequence[str] = ("document_id",),
) -> DataFrame:
    """Documents of several record sources, first one kept per key in source, query and record
    order. Nothing is cleaned on this path."""
    found = [
        local_documents(rows, queries, name).withColumn(
            "place", F.struct(F.col("query_ord"), F.col("ord"))
        )
        for name, rows in sources.items()
    ]
    merged = dedup.merge_sources(found, "place")
    return dedup.keep_first_merged(merged, list(dedup_fields), "place").drop("place")


def observed(docs: DataFrame) -> tuple[DataFrame, Observation]:
    """``docs`` whose documents (``n``) and documents with text (``t``) are counted by the job that
    writes them. Spark counts each written part once, also where a task runs again."""
    seen = Observation()
    with_text = F.count_if(text_or_empty(F.col("full_text")) != "")
    return docs.observe(seen, F.count(F.lit(1)).alias("n"), with_text.alias("t")), seen


def store_parts(parts: dict[str, DataFrame], folder: str, seen: dict[str, Observation] | None = None) -> dict[str, DataFrame]:
    """Clean the documents of each jurisdiction and store them; returns the stored tables. ``seen``
    gets the counts of each."""
    stored = {}
    for code, docs in parts.items():
        cleaned = records.clean(docs, code).withColumn("jurisdiction_code", F.lit(code))
        path = f"{folder}/{code.lower()}"
        if seen is not None:
            cleaned, seen[code] = observed(cleaned)
        cleaned.write.mode("overwrite").parquet(path)
        stored[code] = docs.sparkSession.read.parquet(path)
    return stored


def merge_parts(stored: dict[str, DataFrame]) -> DataFrame:
    """One corpus from stored jurisdictions (Parquet files), in the given order; the first document
    of each id is kept. Documents of one position, as those of a hit with several captured texts,
    are told apart by their text and then by their place in the files, so one of them is kept."""
    text = F.xxhash64("full_text", "download_url", "content_path")
    row = (F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    placed = [docs.withColumn("place", F.struct("ord", text.alias("text"), *row)) for docs in stored.values()]
    merged = dedup.merge_sources(placed, "place")
    return dedup.keep_first_merged(merged, ["document_id"], "place").drop("place")


def corpus_build(parts: dict[str, DataFrame], folder: str) -> DataFrame:
    """Clean and store every jurisdiction's documents under ``folder``, and merge them."""
    return merge_parts(store_parts(parts, folder))


def run_corpus(
    parts: dict[str, DataFrame],
    out: str,
    query_terms: Sequence[str],
    measures: DataFrame | None = None,
    measure_texts: DataFrame | None = None,
    nim_max_rows: int | None = None,
    raw_hit_counts: dict[str, int] | None = None,
) -> dict:
    """Build and write a corpus: one dataset per jurisdiction, the final corpus, the duplicate
    audit, national measures if asked for, and the run manifest, which is returned. Its counts of
    documents are taken while they are written; no dataset is read again to be counted."""
    unknown = [c for c in parts if c not in L.JURISDICTION_LABELS]
    if unknown or not parts:
        raise ValueError(f"jurisdictions must be some of {L.JURISDICTION_ORDER}")
    if not query_terms or any(not t.strip() for t in query_terms):
        raise ValueError("query_terms must contain only non-empty strings")
    if nim_max_rows is not None and nim_max_rows <= 0:
        raise ValueError("nim_max_rows must be positive")
    spark = next(iter(parts.values())).sparkSession
    paths = {code: f"{out}/jurisdictions/{code.lower()}" for code in parts}
    seen: dict[str, Observation] = {}
    read = store_parts(parts, f"{out}/work", seen)
    for code, docs in read.items():
        writers.write_documents(docs, paths[code])
    per_part = {code: (int(o.get["n"]), int(o.get["t"])) for code, o in seen.items()}
    merged, whole = observed(merge_parts(read))
    merged.write.mode("overwrite").parquet(f"{out}/work/final")
    final = spark.read.parquet(f"{out}/work/final")
    writers.write_documents(final, f"{out}/final")
    placed = final.withColumn("ord", F.struct("part_ord", "ord"))
    audit_paths = writers.write_audit(placed, f"{out}/audit")
    kept = int(whole.get["n"])
    total = sum(n for n, _ in per_part.values())
    status, seeds, eligible, nim_count, nim_path = "not_requested", 0, 0, 0, None
    if measures is not None and "EU" not in parts:
        status = "skipped_eu_not_selected"
    elif measures is not None:
        eu_docs = read["EU"]
        references = nim.seed_references(eu_docs)
        seeds = references.where("reference is not null").select("reference").distinct().count()
        eligible = nim.seeds(references).count()
        status = "ran" if eligible else "skipped_no_eligible_eu_legal_acts"
        if eligible:
            docs, listed = observed(nim_documents(eu_docs, measures, measure_texts, max_rows=nim_max_rows))
            nim_path = writers.write_documents(docs, f"{out}/nim")
            nim_count = int(listed.get["n"])
    manifest = {
        "manifest_schema_version": "1.0",
        "schema_version": "1.0",
        "tool_version": __version__,
        "timestamp_utc": datetime.now(timezone.utc).isoformat().replace("+00:00", "Z"),
        "outputs_path": out,
        "query_terms": list(query_terms),
        "selected_jurisdictions": list(parts),
        "jurisdictions": [
            {
                "jurisdiction_code": code,
                "jurisdiction_label": L.JURISDICTION_LABELS[code],
                "intermediate_corpus_path": paths[code],
                "raw_hit_count": (raw_hit_counts or {}).get(code),
                "document_count": per_part.get(code, (0, 0))[0],
                "full_text_document_count": per_part.get(code, (0, 0))[1],
            }
            for code in parts
        ],
        "per_jurisdiction_output_paths": paths,
        "final_corpus_path": f"{out}/final",
        "duplicate_audit_paths": audit_paths,
        "merged_document_count": total,
        "final_document_count": kept,
        "duplicates_removed": total - kept,
        "include_nim": measures is not None,
        "include_nim_fulltext": measure_texts is not None,
        "nim_max_rows": nim_max_rows,
        "nim_status": status,
        "nim_seed_count": seeds,
        "nim_eligible_seed_count": eligible,
        "nim_document_count": nim_count,
        "nim_corpus_path": nim_path,
    }
    writers.write_manifest(spark, manifest, out)
    return manifest
