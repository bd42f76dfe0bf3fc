"""Writers. Tables become folders of part files; only one-row summaries become single files."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexcorpus import schemas
from lexcorpus.functions import nation
from lexcorpus.operators import audit

#: Values are written as they are, white space at their ends included.
CSV = {
    "header": True, "escape": '"', "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
METADATA = (*schemas.PROVENANCE, "_adapter_result_index", *schemas.BREADCRUMBS)


def as_json_document(docs: DataFrame) -> DataFrame:
    """Document columns in name order. ``raw_metadata`` is one object: provenance and notes with
    their own types, and the raw record nested beside them as JSON."""
    have = [c for c in METADATA if c in docs.columns]
    raw = F.col("raw_record") if "raw_record" in docs.columns else F.lit(None).cast("string")
    cols = {c: F.col(c) for c in schemas.TEXT_FIELDS if c in docs.columns}
    cols["raw_metadata"] = F.struct(
        *[F.col(c).alias(c) for c in have], F.try_parse_json(raw).alias("raw_record")
    )
    return docs.select(*[cols[c].alias(c) for c in sorted(cols)])


def write_documents(docs: DataFrame, path: str, fmt: str = "jsonl", by: str | None = None) -> str:
    """Write documents as JSON lines (nulls kept), CSV or Parquet, split by ``by`` if given."""
    if fmt not in ("jsonl", "csv", "parquet"):
        raise ValueError("fmt must be 'jsonl', 'csv' or 'parquet'")
    out = as_json_document(docs) if fmt == "jsonl" else docs
    writer = out.write.mode("overwrite")
    if by:
        writer = writer.partitionBy(by)
    if fmt == "jsonl":
        writer.json(path, ignoreNullFields=False)
    elif fmt == "csv":
        writer.csv(path, **CSV)
    else:
        writer.parquet(path)
    return path


def write_countries(rows: DataFrame, path: str, fmt: str = "csv") -> str:
    """One dataset per country of the row's source."""
    if fmt not in ("csv", "parquet"):
        raise ValueError("fmt must be 'csv' or 'parquet'")
    out = rows.withColumn("country", nation.country(F.col("source")))
    if fmt == "csv":
        lists = [c for c, t in out.dtypes if t.startswith("array")]
        out = out.withColumns({c: F.to_json(c) for c in lists}) if lists else out
    return write_documents(out, path, fmt, "country")


def write_audit(docs: DataFrame, folder: str) -> dict[str, str]:
    """Audit rows (CSV and JSON lines), the group summary (CSV) and its roll-ups (JSON)."""
    rows, summary = audit.duplicate_rows(docs), audit.group_summary(docs)
    paths = {
        "rows_csv": f"{folder}/likely_duplicates_csv",
        "rows_jsonl": f"{folder}/likely_duplicates_jsonl",
        "summary_csv": f"{folder}/duplicate_groups_summary_csv",
        "rollups": f"{folder}/duplicate_groups_summary",
    }
    rows.write.mode("overwrite").parquet(f"{folder}/_rows")
    rows = docs.sparkSession.read.parquet(f"{folder}/_rows")
    rows.write.mode("overwrite").csv(paths["rows_csv"], **CSV)
    rows.select(*sorted(rows.columns)).write.mode("overwrite").json(
        paths["rows_jsonl"], ignoreNullFields=False
    )
    summary.write.mode("overwrite").parquet(f"{folder}/_summary")
    summary = docs.sparkSession.read.parquet(f"{folder}/_summary")
    summary.select(*audit.SUMMARY_COLUMNS).write.mode("overwrite").csv(
        paths["summary_csv"], **CSV
    )
    audit.rollups(summary).write.mode("overwrite").parquet(f"{folder}/_rollups")
    counts = docs.sparkSession.read.parquet(f"{folder}/_rollups")
    parts = {
        "totals": audit.totals(docs),
        **{name: audit.rollup(counts, name) for name in audit.ROLLUPS},
        "top_largest_groups": audit.top_groups(summary, ("group_size",), 10).select(
            *audit.SUMMARY_COLUMNS),
        "top_review_candidates": audit.top_groups(
            summary, ("review_interest_score", "group_size"), 20).select(*audit.SUMMARY_COLUMNS),
    }
    for name, part in parts.items():
        part.write.mode("overwrite").json(f"{paths['rollups']}/{name}", ignoreNullFields=False)
    return paths


def write_manifest(spark: SparkSession, manifest: dict, folder: str) -> str:
    """The run's counts and paths as one JSON document."""
    body = json.dumps(manifest, ensure_ascii=False, indent=2, sort_keys=True)
    path = f"{folder}/run-manifest"
    spark.createDataFrame([(body,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


def replace_log(merged: DataFrame, folder: str, version: int) -> str:
    """Write a merged retrieval log beside the one it was read from; readers take the highest
    version. Nothing being read is ever overwritten."""
    path = f"{folder}/v={version:09d}"
    merged.write.mode("errorifexists").parquet(path)
    return path
