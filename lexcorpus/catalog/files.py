"""Writers, readers and streams: what is written to a fresh folder and read back from it."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexcorpus import lookups as L
from lexcorpus.catalog import rules as R
from lexcorpus.catalog.builds import COUNTRIES, EU, FOREIGN, CORPUS_FOREIGN, _eu, _routed
from lexcorpus.catalog.duplicates import SUMMARY
from lexcorpus.catalog.inputs import load, run
from lexcorpus.catalog.registry import query
from lexcorpus.plans import build
from lexcorpus.session import new_path
from lexcorpus.sinks import writers
from lexcorpus.sources import records as sources
from lexcorpus.streaming import ingest

KEPT = ("ord", "document_id", "source_name", "title", "jurisdiction", "publication_date", "url")

RAW = """
SELECT ord, document_id, source_name, title, jurisdiction, publication_date, url, full_text,
  concat('q', cast(ord % 7 AS string)) AS _query_id, ord % 11 AS _adapter_result_index,
  concat('{"place": ', cast(ord AS string), ', "of": {"source": "', source_name, '"}}') AS raw_record
FROM [[docs]]
"""


@query(
    "jsonl_documents",
    f"""SELECT document_id, title, full_text, _query_id, _adapter_result_index, ord AS place, source_name AS of_source
FROM ({RAW}) t""",
)
def jsonl_documents(spark, sf):
    """Documents written as JSON lines, with their provenance and the raw record as one object."""
    path = writers.write_documents(run(spark, sf, RAW), new_path(spark, "jsonl"))
    meta = "struct<_query_id: string, _adapter_result_index: bigint, raw_record: struct<place: bigint, of: struct<source: string>>>"
    rows = spark.read.json(path, schema=f"document_id string, title string, full_text string, raw_metadata {meta}")
    return rows.select(
        "document_id", "title", "full_text", "raw_metadata._query_id", "raw_metadata._adapter_result_index",
        F.col("raw_metadata.raw_record.place").alias("place"), F.col("raw_metadata.raw_record.of.source").alias("of_source"),
    )



@query(
    "audit_files",
    f"""WITH {SUMMARY}
SELECT 'group' AS kind, signal, group_size AS n, review_rank AS place FROM s
UNION ALL SELECT 'rows', signal, group_size * count(*), NULL FROM s GROUP BY signal, group_size
UNION ALL SELECT 'signal', signal, count(*), NULL FROM s GROUP BY signal""",
)
def audit_files(spark, sf):
    """The audit's row, summary and roll-up files."""
    paths = writers.write_audit(load(spark, sf, "docs"), new_path(spark, "audit"))
    none = F.lit(None).cast("long").alias("place")
    groups = spark.read.csv(paths["summary_csv"], header=True, escape='"', multiLine=True)
    rows = spark.read.json(paths["rows_jsonl"], schema="signal string, group_size bigint")
    signals = spark.read.json(f"{paths['rollups']}/groups_by_signal", schema="signal string, group_count bigint")
    return (
        groups.select(F.lit("group").alias("kind"), "signal", F.col("group_size").cast("long").alias("n"), F.col("review_rank").cast("long").alias("place"))
        .unionAll(rows.groupBy("signal", "group_size").agg(F.count("*").alias("n")).select(F.lit("rows"), "signal", "n", none))
        .unionAll(signals.select(F.lit("signal"), "signal", "group_count", none))
    )


MANIFEST = "struct<jurisdiction_code: string, raw_hit_count: bigint, document_count: bigint, full_text_document_count: bigint>"


@query(
    "run_manifest",
    f"""
WITH {EU}, {FOREIGN.strip()},
al AS (SELECT 0 AS part_ord, 'EU' AS jurisdiction_code, document_id, title, language, jurisdiction, publication_date, document_type,
    full_text, cast(0 AS bigint) AS ord FROM eu UNION ALL {CORPUS_FOREIGN}),
cl AS (SELECT jurisdiction_code, document_id, {R.full_text('full_text')} AS full_text FROM al)
SELECT jurisdiction_code, cast(NULL AS bigint) AS raw_hit_count, count(*) AS document_count,
  count(CASE WHEN full_text <> '' THEN 1 END) AS full_text_document_count,
  (SELECT count(*) FROM cl) AS merged_document_count, (SELECT count(DISTINCT document_id) FROM cl) AS final_document_count
FROM cl GROUP BY 1
""",
)
def run_manifest(spark, sf):
    """The manifest of a whole run, read back from its file."""
    foreign = _routed(spark, sf)
    parts = {"EU": _eu(spark, sf)}
    for code in COUNTRIES:
        parts[code] = foreign.where(F.col("code") == code).drop("code", "source")
    out = new_path(spark, "run")
    build.run_corpus(parts, out, ["nature restoration"])
    body = spark.read.text(f"{out}/run-manifest", wholetext=True)
    schema = f"jurisdictions array<{MANIFEST}>, merged_document_count bigint, final_document_count bigint"
    read = body.select(F.from_json("value", schema).alias("m"))
    return read.select(F.inline("m.jurisdictions"), "m.merged_document_count", "m.final_document_count")


HITS = "SELECT ord, source, url, title FROM [[foreign_hits]]"
COUNTRY_SQL = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in L.SOURCE_COUNTRY.items())


@query(
    "country_files",
    f"""SELECT CASE source {COUNTRY_SQL} ELSE source END AS country, ord, url, coalesce(title, '') AS title
FROM ({HITS}) t""",
)
def country_files(spark, sf):
    """One dataset for each country, as CSV."""
    path = writers.write_countries(run(spark, sf, HITS), new_path(spark, "countries"))
    rows = spark.read.csv(path, header=True, escape='"', multiLine=True, schema="ord bigint, source string, url string, title string, country string")
    return rows.select("country", "ord", F.coalesce("url", F.lit("")).alias("url"), F.coalesce("title", F.lit("")).alias("title"))


CACHED = """
SELECT ord, concat('CELEX:', celex, ' ', cast(ord AS string)) AS doc_uid, CASE WHEN ord % 3 = 0 THEN 'Canada' ELSE 'European Union' END AS jurisdiction,
  concat('Text "', title, '", of ', chr(10), ' line two') AS full_text_clean
FROM (SELECT ord, celex, coalesce(title, 'x') AS title FROM [[hits]] WHERE celex IS NOT NULL AND celex <> '') h
"""


@query(
    "cached_corpus",
    f"""SELECT ord, jurisdiction, full_text_clean, CASE WHEN jurisdiction = 'European Union' THEN
  coalesce({R.token('doc_uid')}, '') END AS celex_full,
  CASE WHEN jurisdiction = 'European Union' THEN length(full_text_clean) END AS text_len FROM ({CACHED}) t""",
)
def cached_corpus(spark, sf):
    """A cached corpus as CSV, read with its schema and split into its EU and other rows."""
    path = new_path(spark, "cached")
    run(spark, sf, CACHED).write.csv(path, header=True, escape='"')
    schema = T.StructType().add("ord", "long").add("doc_uid", "string").add("jurisdiction", "string").add("full_text_clean", "string")
    docs = sources.read_table(spark, path, schema)
    eu = sources.corpus_part(docs, True).select("ord", "jurisdiction", "full_text_clean", "celex_full", F.col("text_len").cast("long"))
    other = sources.corpus_part(docs, False).select("ord", "jurisdiction", "full_text_clean")
    return eu.unionByName(other, allowMissingColumns=True)


FILES = """
SELECT concat('/cache/', replace(replace(celex_full, '(', '%28'), ')', '%29'), '.txt') AS path, concat(full_text_raw, ' ', url) AS value, celex_full
FROM (SELECT celex_full, concat('raw ', title) AS full_text_raw, url FROM [[doc_list]]) t
"""


@query(
    "text_file_cache",
    f"""SELECT celex_full, split_part(celex_full, '-', 1) AS celex,
  CASE WHEN celex_full LIKE '%-%' THEN split_part(celex_full, '-', 2) ELSE '' END AS celex_version,
  length(value)::BIGINT AS file_text_len, path AS text_path, true AS file_exists FROM ({FILES}) t""",
)
def text_file_cache(spark, sf):
    """Cached text files by the id in their name."""
    files = sources.eu_files(sources.text_files(run(spark, sf, FILES).select("value", "path")))
    return files.withColumn("file_text_len", F.col("file_text_len").cast("long"))


#: Texts of one written file.
FILE_TEXTS = 500


@query(
    "text_files_read",
    "SELECT count(*) AS lines, sum(length(replace(text, chr(10), ' ')))::BIGINT AS characters FROM documents",
)
def text_files_read(spark, sf):
    """Text files written and read whole: every line and character of them."""
    path = new_path(spark, "texts")
    docs = load(spark, sf, "documents").select(F.translate("text", "\n", " ").alias("value"))
    # a file is one row when it is read, so files must not grow with the table
    docs.write.option("maxRecordsPerFile", FILE_TEXTS).text(path)
    lines = sources.read_text_files(spark, path).select(F.explode(F.split(F.rtrim("value", F.lit("\n")), "\n")).alias("line"))
    return lines.agg(F.count("*").alias("lines"), F.sum(F.length("line")).alias("characters"))


@query("document_stream", "SELECT DISTINCT document_id FROM [[docs]]")
def document_stream(spark, sf):
    """Documents cleaned and kept once as their files arrive, until all have been read."""
    path, out, state = (new_path(spark, n) for n in ("arriving", "arrived", "offsets"))
    load(spark, sf, "docs").select(*[c for c in KEPT if c != "ord"]).write.json(path)
    stream = ingest.clean_documents(ingest.read_documents(spark, path))
    started = stream.select("document_id").writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
    started.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("document_id string").parquet(out)


ATTEMPTS = "SELECT ord, celex_full, lang, text_len, timestamp FROM [[log]]"


@query(
    "log_stream",
    """SELECT celex_full, lang, max(ord) AS ord FROM (
  SELECT ord, celex_full, coalesce(lang, '') AS lang FROM [[log]]) t GROUP BY 1, 2""",
)
def log_stream(spark, sf):
    """Attempts added as they arrive; the newest of each document and language."""
    path, out, state = (new_path(spark, n) for n in ("attempts", "log", "offsets"))
    log = load(spark, sf, "log")
    log.write.parquet(path)
    started = ingest.keep_log(spark.readStream.schema(log.schema).parquet(path), out).option("checkpointLocation", state)
    started.trigger(availableNow=True).start().awaitTermination()
    return ingest.newest_log(spark, out).select("celex_full", "lang", "ord")


@query(
    "log_compacted",
    """SELECT celex_full, lang, max(ord) AS ord FROM (
  SELECT ord, celex_full, coalesce(lang, '') AS lang FROM [[log]]) t GROUP BY 1, 2""",
)
def log_compacted(spark, sf):
    """The newest attempts after several batches were merged and the last one ran again."""
    out, log = new_path(spark, "merged-log"), load(spark, sf, "log")
    last = log.agg(F.max("ord")).first()[0] or 0
    part = lambda n: log.where(F.floor(F.col("ord") * 3 / F.lit(last + 1)) == n)
    for n in range(3):
        ingest.add_to_log(part(n), out, n)
    ingest.compact_log(spark, out, most=1)
    ingest.add_to_log(part(2), out, 2)
    return ingest.newest_log(spark, out).select("celex_full", "lang", "ord")
