"""Composite jobs, from captured inputs to documents."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from lexcorpus import lookups as L
from lexcorpus.catalog import rules as R
from lexcorpus.catalog.cleaning import QUERY_SQL, QUERY_TERMS
from lexcorpus.catalog.foreign import EDGE, PREPARED, cleaned_title, keyed, title_year
from lexcorpus.catalog.identifiers import EU_DOCS, TEXTS
from lexcorpus.catalog.inputs import bucketed, load, run, stored
from lexcorpus.catalog.measures import MEASURE_TEXTS, enriched, measure_texts
from lexcorpus.catalog.registry import query
from lexcorpus.catalog.retrieval import STATE, _files
from lexcorpus.functions import nation
from lexcorpus.functions.text import blank_to_null
from lexcorpus.operators import cache, matching, noneu
from lexcorpus.plans import build
from lexcorpus.session import new_path

FIELDS = (
    "document_id", "source_name", "source_document_id", "title", "document_type", "language",
    "jurisdiction", "publication_date", "url", "download_url", "full_text", "content_path",
)

EU = f"""
{EU_DOCS}, t AS ({TEXTS}),
eu AS (SELECT 'eu-eurlex:EU:' || k.celex_full AS document_id, 'eu-eurlex' AS source_name,
  k.celex_full AS source_document_id, coalesce({R.blank('k.title')}, k.celex_full) AS title,
  coalesce({R.blank('k.celex_descriptor_label')}, 'eu_legal_document') AS document_type,
  coalesce({R.blank('t.lang')}, 'en') AS language, 'European Union' AS jurisdiction,
  {R.blank('k.date')} AS publication_date, k.url_fix AS url,
  coalesce(CASE WHEN {R.blank('t.text_source_url')} <> 'CACHE' THEN {R.blank('t.text_source_url')} END, k.url_fix) AS download_url,
  coalesce({R.blank('t.full_text_clean')}, {R.blank('t.full_text_raw')}) AS full_text, t.text_path AS content_path
  FROM k LEFT JOIN t USING (celex_full, celex, celex_version) WHERE k.fulltext_support = 'supported')
"""


def _eu(spark, sf):
    keys = ["celex_full", "celex", "celex_version"]
    texts = bucketed(spark, sf, "eu_texts", keys, lambda: run(spark, sf, TEXTS))
    return build.eu_documents(load(spark, sf, "hits"), texts)


@query("eu_build", f"WITH {EU} SELECT * FROM eu")
def eu_build(spark, sf):
    return _eu(spark, sf).select(*FIELDS)


@query(
    "eu_worklist",
    f"""WITH {EU_DOCS}, {STATE.replace('f AS (', 'ff AS (').replace('FULL JOIN f ', 'FULL JOIN ff ')
        .replace('FROM [[doc_list]]', 'FROM k').strip()}
SELECT celex_full FROM k WHERE fulltext_support = 'supported' AND celex_full NOT IN (
  SELECT celex_full FROM st WHERE cache_state = 'successful')""",
)
def eu_worklist(spark, sf):
    work = build.eu_worklist(
        load(spark, sf, "hits"), cache.conform(load(spark, sf, "log")), _files(spark, sf)
    )
    return work.select("celex_full")


@query(
    "nim_build",
    f"""
WITH {EU},
sd AS (SELECT DISTINCT {R.legal_act('source_document_id', True)} AS celex FROM eu),
fm AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY celex, national_measure_id, nim_celex ORDER BY ord) AS rn
  FROM [[measures]] WHERE celex IN (SELECT celex FROM sd WHERE celex IS NOT NULL)) x WHERE rn = 1),
{enriched('fm').strip()},
cp AS (SELECT *, row_number() OVER (PARTITION BY celex ORDER BY ord) AS cr FROM en),
nd AS (SELECT cp.ord, cp.celex, 'eu-nim:NIM:' || member_state_iso3 || ':' || national_measure_id AS document_id,
  national_measure_id AS source_document_id, {R.title("coalesce(nullif(cp.nim_title, ''), national_measure_id)")} AS title,
  {R.inline("'National implementation measure for ' || celex || ': ' || m.eu_act_title")} AS summary,
  lower(coalesce(nullif(tx.lang, ''), cp.nim_title_lang)) AS language,
  {R.jurisdiction("coalesce(nullif(cp.member_state_name, ''), member_state_iso3)")} AS jurisdiction,
  m.nim_date AS publication_date, coalesce(nullif(cp.eurlex_url, ''), cp.nim_resource_uri) AS url,
  coalesce(CASE WHEN text_source_url <> 'CACHE' THEN text_source_url END, nullif(cp.eurlex_url, ''), cp.nim_resource_uri) AS download_url,
  coalesce({R.blank('full_text_clean')}, full_text_raw) AS full_text
  FROM cp JOIN (SELECT ord, nim_date, eu_act_title FROM [[measures]]) m USING (ord)
  LEFT JOIN ({MEASURE_TEXTS}) tx USING (celex, nim_celex, national_measure_id))
SELECT * EXCLUDE (ord, celex, rn) FROM (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY celex, ord) AS rn FROM nd) x WHERE rn = 1
""",
)
def nim_build(spark, sf):
    docs = build.nim_documents(
        _eu(spark, sf), load(spark, sf, "measures"), measure_texts(spark, sf), keyed=True
    )
    return docs.select(
        "document_id", "source_document_id", "title", "summary", "language", "jurisdiction",
        "publication_date", "url", "download_url", "full_text",
    )


def _hits(spark, sf):
    """Distinct hits in one shape, stored once for the documents and their texts."""
    kept = lambda: noneu.distinct_hits(noneu.prepare_hits(load(spark, sf, "foreign_hits")))
    return spark.read.parquet(stored(spark, sf, "distinct_hits", kept))


def _captured(spark, sf):
    """Texts by document key, made from the keys of the hits."""
    key, size = F.col("doc_key"), F.length("doc_key")
    return noneu.one_row_per_doc(_hits(spark, sf)).select(
        "doc_key",
        F.when(size % 4 != 1, F.concat(F.lit("Text  of "), key, F.lit(" from 1999"))).alias("full_text"),
        F.when(size % 4 == 2, "waf_challenge").when(size % 4 == 3, "timeout").otherwise("")
        .alias("full_text_error"),
        F.concat(F.lit("https://t.example/"), key).alias("full_text_url"),
        F.lit("html").alias("full_text_format"),
    )


def _texts(spark, sf):
    return bucketed(spark, sf, "captured", ["doc_key"], lambda: _captured(spark, sf))


TEXT2 = "'Text  of ' || k1 || ' from 1999'"
GIVEN = cleaned_title("title", "jurisdiction")
FOREIGN = f"""
{PREPARED},
kp AS (SELECT * EXCLUDE rn FROM (SELECT h.*, f0.doc_url, row_number() OVER (PARTITION BY doc_id, term, h.source, h.url ORDER BY h.ord) AS rn
  FROM h JOIN (SELECT ord, doc_url FROM [[foreign_hits]]) f0 USING (ord)) x WHERE rn = 1),
{keyed('kp', 'ka').strip()},
kb AS (SELECT *, row_number() OVER (PARTITION BY doc_key ORDER BY ord) AS rn FROM ka),
kc AS (SELECT doc_key AS k1, min(ord) AS ord, max(CASE WHEN rn = 1 THEN source END) AS source, max(CASE WHEN rn = 1 THEN jurisdiction END) AS jurisdiction,
  max(CASE WHEN rn = 1 THEN url END) AS url0, arg_min(doc_url, ord) AS doc_url, arg_min(lang, ord) AS lang,
  coalesce(arg_min(title, {{'l': -length(title), 'o': ord}}) FILTER (WHERE {R.full('title')} <> ''), '') AS title FROM kb GROUP BY doc_key),
kd AS (SELECT * EXCLUDE url0, {R.canonical('url0')} AS url, CASE WHEN length(k1) % 4 <> 1 THEN {TEXT2} ELSE '' END AS body,
  CASE length(k1) % 4 WHEN 2 THEN 'waf_challenge' WHEN 3 THEN 'timeout' ELSE '' END AS err FROM kc),
{keyed('kd', 'ke').strip()},
kf AS (SELECT * REPLACE (CASE WHEN NOT {R.missing('title')} THEN {GIVEN}
    WHEN jurisdiction = 'United Kingdom' OR jurisdiction = 'New Zealand' THEN {EDGE.format(R.strip(R.collapse('body')))} ELSE '' END AS title) FROM ke),
kg AS (SELECT *, cast(coalesce(CASE WHEN source IN ('Australia', 'AUS', 'AU', 'Canada', 'CA', 'US') THEN {title_year('title')}
    ELSE nullif({R.cut('url', '/((?:18|19|20)[0-9]{2})/')}, '') END, {title_year('title')}, nullif({R.cut('url', '/((?:18|19|20)[0-9]{2})/')}, ''),
    {title_year('body')}) AS int) AS year FROM kf),
tm AS (SELECT doc_id, jurisdiction, {R.sorted_list('term')} AS matched_terms FROM kp GROUP BY doc_id, jurisdiction),
fd AS (SELECT kg.ord, kg.source, 'non-eu' || ':' || doc_key AS document_id, doc_key AS source_document_id,
  coalesce({R.blank('title')}, nullif(doc_key, '')) AS title, kg.jurisdiction,
  CASE WHEN lower(kg.lang) IN ('', 'nan', 'none', 'en', 'eng', 'english') THEN 'en' ELSE lower(kg.lang) END AS language,
  cast(year AS varchar) AS publication_date, {R.blank('url')} AS url, 'https://t.example/' || k1 AS download_url,
  {R.blank(R.collapse('body'))} AS full_text, nullif(matched_terms, '') AS matched_terms,
  CASE WHEN err = 'waf_challenge' THEN 'upstream_blocked' WHEN err <> '' THEN 'error' WHEN body <> '' THEN 'ok' ELSE 'missing_text' END AS retrieval_status
  FROM kg LEFT JOIN tm ON kg.doc_key = tm.doc_id)
"""


def _foreign(spark, sf):
    return build.non_eu_documents(_hits(spark, sf), _texts(spark, sf), "non-eu", kept=True)


@query(
    "non_eu_build",
    f"WITH {FOREIGN} SELECT * EXCLUDE (ord, source) FROM fd",
)
def non_eu_build(spark, sf):
    field = lambda k: F.get_json_object("raw_record", f"$.{k}")
    terms = F.array_join(F.from_json(field("matched_terms"), "array<string>"), " | ")
    return _foreign(spark, sf).select(
        "document_id", "source_document_id", "title", "jurisdiction", "language",
        "publication_date", "url", "download_url", "full_text",
        terms.alias("matched_terms"),
        field("retrieval_status").alias("retrieval_status"),
    )


# ---- records of local sources ----------------------------------------------------------

LOCAL = """
SELECT doc_id AS ord, concat(' r', cast(doc_id - doc_id % 2 AS string)) AS id, concat('Title ', md5(text)) AS title,
  CASE doc_id % 3 WHEN 0 THEN NULL ELSE lang END AS language, text AS full_text,
  CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'energy security' WHEN 2 THEN '["critical infrastructure"]' ELSE 'other' END AS queries
FROM [[documents]]
"""


@query(
    "record_build",
    f"""
WITH m AS (SELECT r.*, q.* FROM ({LOCAL}) r JOIN (VALUES {QUERY_SQL}) q(query_ord, query_text, query_id) ON r.queries IS NULL
  OR (r.queries = 'energy security' AND query_ord = 0) OR (starts_with(r.queries, '[') AND query_ord = 1)),
n AS (SELECT 0 AS part_ord, 'first' AS s, *, row_number() OVER (PARTITION BY query_ord ORDER BY ord) - 1 AS idx FROM m
  UNION ALL SELECT 1, 'second', *, row_number() OVER (PARTITION BY query_ord ORDER BY ord) - 1 FROM m),
d AS (SELECT *, s || ':' || trim(id) AS document_id FROM n)
SELECT part_ord, ord, document_id, s AS source_name, {R.blank('id')} AS source_document_id, {R.blank('title')} AS title, language,
  query_text AS query, query_id AS _query_id, idx AS _adapter_result_index, {R.blank('full_text')} AS full_text
FROM (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY part_ord, query_ord, ord) AS rn FROM d) t WHERE rn = 1
""",
)
def record_build(spark, sf):
    rows = run(spark, sf, LOCAL)
    docs = build.record_build(
        {"first": rows, "second": rows}, matching.inline_queries(QUERY_TERMS)
    )
    return docs.select(
        "part_ord", "ord", "document_id", "source_name", "source_document_id", "title", "language",
        "query", "_query_id", "_adapter_result_index", "full_text",
    )


# ---- one corpus ------------------------------------------------------------------------

#: The source names of each jurisdiction, as a list in SQL.
COUNTRIES = {
    "UK": "('UK')", "CA": "('CA', 'Canada')", "AUS": "('AUS')", "NZ": "('NZ')", "US": "('US')",
}
CORPUS_FOREIGN = " UNION ALL ".join(
    f"SELECT {i} AS part_ord, '{code}' AS jurisdiction_code, 'non-eu:' || source_document_id AS document_id, "
    f"title, language, '{L.JURISDICTION_LABELS[code]}' AS jurisdiction, publication_date, 'policy_document' AS document_type, "
    f"full_text, ord FROM fd WHERE source IN {names}"
    for i, (code, names) in enumerate(COUNTRIES.items(), start=1)
)
ROUTED = ", ".join(f"'{name}'" for names in COUNTRIES.values() for name in re.findall("'(.*?)'", names))


def _routed(spark, sf):
    source = F.get_json_object("raw_record", "$.source")
    code = nation.source_code(source)
    path = stored(
        spark, sf, "foreign", lambda: _foreign(spark, sf).withColumns({"source": source, "code": code})
    )
    return spark.read.parquet(path)


@query(
    "corpus_unrouted",
    f"WITH {FOREIGN} SELECT source, count(*) AS documents FROM fd WHERE source NOT IN ({ROUTED}) GROUP BY 1",
)
def corpus_unrouted(spark, sf):
    """Documents whose source belongs to no jurisdiction of a corpus. Only their sources are read, before
    any record is made."""
    rows = build.non_eu_rows(_hits(spark, sf), _texts(spark, sf), kept=True)
    source = blank_to_null(F.col("source"))
    rest = rows.select(source.alias("source")).where(~nation.source_code(source).isin(*COUNTRIES))
    return rest.groupBy("source").agg(F.count("*").alias("documents"))


@query(
    "corpus_build",
    f"""
WITH {EU}, {FOREIGN.strip()},
al AS (SELECT 0 AS part_ord, 'EU' AS jurisdiction_code, document_id, title, language, jurisdiction, publication_date, document_type,
    full_text, cast(0 AS bigint) AS ord FROM eu UNION ALL {CORPUS_FOREIGN}),
cl AS (SELECT part_ord, jurisdiction_code, document_id, ord, {R.title('title')} AS title, lower({R.inline('language')}) AS language, jurisdiction,
  {R.document_type('document_type')} AS document_type, {R.inline('publication_date')} AS d, {R.full_text('full_text')} AS full_text FROM al),
c2 AS (SELECT *, {R.date_candidate('d')} AS dc FROM cl)
SELECT jurisdiction_code, document_id, title, language, jurisdiction, document_type, full_text,
  {R.date_value('d', 'dc')} AS publication_date, {R.date_precision('dc')} AS date_precision
FROM (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY part_ord, ord) AS rn FROM c2) t WHERE rn = 1
""",
)
def corpus_build(spark, sf):
    foreign = _routed(spark, sf)
    parts = {"EU": _eu(spark, sf)}
    for code in COUNTRIES:
        parts[code] = foreign.where(F.col("code") == code).drop("code", "source")
    docs = build.corpus_build(parts, new_path(spark, "corpus"))
    return docs.select(
        "jurisdiction_code", "document_id", "title", "language", "jurisdiction", "document_type",
        "full_text", "publication_date", F.col("_publication_date_precision").alias("date_precision"),
    )
