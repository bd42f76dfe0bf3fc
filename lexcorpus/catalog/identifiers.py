"""Legal identifiers, EU documents, eligible acts."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexcorpus.catalog import rules as R
from lexcorpus.catalog.inputs import load, run
from lexcorpus.catalog.registry import query
from lexcorpus.functions import celex
from lexcorpus.operators import eu, nim, reports


@query("celex_extract", f"SELECT ord, raw_id, {R.token('raw_id')} AS token FROM [[ids]]")
def celex_extract(spark, sf):
    return load(spark, sf, "ids").select(
        "ord", "raw_id", celex.token(F.col("raw_id")).alias("token")
    )


@query(
    "celex_parse",
    f"SELECT ord, coalesce(raw_id, '') AS raw, {R.parsed(R.norm('raw_id'), '')} FROM [[ids]]",
)
def celex_parse(spark, sf):
    return celex.with_parsed(load(spark, sf, "ids"), "raw_id", "p").select("ord", "p.*")


@query("celex_classify", f"WITH {R.classified('[[ids]] i', 'raw_id', 'ord')} SELECT * FROM k")
def celex_classify(spark, sf):
    return celex.with_class(load(spark, sf, "ids"), "raw_id").select("ord", *celex.CLASS_FIELDS)


@query(
    "celex_counts",
    f"""WITH {R.classified('[[ids]] i', 'raw_id', 'ord')}
SELECT celex_sector, celex_descriptor, celex_class, count(*) AS rows FROM k GROUP BY ALL""",
)
def celex_counts(spark, sf):
    classed = celex.with_class(load(spark, sf, "ids"), "raw_id")
    return reports.value_counts(classed, ["celex_sector", "celex_descriptor", "celex_class"])


@query(
    "filter_celex",
    f"""WITH {R.classified('[[ids]] i', 'raw_id', 'ord')}
SELECT 'all' AS mode, ord, celex_full FROM k WHERE celex_descriptor NOT IN ('R', 'CJ')
UNION ALL SELECT 'sector_3_only', ord, celex_full FROM k WHERE celex_sector = '3'
UNION ALL SELECT 'sector_0_and_3', ord, celex_full FROM k WHERE celex_sector IN ('0', '3')
UNION ALL SELECT 'supported_only', ord, celex_full FROM k WHERE fulltext_support = 'supported'""",
)
def filter_celex(spark, sf):
    classed = celex.with_class(load(spark, sf, "ids"), "raw_id")
    asked = {"all": ("all", ["r ", "cj"])}
    asked |= {mode: (mode, ()) for mode in ("sector_3_only", "sector_0_and_3", "supported_only")}
    return eu.types_kept(classed, asked).select("mode", "ord", "celex_full")


@query(
    "nim_seeds",
    f"""SELECT celex, min(ord) AS ord FROM (SELECT ord, {R.legal_act('raw_id', True)} AS celex
  FROM [[ids]]) t WHERE celex IS NOT NULL GROUP BY celex""",
)
def nim_seeds(spark, sf):
    docs = load(spark, sf, "ids").withColumnRenamed("raw_id", "source_document_id")
    return nim.seeds(nim.seed_references(docs))


@query("legal_acts", f"SELECT ord, raw_id, {R.legal_act('raw_id')} AS act FROM [[ids]]")
def legal_acts(spark, sf):
    ids = load(spark, sf, "ids")
    return ids.select("ord", "raw_id", celex.legal_act(F.col("raw_id")).alias("act"))


ACTS = f"""
a AS (SELECT ord, {R.legal_act('celex', True)} AS celex, title, score FROM (
  SELECT ord, celex, title, CASE WHEN ord % 3 = 0 THEN NULL ELSE cast(ord % 101 AS double) END AS score
  FROM [[hits]]) t),
r AS (SELECT *, row_number() OVER (PARTITION BY celex
  ORDER BY length(coalesce(title, 'None')), score DESC NULLS LAST, ord) AS rn
  FROM a WHERE celex IS NOT NULL),
e AS (SELECT celex, title AS eu_act_title,
  CASE substr(celex, 6, 1) WHEN 'L' THEN 'Directive' WHEN 'R' THEN 'Regulation' ELSE 'Decision' END
    AS eu_act_type,
  substr(celex, 6, 1) AS descriptor, cast(substr(celex, 2, 4) AS int) AS year,
  score AS governance_gap_score FROM r WHERE rn = 1)
"""


def _scored(spark, sf):
    score = F.when(F.col("ord") % 3 == 0, None).otherwise((F.col("ord") % 101).cast("double"))
    return load(spark, sf, "hits").withColumn("governance_gap_score", score)


@query("eligible_acts", f"WITH {ACTS} SELECT * FROM e")
def eligible_acts(spark, sf):
    return nim.eligible_acts(_scored(spark, sf)).select(
        "celex", "eu_act_title", "eu_act_type", "descriptor", "year", "governance_gap_score"
    )


EU_DOCS = f"""
d0 AS (SELECT *, {R.full('celex')} AS cf FROM [[hits]] WHERE celex IS NOT NULL AND celex <> ''),
d AS (SELECT 'EU:' || cf AS doc_key, cf AS celex_in, {R.first_filled('source')} AS source,
  {R.first_filled('url')} AS url,
  'https://eur-lex.europa.eu/legal-content/EN/TXT/?uri=CELEX:' || cf AS url_fix,
  {R.longest('title')} AS title, {R.first_filled('date')} AS date,
  {R.sorted_list('scope')} AS scopes, {R.sorted_list('lang')} AS query_langs,
  {R.sorted_list('term_group')} AS query_term_groups FROM d0 GROUP BY cf),
{R.classified('d', 'celex_in', 'doc_key, source, url, url_fix, title, date, scopes, query_langs, query_term_groups').strip()}
"""


@query("eu_docs", f"WITH {EU_DOCS} SELECT * FROM k")
def eu_docs(spark, sf):
    docs = eu.docs_from_hits(load(spark, sf, "hits")).drop("ord")
    lists = ("scopes", "query_langs", "query_term_groups")
    return docs.withColumns({c: F.array_join(c, " | ") for c in lists})


@query(
    "lang_counts",
    "SELECT scope, lang, count(*) AS rows FROM [[hits]] GROUP BY scope, lang",
)
def lang_counts(spark, sf):
    return reports.value_counts(load(spark, sf, "hits"), ["scope", "lang"])


TEXTS = f"""
SELECT CASE WHEN ord % 4 = 3 THEN concat('unlisted', celex_full) ELSE celex_full END AS celex_full, split_part(celex_full, '-', 1) AS celex,
  CASE WHEN celex_full LIKE '%-%' THEN split_part(celex_full, '-', 2) ELSE '' END AS celex_version,
  CASE WHEN ord % 3 = 0 THEN 'CACHE' WHEN ord % 3 = 1 THEN ' ' ELSE url END AS text_source_url,
  concat('raw ', title) AS full_text_raw, CASE WHEN ord % 2 = 0 THEN ' ' ELSE concat(' clean ', title) END
    AS full_text_clean, 200 AS retrieval_status, lang, concat('/cache/', celex_full) AS text_path
FROM [[doc_list]]
"""


@query(
    "join_fulltext",
    f"""
WITH {EU_DOCS}, t AS ({TEXTS})
SELECT k.celex_full, 'eu:EU:' || k.celex_full AS document_id,
  coalesce(nullif(k.title, ''), k.celex_full) AS title,
  coalesce({R.blank('k.celex_descriptor_label')}, 'eu_legal_document') AS document_type,
  coalesce({R.blank('t.lang')}, 'en') AS language, nullif(k.date, '') AS publication_date,
  coalesce(CASE WHEN {R.blank('t.text_source_url')} <> 'CACHE' THEN {R.blank('t.text_source_url')} END, k.url_fix)
    AS download_url,
  coalesce({R.blank('t.full_text_clean')}, {R.blank('t.full_text_raw')}) AS full_text,
  t.retrieval_status, t.text_path AS content_path
FROM k LEFT JOIN t USING (celex_full, celex, celex_version)
""",
)
def join_fulltext(spark, sf):
    docs = eu.docs_from_hits(load(spark, sf, "hits"))
    texts = run(spark, sf, TEXTS)
    rows = eu.to_records(eu.join_fulltext(docs, texts), "eu")
    return rows.select(
        "celex_full", "document_id", "title", "document_type", "language", "publication_date",
        "download_url", "full_text", "retrieval_status", "content_path",
    )
