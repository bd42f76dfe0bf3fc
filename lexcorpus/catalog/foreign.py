"""Documents of jurisdictions outside the EU."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexcorpus import lookups as L
from lexcorpus.catalog import rules as R
from lexcorpus.catalog.inputs import act, load, run
from lexcorpus.catalog.registry import query
from lexcorpus.functions import nation
from lexcorpus.operators import harmonize as corpus
from lexcorpus.operators import noneu, reports
from lexcorpus.sources import records as sources

EDGE = "trim({}, ' -|:' || chr(10) || chr(9))"


def keyed(table: str, dk: str = "dk") -> str:
    """CTE chain ending in ``dk``: rows of ``table`` with column ``doc_key``."""
    seg = "list_filter(string_split(pth, '/'), lambda x: x <> '')"
    own = R.sub("replace(replace(pth, '.html', ''), '.htm', '')", "^/+|/+$")
    own = f"trim({R.sub(f'replace({own}, {R.q('/')}, {R.q('_')})', '_+', '_')}, '_')"
    num = r"(?i)\b(SOR|SI|CRC|TR)[/-]([0-9]{4})[-/]([0-9]+)\b"
    numf = r"(?i)\b(DORS|TR)[/-]([0-9]{4})[-/]([0-9]+)\b"
    numbered = lambda p: (
        f"CASE WHEN {R.has('nm', p)} THEN upper({R.cut('nm', p, 1)}) || '_' || {R.cut('nm', p, 2)} || '_' || "
        f"cast(cast({R.cut('nm', p, 3)} AS bigint) AS varchar) END"
    )
    return f"""
{dk}0 AS (SELECT *, {R.mapped(R.full('source'), L.SOURCE_COUNTRY, f"CASE WHEN {R.full('source')} = '' THEN 'UNKNOWN' ELSE {R.full('source')} END")} AS land,
  coalesce(nullif(url, ''), nullif(doc_url, ''), '') AS lnk, coalesce(title, '') AS nm FROM {table}),
{dk}1 AS (SELECT *, {R.canonical('lnk')} AS canon FROM {dk}0),
{dk}2 AS (SELECT *, {R.cut('canon', '^https://[^/]*(.*)$')} AS pth FROM {dk}1),
{dk}3 AS (SELECT *, {seg} AS sg, {own} AS own FROM {dk}2),
{dk} AS (SELECT * EXCLUDE (land, lnk, nm, pth, sg, own), CASE
  WHEN land = 'US' THEN coalesce(nullif({R.cut('lnk', '(?i)/v4/documents/([^/?#]+)')}, ''), own)
  WHEN land = 'Australia' THEN coalesce(nullif(upper({R.cut('lnk', '(?i)/([CFL][0-9]{4}[A-Z][0-9]{5,})')}), ''), own)
  WHEN land IN ('UK', 'United Kingdom') THEN CASE WHEN len(sg) >= 3 THEN sg[1] || '_' || sg[2] || '_' || sg[3] ELSE own END
  WHEN land = 'Canada' THEN coalesce({numbered(num)}, {numbered(numf)},
    CASE WHEN contains(canon, 'laws-lois.justice.gc.ca') AND len(sg) >= 3 AND lower(sg[2]) IN ('acts', 'regulations')
      THEN lower(sg[2]) || '_' || replace(replace(lower(sg[3]), '.', '_'), '-', '_') ELSE own END)
  WHEN land = 'New Zealand' THEN CASE WHEN len(sg) >= 4 AND sg[1] IN ('act', 'regulation', 'bill')
      AND {R.has('sg[3]', '^(18|19|20)[0-9]{2}$')}
    THEN sg[1] || '_' || sg[3] || '_' || coalesce(nullif(ltrim(sg[4], '0'), ''), '0') ELSE own END
  ELSE land || ':' || canon END AS doc_key FROM {dk}3)"""


def cleaned_title(t: str, land: str) -> str:
    x = f"coalesce({R.strip(R.collapse(t))}, '')"
    uk = R.sub(x, "^(?i) *PDF +", "")
    uk = R.sub(R.sub(uk, r"(?i) *- *Legislation\.gov\.uk *$"), r"(?i) *Legislation\.gov\.uk *$")
    ca = R.sub(x, r" ?: ?[A-Z][A-Za-z0-9-]*/[A-Za-z0-9-]*[0-9]{4}[A-Z-]* ?$")
    ca = R.sub(ca, r" [A-Z][A-Za-z0-9-]*/[A-Za-z0-9-]*[0-9]{4}[A-Z-]* ?$")
    ca = R.sub(R.sub(ca, r"(?i) ?: ?[A-Z][A-Za-z0-9/-]*PDF ?$"), r"(?i) [A-Z][A-Za-z0-9/-]*PDF ?$")
    return (
        f"CASE WHEN {R.missing(t)} THEN '' WHEN {land} = 'United Kingdom' THEN {EDGE.format(uk)} "
        f"WHEN {land} = 'Canada' THEN {EDGE.format(ca)} ELSE {R.strip(t)} END"
    )


def title_year(t: str) -> str:
    runs = f"list_filter(regexp_extract_all({t}, '[0-9]+'), lambda n: length(n) = 4 AND left(n, 2) IN ('18', '19', '20'))"
    return f"({runs})[-1]"


def year(source: str, t: str, u: str) -> str:
    by_url = f"nullif({R.cut(u, '/((?:18|19|20)[0-9]{2})/')}, '')"
    return (
        f"cast(coalesce(CASE WHEN {source} IN ('Australia', 'AUS', 'AU', 'Canada', 'CA', 'US') "
        f"THEN {title_year(t)} ELSE {by_url} END, {title_year(t)}, {by_url}) AS int)"
    )


PREPARED = f"""
h0 AS (SELECT ord, source, jurisdiction, coalesce(term, '') AS term, coalesce(lang, 'en') AS lang, doc_url, title,
  CASE WHEN {R.full('url')} <> '' THEN url ELSE coalesce(doc_url, '') END AS url FROM [[foreign_hits]]),
{keyed('h0').strip()},
h1 AS (SELECT * EXCLUDE (title), {cleaned_title('title', 'jurisdiction')} AS title FROM dk),
h AS (SELECT ord, source, jurisdiction, jurisdiction AS country, term, lang, url, title, doc_key AS doc_id,
  url AS doc_uid, {year('source', 'title', 'url')} AS year FROM h1)
"""


@query(
    "doc_key",
    f"WITH {keyed('[[foreign_hits]] f')} SELECT ord, source, url, canon AS canonical_url, doc_key FROM dk",
)
def doc_key(spark, sf):
    hits = load(spark, sf, "foreign_hits")
    link = F.coalesce(F.nullif("url", F.lit("")), F.nullif("doc_url", F.lit("")), F.lit(""))
    hits = hits.withColumn("link", link)
    keyed_hits = nation.with_document_key(hits, "link", "doc_key")
    return nation.with_canonical(keyed_hits, "link", "canonical_url").select(
        "ord", "source", "url", "canonical_url", "doc_key"
    )


@query(
    "infer_title",
    f"SELECT ord, {cleaned_title('title', 'jurisdiction')} AS title FROM [[foreign_hits]]",
)
def infer_title(spark, sf):
    return load(spark, sf, "foreign_hits").select(
        "ord", nation.title(F.col("title"), F.col("jurisdiction")).alias("title")
    )


@query(
    "infer_year",
    f"""WITH {PREPARED} SELECT ord, doc_id, title, year, cast(year AS varchar) AS date FROM h""",
)
def infer_year(spark, sf):
    return noneu.prepare_hits(load(spark, sf, "foreign_hits")).select(
        "ord", "doc_id", "title", "year", "date"
    )


TEXT_TITLES = """
SELECT doc_id AS ord, CASE doc_id % 3 WHEN 0 THEN NULL WHEN 1 THEN 'None' ELSE 'Given' END AS title,
  CASE doc_id % 4 WHEN 0 THEN 'United Kingdom' WHEN 1 THEN 'New Zealand' WHEN 2 THEN 'Canada' ELSE 'UK' END AS jurisdiction,
  concat('  PDF Marine | Act  ', cast(1800 + doc_id % 300 AS string), ' - Legislation.gov.uk Skip to main content ', text) AS body
FROM [[documents]]
"""


@query(
    "title_from_text",
    f"""
SELECT ord, CASE WHEN title = 'Given' THEN 'Given'
  WHEN jurisdiction = 'United Kingdom' THEN 'Marine | Act ' || cast(1800 + ord % 300 AS varchar)
  WHEN jurisdiction = 'New Zealand' THEN 'PDF Marine | Act ' || cast(1800 + ord % 300 AS varchar) || ' - Legislation.gov.uk'
  ELSE '' END AS title,
  CASE WHEN 1800 + ord % 300 < 2100 THEN 1800 + cast(ord % 300 AS int) END AS year
FROM ({TEXT_TITLES}) t
""",
)
def title_from_text(spark, sf):
    rows = run(spark, sf, TEXT_TITLES).withColumn("source", F.lit("UK")).withColumn("url", F.lit(""))
    rows = rows.withColumn(
        "title", nation.title(F.col("title"), F.col("jurisdiction"), F.col("body"))
    )
    return nation.with_year(rows, "year", "body").select("ord", "title", "year")


@query(
    "non_eu_docs",
    f"""
WITH {PREPARED}
SELECT doc_id, jurisdiction, {R.first_filled('country')} AS country, {R.first_filled('doc_uid')} AS doc_uid,
  {R.longest('title')} AS title, {R.first_filled('url')} AS url, {R.first_filled('lang')} AS lang,
  {R.first_filled('source')} AS source, {R.first_filled('cast(year AS varchar)')} AS date,
  {R.first_filled('cast(year AS varchar)')} AS year, {R.sorted_list('term')} AS matched_terms
FROM h GROUP BY doc_id, jurisdiction
""",
)
def non_eu_docs(spark, sf):
    docs = noneu.docs_from_hits(noneu.prepare_hits(load(spark, sf, "foreign_hits")))
    return docs.withColumn("matched_terms", F.array_join("matched_terms", " | "))


ONE_ROW = f"""
{keyed('[[foreign_hits]] f').strip()},
o1 AS (SELECT *, row_number() OVER (PARTITION BY doc_key ORDER BY ord) AS rn FROM dk),
o AS (SELECT doc_key, min(ord) AS ord, max(CASE WHEN rn = 1 THEN source END) AS source,
  max(CASE WHEN rn = 1 THEN jurisdiction END) AS jurisdiction, max(CASE WHEN rn = 1 THEN url END) AS url0,
  coalesce(arg_min(title, {{'l': -length(title), 'o': ord}}) FILTER (WHERE {R.full('title')} <> ''), '') AS title,
  arg_min(lang, ord) FILTER (WHERE lang <> '') AS lang, arg_min(doc_url, ord) FILTER (WHERE doc_url <> '') AS doc_url,
  coalesce(array_to_string(list_sort(list(DISTINCT term) FILTER (WHERE term <> '')), ' | '), '') AS matched_terms,
  array_to_string(list_sort(list(DISTINCT source) FILTER (WHERE source <> '')), ' | ') AS sources
  FROM o1 GROUP BY doc_key)
"""


@query(
    "one_row_per_doc",
    f"""WITH {ONE_ROW} SELECT doc_key, ord, source, jurisdiction, {R.canonical('url0')} AS url, title, lang,
  doc_url, matched_terms, sources FROM o""",
)
def one_row_per_doc(spark, sf):
    docs = noneu.one_row_per_doc(load(spark, sf, "foreign_hits"))
    return docs.select(
        "doc_key", "ord", "source", "jurisdiction", "url", "title", "lang", "doc_url",
        F.array_join("matched_terms", " | ").alias("matched_terms"),
        F.array_join("sources", " | ").alias("sources"),
    )


@query(
    "distinct_hits",
    f"""WITH {PREPARED} SELECT ord, doc_id, term, source FROM (SELECT *, row_number() OVER (
  PARTITION BY doc_id, term, source, url ORDER BY ord) AS rn FROM h) t WHERE rn = 1""",
)
def distinct_hits(spark, sf):
    hits = noneu.distinct_hits(noneu.prepare_hits(load(spark, sf, "foreign_hits")))
    return hits.select("ord", "doc_id", "term", "source")


@query(
    "hit_summary",
    f"""WITH {PREPARED} SELECT country, count(*) AS rows, count(DISTINCT doc_id) AS documents,
  count(DISTINCT term) AS matched_terms, count(CASE WHEN {R.missing('title')} THEN 1 END) AS missing_title,
  count(CASE WHEN year IS NULL THEN 1 END) AS missing_year FROM h GROUP BY country""",
)
def hit_summary(spark, sf):
    return reports.hit_summary(noneu.prepare_hits(load(spark, sf, "foreign_hits")))


COVERED = """
SELECT ord, jurisdiction AS country, title, CASE WHEN full_text IS NULL THEN 0 ELSE length(full_text) END AS text_len,
  coalesce(full_text <> '', false) AS has_text, CASE WHEN ord % 4 = 0 THEN NULL ELSE 2000 END AS year FROM [[docs]]
"""


@query(
    "coverage",
    f"""SELECT country, count(*) AS documents, count(CASE WHEN has_text THEN 1 END) AS with_text,
  round(avg(text_len), 4) AS mean_text_len, count(CASE WHEN {R.missing('title')} THEN 1 END) AS missing_title,
  count(CASE WHEN year IS NULL THEN 1 END) AS missing_year,
  round(count(CASE WHEN has_text THEN 1 END) / count(*), 6) AS text_coverage
FROM ({COVERED}) t GROUP BY country""",
)
def coverage(spark, sf):
    return reports.coverage(run(spark, sf, COVERED)).withColumns(
        {"mean_text_len": F.round("mean_text_len", 4), "text_coverage": F.round("text_coverage", 6)}
    )


LINKS = """
SELECT ord, concat(url, CASE ord % 6 WHEN 0 THEN '/tbl/csv/x' WHEN 1 THEN '/data.GeoJSON' WHEN 2 THEN '?f=a.csv&b'
  WHEN 3 THEN '/download/y/z.zip' ELSE '' END) AS url, source FROM [[foreign_hits]]
"""


@query(
    "data_file_urls",
    f"""SELECT ord, url, ({R.has("lower(regexp_extract(url, '^[A-Za-z]*:?/*[^/?#]*([^?#]*)', 1))", "[.](" + "|".join(L.DATA_FILE_EXTENSIONS) + ")$")}
  OR {R.has('lower(url)', r"/tbl/csv/|/download/.*\.(csv|zip|xlsx|xls|tsv)\b|\.(csv|zip|xlsx|xls|tsv)\b")}) AS is_data_file
FROM ({LINKS}) t""",
)
def data_file_urls(spark, sf):
    return run(spark, sf, LINKS).select(
        "ord", "url", nation.is_data_file(F.col("url")).alias("is_data_file")
    )


SEG = "list_filter(string_split(regexp_extract(url, '^[A-Za-z]*:?/*[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '')"


@query(
    "legislation_urls",
    f"""
SELECT ord, {R.has('url', r"(?i)https?://(www\.)?legislation\.govt\.nz/(act|regulation|bill)/")} AS nz_act,
  coalesce(len({SEG}) >= 3 AND lower(({SEG})[1]) IN ('eng', 'fra') AND lower(({SEG})[2]) IN ('acts', 'regulations'), false) AS ca_act,
  CASE WHEN contains(lower(url), '//laws-lois.justice.gc.ca/') AND len({SEG}) >= 3 AND lower(({SEG})[1]) IN ('eng', 'fra')
    AND lower(({SEG})[2]) IN ('acts', 'regulations')
    THEN 'https://laws-lois.justice.gc.ca/' || array_to_string(({SEG})[1:3], '/') || '/' ELSE '' END AS ca_act_url,
  CASE WHEN len({SEG}) >= 3 THEN 'https://' || {R.cut('url', '^[A-Za-z]+://([^/?#]*)')} || '/' || array_to_string(({SEG})[1:3], '/') || '/contents'
    ELSE 'https://' || coalesce(nullif({R.cut('url', '^[A-Za-z]+://([^/?#]*)')}, ''), 'www.legislation.gov.uk') ||
      CASE WHEN {R.has('url', '^[A-Za-z]+://[^/]*/')} THEN {R.cut('url', '^[A-Za-z]+://[^/?#]*([^?#]*)')} ELSE '/' || url END END AS uk_contents,
  CASE WHEN {R.has('lower(source)', 'aus')} THEN 'AUS' WHEN source = 'UK' THEN 'UK'
    WHEN lower(source) IN ('ca', 'canada') THEN 'CA' WHEN source = 'NZ' THEN 'NZ' WHEN source = 'US' THEN 'US' ELSE source END AS code
FROM [[foreign_hits]]
""",
)
def legislation_urls(spark, sf):
    url = F.col("url")
    return load(spark, sf, "foreign_hits").select(
        "ord",
        nation.is_nz_act(url).alias("nz_act"),
        F.coalesce(nation.is_canada_act(url), F.lit(False)).alias("ca_act"),
        nation.canada_act_url(url).alias("ca_act_url"),
        nation.uk_contents_url(url).alias("uk_contents"),
        nation.source_code(F.col("source")).alias("code"),
    )


PAGE_TEXTS = """
SELECT doc_id AS ord, concat('Home Search Search Canada.ca Search Menu Main Menu ', 'Passer au contenu principal ',
  'RÃ©sumÃ© â€™x ', text, '  Government of Canada Publications - Canada.ca ',
  CASE WHEN doc_id % 2 = 0 THEN 'About this site Government of Canada and more' ELSE 'end' END) AS body
FROM [[documents]]
"""


@query(
    "canada_page_text",
    f"""SELECT ord, {R.strip(R.collapse("'Résumé ''x ' || text || '  ' || CASE WHEN ord % 2 = 0 THEN '' ELSE ' end' END"))} AS text
FROM (SELECT doc_id AS ord, text FROM documents) t""",
)
def canada_page_text(spark, sf):
    return run(spark, sf, PAGE_TEXTS).select("ord", nation.canada_page_text(F.col("body")).alias("text"))


ACT_TEXTS = """
SELECT doc_id AS ord, 'Oceans Act' AS title,
  concat('Justice Laws Skip to main content Oceans Act menu Consolidated Acts ', repeat('menu ', 20),
    'Oceans Act &amp; Schedules Preamble ', text) AS body
FROM [[documents]]
"""


@query(
    "canada_act_text",
    f"""SELECT doc_id AS ord, {R.strip(R.collapse("'Oceans Act & Schedules Preamble ' || text"))} AS text FROM documents""",
)
def canada_act_text(spark, sf):
    return run(spark, sf, ACT_TEXTS).select(
        "ord", nation.canada_act_text(F.col("body"), F.col("title")).alias("text")
    )


@query(
    "fill_from_texts",
    f"""
WITH {PREPARED}, t AS (SELECT * FROM (SELECT doc_id, title AS ft, cast(year AS varchar) AS fd, year AS fy,
  row_number() OVER (PARTITION BY doc_id ORDER BY ord) AS rn
  FROM (SELECT * REPLACE (CASE WHEN ord % 3 = 0 THEN doc_id ELSE 'unlisted ' || doc_id END AS doc_id) FROM h) y) x WHERE rn = 1)
SELECT ord, doc_id, CASE WHEN {R.missing('title')} THEN ft ELSE title END AS title,
  CASE WHEN {R.missing('cast(year AS varchar)')} THEN fd ELSE cast(year AS varchar) END AS date,
  coalesce(year, fy) AS year FROM h LEFT JOIN t USING (doc_id)
""",
)
def fill_from_texts(spark, sf):
    hits = noneu.prepare_hits(load(spark, sf, "foreign_hits"))
    known = F.when(F.col("ord") % 3 == 0, F.col("doc_id")).otherwise(
        F.concat(F.lit("unlisted "), F.col("doc_id"))
    )
    texts = hits.withColumns({"doc_id": known, "retrieval_status": F.lit("ok")})
    return noneu.fill_from_texts(hits, texts).select("ord", "doc_id", "title", "date", "year")


# ---- one corpus ------------------------------------------------------------------------

EU_ROWS = """
SELECT ord, source_document_id AS celex_full, url, title, language AS lang, full_text AS full_text_clean FROM [[docs]]
"""
OTHER_ROWS = """
SELECT ord, jurisdiction, url AS doc_uid, concat('k', cast(ord % 500 AS string)) AS doc_id, title, language AS lang,
  full_text AS full_text_clean FROM [[docs]]
"""


def _lang(x: str) -> str:
    y = f"lower({R.full(x)})"
    return f"CASE WHEN {y} IN ('', 'nan', 'none', 'en', 'eng', 'english') THEN 'en' ELSE {y} END"


HARMONIZED = f"""
e0 AS (SELECT 0 AS part_ord, ord, 'European Union' AS jurisdiction, {_lang('lang')} AS lang, coalesce(celex_full, '') AS celex_full,
  coalesce(nullif(url, ''), celex_full, '') AS doc_uid, coalesce(nullif(celex_full, ''), nullif(url, ''), '') AS doc_id,
  coalesce(nullif(coalesce(nullif(url, ''), celex_full, ''), ''), NULL) AS celex, coalesce(title, '') AS title,
  coalesce({R.strip(R.collapse('full_text_clean'))}, '') AS body FROM ({EU_ROWS}) a),
n0 AS (SELECT 1 AS part_ord, ord, jurisdiction, {_lang('lang')} AS lang, '' AS celex_full, coalesce(doc_uid, '') AS doc_uid, doc_id,
  nullif(doc_uid, '') AS celex, coalesce(title, '') AS title, coalesce({R.strip(R.collapse('full_text_clean'))}, '') AS body
  FROM ({OTHER_ROWS}) b),
hz AS (SELECT *, length(body) AS text_len, body <> '' AS has_text, lower(body) AS text_norm, body = '' AS text_missing,
  CASE WHEN jurisdiction = 'European Union' THEN 'EU EUR-Lex retrieval' ELSE 'Non-EU jurisdiction retrieval' END AS retrieval_track
  FROM (SELECT * FROM e0 UNION ALL SELECT * FROM n0) u)
"""


@query(
    "harmonize",
    f"""WITH {HARMONIZED} SELECT part_ord, ord, lang, celex_full, doc_uid, doc_id, title, body AS full_text_clean,
  cast(text_len AS int) AS text_len, has_text, text_norm, text_missing, retrieval_track FROM hz""",
)
def harmonize(spark, sf):
    eu = corpus.harmonize(run(spark, sf, EU_ROWS), "European Union").withColumn("part_ord", F.lit(0))
    other = corpus.harmonize(run(spark, sf, OTHER_ROWS)).withColumn("part_ord", F.lit(1))
    return eu.unionByName(other, allowMissingColumns=True).select(
        "part_ord", "ord", "lang", "celex_full", "doc_uid", "doc_id", "title", "full_text_clean",
        "text_len", "has_text", "text_norm", "text_missing", "retrieval_track",
    )


CORPUS = f"""
{HARMONIZED},
cz AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY part_ord, ord) AS rn FROM hz) t WHERE rn = 1)
"""


@query(
    "construct_corpora",
    f"""
WITH {CORPUS}, p AS (SELECT *, {R.parsed(R.norm('celex'), 'p_')} FROM cz)
SELECT part_ord, ord, doc_id, lang = 'en' AS is_english, p_sector AS celex_sector, p_year AS analysis_year,
  p_descriptor AS celex_doc_type_code, p_descriptor_label AS celex_doc_type_label,
  p_document_number AS celex_document_number FROM p
""",
)
def construct_corpora(spark, sf):
    docs = corpus.construct(run(spark, sf, EU_ROWS), run(spark, sf, OTHER_ROWS))
    return docs.select(
        "part_ord", "ord", "doc_id", (F.col("lang") == "en").alias("is_english"), "celex_sector",
        "analysis_year", "celex_doc_type_code", "celex_doc_type_label", "celex_document_number",
    )


@query(
    "english_subset",
    f"WITH {CORPUS} SELECT retrieval_track, text_missing, count(*) AS documents FROM cz WHERE lang = 'en' GROUP BY ALL",
)
def english_subset(spark, sf):
    docs = corpus.english(corpus.construct(run(spark, sf, EU_ROWS), run(spark, sf, OTHER_ROWS)))
    return docs.groupBy("retrieval_track", "text_missing").agg(F.count("*").alias("documents"))


CACHED = f"""
SELECT ord, CASE WHEN ord % 2 = 0 THEN 'European Union' ELSE jurisdiction END AS jurisdiction,
  concat('https://x.example/?uri=', {act('ord')}, CASE WHEN ord % 10 = 0 THEN '-20200101' ELSE '' END) AS doc_uid,
  full_text AS full_text_clean FROM [[docs]]
"""


@query(
    "corpus_part",
    f"""
SELECT true AS is_eu, ord, {act('ord')} || CASE WHEN ord % 10 = 0 THEN '-20200101' ELSE '' END AS celex_full, {act('ord')} AS celex,
  {R.full('full_text_clean')} = '' AS text_missing, cast(length(coalesce(full_text_clean, '')) AS int) AS text_len
FROM ({CACHED}) t WHERE jurisdiction = 'European Union'
UNION ALL SELECT false, ord, NULL, NULL, NULL, NULL FROM ({CACHED}) t WHERE jurisdiction IS DISTINCT FROM 'European Union'
""",
)
def corpus_part(spark, sf):
    docs = run(spark, sf, CACHED)
    eu = sources.corpus_part(docs, eu=True).withColumn("is_eu", F.lit(True))
    other = sources.corpus_part(docs, eu=False).withColumn("is_eu", F.lit(False))
    return eu.unionByName(other, allowMissingColumns=True).select(
        "is_eu", "ord", "celex_full", "celex", "text_missing", "text_len"
    )
