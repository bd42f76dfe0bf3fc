"""National measures: languages, metadata, caps, roll-ups, retrieval state."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexcorpus import lookups as L
from lexcorpus.catalog import rules as R
from lexcorpus.catalog.inputs import act, bucketed, load, pick, run
from lexcorpus.catalog.registry import query
from lexcorpus.functions import langs
from lexcorpus.operators import cache, dedup, nim, reports

MEANS = ("mean_gap_score", "mean_ambition_score", "mean_design_score")

ACT_SUMMARY = """
a AS (SELECT celex, eu_act_title, eu_act_type, year,
  count(DISTINCT nullif(member_state_name, '')) AS member_states_with_measures,
  count(DISTINCT national_measure_id) AS total_national_measures,
  avg(governance_gap_score) AS mean_gap_score, avg(ecological_ambition_score) AS mean_ambition_score,
  avg(design_specificity_score) AS mean_design_score
  FROM [[measures]] GROUP BY celex, eu_act_title, eu_act_type, year)
"""


@query(
    "act_summary",
    f"WITH {ACT_SUMMARY} SELECT * REPLACE ({', '.join(f'round({m}, 4) AS {m}' for m in MEANS)}) FROM a",
)
def act_summary(spark, sf):
    summary = nim.act_summary(load(spark, sf, "measures"))
    return summary.withColumns({m: F.round(m, 4) for m in MEANS})


STATES = ", ".join(f"({R.q(v)})" for v in sorted(set(L.MEMBER_STATES.values())))


@query(
    "country_summary",
    f"""
WITH c AS (SELECT member_state_name AS member_state, count(DISTINCT celex) AS a,
  count(DISTINCT national_measure_id) AS m FROM [[measures]] GROUP BY 1)
SELECT s.member_state, coalesce(a, 0) AS acts_with_measures, coalesce(m, 0) AS total_national_measures,
  round(CASE WHEN a IS NULL THEN 0.0 ELSE cast(m AS double) / greatest(a, 1) END, 6) AS average_measures_per_act
FROM (VALUES {STATES}) s(member_state) LEFT JOIN c USING (member_state)
""",
)
def country_summary(spark, sf):
    rows = nim.country_summary(load(spark, sf, "measures"))
    return rows.withColumn("average_measures_per_act", F.round("average_measures_per_act", 6))


TOP = """
t1 AS (SELECT *, row_number() OVER (PARTITION BY celex ORDER BY total_national_measures DESC,
  member_states_with_measures DESC, eu_act_title, eu_act_type, year) AS variant FROM a),
t AS (SELECT *, row_number() OVER (ORDER BY total_national_measures DESC,
  member_states_with_measures DESC, celex) AS act_rank FROM t1 WHERE variant = 1
  ORDER BY act_rank LIMIT 10)
"""


@query(
    "country_act_matrix",
    f"""
WITH {ACT_SUMMARY}, {TOP},
c AS (SELECT member_state_name AS member_state, celex, coalesce(eu_act_title, celex) AS act_display,
  count(DISTINCT national_measure_id) AS measures
  FROM (SELECT celex, member_state_name, national_measure_id FROM [[measures]]) m JOIN t USING (celex)
  WHERE member_state_name IN (SELECT * FROM (VALUES {STATES}) s) GROUP BY ALL),
p AS (SELECT celex, cast(row_number() OVER (ORDER BY sum(measures) DESC, celex) AS int) AS act_place FROM c GROUP BY celex)
SELECT * FROM c JOIN p USING (celex) WHERE measures > 0
""",
)
def country_act_matrix(spark, sf):
    return nim.country_act_matrix(load(spark, sf, "measures"))


@query(
    "country_act_table",
    f"""
WITH {ACT_SUMMARY}, {TOP},
c AS (SELECT member_state_name AS member_state, celex, count(DISTINCT national_measure_id) AS measures
  FROM (SELECT celex, member_state_name, national_measure_id FROM [[measures]]) m JOIN t USING (celex)
  WHERE member_state_name IN (SELECT * FROM (VALUES {STATES}) s) GROUP BY ALL),
p AS (SELECT celex, row_number() OVER (ORDER BY sum(measures) DESC, celex) AS place FROM c GROUP BY celex)
SELECT member_state, {", ".join(f"cast(coalesce(sum(measures) FILTER (WHERE place = {i}), 0) AS bigint) AS act_{i}" for i in range(1, 11))}
FROM c JOIN p USING (celex) GROUP BY member_state HAVING sum(measures) > 0
""",
)
def country_act_table(spark, sf):
    """The matrix of member states and top acts with a column for each act."""
    return nim.country_act_table(load(spark, sf, "measures"), named=False)


@query(
    "top_acts",
    f"""WITH {ACT_SUMMARY}, {TOP}
SELECT cast(act_rank AS int) AS act_rank, celex, coalesce(eu_act_title, celex) AS act_display FROM t""",
)
def top_acts(spark, sf):
    return nim.top_acts(load(spark, sf, "measures"))


@query(
    "nim_country",
    """SELECT celex, member_state_name AS member_state, count(*) AS number_of_national_measures
FROM [[measures]] GROUP BY 1, 2""",
)
def nim_country(spark, sf):
    return nim.country_counts(load(spark, sf, "measures"))


@query(
    "cap_per_seed",
    """SELECT celex, ord, nim_celex FROM (SELECT *, row_number() OVER (PARTITION BY celex ORDER BY ord) AS rn
  FROM [[measures]]) t WHERE rn <= 5""",
)
def cap_per_seed(spark, sf):
    capped = dedup.cap_per_key(load(spark, sf, "measures"), ["celex"], [F.col("ord")], 5)
    return capped.select("celex", "ord", "nim_celex")


@query(
    "large_cap_per_state",
    """SELECT member_state_iso3, ord FROM (SELECT *, row_number() OVER (PARTITION BY member_state_iso3 ORDER BY ord) AS rn
  FROM [[measures]]) t WHERE rn <= 2000""",
)
def large_cap_per_state(spark, sf):
    """A cap past Spark's own per-task trimming."""
    capped = dedup.cap_per_key(
        load(spark, sf, "measures"), ["member_state_iso3"], [F.col("ord")], 2000
    )
    return capped.select("member_state_iso3", "ord")


L2 = R.mapped("{}", {k: v.lower() for k, v in L.LANG3_TO_LANG2.items()})


def _opt(x: str) -> str:
    return f"CASE WHEN lower({R.full(x)}) = 'nan' THEN '' ELSE {R.full(x)} END"


def _langs2(x: str) -> str:
    """Comma list of two-letter codes in order; the inputs never repeat a language."""
    inner = f"list_transform(string_split(lower({_opt(x)}), ','), lambda t: {L2.format('trim(t)')})"
    return f"list_filter({inner}, lambda t: t IS NOT NULL)"


def enriched(table: str) -> str:
    """CTE chain ending in ``en``: the measures of ``table`` with languages and their sources."""
    return f"""
m0 AS (SELECT *, {_langs2('available_expr_langs3')} AS l2, lower({_opt('nim_title_lang')}) AS tl,
  lower({R.cut('eurlex_url', '/legal-content/([A-Za-z]{2})/')}) AS ul,
  {R.mapped('member_state_iso3', L.MEMBER_STATE_MAIN_LANG)} AS home FROM {table}),
m1 AS (SELECT *, CASE WHEN ul <> '' AND ul <> 'en' THEN {{'l': ul, 's': 'url'}}
  WHEN len(l2) > 0 THEN {{'l': l2[1], 's': 'metadata'}}
  WHEN length(tl) = 2 THEN {{'l': tl, 's': 'metadata'}}
  WHEN length(tl) = 3 THEN {{'l': coalesce({L2.format('tl')}, 'en'), 's': 'metadata'}}
  WHEN home IS NOT NULL THEN {{'l': home, 's': 'country_fallback'}}
  WHEN ul <> '' THEN {{'l': ul, 's': 'url'}} ELSE {{'l': 'en', 's': 'default_en'}} END AS f FROM m0),
en AS (SELECT ord, celex, nim_celex, national_measure_id, member_state_iso3, member_state_name, eurlex_url,
  {_opt('nim_title')} AS nim_title, f.l AS lang_detected, f.s AS lang_source,
  array_to_string(list_transform(l2, lambda t: upper(t)), ',') AS available_langs,
  coalesce(nullif(CASE WHEN length(tl) = 2 THEN tl ELSE coalesce({L2.format('tl')}, '') END, ''), f.l) AS nim_title_lang,
  'http://publications.europa.eu/resource/nim/' || national_measure_id AS nim_resource_uri FROM m1)
"""


ENRICHED = enriched("[[measures]]")


@query(
    "detect_lang",
    f"""WITH {ENRICHED} SELECT ord, nim_title, lang_detected, lang_source, coalesce(available_langs, '') AS available_langs,
  nim_title_lang, nim_resource_uri FROM en""",
)
def detect_lang(spark, sf):
    return nim.enrich(load(spark, sf, "measures")).select(
        "ord", "nim_title", "lang_detected", "lang_source", "available_langs", "nim_title_lang",
        "nim_resource_uri",
    )


@query(
    "nim_lang_counts",
    f"WITH {ENRICHED} SELECT lang_detected, lang_source, count(*) AS rows FROM en GROUP BY ALL",
)
def nim_lang_counts(spark, sf):
    return reports.value_counts(
        nim.enrich(load(spark, sf, "measures")), ["lang_detected", "lang_source"]
    )


TRY = ", ".join(f"({R.q(k)}, {R.q(v)})" for k, v in L.MEMBER_STATE_TRY_LANGS.items())


@query(
    "lang_candidates",
    f"""
WITH x AS (SELECT ord, member_state_iso3, list_transform({_langs2('available_expr_langs3')}, lambda t: upper(t)) ||
    string_split(v.t, ',') || ['EN'] AS c FROM [[measures]] JOIN (VALUES {TRY}) v(k, t) ON member_state_iso3 = v.k),
y AS (SELECT ord, unnest(c) AS l, generate_subscripts(c, 1) AS p FROM x),
z AS (SELECT ord, l, min(p) AS p FROM y GROUP BY ord, l)
SELECT ord, string_agg(l, ',' ORDER BY p) AS try_langs FROM z GROUP BY ord
""",
)
def lang_candidates(spark, sf):
    return load(spark, sf, "measures").select(
        "ord",
        F.array_join(
            langs.try_langs(F.col("available_expr_langs3"), F.col("member_state_iso3")), ","
        ).alias("try_langs"),
    )


DOC_LANGS = f"""
SELECT ord, {pick('ord', "'en'", "'FR '", "''", "'de'", "'eng'")} AS lang,
  {pick('ord', "array('fr', 'EN')", "array('eng', ' de ')", "CAST(NULL AS array<string>)")} AS query_langs,
  {pick('ord', "'en'", "'fr'", "'de'", "'it'")} AS chosen FROM [[docs]]
"""
DUCK_DOC_LANGS = DOC_LANGS.replace("array('fr', 'EN')", "['fr', 'EN']").replace(
    "array('eng', ' de ')", "['eng', ' de ']").replace("CAST(NULL AS array<string>)", "[]::VARCHAR[]")


@query(
    "text_lang_source",
    f"""
WITH d AS (SELECT ord, lower(trim(lang)) AS own, list_transform(query_langs, lambda q: lower(trim(q))) AS a, chosen
  FROM ({DUCK_DOC_LANGS}) t),
c AS (SELECT ord, ['en'] || list_transform(a, lambda q: CASE WHEN q = 'eng' THEN 'en' ELSE q END) ||
  [CASE WHEN own IN ('', 'en', 'eng') THEN 'en' ELSE own END] AS c FROM d),
u AS (SELECT ord, unnest(c) AS l, generate_subscripts(c, 1) AS p FROM c),
v AS (SELECT ord, string_agg(l, ',' ORDER BY p) AS candidates FROM (SELECT ord, l, min(p) AS p FROM u GROUP BY ord, l) w GROUP BY ord)
SELECT ord, candidates, CASE WHEN chosen = 'en' THEN CASE WHEN own IN ('', 'en', 'eng')
    AND len(list_filter(a, lambda q: q NOT IN ('en', 'eng'))) = 0 THEN 'english_default' ELSE 'english_fallback' END
  WHEN own = chosen THEN 'job_language' WHEN list_contains(a, chosen) THEN 'query_language'
  ELSE 'retry_sequence' END AS lang_source FROM d JOIN v USING (ord)
""",
)
def text_lang_source(spark, sf):
    rows = run(spark, sf, DOC_LANGS)
    return rows.select(
        "ord",
        F.array_join(langs.doc_candidates(F.col("query_langs"), F.col("lang")), ",").alias("candidates"),
        langs.text_lang_source(F.col("chosen"), F.col("lang"), F.col("query_langs")).alias("lang_source"),
    )


KEYS = f"""
SELECT ord, CASE ord % 4 WHEN 0 THEN concat(' id/', national_measure_id, ' é') ELSE ' ' END AS national_measure_id,
  CASE WHEN ord % 4 = 3 THEN '' ELSE nim_celex END AS nim_celex,
  CASE WHEN ord % 4 = 2 THEN '' ELSE member_state_iso3 END AS member_state_iso3, member_state_name FROM [[measures]]
"""


@query(
    "nim_cache_key",
    f"""
SELECT ord, CASE WHEN {R.full('national_measure_id')} <> '' THEN {R.sub(R.full('national_measure_id'), '[^A-Za-z0-9._-]+', '_')}
  WHEN nim_celex <> '' AND member_state_iso3 <> '' THEN nim_celex || '_' || member_state_iso3
  WHEN nim_celex <> '' THEN nim_celex ELSE 'by content' END AS cache_key FROM ({KEYS}) t
""",
)
def nim_cache_key(spark, sf):
    keyed = cache.measure_keys(run(spark, sf, KEYS))
    by_content = F.col("cache_key").rlike("^[0-9a-f]{24}$")
    return keyed.select(
        "ord", F.when(by_content, "by content").otherwise(F.col("cache_key")).alias("cache_key")
    )


NIM_LOG = f"""
SELECT event_id AS ord, cast(user_id * 3 AS string) AS cache_key, concat('7', substr({act('user_id')}, 2, 20), 'DNK_', cast(user_id AS string)) AS nim_celex,
  {pick('event_id', "'da'", "'en'")} AS lang, CASE WHEN event_id % 3 = 0 THEN repeat('y', cast(event_id % 900 AS int)) ELSE '' END AS text,
  CASE event_type WHEN 'click' THEN '200' WHEN 'error' THEN '404' ELSE '0' END AS retrieval_status,
  CASE event_type WHEN 'error' THEN 'HTTP 404' ELSE '' END AS retrieval_error,
  CASE event_id % 5 WHEN 0 THEN '0' ELSE cast(cast(floor(value * 10) AS int) AS string) END AS text_len,
  cast(ts AS string) AS timestamp, concat('https://t.example/', cast(event_id AS string)) AS source_url,
  {pick('event_id', "''", "'Cached title'", "'nan'")} AS nim_title, concat('Page ', cast(event_id AS string)) AS page_title,
  {pick('event_id', "'da'", "''")} AS page_title_lang, 'DA,EN' AS available_languages FROM [[events]]
"""
NIM_CONFORMED = f"""
nc AS (SELECT ord, cache_key, nim_celex, lang, coalesce(cast(retrieval_status AS int), 0) AS retrieval_status, retrieval_error,
  CASE WHEN cast(text_len AS int) <= 0 AND length(text) > 0 THEN cast(length(text) AS int) ELSE cast(text_len AS int) END AS text_len,
  timestamp, source_url, nim_title, page_title, page_title_lang, available_languages FROM ({NIM_LOG}) t)
"""


@query(
    "nim_cache_conform",
    f"""WITH {NIM_CONFORMED} SELECT ord, cache_key, nim_celex, lang, retrieval_status, retrieval_error, text_len, timestamp FROM nc""",
)
def nim_cache_conform(spark, sf):
    return cache.conform_nim(run(spark, sf, NIM_LOG)).select(
        "ord", "cache_key", "nim_celex", "lang", "retrieval_status", "retrieval_error", "text_len",
        "timestamp",
    )


@query(
    "nim_cache_upsert",
    f"""WITH {NIM_CONFORMED}, u AS (SELECT 0 AS batch, * FROM nc WHERE ord % 2 = 0 UNION ALL SELECT 1, * FROM nc WHERE ord % 2 = 1)
SELECT batch, ord, cache_key, lang, text_len FROM (SELECT *, row_number() OVER (PARTITION BY cache_key, lang
  ORDER BY timestamp DESC, text_len DESC, batch DESC, ord DESC) AS rn FROM u) t WHERE rn = 1""",
)
def nim_cache_upsert(spark, sf):
    log = cache.conform_nim(run(spark, sf, NIM_LOG))
    merged = cache.merge_nim_logs(log.where("ord % 2 = 0"), log.where("ord % 2 = 1"))
    return merged.select("batch", "ord", "cache_key", "lang", "text_len")


NIM_FILES = """
SELECT concat(CASE WHEN c_custkey % 2 = 0 THEN '' ELSE 'unlisted-' END, cast(c_custkey AS string)) AS cache_key, cast(floor(abs(c_acctbal)) AS int) % 1500 AS file_text_len,
  concat('/cache/', cast(c_custkey AS string), '.txt') AS text_path, true AS file_exists
FROM [[customer]]
"""


@query(
    "nim_cache_state",
    f"""
WITH {NIM_CONFORMED},
l AS (SELECT cache_key, arg_max(retrieval_status, {{'t': timestamp, 'o': ord}}) AS retrieval_status,
  arg_max(retrieval_error, {{'t': timestamp, 'o': ord}}) AS retrieval_error, max(text_len) AS text_len FROM nc GROUP BY 1),
d AS (SELECT DISTINCT national_measure_id AS cache_key, nim_celex, national_measure_id, member_state_iso3, member_state_name FROM [[measures]])
SELECT d.cache_key, nim_celex, member_state_name, coalesce(retrieval_status, 0) AS retrieval_status,
  coalesce(retrieval_error, '') AS retrieval_error, coalesce(text_len, 0) AS text_len,
  coalesce(file_text_len, 0) AS file_text_len, CASE
    WHEN coalesce(file_text_len, 0) >= 500 OR coalesce(text_len, 0) >= 500 THEN 'successful'
    WHEN coalesce(retrieval_status, 0) > 0 OR coalesce(retrieval_error, '') <> '' THEN 'failed' ELSE 'pending' END AS cache_state
FROM d LEFT JOIN l USING (cache_key) LEFT JOIN ({NIM_FILES}) f USING (cache_key)
""",
)
def nim_cache_state(spark, sf):
    states = cache.state_nim(
        load(spark, sf, "measures"), cache.conform_nim(run(spark, sf, NIM_LOG)),
        run(spark, sf, NIM_FILES),
    )
    return states.select(
        "cache_key", "nim_celex", "member_state_name", "retrieval_status", "retrieval_error",
        "text_len", "file_text_len", "cache_state",
    )


FILL_MEASURES = f"""
SELECT ord, concat('7', substr({act('ord % 60')}, 2, 20), 'DNK_', cast(ord % 60 AS string)) AS nim_celex,
  nim_title, '' AS nim_title_lang, {pick('ord', "'xx'", "''")} AS lang_detected, '' AS lang_source, '' AS available_langs
FROM [[measures]]
"""


@query(
    "fill_from_cache",
    f"""
WITH {NIM_CONFORMED},
b AS (SELECT * FROM (SELECT nim_celex, {_opt('nim_title')} AS ct, page_title AS cp, page_title_lang AS cl, available_languages AS ca,
  row_number() OVER (PARTITION BY nim_celex ORDER BY text_len DESC, timestamp DESC, ord) AS rn FROM nc) t WHERE rn = 1)
SELECT ord, nim_celex, coalesce(nullif(nim_title, ''), nullif(ct, ''), nullif(cp, ''), '') AS nim_title,
  coalesce(nullif(cl, ''), '') AS nim_title_lang, lang_detected, coalesce(ca, '') AS available_langs
FROM ({FILL_MEASURES}) m LEFT JOIN b USING (nim_celex)
""",
)
def fill_from_cache(spark, sf):
    filled = nim.fill_from_cache(
        run(spark, sf, FILL_MEASURES), cache.conform_nim(run(spark, sf, NIM_LOG))
    )
    return filled.select(
        "ord", "nim_celex", "nim_title", "nim_title_lang", "lang_detected", "available_langs"
    )


@query(
    "measures_of_acts",
    f"""SELECT ord, celex, nim_celex FROM [[measures]] WHERE celex IN (
  SELECT {R.legal_act('celex', True)} FROM [[hits]])""",
)
def measures_of_acts(spark, sf):
    """Measures whose act is among the eligible acts of the hits."""
    acts = nim.eligible_acts(load(spark, sf, "hits")).select("celex")
    return load(spark, sf, "measures").join(acts, "celex", "left_semi").select(
        "ord", "celex", "nim_celex"
    )


TEXT_ROWS = """(SELECT min(ord) AS ord, celex, nim_celex, national_measure_id FROM [[measures]] GROUP BY 2, 3, 4) t"""
TEXT_KEYS = """celex, nim_celex, concat(CASE WHEN ord % 4 = 1 THEN 'unlisted-' ELSE '' END, national_measure_id) AS national_measure_id"""
TEXT_COLUMNS = (
    "CASE WHEN ord % 3 = 0 THEN ' ' ELSE concat('text of ', nim_celex) END AS full_text_clean",
    "concat('raw of ', nim_celex) AS full_text_raw",
    "CASE WHEN ord % 2 = 0 THEN 'CACHE' ELSE concat('https://t.example/', nim_celex) END AS text_source_url",
    "CASE WHEN ord % 5 = 0 THEN 'sv' ELSE '' END AS lang",
)
MEASURE_TEXTS = f"""
SELECT {TEXT_KEYS}, {TEXT_COLUMNS[0]},
  {TEXT_COLUMNS[1]}, {TEXT_COLUMNS[2]},
  {TEXT_COLUMNS[3]}
FROM {TEXT_ROWS}
"""
#: Measures of one bucket of their texts, so that tasks that sort them stay small on tables of any size.
BUCKET_ROWS = 500_000


def measure_texts(spark, sf):
    """Captured measure texts with their merge keys, in buckets by them. Their keys are dealt first, when they are
    short; merge keys are the measures' own here, as these have no blanks around them."""
    keyed = lambda: nim.with_merge_keys(run(spark, sf, f"SELECT ord, {TEXT_KEYS} FROM {TEXT_ROWS}"))
    texts = lambda dealt: dealt.selectExpr(*nim.MERGE_KEYS, *TEXT_COLUMNS)
    rows = load(spark, sf, "lineitem").count()  # from the footers
    return bucketed(spark, sf, "measure_texts", nim.MERGE_KEYS, keyed, rows // BUCKET_ROWS, texts)


@query(
    "nim_join_fulltext",
    f"""
SELECT ord, 'nim:NIM:' || member_state_iso3 || ':' || national_measure_id AS document_id,
  coalesce(nullif(nim_title, ''), national_measure_id) AS title,
  'National implementation measure for ' || celex || ': ' || eu_act_title AS summary,
  coalesce(nullif(t.lang, ''), {R.blank('m.nim_title_lang')}) AS language,
  coalesce(nullif(member_state_name, ''), member_state_iso3) AS jurisdiction,
  coalesce(CASE WHEN text_source_url <> 'CACHE' THEN text_source_url END, nullif(eurlex_url, '')) AS download_url,
  coalesce({R.blank('full_text_clean')}, full_text_raw) AS full_text
FROM [[measures]] m LEFT JOIN ({MEASURE_TEXTS}) t USING (celex, nim_celex, national_measure_id)
""",
)
def nim_join_fulltext(spark, sf):
    joined = nim.join_fulltext(load(spark, sf, "measures"), measure_texts(spark, sf), keyed=True)
    return nim.to_records(joined, "nim").select(
        "ord", "document_id", "title", "summary", "language", "jurisdiction", "download_url",
        "full_text",
    )


PAGE_RECORDS = """
SELECT ord, concat('http://publications.europa.eu/resource/nim/', national_measure_id) AS nim_resource_uri,
  concat('Page ', nim_celex) AS page_title, CASE WHEN ord % 2 = 0 THEN 'it' ELSE '' END AS page_title_lang,
  'sv,en' AS page_langs FROM [[measures]]
"""


@query(
    "fill_from_page",
    f"""
WITH {ENRICHED},
p AS (SELECT nim_resource_uri, arg_min(page_title, ord) AS pt, arg_min(page_title_lang, ord) AS pl FROM ({PAGE_RECORDS}) x GROUP BY 1)
SELECT ord, CASE WHEN nim_title = '' THEN pt ELSE nim_title END AS nim_title,
  CASE WHEN lang_source IN ('country_fallback', 'default_en') THEN coalesce(nullif(pl, ''), 'sv') ELSE lang_detected END AS lang_detected,
  CASE WHEN lang_source IN ('country_fallback', 'default_en') THEN 'page_metadata' ELSE lang_source END AS lang_source,
  CASE WHEN coalesce(available_langs, '') = '' AND (nim_title = '' OR coalesce(available_langs, '') = '') THEN 'sv,en' ELSE available_langs END AS available_langs
FROM en JOIN p USING (nim_resource_uri)
""",
)
def fill_from_page(spark, sf):
    enriched_rows = nim.enrich(load(spark, sf, "measures"))
    filled = nim.fill_from_page(enriched_rows, run(spark, sf, PAGE_RECORDS))
    return filled.select("ord", "nim_title", "lang_detected", "lang_source", "available_langs")
