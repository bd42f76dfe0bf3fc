"""Retrieval logs, their state, and roll-ups over results."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexcorpus.catalog import rules as R
from lexcorpus.catalog.inputs import load, run
from lexcorpus.catalog.registry import query
from lexcorpus.functions import celex, quality
from lexcorpus.operators import cache, dedup, reports

CONFORMED = """
c0 AS (SELECT ord, celex_full, split_part(celex_full, '-', 1) AS celex,
  CASE WHEN contains(celex_full, '-') THEN split_part(celex_full, '-', 2) ELSE '' END AS celex_version,
  coalesce(lang, '') AS lang, coalesce(text, '') AS text, coalesce(source_url, '') AS source_url,
  coalesce(retrieval_error, '') AS retrieval_error, timestamp,
  coalesce(cast(trunc(try_cast(retrieval_status AS double)) AS int), 0) AS retrieval_status,
  CASE WHEN try_cast(text_len AS double) > 0 THEN cast(trunc(try_cast(text_len AS double)) AS int)
    ELSE length(coalesce(text, '')) END AS text_len FROM [[log]]),
c AS (SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (
  PARTITION BY celex_full, lang ORDER BY ord DESC) AS rn FROM c0) t WHERE rn = 1)
"""


@query(
    "cache_conform",
    f"WITH {CONFORMED} SELECT * REPLACE (cast(text_len AS int) AS text_len) FROM c",
)
def cache_conform(spark, sf):
    return cache.conform(load(spark, sf, "log"))


@query(
    "cache_keep_last",
    """SELECT ord, celex_full, lang, timestamp FROM (SELECT *, row_number() OVER (
  PARTITION BY celex_full, lang ORDER BY timestamp DESC, ord DESC) AS rn FROM [[log]]) t WHERE rn = 1""",
)
def cache_keep_last(spark, sf):
    kept = dedup.keep_best(load(spark, sf, "log"), ["celex_full", "lang"], [F.col("timestamp")])
    return kept.select("ord", "celex_full", "lang", "timestamp")


LATEST = f"""
{CONFORMED},
l AS (SELECT celex_full, celex, celex_version, arg_max(lang, {{'t': timestamp, 'o': ord}}) AS lang,
  arg_max(retrieval_status, {{'t': timestamp, 'o': ord}}) AS retrieval_status,
  arg_max(retrieval_error, {{'t': timestamp, 'o': ord}}) AS retrieval_error,
  arg_max(source_url, {{'t': timestamp, 'o': ord}}) AS source_url, max(timestamp) AS timestamp,
  cast(max(text_len) AS int) AS text_len FROM c GROUP BY celex_full, celex, celex_version)
"""


@query("cache_latest", f"WITH {LATEST} SELECT * FROM l")
def cache_latest(spark, sf):
    return cache.latest_eu(cache.conform(load(spark, sf, "log")))


FILES = """
f AS (SELECT celex_full, split_part(celex_full, '-', 1) AS celex,
  CASE WHEN contains(celex_full, '-') THEN split_part(celex_full, '-', 2) ELSE '' END AS celex_version,
  cast(file_text_len AS int) AS file_text_len, text_path, file_exists FROM [[files]])
"""
STATE = f"""
{LATEST}, {FILES},
b AS (SELECT celex_full, celex, celex_version, lang, retrieval_status, retrieval_error, source_url,
  timestamp, text_len, file_text_len, text_path, file_exists,
  CASE WHEN (coalesce(file_exists, false) AND coalesce(file_text_len, 0) >= 500)
    OR coalesce(text_len, 0) >= 500 THEN 'successful' ELSE 'failed' END AS cache_state
  FROM l FULL JOIN f USING (celex_full, celex, celex_version)),
st AS (SELECT d.celex_full, split_part(d.celex_full, '-', 1) AS celex,
  CASE WHEN contains(d.celex_full, '-') THEN split_part(d.celex_full, '-', 2) ELSE '' END AS celex_version,
  coalesce(lang, '') AS lang, coalesce(retrieval_status, 0) AS retrieval_status,
  coalesce(retrieval_error, '') AS retrieval_error, coalesce(source_url, '') AS source_url,
  coalesce(timestamp, '') AS timestamp, coalesce(text_len, 0) AS text_len,
  coalesce(file_text_len, 0) AS file_text_len, coalesce(text_path, '') AS text_path,
  coalesce(file_exists, false) AS file_exists, coalesce(cache_state, 'pending') AS cache_state
  FROM (SELECT DISTINCT celex_full FROM [[doc_list]]) d LEFT JOIN b ON d.celex_full = b.celex_full)
"""


def _files(spark, sf):
    full = F.col("celex_full")
    return load(spark, sf, "files").withColumns(
        {"celex": celex.split_base(full), "celex_version": celex.split_version(full)}
    )


def _state(spark, sf):
    return cache.state(
        load(spark, sf, "doc_list"), cache.conform(load(spark, sf, "log")), _files(spark, sf)
    )


@query("cache_state", f"WITH {STATE} SELECT * FROM st")
def cache_state(spark, sf):
    return _state(spark, sf)


@query(
    "resume_worklist",
    f"""WITH {STATE}
SELECT true AS retry_failures, ord, celex_full FROM [[doc_list]] WHERE celex_full NOT IN (
  SELECT celex_full FROM st WHERE cache_state = 'successful')
UNION ALL SELECT false, ord, celex_full FROM [[doc_list]] WHERE celex_full NOT IN (
  SELECT celex_full FROM st WHERE cache_state IN ('successful', 'failed'))""",
)
def resume_worklist(spark, sf):
    docs, states = load(spark, sf, "doc_list"), _state(spark, sf)
    parts = [
        cache.worklist(docs, states, retry).select(
            F.lit(retry).alias("retry_failures"), "ord", "celex_full"
        )
        for retry in (True, False)
    ]
    return parts[0].unionByName(parts[1])


CACHED_TEXTS = """
SELECT concat('/cache/', cast(doc_id AS string), '.txt') AS text_path,
  CASE doc_id % 4 WHEN 0 THEN concat('C_2023157EN.01.xml', chr(10), text, ' Official Journal of the European Union')
    WHEN 1 THEN concat('C_2023157EN.01.xml', chr(10), text) ELSE text END AS text
FROM [[documents]]
"""


@query(
    "resume_rows",
    f"""
WITH {STATE}, x AS (SELECT text_path, {R.tidy_lines('text')} AS t FROM ({CACHED_TEXTS}) c),
y AS (SELECT text_path, {R.strip("CASE WHEN contains(lower(t), 'official journal of the european union') THEN regexp_replace(t, '^[A-Za-z0-9_.-]+[.](?i:xml|html|xhtml|txt) *' || chr(10), '') ELSE t END")} AS t FROM x)
SELECT d.ord, d.celex_full, y.t AS full_text_clean, length(y.t) AS text_len,
  coalesce(nullif(st.lang, ''), 'en') AS lang,
  coalesce(nullif(st.source_url, ''), 'CACHE') AS text_source_url, st.retrieval_status,
  CASE WHEN coalesce(nullif(st.lang, ''), 'en') = 'en' THEN
      CASE WHEN d.lang IN ('', 'en') THEN 'english_default' ELSE 'english_fallback' END
    WHEN d.lang = st.lang THEN 'job_language' ELSE 'retry_sequence' END AS lang_source_fulltext
FROM [[doc_list]] d JOIN st USING (celex_full) JOIN y ON st.text_path = y.text_path
WHERE cache_state = 'successful' AND {R.strip('y.t')} <> ''
""",
)
def resume_rows(spark, sf):
    rows = cache.resumed(load(spark, sf, "doc_list"), _state(spark, sf), run(spark, sf, CACHED_TEXTS))
    return rows.select(
        "ord", "celex_full", "full_text_clean", "text_len", "lang", "text_source_url",
        "retrieval_status", "lang_source_fulltext",
    )


@query(
    "cache_diag",
    f"""
WITH {LATEST}, {FILES}
SELECT 'cache_csv_rows' AS metric, count(*) AS value FROM c
UNION ALL SELECT 'cache_csv_status_200', count(*) FROM c WHERE retrieval_status = 200
UNION ALL SELECT 'cache_csv_text_ge_threshold', count(*) FROM c WHERE text_len >= 500
UNION ALL SELECT 'existing_txt_files', count(*) FROM f WHERE file_exists
UNION ALL SELECT 'txt_files_ge_threshold', count(*) FROM f WHERE file_text_len >= 500
UNION ALL SELECT 'csv_vs_file_inconsistencies', count(*) FROM l FULL JOIN f USING (celex_full, celex, celex_version)
  WHERE (coalesce(text_len, 0) >= 500) <> (coalesce(file_text_len, 0) >= 500)
""",
)
def cache_diag(spark, sf):
    return cache.diagnostics(cache.conform(load(spark, sf, "log")), _files(spark, sf))


@query(
    "failed_attempts",
    f"""WITH {CONFORMED}
SELECT ord, celex_full, lang, cast(text_len AS int) AS text_len FROM c WHERE text_len < 500""",
)
def failed_attempts(spark, sf):
    failed = cache.failed_attempts(cache.conform(load(spark, sf, "log")))
    return failed.select("ord", "celex_full", "lang", "text_len")


@query(
    "cache_upsert",
    f"""
WITH {CONFORMED},
o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY celex_full, lang ORDER BY ord DESC) AS rn
  FROM c0 WHERE ord % 2 = 0) t WHERE rn = 1),
n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY celex_full, lang ORDER BY ord DESC) AS rn
  FROM c0 WHERE ord % 2 = 1) t WHERE rn = 1),
u AS (SELECT 0 AS batch, * FROM o UNION ALL SELECT 1, * FROM n)
SELECT batch, ord, celex_full, lang FROM (SELECT *, row_number() OVER (
  PARTITION BY celex_full, lang ORDER BY batch DESC, ord DESC) AS r2 FROM u) t WHERE r2 = 1
""",
)
def cache_upsert(spark, sf):
    log = load(spark, sf, "log")
    old, new = cache.conform(log.where("ord % 2 = 0")), cache.conform(log.where("ord % 2 = 1"))
    return cache.merge_logs(old, new).select("batch", "ord", "celex_full", "lang")


RESULTS = f"""
{CONFORMED},
{R.classified("(SELECT ord, celex_full AS id, retrieval_status, retrieval_error, text_len FROM c) x", 'id', 'ord, retrieval_status, retrieval_error, text_len').strip()},
r AS (SELECT *, text_len >= 500 AS success, CASE WHEN text_len < 500 THEN
  {R.failure('retrieval_status', 'retrieval_error', 'celex_class', 'fulltext_support')} END AS failure_category FROM k)
"""


def _results(spark, sf):
    log = cache.conform(load(spark, sf, "log"))
    return cache.with_failure(celex.with_class(log, "celex_full"))


@query(
    "failure_counts",
    f"""WITH {RESULTS} SELECT failure_category, count(*) AS n FROM r
WHERE failure_category IS NOT NULL GROUP BY 1""",
)
def failure_counts(spark, sf):
    return reports.failure_counts(_results(spark, sf))


@query(
    "type_summary",
    f"""
WITH {RESULTS},
p AS (SELECT celex_sector, celex_sector_label, celex_descriptor, celex_descriptor_label, celex_class,
  count(*) AS attempted, count(CASE WHEN success THEN 1 END) AS successful FROM r GROUP BY ALL),
q0 AS (SELECT celex_sector, celex_descriptor, celex_class, failure_category, count(*) AS n FROM r
  WHERE failure_category IS NOT NULL GROUP BY ALL),
q AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY celex_sector, celex_descriptor, celex_class
  ORDER BY n DESC, failure_category) AS rn FROM q0) t WHERE rn = 1)
SELECT p.*, attempted - successful AS failed, failure_category AS top_failure_reason,
  n AS top_failure_count
FROM p LEFT JOIN q USING (celex_sector, celex_descriptor, celex_class)
""",
)
def type_summary(spark, sf):
    return reports.type_summary(_results(spark, sf))


@query(
    "route_counts",
    f"""
WITH {CONFORMED}, x AS (SELECT coalesce(nullif(g.text_route_used, ''), nullif(g.route_used, ''), 'unknown') AS route,
  c0.text_len FROM c0 JOIN [[log]] g USING (ord))
SELECT route, count(*) AS n, count(CASE WHEN text_len >= 500 THEN 1 END) AS successful,
  count(CASE WHEN text_len < 500 THEN 1 END) AS failed FROM x GROUP BY 1
""",
)
def route_counts(spark, sf):
    log = load(spark, sf, "log")
    given = F.expr("try_cast(text_len as double)")
    sized = log.withColumn(
        "text_len", F.when(given > 0, given.cast("int")).otherwise(F.length("text"))
    )
    return reports.route_counts(sized)


QUALITY_TEXT = """
SELECT doc_id AS ord, CASE doc_id % 6
  WHEN 0 THEN concat('rdf:about ', text, ' skos:Concept')
  WHEN 1 THEN concat(repeat('http://a.example/x ', 14), text)
  WHEN 2 THEN concat('xmlns:dcterms:', text) WHEN 3 THEN concat('  ', text, ' ') ELSE text END AS body FROM [[documents]]
"""


def _problem(n: int) -> str:
    x = f"lower({R.full('body')})"
    count = lambda w: f"(length({x}) - length(replace({x}, '{w}', ''))) / {len(w)}"
    spaces = " + ".join(count(w) for w in ("xmlns:", "rdf:", "skos:", "dcterms:", "owl:"))
    return f"""CASE WHEN {x} = '' THEN 'empty_text' WHEN length({R.full('body')}) < {n} THEN 'short_text'
  WHEN {spaces} >= 2 THEN 'metadata_response_namespace_heavy'
  WHEN length({R.full('body')}) < 3000 AND {count('http://')} + {count('https://')} >= 12
    THEN 'metadata_response_uri_heavy' ELSE '' END"""


@query(
    "text_quality",
    f"SELECT ord, {_problem(300)} AS problem, {_problem(150)} AS cellar_problem FROM ({QUALITY_TEXT}) t",
)
def text_quality(spark, sf):
    body = F.col("body")
    return run(spark, sf, QUALITY_TEXT).select(
        "ord", quality.text_problem(body).alias("problem"),
        quality.text_problem(body, 150).alias("cellar_problem"),
    )


@query(
    "text_availability",
    f"""SELECT ord, CASE WHEN contains(lower(body), '<rdf:rdf') THEN 'metadata_rdf'
    WHEN ord % 7 = 2 THEN 'metadata_rdf'
    WHEN length(lower(body)) < 5000 AND (length(lower(body)) - length(replace(lower(body), 'http://', ''))) / 7 > 40
      THEN 'metadata_uri_heavy'
    WHEN contains(lower(body), 'xmlns:rdf') OR contains(lower(body), 'dcterms:') THEN 'metadata_xml'
    ELSE '' END AS measure_problem,
  length(body) < 300 OR contains(lower(body), 'document not found') AS not_available
FROM (SELECT ord, CASE WHEN ord % 5 = 0 THEN concat(body, ' Document not found') ELSE body END AS body
  FROM ({QUALITY_TEXT}) q) t""",
)
def text_availability(spark, sf):
    rows = run(spark, sf, QUALITY_TEXT)
    rows = rows.withColumn(
        "body",
        F.when(F.col("ord") % 5 == 0, F.concat("body", F.lit(" Document not found"))).otherwise(F.col("body")),
    )
    url = F.when(F.col("ord") % 7 == 2, "https://x.example/rdf/1").otherwise("https://x.example/1")
    return rows.select(
        "ord",
        quality.measure_metadata_problem(F.col("body"), url, F.lit("text/html")).alias("measure_problem"),
        quality.not_available(F.col("body")).alias("not_available"),
    )


ATTEMPTS = """
SELECT event_id AS ord, concat('source-', cast(user_id AS string)) AS source,
  cast(floor(value) AS bigint) AS rows,
  CASE WHEN event_type = 'error' AND user_id % 3 = 0 THEN concat('failed at ', cast(event_id AS string)) ELSE '' END AS error
FROM [[events]]
"""


@query(
    "source_log",
    f"""SELECT source, coalesce(arg_min(error, ord) FILTER (WHERE error <> ''), '') AS error,
  max(error) = '' AS ok, CASE WHEN max(error) = '' THEN cast(sum(rows) AS bigint) ELSE 0 END AS rows
FROM ({ATTEMPTS}) t GROUP BY source""",
)
def source_log(spark, sf):
    return reports.source_log(run(spark, sf, ATTEMPTS))


PAGE_LOG = """
SELECT event_id AS ord, concat('term ', cast(user_id % 20 AS string)) AS term,
  cast(floor(value) AS bigint) % 9 AS page, event_type AS stop_reason,
  cast(200 + event_id % 5 AS bigint) AS status_code, cast(floor(value) AS bigint) AS candidates_found,
  event_id % 7 AS new_urls_kept, event_id % 100 AS kept_total FROM [[events]]
"""


@query(
    "page_diagnostics",
    f"""SELECT term, page, arg_min(status_code, ord) AS status_code,
  cast(sum(candidates_found) AS bigint) AS candidates_found,
  cast(sum(new_urls_kept) AS bigint) AS new_urls_kept, max(kept_total) AS kept_total,
  arg_max(stop_reason, ord) AS stop_reason FROM ({PAGE_LOG}) t GROUP BY term, page""",
)
def page_diagnostics(spark, sf):
    return reports.page_diagnostics(run(spark, sf, PAGE_LOG))
