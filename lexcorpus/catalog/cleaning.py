"""Cleaning, mapping, reading and matching of documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexcorpus import lookups as L
from lexcorpus.catalog import rules as R
from lexcorpus.catalog.inputs import act, load, run
from lexcorpus.catalog.registry import query
from lexcorpus.functions import dates, text, urls
from lexcorpus.operators import dedup, matching, records, terms
from lexcorpus.session import new_path
from lexcorpus.sources import records as sources

# ---- cleaning --------------------------------------------------------------------------

CLEANED = """
SELECT *, {title} AS t, {dtype} AS d, {lang} AS l, {land} AS j,
  {pub} AS p0, {eff} AS e0, {body} AS b
FROM [[docs]]
""".format(
    title=R.title("title"), dtype=R.document_type("document_type"),
    lang=f"lower({R.inline('language')})", land=R.jurisdiction("jurisdiction"),
    pub=R.inline("publication_date"), eff=R.inline("effective_date"), body=R.full_text("full_text"),
)


@query(
    "clean_docs",
    f"""
WITH a AS ({CLEANED}),
b AS (SELECT *, {R.date_candidate('p0')} AS pc, {R.date_candidate('e0')} AS ec,
  CASE WHEN b <> '' AND NOT {R.schema_page('b')} THEN b END AS body FROM a),
c AS (SELECT *, {R.date_value('p0', 'pc')} AS pub, {R.date_value('e0', 'ec')} AS eff FROM b)
SELECT ord, document_id, t AS title, {R.inline('summary')} AS summary, d AS document_type,
  l AS language, j AS jurisdiction, pub AS publication_date, eff AS effective_date,
  body AS full_text,
  CASE WHEN title IS DISTINCT FROM t THEN title END AS _original_title,
  CASE WHEN document_type IS DISTINCT FROM d THEN document_type END AS _original_document_type,
  CASE WHEN language IS DISTINCT FROM l THEN language END AS _original_language,
  CASE WHEN jurisdiction IS DISTINCT FROM j THEN jurisdiction END AS _original_jurisdiction,
  CASE WHEN publication_date IS DISTINCT FROM pub THEN publication_date END
    AS _original_publication_date,
  CASE WHEN effective_date IS DISTINCT FROM eff THEN effective_date END
    AS _original_effective_date,
  {R.date_precision('pc')} AS _publication_date_precision,
  {R.date_precision('ec')} AS _effective_date_precision,
  CASE WHEN full_text <> '' AND body IS NULL
    THEN 'source_boilerplate_or_empty_after_cleaning' END AS _full_text_removed_reason
FROM c
""",
)
def clean_docs(spark, sf):
    cleaned = records.clean(load(spark, sf, "docs"))
    return cleaned.select(
        "ord", "document_id", "title", "summary", "document_type", "language", "jurisdiction",
        "publication_date", "effective_date", "full_text",
        *[c for c in cleaned.columns if c.startswith("_")],
    )


@query(
    "clean_fulltext",
    f"""
WITH a AS (SELECT ord, {R.full_text('full_text')} AS b,
  {R.sub(R.tidy_lines('full_text'), '^[A-Za-z0-9_.-]+[.](?i:xml|html|xhtml|txt)[ ]*' + chr(10), '', '')} AS light
  FROM [[docs]])
SELECT ord, CASE WHEN b <> '' AND NOT {R.schema_page('b')} THEN b END AS full_text,
  {R.strip('light')} AS light_text FROM a
""",
)
def clean_fulltext(spark, sf):
    body = F.col("full_text")
    return load(spark, sf, "docs").select(
        "ord", text.full_text(body).alias("full_text"), text.light_text(body).alias("light_text")
    )


@query(
    "doc_type_slug",
    f"""SELECT {R.document_type('document_type')} AS document_type, {R.slug('title')} AS title_slug,
  count(*) AS n FROM [[docs]] GROUP BY 1, 2""",
)
def doc_type_slug(spark, sf):
    docs = load(spark, sf, "docs")
    return docs.groupBy(
        text.document_type(F.col("document_type")).alias("document_type"),
        text.slug(F.col("title")).alias("title_slug"),
    ).agg(F.count("*").alias("n"))


ORDER_DATES = """
SELECT o_orderkey AS ord, CASE o_orderkey % 9
  WHEN 0 THEN cast(year(o_orderdate) AS string)
  WHEN 1 THEN concat(' ', cast(year(o_orderdate) AS string), '-', lpad(cast(month(o_orderdate) + o_orderkey % 3 AS string), 2, '0'))
  WHEN 2 THEN concat(cast(year(o_orderdate) AS string), '-', lpad(cast(month(o_orderdate) AS string), 2, '0'), '-', lpad(cast(day(o_orderdate) + o_orderkey % 4 AS string), 2, '0'))
  WHEN 3 THEN concat(cast(year(o_orderdate) AS string), '/', cast(month(o_orderdate) AS string), '/', cast(day(o_orderdate) + o_orderkey % 2 AS string))
  WHEN 4 THEN concat(cast(day(o_orderdate) + o_orderkey % 2 AS string), '.', cast(month(o_orderdate) AS string), '.', cast(year(o_orderdate) AS string), chr(160))
  WHEN 5 THEN concat('0000-', lpad(cast(month(o_orderdate) AS string), 2, '0'), '-01')
  WHEN 6 THEN concat(cast(year(o_orderdate) AS string), '-2')
  WHEN 7 THEN NULL ELSE concat('c.  ', cast(year(o_orderdate) AS string)) END AS raw_date
FROM [[orders]]
"""


@query(
    "normalize_dates",
    f"""
WITH a AS (SELECT ord, raw_date, {R.inline('raw_date')} AS x FROM ({ORDER_DATES}) t),
b AS (SELECT *, {R.date_candidate('x')} AS c FROM a)
SELECT ord, raw_date, {R.date_value('x', 'c')} AS date_value,
  {R.date_precision('c')} AS date_precision FROM b
""",
)
def normalize_dates(spark, sf):
    raw = run(spark, sf, ORDER_DATES)
    return dates.with_normalized(raw, {"raw_date": ("date_value", "date_precision")})


ALL_URLS = """
SELECT page_id AS id, url FROM [[pages]] UNION ALL SELECT ord AS id, url FROM [[docs]]
"""


@query("normalize_url", f"SELECT id, url, {R.comparison_url('url')} AS normalized_url FROM ({ALL_URLS}) t")
def normalize_url(spark, sf):
    return urls.with_comparison(run(spark, sf, ALL_URLS), "url", "normalized_url")


@query("canonical_url", f"SELECT id, url, {R.canonical('url')} AS canonical_url FROM ({ALL_URLS}) t")
def canonical_url(spark, sf):
    return urls.with_canonical(run(spark, sf, ALL_URLS), "url", "canonical_url")


@query(
    "host_counts",
    f"""SELECT lower({R.cut('url', '^[A-Za-z]+://([^/:?#]*)')}) AS host, count(*) AS n,
  count(DISTINCT {R.canonical('url')}) AS canonical_urls FROM ({ALL_URLS}) t GROUP BY 1""",
)
def host_counts(spark, sf):
    links = urls.with_canonical(run(spark, sf, ALL_URLS), "url", "canonical")
    return links.groupBy(urls.host(F.col("url")).alias("host")).agg(
        F.count("*").alias("n"), F.countDistinct("canonical").alias("canonical_urls")
    )


# ---- records, mapping, queries ---------------------------------------------------------

TERMS = (*dict.fromkeys((*L.SEARCH_TERMS, *L.FULLTEXT_TERMS)), "tion", "Est", "für", "thand")
QUERY_TERMS = ("Energy Security", "critical infrastructure", "resilience policy ")

RECORDS = f"""
SELECT doc_id AS ord,
  CASE WHEN doc_id % 23 = 0 THEN ' ' ELSE concat(' doc-', cast(doc_id AS string)) END AS id,
  CASE WHEN doc_id % 29 = 0 THEN NULL ELSE concat('Title ', md5(text)) END AS title,
  CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN ' ' ELSE {act('doc_id')} END AS source_document_id,
  CASE doc_id % 3 WHEN 0 THEN NULL ELSE concat(' ', source, ' ') END AS summary,
  lang AS language, 'EU' AS jurisdiction, text AS full_text,
  CASE doc_id % 6 WHEN 0 THEN NULL WHEN 1 THEN 'energy security'
    WHEN 2 THEN '["critical infrastructure", "ENERGY security "]' WHEN 3 THEN '["other"]'
    WHEN 4 THEN 'Resilience Policy' ELSE '' END AS queries
FROM [[documents]]
"""
RECORD_MAPPING = {
    "document_id": "id", "title": "title", "source_document_id": "source_document_id",
    "summary": "summary", "language": "language", "jurisdiction": "jurisdiction",
    "full_text": "full_text",
}


@query(
    "map_fields",
    f"""
SELECT ord, {R.blank('id')} AS document_id, {R.blank('title')} AS title,
  {R.blank('coalesce(source_document_id, id)')} AS source_document_id,
  {R.blank('summary')} AS summary, {R.blank('language')} AS language,
  {R.blank('full_text')} AS full_text,
  CASE WHEN {R.strip('id')} = '' THEN 'document_id must be non-empty'
    WHEN title IS NULL THEN 'title is required' END AS problem
FROM ({RECORDS}) t
""",
)
def map_fields(spark, sf):
    mapped = records.map_fields(
        run(spark, sf, RECORDS), RECORD_MAPPING, {"source_document_id": F.col("id")}
    )
    return mapped.select(
        "ord", "document_id", "title", "source_document_id", "summary", "language", "full_text",
        "problem",
    )


@query(
    "normalize_docs",
    f"""
SELECT ord, {R.blank('id')} AS document_id, 'local' AS source_name, {R.blank('title')} AS title,
  {R.blank('coalesce(source_document_id, id)')} AS source_document_id,
  {R.blank('summary')} AS summary, 'some query' AS query, 'inline-001' AS _query_id,
  'inline' AS _query_origin, 'local-file' AS _adapter_name, ord AS _adapter_result_index,
  {R.blank('full_text')} AS full_text
FROM ({RECORDS}) t WHERE {R.strip('id')} <> '' AND title IS NOT NULL
""",
)
def normalize_docs(spark, sf):
    mapped = records.map_fields(
        run(spark, sf, RECORDS), RECORD_MAPPING, {"source_document_id": F.col("id")}
    )
    asked = mapped.where(F.col("problem").isNull()).withColumns(
        {
            "query_text": F.lit("some query"), "query_id": F.lit("inline-001"),
            "query_origin": F.lit("inline"), "result_index": F.col("ord"),
        }
    )
    return records.normalize(asked, "local", "local-file").select(
        "ord", "document_id", "source_name", "title", "source_document_id", "summary", "query",
        "_query_id", "_query_origin", "_adapter_name", "_adapter_result_index", "full_text",
    )


RAW_RECORDS = """
SELECT ord, concat('{"query_text": "q", "id" : ', cast(ord AS string), ', "source": " ', source_name, ' ", "blank": " ', chr(160), '", "none": null, "tags": [" ", "a ", null, ["", []]], ',
  '"parts": [{"name": "', md5(summary), '", "note": ""}, {"note": null}, 1.5, true, "null"], "inner": {"deep": {"blank": "", "kept": "x: ', chr(92), '"null', chr(92), '", "}}, "date": "2020"}') AS raw FROM [[docs]]
"""


@query(
    "slim_raw_json",
    """
SELECT ord, '{"id":' || cast(ord AS varchar) || ',"source":"' || trim(source_name) || '","tags":["a",[[]]],"parts":[{"name":"' || md5(summary)
  || '"},{},1.5,true,"null"],"inner":{"deep":{"kept":"x: \\"null\\","}}}' AS raw FROM [[docs]]
""",
)
def slim_raw_json(spark, sf):
    """Raw records of unknown shape without blanks at any depth and without two of their fields."""
    slim = records.slim_json(F.col("raw"), drop=("query_text", "date"))
    return run(spark, sf, RAW_RECORDS).select("ord", slim.alias("raw"))


SLIM = """
SELECT ord, title, source_name, summary, publication_date,
  array('a ', ' ', source_name) AS tags FROM [[docs]]
"""


@query(
    "slim_record",
    f"""
WITH a AS (SELECT ord, {R.blank('title')} AS title, {R.blank('source_name')} AS source_name,
  {R.blank('summary')} AS summary FROM [[docs]])
SELECT ord, title, source_name, summary, 'a,' || source_name AS tags,
  false AS has_date FROM a
""",
)
def slim_record(spark, sf):
    raw = load(spark, sf, "docs").withColumn(
        "tags", F.array(F.lit("a "), F.lit(" "), F.col("source_name"))
    )
    cols = ["title", "source_name", "summary", "publication_date", "tags"]
    slim = raw.select(
        "ord", records.slim_record(raw, cols, drop=("publication_date",)).alias("r")
    )
    field = lambda k: F.get_json_object("r", f"$.{k}").alias(k)
    return slim.select(
        "ord", field("title"), field("source_name"), field("summary"),
        F.array_join(F.from_json(F.get_json_object("r", "$.tags"), "array<string>"), ",").alias("tags"),
        F.coalesce(F.contains("r", F.lit('"publication_date"')), F.lit(False)).alias("has_date"),
    )


@query("scan_records", f"SELECT id, title, summary, queries, full_text FROM ({RECORDS}) t")
def scan_records(spark, sf):
    path = new_path(spark, "records")
    run(spark, sf, RECORDS).drop("ord").write.json(path)
    return sources.read_records(spark, path).select("id", "title", "summary", "queries", "full_text")


@query(
    "load_queries",
    f"""
WITH l AS (SELECT 'doc-' || cast(doc_id AS varchar) AS source_path,
  unnest(string_split(text, chr(10))) AS line,
  generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents)
SELECT {R.strip('line')} AS text, 'inventory-' || CASE WHEN n < 1000 THEN lpad(cast(n AS varchar), 3, '0') ELSE cast(n AS varchar) END AS query_id,
  'inventory' AS origin, source_path
FROM l WHERE {R.strip('line')} <> '' AND NOT starts_with({R.strip('line')}, '#')
""",
)
def load_queries(spark, sf):
    """Every document read as a query inventory."""
    files = load(spark, sf, "documents").select(
        F.col("text").alias("value"), F.concat(F.lit("doc-"), F.col("doc_id")).alias("path")
    )
    return sources.inventory_queries(files)


QUERY_SQL = ", ".join(f"({i}, {R.q(t)}, 'inline-{i + 1:03d}')" for i, t in enumerate(QUERY_TERMS))
MATCH_SQL = f"""
SELECT r.ord, q.query_ord, q.query_text, q.query_id
FROM ({RECORDS}) r JOIN (VALUES {QUERY_SQL}) q(query_ord, query_text, query_id) ON
  r.queries IS NULL OR list_contains(list_transform(
    CASE WHEN starts_with(r.queries, '[') THEN from_json(r.queries, '["VARCHAR"]')
      WHEN {R.strip('r.queries')} = '' THEN [] ELSE [r.queries] END,
    lambda t: lower(trim(t))), lower(trim(q.query_text)))
"""


@query("match_queries", MATCH_SQL)
def match_queries(spark, sf):
    matched = matching.match_queries(
        run(spark, sf, RECORDS), matching.inline_queries(QUERY_TERMS)
    )
    return matched.select("ord", "query_ord", "query_text", "query_id")


@query(
    "collect_union",
    f"""
WITH m AS ({MATCH_SQL})
SELECT 0 AS source_ord, query_ord, ord, 'first:' || cast(ord AS varchar) AS document_id, query_id FROM m
UNION ALL
SELECT 1, query_ord, ord, 'second:' || cast(ord AS varchar), query_id FROM m
""",
)
def collect_union(spark, sf):
    """Two sources, each read once, times the run's queries."""
    queries = matching.inline_queries(QUERY_TERMS)
    both = run(spark, sf, RECORDS)
    found = [
        matching.match_queries(rows, queries).withColumn(
            "document_id", F.concat(F.lit(f"{name}:"), F.col("ord"))
        )
        for name, rows in (("first", both), ("second", both))
    ]
    merged = dedup.merge_sources(found).withColumnRenamed("part_ord", "source_ord")
    return merged.select("source_ord", "query_ord", "ord", "document_id", "query_id")


TERM_SQL = ", ".join(R.q(t) for t in TERMS)


@query(
    "match_terms",
    f"""
WITH a AS (SELECT ord, jurisdiction,
  lower(coalesce(title, '') || ' ' || coalesce(full_text, '')) AS x FROM [[docs]]),
m AS (SELECT ord, list_filter([{TERM_SQL}], lambda t: contains(x, lower(t))) AS found FROM a)
SELECT ord, unnest(CASE WHEN len(found) > 0 THEN found ELSE [''] END) AS term FROM m
""",
)
def match_terms(spark, sf):
    return matching.match_terms(load(spark, sf, "docs"), TERMS).select("ord", "term")


INVENTORY = """
SELECT doc_id AS ord, CASE WHEN length(term) % 5 = 0 THEN NULL ELSE lang END AS lang, term FROM (
  SELECT doc_id, lang, trim(concat(split_part(text, ' ', 2), ' ', split_part(text, ' ', 3))) AS term FROM [[documents]]) t
"""


@query(
    "match_terms_by_language",
    f"""
WITH t AS (SELECT lang, term, lower(term) AS low, min(ord) AS term_ord FROM ({INVENTORY}) i
  WHERE {R.strip('term')} <> '' GROUP BY lang, term),
d AS (SELECT ord, lower({R.strip('language')}) AS lang, lower(coalesce(title, '') || ' ' || coalesce(full_text, '')) AS x FROM [[docs]]),
m AS (SELECT d.ord, t.term, t.lang AS term_lang, t.term_ord FROM d JOIN t
  ON (t.lang IS NULL OR t.lang = d.lang) AND contains(d.x, t.low))
SELECT * FROM m UNION ALL SELECT ord, '', NULL, NULL FROM d WHERE ord NOT IN (SELECT ord FROM m)
""",
)
def match_terms_by_language(spark, sf):
    """An inventory with a term from each document, sought in all documents of its language."""
    docs = load(spark, sf, "docs")
    # only the first three words are split, not the whole text
    listed = INVENTORY.replace("[[documents]]", "(SELECT doc_id, lang, substring_index(text, ' ', 3) AS text FROM [[documents]])")
    return terms.term_rows(docs, terms.term_index(run(spark, sf, listed), docs), ["ord"], lang="language")


WORDS = """
SELECT doc_id AS ord, lower(text) AS term FROM [[documents]]
"""


@query(
    "dedupe_terms",
    f"""SELECT term, min(ord) AS ord FROM ({WORDS}) t GROUP BY term""",
)
def dedupe_terms(spark, sf):
    return dedup.ordered_distinct(run(spark, sf, WORDS), "term")
