"""Captured pages, search answers, notices and API answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexcorpus import lookups as L
from lexcorpus.catalog import rules as R
from lexcorpus.catalog.inputs import act, load, pick, run, spread, stored
from lexcorpus.catalog.registry import query
from lexcorpus.functions import quality
from lexcorpus.operators import extract
from lexcorpus.session import saved

def _payload(spark, sf, name, template):
    """Captured payloads as a stored table."""
    return spark.read.parquet(stored(spark, sf, name, lambda: spread(spark, sf, template)))


# ---- pages -----------------------------------------------------------------------------


def _decode(x: str) -> str:
    for mark, letter in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&amp;", "&")):
        x = f"replace({x}, '{mark}', '{letter}')"
    return R.sub(x, "&amp$", "&")


BARE = R.sub(R.sub(R.sub("html", r"(?s)<script>.*?</script>", "<x>"), r"(?s)<style>.*?</style>", "<x>"), r"(?s)<!--.*?-->", "<x>")
VISIBLE = R.strip(R.collapse(_decode(R.sub(BARE, "<[^>]*>", " "))))
LINES = R.strip(R.sub(R.sub(_decode(R.sub(BARE, "(?:<[^>]*>)+", "\n")), r"[ \t\r\f\x0b]+", " "), r"\n{3,}", "\n\n"))


@query(
    "page_text",
    f"""WITH v AS (SELECT page_id, {VISIBLE} AS text_visible, {LINES} AS text_lines FROM pages)
SELECT page_id, text_visible, text_lines, text_visible AS text_plain,
  cast(length(text_visible) AS int) AS text_len FROM v""",
)
def page_text(spark, sf):
    read = extract.read_pages(load(spark, sf, "pages"), parts=("text_visible", "text_lines", "text_plain"))
    return read.select(
        "page_id", "page.text_visible", "page.text_lines", "page.text_plain",
        F.length("page.text_visible").alias("text_len"),
    )


@query(
    "page_quality",
    f"""
WITH v AS (SELECT page_id, {VISIBLE} AS t, lower(html) AS h FROM pages)
SELECT CASE WHEN t = '' THEN 'empty_text' WHEN length(t) < 150 THEN 'short_text' ELSE '' END AS problem,
  count(*) AS pages, count(CASE WHEN length(h) < 300 THEN 1 END) AS not_available FROM v GROUP BY 1
""",
)
def page_quality(spark, sf):
    read = extract.read_pages(load(spark, sf, "pages"), parts=("text_visible",))
    body, seen = F.col("html"), F.col("page.text_visible")
    caught = quality.metadata_problem(body, seen, F.col("url"), F.lit("text/html"))
    problem = F.coalesce(F.nullif(caught, F.lit("")), quality.text_problem(seen, 150))
    return read.groupBy(problem.alias("problem")).agg(
        F.count("*").alias("pages"),
        F.count_if(quality.not_available(body)).alias("not_available"),
    )


SAID = R.strip(R.collapse(_decode(R.cut("html", "<title>([^<]*)</title>"))))
HEAD = R.strip(R.collapse(_decode(R.cut("html", "<h1>([^<]*)</h1>"))))


@query(
    "page_title",
    f"""WITH v AS (SELECT page_id, {SAID} AS t, {HEAD} AS h FROM pages)
SELECT page_id, CASE WHEN length(t) >= 15 THEN t WHEN length(h) > 20 THEN h ELSE 'page ' || cast(page_id AS varchar) END AS title
FROM v""",
)
def page_title(spark, sf):
    read = extract.read_pages(load(spark, sf, "pages"), parts=extract.TITLE_PARTS)
    fallback = F.concat(F.lit("page "), F.col("page_id").cast("string"))
    return read.select("page_id", extract.page_title(fallback).alias("title"))


LINK_TYPE = """CASE WHEN lower(u) LIKE '%.pdf' THEN 'direct_text_pdf' WHEN lower(u) LIKE '%.docx' THEN 'direct_text_docx'
  WHEN lower(u) LIKE '%.doc' THEN 'direct_text_doc'
  WHEN regexp_matches(lower(u), '[.]rtf|[.]odt|[.]txt|download|file=') THEN 'direct_text_file'
  WHEN contains(lower(u), 'eli') THEN 'national_website_eli'
  WHEN (contains(lower(u), 'machine') AND contains(lower(u), 'translat')) OR contains(lower(label), 'machine translation')
    THEN 'machine_translation' ELSE 'national_website' END"""
PRIORITY = "CASE t {} ELSE 112 END".format(
    " ".join(f"WHEN {R.q(r)} THEN {i}" for i, r in enumerate(L.ROUTE_ORDER))
)
PAGE_LINKS = f"""
pl0 AS (SELECT page_id, regexp_extract(url, '^([a-z]+://[^/]*)', 1) AS origin, html FROM pages),
pl1 AS (SELECT page_id, origin, unnest(regexp_extract_all(html, '<a href="([^"]*)">', 1)) AS href,
  unnest(regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1)) AS label,
  generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)">', 1), 1) - 1 AS pos FROM pl0),
pl2 AS (SELECT page_id, cast(pos AS int) AS pos, origin || {_decode('href')} AS u, {R.strip(_decode('label'))} AS label FROM pl1),
pl3 AS (SELECT page_id, pos, u AS url, label, {LINK_TYPE} AS t FROM pl2),
pl AS (SELECT page_id, pos, url, label, t AS link_type, {PRIORITY} AS priority FROM pl3)
"""


@query(
    "page_links",
    f"WITH {PAGE_LINKS} SELECT page_id, pos, url, label, link_type, cast(priority AS int) AS priority FROM pl",
)
def page_links(spark, sf):
    read = extract.read_pages(load(spark, sf, "pages").withColumnRenamed("url", "page_url"), url="page_url", parts=["links"])
    return extract.page_links(read, "page_id").select(
        "page_id", "pos", "url", "label", "link_type", "priority"
    )


@query(
    "rank_routes",
    f"""WITH {PAGE_LINKS}, d AS (SELECT page_id, url, min(priority) AS p FROM pl GROUP BY page_id, url)
SELECT page_id, url, cast(p AS int) AS priority, cast(row_number() OVER (PARTITION BY page_id ORDER BY p, url) AS int) AS rank FROM d""",
)
def rank_routes(spark, sf):
    read = extract.read_pages(load(spark, sf, "pages").withColumnRenamed("url", "page_url"), url="page_url", parts=["links"])
    typed = F.transform(
        "page.links",
        lambda x: F.struct(
            x["url"].alias("url"), quality.page_link_type(x["url"], x["label"]).alias("link_type")
        ),
    )
    read = read.select("page_id", typed.alias("links"))
    ranked = read.select("page_id", extract.ranked_routes(F.col("links")).alias("r"))
    return ranked.select("page_id", F.posexplode("r").alias("i", "x")).select(
        "page_id", "x.url", "x.priority", (F.col("i") + 1).alias("rank")
    )


RAW_LINKS = f"""
SELECT o_orderkey AS ord, concat('https://', {pick('o_orderkey', "'a.example/x.PDF'", "'b.example/eli/1'", "'c.example/d.docx'",
  "'d.example/f?format=pdf&x'", "'publications.europa.eu/r'", "'e.example/machine/translate'", "'f.example/a.txt?x'", "'g.example/h.doc'", "'h.example/p'")}) AS url,
  {pick('o_orderkey', "'text/html'", "'application/pdf'", "'application/msword'", "''")} AS content_type,
  {pick('o_orderkey', "'link'", "'national_Website'")} AS element FROM [[orders]]
"""


@query(
    "classify_links",
    f"""
SELECT ord, CASE WHEN lower(u) LIKE '%.pdf' THEN 'direct_text_pdf' WHEN lower(u) LIKE '%.docx' THEN 'direct_text_docx'
  WHEN lower(u) LIKE '%.doc' THEN 'direct_text_doc'
  WHEN regexp_matches(lower(u), '[.]rtf|[.]odt|[.]txt') OR regexp_matches(lower(u), '[?&](?:format|download|file)=(pdf|docx|doc|rtf|txt)\\b') THEN 'direct_text_file'
  WHEN contains(lower(u), 'machine') AND contains(lower(u), 'translat') THEN 'machine_translation'
  WHEN contains(lower(u), 'eli') THEN 'national_website_eli'
  WHEN contains(lower(element), 'website') OR NOT (contains(lower(u), 'publications.europa.eu') OR contains(lower(u), 'w3.org')) THEN 'national_website'
  ELSE 'other' END AS record_type,
  {LINK_TYPE.replace('lower(label)', "''")} AS page_type,
  CASE WHEN lower(u) LIKE '%.pdf' OR content_type = 'application/pdf' THEN 'pdf' WHEN lower(u) LIKE '%.docx' THEN 'docx'
  WHEN lower(u) LIKE '%.doc' OR content_type = 'application/msword' THEN 'doc' WHEN content_type = 'text/html' THEN 'html' ELSE 'binary' END AS format
FROM (SELECT *, url AS u FROM ({RAW_LINKS}) r) t
""",
)
def classify_links(spark, sf):
    url = F.col("url")
    return run(spark, sf, RAW_LINKS).select(
        "ord",
        quality.record_link_type(url, F.col("element")).alias("record_type"),
        quality.page_link_type(url, F.lit("")).alias("page_type"),
        quality.source_format(url, F.col("content_type")).alias("format"),
    )


# ---- search answers --------------------------------------------------------------------

CX = act("o_custkey")
ANSWERS = f"""
SELECT o_orderkey AS ord, concat('<?xml version="1.0"?><S:E xmlns:S="urn:s"><searchResults xmlns="urn:x"><numhits>2</numhits><totalhits>',
  cast(o_custkey AS string), '</totalhits><result><content><W>',
  CASE o_orderkey % 4 WHEN 0 THEN concat('<ID_CELEX><LANG>FR</LANG><VALUE>', {CX}, 'FR</VALUE></ID_CELEX><ID_CELEX><LANG>EN</LANG><VALUE> ', {CX}, '</VALUE></ID_CELEX>')
    WHEN 1 THEN concat('<ID_CELEX><VALUE>', {CX}, '</VALUE></ID_CELEX>')
    WHEN 2 THEN concat('<U a="http://p/resource/celex/', {CX}, '">x</U>') ELSE '<U>none</U>' END,
  CASE o_orderkey % 3 WHEN 0 THEN '<EXPRESSION_TITLE><VALUE>Titre</VALUE><LANG>fr</LANG></EXPRESSION_TITLE><EXPRESSION_TITLE><VALUE>Title &amp; more</VALUE><LANG>en</LANG></EXPRESSION_TITLE>'
    WHEN 1 THEN '<WORK_TITLE><VALUE>Work</VALUE></WORK_TITLE>' ELSE '' END,
  CASE o_orderkey % 5 WHEN 0 THEN '<WORK_DATE_DOCUMENT><VALUE>2014-07-23</VALUE></WORK_DATE_DOCUMENT>'
    WHEN 1 THEN concat('<DATE_DOCUMENT><YEAR>', cast(year(o_orderdate) AS string), '</YEAR><MONTH>', cast(month(o_orderdate) AS string), '</MONTH><DAY>7</DAY></DATE_DOCUMENT>')
    WHEN 2 THEN '<DATE_PUBLICATION><YEAR>2001</YEAR><MONTH>3</MONTH></DATE_PUBLICATION>'
    WHEN 3 THEN '<DATE_PUBLICATION><YEAR>2001</YEAR></DATE_PUBLICATION>' ELSE '' END,
  '</W></content></result><result><ID_CELEX><VALUE>', {act('o_custkey % 50')}, '</VALUE></ID_CELEX></result></searchResults></S:E',
  CASE WHEN o_orderkey % 29 = 5 THEN '' ELSE '>' END) AS body, o_custkey % 7 AS job
FROM [[orders]]
"""
HITS = f"""
p AS (SELECT o_orderkey AS ord, o_custkey % 7 AS job, 0 AS result_idx,
  CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE {CX} END AS celex,
  CASE o_orderkey % 3 WHEN 0 THEN 'Title & more' WHEN 1 THEN 'Work' ELSE '' END AS title,
  CASE o_orderkey % 5 WHEN 0 THEN '2014-07-23' WHEN 1 THEN cast(year(o_orderdate) AS varchar) || '-' || lpad(cast(month(o_orderdate) AS varchar), 2, '0') || '-07'
    WHEN 2 THEN '2001-03' WHEN 3 THEN '2001' ELSE '' END AS date FROM orders
  UNION ALL SELECT o_orderkey, o_custkey % 7, 1, {act('o_custkey % 50')}, '', '' FROM orders),
ph AS (SELECT * FROM p WHERE ord % 29 <> 5)
"""


@query(
    "parse_hits",
    f"""WITH {HITS} SELECT ord, job, result_idx, celex, title, date,
  'https://eur-lex.europa.eu/legal-content/EN/TXT/?uri=CELEX:' || celex AS url FROM ph""",
)
def parse_hits(spark, sf):
    return extract.parse_hits(_payload(spark, sf, "answers", ANSWERS))


@query(
    "found_hits",
    f"""WITH {HITS} SELECT job, celex, title FROM (SELECT *, row_number() OVER (PARTITION BY job, celex
  ORDER BY ord, result_idx) AS rn FROM ph WHERE celex IS NOT NULL) t WHERE rn = 1""",
)
def found_hits(spark, sf):
    hits = extract.parse_hits(_payload(spark, sf, "answers", ANSWERS)).withColumn(
        "place", F.struct("ord", "result_idx")
    )
    return extract.found_hits(hits, ["job"], "place").select("job", "celex", "title")


NOTICES = f"""
SELECT o_orderkey AS ord, {CX} AS act, concat('<R xmlns:xml="http://www.w3.org/XML/1998/namespace"><NOTICE><ID_CELEX><VALUE>79999L0001</VALUE></ID_CELEX><SAMEAS><URI><TYPE>celex</TYPE><IDENTIFIER>7', substr({CX}, 2, 20), 'dnk_', cast(o_orderkey AS string),
  '</IDENTIFIER></URI></SAMEAS><SAMEAS><TYPE>nim</TYPE><IDENTIFIER>', cast(o_custkey AS string), '</IDENTIFIER><VALUE>http://n/', cast(o_custkey AS string), '</VALUE></SAMEAS>',
  '<WORK_DATE_DOCUMENT><VALUE>2016-06-01</VALUE></WORK_DATE_DOCUMENT><EXPRESSION_TITLE xml:lang="DA"><VALUE>Lov ', cast(o_custkey AS string), '</VALUE></EXPRESSION_TITLE>',
  CASE o_orderkey % 3 WHEN 0 THEN '<EXPRESSION_USES_LANGUAGE><VALUE>http://e/authority/language/SWE</VALUE><OP-CODE>DAN</OP-CODE></EXPRESSION_USES_LANGUAGE>' WHEN 1 THEN '<LANGUAGE>eng</LANGUAGE>' ELSE '' END,
  CASE WHEN o_orderkey % 2 = 0 THEN '<WORK_CREATED_BY_AGENT><X><IDENTIFIER>swe</IDENTIFIER></X></WORK_CREATED_BY_AGENT>' ELSE '' END,
  '<URI><TYPE>cellar</TYPE><VALUE>c-', cast(o_custkey AS string), '</VALUE></URI></NOTICE><NOTICE><ID_CELEX/></NOTICE></R>') AS body
FROM [[orders]] WHERE length({CX}) > 0
"""


@query(
    "parse_notices",
    f"""
SELECT o_orderkey AS ord, {CX} AS act_celex, '7' || substr({CX}, 2) || 'DNK_' || cast(o_orderkey AS varchar) AS nim_celex,
  cast(o_custkey AS varchar) AS national_measure_id, '2016-06-01' AS nim_date, 'Lov ' || cast(o_custkey AS varchar) AS nim_title,
  'da' AS nim_title_lang, CASE o_orderkey % 3 WHEN 0 THEN 'dan,swe' WHEN 1 THEN 'eng' ELSE '' END AS available_expr_langs3,
  'c-' || cast(o_custkey AS varchar) AS cellar_uri, 'http://n/' || cast(o_custkey AS varchar) AS nim_resource_uri,
  CASE WHEN o_orderkey % 2 = 0 THEN 'Sweden' ELSE 'Denmark' END AS member_state_name FROM orders
""",
)
def parse_notices(spark, sf):
    rows = extract.parse_notices(_payload(spark, sf, "notices", NOTICES), act="act")
    return rows.select(
        "ord", "act_celex", "nim_celex", "national_measure_id", "nim_date", "nim_title",
        "nim_title_lang", "available_expr_langs3", "cellar_uri", "nim_resource_uri",
        "member_state_name",
    )


RECORDS = f"""
SELECT o_orderkey AS ord, concat('<rdf:RDF xmlns:rdf="urn:r" xmlns:w="urn:w"><w:title xml:lang="dan">Lov ', cast(o_custkey AS string),
  '</w:title><w:label xml:lang="en">x</w:label><w:see rdf:resource="http://publications.europa.eu/resource/authority/a"/><w:file rdf:resource="https://n.example/', cast(o_custkey AS string),
  {pick('o_orderkey', "'.pdf'", "'.html'", "'/eli'")}, '"/><w:national_website>https://site.example/</w:national_website></rdf:RDF>') AS body FROM [[orders]]
"""


@query(
    "rdf_links",
    f"""
SELECT o_orderkey AS ord, 'Lov ' || cast(o_custkey AS varchar) AS title, 'da' AS title_lang, 'da,en' AS languages,
  'https://n.example/' || cast(o_custkey AS varchar) || {pick('o_orderkey', "'.pdf'", "'.html'", "'/eli'")} || ' '
    || {pick('o_orderkey', "'direct_text_pdf'", "'national_website'", "'national_website_eli'")} || ' | https://site.example/ national_website' AS links FROM orders
""",
)
def rdf_links(spark, sf):
    return extract.read_rdf(_payload(spark, sf, "records", RECORDS)).select(
        "ord", "title", "title_lang", F.array_join("available_languages", ",").alias("languages"),
        F.array_join(
            F.transform("links", lambda x: F.concat_ws(" ", x["url"], x["link_type"])), " | "
        ).alias("links"),
    )


ACT_XML = """
SELECT doc_id AS ord, concat('<Legislation xmlns="urn:l"><Metadata>hidden <b>deep</b></Metadata><Body><Title>Act ', cast(doc_id AS string),
  '</Title> tail <P>', replace(replace(text, '&', '&amp;'), '<', '&lt;'), '</P><Contents>no</Contents>after</Body><Versions><V>v</V></Versions></Legislation>') AS body
FROM [[documents]]
"""


@query(
    "legislation_text",
    f"SELECT doc_id AS ord, {R.strip(R.collapse('concat(' + chr(39) + 'Act ' + chr(39) + ', cast(doc_id AS varchar), ' + chr(39) + ' tail ' + chr(39) + ', text, ' + chr(39) + ' after' + chr(39) + ')'))} AS text FROM documents",
)
def legislation_text(spark, sf):
    return extract.legislation_texts(_payload(spark, sf, "act_xml", ACT_XML))


# ---- API answers -----------------------------------------------------------------------

NZ = f"""
SELECT o_orderkey AS ord, concat('term ', cast(o_orderkey % 9 AS string)) AS term, concat('{{"results": [{{"work_id": "w', cast(o_custkey AS string),
  '", "latest_matching_version": {{"title": " Act ', cast(o_custkey AS string), ' ", "version_id": ', {pick('o_orderkey', "'\"v1\"'", "'null'", "'\"\"'")},
  ', "formats": [{{"type": "pdf", "url": "https://nz/', cast(o_custkey AS string), '.pdf"}}', CASE WHEN o_orderkey % 2 = 0 THEN concat(', {{"type": " HTML ", "url": "https://nz/', cast(o_custkey AS string), '"}}') ELSE '' END,
  ']}}}}, {{"work_id": "again", "latest_matching_version": {{"formats": [{{"type": "xml", "url": "https://nz/', cast(o_orderkey % 4 AS string), '.xml"}}]}}}}, {{"work_id": "w2", "latest_matching_version": {{"title": "B", "formats": [{{"type": "xml", "url": "https://nz/0.xml"}}]}}}}, {{"work_id": "none"}}]}}') AS body
FROM [[orders]]
"""


@query(
    "nz_rows",
    f"""
WITH a AS (SELECT o_orderkey AS ord, 'term ' || cast(o_orderkey % 9 AS varchar) AS term, o_custkey AS c,
  CASE WHEN o_orderkey % 2 = 0 THEN 'https://nz/' || cast(o_custkey AS varchar) ELSE '' END AS text_url FROM orders),
r AS (SELECT ord, term, 0 AS i, coalesce(nullif(text_url, ''), 'https://nz/' || cast(c AS varchar) || '.pdf') AS url, text_url,
    'Act ' || cast(c AS varchar) AS title, CASE WHEN ord % 3 = 0 THEN 'v1' ELSE 'w' || cast(c AS varchar) END AS doc_uid FROM a
  UNION ALL SELECT ord, term, 1, 'https://nz/' || cast(ord % 4 AS varchar) || '.xml', '', '', 'again' FROM a
  UNION ALL SELECT ord, term, 2, 'https://nz/0.xml', '', 'B', 'w2' FROM a WHERE ord % 4 <> 0)
SELECT ord, term, url, text_url, title, doc_uid FROM r
""",
)
def nz_rows(spark, sf):
    return extract.nz_rows(_payload(spark, sf, "nz", NZ)).select(
        "ord", "term", "url", "text_url", "title", "doc_uid"
    )


US = """
SELECT o_orderkey AS ord, concat('term ', cast(o_custkey % 50 AS string)) AS term, concat('{"data": [{"id": "D-', cast(o_orderkey AS string), '", "links": {"self": " https://us/',
  cast(o_orderkey AS string), ' "}, "attributes": {"title": "", "documentTitle": "Notice ', cast(o_orderkey AS string), '"}}, {"id": "E-', cast(o_orderkey AS string), '", "attributes": {"title": "T"}}]}') AS body
FROM [[orders]]
"""


@query(
    "us_rows",
    """
WITH r AS (SELECT o_orderkey AS ord, 'term ' || cast(o_custkey % 50 AS varchar) AS term, 0 AS i, 'D-' || cast(o_orderkey AS varchar) AS api_id,
    'https://us/' || cast(o_orderkey AS varchar) AS url, 'Notice ' || cast(o_orderkey AS varchar) AS title FROM orders
  UNION ALL SELECT o_orderkey, 'term ' || cast(o_custkey % 50 AS varchar), 1, 'E-' || cast(o_orderkey AS varchar), '', 'T' FROM orders)
SELECT term, ord, api_id, url, title FROM r
""",
)
def us_rows(spark, sf):
    return extract.us_rows(_payload(spark, sf, "us", US)).select("term", "ord", "api_id", "url", "title")


DETAIL = """
SELECT o_orderkey AS ord, concat('{"data": {"attributes": {"title": "Rule ', cast(o_orderkey AS string), '", "documentType": "Rule", "summary": "About ', o_orderpriority,
  '", "fileFormats": [{"fileUrl": "https://f/', cast(o_orderkey AS string), '.pdf", "format": "pdf"}, {"fileUrl": "https://f/', cast(o_orderkey AS string), '/content.htm", "format": "HTM"}, {"fileUrl": "", "format": "txt"}]}}, ',
  '"included": [{"type": "attachments", "attributes": {"title": " A ", "docOrder": ', cast(o_orderkey % 3 AS string), ', "fileFormats": [{"fileUrl": "https://f/a', cast(o_orderkey AS string), '.pdf", "format": "pdf"}]}}, ',
  '{"type": "attachments", "attributes": {"title": "B", "docOrder": 1, "fileFormats": [{"fileUrl": "https://f/b.xls", "format": "xls"}, {"fileUrl": "https://f/', cast(o_orderkey AS string), '.pdf", "format": "pdf"}, {"fileUrl": "https://f/b.pdf", "format": "pdf"}]}}, {"type": "other"}]}') AS body
FROM [[orders]]
"""


@query(
    "rank_downloads",
    """
WITH o AS (SELECT o_orderkey AS ord, cast(o_orderkey AS varchar) AS k FROM orders),
c AS (SELECT ord, 'https://f/' || k || '.pdf' AS file_url, 'pdf' AS format, 200 AS s, 40 AS f, 0 AS b, 0 AS a, '' AS attachment_title FROM o
  UNION ALL SELECT ord, 'https://f/' || k || '/content.htm', 'htm', 200, 50, 20, 0, '' FROM o
  UNION ALL SELECT ord, 'https://f/a' || k || '.pdf', 'pdf', 100, 40, 0, -(ord % 3), 'A' FROM o
  UNION ALL SELECT ord, 'https://f/b.xls', 'xls', 100, -1000, 0, -1, 'B' FROM o
  UNION ALL SELECT ord, 'https://f/b.pdf', 'pdf', 100, 40, 0, -1, 'B' FROM o)
SELECT ord, cast(row_number() OVER (PARTITION BY ord ORDER BY s DESC, f DESC, b DESC, a DESC, file_url DESC) AS int) AS rank,
  file_url, format, CASE s WHEN 200 THEN 'document' ELSE 'attachment' END AS source_kind, attachment_title FROM c
""",
)
def rank_downloads(spark, sf):
    details = extract.us_detail(_payload(spark, sf, "detail", DETAIL))
    return extract.us_downloads(details, "ord").drop("attachment_order")


@query(
    "us_texts",
    """SELECT o_orderkey AS ord, 'title: Rule ' || cast(o_orderkey AS varchar) || chr(10) || 'documentType: Rule' || chr(10) ||
  'About ' || o_orderpriority AS text FROM orders""",
)
def us_texts(spark, sf):
    return extract.us_detail(_payload(spark, sf, "detail", DETAIL)).select("ord", "text")


# ---- links of result pages -------------------------------------------------------------

RESULT_PAGE = """
SELECT o_orderkey AS ord, concat('https://www.legislation.gov.au/C2004A', lpad(cast(o_custkey AS string), 5, '0'), '/latest/text') AS url,
  concat('<p><a href="/ukpga/', cast(1990 + o_custkey % 30 AS string), '/', cast(o_custkey AS string), '/contents#x">UK <b>act</b></a><a href="/ukpga/', cast(1990 + o_custkey % 30 AS string), '/', cast(o_custkey AS string), '">again</a>',
  '<noscript><a href="/C2004A', lpad(cast(o_custkey AS string), 5, '0'), '/latest">AU act</a></noscript>',
  '<a href="https://laws-lois.justice.gc.ca/eng/acts/O-', cast(o_custkey % 9 AS string), '/section-2.html#s">Oceans Act - S.C. 1996, c. 31 (Section 2)</a><a href="https://laws-lois.justice.gc.ca/fra/x.html"> </a>',
  '<a href="/C2004A', lpad(cast(o_custkey AS string), 5, '0'), '/2020/text/original/epub/OEBPS/document_2/document_2.html#p">2</a>',
  '<i data="https://www.legislation.gov.au/C2004A', lpad(cast(o_custkey AS string), 5, '0'), '/2020/text/1/epub/OEBPS/document_1/document_1.html"></i>') AS html
FROM [[orders]]
"""
AU = "lpad(cast(o_custkey AS varchar), 5, '0')"


@query(
    "result_links",
    f"""
SELECT 'uk' AS kind, o_orderkey AS ord, 'https://www.legislation.gov.uk/ukpga/' || cast(1990 + o_custkey % 30 AS varchar) || '/' || cast(o_custkey AS varchar) AS url, '' AS title FROM orders
UNION ALL SELECT 'au', o_orderkey, 'https://www.legislation.gov.au/C2004A' || {AU} || '/latest', 'AU act' FROM orders
UNION ALL SELECT 'ca', o_orderkey, 'https://laws-lois.justice.gc.ca/eng/acts/O-' || cast(o_custkey % 9 AS varchar) || '/', 'Oceans Act' FROM orders
UNION ALL SELECT 'au text', o_orderkey, 'https://www.legislation.gov.au/C2004A' || {AU} || '/2020/text/1/epub/OEBPS/document_1/document_1.html', '1' FROM orders
UNION ALL SELECT 'au text', o_orderkey, 'https://www.legislation.gov.au/C2004A' || {AU} || '/2020/text/original/epub/OEBPS/document_2/document_2.html', '2' FROM orders
""",
)
def result_links(spark, sf):
    captured = _payload(spark, sf, "result_page", RESULT_PAGE).withColumnRenamed("url", "page_url")
    # four link tables are made from each page, so the read links are stored once, in columns
    read = saved(extract.read_pages(captured, url="page_url", parts=["links"]), "links")
    kind = lambda df, k, u, t: df.select(F.lit(k).alias("kind"), "ord", F.col(u).alias("url"), t.alias("title"))
    assets = extract.au_text_assets(read, "ord", "page_url")
    return (
        kind(extract.uk_result_links(read, "ord"), "uk", "doc_url", F.lit(""))
        .unionByName(kind(extract.au_result_links(read, "ord"), "au", "doc_url", F.col("title")))
        .unionByName(kind(extract.ca_result_links(read, "ord"), "ca", "canonical_url", F.col("title")))
        .unionByName(kind(assets, "au text", "asset_url", F.col("part").cast("string")))
    )
