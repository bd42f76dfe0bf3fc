"""Inputs derived from the given tables, in SQL that Spark and the checking engine both read.

``[[name]]`` stands for a given table or for another derived input.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from lexcorpus.session import new_path
from lexcorpus.sinks.texts import store_texts

TABLES = frozenset(
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations".split()
)

BOM = "﻿"
ISO3 = "AUTBELBGRHRVCYPCZEDNKESTFINFRADEUGRCHUNIRLITALVALTULUXMLTNLDPOLPRTROUSVKSVN"
STATES = (
    "Austria", "Belgium", "Bulgaria", "Croatia", "Cyprus", "Czechia", "Denmark", "Estonia",
    "Finland", "France", "Germany", "Greece", "Hungary", "Ireland", "Italy", "Latvia",
    "Lithuania", "Luxembourg", "Malta", "Netherlands", "Poland", "Portugal", "Romania",
    "Slovakia", "Slovenia",
)


def s(x: str) -> str:
    return f"cast({x} AS string)"


def pick(number: str, *values: str) -> str:
    """One of ``values`` (SQL expressions) by a number."""
    cases = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
    return f"(CASE {number} % {len(values)} {cases} END)"


def pad(x: str, n: int) -> str:
    return f"lpad({s(x)}, {n}, '0')"


def act(key: str, letters: str = "LRDH") -> str:
    return (
        f"concat('3', {s(f'1990 + {key} % 30')}, "
        f"substr('{letters}', cast({key} % {len(letters)} AS int) + 1, 1), "
        f"{pad(f'{key} % 10000', 4)})"
    )


def versioned(key: str) -> str:
    return f"concat({act(key)}, CASE WHEN {key} % 5 = 0 THEN '-20200101' ELSE '' END)"


NL = "chr(10)"
DISCLAIMER = (
    "concat('This text is meant purely as a documentation tool and has no legal effect. "
    "The Union', chr(39), 's institutions do not assume any liability for its contents.')"
)
CAUTION = (
    "'CAUTION: This email originated from outside EPA, please exercise additional caution when "
    "deciding whether to open attachments or click links from this email. '"
)
BASE = "concat('3', cast(year(o_orderdate) AS string), " \
    "substr('LRDH', cast(o_orderkey % 4 AS int) + 1, 1), lpad(cast(o_orderkey % 3000 AS string), 4, '0'))"

INPUTS: dict[str, str] = {}

INPUTS["docs"] = f"""
SELECT doc_id AS ord,
  concat(CASE WHEN doc_id % 26 = 14 THEN 'DOC:' ELSE 'doc:' END,
         {s('doc_id - CASE WHEN doc_id % 13 = 1 THEN 1 ELSE 0 END')}) AS document_id,
  source AS source_name,
  CASE doc_id % 37 WHEN 5 THEN 'Untitled' WHEN 6 THEN ' n/A ' WHEN 7 THEN NULL
    ELSE concat('  Notice ', md5(text), ' of ', source, chr(160), ' ', chr(9)) END AS title,
  CASE doc_id % 5
    WHEN 0 THEN concat(' ', {act('doc_id % 300')}, ' ')
    WHEN 1 THEN concat('ref ', lower({act('doc_id % 300')}))
    WHEN 2 THEN '' ELSE NULL END AS source_document_id,
  text AS summary,
  {pick('doc_id', "'Regulation'", "' Decision '", "'Opinion'", "'Policy Paper (Draft)'",
        "'unknown descriptor'", 'NULL', "'  '", "'--'", "'Tribunal  case'")} AS document_type,
  {pick('doc_id', 'upper(lang)', "concat(' ', lang)", "''", 'NULL')} AS language,
  {pick('doc_id', "'eu'", "' UK '", "'Canada'", "'USA'", "'new zealand'", "'Atlantis'", 'NULL')}
    AS jurisdiction,
  {pick('doc_id', s('1990 + doc_id % 35'),
        f"concat('20', {pad('doc_id % 25', 2)}, '-', {pad('1 + doc_id % 14', 2)})",
        f"concat('2019-', {pad('1 + doc_id % 13', 2)}, '-', {pad('1 + doc_id % 31', 2)})",
        f"concat('2020/', {s('1 + doc_id % 12')}, '/', {s('1 + doc_id % 32')})",
        f"concat({s('1 + doc_id % 31')}, '.', {s('1 + doc_id % 12')}, '.2018')",
        "'circa  1999'", 'NULL', "'  '")} AS publication_date,
  {pick('doc_id', "'2020-02-30'", "'2024-02-29'", "'0000-01-01'", "'20200101'")} AS effective_date,
  concat(CASE WHEN doc_id % 3 = 0 THEN 'https://www.' ELSE 'HTTPS://' END, 'Example.org',
    {pick('doc_id', "':8080'", "':0'", "''")}, '/legal//doc', {s('doc_id % 97')},
    CASE WHEN doc_id % 2 = 0 THEN '/' ELSE '' END,
    {pick('doc_id', "'?b=2&a=%C3%A9&empty'", "'?a=%c3%a9&&b=2&empty='", "'#part'", "''",
          "'?q=x+y&q=a%20b~*'")}) AS url,
  CAST(NULL AS string) AS download_url,
  {pick('doc_id',
        f"concat('Consolidated text: Some Act', {NL}, ' ', {NL}, '02014L0089-20200101 x', {NL}, text)",
        f"concat({DISCLAIMER}, {NL}, text)",
        "concat('XML Schema  XML ', chr(9), 'Schema. This document describes the XML Schema ', text)",
        f"concat({CAUTION}, text)",
        f"concat('{BOM}', replace(text, {NL}, concat(chr(13), {NL}, {NL}, {NL})))",
        f"concat(replace(text, ' ', concat(' ', chr(160), chr(9))), {NL}, {NL}, {NL}, ' ')",
        'text', f"concat('C_2023157EN.xml', {NL}, text)", "concat('   ', text)", "concat(text, chr(9))", 'text')} AS full_text
FROM [[documents]]
"""

INPUTS["ids"] = f"""
SELECT o_orderkey AS ord, CASE o_orderkey % 16
  WHEN 4 THEN concat({BASE}, 'R(0', {s('o_orderkey % 9 + 1')}, ')')
  WHEN 5 THEN concat('0', substr({BASE}, 2, 20), '-20200101')
  WHEN 6 THEN concat('0', {BASE}, '-20150630')
  WHEN 7 THEN concat('7', {BASE}, 'DNK_', {s('o_orderkey')})
  WHEN 8 THEN concat('7', substr({BASE}, 2, 20), 'DNK_', {s('o_orderkey')})
  WHEN 9 THEN concat('5', substr({BASE}, 2, 4), 'PC', {pad('o_orderkey % 3000', 4)})
  WHEN 10 THEN concat('6', substr({BASE}, 2, 4), 'CJ', {pad('o_orderkey % 3000', 4)}, '_INF')
  WHEN 11 THEN concat(' see celex:', lower({BASE}), ' and ', {s('o_orderkey')})
  WHEN 12 THEN CASE WHEN o_orderkey % 32 = 12 THEN '' ELSE NULL END
  WHEN 13 THEN concat('0', substr({BASE}, 2, 4), 'X_', {pad('o_orderkey % 3000', 4)}, '(01)')
  WHEN 14 THEN concat('8', substr({BASE}, 2, 4), 'ZZ', {pad('o_orderkey % 3000', 4)}, '-2020_1')
  WHEN 15 THEN concat('e', substr({BASE}, 2, 4), 'j 0001/', {s('o_orderkey % 10')}, 'R(02)')
  ELSE {BASE} END AS raw_id,
  o_custkey, o_totalprice
FROM [[orders]]
"""

INPUTS["hits"] = f"""
SELECT o_orderkey AS ord, 'EU' AS source,
  {pick('o_orderkey', "'ALL_ALL'", "'EU_LAW_ALL'", "' '")} AS scope,
  {pick('o_orderkey', "'en'", "'fr'", "'de'", "NULL", "'es'")} AS lang,
  {pick('o_orderkey', "'nature repair'", "'net gain'", "'nature restoration'")} AS term_group,
  {pick('o_orderkey', "concat(' Act of ', o_orderpriority, ' ')", "''", 'NULL',
        "concat('On ', o_orderstatus, ' and ', o_orderpriority)")} AS title,
  CASE WHEN o_orderkey % 41 = 0 THEN NULL WHEN o_orderkey % 41 = 1 THEN ''
    WHEN o_custkey % 17 = 3 THEN concat('0', substr({act('o_custkey')}, 2, 20), '-20200101')
    WHEN o_custkey % 17 = 4 THEN concat('7', {act('o_custkey')}, 'DNK_', {s('o_custkey')})
    WHEN o_custkey % 17 = 5 THEN concat('5', substr({act('o_custkey')}, 2, 4), 'DC0', {s('o_custkey')})
    ELSE {versioned('o_custkey')} END AS celex,
  {pick('o_orderkey', "''", s('year(o_orderdate)'), "'2014-07-23'")} AS date,
  concat('https://eur-lex.europa.eu/legal-content/EN/TXT/?uri=CELEX:', {s('o_custkey')}) AS url
FROM [[orders]]
"""

INPUTS["log"] = f"""
SELECT event_id AS ord, {versioned('user_id')} AS celex_full,
  {pick('event_id', "'en'", "'fr'", "'de'")} AS lang,
  CASE WHEN event_id % 4 = 0 THEN repeat('x ', cast(event_id % 700 AS int)) ELSE '' END AS text,
  concat('https://texts.example.org/', {s('event_id % 100')}) AS source_url,
  CASE event_type WHEN 'click' THEN '200' WHEN 'view' THEN '200' WHEN 'error' THEN '404'
    WHEN 'signup' THEN '503' ELSE CASE WHEN event_id % 2 = 0 THEN '202' ELSE 'n/a' END END
    AS retrieval_status,
  CASE event_type WHEN 'click' THEN '' WHEN 'view' THEN 'empty_text'
    WHEN 'error' THEN {pick('event_id', "'HTTP 404'", "'metadata_response_rdf_url'", "'Read Timeout'")}
    WHEN 'signup' THEN {pick('event_id', "''", "'parse_error'", "'route_exhausted_after_202'")}
    ELSE NULL END AS retrieval_error,
  CASE event_id % 9 WHEN 0 THEN NULL WHEN 1 THEN '-1' WHEN 2 THEN 'abc'
    ELSE {s('cast(floor(value * 20) AS int)')} END AS text_len,
  {s('ts')} AS timestamp,
  {pick('event_id', "'direct_text_pdf'", "'national_website'", "''")} AS text_route_used,
  {pick('event_id', "'cellar'", "''")} AS route_used
FROM [[events]]
"""

INPUTS["files"] = f"""
SELECT CASE WHEN c_custkey % 3 = 0 THEN {versioned('c_custkey')}
    ELSE concat('unlisted-', {s('c_custkey')}) END AS celex_full,
  cast(floor(abs(c_acctbal)) AS int) % 1500 AS file_text_len,
  concat('/cache/', {s('c_custkey')}, '.txt') AS text_path, true AS file_exists
FROM [[customer]]
"""

INPUTS["doc_list"] = f"""
SELECT c_custkey AS ord, {versioned('c_custkey')} AS celex_full,
  concat('Act ', c_name) AS title,
  concat('https://example.org/', {s('c_custkey')}) AS url,
  {pick('c_custkey', "'en'", "''", "'fr'")} AS lang
FROM [[customer]]
"""

INPUTS["foreign_hits"] = f"""
SELECT o_orderkey AS ord,
  {pick('o_custkey', "'UK'", "'AUS'", "'CA'", "'NZ'", "'US'", "'Norway'", "'Canada'")} AS source,
  {pick('o_custkey', "'United Kingdom'", "'Australia'", "'Canada'", "'New Zealand'",
        "'United States'", "'Norway'", "'Canada'")} AS jurisdiction,
  CASE WHEN o_orderkey % 50 = 9 THEN ' ' ELSE {pick('o_custkey',
    f"concat('http://www.legislation.gov.uk/ukpga/', {s('1980 + o_custkey % 40')}, '/', {s('o_custkey')}, '/contents?x=1')",
    f"concat('https://www.legislation.gov.au/c2', {pad('o_custkey % 100', 3)}, 'A', {pad('o_custkey', 5)}, '/latest/text')",
    f"concat('https://laws-lois.justice.gc.ca/eng/Acts/O-', {s('o_custkey % 90')}, '.', {s('o_orderkey % 2')}, '/section-2.html#s')",
    f"concat('https://www.legislation.govt.nz/act/public/', {s('1990 + o_custkey % 30')}, '/00', {s('o_custkey')}, '/latest/')",
    f"concat('https://api.regulations.gov/v4/documents/EPA-', {s('2000 + o_custkey % 20')}, '-', {s('o_custkey')}, '?api=1')",
    f"concat('HTTPS://Lovdata.NO/dokument//', {s('o_custkey % 300')}, '/;v=1?q=2')",
    f"concat('https://publications.gc.ca/site/', {s('o_custkey')}, '/publication.html')")} END AS url,
  concat('https://fallback.example.org/d/', {s('o_custkey')}, '/') AS doc_url,
  {pick('o_orderkey', "concat('PDF Marine Act ', cast(year(o_orderdate) AS string), '  - Legislation.gov.uk ')",
        "concat('Notice of ', o_orderpriority, ' 1875/', cast(o_custkey AS string))", "'nan'", 'NULL',
        "concat('Oceans Regulations SOR/', cast(year(o_orderdate) AS string), '-0', cast(o_custkey AS string))",
        "concat('Fisheries report : Fs', cast(o_custkey % 9 AS string), '-1/2011E-PDF')",
        "concat(' Order ', o_orderstatus, ' of 12', cast(year(o_orderdate) AS string))")} AS title,
  {pick('o_orderkey', "'nature repair'", "'net gain'", "'biodiversity strategy'", "NULL")} AS term,
  {pick('o_orderkey', "'en'", 'NULL', "'fr'")} AS lang
FROM [[orders]]
"""

INPUTS["measures"] = f"""
SELECT cast((l_orderkey * 8 + l_linenumber) * 100000000
    + l_partkey % 10000 * 10000 + l_suppkey % 10000 AS bigint) AS ord, {act('l_partkey', 'LRD')} AS celex,
  concat('Act on ', p_name) AS eu_act_title, p_type AS eu_act_type,
  cast(1990 + l_partkey % 30 AS int) AS year,
  {s('l_orderkey')} AS national_measure_id,
  concat('7', substr({act('l_partkey', 'LRD')}, 2, 20),
    substr('{ISO3}', cast(n_nationkey AS int) * 3 + 1, 3), '_', {s('l_orderkey')}) AS nim_celex,
  substr('{ISO3}', cast(n_nationkey AS int) * 3 + 1, 3) AS member_state_iso3,
  CASE WHEN l_linenumber = 7 THEN '' ELSE {pick('n_nationkey', *[f"'{x}'" for x in STATES])} END
    AS member_state_name,
  cast(p_size AS double) AS governance_gap_score,
  cast(p_retailprice AS double) AS ecological_ambition_score,
  CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE cast(p_size AS double) / 2 END
    AS design_specificity_score,
  {pick('l_orderkey', "'dan,eng'", "''", "'xxx'", "' fra , deu '", "'nan'")} AS available_expr_langs3,
  {pick('l_linenumber', "'DA'", "'fra'", "''", "'zzz'", "'nan'")} AS nim_title_lang,
  CASE WHEN l_linenumber % 3 = 0 THEN '' ELSE concat('Measure ', {s('l_orderkey')}) END AS nim_title,
  {pick('l_suppkey', "concat('https://eur-lex.europa.eu/legal-content/EN/TXT/?uri=CELEX:7', cast(l_orderkey AS string))",
        "concat('https://eur-lex.europa.eu/legal-content/FR/TXT/?uri=', cast(l_orderkey AS string))",
        "''")} AS eurlex_url,
  concat('2016-0', {s('1 + l_linenumber')}, '-01') AS nim_date,
  '' AS nim_resource_uri
FROM [[lineitem]] JOIN [[part]] ON l_partkey = p_partkey
JOIN [[supplier]] ON l_suppkey = s_suppkey JOIN [[nation]] ON s_nationkey = n_nationkey
"""


def render(template: str, table, derived=None) -> str:
    """Fill the ``[[name]]`` marks; ``table`` names a given table for the engine, ``derived`` a
    derived input (which is written out in place without it)."""

    def fill(match: re.Match) -> str:
        name = match.group(1)
        if name in TABLES:
            return table(name)
        return derived(name) if derived else f"({render(INPUTS[name], table)})"

    return re.sub(r"\[\[(\w+)\]\]", fill, template)


#: Inputs that are read in place: a query then computes only the columns that it uses, and none of their
#: wide rows are dealt or written. The others are stored, as their rules refer to a column many times.
IN_PLACE = frozenset(("docs", "measures"))

_written: dict[tuple[str, str, str], str] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> str:
    """Folder of an input built by ``build``. It is written once per application, so that a job
    reads it as it would read a stored table, and filters do not drag the derivation along."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        path = new_path(spark, f"input-{name}")
        build().write.parquet(path)
        _written[key] = path
    return _written[key]


_bucketed: dict[tuple[str, str, str], DataFrame] = {}


def bucketed(
    spark: SparkSession, sf_dir: str, name: str, keys: Sequence[str], build: Callable[[], DataFrame],
    least: int = 0, derive: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Captured texts built by ``build``, stored once per application in buckets by ``keys``: ``least`` buckets,
    or as many as there are shuffle partitions if those are more."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _bucketed:
        buckets = max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))
        _bucketed[key] = store_texts(build(), keys, buckets, derive=derive)
    return _bucketed[key]


def _path(spark: SparkSession, sf_dir: str, name: str) -> str:
    return stored(spark, sf_dir, name, lambda: spread(spark, sf_dir, INPUTS[name]))


def _sql(spark: SparkSession, sf_dir: str, template: str, table: str = "parquet.`{}`") -> DataFrame:
    given = lambda t: table.format(f"{sf_dir}/{t}.parquet")

    def derived(name: str) -> str:
        if name in IN_PLACE:
            return f"({render(INPUTS[name], given, derived)})"
        return f"parquet.`{_path(spark, sf_dir, name)}`"

    return spark.sql(render(template, given, derived))


def spread(spark: SparkSession, sf_dir: str, template: str) -> DataFrame:
    """``run`` with the rows of the given tables dealt to tasks of about equal size, as many as their
    bytes need. They are dealt before anything is derived from them, when they are still short."""
    return _sql(spark, sf_dir, template, "(SELECT /*+ REBALANCE */ * FROM parquet.`{}`)")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table or a derived input."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if name in IN_PLACE:
        return _sql(spark, sf_dir, INPUTS[name])
    return spark.read.parquet(_path(spark, sf_dir, name))


def run(spark: SparkSession, sf_dir: str, template: str) -> DataFrame:
    return _sql(spark, sf_dir, template)


def oracle(template: str) -> str:
    return render(template, lambda t: t).strip()
