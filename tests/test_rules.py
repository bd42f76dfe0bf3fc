"""Column rules on small literals."""

import pytest
from pyspark.sql import functions as F

from lexcorpus.functions import celex, dates, langs, nation, quality, text, urls


def one(spark, value, rule):
    df = spark.createDataFrame([(value,)], "x string")
    return df.select(rule(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "value, expected",
    [
        ("  Proposal\n\nfor a   Regulation\xa0 ", "Proposal for a Regulation"),
        ("﻿Untitled ", None),
        (" N/A", None),
        ("   ", None),
        (None, None),
    ],
)
def test_title(spark, value, expected):
    assert one(spark, value, text.title) == expected


@pytest.mark.parametrize(
    "value, expected",
    [
        ("Regulation", "eu_regulation"),
        ("Tribunal  case", "eu_case_law"),
        ("White Paper (2020)", "white_paper_2020"),
        ("--", None),
    ],
)
def test_document_type(spark, value, expected):
    assert one(spark, value, text.document_type) == expected


def test_full_text_drops_source_boilerplate(spark):
    raw = (
        "Consolidated text: Directive\n\n02014L0089-20200101 - EN\n\n"
        "This text is meant purely as a documentation tool and has no legal effect. The Union's "
        "institutions do not assume any liability for its contents.\n\nArticle 1\r\n\r\n\r\nPolicy  text."
    )
    assert one(spark, raw, text.full_text) == "Article 1\n\nPolicy text."
    schema = "XML Schema  XML Schema\nabout. This document describes the\nXML Schema of x"
    assert one(spark, schema, text.full_text) is None
    assert one(spark, "a\x85b c", text.full_text) == "a\nb\nc"


def test_light_text_drops_file_name_line(spark):
    raw = "C_2023157EN.01003801.xml\n3.5.2023\tEN\nOfficial Journal of the European Union"
    assert one(spark, raw, text.light_text).startswith("3.5.2023 EN")
    assert one(spark, raw, text.cached_text).startswith("3.5.2023 EN")
    kept = "name.xml\nother text"
    assert one(spark, kept, text.cached_text) == kept
    assert one(spark, "name.xml", text.light_text) == "name.xml"


@pytest.mark.parametrize(
    "value, iso, precision",
    [
        ("2024", "2024-01-01", "year"),
        ("2024-02", "2024-02-01", "month"),
        ("2024-13", "2024-13", None),
        ("2024-02-29", "2024-02-29", "day"),
        ("2023-02-29", "2023-02-29", None),
        ("2020/1/5", "2020-01-05", "day"),
        ("23.07.2014\xa0", "2014-07-23", "day"),
        ("0000-01-01", "0000-01-01", None),
        ("July 2014", "July 2014", None),
        (" ", None, None),
    ],
)
def test_dates(spark, value, iso, precision):
    df = spark.createDataFrame([(value,)], "d string")
    row = dates.with_normalized(df, {"d": ("v", "p")}).first()
    assert (row["v"], row["p"]) == (iso, precision)


@pytest.mark.parametrize(
    "value, expected",
    [
        ("https://www.Example.org/legal//doc/?b=2&a=1#x", "https://example.org/legal/doc?a=1&b=2"),
        ("HTTP://user@example.org:0080", "http://example.org:80/"),
        ("https://example.org:0/a?x=%zz&y=~*", "https://example.org/a?x=%25zz&y=~%2A"),
        ("a b/c|d/", "a b/c|d"),
        (" ", ""),
        (None, ""),
    ],
)
def test_comparison_url(spark, value, expected):
    df = spark.createDataFrame([(value,)], "u string")
    assert urls.with_comparison(df, "u", "v").first()["v"] == expected


def test_canonical_url(spark):
    df = spark.createDataFrame([("http://WWW.A.org/x/;v=1?q#f",), (" ",), ("",)], "u string")
    got = [r["v"] for r in urls.with_canonical(df, "u", "v").collect()]
    assert got == ["https://www.a.org/x", "https:///", ""]


@pytest.mark.parametrize(
    "value, sector, descriptor, number, valid",
    [
        ("32014L0089", "3", "L", "0089", True),
        (" 32014l0089 ", "3", "L", "0089", True),
        ("02014L0089-20200101", "0", "L", "0089-20200101", True),
        ("032014L0089-20200101", "0", "L", "0089", True),
        ("732014L0089DNK_270540", "7", "L", "0089", True),
        ("72014L0089DNK_270540", None, None, None, False),
        ("52023PC0304", "5", "PC", "0304", True),
        ("32014L0089R(03)", "3", "L", "0089", True),
    ],
)
def test_celex_parts(spark, value, sector, descriptor, number, valid):
    df = spark.createDataFrame([(value,)], "c string")
    got = celex.with_parsed(df, "c", "p").first()["p"]
    assert (got["sector"], got["descriptor"], got["document_number"], got["valid"]) == (
        sector, descriptor, number, valid,
    )


def test_celex_notes_and_correction(spark):
    df = spark.createDataFrame([("32014L0089R(03)",), ("",), ("732014L0089DNK_1",)], "c string")
    rows = [r["p"] for r in celex.with_parsed(df, "c", "p").collect()]
    assert rows[0]["is_corrigendum"] and rows[0]["corrigendum_number"] == 3
    assert rows[1]["notes"] == "Empty input"
    assert rows[2]["transposed_base_celex"] == "32014L0089"
    assert rows[2]["transposition_country"] == "DNK"


@pytest.mark.parametrize(
    "value, cls",
    [
        ("32014L0089R(03)", "sector_3_legal_acts"),
        ("02014L0089-20200101", "sector_0_consolidated"),
        ("02014L_X(01)", "sector_0_consolidated"),
        ("92014E000001", "sector_9_other"),
        ("nonsense", "unknown_or_invalid"),
    ],
)
def test_celex_class(spark, value, cls):
    df = spark.createDataFrame([(value,)], "celex_full string")
    assert celex.with_class(df).first()["celex_class"] == cls


@pytest.mark.parametrize(
    "value, expected",
    [
        ("52022AR4206", None), ("52023PC0304", None), ("32024R1991", "32024R1991"),
        ("32014L0089-20200101", "32014L0089"), ("032014L0089", None),
        ("32022D0591", "32022D0591"), ("32022H0591", None), (None, None),
    ],
)
def test_eligible_act(spark, value, expected):
    assert one(spark, value, celex.eligible_act) == expected


@pytest.mark.parametrize(
    "source, url, title, expected",
    [
        ("UK", "http://www.legislation.gov.uk/ukpga/2009/23/contents", "", "ukpga_2009_23"),
        ("AUS", "https://www.legislation.gov.au/c2004A00485/latest/text", "", "C2004A00485"),
        ("CA", "https://laws-lois.justice.gc.ca/eng/Acts/O-2.4/x.html", "", "acts_o_2_4"),
        ("CA", "https://x.ca/a", "Oceans Regulations SOR/96-118, SOR/1996-0118", "SOR_1996_118"),
        ("NZ", "https://www.legislation.govt.nz/act/public/1991/0069/latest", "", "act_1991_69"),
        ("US", "https://api.regulations.gov/v4/documents/EPA-1?x", "", "EPA-1"),
        ("Norway", "http://Lov.NO/a/", "", "Norway:https://lov.no/a"),
        ("", "http://a.b/c", "", "UNKNOWN:https://a.b/c"),
        ("EU", "http://a.b/?uri=CELEX:32014L0089", "", "EU:32014L0089"),
    ],
)
def test_document_key(spark, source, url, title, expected):
    df = spark.createDataFrame([(source, url, title)], "source string, url string, title string")
    assert nation.with_document_key(df, "url", "k").first()["k"] == expected


def test_titles_and_years(spark):
    assert one(spark, " PDF Marine Act  2009 - Legislation.gov.uk ", nation.uk_title) == "Marine Act 2009"
    assert one(spark, "Fish report : Fs97-4/2011E-PDF", nation.canada_title) == "Fish report"
    assert one(spark, "Oceans Act - S.C. 1996, c. 31 (Section 2)", nation.canada_act_title) == "Oceans Act"
    assert one(spark, "Act 1999 amended 2004, no 12005", nation.year_in_title) == "2004"
    assert one(spark, "/a/1234/1998/b", nation.year_in_url) == "1998"


def test_canada_texts(spark):
    page = "Menu Search Search Canada.ca Search Menu Main Menu RÃ©sumÃ©  text About this site Government of Canada x"
    assert one(spark, page, nation.canada_page_text) == "Résumé text"
    act = "Top Skip to main content Oceans Act " + "menu " * 20 + "Oceans Act &amp; x Table of Contents a Preamble body"
    df = spark.createDataFrame([(act, "Oceans Act")], "a string, t string")
    got = df.select(nation.canada_act_text(F.col("a"), F.col("t")).alias("y")).first()["y"]
    assert got == "Preamble body"


@pytest.mark.parametrize(
    "url, langs3, title, iso3, expected",
    [
        ("https://e/legal-content/FR/TXT/", "dan", "da", "DNK", ("fr", "url")),
        ("https://e/legal-content/EN/TXT/", "dan,eng", "", "SWE", ("da", "metadata")),
        ("", "", "fra", "SWE", ("fr", "metadata")),
        ("", "nan", "", "BEL", ("nl", "country_fallback")),
        ("https://e/legal-content/EN/TXT/", "", "", "", ("en", "url")),
        ("", "", "", "", ("en", "default_en")),
    ],
)
def test_language_of_measure(spark, url, langs3, title, iso3, expected):
    df = spark.createDataFrame([(url, langs3, title, iso3)], "a string, b string, c string, d string")
    got = df.select(langs.detect(*[F.col(c) for c in "abcd"]).alias("y")).first()["y"]
    assert tuple(got) == expected


def test_quality_and_failures(spark):
    assert one(spark, "x" * 299, quality.text_problem) == "short_text"
    assert one(spark, "rdf: owl: " + "x" * 400, quality.text_problem).endswith("namespace_heavy")
    rows = [
        (404, "", "sector_0_consolidated", "supported", "sector0_route_mismatch"),
        (404, "", "sector_3_legal_acts", "supported", "404_not_found"),
        (200, "metadata_response_x", "", "supported", "metadata_rdf_reject"),
        (503, "", "", "supported", "http 503"),
        (0, "", "", "supported", "HTML missing"),
    ]
    df = spark.createDataFrame(rows, "s int, e string, c string, f string, want string")
    bad = df.where(quality.failure(F.col("s"), F.col("e"), F.col("c"), F.col("f")) != F.col("want"))
    assert bad.count() == 0
    status = spark.createDataFrame(
        [(5, "waf_challenge", "upstream_blocked"), (5, "x", "error"), (5, "", "ok"), (0, None, "missing_text")],
        "n int, e string, want string",
    )
    assert status.where(quality.retrieval_status(F.col("n"), F.col("e")) != F.col("want")).count() == 0
