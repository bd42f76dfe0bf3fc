"""Quality, failure and format rules for retrieved texts and links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexcorpus import lookups as L
from lexcorpus.functions.text import empty, strip, text_or_empty

ADDRESS = "https?://"
NAMESPACE = "xmlns:|rdf:|skos:|dcterms:|owl:"


def _count(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern))


def text_problem(text: Column, min_chars: int = 300) -> Column:
    """Why a text is no usable full text; empty when it is one."""
    x = text_or_empty(text)
    low, n = F.lower(x), F.length(x)
    return (
        F.when(x == "", "empty_text")
        .when(n < min_chars, "short_text")
        .when(_count(low, NAMESPACE) >= 2, "metadata_response_namespace_heavy")
        .when((n < 3000) & (_count(low, ADDRESS) >= 12), "metadata_response_uri_heavy")
        .otherwise(empty())
    )


def metadata_problem(body: Column, visible: Column, url: Column, content_type: Column) -> Column:
    """Why a response body is catalogue metadata and no document; empty when it is none."""
    u, t = F.lower(F.coalesce(url, empty())), F.lower(F.coalesce(content_type, empty()))
    low = F.lower(F.coalesce(body, empty()))
    return (
        F.when(F.contains(u, F.lit("/rdf/object/full")), "metadata_response_rdf_url")
        .when(t.rlike(r"application/rdf\+xml|application/ld\+json"), "metadata_response_rdf_type")
        .when(low.rlike("<rdf:rdf|xmlns:rdf="), "metadata_response_rdf_xml")
        .when(low.rlike("<skos:concept|<owl:|<dcterms:"), "metadata_response_metadata_xml")
        .when(low.rlike("<!doctype rdf|<sparql"), "metadata_response_xml_payload")
        .when(
            (_count(low, ADDRESS) >= 8) & (F.length(visible) < 2000), "metadata_response_uri_heavy"
        )
        .otherwise(empty())
    )


def measure_metadata_problem(body: Column, url: Column, content_type: Column) -> Column:
    """As ``metadata_problem``, with the limits used for national measures: a body of up to
    5,000 characters is heavy with addresses if it has over 40."""
    u, t = F.lower(F.coalesce(url, empty())), F.lower(F.coalesce(content_type, empty()))
    low = F.lower(F.coalesce(body, empty()))
    rdf = (
        F.contains(u, F.lit("/rdf/"))
        | F.contains(t, F.lit("application/rdf+xml"))
        | F.contains(low, F.lit("<rdf:rdf"))
    )
    return (
        F.when(rdf, "metadata_rdf")
        .when((_count(low, ADDRESS) > 40) & (F.length(low) < 5000), "metadata_uri_heavy")
        .when(low.rlike("xmlns:rdf|dcterms:"), "metadata_xml")
        .otherwise(empty())
    )


def not_available(body: Column) -> Column:
    low = F.lower(F.coalesce(body, empty()))
    return (F.length(low) < 300) | low.rlike(
        "not available in (this|the) language"
        "|requested document is not available"
        "|page you requested cannot be found"
        "|document not found"
        "|could not be found"
        "|no html content"
    )


def failure(status: Column, error: Column, celex_class: Column, support: Column) -> Column:
    """Category of a failed retrieval; the first rule that fits names it."""
    code = F.coalesce(status.cast("int"), F.lit(0))
    e = F.lower(F.coalesce(error, empty()))
    has = lambda word: F.contains(e, F.lit(word))
    return (
        F.when(support == "unsupported_celex_type_for_fulltext", support)
        .when(has("route_exhausted_after_202"), "route_exhausted_after_202")
        .when(has("sector0_route_mismatch"), "sector0_route_mismatch")
        .when(has("no_text_representation_for_type"), "no_text_representation_for_type")
        .when(F.startswith(e, F.lit("metadata_response")), "metadata_rdf_reject")
        .when(has("timeout"), "timeout")
        .when(has("parse_error"), "parse_error")
        .when((code == 202) | has("http 202"), "http_202")
        .when(
            (code == 404) | has("http 404"),
            F.when(celex_class == "sector_0_consolidated", "sector0_route_mismatch").otherwise(
                "404_not_found"
            ),
        )
        .when(has("empty_text"), "empty_text_after_successful_fetch")
        .when(code >= 400, F.concat(F.lit("http "), code.cast("string")))
        .otherwise("HTML missing")
    )


def retrieval_status(text_len: Column, error: Column) -> Column:
    e = F.coalesce(error, empty())
    return (
        F.when(e == "waf_challenge", "upstream_blocked")
        .when(e != "", "error")
        .when(text_len > 0, "ok")
        .otherwise("missing_text")
    )


def source_format(url: Column, content_type: Column) -> Column:
    u, t = F.lower(F.coalesce(url, empty())), F.lower(F.coalesce(content_type, empty()))
    ends = lambda s: F.endswith(u, F.lit(s))
    has = lambda s: F.contains(t, F.lit(s))
    return (
        F.when(ends(".pdf") | has("application/pdf"), "pdf")
        .when(ends(".docx") | has("wordprocessingml"), "docx")
        .when(ends(".doc") | has("msword"), "doc")
        .when(has("html") | ends(".htm") | ends(".html"), "html")
        .otherwise("binary")
    )


def _direct(low: Column, as_file: Column) -> Column:
    return (
        F.when(F.endswith(low, F.lit(".pdf")), "direct_text_pdf")
        .when(F.endswith(low, F.lit(".docx")), "direct_text_docx")
        .when(F.endswith(low, F.lit(".doc")), "direct_text_doc")
        .when(as_file, "direct_text_file")
    )


def page_link_type(url: Column, label: Column) -> Column:
    """Kind of a link found on a page."""
    low = F.lower(url)
    has = lambda word: F.contains(low, F.lit(word))
    return F.coalesce(
        _direct(low, low.rlike(r"\.rtf|\.odt|\.txt|download|file=")),
        F.when(has("eli"), "national_website_eli"),
        F.when(
            (has("machine") & has("translat"))
            | F.contains(F.lower(label), F.lit("machine translation")),
            "machine_translation",
        ),
        F.lit("national_website"),
    )


def record_link_type(url: Column, element: Column) -> Column:
    """Kind of a link found in a measure's metadata record."""
    low = F.lower(url)
    has = lambda word: F.contains(low, F.lit(word))
    as_file = low.rlike(r"\.rtf|\.odt|\.txt") | low.rlike(
        r"[?&](?:format|download|file)=(pdf|docx|doc|rtf|txt)\b"
    )
    site = F.contains(F.lower(element), F.lit("website")) | ~(
        has("publications.europa.eu") | has("w3.org")
    )
    return F.coalesce(
        _direct(low, as_file),
        F.when(has("machine") & has("translat"), "machine_translation"),
        F.when(has("eli"), "national_website_eli"),
        F.when(site, "national_website"),
        F.lit("other"),
    )


def link_format(link_type: Column) -> Column:
    return (
        F.when(link_type == "direct_text_file", "binary")
        .when(
            F.startswith(link_type, F.lit("direct_text_")),
            F.substring_index(link_type, "_", -1),
        )
        .otherwise("html")
    )


def route_priority(route: Column) -> Column:
    place = F.array_position(F.array(*[F.lit(r) for r in L.ROUTE_ORDER]), strip(route))
    return F.when(place > 0, place - 1).otherwise(len(L.ROUTE_ORDER) + 100).cast("int")
