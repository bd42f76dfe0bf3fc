"""Jobs over tables of captured payloads: pages, search results, notices, API answers.

Reading pages is an Arrow step per payload, since Spark has no HTML reader. XML is read by column
expressions behind a check by Spark's XML reader, JSON by Spark. Choosing, ranking and classifying
what was read are column expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexcorpus import lookups as L
from lexcorpus.functions import batches, celex, langs, nation, quality, xml
from lexcorpus.functions.text import SPACE, collapse, empty, strip, text_or_empty
from lexcorpus.functions.urls import NETLOC, PATH, SCHEME, part, step
from lexcorpus.operators.dedup import cap_per_key, keep_first_narrow

PAGE = {
    "text_lines": "string",
    "text_visible": "string",
    "text_plain": "string",
    "places": "array<struct<tag: string, classes: array<string>, ident: string, text: string>>",
    "links": "array<struct<pos: int, href: string, url: string, label: string>>",
    "metas": "array<struct<name: string, property: string, content: string>>",
}
TITLE_PARTS = ("places", "metas")
def _reader(batch, kind: str):
    """An Arrow reader that runs once per payload. It is marked as not deterministic, because
    Spark would otherwise run it again for the filters it derives from an explode."""
    return F.arrow_udf(batch, kind).asNondeterministic()


# ---- pages -----------------------------------------------------------------------------


def read_pages(
    pages: DataFrame, body: str = "html", url: str = "url", parts: Sequence[str] = tuple(PAGE)
) -> DataFrame:
    """Add struct ``page`` with the named parts: texts, title places, links and meta tags. Only
    these are made and sent back from Python."""
    kind = ", ".join(f"{name} {PAGE[name]}" for name in parts)
    return pages.withColumn("page", _reader(batches.page_batch(tuple(parts)), kind)(body, url))


def page_title(fallback: Column | None = None) -> Column:
    """Readable title of a read page: title tag, headings, marked elements, meta tags."""
    fallback = empty() if fallback is None else fallback
    gap = f"[{SPACE}]*"
    places = F.col("page.places")
    said = F.get(F.filter(places, lambda p: p["tag"] == "title"), F.lit(0))["text"]
    said = strip(F.regexp_replace(said, rf"(?i){gap}[-|]{gap}EUR-Lex.*$", ""))
    said = strip(F.regexp_replace(said, rf"^(?i){gap}EUR-Lex{gap}-{gap}", ""))
    long = lambda cond: F.transform(
        F.filter(places, lambda p: cond(p) & (F.length(p["text"]) > 20)), lambda p: p["text"]
    )
    has_class = lambda name: lambda p: F.array_contains(p["classes"], name)

    def meta(name):
        of = lambda key: F.get(
            F.filter(F.col("page.metas"), lambda m: m[key] == name), F.lit(0)
        )["content"]
        return F.coalesce(of("name"), of("property"))

    found = F.concat(
        F.array(said),
        long(lambda p: p["tag"] == "h1"),
        long(lambda p: p["tag"] == "h2"),
        long(has_class("eli-main-title")),
        long(has_class("title")),
        long(lambda p: p["ident"] == "title"),
        long(has_class("document-title")),
        F.array(meta("DC.title"), meta("citation_title"), meta("title")),
    )
    shown = F.transform(found, lambda t: strip(collapse(t)))
    good = F.filter(
        shown,
        lambda t: t.isNotNull()
        & (F.length(t) >= 15)
        & ~(F.contains(F.lower(t), F.lit("eur-lex")) & (F.length(t) < 40)),
    )
    return F.coalesce(F.get(good, F.lit(0)), strip(fallback), empty())


def page_links(read: DataFrame, *keep: str) -> DataFrame:
    """One row per link of a page with its kind, format, language and rank among the links."""
    rows = read.select(*keep, F.explode("page.links").alias("l")).select(*keep, "l.*")
    kind = quality.page_link_type(F.col("url"), F.col("label"))
    return (
        rows.withColumn("link_type", kind)
        .withColumns(
            {
                "source_format": quality.link_format(F.col("link_type")),
                "lang": langs.lang_of_url(F.col("url")),
                "priority": quality.route_priority(F.col("link_type")),
            }
        )
    )


def _once(ranked: Column) -> Column:
    """A ranked list without what repeats an address (``url``). Addresses are sorted beside their
    places, so that each is compared with its neighbour only."""
    placed = F.transform(ranked, lambda x, i: F.struct(x["url"].alias("url"), i.alias("i"), x.alias("x")))

    def firsts(sorted_by_url: Column) -> Column:
        return F.filter(
            sorted_by_url,
            lambda x, i: (i == 0) | (F.get(sorted_by_url, i - 1)["url"] != x["url"]),
        )

    kept = F.get(F.transform(F.array(F.array_sort(placed)), firsts), F.lit(0))
    back = F.array_sort(F.transform(kept, lambda k: F.struct(k["i"].alias("i"), k["x"].alias("x"))))
    return F.transform(back, lambda k: k["x"])


def ranked_routes(links: Column) -> Column:
    """Links of one record (``url, link_type, ...``) by priority and address, each address once.
    Works inside the row, as a record's links never exceed the record."""
    usable = F.filter(links, lambda x: strip(x["url"]) != "")
    ranked = F.array_sort(
        F.transform(
            usable,
            lambda x: F.struct(
                quality.route_priority(x["link_type"]).alias("priority"), x["url"].alias("url"),
                x.alias("link"),
            ),
        )
    )
    return _once(ranked)


def au_text_assets(read: DataFrame, row_id: str, wrapper: str = "url", body: str = "html"):
    """Addresses of an Australian act's text parts found on its page, each once per page row,
    with the part number that orders them."""
    tail = r"[^\s\"'<>]+/document_\d+/document_\d+\.html(?:#[^\s\"'<>]*)?"
    linked = F.transform("page.links", lambda x: x["url"])
    # addresses hold none of the signs split at, so the patterns are tried only where a part is named
    named = F.filter(F.split(F.col(body), r"[\s\"'<>]+"), lambda t: F.contains(F.lower(t), F.lit("/document_")))
    read = read.withColumns(
        {
            "_named": F.array_join(named, " "), "home": F.lower(part(F.col(wrapper), NETLOC)),
            "act": step(part(F.col(wrapper), PATH), 0),
        }
    )
    full = F.regexp_extract_all(F.col("_named"), F.lit(f"(?i)(https?://{tail})"), F.lit(1))
    bare = F.transform(
        F.regexp_extract_all(F.col("_named"), F.lit(f"(?i)(//{tail})"), F.lit(1)),
        lambda u: F.concat(F.lit("https:"), u),
    )
    placed = F.transform(F.concat(linked, full, bare), lambda u, i: F.struct(i.alias("pos"), u.alias("link")))
    texts = F.filter(placed, lambda x: F.lower(x["link"]).rlike(r"/text/(original|\d+)/epub/"))
    cut = F.transform(
        texts,
        lambda x: F.struct(
            x["pos"].alias("pos"),
            *[part(x["link"], which).alias(name) for name, which in (("scheme", SCHEME), ("host", NETLOC), ("path", PATH))],
        ),
    )
    # the outer form keeps Spark from deriving a filter that would search each page twice
    rows = read.select(row_id, "home", "act", F.explode_outer(cut).alias("x")).select(row_id, "home", "act", "x.*")
    rows = rows.withColumns(
        {
            "asset_url": F.concat("scheme", F.lit("://"), "host", "path"),
            "part": F.regexp_extract("path", r"(?i)/document_(\d+)/document_\1\.html$", 1),
        }
    ).where(
        (F.lower("host") == F.col("home"))
        & (F.col("act").isNull() | (step(F.col("path"), 0) == F.col("act")))
        & (F.col("part") != "")
    )
    return rows.groupBy(row_id, "asset_url").agg(
        F.min("pos").alias("pos"), F.min(F.col("part").cast("int")).alias("part")
    )


def uk_result_links(read: DataFrame, *keep: str) -> DataFrame:
    """Acts linked from a UK result page, each once."""
    rows = read.select(*keep, F.explode("page.links").alias("l"))
    rows = rows.where(nation.is_uk_act(F.col("l.href"))).withColumn(
        "doc_url", nation.uk_act_url(F.col("l.href"))
    )
    return rows.groupBy(*keep, "doc_url").agg(F.min("l.pos").alias("pos"))


def au_result_links(read: DataFrame, *keep: str) -> DataFrame:
    """Register entries linked from an Australian result page, each address and title once."""
    rows = read.select(*keep, F.explode("page.links").alias("l"))
    rows = rows.where(nation.is_au_act(F.col("l.href"))).select(
        *keep,
        F.concat(
            F.lit("https://www.legislation.gov.au"), F.regexp_replace("l.href", "/+$", "")
        ).alias("doc_url"),
        F.col("l.label").alias("title"),
        F.col("l.pos").alias("pos"),
    )
    return rows.groupBy(*keep, "doc_url", "title").agg(F.min("pos").alias("pos")).withColumn(
        "text_url", F.concat("doc_url", F.lit("/text"))
    )


def ca_result_links(read: DataFrame, *keep: str) -> DataFrame:
    """Acts and pages linked from a Canadian result page: address, root address and title."""
    rows = read.select(*keep, F.explode("page.links").alias("l"))
    rows = rows.where(F.contains(F.lower("l.url"), F.lit(nation.JUSTICE_HOST)))  # before parts are cut
    link = F.regexp_replace("l.url", "#.*$", "")
    root = F.nullif(nation.canada_act_url(F.col("l.url")), empty())
    rows = rows.where(
        F.contains(F.lower(part(F.col("l.url"), NETLOC)), F.lit(nation.JUSTICE_HOST))
        & part(F.col("l.url"), PATH).rlike("(?i)^/(eng|fra)/")
    ).select(
        *keep,
        link.alias("result_url"),
        F.coalesce(root, link).alias("canonical_url"),
        nation.canada_act_title(F.col("l.label")).alias("title"),
        F.col("l.pos").alias("pos"),
    )
    return (
        rows.where(F.col("title") != "")
        .groupBy(*keep, "result_url", "canonical_url")
        .agg(F.min_by("title", "pos").alias("title"), F.min("pos").alias("pos"))
    )


# ---- search results and notices --------------------------------------------------------


def _first(values: Column) -> Column:
    return F.get(values, F.lit(0))


# ---- fixed values: fields of search results and notices, parts of acts that are no text --
DATE_FIELDS = (
    "WORK_DATE_DOCUMENT", "DATE_DOCUMENT", "DATE_PUBLICATION", "DATE_ENTRY_INTO_FORCE",
    "RESOURCE_LEGAL_DATE_ENTRY-INTO-FORCE",
)
HIT_FIELDS = ("ID_CELEX", "EXPRESSION_TITLE", "WORK_TITLE", *DATE_FIELDS)
NOTICE_TITLES = ("EXPRESSION_TITLE", "TITLE", "WORK_TITLE")
NOTICE_LANGUAGES = ("EXPRESSION_USES_LANGUAGE", "LANGUAGE")
SKIPPED_XML = ("Metadata", "Versions", "Contents", "Commentaries")


def _exploded(payloads: DataFrame, keep: list[str], found: Column, index: str) -> DataFrame:
    """A row for each element found, as ``_r``. The outer form keeps Spark from deriving a filter
    that would read each payload twice."""
    rows = payloads.select(*keep, F.posexplode_outer(found).alias(index, "_r"))
    return rows.where(F.col("_r").isNotNull())


def _settled(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """``rows`` with ``value`` as a column that is worked out once: as the row of a list of one, it is
    not worked out again by filters on it that Spark moves down, or by columns made from it."""
    return rows.select("*", F.explode_outer(F.array(value)).alias(name))


def parse_hits(payloads: DataFrame, body: str = "body", lang: str = "EN") -> DataFrame:
    """Hits of captured search answers, one row per result; ``celex`` is null where a result
    names no identifier. Answers that are no whole XML give no rows."""
    keep = [c for c in payloads.columns if c != body]
    answers = payloads.select(*keep, xml.first(xml.readable(F.col(body)), "searchResults").alias("_x"))
    rows = _exploded(answers, keep, xml.elements(F.col("_x"), "result"), "result_idx")
    first_of = lambda e, what: F.coalesce(_first(xml.texts(e, what)), empty())
    rows = rows.withColumn(
        "_f",
        F.transform(
            xml.elements(F.col("_r"), *HIT_FIELDS),
            lambda e: F.struct(
                xml.name_of(e).alias("name"), F.transform(xml.texts(e, "LANG"), F.lower).alias("langs"),
                xml.texts(e, "VALUE").alias("values"), first_of(e, "YEAR").alias("year"),
                first_of(e, "MONTH").alias("month"), first_of(e, "DAY").alias("day"),
            ),
        ),
    )
    of = lambda name: F.filter("_f", lambda f: f["name"] == name)

    def value(name):
        valued = F.filter(of(name), lambda f: F.size(f["values"]) > 0)
        own = F.filter(valued, lambda f: F.array_contains(f["langs"], lang.lower()))
        return _first(F.coalesce(_first(own), _first(valued))["values"])

    def number(text, width):
        whole = F.regexp_replace(text, "^0+(?=[0-9])", "")
        padded = F.when(F.length(whole) < width, F.lpad(whole, width, "0")).otherwise(whole)
        return F.when(text.rlike("^[0-9]+$"), padded)

    def date_of(f):
        y, m, d = f["year"], f["month"], f["day"]
        numbers = F.concat_ws("-", number(y, 4), number(m, 2), number(d, 2))
        all_num = lambda *xs: F.concat(*xs).rlike("^[0-9]+$")
        return (
            F.when(F.size(f["values"]) > 0, f["values"][0])
            .when(
                (y != "") & (m != "") & (d != ""),
                F.when(all_num(y, m, d), numbers).otherwise(F.concat_ws("-", y, m, d)),
            )
            .when(
                (y != "") & (m != ""),
                F.when(
                    all_num(y, m), F.concat_ws("-", number(y, 4), number(m, 2))
                ).otherwise(F.concat_ws("-", y, m)),
            )
            .when(y != "", y)
        )

    dates = [
        _first(F.filter(F.transform(of(n), date_of), lambda d: d.isNotNull()))
        for n in DATE_FIELDS
    ]
    said = F.flatten(
        F.transform(
            xml.everything(F.col("_r")), lambda e: F.concat(F.array(xml.own_text(e)), xml.values(e))
        )
    )
    said = F.when(F.lower("_r").contains("celex"), said)
    mentions = F.filter(said, lambda t: F.lower(t).rlike("celex:|/celex/"))
    mentioned = _first(F.filter(F.transform(mentions, celex.token), lambda t: t.isNotNull()))
    rows = _settled(rows, "_celex", F.coalesce(value("ID_CELEX"), mentioned)).select(
        *keep,
        "result_idx",
        F.col("_celex").alias("celex"),
        F.coalesce(value("EXPRESSION_TITLE"), value("WORK_TITLE"), empty()).alias("title"),
        F.coalesce(*dates, empty()).alias("date"),
    )
    address = f"https://eur-lex.europa.eu/legal-content/{lang.upper()}/TXT/?uri=CELEX:"
    return rows.withColumn(
        "url", F.when(F.col("celex").isNotNull(), F.concat(F.lit(address), "celex"))
    )


def found_hits(hits: DataFrame, job: list[str], order: str = "ord") -> DataFrame:
    """Usable hits of search jobs: an identifier, and the first of each identifier per job."""
    return keep_first_narrow(hits.where(F.col("celex").isNotNull()), [*job, "celex"], order)


def _read_notices(rows: DataFrame) -> DataFrame:
    """``rows`` whose ``_r`` is a notice, with what it lists as ``n``: identifiers, dates, titles,
    languages, states and addresses."""
    notice = F.col("_r")
    final = lambda xs: F.coalesce(F.try_element_at(xs, F.lit(-1)), empty())
    gathered = lambda xs, f: F.flatten(F.transform(xs, f))
    of = lambda *names: F.filter("_e", lambda x: x["name"].isin(*names))

    def listed(x):
        """Own values of an identifier or a date; kind, identifier and address of a link."""
        e = x["e"]
        link = F.struct(
            F.lower(final(xml.texts(e, "TYPE"))).alias("kind"),
            final(xml.texts(e, "IDENTIFIER")).alias("ident"), final(xml.texts(e, "VALUE")).alias("uri"),
        )
        return F.struct(
            x["name"].alias("name"),
            F.when(x["name"] == "SAMEAS", link).alias("link"),
            F.when(x["name"] != "SAMEAS", xml.children(e, "VALUE")).alias("values"),
        )

    def identified(x):
        return F.when(
            x["name"] == "SAMEAS",
            F.when((x["link"]["kind"] == "celex") & (x["link"]["ident"] != ""), F.array(x["link"]["ident"])).otherwise(
                F.array().cast("array<string>")
            ),
        ).otherwise(x["values"])

    def lang_of(tag, default):
        named = (xml.attribute(tag, "xml:lang"), xml.attribute(tag, "lang"))
        spoken = F.lower(F.coalesce(*[F.nullif(x, empty()) for x in named], default))
        return F.when(F.contains(tag, F.lit("lang")), spoken).otherwise(default)

    def titles(x):
        e = x["e"]

        def valued(v):
            return F.struct(xml.own_text(v).alias("text"), lang_of(v, lang_of(e, empty())).alias("lang"))

        itself = F.struct(xml.own_text(e).alias("text"), lang_of(e, empty()).alias("lang"))
        inside = F.transform(xml.tagged(e, "VALUE"), valued)
        said = xml.once(inside, lambda xs: F.when(F.size(xs) > 0, xs).otherwise(F.array(itself)))
        return F.filter(said, lambda t: t["text"] != "")

    def codes(e):
        named = F.filter(xml.texts(e, "VALUE"), lambda v: F.contains(F.lower(v), F.lit("authority/language")))
        return F.concat(named, xml.texts(e, "OP-CODE"), xml.texts(e, "IDENTIFIER"), F.array(xml.own_text(e)))

    def address(e):
        kind, value = final(xml.children(e, "TYPE")), final(xml.children(e, "VALUE"))
        found = F.filter(F.array(value), lambda v: (F.lower(kind) == "cellar") & (v != ""))
        return F.when(F.contains(F.lower(e), F.lit("cellar")), found).otherwise(F.array().cast("array<string>"))

    own = ("ID_CELEX", "SAMEAS", "WORK_DATE_DOCUMENT", "DATE_DOCUMENT")
    named = F.transform(
        xml.elements(notice, *own, *NOTICE_TITLES, "WORK_CREATED_BY_AGENT"),
        lambda e: F.struct(xml.name_of(e).alias("name"), e.alias("e")),
    )
    rows = rows.withColumn("_e", named).withColumn("_l", F.transform(of(*own), listed))
    dated = F.filter("_l", lambda x: x["name"].isin("WORK_DATE_DOCUMENT", "DATE_DOCUMENT"))
    nims = F.filter("_l", lambda x: (x["link"]["kind"] == "nim") & (x["link"]["ident"] != ""))
    return rows.withColumn(
        "n",
        F.struct(
            gathered(F.filter("_l", lambda x: x["name"].isin("ID_CELEX", "SAMEAS")), identified).alias("ids"),
            gathered(dated, lambda x: x["values"]).alias("dates"),
            gathered(of(*NOTICE_TITLES), titles).alias("titles"),
            # these may stand inside others
            F.concat(*[gathered(xml.elements(notice, name), codes) for name in NOTICE_LANGUAGES]).alias("codes"),
            gathered(of("WORK_CREATED_BY_AGENT"), lambda x: F.transform(xml.texts(x["e"], "IDENTIFIER"), F.upper)).alias("states"),
            F.transform(nims, lambda x: F.struct(x["link"]["ident"].alias("ident"), x["link"]["uri"].alias("uri"))).alias("nims"),
            gathered(xml.elements(notice, "URI"), address).alias("cellars"),
        ),
    )


def parse_notices(payloads: DataFrame, body: str = "body", act: str = "act_celex") -> DataFrame:
    """National measures listed in captured notices of an act, one row per notice. Answers that are
    no whole XML give no rows."""
    keep = [c for c in payloads.columns if c not in (body, act)]
    rows = payloads.select(
        *keep, F.coalesce(celex.legal_act(F.col(act)), empty()).alias("act_celex"),
        xml.readable(F.col(body)).alias("_x"),
    )
    rows = _exploded(rows, [*keep, "act_celex"], xml.elements(F.col("_x"), "NOTICE"), "notice_idx")
    rows = _read_notices(rows)
    ids = F.transform("n.ids", lambda x: F.upper(strip(x)))
    prefix = F.concat(F.lit("7"), F.expr("substring(act_celex, 2)"))
    own = F.filter(ids, lambda x: (F.col("act_celex") != "") & F.startswith(x, prefix))
    rows = _settled(rows, "_nim_celex", F.coalesce(_first(own), _first(ids), empty()))
    nim_celex = F.col("_nim_celex")
    title = _first(F.col("n.titles"))
    last = lambda xs: F.try_element_at(xs, F.lit(-1))
    codes = F.transform(
        "n.codes", lambda c: F.lower(F.regexp_extract(c, "([^/]*)/*$", 1))
    )
    known = [F.lit(k) for k in L.LANG3_TO_LANG2]
    states = [F.lit(k) for k in L.MEMBER_STATES]
    named = last(F.filter("n.states", lambda s: s.isin(*states)))
    uris = F.filter(F.transform("n.nims", lambda x: x["uri"]), lambda u: u != "")
    df = rows.select(
        *keep, "notice_idx", "act_celex",
        nim_celex.alias("nim_celex"),
        F.coalesce(last(F.transform("n.nims", lambda x: x["ident"])), empty()).alias(
            "national_measure_id"
        ),
        F.coalesce(_first(F.col("n.dates")), empty()).alias("nim_date"),
        langs.optional(title["text"]).alias("nim_title"),
        langs.optional(title["lang"]).alias("nim_title_lang"),
        F.array_join(
            F.array_sort(F.array_distinct(F.filter(codes, lambda c: c.isin(*known)))), ","
        ).alias("available_expr_langs3"),
        F.coalesce(last(F.col("n.cellars")), empty()).alias("cellar_uri"),
        F.coalesce(last(uris), empty()).alias("nim_resource_uri"),
        F.coalesce(named, celex.member_state_of(nim_celex), empty()).alias("member_state_iso3"),
    )
    return df.where(F.col("nim_celex") != "").withColumns(
        {
            "member_state_name": F.coalesce(
                L.lookup(L.MEMBER_STATES, F.col("member_state_iso3")), empty()
            ),
            "eurlex_url": F.concat(
                F.lit("https://eur-lex.europa.eu/legal-content/EN/TXT/?uri=CELEX:"), "nim_celex"
            ),
        }
    )


def measures_of_acts(measures: DataFrame, order: str = "ord") -> DataFrame:
    """First row of each measure of an act."""
    return keep_first_narrow(measures, ["act_celex", "national_measure_id", "nim_celex"], order)


def read_rdf(payloads: DataFrame, body: str = "body") -> DataFrame:
    """Title, languages and classified links of captured metadata records; none of those that are
    no whole XML."""
    keep = [c for c in payloads.columns if c != body]

    def element(e):
        said = xml.own_text(e)
        web = lambda t: F.startswith(t, F.lit("http://")) | F.startswith(t, F.lit("https://"))
        urls = F.array_distinct(F.filter(F.concat(F.array(said), xml.values(e)), web))
        urls = F.when(F.contains(e, F.lit("http")), urls).otherwise(F.array().cast("array<string>"))
        return F.struct(
            xml.name_of(e).alias("name"), said.alias("text"), xml.attribute(e, "xml:lang").alias("lang"), urls.alias("urls")
        )

    read = F.transform(xml.everything(F.coalesce(xml.readable(F.col(body)), empty())), element)
    df = payloads.withColumn("_e", read)
    title = _first(
        F.filter("_e", lambda e: e["name"].isin("title", "work_title") & (e["text"] != ""))
    )
    links = F.flatten(
        F.transform(
            "_e",
            lambda e: F.transform(
                e["urls"],
                lambda u: F.struct(
                    u.alias("url"),
                    quality.record_link_type(u, e["name"]).alias("link_type"),
                    langs.lang2(e["lang"]).alias("lang"),
                ),
            ),
        )
    )
    links = F.filter(
        links,
        lambda x: ~F.contains(x["url"], F.lit("publications.europa.eu/resource/authority")),
    )
    return df.select(
        *keep,
        F.coalesce(title["text"], empty()).alias("title"),
        F.coalesce(langs.lang2(title["lang"]), empty()).alias("title_lang"),
        langs.distinct_words(F.transform("_e", lambda e: langs.lang2(e["lang"]))).alias(
            "available_languages"
        ),
        links.alias("links"),
    )


def legislation_texts(payloads: DataFrame, body: str = "body", out: str = "text") -> DataFrame:
    """Text of captured acts outside metadata, contents, versions and commentaries; empty where an
    act is no whole XML."""
    shown = xml.visible(xml.readable(F.col(body)), SKIPPED_XML)
    return payloads.withColumn(out, F.coalesce(shown, empty())).drop(body)


# ---- API answers -----------------------------------------------------------------------

NZ_ANSWER = (
    "results array<struct<work_id: string, latest_matching_version: struct<title: string, "
    "version_id: string, formats: array<struct<type: string, url: string>>>>>"
)
US_LIST = (
    "data array<struct<id: string, links: struct<self: string>, "
    "attributes: struct<title: string, documentTitle: string>>>"
)
US_FILES = "array<struct<fileUrl: string, format: string>>"
US_DETAIL = (
    "data struct<attributes: struct<title: string, documentType: string, agencyId: string, "
    "docketId: string, postedDate: string, commentDueDate: string, rin: string, summary: string, "
    f"abstract: string, documentAbstract: string, additionalRins: string, fileFormats: {US_FILES}>>, "
    "included array<struct<type: string, attributes: struct<title: string, docOrder: int, "
    f"fileFormats: {US_FILES}>>>"
)


def nz_rows(
    payloads: DataFrame, cap: int | None = None, body: str = "body", order: str = "ord"
) -> DataFrame:
    """Hits of NZ answers (``term, ord, body``): html before pdf before xml, first per address,
    and at most ``cap`` per answer if it is given."""
    rows = payloads.select(
        "term", F.col(order).alias("ord"),
        F.posexplode(F.from_json(F.col(body), NZ_ANSWER)["results"]).alias("result_idx", "r"),
    )
    version = F.col("r.latest_matching_version")
    pick = lambda kind: text_or_empty(
        _first(
            F.filter(version["formats"], lambda f: F.lower(text_or_empty(f["type"])) == kind)
        )["url"]
    )
    rows = rows.select(
        "term", "ord", "result_idx",
        pick("html").alias("text_url"), pick("pdf").alias("pdf_url"), pick("xml").alias("xml_url"),
        text_or_empty(version["title"]).alias("title"),
        text_or_empty(
            F.coalesce(F.nullif(version["version_id"], empty()), F.col("r.work_id"))
        ).alias("doc_uid"),
    )
    filled = lambda c: F.nullif(F.col(c), empty())
    rows = rows.withColumn("url", F.coalesce(filled("text_url"), filled("pdf_url"), filled("xml_url")))
    first = (
        rows.where(F.col("url").isNotNull())
        .groupBy("ord", "url")
        .agg(F.min_by(F.struct(*[c for c in rows.columns if c not in ("ord", "url")]),
                      "result_idx").alias("x"))
        .select("ord", "url", "x.*")
    )
    if cap is not None:
        first = cap_per_key(first, ["ord"], [F.col("result_idx")], cap, spread="result_idx")
    return first.withColumns(
        {"jurisdiction": F.lit("New Zealand"), "source": F.lit("NZ"), "doc_url": F.col("url")}
    )


def us_rows(
    payloads: DataFrame, cap: int | None = None, body: str = "body", order: str = "ord"
) -> DataFrame:
    """Hits of US list answers (``term, ord, body``), at most ``cap`` per term over all pages if
    it is given."""
    rows = payloads.select(
        "term", F.col(order).alias("ord"),
        F.posexplode(F.from_json(F.col(body), US_LIST)["data"]).alias("result_idx", "d"),
    )
    filled = lambda c: F.nullif(c, empty())
    link = text_or_empty(F.col("d.links.self"))
    rows = rows.select(
        "term", "ord", "result_idx",
        F.coalesce("d.id", empty()).alias("api_id"),
        link.alias("api_self"),
        F.coalesce(
            filled(F.col("d.attributes.title")), filled(F.col("d.attributes.documentTitle")), empty()
        ).alias("title"),
    )
    if cap is not None:
        rows = cap_per_key(rows, ["term"], [F.col("ord"), F.col("result_idx")], cap)
    return rows.withColumns(
        {
            "jurisdiction": F.lit("United States"), "source": F.lit("US"),
            "url": F.col("api_self"), "document_id": F.col("api_id"),
        }
    )


def us_detail(payloads: DataFrame, body: str = "body") -> DataFrame:
    """Text lines of US detail answers, and the answer itself as struct ``detail``."""
    df = payloads.withColumn("detail", F.from_json(F.col(body), US_DETAIL)).drop(body)
    a = "detail.data.attributes."
    said = lambda k: F.nullif(F.col(a + k), empty())
    named = ("title", "documentType", "agencyId", "docketId", "postedDate", "commentDueDate", "rin")
    plain = ("summary", "abstract", "documentAbstract", "additionalRins")
    lines = F.concat_ws(
        "\n", *[F.concat(F.lit(f"{k}: "), said(k)) for k in named], *[said(k) for k in plain]
    )
    return df.withColumn("text", strip(lines))


def _files(entries: Column, kind: str, title: Column, order: Column) -> Column:
    listed = F.transform(
        entries,
        lambda e: F.struct(
            text_or_empty(e["fileUrl"]).alias("file_url"),
            F.lower(text_or_empty(e["format"])).alias("format"),
            F.lit(kind).alias("source_kind"),
            title.alias("attachment_title"),
            order.cast("int").alias("attachment_order"),
        ),
    )
    usable = F.filter(listed, lambda x: (x["file_url"] != "") & (x["format"] != ""))
    none = F.array().cast(
        "array<struct<file_url: string, format: string, source_kind: string, "
        "attachment_title: string, attachment_order: int>>"
    )
    return F.coalesce(usable, none)


def us_downloads(details: DataFrame, *keep: str) -> DataFrame:
    """Files of US documents, best first: the document before its attachments, readable formats
    first, each address once. ``details`` comes from ``us_detail``."""
    own = _files(F.col("detail.data.attributes.fileFormats"), "document", empty(), F.lit(0))
    attached = F.flatten(
        F.transform(
            F.filter("detail.included", lambda i: i["type"] == "attachments"),
            lambda i: _files(
                i["attributes"]["fileFormats"], "attachment",
                text_or_empty(i["attributes"]["title"]),
                F.coalesce(i["attributes"]["docOrder"], F.lit(0)),
            ),
        )
    )
    scores = L.literal_map(L.DOWNLOAD_FORMAT_SCORES)

    def scored(x, i):
        return F.struct(
            F.when(x["source_kind"] == "document", 200).otherwise(100).alias("source_score"),
            F.coalesce(F.try_element_at(scores, x["format"]), F.lit(-1000)).alias("format_score"),
            F.when(F.contains(F.lower(x["file_url"]), F.lit("content.")), 20)
            .otherwise(0).alias("content_bonus"),
            F.when(x["source_kind"] == "attachment", -x["attachment_order"])
            .otherwise(0).alias("order_bias"),
            x["file_url"].alias("url"),
            (-i).alias("place"),
            x.alias("file"),
        )

    ranked = F.reverse(F.array_sort(F.transform(F.concat(own, F.coalesce(attached, F.filter(own, lambda x: F.lit(False)))), scored)))
    return details.select(*keep, F.posexplode(_once(ranked)).alias("rank", "x")).select(
        *keep, (F.col("rank") + 1).alias("rank"), "x.file.*"
    )
