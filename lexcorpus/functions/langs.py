"""Language rules for national measures and EU documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexcorpus import lookups as L
from lexcorpus.functions.text import empty, strip, text_or_empty


def optional(c: Column) -> Column:
    """Trimmed text; the word ``nan`` counts as empty."""
    x = text_or_empty(c)
    return F.when(F.lower(x) == "nan", empty()).otherwise(x)


def distinct_words(words: Column) -> Column:
    return F.array_distinct(
        F.filter(F.transform(words, strip), lambda w: w.isNotNull() & (w != ""))
    )


def langs2_of(langs3: Column) -> Column:
    """Two-letter codes (upper case) of a comma list of three-letter codes, in order."""
    tokens = F.split(F.lower(optional(langs3)), ",", -1)
    return distinct_words(
        F.transform(tokens, lambda t: F.try_element_at(L.literal_map(L.LANG3_TO_LANG2), strip(t)))
    )


def lang2(c: Column) -> Column:
    """Two-letter code (lower case) of a language tag; empty when unknown."""
    x = F.lower(text_or_empty(c))
    return F.when(F.length(x) == 2, x).otherwise(
        F.coalesce(F.lower(L.lookup(L.LANG3_TO_LANG2, x)), empty())
    )


def lang_of_url(url: Column) -> Column:
    x = text_or_empty(url)
    by_path = F.regexp_extract(x, "/legal-content/([A-Za-z]{2})/", 1)
    by_query = F.regexp_extract(x, r"(?i)[?&](?:lang|locale)=([A-Za-z]{2})\b", 1)
    return F.lower(F.coalesce(F.nullif(by_path, empty()), by_query))


def detect(eurlex_url: Column, langs3: Column, title_lang: Column, iso3: Column) -> Column:
    """struct(lang, source): language of a measure and where it was read."""
    url = F.lower(
        F.regexp_extract(text_or_empty(eurlex_url), "/legal-content/([A-Za-z]{2})/", 1)
    )
    first = F.lower(F.get(langs2_of(langs3), F.lit(0)))
    tag = F.lower(optional(title_lang))
    by_title = F.when(F.length(tag) == 2, tag).when(
        F.length(tag) == 3, F.coalesce(F.lower(L.lookup(L.LANG3_TO_LANG2, tag)), F.lit("en"))
    )
    home = L.lookup(L.MEMBER_STATE_MAIN_LANG, F.upper(text_or_empty(iso3)))
    found = lambda lang, src: F.when(
        lang.isNotNull() & (lang != ""), F.struct(lang.alias("lang"), F.lit(src).alias("source"))
    )
    return F.coalesce(
        found(F.when(url != "en", url), "url"),
        found(first, "metadata"),
        found(by_title, "metadata"),
        found(home, "country_fallback"),
        found(url, "url"),
        found(F.lit("en"), "default_en"),
    )


def try_langs(langs3: Column, iso3: Column) -> Column:
    """Languages to try for a measure's text: its own, its state's, then English."""
    home = F.split(
        F.coalesce(
            L.lookup(L.MEMBER_STATE_TRY_LANGS, F.upper(text_or_empty(iso3))), empty()
        ),
        ",", -1,
    )
    return F.array_distinct(
        F.concat(distinct_words(F.concat(langs2_of(langs3), home)), F.array(F.lit("EN")))
    )


def doc_candidates(query_langs: Column, doc_lang: Column) -> Column:
    """Languages to try for an EU document: English, the query languages, its own."""
    plain = lambda x: F.when(x.isin("eng", ""), "en").otherwise(x)
    asked = F.transform(
        F.coalesce(query_langs, F.array().cast("array<string>")), lambda q: plain(F.lower(strip(q)))
    )
    own = F.lower(text_or_empty(doc_lang))
    own = F.when(own.isin("", "en", "eng"), F.lit("en")).otherwise(own)
    return F.array_distinct(F.concat(F.array(F.lit("en")), asked, F.array(own)))


def text_lang_source(chosen: Column, doc_lang: Column, query_langs: Column) -> Column:
    lang = F.lower(text_or_empty(chosen))
    own = F.lower(text_or_empty(doc_lang))
    asked = F.transform(
        F.coalesce(query_langs, F.array().cast("array<string>")), lambda q: F.lower(strip(q))
    )
    english = lambda x: x.isin("en", "eng")
    return (
        F.when(
            lang == "en",
            F.when(
                ((own == "") | english(own)) & F.forall(asked, english), "english_default"
            ).otherwise("english_fallback"),
        )
        .when(own == lang, "job_language")
        .when(F.array_contains(asked, lang), "query_language")
        .otherwise("retry_sequence")
    )


def safe_name(c: Column) -> Column:
    x = F.regexp_replace(text_or_empty(c), "[^A-Za-z0-9._-]+", "_")
    return F.when(x == "", "missing_id").otherwise(x)


def measure_key(measure_id: Column, nim_celex: Column, iso3: Column, whole_row: Column) -> Column:
    """Cache key of a national measure; rows without any id are keyed by their content."""
    m, n, s = text_or_empty(measure_id), text_or_empty(nim_celex), text_or_empty(iso3)
    return (
        F.when(m != "", safe_name(m))
        .when((n != "") & (s != ""), safe_name(F.concat_ws("_", n, s)))
        .when(n != "", safe_name(n))
        .otherwise(F.substring(F.sha1(whole_row), 1, 24))
    )
