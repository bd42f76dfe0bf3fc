"""Terms of an inventory against looking for each of them in each text."""

import random

import pytest

from lexcorpus.operators import terms

WORDS = "nature restoration net-gain biodiversité Überwachung λόγοσ природа 自然再生 EU's straße İz 😀 a of".split()
DOCS = "ord long, title string, full_text string, lang string"


def inventory(seed, n):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["en", "DE ", "fr", None, " "]), " ".join(rng.choices(WORDS, k=rng.randint(1, 3)))) for i in range(n)]
    return [*rows, (n, "en", ""), (n + 1, None, " \t"), (n + 2, None, None), (n + 3, "en", "e"), (n + 4, "fr", "at"), (n + 5, None, "gai"), (n + 6, "en", "net-gain"), (n + 7, "en", "net-gain")]


def texts(seed, n):
    rng = random.Random(seed)
    pick = lambda k: rng.choice(["", " ", "\n", "x"]).join(w.upper() if rng.random() < 0.2 else w for w in rng.choices(WORDS, k=rng.randint(0, k)))
    rows = [(i, pick(4), pick(30), rng.choice(["en", "de", "fr", "it", None])) for i in range(n)]
    long = " ".join(rng.choices(WORDS, k=30_000))
    return [*rows, (n, None, None, "en"), (n + 1, "", "", None), (n + 2, "Net-Gain", None, "EN"), (n + 3, None, long, "de")]


def brute(docs, rows, by_language):
    out = []
    first = {}
    for place, lang, term in rows:
        if term and term.strip():
            lang = (lang or "").strip().lower() or None
            first[lang, term] = min(first.get((lang, term), place), place)
    for ord_, title, body, lang in docs:
        text = f"{title or ''} {body or ''}".lower()
        spoken = (lang or "").strip().lower()
        found = [(ord_, t, g, p) for (g, t), p in first.items() if t.lower() in text and (not by_language or g in (None, spoken))]
        out += found or [(ord_, "", None, None)]
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r["ord"], r["term"], r["term_lang"], r["term_ord"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("sent", [terms.SENT, 0])
@pytest.mark.parametrize("by_language", [True, False])
def test_terms_equal_brute_force(spark, sent, by_language):
    docs, listed = texts(1, 60), inventory(2, 80)
    df = spark.createDataFrame(docs, DOCS)
    index = terms.term_index(spark.createDataFrame(listed, "ord long, lang string, term string"), df)
    assert index.lengths == [1, 2, 3, 4, 8]
    got = terms.term_rows(df, index, ["ord", "lang"], lang="lang" if by_language else None, sent=sent)
    assert got.columns == ["ord", "lang", "term", "term_lang", "term_ord"]
    assert rows_of(got) == brute(docs, listed, by_language)


def test_empty_tables(spark):
    df = spark.createDataFrame(texts(1, 3), DOCS)
    none = spark.createDataFrame([(1, "en", " ")], "ord long, lang string, term string")
    index = terms.term_index(none, df)
    assert [r["term"] for r in terms.term_rows(df, index, ["ord"], lang="lang").collect()] == [""] * df.count()
    index = terms.term_index(spark.createDataFrame(inventory(1, 5), none.schema), df.limit(0))
    assert terms.term_rows(df.limit(0), index, ["ord"]).count() == 0


def test_small_index_moves_no_text(spark):
    df = spark.createDataFrame(texts(1, 5), DOCS)
    index = terms.term_index(spark.createDataFrame(inventory(3, 4000), "ord long, lang string, term string"), df)
    plan = terms.find_terms(df, index, lang="lang")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and "biodiv" not in plan
    assert index.anchors.count() > 1000


def test_rare_stretches_are_anchors(spark):
    df = spark.createDataFrame([(1, "", "abcd efgh " * 9 + "wxyz", "en")], DOCS)
    index = terms.term_index(spark.createDataFrame([(1, "en", "abcd efgh wxyz"), (2, "en", "abcd")], "ord long, lang string, term string"), df)
    assert {r["term"]: r["anchor"] for r in index.anchors.collect()} == {"abcd efgh wxyz": " efgh wx", "abcd": "abcd"}


def test_small_index_makes_no_row_of_a_stretch(spark, monkeypatch):
    """Texts are looked up in pieces where they are read; terms lie across pieces and at text ends."""
    monkeypatch.setattr(terms, "PIECE", 7)
    docs, listed = texts(7, 20)[:-1], [*inventory(8, 40), (90, None, "\0"), (91, None, "😀 a"), (92, "de", "λόγοσ природа 自然再生")]
    df = spark.createDataFrame(docs, DOCS)
    index = terms.term_index(spark.createDataFrame(listed, "ord long, lang string, term string"), df)
    plan = terms.find_terms(df, index, lang="lang")._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan
    assert rows_of(terms.term_rows(df, index, ["ord", "lang"], lang="lang")) == brute(docs, listed, True)


def test_index_in_parts_moves_neither_texts_nor_stretches(spark):
    docs, listed = texts(5, 30), inventory(6, 300)
    df = spark.createDataFrame(docs, DOCS)
    index = terms.term_index(spark.createDataFrame(listed, "ord long, lang string, term string"), df)
    plan = terms.find_terms(df, index, lang="lang", sent=4000)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") > 2 and "Generate" not in plan and "Exchange hashpartitioning" not in plan
    assert rows_of(terms.term_rows(df, index, ["ord"], lang="lang", sent=4000)) == brute(docs, listed, True)
    plan = terms.term_rows(df, index, ["ord"], lang="lang")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Exchange hashpartitioning" not in plan
