"""XML payloads by column expressions against a reader that walks the elements."""

import random
import re

import pytest
from tests import xml_brute

from lexcorpus.operators import extract

TEXTS = ["", "x", " 32014L0089 ", "a &amp; b", "&lt;VALUE&gt;z&lt;/VALUE&gt;", "caf&#233;&#x20AC;", "http://e/authority/language/DAN", "https://s/x.pdf", "12", "2014", "DAN", "swe", "celex", "nim", "cellar", "<![CDATA[<VALUE>c & d</VALUE>]]>", "one<!-- <VALUE>no</VALUE> -->two", "72014L0089DNK_1", "http://p/resource/celex/32014L0089", "en", "\n long\ttext "]
LEAVES = ["VALUE", "LANG", "YEAR", "MONTH", "DAY", "TYPE", "IDENTIFIER", "OP-CODE", "other", "x:VALUE", "VALUES"]
FIELDS = ["ID_CELEX", "EXPRESSION_TITLE", "WORK_TITLE", "TITLE", "WORK_DATE_DOCUMENT", "DATE_DOCUMENT", "DATE_PUBLICATION", "RESOURCE_LEGAL_DATE_ENTRY-INTO-FORCE", "EXPRESSION_USES_LANGUAGE", "WORK_CREATED_BY_AGENT", "SAMEAS", "LANGUAGE", "x:ID_CELEX"]
ATTRIBUTES = ["", "", ' xml:lang="da"', " lang = 'FR'", ' t="a > b / c"', " u='https://n/a?b=1&amp;c=2'", ' x:r="http://p/celex/32014L0089"', ' xmlns:q="https://not/an/attribute"']


def leaf(rng, names=LEAVES):
    name, attrs = rng.choice(names), rng.choice(ATTRIBUTES)
    return f"<{name}{attrs}/>" if rng.random() < 0.1 else f"<{name}{attrs}>{rng.choice(TEXTS)}</{name}>"


def field(rng):
    name = rng.choice(FIELDS)
    body = "".join(leaf(rng) for _ in range(rng.randint(0, 4)))
    if name == "SAMEAS" and rng.random() < 0.5:
        body = f"<URI>{body}</URI>"
    elif rng.random() < 0.2:
        body = f"<W>{body}</W>tail"
    return f"<{name}{rng.choice(ATTRIBUTES)}>{rng.choice(['', 'eng', ' '])}{body}</{name}>"


def payload(rng, item):
    parts = []
    for _ in range(rng.randint(0, 3)):
        inside = "".join(rng.choice([field(rng), leaf(rng), "<d>" + field(rng) + "</d>"]) for _ in range(rng.randint(0, 6)))
        parts.append(f"<{item}{rng.choice(ATTRIBUTES)}>{inside}</{item}>")
    head = rng.choice(["", '<?xml version="1.0"?>', "<!-- <result/> -->", "<!DOCTYPE S>"])
    whole = f'{head}<x:S xmlns:x="urn:x"><searchResults><totalhits>3</totalhits>{"".join(parts)}</searchResults></x:S>'
    return rng.choice([whole] * 9 + [whole[:-2], whole.replace("</d>", "", 1), "", None, "no xml", whole + "junk", " " + whole if not head else whole])


@pytest.fixture(scope="module")
def bodies():
    rng = random.Random(5)
    return {item: [payload(rng, item) for _ in range(400)] for item in ("result", "NOTICE")}


def table(spark, rows, extra=""):
    return spark.createDataFrame([(i, b, "32014L0089") for i, b in enumerate(rows)], "ord long, body string, act_celex string")


def first(values, default=""):
    return next(iter(values), default)


def hit(result):
    def value(name):
        fields = [f for f in result["fields"] if f["name"] == name and f["values"]]
        return first([f["values"][0] for f in fields if "en" in f["langs"]] or [f["values"][0] for f in fields], None)

    def date(f):
        y, m, d = f["year"], f["month"], f["day"]
        if f["values"]:
            return f["values"][0]
        parts = [y, m, d] if y and m and d else [y, m] if y and m else [y]
        if len(parts) > 1 and all(re.fullmatch("[0-9]+", p) for p in parts):
            return "-".join(str(int(p)).zfill(w) for p, w in zip(parts, (4, 2, 2)))
        return "-".join(parts) if y else None

    dates = [d for n in extract.DATE_FIELDS for f in result["fields"] if f["name"] == n for d in [date(f)] if d]
    found = value("ID_CELEX") or first((t for m in result["mentions"] for t in re.findall("32014L0089", m)), None)
    return found, value("EXPRESSION_TITLE") or value("WORK_TITLE") or "", first(dates)


def test_hits_equal_the_walk(spark, bodies):
    got = {(r["ord"], r["result_idx"]): (r["celex"], r["title"], r["date"]) for r in extract.parse_hits(table(spark, bodies["result"])).collect()}
    want = {}
    for i, body in enumerate(bodies["result"]):
        for k, result in enumerate((xml_brute.search_hits(body) or {"results": []})["results"]):
            want[i, k] = hit(result)
    assert len(want) > 300 and got == want


def test_notices_equal_the_walk(spark, bodies):
    from pyspark.sql import functions as F

    from lexcorpus.functions import xml

    rows = table(spark, bodies["NOTICE"]).select("ord", xml.readable(F.col("body")).alias("x"))
    rows = extract._read_notices(rows.select("ord", F.posexplode(xml.elements(F.col("x"), "NOTICE")).alias("k", "_r")))
    got = {(r["ord"], r["k"]): r["n"].asDict(True) for r in rows.collect()}
    want = {(i, k): n for i, body in enumerate(bodies["NOTICE"]) for k, n in enumerate(xml_brute.notices(body))}
    tidy = lambda n: {k: sorted(filter(None, v)) if k in ("codes", "states") else v for k, v in n.items()}
    assert len(want) > 300
    assert {k: tidy(n) for k, n in got.items()} == {k: tidy(n) for k, n in want.items()}


def test_records_and_acts_equal_the_walk(spark, bodies):
    from pyspark.sql import functions as F

    from lexcorpus.functions import langs

    rows = [b.replace("<W", "<Metadata").replace("</W", "</Metadata") if b else b for b in bodies["NOTICE"]]
    shown = {r["ord"]: r["text"] for r in extract.legislation_texts(table(spark, rows)).collect()}
    assert shown == {i: xml_brute.legislation_text(b) for i, b in enumerate(rows)}
    links = {r["ord"]: [x["url"] for x in r["links"]] for r in extract.read_rdf(table(spark, rows)).collect()}
    web = lambda b: [u for e in xml_brute.rdf_elements(b) for u in e["urls"] if "publications.europa.eu/resource/authority" not in u]
    assert links == {i: web(b) for i, b in enumerate(rows)}
    named = {r["ord"]: (r["title"], r["title_lang"]) for r in extract.read_rdf(table(spark, [b and b.replace("WORK_TITLE", "title") for b in rows])).collect()}
    want = {}
    codes = {r["c"]: r["l"] or "" for r in spark.createDataFrame([("da",), ("",)], "c string").select("c", langs.lang2(F.col("c")).alias("l")).collect()}
    for i, b in enumerate(rows):
        e = first([e for e in xml_brute.rdf_elements(b and b.replace("WORK_TITLE", "title")) if e["name"] in ("title", "work_title") and e["text"]], {"text": "", "lang": ""})
        want[i] = (e["text"], codes[e["lang"]])
    assert named == want


def test_no_python_step(spark):
    df = table(spark, ["<a/>"])
    for job in (extract.parse_hits, extract.parse_notices, extract.read_rdf, extract.legislation_texts):
        plan = job(df)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan
