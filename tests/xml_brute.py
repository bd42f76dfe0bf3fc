"""XML payloads read element by element, which the column expressions must agree with."""

from xml.etree import ElementTree

XML_LANG = "{http://www.w3.org/XML/1998/namespace}lang"
SKIPPED_XML = frozenset(("Metadata", "Versions", "Contents", "Commentaries"))


def parse_xml(body: str | None):
    """Root element, or None when the text is no XML."""
    try:
        return ElementTree.fromstring((body or "").encode("utf-8", "ignore"))
    except ElementTree.ParseError:
        return None


def local(tag) -> str:
    return str(tag).rpartition("}")[2]


def named(node, name: str):
    return [e for e in node.iter() if local(e.tag) == name]


def own_text(node) -> str:
    return (node.text or "").strip()


def texts(node, name: str) -> list[str]:
    return [t for t in map(own_text, named(node, name)) if t]


def search_hits(body: str | None) -> dict | None:
    """Counts and, per result, its named fields and every text that mentions an identifier."""
    root = parse_xml(body)
    found = [] if root is None else named(root, "searchResults")
    if not found:
        return None
    results = []
    for node in named(found[0], "result"):
        mentions = []
        for e in node.iter():
            for t in (own_text(e), *map(str.strip, e.attrib.values())):
                low = t.lower()
                if "celex:" in low or "/celex/" in low:
                    mentions.append(t)
        fields = [
            {
                "name": local(e.tag),
                "langs": [x.lower() for x in texts(e, "LANG")],
                "values": texts(e, "VALUE"),
                "year": (texts(e, "YEAR") or [""])[0],
                "month": (texts(e, "MONTH") or [""])[0],
                "day": (texts(e, "DAY") or [""])[0],
            }
            for e in node.iter()
            if local(e.tag) in HIT_FIELDS
        ]
        results.append({"fields": fields, "mentions": mentions})
    return {
        "totalhits": (texts(found[0], "totalhits") or [""])[-1],
        "numhits": (texts(found[0], "numhits") or [""])[-1],
        "results": results,
    }


# ---- fixed values: fields of search results and notices --------------------------------
DATE_FIELDS = (
    "WORK_DATE_DOCUMENT", "DATE_DOCUMENT", "DATE_PUBLICATION", "DATE_ENTRY_INTO_FORCE",
    "RESOURCE_LEGAL_DATE_ENTRY-INTO-FORCE",
)
HIT_FIELDS = frozenset(("ID_CELEX", "EXPRESSION_TITLE", "WORK_TITLE", *DATE_FIELDS))
NOTICE_TITLES = frozenset(("EXPRESSION_TITLE", "TITLE", "WORK_TITLE"))
NOTICE_LANGUAGES = frozenset(("EXPRESSION_USES_LANGUAGE", "LANGUAGE"))


def _children(node, name: str) -> list[str]:
    return [own_text(c) for c in node if local(c.tag) == name and own_text(c)]


def _lang_of(node, default: str = "") -> str:
    return (node.get(XML_LANG) or node.get("lang") or default).strip().lower()


def notices(body: str | None) -> list[dict]:
    """Per notice the identifiers, dates, titles, languages, states and addresses it lists."""
    root = parse_xml(body)
    out = []
    for notice in [] if root is None else named(root, "NOTICE"):
        row = {k: [] for k in ("ids", "dates", "titles", "codes", "states", "nims", "cellars")}
        for e in notice.iter():
            name = local(e.tag)
            if name == "ID_CELEX":
                row["ids"] += _children(e, "VALUE")
            elif name in ("WORK_DATE_DOCUMENT", "DATE_DOCUMENT"):
                row["dates"] += _children(e, "VALUE")
            elif name in NOTICE_TITLES:
                places = named(e, "VALUE") or [e]
                row["titles"] += [
                    {"text": own_text(v), "lang": _lang_of(v, _lang_of(e))}
                    for v in places
                    if own_text(v)
                ]
            elif name in NOTICE_LANGUAGES:
                uris = [v for v in texts(e, "VALUE") if "authority/language" in v.lower()]
                codes = texts(e, "OP-CODE") + texts(e, "IDENTIFIER")
                row["codes"] += uris + codes + [own_text(e)]
            elif name == "WORK_CREATED_BY_AGENT":
                row["states"] += [t.upper() for t in texts(e, "IDENTIFIER")]
            elif name == "SAMEAS":
                kind, ident, value = (
                    (texts(e, n) or [""])[-1] for n in ("TYPE", "IDENTIFIER", "VALUE")
                )
                if kind.lower() == "celex" and ident:
                    row["ids"].append(ident)
                elif kind.lower() == "nim" and ident:
                    row["nims"].append({"ident": ident, "uri": value})
            elif name == "URI":
                kind, value = ((_children(e, n) or [""])[-1] for n in ("TYPE", "VALUE"))
                if kind.lower() == "cellar" and value:
                    row["cellars"].append(value)
        out.append(row)
    return out


def rdf_elements(body: str | None) -> list[dict]:
    """Every element of a metadata record with its text, language tag and web addresses."""
    root = parse_xml(body)
    out = []
    for e in [] if root is None else root.iter():
        seen = [t.strip() for t in (own_text(e), *e.attrib.values())]
        web = list(dict.fromkeys(t for t in seen if t.startswith(("http://", "https://"))))
        out.append(
            {"name": local(e.tag), "text": own_text(e), "lang": e.get(XML_LANG, ""), "urls": web}
        )
    return out


def legislation_text(body: str | None) -> str:
    """Text of an act outside its metadata, contents, versions and commentaries."""
    root = parse_xml(body)
    if root is None:
        return ""

    def shown(e, above: bool) -> bool:
        return above and local(e.tag).rpartition(":")[2] not in SKIPPED_XML

    # a stack of elements being read, so that depth is bounded by memory alone
    stack = [(root, iter(root), shown(root, True))]
    words = (root.text or "").split() if stack[0][2] else []
    while stack:
        e, children, seen = stack[-1]
        child = next(children, None)
        if child is None:
            stack.pop()
            if stack and stack[-1][2]:
                words += (e.tail or "").split()
            continue
        stack.append((child, iter(child), shown(child, seen)))
        if stack[-1][2]:
            words += (child.text or "").split()
    return " ".join(words)
