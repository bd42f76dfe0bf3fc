"""Per-row readers for captured pages. They only list what is in a payload: texts,
links, headings, fields. What to keep is decided in the jobs, by column expressions."""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from html.parser import HTMLParser
from urllib.parse import urljoin

# ---- fixed values: elements without content, hidden elements, title places --------------
VOID = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen "
    "link menuitem meta nextid param source spacer track wbr".split()
)
SCRIPT = frozenset(("script", "style"))
TITLE_TAGS = frozenset(("title", "h1", "h2"))
TITLE_CLASSES = frozenset(("eli-main-title", "title", "document-title"))

#: Plain markup, which most pages consist of: an end tag, a start tag with quoted attributes, or text.
PLAIN = re.compile(r'</([a-zA-Z][a-zA-Z0-9]*)>|<([a-zA-Z][a-zA-Z0-9]*)((?: [a-zA-Z][a-zA-Z-]*="[^"]*")*)>|([^<]+)')
PLAIN_ATTRIBUTE = re.compile(r' ([a-zA-Z-]+)="([^"]*)"')
#: An address from the root, and the site of a page, that join without a look at their parts.
ROOTED = re.compile(r"/(?!/)(?:[A-Za-z0-9_-][A-Za-z0-9._-]*/)*(?:[A-Za-z0-9_-][A-Za-z0-9._-]*)?(?:#[A-Za-z0-9_-]+)?")
WHOLE = re.compile(r"https?://[A-Za-z0-9.-]+" + ROOTED.pattern)
SITE = re.compile(r"(https?://[A-Za-z0-9.-]+)/")


class PageReader(HTMLParser):
    """Text pieces, title places, links and meta tags of one page.

    A piece is the text between two tags or comments; ``where`` tells whether it is inside a
    script, a noscript or an svg element.
    """

    def __init__(self, base: str):
        super().__init__(convert_charrefs=True)
        self.base = base
        self.open: list[tuple[str, int, dict]] = []
        self.depth: Counter[str] = Counter()  # how many elements of a name are open
        self.pieces: list[list[str]] = []
        self.fresh = True
        self.nodes, self.links, self.metas = [], [], []

    def read(self, html):
        """Feed a page. Plain markup is handed on at once, with what the parser would make of it; the
        parser reads the rest from the first place that is not plain."""
        at, plain = 0, PLAIN.match
        while found := plain(html, at):
            closed, opened, attrs, text = found.groups()
            if text is not None:
                self.handle_data(unescape(text) if "&" in text else text)
            elif closed is not None:
                self.handle_endtag(closed.lower())
            else:
                tag = opened.lower()
                if tag in SCRIPT:
                    break
                said = PLAIN_ATTRIBUTE.findall(attrs) if attrs else ()
                self.handle_starttag(tag, [(k.lower(), unescape(v) if "&" in v else v) for k, v in said])
            at = found.end()
        if at < len(html):
            self.feed(html[at:])

    def handle_starttag(self, tag, attrs):
        self.fresh = True
        attrs = {k: (v or "") for k, v in attrs}
        if tag == "meta" and attrs.get("content"):
            self.metas.append(
                (attrs.get("name", ""), attrs.get("property", ""), attrs["content"])
            )
        if tag not in VOID:
            self.open.append((tag, len(self.pieces), attrs))
            self.depth[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.fresh = True
        if not self.depth[tag]:
            return
        name = None
        while name != tag:
            closed = self.open.pop()
            name = closed[0]
            self.depth[name] -= 1
            self.note(*closed)

    def handle_comment(self, data):
        self.fresh = True

    handle_decl = handle_pi = unknown_decl = handle_comment

    def handle_data(self, data):
        if self.fresh:
            where = (
                "script" if any(self.depth[name] for name in SCRIPT)
                else "noscript" if self.depth["noscript"]
                else "svg" if self.depth["svg"] else ""
            )
            self.pieces.append([data, where])
            self.fresh = False
        else:
            self.pieces[-1][0] += data

    def note(self, name, start, attrs):
        end = len(self.pieces)
        if name == "a" and "href" in attrs:
            self.links.append((start, attrs["href"].strip(), end))
        classes = TITLE_CLASSES.intersection(attrs.get("class", "").split())
        if name in TITLE_TAGS or classes or attrs.get("id") == "title":
            self.nodes.append((start, name, sorted(classes), attrs.get("id", ""), end))

    def done(self):
        self.close()
        while self.open:
            self.note(*self.open.pop())

    def label(self, start, end) -> str:
        shown = (p.strip() for p, where in self.pieces[start:end] if where != "script")
        return " ".join(t for t in shown if t)


def _line_piece(piece: str) -> str:
    """A piece of plain blanks counts as one blank, or one newline when it has any."""
    if piece.strip(" \t\n\r\f\v"):
        return piece
    return "\n" if "\n" in piece else " "


def _lines(reader: PageReader) -> str:
    pieces = [p for p, where in reader.pieces if where in ("", "svg")]
    lines = re.sub(r"[ \t\r\f\v]+", " ", "\n".join(_line_piece(p) for p in pieces))
    return re.sub(r"\n{3,}", "\n\n", lines).strip()


def _words(reader: PageReader, *where: str) -> str:
    return " ".join(" ".join(p for p, w in reader.pieces if w in where).split())


#: What can be read from a page. A job asks only for the parts that it uses.
PAGE_PARTS = {
    "text_lines": _lines,
    "text_visible": lambda reader: _words(reader, ""),
    "text_plain": lambda reader: _words(reader, "", "svg"),
    "places": lambda reader: [
        {"tag": tag, "classes": cls, "ident": ident, "text": reader.label(a, b)}
        for a, tag, cls, ident, b in sorted(reader.nodes)
    ],
    "links": lambda reader: [
        {"pos": i, "href": href, "url": url, "label": reader.label(a, b)}
        for i, ((a, href, b), url) in enumerate(_joined(reader.base, sorted(reader.links)))
    ],
    "metas": lambda reader: [
        {"name": n, "property": p, "content": c.strip()} for n, p, c in reader.metas
    ],
}


def read_page(html: str | None, base: str | None, parts=tuple(PAGE_PARTS)) -> dict:
    """Visible text in three forms, title places, links (resolved) and meta tags of a page."""
    reader = PageReader(base or "")
    reader.read(html or "")
    reader.done()
    return {name: PAGE_PARTS[name](reader) for name in parts}


def _joined(base: str, links: list[tuple[int, str, int]]):
    """Links with their addresses. Whole addresses and those from the root need no join of parts."""
    site = SITE.match(base)
    for link in links:
        href = link[1]
        if site and WHOLE.fullmatch(href):
            yield link, href
        elif site and ROOTED.fullmatch(href):
            yield link, site[1] + href
        else:
            yield link, _join(base, href)


def _join(base: str, href: str) -> str:
    try:
        return urljoin(base, href)
    except ValueError:
        return href
