import random

from lexcorpus.functions import markup

BITS = (
    '<a href="/x/y">', '<a href="/x/../y">', '<a href="//h/p">', '<a href="https://q.org/a/b.html#s">', "<a href='/q'>",
    '<a href="?q=1">', '<a href="">', '<a href="/a&amp;b">', '<a href="/">', "</a>", "<b>", "</B>", "</b >", "<script>", "</script>",
    "<noscript>", "</noscript>", "<br/>", "<br>", "<!-- c -->", "<!--", "<!DOCTYPE html>", "<?pi?>", "&amp;", "&amp", "&#6",
    "<", "</>", "text ", "\n", '"', '<h1 class="title">', "</h1>", '<meta name="x" content="y&quot;">', '<A HREF="/Up">', '<a href="/x"id="t">',
)
BASES = ("https://www.e.org/a/b", "https://e.org", "", "http://u@e.org:80/x", "ftp://e.org/")


def _by_the_parser(html, base):
    reader = markup.PageReader(base)
    reader.feed(html)
    reader.done()
    read = {name: part(reader) for name, part in markup.PAGE_PARTS.items()}
    for link in read["links"]:
        link["url"] = markup._join(base, link["href"])
    return read


def test_plain_markup_reads_as_the_parser_reads_it():
    rnd = random.Random(7)
    for _ in range(3000):
        html = "".join(rnd.choice(BITS) for _ in range(rnd.randint(0, 14)))
        base = rnd.choice(BASES)
        assert markup.read_page(html, base) == _by_the_parser(html, base), (html, base)


def test_plain_markup_is_not_sent_through_the_parser(monkeypatch):
    fed = []
    monkeypatch.setattr(markup.PageReader, "feed", lambda self, html: fed.append(html))
    page = markup.read_page('<p><a href="/a/1#x">An <b>act</b></a> &amp; more</p>', "https://e.org/b", ("links", "text_plain"))
    assert page["links"] == [{"pos": 0, "href": "/a/1#x", "url": "https://e.org/a/1#x", "label": "An act"}]
    assert page["text_plain"] == "An act & more" and not fed
