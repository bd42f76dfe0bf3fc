"""XML payloads by column expressions: one reader's check that a payload is whole, then its elements
by name, at any depth and whatever their prefixes.

An element is taken as far as the next end tag of its name, so elements that are read by name must
not hold others of the same name; those of hits, notices, records and acts don't.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexcorpus.functions.text import collapse, strip

BOM = chr(0xFEFF)
_PREFIX = r"(?:[^\s<>/:]++:)?+"
#: What a start tag holds after its name, a last slash included; signs in quotes are skipped.
_ATTRIBUTES = r"""[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+"""
_HEAD = rf"^<{_PREFIX}([^\s<>/]++)({_ATTRIBUTES})"
_ANY = rf"<[^\s<>/!?][^\s<>/]*+(?=[\s/>]){_ATTRIBUTES}"
_CHECK = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken", "ignoreNamespace": "true"}
_BLANKS = " \t\r\n"


def _names(names: tuple[str, ...]) -> str:
    return "(?:" + "|".join(n.replace(".", r"\.") for n in names) + ")"


def _element(names: str) -> str:
    # nothing is tried twice: all parts take what they can and give nothing back
    return rf"<({names})(?=[\s/>]){_ATTRIBUTES}(?:(?<=/)>|>(?:[^<]++|<(?!/\1[\s>]))*+</\1\s*>)"


def _all(x: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(x, F.lit(pattern), F.lit(group))


def _nothing(kind: str = "string") -> Column:
    return F.array().cast(f"array<{kind}>")


def readable(body: Column) -> Column:
    """``body`` without comments, instructions and document type, its CDATA as escaped text; null
    where it is no whole XML document. The check is that of Spark's own XML reader, which gives a
    broken document back instead of failing the job. (It takes a second root element for the end.)"""
    body = F.when(F.startswith(body, F.lit(BOM)), F.substring(body, F.lit(2), F.length(body))).otherwise(body)
    broken = F.from_xml(body, "broken string, root_of_none string", _CHECK)["broken"]
    trimmed = F.btrim(body, F.lit(_BLANKS))
    framed = F.startswith(trimmed, F.lit("<")) & F.endswith(trimmed, F.lit(">"))

    def escaped(part: Column, i: Column) -> Column:
        inside = F.substring_index(part, "]]>", 1)
        safe = F.replace(F.replace(inside, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
        return F.when(i == 0, part).otherwise(F.concat(safe, F.substring(part, F.length(inside) + 4, F.length(part))))

    unpacked = F.array_join(F.transform(F.split(body, r"<!\[CDATA\["), escaped), "")
    plain = F.when(F.contains(body, F.lit("<![CDATA[")), unpacked).otherwise(body)
    bare = F.regexp_replace(plain, r"(?s)<!--.*?-->|<\?.*?\?>|<!DOCTYPE[^>\[]*(?:\[.*?\]\s*)?>", "")
    return F.when(framed & broken.isNull(), bare)


def decoded(x: Column) -> Column:
    """Text or attribute with its references resolved; numbers are left to Spark's XML reader."""
    named = x
    for mark, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        named = F.replace(named, F.lit(mark), F.lit(sign))
    escaped = F.replace(x, F.lit(">"), F.lit("&gt;"))
    numbered = F.from_xml(F.concat(F.lit("<r><v>"), escaped, F.lit("</v></r>")), "v string", {"ignoreSurroundingSpaces": "false"})["v"]
    plain = F.when(F.contains(x, F.lit("&#")), F.coalesce(numbered, F.lit(""))).otherwise(named)
    return F.when(F.contains(x, F.lit("&")), plain).otherwise(x)


def once(x: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it is named."""
    return F.get(F.transform(F.array(x), use), F.lit(0))


def _text(x: Column) -> Column:
    return once(x, lambda v: strip(decoded(v)))


def _texts(found: Column) -> Column:
    return F.filter(F.transform(found, lambda v: strip(decoded(v))), lambda t: t != "")


def elements(x: Column, *names: str) -> Column:
    """Whole elements of these names in order, those inside one of them left out."""
    held = F.contains(x, F.lit(names[0]))
    for n in names[1:]:
        held |= F.contains(x, F.lit(n))
    return F.when(held, _all(x, _element(_PREFIX + _names(names)))).when(x.isNotNull(), _nothing())


def first(x: Column, name: str) -> Column:
    """The first element of this name; empty where there is none."""
    return F.regexp_extract(x, _element(_PREFIX + _names((name,))), 0)


def name_of(element: Column) -> Column:
    return F.regexp_extract(element, _HEAD, 1)


def attributes(element: Column) -> Column:
    return F.regexp_extract(element, _HEAD, 2)


def own_text(element: Column) -> Column:
    """An element's text before its first child."""
    return _text(F.regexp_extract(element, _HEAD + r"(?:(?<=/)>|>([^<]*+))", 3))


def texts(element: Column, name: str) -> Column:
    """Texts of all elements of this name, blank ones left out."""
    found = _all(element, rf"<{_PREFIX}{_names((name,))}(?=[\s/>]){_ATTRIBUTES}(?:(?<=/)>|>([^<]*+))", 1)
    return F.when(F.contains(element, F.lit(name)), _texts(found)).otherwise(_nothing())


def children(element: Column, name: str) -> Column:
    """Texts of an element's own children of this name, blank ones left out."""
    held = F.regexp_extract(element, rf"(?s){_HEAD}>(.*)</", 3)
    own = F.filter(_all(held, _element(r"[^\s<>/!?][^\s<>/]*+")), lambda e: name_of(e) == name)
    spoken = F.filter(F.transform(own, own_text), lambda t: t != "")
    return F.when(F.contains(element, F.lit(name)), spoken).otherwise(_nothing())


def tagged(element: Column, name: str) -> Column:
    """Start tags of this name, each with the text that follows it."""
    return _all(element, rf"<{_PREFIX}{_names((name,))}(?=[\s/>]){_ATTRIBUTES}>[^<]*+")


def everything(x: Column) -> Column:
    """All start tags, each before those it holds, with the text that follows it."""
    return _all(x, _ANY + ">[^<]*+")


def values(tag: Column) -> Column:
    """Values of a start tag's attributes; declarations of prefixes are none."""
    quoted = _all(attributes(tag), r"""(?<!\S)(?!xmlns[\s:=])[^\s="']+\s*=\s*("[^"]*"|'[^']*')""", 1)
    found = F.transform(quoted, lambda v: strip(decoded(F.substring(v, F.lit(2), F.length(v) - 2))))
    return F.when(F.contains(tag, F.lit("=")), found).otherwise(_nothing())


def attribute(tag: Column, name: str) -> Column:
    """The value of one attribute by its full name; empty where it is absent."""
    quoted = F.regexp_extract(attributes(tag), rf"""(?<!\S){name}\s*=\s*("[^"]*"|'[^']*')""", 1)
    found = once(quoted, lambda v: strip(decoded(F.substring(v, F.lit(2), F.greatest(F.length(v) - 2, F.lit(0))))))
    return F.when(F.contains(tag, F.lit(name)), found).otherwise(F.lit(""))


def visible(x: Column, skipped: tuple[str, ...]) -> Column:
    """All text outside the elements named in ``skipped``, in one line."""
    held = F.contains(x, F.lit(skipped[0]))
    for n in skipped[1:]:
        held |= F.contains(x, F.lit(n))
    kept = F.when(held, F.regexp_replace(x, _element(_PREFIX + _names(skipped)), " ")).otherwise(x)
    return once(F.regexp_replace(kept, rf"</?[^\s<>/!?]{_ATTRIBUTES}>", " "), lambda v: strip(collapse(decoded(v))))
