"""Text cleaning rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexcorpus import lookups as L

# Every character the rules treat as white space, as a class body and as plain characters.
SPACE = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
SPACE_CHARS = "".join(
    chr(i)
    for i in (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
              *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
)
TITLE_EDGE = " -|:\n\t"
BOM = "\ufeff"
NBSP = "\u00a0"
FILE_LINE = r"[A-Za-z0-9_.-]+\.(?i:xml|html|xhtml|txt)"
JOURNAL_PHRASE = "official journal of the european union"


def empty() -> Column:
    return F.lit("")


def strip(c: Column, chars: str = SPACE_CHARS) -> Column:
    return F.btrim(c, F.lit(chars))


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def text_or_empty(c: Column) -> Column:
    return F.coalesce(strip(c), F.lit(""))


def collapse(c: Column) -> Column:
    return F.regexp_replace(c, f"[{SPACE}]+", " ")


def inline(c: Column) -> Column:
    """One-line form: no byte-order mark, single spaces, null when blank."""
    return blank_to_null(collapse(F.replace(c, F.lit(BOM), F.lit(""))))


# The ``*_of`` forms take text that is already in its one-line form.


def title_of(x: Column) -> Column:
    return F.when(~F.lower(x).isin(*L.EMPTY_TITLES), x)


def title(c: Column) -> Column:
    return title_of(inline(c))


def slug_of(x: Column) -> Column:
    return F.nullif(
        F.btrim(F.regexp_replace(F.lower(x), "[^a-z0-9]+", "_"), F.lit("_")), F.lit("")
    )


def slug(c: Column) -> Column:
    return slug_of(inline(c))


def document_type_of(x: Column) -> Column:
    return F.coalesce(L.lookup(L.DOCUMENT_TYPES, F.lower(x)), slug_of(x))


def document_type(c: Column) -> Column:
    return document_type_of(inline(c))


def language(c: Column) -> Column:
    return F.lower(inline(c))


def corpus_language(c: Column) -> Column:
    """Language of a harmonized row: English unless another one is named."""
    x = F.lower(text_or_empty(c))
    return F.when(x.isin("", "nan", "none", "en", "eng", "english"), "en").otherwise(x)


def jurisdiction_of(x: Column, code: str | None = None) -> Column:
    label = L.JURISDICTION_LABELS.get((code or "").upper())
    return F.lit(label) if label else F.coalesce(L.lookup(L.JURISDICTION_ALIASES, F.lower(x)), x)


def fold(c: Column) -> Column:
    """Case folding for comparisons (``ẞ``, ``ß`` and ``ss`` agree)."""
    return F.lower(F.upper(F.lower(c)))


def folded_title(c: Column) -> Column:
    return collapse(fold(strip(c)))


def identifier(c: Column) -> Column:
    return F.upper(F.regexp_replace(c, f"[{SPACE}]+", ""))


def tidy_lines(c: Column) -> Column:
    """Unix newlines, single blanks inside lines, at most one empty line in a row."""
    x = F.replace(F.replace(c, F.lit(BOM), F.lit("")), F.lit(NBSP), F.lit(" "))
    x = F.replace(F.replace(x, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    x = F.regexp_replace(x, r"[ \t\f\x0b]+", " ")
    x = F.regexp_replace(x, " ?\n ?", "\n")
    return strip(F.regexp_replace(x, "\n{3,}", "\n\n"))


def body_lines(c: Column) -> Column:
    """Document body with tidy lines and without source boilerplate."""
    x = F.regexp_replace(tidy_lines(c), r"[\x1c-\x1e\x{85}\x{2028}\x{2029}]", "\n")
    x = F.regexp_replace(
        x,
        rf"^(?i:consolidated text:)[^\n]*[{SPACE}]*(?:[0-9A-Z]{{8,}}[^\n]*[{SPACE}]*)?",
        "",
    )
    x = F.regexp_replace(
        strip(x),
        rf"^(?is:This text is meant purely as a documentation tool and has no legal effect\."
        rf"[{SPACE}]*The Union's institutions do not assume any liability for its contents\."
        rf"[{SPACE}]*)",
        "",
    )
    x = F.regexp_replace(
        strip(x),
        rf"^(?is:Caution:[{SPACE}]*This email originated from outside EPA,?[{SPACE}]*"
        rf"please exercise additional caution when deciding whether to open attachments "
        rf"or click links from this email\.[{SPACE}]*)",
        "",
    )
    return strip(F.regexp_replace(strip(x), "\n{3,}", "\n\n"))


def body_of(x: Column) -> Column:
    """Null for an empty body and for schema descriptions, else the body (from ``body_lines``)."""
    gap = f"[{SPACE}]+"
    schema_page = x.rlike("^(?i:" + gap.join(["xml", "schema", "xml", "schema"]) + ")") & x.rlike(
        "(?i:" + gap.join(["this", "document", "describes", "the", "xml", "schema"]) + ")"
    )
    return F.when(~schema_page, F.nullif(x, F.lit("")))


def full_text(c: Column) -> Column:
    """Document body without source boilerplate; null when nothing is left."""
    return body_of(body_lines(c))


def light_text(c: Column) -> Column:
    """Tidy lines, and drop a first line that is only a file name."""
    line_space = SPACE.replace(r"\t-\r", r"\t\x0b-\r")
    return strip(F.regexp_replace(tidy_lines(c), rf"^{FILE_LINE}[{line_space}]*\n[{SPACE}]*", ""))


def cached_text(c: Column) -> Column:
    """As ``light_text``, but the file name goes only when the journal phrase follows."""
    tidy = tidy_lines(c)
    return F.when(F.contains(F.lower(tidy), F.lit(JOURNAL_PHRASE)), light_text(c)).otherwise(tidy)


def single_line(c: Column) -> Column:
    return F.coalesce(strip(collapse(c)), F.lit(""))


def missing(c: Column) -> Column:
    """True for null, blank and the literal words that stand for a missing value."""
    return F.lower(text_or_empty(c)).isin(*L.MISSING_WORDS)


def parse_list(c: Column) -> Column:
    """A JSON array string, or one plain value, as a list without blanks; null when blank."""
    x = blank_to_null(c)
    parsed = F.from_json(F.when(x.rlike(r"(?s)^\[.*\]$"), x), "array<string>")
    items = F.coalesce(parsed, F.array(x))
    return F.when(
        x.isNotNull(),
        F.filter(F.transform(items, strip), lambda v: v.isNotNull() & (v != "")),
    )
