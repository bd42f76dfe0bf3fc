"""Text rules written for the checking engine, as SQL expression builders."""

from __future__ import annotations

from lexcorpus import lookups as L
from lexcorpus.functions.text import SPACE, SPACE_CHARS
from lexcorpus.catalog.inputs import BOM


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sub(x: str, pattern: str, to: str = "", flags: str = "g") -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(to)}, {q(flags)})"


def has(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {q(pattern)})"


def cut(x: str, pattern: str, group: int = 1) -> str:
    return f"regexp_extract({x}, {q(pattern)}, {group})"


def strip(x: str) -> str:
    return f"trim({x}, {q(SPACE_CHARS)})"


def full(x: str) -> str:
    return f"coalesce({strip(x)}, '')"


def blank(x: str) -> str:
    return f"nullif({strip(x)}, '')"


def collapse(x: str) -> str:
    return sub(x, f"[{SPACE}]+", " ")


def inline(x: str) -> str:
    return blank(collapse(f"replace({x}, '{BOM}', '')"))


def among(x: str, values) -> str:
    return f"{x} IN ({', '.join(q(v) for v in values)})"


def mapped(x: str, values: dict, default: str = "NULL") -> str:
    cases = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in values.items())
    return f"(CASE {x} {cases} ELSE {default} END)"


def title(x: str) -> str:
    return f"(CASE WHEN lower({inline(x)}) NOT IN ({', '.join(q(v) for v in L.EMPTY_TITLES)}) THEN {inline(x)} END)"


def slug(x: str) -> str:
    return f"nullif(trim({sub(f'lower({inline(x)})', '[^a-z0-9]+', '_')}, '_'), '')"


def document_type(x: str) -> str:
    return mapped(f"lower({inline(x)})", L.DOCUMENT_TYPES, slug(x))


def jurisdiction(x: str) -> str:
    return mapped(f"lower({inline(x)})", L.JURISDICTION_ALIASES, inline(x))


def fold(x: str) -> str:
    return f"lower(replace(upper(lower({x})), 'ß', 'SS'))"


def date_candidate(x: str) -> str:
    """iso, precision of an inlined text ``x`` as one struct."""
    day = lambda y, m, d: f"concat_ws('-', {y}, lpad({m}, 2, '0'), lpad({d}, 2, '0'))"
    sl, do = "^([0-9]{4})/([0-9]{1,2})/([0-9]{1,2})$", r"^([0-9]{1,2})\.([0-9]{1,2})\.([0-9]{4})$"
    return f"""(CASE
      WHEN {has(x, '^[0-9]{4}$')} THEN {{'iso': concat({x}, '-01-01'), 'p': 'year'}}
      WHEN {has(x, '^[0-9]{4}-[0-9]{2}$')} THEN {{'iso': concat({x}, '-01'), 'p': 'month'}}
      WHEN {has(x, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$')} THEN {{'iso': {x}, 'p': 'day'}}
      WHEN {has(x, sl)} THEN {{'iso': {day(cut(x, sl, 1), cut(x, sl, 2), cut(x, sl, 3))}, 'p': 'day'}}
      WHEN {has(x, do)} THEN {{'iso': {day(cut(x, do, 3), cut(x, do, 2), cut(x, do, 1))}, 'p': 'day'}}
      END)"""


def date_value(x: str, c: str) -> str:
    return f"(CASE WHEN {date_ok(c)} THEN {c}.iso ELSE {x} END)"


def date_ok(c: str) -> str:
    return (
        f"coalesce({c}.p = 'year' OR (try_strptime({c}.iso, '%Y-%m-%d') IS NOT NULL "
        f"AND left({c}.iso, 4) <> '0000'), false)"
    )


def date_precision(c: str) -> str:
    return f"(CASE WHEN {date_ok(c)} THEN {c}.p END)"


def tidy_lines(x: str) -> str:
    x = f"replace(replace({x}, '{BOM}', ''), chr(160), ' ')"
    x = f"replace(replace({x}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"
    x = sub(x, r"[ \t\f\x0b]+", " ")
    x = sub(x, r" *\n *", "\n")
    return strip(sub(x, r"\n{3,}", "\n\n"))


def full_text(x: str) -> str:
    x = sub(tidy_lines(x), r"[\x1c-\x1e\x{85}\x{2028}\x{2029}]", "\n")
    x = sub(x, rf"^(?i:consolidated text:)[^\n]*[{SPACE}]*(?:[0-9A-Z]{{8,}}[^\n]*[{SPACE}]*)?", "", "")
    x = sub(
        strip(x),
        rf"^(?i:This text is meant purely as a documentation tool and has no legal effect\.[{SPACE}]*"
        rf"The Union's institutions do not assume any liability for its contents\.[{SPACE}]*)", "", "",
    )
    x = sub(
        strip(x),
        rf"^(?i:Caution:[{SPACE}]*This email originated from outside EPA,?[{SPACE}]*please exercise "
        rf"additional caution when deciding whether to open attachments or click links from this "
        rf"email\.[{SPACE}]*)", "", "",
    )
    return strip(sub(strip(x), r"\n{3,}", "\n\n"))


def schema_page(x: str) -> str:
    y = f"lower({strip(collapse(x))})"
    return (
        f"(starts_with({y}, 'xml schema xml schema') AND "
        f"contains({y}, 'this document describes the xml schema'))"
    )


def missing(x: str) -> str:
    return f"lower({full(x)}) IN ('', 'nan', 'none', 'null', '<na>')"


# ---- identifiers -----------------------------------------------------------------------


def norm(x: str) -> str:
    return sub(f"upper(coalesce({x}, ''))", f"[{SPACE}]+")


def token(x: str) -> str:
    return f"nullif({cut(norm(x), r'(?:^|[^A-Z0-9])([0-9CE][0-9]{4}[A-Z]{1,2}[A-Z0-9/.-]+)')}, '')"


def comparison_url(x: str) -> str:
    """Column-free form of the duplicate-audit URL rule; ``x`` must be simple and not null."""
    y = strip(x)
    parts = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"
    host = f"lower({sub(cut(y, parts, 2), '^.*@')})"
    name = sub(sub(host, ":[0-9]*$"), r"^www\.")
    port = cut(host, ":0*([1-9][0-9]*)$")
    path = sub(f"coalesce(nullif({cut(y, parts, 3)}, ''), '/')", "/+", "/")
    pairs = (
        f"list_transform(list_sort(list_transform(list_filter(string_split({cut(y, parts, 4)}, '&'), "
        "lambda s: s <> ''), lambda s: {'k': url_decode(replace(split_part(s, '=', 1), '+', ' ')), "
        "'v': url_decode(replace(regexp_extract(s, '^[^=]*=(.*)$', 1), '+', ' '))})), "
        "lambda p: replace(url_encode(p.k), '%20', '+') || '=' || replace(url_encode(p.v), '%20', '+'))"
    )
    query = f"coalesce(array_to_string({pairs}, '&'), '')"
    return (
        f"(CASE WHEN {full(x)} = '' THEN '' ELSE lower({cut(y, parts, 1)}) || '://' || {name} || "
        f"CASE WHEN {port} <> '' THEN ':' || {port} ELSE '' END || "
        f"CASE WHEN {path} = '/' THEN '/' ELSE {sub(path, '/$')} END || "
        f"CASE WHEN {query} <> '' THEN '?' || {query} ELSE '' END END)"
    )


def canonical(x: str) -> str:
    """https, lower-case host, path without parameters and closing slashes."""
    y = strip(x)
    parts = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)"
    path = f"coalesce(nullif({sub(sub(cut(y, parts, 3), ';[^/]*$'), '/+$')}, ''), '/')"
    return (
        f"(CASE WHEN coalesce({x}, '') = '' THEN '' ELSE 'https://' || lower({cut(y, parts, 2)}) "
        f"|| {path} END)"
    )


def parsed(x: str, p: str) -> str:
    """Select list of the parts of the identifier text ``x`` (already normalized), prefixed."""
    from lexcorpus import lookups as L

    base = r"[0-9CE][0-9]{4}[A-Z]{1,2}[0-9]{4}"
    tr = rf"^7({base})([A-Z]{{3}})_([0-9A-Z*]+)$"
    co = rf"^0({base})(?:-([0-9]{{8}}))?$"
    ma = r"^([0-9CE])([0-9]{4})([A-Z]{1,4})([A-Z0-9/.-]+?)(?:R\([0-9]{2}\))?$"
    kind = (
        f"CASE WHEN {x} = '' THEN 'e' WHEN {has(x, tr)} THEN 't' WHEN {has(x, co)} THEN 'c' "
        f"WHEN {has(x, ma)} THEN 'm' ELSE 'n' END"
    )
    inner = f"CASE WHEN {has(x, tr)} THEN {cut(x, tr, 1)} WHEN {has(x, co)} THEN {cut(x, co, 1)} END"
    b = r"^([0-9CE])([0-9]{4})([A-Z]{1,2})([0-9]{4})$"
    pick = lambda i: f"CASE {kind} WHEN 'm' THEN {cut(x, ma, i)} WHEN 'n' THEN NULL WHEN 'e' THEN NULL ELSE {cut(inner, b, i)} END"
    s1, d = pick(1), pick(3)
    label = (
        f"coalesce({mapped(f'({s1}) || chr(58) || ({d})', L.SECTOR_DESCRIPTOR_LABELS)}, "
        f"{mapped(f'({d})', L.DESCRIPTOR_LABELS)}, {mapped(f'left({d}, 1)', L.DESCRIPTOR_LABELS)}, "
        f"CASE WHEN ({d}) IS NOT NULL THEN 'Unknown descriptor' END)"
    )
    sector = f"CASE {kind} WHEN 't' THEN '7' WHEN 'c' THEN '0' ELSE {s1} END"

    corr = f"CASE WHEN {kind} = 'm' AND {has(x, r'R\([0-9]{2}\)$')} THEN left(right({x}, 3), 2) END"
    return f"""{x} AS {p}normalized, ({kind}) NOT IN ('e', 'n') AS {p}valid, {sector} AS {p}sector,
  {mapped(f'({sector})', L.SECTOR_LABELS)} AS {p}sector_label, cast({pick(2)} AS int) AS {p}year,
  {d} AS {p}descriptor, {label} AS {p}descriptor_label, {pick(4)} AS {p}document_number,
  ({corr}) IS NOT NULL AS {p}is_corrigendum, cast({corr} AS int) AS {p}corrigendum_number,
  ({kind}) = 'c' AS {p}is_consolidated,
  CASE WHEN ({kind}) = 'c' THEN nullif({cut(x, co, 2)}, '') END AS {p}consolidated_date,
  CASE WHEN ({kind}) = 't' THEN {cut(x, tr, 1)} END AS {p}transposed_base_celex,
  CASE WHEN ({kind}) = 't' THEN {cut(x, tr, 2)} END AS {p}transposition_country,
  CASE WHEN ({kind}) = 't' THEN {cut(x, tr, 3)} END AS {p}transposition_uid,
  CASE {kind} WHEN 'e' THEN 'Empty input' WHEN 'n' THEN 'Pattern mismatch'
    WHEN 't' THEN 'Sector 7 transposition CELEX' WHEN 'c' THEN 'Sector 0 consolidated text' END
    AS {p}notes"""


def classified(table: str, x: str, keep: str) -> str:
    """CTE chain: table ``k`` with the class columns of identifier column ``x`` of ``table``."""
    valid = r"^(?:7[0-9CE][0-9]{4}[A-Z]{1,2}[0-9]{4}[A-Z]{3}_[0-9A-Z*]+|0[0-9CE][0-9]{4}[A-Z]{1,2}[0-9]{4}(?:-[0-9]{8})?|[0-9CE][0-9]{4}[A-Z]{1,4}[A-Z0-9/.-]+?(?:R\([0-9]{2}\))?)$"
    return f"""
k0 AS (SELECT *, {full(x)} AS kf, split_part({full(x)}, '-', 1) AS kb FROM {table}),
k1 AS (SELECT *, CASE WHEN kb <> kf AND NOT {has(norm('kf'), valid)} AND {has(norm('kb'), valid)}
  THEN kb ELSE kf END AS kr FROM k0),
k2 AS (SELECT *, {parsed(norm('kr'), 'k_')} FROM k1),
k3 AS (SELECT *, NOT k_valid AND {has('kf', '^0[0-9]{4}[A-Z]{1,4}.+[(][0-9]{2}[)]$')} AS loose FROM k2),
k4 AS (SELECT *, CASE WHEN loose THEN '0' ELSE coalesce(k_sector, '') END AS ks FROM k3),
k AS (SELECT {keep}, kf AS celex_full, kb AS celex,
  CASE WHEN contains(kf, '-') THEN substr(kf, length(kb) + 2) ELSE '' END AS celex_version,
  k_valid OR loose AS celex_valid, ks AS celex_sector,
  CASE WHEN loose THEN 'Consolidated texts' ELSE coalesce(k_sector_label, '') END AS celex_sector_label,
  CASE WHEN loose THEN {cut('kf', '^0[0-9]{4}([A-Z]{1,4})')} ELSE coalesce(k_descriptor, '') END AS celex_descriptor,
  CASE WHEN loose THEN 'Consolidated non-standard form' ELSE coalesce(k_descriptor_label, '') END AS celex_descriptor_label,
  CASE WHEN loose THEN 'Sector 0 consolidated text (non-standard suffix form)' ELSE coalesce(k_notes, '') END AS celex_notes,
  k_is_corrigendum AS celex_is_corrigendum, k_is_consolidated OR ks = '0' AS celex_is_consolidated,
  CASE ks WHEN '0' THEN 'sector_0_consolidated' WHEN '1' THEN 'sector_1_treaties'
    WHEN '2' THEN 'sector_2_international_agreements' WHEN '3' THEN 'sector_3_legal_acts'
    WHEN '5' THEN 'sector_5_preparatory' WHEN '6' THEN 'sector_6_case_law'
    WHEN '7' THEN 'sector_7_national_transposition'
    ELSE CASE WHEN k_is_corrigendum THEN 'corrigendum_or_special_form'
      WHEN ks <> '' THEN 'sector_' || ks || '_other' ELSE 'unknown_or_invalid' END END AS celex_class,
  CASE WHEN ks IN ('7', '8') THEN 'unsupported_celex_type_for_fulltext' ELSE 'supported' END
    AS fulltext_support FROM k4)"""


def legal_act(x: str, eligible: bool = False) -> str:
    t = sub(token(x), "-[0-9]{8}$")
    t = sub(t, r"^0(3[0-9]{4}[A-Z]{1,3}[0-9]+)$", r"\1")
    t = f"coalesce(nullif({cut(t, '^(3[0-9]{4}[A-Z]{1,3}[0-9]+)')}, ''), {t})"
    letters = "[LRD]" if eligible else "[A-Z]{1,4}"
    last = "[0-9/.-][A-Z0-9/.-]*" if eligible else r"[A-Z0-9/.-]+?(?:R\([0-9]{2}\))?"
    return f"(CASE WHEN {has(t, '^3[0-9]{4}' + letters + last + '$')} THEN {t} END)"


def first_filled(x: str) -> str:
    return f"coalesce(arg_min({blank(x)}, ord) FILTER (WHERE {blank(x)} IS NOT NULL), '')"


def longest(x: str) -> str:
    return (
        f"coalesce(arg_min({blank(x)}, {{'l': -length({blank(x)}), 'o': ord}}) "
        f"FILTER (WHERE {blank(x)} IS NOT NULL), '')"
    )


def sorted_list(x: str, sep: str = " | ") -> str:
    return (
        f"coalesce(array_to_string(list_sort(list(DISTINCT {blank(x)}) "
        f"FILTER (WHERE {blank(x)} IS NOT NULL)), '{sep}'), '')"
    )


def failure(status: str, error: str, cls: str, support: str) -> str:
    e = f"lower(coalesce({error}, ''))"
    return f"""(CASE WHEN {support} = 'unsupported_celex_type_for_fulltext' THEN {support}
  WHEN contains({e}, 'route_exhausted_after_202') THEN 'route_exhausted_after_202'
  WHEN contains({e}, 'sector0_route_mismatch') THEN 'sector0_route_mismatch'
  WHEN contains({e}, 'no_text_representation_for_type') THEN 'no_text_representation_for_type'
  WHEN starts_with({e}, 'metadata_response') THEN 'metadata_rdf_reject'
  WHEN contains({e}, 'timeout') THEN 'timeout'
  WHEN contains({e}, 'parse_error') THEN 'parse_error'
  WHEN {status} = 202 OR contains({e}, 'http 202') THEN 'http_202'
  WHEN {status} = 404 OR contains({e}, 'http 404') THEN
    CASE WHEN {cls} = 'sector_0_consolidated' THEN 'sector0_route_mismatch' ELSE '404_not_found' END
  WHEN contains({e}, 'empty_text') THEN 'empty_text_after_successful_fetch'
  WHEN {status} >= 400 THEN 'http ' || cast({status} AS varchar) ELSE 'HTML missing' END)"""
