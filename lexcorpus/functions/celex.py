"""Legal identifiers: token search, parsing, splitting and classes.

The three identifier patterns run one after another as replacements that turn a valid
identifier into a list of its parts. Every field then reads one place of that list, which keeps
the expressions small when Spark moves filters on them down to the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexcorpus import lookups as L
from lexcorpus.functions.text import SPACE, strip

# ---- fixed values: identifier patterns (on upper-case text without white space) ----------
TOKEN = r"(?<![A-Z0-9])([0-9CE]\d{4}[A-Z]{1,2}[A-Z0-9/.-]+(?:R\(\d{2}\))?)(?![A-Z0-9])"
BASE = r"([0-9CE])(\d{4})([A-Z]{1,2})(\d{4})"
TRANSPOSITION = rf"^7{BASE}([A-Z]{{3}})_([0-9A-Z*]+)$"
CONSOLIDATED = rf"^0{BASE}(?:-(\d{{8}}))?$"
MAIN = r"^([0-9CE])(\d{4})([A-Z]{1,4})([A-Z0-9/.-]+?)(?:R\((\d{2})\))?$"
LOOSE_CONSOLIDATED = r"^0\d{4}[A-Z]{1,4}.+\(\d{2}\)$"
LEGAL_ACT = (
    r"^(?:0(?=3\d{4}[A-Z]{1,3}\d+$))?"
    r"(3\d{4}[A-Z]{1,3}\d+|3\d{4}[A-Z]{1,4}[A-Z0-9/.-]+$)"
)
URL_TOKEN = r"(?i)(?:CELEX:|celex%3A)([0-9A-Z]{4,}[0-9A-Z()./]+)"

SEP = "\x01"
KIND, SECTOR, YEAR, DESCRIPTOR, NUMBER, CORRECTION, DATE, STATE, UID = range(9)

PARSED_FIELDS = (
    "raw", "normalized", "valid", "sector", "sector_label", "year", "descriptor",
    "descriptor_label", "document_number", "is_corrigendum", "corrigendum_number",
    "is_consolidated", "consolidated_date", "transposed_base_celex", "transposition_country",
    "transposition_uid", "notes",
)


def normalized(c: Column) -> Column:
    return F.regexp_replace(F.upper(F.coalesce(c, F.lit(""))), f"[{SPACE}]+", "")


def _group(c: Column, pattern: str, i: int) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, i), F.lit(""))


def token(c: Column) -> Column:
    """First identifier-like token of any text, or null."""
    return _group(normalized(c), TOKEN, 1)


def from_url(c: Column) -> Column:
    return F.regexp_extract(F.coalesce(c, F.lit("")), URL_TOKEN, 1)


def _parts(norm: Column) -> Column:
    """Parts of a valid identifier, by the places above; one item for an invalid one."""
    line = lambda kind, *groups: SEP.join((kind, *groups))
    x = F.regexp_replace(norm, TRANSPOSITION, line("t", "$1", "$2", "$3", "$4", "", "", "$5", "$6"))
    x = F.regexp_replace(x, CONSOLIDATED, line("c", "$1", "$2", "$3", "$4", "", "$5", "", ""))
    x = F.regexp_replace(x, MAIN, line("m", "$1", "$2", "$3", "$4", "$5", "", "", ""))
    return F.split(x, SEP, -1)


def is_valid(norm: Column) -> Column:
    return norm.rlike("|".join((TRANSPOSITION, CONSOLIDATED, MAIN)))


def split_full(c: Column) -> Column:
    return F.coalesce(strip(c), F.lit(""))


def split_base(full: Column) -> Column:
    return F.substring_index(full, "-", 1)


def split_version(full: Column) -> Column:
    return F.regexp_extract(full, "(?s)^[^-]*-(.*)$", 1)


def descriptor_label(sector: Column, descriptor: Column) -> Column:
    return F.when(
        descriptor.isNotNull(),
        F.coalesce(
            L.lookup(L.SECTOR_DESCRIPTOR_LABELS, F.concat_ws(":", sector, descriptor)),
            L.lookup(L.DESCRIPTOR_LABELS, descriptor),
            L.lookup(L.DESCRIPTOR_LABELS, F.substring(descriptor, 1, 1)),
            F.lit("Unknown descriptor"),
        ),
    )


def with_parsed(df: DataFrame, col: str, out: str = "parsed") -> DataFrame:
    """Add struct ``out`` with the parts of the identifier in ``col``."""
    at = lambda i: F.nullif(F.get(F.col("_p"), F.lit(i)), F.lit(""))
    staged = df.withColumn("_norm", normalized(F.col(col)))
    staged = staged.withColumn("_p", _parts(F.col("_norm"))).withColumns(
        {
            "_kind": F.when(F.size("_p") > 1, F.get("_p", F.lit(KIND))),
            "_own": at(SECTOR),
            "_code": at(DESCRIPTOR),
        }
    )
    kind = F.col("_kind")
    sector = F.when(kind == "t", "7").when(kind == "c", "0").otherwise(F.col("_own"))
    base = F.concat(at(SECTOR), at(YEAR), at(DESCRIPTOR), at(NUMBER))
    fields = {
        "raw": F.coalesce(F.col(col), F.lit("")),
        "normalized": F.col("_norm"),
        "valid": kind.isNotNull(),
        "sector": sector,
        "sector_label": F.coalesce(
            L.lookup(L.SECTOR_LABELS, sector), F.when(kind == "m", "Unknown sector")
        ),
        "year": at(YEAR).cast("int"),
        "descriptor": F.col("_code"),
        "descriptor_label": descriptor_label(F.col("_own"), F.col("_code")),
        "document_number": at(NUMBER),
        "is_corrigendum": at(CORRECTION).isNotNull(),
        "corrigendum_number": at(CORRECTION).cast("int"),
        "is_consolidated": F.coalesce(kind == "c", F.lit(False)),
        "consolidated_date": at(DATE),
        "transposed_base_celex": F.when(kind == "t", base),
        "transposition_country": at(STATE),
        "transposition_uid": at(UID),
        "notes": F.when(F.col("_norm") == "", "Empty input")
        .when(kind.isNull(), "Pattern mismatch")
        .when(kind == "t", "Sector 7 transposition CELEX")
        .when(kind == "c", "Sector 0 consolidated text"),
    }
    return staged.withColumn(out, F.struct(*[v.alias(k) for k, v in fields.items()])).drop(
        "_norm", "_p", "_kind", "_own", "_code"
    )


CLASS_FIELDS = (
    "celex_full", "celex", "celex_version", "celex_valid", "celex_sector", "celex_sector_label",
    "celex_descriptor", "celex_descriptor_label", "celex_notes", "celex_is_corrigendum",
    "celex_is_consolidated", "celex_class", "fulltext_support",
)


def with_class(df: DataFrame, col: str = "celex_full") -> DataFrame:
    """Add the split, the parsed parts and the retrieval class of the identifier in ``col``."""
    full, base = F.col("_full"), F.col("_full_base")
    staged = df.withColumn("_full", split_full(F.col(col))).withColumn(
        "_full_base", split_base(full)
    )
    # a versioned identifier that is no valid whole is read through its base
    staged = staged.withColumn(
        "_read",
        F.when(is_valid(normalized(full)), full)
        .when(is_valid(normalized(base)), base)
        .otherwise(full),
    )
    staged = with_parsed(staged, "_read", "_info")
    info = F.col("_info")
    loose = ~info["valid"] & full.rlike(LOOSE_CONSOLIDATED)
    own = lambda name: F.coalesce(info[name], F.lit(""))
    loose_or = lambda value, name: F.when(loose, value).otherwise(own(name))
    staged = staged.withColumn("_sector", loose_or(F.lit("0"), "sector"))
    sector = F.col("_sector")
    return staged.withColumns(
        {
            "celex_full": full,
            "celex": base,
            "celex_version": split_version(full),
            "celex_valid": info["valid"] | loose,
            "celex_sector": sector,
            "celex_sector_label": loose_or(F.lit("Consolidated texts"), "sector_label"),
            "celex_descriptor": loose_or(
                F.regexp_extract(full, r"^0\d{4}([A-Z]{1,4})", 1), "descriptor"
            ),
            "celex_descriptor_label": loose_or(
                F.lit("Consolidated non-standard form"), "descriptor_label"
            ),
            "celex_notes": loose_or(
                F.lit("Sector 0 consolidated text (non-standard suffix form)"), "notes"
            ),
            "celex_is_corrigendum": info["is_corrigendum"],
            "celex_is_consolidated": info["is_consolidated"] | (sector == "0"),
            "celex_class": F.coalesce(
                L.lookup(L.SECTOR_CLASSES, sector),
                F.when(info["is_corrigendum"], "corrigendum_or_special_form"),
                F.when(sector != "", F.concat(F.lit("sector_"), sector, F.lit("_other"))),
                F.lit("unknown_or_invalid"),
            ),
            "fulltext_support": F.when(
                sector.isin(*L.UNSUPPORTED_SECTORS), "unsupported_celex_type_for_fulltext"
            ).otherwise("supported"),
        }
    ).drop("_full", "_full_base", "_read", "_info", "_sector")


def legal_act(reference: Column) -> Column:
    """Identifier of the legal act a reference points to, without date and correction tails;
    null when it is none."""
    return _group(F.regexp_replace(token(reference), r"-\d{8}$", ""), LEGAL_ACT, 1)


def act_descriptor(act: Column) -> Column:
    return _group(act, MAIN, 3)


def act_year(act: Column) -> Column:
    return _group(act, MAIN, 2).cast("int")


def eligible_act(reference: Column) -> Column:
    """``legal_act`` where it is a directive, regulation or decision, else null."""
    act = legal_act(reference)
    return F.when(act_descriptor(act).isin(*L.ELIGIBLE_DESCRIPTORS), act)


def member_state_of(nim_celex: Column) -> Column:
    code = F.right(F.substring_index(F.upper(strip(nim_celex)), "_", 1), F.lit(3))
    return F.when(code.rlike(r"^\p{L}+$"), code)
