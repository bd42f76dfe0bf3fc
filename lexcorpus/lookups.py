"""Labels, aliases and orders that results must agree on."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: jurisdictions -------------------------------------------------------
JURISDICTION_ORDER = ("EU", "UK", "CA", "AUS", "NZ", "US")
JURISDICTION_LABELS = {
    "EU": "European Union",
    "UK": "United Kingdom",
    "CA": "Canada",
    "AUS": "Australia",
    "NZ": "New Zealand",
    "US": "United States",
}
JURISDICTION_ALIASES = {
    "australia": "Australia",
    "canada": "Canada",
    "eu": "European Union",
    "european union": "European Union",
    "new zealand": "New Zealand",
    "nz": "New Zealand",
    "uk": "United Kingdom",
    "united kingdom": "United Kingdom",
    "united states": "United States",
    "united states of america": "United States",
    "us": "United States",
    "usa": "United States",
}
SOURCE_COUNTRY = {
    "UK": "UK",
    "UK_GOVUK": "UK",
    "US": "US",
    "Canada": "Canada",
    "CA": "Canada",
    "Australia": "Australia",
    "AUS": "Australia",
    "AU": "Australia",
    "New Zealand": "New Zealand",
    "NZ": "New Zealand",
}

# ---- fixed values: titles and document types -------------------------------------------
EMPTY_TITLES = ("none", "n/a", "na", "null", "untitled")
MISSING_WORDS = ("", "nan", "none", "null", "<na>")
DOCUMENT_TYPES = {
    "commission document (green paper, white paper, report, communication)": "eu_communication",
    "commission proposal for legal act (com proposal)": "eu_proposal",
    "commission staff working document (swd / sec)": "eu_staff_working_document",
    "communication / information": "eu_communication",
    "committee of the regions opinion": "eu_opinion",
    "decision": "eu_decision",
    "decision (agreement-related)": "eu_decision",
    "directive": "eu_directive",
    "eu_document": "eu_document",
    "eu_legal_document": "eu_document",
    "european parliament legislative resolution": "eu_resolution",
    "national_implementation_measure": "national_implementation_measure",
    "opinion": "eu_opinion",
    "policy_document": "policy_document",
    "regulation": "eu_regulation",
    "tribunal case": "eu_case_law",
    "unknown descriptor": "eu_document",
}

# ---- fixed values: legal identifier sectors and descriptors ----------------------------
SECTOR_LABELS = {
    "0": "Consolidated texts",
    "1": "Treaties",
    "2": "International agreements",
    "3": "Legal acts",
    "4": "Complementary legislation",
    "5": "Preparatory documents",
    "6": "EU case-law",
    "7": "National transposition",
    "8": "National case-law relating to EU law",
    "9": "Parliamentary questions",
    "C": "Other documents published in OJ C series",
    "E": "EFTA documents",
}
SECTOR_DESCRIPTOR_LABELS = {
    "1:K": "Treaty establishing the ECSC",
    "1:E": "Treaty establishing the EEC / EC",
    "1:M": "Treaty on European Union (Maastricht)",
    "1:A": "Amsterdam Treaty",
    "1:N": "Nice Treaty",
    "1:L": "Lisbon Treaty",
    "2:A": "Agreement",
    "2:D": "Decision (agreement-related)",
    "2:P": "Protocol",
    "3:R": "Regulation",
    "3:L": "Directive",
    "3:D": "Decision",
    "3:F": "Framework decision (pre-Lisbon)",
    "3:H": "Recommendation",
    "3:A": "Agreement (legal act form)",
    "3:B": "Budget act",
    "3:C": "Communication",
    "3:E": "Common position",
    "3:G": "Resolution",
    "3:J": "Joint action",
    "3:K": "Recommendation ECSC",
    "3:M": "Decision ECSC",
    "3:P": "Proposal for legal act",
    "4:X": "Complementary legislation document",
    "5:PC": "Commission proposal for legal act (COM proposal)",
    "5:DC": "Commission document (Green paper, White paper, report, communication)",
    "5:SC": "Commission staff working document (SWD / SEC)",
    "5:SWD": "Staff working document",
    "5:SEC": "Staff working document (older code)",
    "5:JC": "JOIN document (Joint Communication)",
    "5:JOIN": "Joint Communication",
    "5:IP": "European Parliament resolution / preparatory act",
    "5:AR": "Committee of the Regions opinion",
    "5:AE": "European Economic and Social Committee opinion",
    "5:BP": "European Central Bank opinion",
    "5:IR": "Interinstitutional report",
    "5:XR": "Court of Auditors opinion",
    "5:SA": "Council statement",
    "5:AP": "European Parliament legislative resolution",
    "5:DMA": "Digital Markets Act preparatory document",
    "5:DSA": "Digital Services Act preparatory document",
    "6:CC": "Opinion of the Advocate General",
    "6:CO": "Order of the Court",
    "6:CJ": "Court of Justice judgment",
    "6:TJ": "General Court judgment",
    "6:TC": "Civil Service Tribunal judgment",
    "6:TR": "Tribunal order",
    "6:TO": "Order of the General Court",
    "7:L": "National implementing measure",
    "8:CJ": "National court decision citing EU law",
    "9:E": "Written question",
    "9:O": "Oral question",
    "9:H": "Question time",
    "C:A": "Information notice",
    "C:C": "Communication in OJ C series",
    "C:R": "Resolution published in OJ C",
    "E:J": "EFTA Court judgment",
    "E:O": "EFTA Surveillance Authority decision",
}
DESCRIPTOR_LABELS = {
    "A": "Agreement / Act / Notice",
    "AE": "EESC opinion",
    "AP": "Parliament resolution",
    "AR": "Committee of the Regions opinion",
    "B": "Budgetary act",
    "BP": "ECB opinion",
    "C": "Communication / Information",
    "CJ": "Court judgment",
    "CO": "Court order",
    "D": "Decision",
    "DC": "Commission document",
    "E": "Treaty / EEA related document",
    "F": "Framework decision",
    "G": "Resolution / Recommendation",
    "H": "Recommendation",
    "IP": "Parliament document",
    "IR": "Interinstitutional report",
    "J": "Joint action",
    "JC": "Joint communication",
    "JOIN": "Joint communication",
    "K": "ECSC related act",
    "L": "Directive",
    "M": "Decision (ECSC)",
    "N": "National measure",
    "O": "Order / Oral question",
    "P": "Proposal",
    "PC": "Commission proposal",
    "R": "Regulation",
    "S": "Staff document",
    "SC": "Staff working document",
    "SEC": "Staff working document",
    "SWD": "Staff working document",
    "T": "Tribunal case",
    "TC": "Civil Service Tribunal case",
    "TJ": "General Court judgment",
    "TO": "Tribunal order",
    "XR": "Court of Auditors opinion",
}
SECTOR_CLASSES = {
    "0": "sector_0_consolidated",
    "1": "sector_1_treaties",
    "2": "sector_2_international_agreements",
    "3": "sector_3_legal_acts",
    "5": "sector_5_preparatory",
    "6": "sector_6_case_law",
    "7": "sector_7_national_transposition",
}
UNSUPPORTED_SECTORS = ("7", "8")
ELIGIBLE_DESCRIPTORS = ("L", "R", "D")

# ---- fixed values: member states and languages -----------------------------------------
MEMBER_STATES = {
    "AUT": "Austria", "BEL": "Belgium", "BGR": "Bulgaria", "HRV": "Croatia", "CYP": "Cyprus",
    "CZE": "Czechia", "DNK": "Denmark", "EST": "Estonia", "FIN": "Finland", "FRA": "France",
    "DEU": "Germany", "GRC": "Greece", "HUN": "Hungary", "IRL": "Ireland", "ITA": "Italy",
    "LVA": "Latvia", "LTU": "Lithuania", "LUX": "Luxembourg", "MLT": "Malta", "NLD": "Netherlands",
    "POL": "Poland", "PRT": "Portugal", "ROU": "Romania", "SVK": "Slovakia", "SVN": "Slovenia",
    "ESP": "Spain", "SWE": "Sweden", "GBR": "United Kingdom",
}
LANG3_TO_LANG2 = {
    "bul": "BG", "ces": "CS", "dan": "DA", "deu": "DE", "ell": "EL", "eng": "EN", "spa": "ES",
    "est": "ET", "fin": "FI", "fra": "FR", "gle": "GA", "hrv": "HR", "hun": "HU", "ita": "IT",
    "lav": "LV", "lit": "LT", "mlt": "MT", "nld": "NL", "pol": "PL", "por": "PT", "ron": "RO",
    "slk": "SK", "slv": "SL", "swe": "SV",
}
# languages tried for a measure's text, by member state
MEMBER_STATE_TRY_LANGS = {
    "AUT": "DE", "BEL": "FR,NL,DE", "BGR": "BG", "HRV": "HR", "CYP": "EL,EN", "CZE": "CS",
    "DNK": "DA", "EST": "ET", "FIN": "FI,SV", "FRA": "FR", "DEU": "DE", "GRC": "EL", "HUN": "HU",
    "IRL": "EN,GA", "ITA": "IT", "LVA": "LV", "LTU": "LT", "LUX": "FR,DE,EN", "MLT": "MT,EN",
    "NLD": "NL", "POL": "PL", "PRT": "PT", "ROU": "RO", "SVK": "SK", "SVN": "SL", "ESP": "ES",
    "SWE": "SV",
}
# first official language by member state, used when nothing else tells the language
MEMBER_STATE_MAIN_LANG = {
    "AUT": "de", "BEL": "nl", "BGR": "bg", "HRV": "hr", "CYP": "el", "CZE": "cs", "DNK": "da",
    "EST": "et", "FIN": "fi", "FRA": "fr", "DEU": "de", "GRC": "el", "HUN": "hu", "IRL": "ga",
    "ITA": "it", "LVA": "lv", "LTU": "lt", "LUX": "fr", "MLT": "mt", "NLD": "nl", "POL": "pl",
    "PRT": "pt", "ROU": "ro", "SVK": "sk", "SVN": "sl", "ESP": "es", "SWE": "sv",
}

# ---- fixed values: routes, file formats, search terms ----------------------------------
ROUTE_ORDER = (
    "direct_text_pdf",
    "direct_text_docx",
    "direct_text_doc",
    "direct_text_file",
    "national_website_eli",
    "national_website",
    "machine_translation",
    "fallback_generic/eurlex_url",
    "fallback_generic/legal-content-html",
    "fallback_generic/legal-content-txt",
    "fallback_generic/legal-content-html-en",
    "fallback_generic/lexuriserv",
)
DOWNLOAD_FORMAT_SCORES = {"htm": 50, "html": 50, "txt": 45, "pdf": 40, "xml": 20, "docx": 10, "doc": 5}
DATA_FILE_EXTENSIONS = (
    "zip", "gz", "7z", "rar", "csv", "tsv", "xlsx", "xls",
    "json", "geojson", "shp", "gpkg", "tif", "tiff", "xml",
)
UK_DATASETS = (
    "ukpga", "uksi", "ukla", "asp", "anaw", "wsi", "ssi", "nisr", "nisi", "ukdsi", "sdsi",
)
SEARCH_TERMS = (
    "nature-positive",
    "nature positive",
    "nature inclusive",
    "nature-inclusive",
    "nature inclusive design",
    "nature based solutions",
    "nature-based solutions",
    "biodiversity net gain",
    "biodiversity net-gain",
    "biodiversity gain",
    "nature restoration",
    "nature repair",
    "biodiversity strategy",
)
FULLTEXT_TERMS = (
    "nature-positive",
    "nature positive",
    "nature inclusive",
    "nature-inclusive",
    "nature inclusive design",
    "nature-inclusive design",
    "nature based solutions",
    "nature-based solutions",
    "biodiversity net gain",
    "net gain",
    "net-gain",
    "biodiversity net-gain",
    "biodiversity gain",
    "nature restoration",
    "nature repair",
    "biodiversity strategy",
)


def literal_map(values: dict) -> Column:
    """A lookup table of known size as a map literal."""
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(values.items())])


def lookup(values: dict, key: Column) -> Column:
    """Value for ``key``, null when the key is unknown or null."""
    return F.try_element_at(literal_map(values), key)
