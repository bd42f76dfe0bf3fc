"""Date rules: only obvious forms are changed, everything else stays as it was."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexcorpus.functions.text import inline

SLASHED = "^([0-9]{4})/([0-9]{1,2})/([0-9]{1,2})$"
DOTTED = r"^([0-9]{1,2})\.([0-9]{1,2})\.([0-9]{4})$"
YEAR = r"^\p{Nd}{4}$"
MONTH = "^[0-9]{4}-[0-9]{2}$"
DAY = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def _real_day(iso: Column) -> Column:
    return F.coalesce(
        F.try_to_date(iso, "yyyy-MM-dd").isNotNull() & ~F.startswith(iso, F.lit("0000")),
        F.lit(False),
    )


def _iso(x: Column, pattern: str, y: int, m: int, d: int) -> Column:
    part = lambda i: F.lpad(F.regexp_extract(x, pattern, i), 2, "0")
    return F.concat_ws("-", F.regexp_extract(x, pattern, y), part(m), part(d))


def with_normalized(df: DataFrame, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """Add, for each date column, its value and precision under the two given names. The
    precision is null for forms that are not read, whose value stays as it was."""
    raw = lambda c: F.col(f"_raw_{c}")
    iso = lambda c: F.col(f"_iso_{c}")
    form = lambda c: F.col(f"_form_{c}")
    df = df.withColumns({f"_raw_{c}": inline(F.col(c)) for c in columns})
    df = df.withColumns(
        {
            f"_form_{c}": F.when(raw(c).rlike(YEAR), "year")
            .when(raw(c).rlike(MONTH), "month")
            .when(raw(c).rlike(DAY), "day")
            .when(raw(c).rlike(SLASHED), "slashed")
            .when(raw(c).rlike(DOTTED), "dotted")
            for c in columns
        }
    )
    df = df.withColumns(
        {
            f"_iso_{c}": F.when(form(c) == "year", F.concat(raw(c), F.lit("-01-01")))
            .when(form(c) == "month", F.concat(raw(c), F.lit("-01")))
            .when(form(c) == "day", raw(c))
            .when(form(c) == "slashed", _iso(raw(c), SLASHED, 1, 2, 3))
            .when(form(c) == "dotted", _iso(raw(c), DOTTED, 3, 2, 1))
            for c in columns
        }
    )
    df = df.withColumns(
        {f"_ok_{c}": (form(c) == "year") | _real_day(iso(c)) for c in columns}
    )
    out = {}
    for c, (value, precision) in columns.items():
        ok = F.col(f"_ok_{c}")
        known = F.when(form(c).isin("slashed", "dotted"), "day").otherwise(form(c))
        out[value] = F.when(ok, iso(c)).otherwise(raw(c))
        out[precision] = F.when(ok, known)
    helpers = [f"_{k}_{c}" for c in columns for k in ("raw", "iso", "form", "ok")]
    return df.withColumns(out).drop(*helpers)
