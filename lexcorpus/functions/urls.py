"""URL rules, staged over a few columns so that each pattern runs once per row.

Parts are cut by pattern, so odd characters never lose a URL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexcorpus.functions.text import empty, strip

PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"
SCHEME, NETLOC, PATH, QUERY = 1, 2, 3, 4


def part(url: Column, which: int) -> Column:
    """One part of a URL; empty when it has none."""
    return F.regexp_extract(url, PARTS, which)


def cleaned(url: Column) -> Column:
    """A URL without the characters URL readers drop."""
    return F.regexp_replace(F.coalesce(strip(url), empty()), r"^[\x00-\x20]+|[\t\r\n]", "")


def segments(path: Column) -> Column:
    """The non-empty steps of a path."""
    return F.split(F.btrim(F.regexp_replace(path, "/+", "/"), F.lit("/")), "/", -1)


def steps(path: Column) -> Column:
    """Number of non-empty steps of a path."""
    return F.when(F.btrim(path, F.lit("/")) == "", 0).otherwise(F.size(segments(path)))


def step(path: Column, i: int) -> Column:
    """Step ``i`` of a path, null when there are fewer."""
    return F.nullif(F.get(segments(path), F.lit(i)), empty())


def _rebuild(scheme: Column, netloc: Column, path: Column) -> Column:
    rooted = F.startswith(path, F.lit("/"))
    return (
        F.when(
            netloc != "",
            F.concat(
                F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(empty()),
                F.lit("//"),
                netloc,
                F.when(rooted | (path == ""), path).otherwise(F.concat(F.lit("/"), path)),
            ),
        )
        .when((scheme == ""), path)
        .when(rooted & scheme.isin("http", "https", "ftp"), F.concat(scheme, F.lit("://"), path))
        .otherwise(F.concat(scheme, F.lit(":"), path))
    )


def _decode(c: Column) -> Column:
    # a percent sign that starts no escape stands for itself
    return F.url_decode(F.regexp_replace(c, "%(?![0-9A-Fa-f]{2})", "%25"))


def _encode(c: Column) -> Column:
    x = F.replace(F.url_encode(c), F.lit("%7E"), F.lit("~"))
    return F.replace(x, F.lit("*"), F.lit("%2A"))


def sorted_query(query: Column) -> Column:
    """Query pairs decoded, sorted and encoded again; blank values are kept."""
    pairs = F.transform(
        F.filter(F.split(query, "&", -1), lambda s: s != ""),
        lambda s: F.struct(
            _decode(F.regexp_extract(s, "(?s)^([^=]*)", 1)).alias("k"),
            _decode(F.regexp_extract(s, "(?s)^[^=]*=(.*)$", 1)).alias("v"),
        ),
    )
    return F.array_join(
        F.transform(
            F.array_sort(pairs), lambda p: F.concat(_encode(p["k"]), F.lit("="), _encode(p["v"]))
        ),
        "&",
    )


def with_comparison(df: DataFrame, col: str, out: str) -> DataFrame:
    """Add the URL form used to find likely duplicates; empty for null or blank."""
    u, at, path = F.col("_u"), F.col("_at"), F.col("_path")
    df = df.withColumn("_u", cleaned(F.col(col)))
    df = df.withColumns(
        {
            "_scheme": F.lower(part(u, SCHEME)),
            "_at": F.regexp_replace(part(u, NETLOC), "^.*@", ""),
            "_path": F.regexp_replace(part(u, PATH), "/+", "/"),
            "_query": part(u, QUERY),
        }
    )
    host = F.when(
        F.startswith(at, F.lit("[")), F.regexp_extract(at, r"^\[([^\]]*)", 1)
    ).otherwise(F.substring_index(at, ":", 1))
    df = df.withColumns(
        {
            "_host": F.regexp_replace(F.lower(host), r"^www\.", ""),
            "_port": F.regexp_extract(at, r"^(?:\[[^\]]*\]|[^:]*):0*([1-9][0-9]*)$", 1),
            "_path": F.when(path.isin("", "/"), "/").otherwise(F.regexp_replace(path, "/$", "")),
            "_query": F.when(F.col("_query") != "", sorted_query(F.col("_query"))),
        }
    )
    netloc = F.concat_ws(":", F.col("_host"), F.nullif(F.col("_port"), empty()))
    df = df.withColumn("_netloc", netloc)
    url = F.concat_ws(
        "?", _rebuild(F.col("_scheme"), F.col("_netloc"), path), F.nullif(F.col("_query"), empty())
    )
    return df.withColumn(out, F.when(u != "", url).otherwise(empty())).drop(
        "_u", "_scheme", "_at", "_path", "_query", "_host", "_port", "_netloc"
    )


def with_canonical(df: DataFrame, col: str, out: str) -> DataFrame:
    """Add the https form with a lower-case host and no query, fragment or trailing slash."""
    u = F.col("_u")
    df = df.withColumns({"_u": cleaned(F.col(col)), "_given": F.coalesce(F.col(col), empty())})
    df = df.withColumns(
        {
            "_host": F.lower(part(u, NETLOC)),
            "_path": F.regexp_replace(F.regexp_replace(part(u, PATH), ";[^/]*$", ""), "/+$", ""),
        }
    )
    path = F.when(F.col("_path") == "", "/").otherwise(F.col("_path"))
    return df.withColumn(
        out,
        F.when(F.col("_given") != "", _rebuild(F.lit("https"), F.col("_host"), path)).otherwise(
            empty()
        ),
    ).drop("_u", "_given", "_host", "_path")


def host(c: Column) -> Column:
    return F.regexp_replace(F.lower(part(cleaned(c), NETLOC)), "^.*@|:[0-9]*$", "")
