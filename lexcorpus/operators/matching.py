"""Matching records and texts with queries and search terms."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexcorpus.functions.text import fold, parse_list, strip


class Query(NamedTuple):
    """One search query of a run."""

    text: str
    query_id: str
    origin: str = "inline"
    source_path: str | None = None


def inline_queries(terms: Sequence[str], origin: str = "inline") -> list[Query]:
    return [Query(t, f"{origin}-{i:03d}", origin) for i, t in enumerate(terms, start=1)]


def query_array(queries: Sequence[Query]) -> Column:
    """The run's query list, which is part of its settings, as an array literal."""
    return F.array(
        *[
            F.struct(
                F.lit(i).alias("query_ord"),
                F.lit(q.text).alias("query_text"),
                F.lit(q.query_id).alias("query_id"),
                F.lit(q.origin).alias("query_origin"),
                F.lit(q.source_path).cast("string").alias("query_source_path"),
            )
            for i, q in enumerate(queries)
        ]
    )


def match_queries(
    records: DataFrame, queries: Sequence[Query], field: str = "queries"
) -> DataFrame:
    """Records per query. A record's term list (or single term) must hold the query; a record
    without the field belongs to every query. The query list is a literal, so the records are
    neither joined nor shuffled."""
    listed = dict(records.dtypes)[field].startswith("array")
    terms = F.col(field) if listed else parse_list(F.col(field))
    folded = F.transform(F.coalesce(terms, F.array().cast("array<string>")),
                         lambda t: fold(strip(t)))
    asked = F.filter(
        query_array(queries),
        lambda q: F.col(field).isNull()
        | F.array_contains(F.col("_terms"), fold(strip(q["query_text"]))),
    )
    return (
        records.withColumn("_terms", folded)
        .withColumn("_q", F.explode(asked))
        .select(*records.columns, "_q.*")
    )


def match_terms(
    docs: DataFrame, terms: Sequence[str], title: str = "title", body: str = "full_text",
    out: str = "term",
) -> DataFrame:
    """One row per document and term found in its title or text, ignoring case; documents
    without any term give one row with an empty term. The terms travel as a literal, so the
    texts are neither joined nor shuffled."""
    blank = F.lit("")
    text = F.lower(
        F.concat(F.coalesce(title, blank), F.lit(" "), F.coalesce(body, blank))
    )
    sought = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(t.lower()).alias("low")) for t in terms])
    found = F.transform(
        F.filter(sought, lambda x: F.contains(F.col("_text"), x["low"])), lambda x: x["t"]
    )
    return (
        docs.withColumn("_text", text)
        .withColumn("_found", found)
        .withColumn(out, F.explode(F.when(F.size("_found") > 0, F.col("_found")).otherwise(
            F.array(blank))))
        .drop("_text", "_found")
    )
