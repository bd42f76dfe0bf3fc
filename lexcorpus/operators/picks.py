"""Aggregates that pick one value per group by input order. All of them combine partially."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexcorpus.functions.text import blank_to_null


def first_filled(name: str, order: str = "ord") -> Column:
    """First non-blank value, trimmed; empty when there is none."""
    value = blank_to_null(F.col(name))
    return F.coalesce(
        F.min_by(value, F.when(value.isNotNull(), F.col(order))), F.lit("")
    ).alias(name)


def longest(name: str, order: str = "ord") -> Column:
    """Longest non-blank value, trimmed; the first of equally long ones."""
    value = blank_to_null(F.col(name))
    rank = F.struct(-F.length(value), F.col(order))
    return F.coalesce(F.min_by(value, F.when(value.isNotNull(), rank)), F.lit("")).alias(name)


def sorted_values(name: str, out: str) -> Column:
    return F.array_sort(F.collect_set(blank_to_null(F.col(name)))).alias(out)
