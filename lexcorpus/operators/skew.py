"""Joins and numbering that hold when one key has a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexcorpus.session import written


def join_sized(
    facts: DataFrame, dims: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join ``facts`` to ``dims``, which has one row per key, where any key may hold most facts.

    ``dims`` is stored first: both sides are then plain exchanges, so Spark splits the partitions
    of hot keys at run time (``spark.sql.adaptive.skewJoin``), copies the one row of ``dims`` to
    each split, and broadcasts ``dims`` where its measured size allows. No list of hot keys is
    kept, so there is no limit to how many there are.
    """
    return facts.join(written(dims), list(keys), how)


def number_rows(df: DataFrame, order: Sequence[Column], out: str, start: int = 1) -> DataFrame:
    """Number all rows in ``order`` (which must end in a unique key) without one big partition:
    a range sort, an index inside each partition, and the sizes of the partitions before it."""
    sorted_rows = written(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    placed = sorted_rows.withColumn("_part", F.shiftright(F.col("_at"), 33))
    index = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    # one row per partition of the sort
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (
        placed.join(offsets, "_part")
        .withColumn(out, F.col("_before") + index + start)
        .drop("_at", "_part", "_before")
    )


def number_within(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], out: str
) -> DataFrame:
    """Number rows from 0 inside each group, however large a group is."""
    numbered = number_rows(df, [*[F.col(g) for g in group], *order], "_no")
    starts = numbered.groupBy(*group).agg(F.min("_no").alias("_first"))
    joined = join_sized(numbered, starts, group)
    return joined.withColumn(out, F.col("_no") - F.col("_first")).drop("_no", "_first")
