"""Keep-first, keep-best, ordered distinct, caps per key, and merging of sources."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexcorpus.session import saved

GROUP_LIMIT = 1000
SPREAD = 64


def _one_per_key(
    df: DataFrame, keys: Sequence[str], place: Sequence[str], rank: Sequence[Column] = (),
    last: bool = True,
) -> DataFrame:
    """The row with the greatest (or least) rank and place per key; missing key values equal each
    other. ``place`` is unique.

    Only keys, ranks and places are grouped, with partial aggregates, so a hot key sends one row
    per task. Keys that occur once are done then; of the others the places that lose are stored,
    and an anti-join takes them out. Where more rows lose than win, the keys that occur often are
    the shorter list, and rows are held against them instead. Rows with texts are only moved if
    the shorter list is too long to broadcast.
    """
    order = F.struct(*rank, *[F.col(p) for p in place]).alias("_order")
    narrow = df.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *place, order)
    own = [f"_k{i}" for i in range(len(keys))]
    best = (F.max if last else F.min)("_order").alias("_best")
    best = saved(narrow.groupBy(*own).agg(best, F.count("*").alias("_n")).where("_n > 1"), "best")
    keys_met, rows_met = best.agg(F.count("*"), F.coalesce(F.sum("_n"), F.lit(0))).first()
    if rows_met - keys_met > keys_met:
        same = [df[k].eqNullSafe(best[o]) for k, o in zip(keys, own, strict=True)]
        held = df.withColumn("_order", order).join(best, reduce(and_, same), "left")
        lost = F.col("_best").isNotNull() & ~F.col("_order").eqNullSafe(F.col("_best"))
        return held.where(~lost).select(*[df[c] for c in df.columns])
    same = [narrow[k].eqNullSafe(best[k]) for k in own]
    met = narrow.join(best, reduce(and_, same)).where(~F.col("_order").eqNullSafe(F.col("_best")))
    return df.join(saved(met.select(*place), "losers"), list(place), "left_anti")


def keep_first(df: DataFrame, keys: Sequence[str], order: str = "ord") -> DataFrame:
    """First row per key in input order; missing key values equal each other."""
    return _one_per_key(df, keys, [order], last=False)


def keep_first_narrow(df: DataFrame, keys: Sequence[str], order: str = "ord") -> DataFrame:
    """``keep_first`` for tables of short columns: one pass, the row travels with its key. Each
    task sends one row per key, so a hot key stays small."""
    rest = [c for c in df.columns if c not in keys]
    row = F.min_by(F.struct(*rest), order).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, "_row.*").select(*df.columns)


def keep_best(
    df: DataFrame, keys: Sequence[str], rank: Sequence[Column], order: str = "ord"
) -> DataFrame:
    """Row with the greatest ``rank`` per key; among equals the last in input order."""
    return _one_per_key(df, keys, [order], rank)


def keep_last(df: DataFrame, keys: Sequence[str], order: str = "ord") -> DataFrame:
    return _one_per_key(df, keys, [order])


def keep_last_merged(df: DataFrame, keys: Sequence[str], order: str = "ord") -> DataFrame:
    """``keep_last`` over merged sources or batches (``part_ord``)."""
    return _one_per_key(df, keys, ["part_ord", order])


def ordered_distinct(df: DataFrame, value: str, order: str = "ord") -> DataFrame:
    """Distinct values with the position of their first occurrence."""
    return df.groupBy(value).agg(F.min(order).alias(order))


def cap_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], cap: int, spread: str = "ord"
) -> DataFrame:
    """First ``cap`` rows of every key. Spark trims each task to ``cap`` rows per key before the
    shuffle; for caps past its limit a first pass over salted keys does that trimming."""
    if cap > GROUP_LIMIT:
        salt = F.pmod(F.xxhash64(spread), F.lit(SPREAD))
        part = Window.partitionBy(*keys, salt).orderBy(*order)
        df = df.withColumn("_rn", F.row_number().over(part)).where(F.col("_rn") <= cap).drop("_rn")
    whole = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(whole)).where(F.col("_rn") <= cap).drop("_rn")


def merge_sources(parts: Sequence[DataFrame], order: str = "ord") -> DataFrame:
    """Stack tables in the given order; ``part_ord`` and ``order`` together give the position.
    A column whose kinds differ between the tables becomes text."""
    kinds: dict[str, set[str]] = {}
    for part in parts:
        for name, kind in part.dtypes:
            kinds.setdefault(name, set()).add(kind)
    mixed = [name for name, found in kinds.items() if len(found) > 1]
    stacked = None
    for place, part in enumerate(parts):
        part = part.withColumn("part_ord", F.lit(place))
        part = part.withColumns({c: F.col(c).cast("string") for c in mixed if c in part.columns})
        stacked = part if stacked is None else stacked.unionByName(part, allowMissingColumns=True)
    return stacked


def keep_first_merged(df: DataFrame, keys: Sequence[str], order: str = "ord") -> DataFrame:
    """``keep_first`` over merged sources."""
    return _one_per_key(df, keys, ["part_ord", order], last=False)
