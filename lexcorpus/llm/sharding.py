"""Reproducible shuffle into shards: a Feistel permutation of global row numbers."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexcorpus.llm.store import own_names, stored, without

ROUNDS = 6


class Feistel:
    """A keyed permutation of 0 .. n-1. The network works on the smallest even number of bits that
    holds n; a value of n or more is encrypted again until it falls below n (cycle walking)."""

    def __init__(self, n: int, key: int):
        self.n = n
        self.half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
        self.mask = np.uint64((1 << self.half) - 1)
        rng = np.random.Generator(np.random.Philox(key))
        self.keys = rng.integers(0, 1 << 63, ROUNDS, dtype=np.uint64)

    def _round(self, x: np.ndarray, key: np.uint64) -> np.ndarray:
        h = (x + key) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (h ^ (h >> np.uint64(32))) & self.mask

    def _once(self, x: np.ndarray, back: bool) -> np.ndarray:
        half = np.uint64(self.half)
        left, right = x >> half, x & self.mask
        if back:
            for key in self.keys[::-1]:
                left, right = right ^ self._round(left, key), left
        else:
            for key in self.keys:
                left, right = right, left ^ self._round(right, key)
        return (left << half) | right

    def _walk(self, x: np.ndarray, back: bool) -> np.ndarray:
        x = self._once(np.asarray(x, np.int64).astype(np.uint64), back)
        while len(out := np.flatnonzero(x >= np.uint64(self.n))):
            x[out] = self._once(x[out], back)
        return x.astype(np.int64)

    def forward(self, x: np.ndarray) -> np.ndarray:
        return self._walk(x, False)

    def backward(self, x: np.ndarray) -> np.ndarray:
        return self._walk(x, True)


def numbered(df: DataFrame, order: Sequence[Column], out: str) -> DataFrame:
    """Global row numbers from 0 in ``order``: a range sort, the place in each partition, and the
    sizes of the partitions before it. Rows that tie in ``order`` may swap numbers, so an order
    that ends in all columns gives the same table each time. A tie is spread over partitions by
    the place where a row was read, so a value that many rows share fills no partition alone."""
    at, part, before = own_names(df, "_at", "_part", "_before")
    spread = df.withColumn(at, F.monotonically_increasing_id())
    rows = stored(
        spread.orderBy(*order, at)
        .withColumn(at, F.monotonically_increasing_id())
        .withColumn(part, F.shiftright(F.col(at), 33)),
        "numbered",
    )
    # one row per partition of the sort
    sizes = rows.groupBy(part).agg(F.count(F.lit(1)).alias(before))
    upto = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(part, F.coalesce(F.sum(before).over(upto), F.lit(0)).alias(before))
    place = F.col(at).bitwiseAND(F.lit((1 << 33) - 1))
    return rows.join(F.broadcast(offsets), part).withColumn(out, F.col(before) + place).drop(at, part, before)


def shuffled_shards(df: DataFrame, order: Sequence[Column], shards: int, key: int = 20_240_607) -> DataFrame:
    """``df`` with ``row`` (its global number in ``order``), ``shard`` and ``slot``.

    Row r goes to place p = Feistel(r): shard p mod ``shards``, slot p div ``shards``. Shards differ
    by one row at most, slots have no gap, and ``row_at`` gives the row of any shard and slot.
    Nulls order first; repeated rows take one place each; an empty table stays empty; columns
    called row, shard or slot are replaced.
    """
    rows = numbered(without(df, ("row", "shard", "slot")), order, "row")
    total = rows.count()

    @F.pandas_udf("long")
    def place(row: pd.Series) -> pd.Series:
        return pd.Series(Feistel(total, key).forward(row.to_numpy()))

    (at,) = own_names(rows, "_place")
    return (
        rows.withColumn(at, place("row"))
        .withColumn("shard", F.pmod(F.col(at), F.lit(shards)).cast("int"))
        .withColumn("slot", F.expr(f"`{at}` div {shards}"))
        .drop(at)
    )


def row_at(shard: np.ndarray, slot: np.ndarray, total: int, shards: int, key: int = 20_240_607) -> np.ndarray:
    """The global row number that lies in a slot of a shard."""
    return Feistel(total, key).backward(np.asarray(slot, np.int64) * shards + shard)
