"""Near-duplicate vectors by cosine, found by p-stable hashing."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexcorpus.llm.components import components, forest
from lexcorpus.llm.grouping import whole_groups
from lexcorpus.llm.store import stored

BLOCK = 512
WIDTH = 2.0
MISSED = 0.002
LEAST_FUNCTIONS = 4


def collision(distance: float, width: float) -> float:
    """The chance that one quantised Gaussian projection agrees for two points that far apart."""
    if distance <= 0:
        return 1.0
    r = width / distance
    below = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * below - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def shape(n: int, cosine: float, missed: float = MISSED) -> tuple[int, int]:
    """Functions a table and tables. Enough functions that unrelated vectors (at right angles) of n
    meet in buckets of about ``BLOCK`` / 4; enough tables that a pair at the cosine meets nowhere
    with a chance of ``missed`` at most."""
    near = collision(math.sqrt(max(0.0, 2 - 2 * cosine)), WIDTH)
    far = collision(math.sqrt(2), WIDTH)
    k = max(LEAST_FUNCTIONS, math.ceil(math.log(max(n, 2) / (BLOCK / 4)) / -math.log(far)))
    return k, max(1, math.ceil(math.log(missed) / math.log(1 - near**k)))


class PStable:
    """``tables`` hash tables of ``k`` functions floor((a . v + b) / width)."""

    def __init__(self, dim: int, k: int, tables: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.k, self.tables = k, tables
        self.a = rng.standard_normal((dim, k * tables))
        self.b = rng.uniform(0, WIDTH, k * tables)
        self.odd = rng.integers(1, 1 << 62, (1, tables, k), dtype=np.uint64) | np.uint64(1)

    def keys(self, unit: np.ndarray) -> np.ndarray:
        """One 64-bit key for each vector and table."""
        cells = np.floor((unit @ self.a + self.b) / WIDTH).astype(np.int64).view(np.uint64)
        mixed = (cells.reshape(len(unit), self.tables, self.k) + np.uint64(0x9E3779B9)) * self.odd
        mixed ^= mixed >> np.uint64(31)
        keys = np.zeros((len(unit), self.tables), np.uint64)
        for i in range(self.k):
            keys = (keys ^ mixed[:, :, i]) * np.uint64(0xBF58476D1CE4E5B9)
            keys ^= keys >> np.uint64(29)
        return keys.view(np.int64)


def units(vectors: pd.Series) -> np.ndarray:
    rows = np.stack([np.asarray(v, np.float64) for v in vectors])
    # scaled first, so that squares of very large or small components stay in range
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", cosine: float = 0.9) -> DataFrame:
    """``vec_id`` of every row with ``n_links``, ``component_id`` and ``kept``.

    Equal vectors are one class, linked within itself by count. Classes are bucketed by p-stable
    hashes of their unit vectors in several tables and compared by exact cosine; the parameters
    follow from the number of classes (``shape``). A bucket of over ``BLOCK`` rows is compared block
    against block, each pair of blocks as a group of its own, so no task holds a bucket. A pair is
    counted in the first table it meets in; a group gives counts for its rows and a forest of its
    links, never its pairs. Vectors of different lengths are not compared. Null, empty, zero
    vectors and those with null or non-finite components link with nothing; n_links is 0 and the
    component their own id. Rows that share an id are vectors of their own. Null ids are never the
    smallest; a component without any id has a null one, and its rows are not kept. Other columns
    are left out.
    """
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = F.coalesce(finite & F.exists("v", lambda x: x != 0), F.lit(False))
    cleaned = F.when(sound, F.transform("v", lambda x: x + F.lit(0.0)))  # -0.0 is 0.0
    rows = stored(rows.select("vec_id", cleaned.alias("v")), "vectors")
    classes = stored(
        rows.where("v is not null").groupBy("v").agg(F.count(F.lit(1)).alias("size"), F.min("vec_id").alias("low"))
        .withColumn("class", F.monotonically_increasing_id()),
        "classes",
    )
    counts = {r["dim"]: r["n"] for r in classes.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n")).collect()}
    tallies = None
    for dim, n in sorted(counts.items()):
        found = _compared(classes.where(F.size("v") == dim), dim, *shape(n, cosine), cosine)
        tallies = found if tallies is None else tallies.unionAll(found)
    if tallies is None:
        return rows.select(
            "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast("long").alias("component_id"),
            F.col("vec_id").isNotNull().alias("kept"),
        )
    tallies = stored(tallies, "tallies")
    roots = components(tallies.where("root is not null"), "class", "root")
    near = tallies.groupBy("class").agg(F.sum("n").alias("n"))
    labelled = (
        classes.select("class", "v", "size", "low")
        .join(near, "class", "left")
        .join(roots.select(F.col("node").alias("class"), "root"), "class", "left")
        .withColumn("root", F.coalesce("root", "class"))
    )
    lows = labelled.groupBy("root").agg(F.min("low").alias("lowest"))
    labels = labelled.join(lows, "root").select("v", (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"), "lowest")
    joined = rows.where("v is not null").join(labels, "v").select("vec_id", "n_links", F.col("lowest").alias("component_id"))
    alone = rows.where("v is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.unionAll(alone).select(
        "vec_id", F.col("n_links").cast("long").alias("n_links"), F.col("component_id").cast("long").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )


def _compared(classes: DataFrame, dim: int, k: int, tables: int, cosine: float) -> DataFrame:
    """(class, n, root): how many rows of other classes were found linked in one group, and a
    smaller class that a path of the group's links leads to."""
    hashes = PStable(dim, k, tables)

    def filed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = np.arange(tables, dtype=np.int32)
        for frame in frames:
            for at in range(0, len(frame), 2000):
                part = frame.iloc[at : at + 2000]
                keys = hashes.keys(units(part["v"]))
                yield pd.DataFrame({"class": np.repeat(part["class"].to_numpy(), tables), "t": np.tile(table, len(part)), "key": keys.ravel()})

    buckets = stored(classes.select("class", "v").mapInPandas(filed, "class long, t int, key long"), "buckets")
    sizes = buckets.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    placed = (
        buckets.join(sizes, ["t", "key"])
        .withColumn("blocks", blocks).withColumn("mine", mine).withColumn("other", others)
        .select(
            "t", "key", F.least("mine", "other").alias("b1"), F.greatest("mine", "other").alias("b2"),
            (F.col("mine") < F.col("other")).alias("first"), "class",
        )
    )
    full = placed.join(classes.select("class", "v", "size"), "class")
    keys = ["t", "key", "b1", "b2"]
    dealt = full.repartition(*keys).sortWithinPartitions(*keys)

    def check(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, cuts in whole_groups(frames, keys):
            unit = units(frame["v"])
            signs = hashes.keys(unit)
            ids, sizes = frame["class"].to_numpy(), frame["size"].to_numpy()
            first = frame["first"].to_numpy(bool)
            table = frame["t"].to_numpy()
            same = frame["b1"].to_numpy() == frame["b2"].to_numpy()
            out = []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                rows = np.arange(a, b)
                if same[a]:
                    i, j = np.nonzero(np.triu(unit[a:b] @ unit[a:b].T >= cosine, 1))
                    left, right = rows[i], rows[j]
                else:
                    x, y = rows[first[a:b]], rows[~first[a:b]]
                    i, j = np.nonzero(unit[x] @ unit[y].T >= cosine)
                    left, right = x[i], y[j]
                t = table[a]
                if t and len(left):
                    new = np.ones(len(left), bool)
                    for e in range(t):
                        new &= signs[left, e] != signs[right, e]
                    left, right = left[new], right[new]
                if not len(left):
                    continue
                n = np.zeros(b - a, np.int64)
                np.add.at(n, left - a, sizes[right])
                np.add.at(n, right - a, sizes[left])
                some = np.flatnonzero(n)
                out.append(pd.DataFrame({"class": ids[a + some], "n": n[some], "root": pd.array([None] * len(some), "Int64")}))
                node, root = forest(ids[left], ids[right])
                out.append(pd.DataFrame({"class": node, "n": 0, "root": pd.array(root, "Int64")}))
            if out:
                yield pd.concat(out, ignore_index=True)

    return dealt.mapInPandas(check, "class long, n long, root long")
