"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexcorpus.llm.store import dropped, stored


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node reachable) of the links a-b, nodes that are their own root left out."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = place[: len(a)], place[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    other = root != np.arange(len(nodes))
    return nodes[other], nodes[root[other]]


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node with a link; root is the smallest node of its component.

    Each batch of links first shrinks to a forest of its own. Then every round joins all larger
    neighbours of a node to its smallest one, and all smaller neighbours likewise, until nothing
    changes; a round is written to the shared folder. Groups are aggregated before they are
    shuffled and joined by their smallest neighbour, so no neighbourhood is ever held by a task.
    No links, no rows. Links from a node to itself are ignored.
    """

    def shrunk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            node, root = forest(frame["a"].to_numpy(), frame["b"].to_numpy())
            yield pd.DataFrame({"a": node, "b": root})

    pairs = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    edges = stored(pairs.mapInPandas(shrunk, "a long, b long").distinct(), "edges")  # a > b
    state = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now[0] == 0 or now == state:
            break
        state = now
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        new = stored(small.unionAll(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        dropped(edges)
        edges = new
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
