"""SimHash near-duplicates, found by the generalised pigeonhole principle."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexcorpus.llm import texts as T
from lexcorpus.llm.batches import extended
from lexcorpus.llm.components import components, forest
from lexcorpus.llm.grouping import whole_groups
from lexcorpus.llm.store import own_names, stored, without

BITS = 64
BUCKET = 2048
SEED = 42
PIECE = 1_000_000


def _pieces(text: bytes, words: int) -> Iterator[bytes]:
    """The words of a text in lower case with single spaces, about ``PIECE`` bytes at a time; a
    piece repeats the last ``words`` - 1 words of the one before."""
    at, tail = 0, []
    while True:
        end = at + PIECE
        while end < len(text) and not T.SPACE[text[end]]:
            end += 1
        found = tail + text[at:end].lower().split()
        yield b" ".join(found)
        if end >= len(text):
            return
        at, tail = end, found[max(0, len(found) - words + 1) :]


def _counts(joined: bytes, words: int) -> tuple[np.ndarray, int]:
    """How often each bit is set in the hashes of the shingles, and how many shingles there are."""
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    if not joined or len(spaces) + 1 < words:
        return np.zeros(BITS, np.int64), 0
    starts = [0, *(spaces[: len(spaces) + 1 - words] + 1).tolist()]
    ends = [*spaces[words - 1 :].tolist(), len(joined)]
    h = xxhash.xxh64_intdigest
    hashes = np.fromiter((h(joined[i:j], SEED) for i, j in zip(starts, ends, strict=True)), np.uint64, len(starts))
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return bits.sum(axis=0, dtype=np.int64), len(starts)


def fingerprint(text: str | None, words: int = 3) -> int:
    """A bit is 1 if it is set in more than half of the XXH64 hashes of the shingles of ``words``
    words, repeats included. Fewer words: their whole sequence is the one shingle; none: zero."""
    total, n, piece = np.zeros(BITS, np.int64), 0, b""
    for piece in _pieces(T.encoded(text), words):
        counts, more = _counts(piece, words)
        total, n = total + counts, n + more
    if n == 0:
        return xxhash.xxh64_intdigest(piece, SEED) if piece else 0
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big")


def fingerprints(docs: DataFrame, out: str, text: str = "text", words: int = 3) -> DataFrame:
    """``docs`` without its texts and with the fingerprint of each, as a signed long, in ``out``."""

    def hashed(texts: list[str | None]) -> list[np.ndarray]:
        return [np.fromiter((fingerprint(t, words) for t in texts), np.uint64, len(texts)).view(np.int64)]

    return extended(docs, text, f"`{out}` long", hashed)


def _spread(bits: Iterable[int]) -> int:
    """A mask of bits, as a signed long."""
    mask = sum(1 << b for b in bits)
    return mask - (1 << 64) if mask >> 63 else mask


def bit_counts(prints: DataFrame) -> tuple[np.ndarray, int]:
    """How often each pair of bits is set together, over all fingerprints, and their number."""

    def together(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros((BITS, BITS)), 0
        for frame in frames:
            octets = frame["fp"].to_numpy().astype(">i8").view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(octets, axis=1)[:, ::-1].astype(np.float32)
            for k in range(0, len(bits), 100_000):  # exact in single precision
                total += bits[k : k + 100_000].T @ bits[k : k + 100_000]
            n += len(frame)
        i, j = np.indices(total.shape)
        yield pd.DataFrame({"i": [*i.ravel(), BITS], "j": [*j.ravel(), BITS], "n": [*total.ravel().astype(np.int64), n]})

    rows = prints.mapInPandas(together, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()
    table, n = np.zeros((BITS, BITS)), 0
    for r in rows:
        if r["i"] == BITS:
            n = r["n"]
        else:
            table[r["i"], r["j"]] = r["n"]
    return table, n


def correlated_groups(table: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """The bits in ``parts`` groups of even size, each grown by the free bit that correlates most
    with those it has."""
    p = np.diag(table) / max(n, 1)
    covariance = table / max(n, 1) - np.outer(p, p)
    scale = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    strength = np.abs(covariance / np.outer(scale, scale))
    free, found = set(range(BITS)), []
    for k in range(parts):
        size = BITS // parts + (k < BITS % parts)
        order = sorted(free)
        group = [max(order, key=lambda b: (strength[b, order].sum(), -b))]
        free.discard(group[0])
        while len(group) < size:
            order = sorted(free)
            best = max(order, key=lambda b: (strength[b, group].mean(), -b))
            group.append(best)
            free.discard(best)
        found.append(group)
    return found


def thresholds(costs: list[list[float]], budget: int) -> tuple[float, list[int]]:
    """The cheapest thresholds, one of -1, 0, 1, ... for each part, that sum up to ``budget``:
    dynamic programming over parts and budget. costs[i][t + 1] is the cost of t in part i."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for part in costs:
        after: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for t, more in enumerate(part, -1):
                option = (cost + more, [*chosen, t])
                if used + t not in after or option < after[used + t]:
                    after[used + t] = option
        best = after
    return best[budget]


def plan(prints: DataFrame, distance: int) -> list[tuple[list[int], int]]:
    """Groups of bits with their thresholds. For two to four parts of correlated bits the pairs of
    distinct fingerprints that agree on a part are counted over all of them; pairs within a radius
    are estimated from that and the bits' frequencies. A distance of d needs thresholds that sum
    up to d - parts + 1."""
    table, n = bit_counts(prints)
    if n < 2:
        return [(list(range(BITS)), distance)]
    options = {m: correlated_groups(table, n, m) for m in range(2, distance + 3)}
    masks = F.array(*[F.lit(_spread(g)).cast("long") for gs in options.values() for g in gs])
    values = prints.select("fp", F.posexplode(masks).alias("part", "mask")).select(
        "part", F.col("fp").bitwiseAND(F.col("mask")).alias("value")
    )
    same = values.groupBy("part", "value").count().groupBy("part").agg(F.sum(F.expr("double(count) * (count - 1) / 2")).alias("pairs"))
    pairs = {r["part"]: r["pairs"] for r in same.collect()}
    p = np.diag(table) / n
    agree = p * p + (1 - p) * (1 - p)
    odds = (1 - agree) / np.maximum(agree, 1e-9)
    best, k = None, 0
    for m, parts in options.items():
        costs = []
        for group in parts:
            exact, odd = pairs.get(k, 0.0), odds[group]
            k += 1
            near, probes = [0.0, 1.0], [0, 1]
            one = odd.sum()
            near.append(1 + one)
            probes.append(1 + len(group))
            near.append(1 + one + (one * one - (odd * odd).sum()) / 2)
            probes.append(1 + len(group) + len(group) * (len(group) - 1) // 2)
            costs.append([exact * a + n * b for a, b in zip(near[: distance + 2], probes[: distance + 2], strict=True)])
        cost, chosen = thresholds(costs, distance - m + 1)
        if best is None or cost < best[0]:
            best = (cost, list(zip(parts, chosen, strict=True)))
    return [(group, t) for group, t in best[1] if t >= 0]


def _variants(fp: Column, group: list[int], radius: int) -> Column:
    """``fp`` with up to ``radius`` bits of the group flipped."""
    flips = [_spread(c) for r in range(radius + 1) for c in combinations(group, r)]
    return F.transform(F.array(*[F.lit(x).cast("long") for x in flips]), lambda x: fp.bitwiseXOR(x))


def linked(prints: DataFrame, distance: int = 2) -> DataFrame:
    """Links (a, b) that join all distinct fingerprints ``fp`` within ``distance`` bits into their
    components: for every pair within the distance a path, and no pair beyond it.

    Every fingerprint is filed under its bits of each part and probes the values within the part's
    threshold. A bucket of over ``BUCKET`` rows is filed again under parts of the remaining bits,
    as often as needed: a pair in it agrees on one of them. A bucket whose fixed bits are all but r
    has 2**r rows at most, so this ends, and no task compares a large bucket with itself. Verified
    pairs of a bucket are given as a forest, so a dense bucket gives no more links than rows.
    """
    parts = plan(prints, distance)
    rows = None
    for group, radius in parts:
        mask = _spread(group)
        filed = prints.select(
            F.lit(mask).cast("long").alias("mask"), F.col("fp").bitwiseAND(F.lit(mask)).alias("value"),
            F.lit(True).alias("filed"), F.lit(radius == 0).alias("probe"), "fp",
        )
        rows = filed if rows is None else rows.unionAll(filed)
        if radius:
            probes = prints.select("fp", F.explode(_variants(F.col("fp"), group, radius)).alias("v"))
            rows = rows.unionAll(probes.select(
                F.lit(mask).cast("long"), F.col("v").bitwiseAND(F.lit(mask)), F.lit(False), F.lit(True), "fp"
            ))
    links = None
    rows, step = stored(rows, "filed"), 0
    while rows is not None:
        sizes = rows.groupBy("mask", "value").agg(
            F.count(F.lit(1)).alias("n"), F.max("filed").alias("some_filed"), F.max("probe").alias("some_probe")
        ).where("n > 1 and some_filed and some_probe")
        sizes = stored(sizes.select("mask", "value", "n"), "sizes")
        small = rows.join(sizes.where(F.col("n") <= BUCKET), ["mask", "value"])
        found = _verified(small, distance)
        links = found if links is None else links.unionAll(found)
        if sizes.where(F.col("n") > BUCKET).isEmpty():
            break
        masks = [r["mask"] for r in sizes.where(F.col("n") > BUCKET).select("mask").distinct().collect()]
        large = rows.join(sizes.where(F.col("n") > BUCKET).drop("n"), ["mask", "value"])
        rows = stored(_refiled(large, masks, distance, step), "filed")
        step += 1
    return links


def _refiled(large: DataFrame, masks: list[int], distance: int, step: int) -> DataFrame:
    """Rows of large buckets under each of ``distance`` + 1 parts of the bits not fixed yet. There
    are as many masks as parts of parts, not as many as rows. A probe's fixed bits stay those of
    the bucket, so the value goes on from there."""
    table = []
    for mask in masks:
        free = [b for b in range(BITS) if not mask >> b & 1]
        free = free[step % 2 :: 2] + free[1 - step % 2 :: 2]
        for k in range(distance + 1):
            table.append((mask, _spread(free[k :: distance + 1])))
    more = large.sparkSession.createDataFrame(table, "mask long, more long")
    return large.join(F.broadcast(more), "mask").select(
        F.col("mask").bitwiseOR(F.col("more")).alias("mask"),
        F.col("value").bitwiseOR(F.col("fp").bitwiseAND(F.col("more"))).alias("value"),
        "filed", "probe", "fp",
    )


def _verified(rows: DataFrame, distance: int) -> DataFrame:
    """A forest of the pairs (filed, probe) of each bucket within ``distance`` bits."""

    def check(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, cuts in whole_groups(frames, ["mask", "value"]):
            fp = frame["fp"].to_numpy().view(np.uint64)
            filed, probe = frame["filed"].to_numpy(bool), frame["probe"].to_numpy(bool)
            left, right = [], []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                x, y = fp[a:b][filed[a:b]], fp[a:b][probe[a:b]]
                i, j = np.nonzero(np.bitwise_count(x[:, None] ^ y[None, :]) <= distance)
                node, root = forest(x[i].view(np.int64), y[j].view(np.int64))
                left.append(node)
                right.append(root)
            if left:
                yield pd.DataFrame({"a": np.concatenate(left), "b": np.concatenate(right)})

    dealt = rows.select("mask", "value", "filed", "probe", "fp").repartition("mask", "value").sortWithinPartitions("mask", "value")
    return dealt.mapInPandas(check, "a long, b long")


def _grouped(docs: DataFrame, doc_id: str, text: str, words: int, distance: int, fp: str, root: str, low: str) -> DataFrame:
    """``docs`` without its texts and with fingerprint, group and smallest id of the group."""
    hashed = stored(fingerprints(docs, fp, text, words), "fingerprints")
    prints = stored(hashed.groupBy(F.col(fp).alias("fp")).agg(F.min(doc_id).alias("low")), "prints")
    roots = components(linked(prints.select("fp"), distance), "a", "b")
    grouped = prints.join(roots, prints["fp"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "low"
    )
    lows = grouped.groupBy("root").agg(F.min("low").alias("low"))
    labels = grouped.drop("low").join(lows, "root").select(F.col("fp").alias(fp), F.col("root").alias(root), F.col("low").alias(low))
    return hashed.join(labels, fp)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, distance: int = 2) -> DataFrame:
    """``docs`` without its texts, with ``fingerprint`` (16 hexadecimal digits) and
    ``component_id``: the smallest id that a chain of fingerprints, each within ``distance`` bits
    of the next, leads to.

    Links are sought between distinct fingerprints, so copies cost one row. Null and empty texts
    have fingerprint zero and are linked like any other; null ids are never the smallest, and a
    group without any id has a null one. Repeated rows stay; an empty table stays empty. Texts of
    any length are hashed a piece at a time. Columns called like the results are replaced.
    """
    docs = without(docs, {"fingerprint", "component_id"} - {doc_id, text})
    fp, root, low = own_names(docs, "_fp", "_root", "_low")
    return (
        _grouped(docs, doc_id, text, words, distance, fp, root, low)
        .withColumn("fingerprint", F.lpad(F.lower(F.hex(fp)), 16, "0"))
        .withColumn("component_id", F.col(low))
        .drop(fp, root, low)
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, distance: int = 2) -> DataFrame:
    """One row of each group of near duplicates, with all columns of ``docs``: the one with the
    smallest id; of several with that id, or without ids, the one whose columns hash lowest. Rows
    that are alike in all columns count once. Texts are read twice and shuffled once, by keys of
    which each stands for few rows."""
    fp, root, low, own, at = own_names(docs, "_fp", "_root", "_low", "_hash", "_at")
    key = keyed(docs, doc_id, at, own)
    rows = _grouped(key.select(doc_id, text, own, at), doc_id, text, words, distance, fp, root, low)
    return best_rows(docs, key, rows, doc_id, root, at, own)


def keyed(docs: DataFrame, doc_id: str, at: str, own: str) -> DataFrame:
    """``docs`` with the id as a number in ``at`` and a hash of all columns in ``own``."""
    return docs.withColumn(own, F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])).withColumn(
        at, F.coalesce(F.expr(f"try_cast(`{doc_id}` as long)"), F.lit(0))
    )


def best_rows(docs: DataFrame, key: DataFrame, rows: DataFrame, doc_id: str, root: str, at: str, own: str) -> DataFrame:
    """One row of ``docs`` for each ``root`` in ``rows``; ``key`` is ``docs`` with ``at`` and ``own``."""
    order = F.struct(F.col(doc_id).isNull(), F.col(at), F.col(own))
    best = rows.groupBy(root).agg(F.min(F.struct(order.alias("o"), F.col(at), F.col(own))).alias("b")).select(f"b.{at}", f"b.{own}")
    best = stored(best, "kept")
    kept = key.join(best, [at, own], "left_semi")
    repeated = rows.join(best, [at, own], "left_semi").groupBy(at, own).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not repeated.isEmpty():
        kept = kept.dropDuplicates([at, own])
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
