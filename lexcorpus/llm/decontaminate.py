"""Benchmark decontamination by greedy string tiling."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lexcorpus.llm import texts as T
from lexcorpus.llm.batches import extended, sliced
from lexcorpus.llm.store import dropped, own_names, stored

MIN_MATCH = 4
COVERED = 0.6
#: Bits of the filter that tells documents' seeds from those no item has. Its size, 4 MB, is all
#: that is sent to the tasks, whatever the benchmark's.
FILTER_BITS = 25
#: Bits of one row of it.
ROW_BITS = 15
KR_BASE, KR_MOD = 1_000_003, (1 << 61) - 1

#: Bytes of words: ASCII letters and digits, and everything outside ASCII.
_WORD = np.zeros(256, bool)
for _span in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _WORD[slice(*_span)] = True


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in order, in lower case (A-Z), and how many words lie before each
    text (one number more than texts)."""
    data, _, ends = T.joined(texts)
    data = T.LOWER[data]
    starts, stops = T.runs(_WORD[data])
    hashes = T.mixed(T.RangeHashes(data).of(starts, stops) ^ (stops - starts).astype(np.uint64))
    return hashes, np.concatenate([[0], np.searchsorted(starts, ends)])


def seeds(hashes: np.ndarray, k: int = MIN_MATCH) -> np.ndarray:
    """A hash of every ``k`` consecutive words."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for i in range(k):
        h = (h ^ hashes[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    return h


def _rolling(tokens: list[int], free: list[bool], length: int) -> Iterator[tuple[int, int]]:
    """(start, running Karp-Rabin hash) of every run of ``length`` free tokens."""
    drop = pow(KR_BASE, length, KR_MOD)
    h = run = 0
    for i, (t, ok) in enumerate(zip(tokens, free, strict=True)):
        if not ok:
            h = run = 0
            continue
        h = (h * KR_BASE + t) % KR_MOD
        run += 1
        if run > length:
            h = (h - tokens[i - length] * drop) % KR_MOD
        if run >= length:
            yield i - length + 1, h


def tiles(text: list[int], item: list[int], least: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (place in the text, place in the item, length) of matches that don't
    overlap, longest first, down to ``least`` tokens. A search for one length hashes all free runs
    of that length; matches are prolonged, and the longest are marked first. A match over twice as
    long as what was sought starts the search again at its length. None is a barrier."""
    free_text, free_item = [t is not None for t in text], [True] * len(item)
    text = [0 if t is None else t for t in text]
    found, length = [], max(least, min(len(text), len(item)) // 2)
    while True:
        table = defaultdict(list)
        for at, h in _rolling(text, free_text, length):
            table[h].append(at)
        matches, longest = [], 0
        for j, h in _rolling(item, free_item, length):
            for i in table.get(h, ()):
                n = 0
                while i + n < len(text) and j + n < len(item) and free_text[i + n] and free_item[j + n] and text[i + n] == item[j + n]:
                    n += 1
                if n >= length:
                    matches.append((n, i, j))
                    longest = max(longest, n)
        if longest > 2 * length:
            length = longest
            continue
        for n, i, j in sorted(matches, key=lambda m: (-m[0], m[1], m[2])):
            if all(free_text[i : i + n]) and all(free_item[j : j + n]):
                free_text[i : i + n] = free_item[j : j + n] = [False] * n
                found.append((i, j, n))
        if matches and any(all(free_text[i : i + length]) and all(free_item[j : j + length]) for _, i, j in matches):
            continue
        if length == least:
            return found
        length = max(least, length // 2)


def item_table(benchmark: DataFrame, item_id: str, text: str, least: int) -> DataFrame:
    """(item_id, item, tokens, k, seeds) of items with a word: items of the same words share
    ``item``; ``k`` is ``least`` or, for shorter items, all their words."""

    def work(texts: list[str | None]) -> list:
        hashes, cuts = words([T.encoded(t) for t in texts])
        tokens = [hashes[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        sizes = np.clip([len(t) for t in tokens], 1, least).astype(np.int32)
        key = np.fromiter((xxhash.xxh64_intdigest(t.tobytes()) for t in tokens), np.uint64, len(tokens)).view(np.int64)
        found = [seeds(t, k).view(np.int64) for t, k in zip(tokens, sizes, strict=True)]
        return [key, [t.view(np.int64) for t in tokens], sizes, found]

    rows = benchmark.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    made = extended(rows, "text", "item long, tokens array<long>, k int, seeds array<long>", work)
    return stored(made.where(F.size("tokens") > 0), "items")


def seed_filter(places: DataFrame) -> np.ndarray:
    """A bit for the leading ``FILTER_BITS`` bits of each seed, as bytes. Spark makes it in rows of
    4 KB, so its size is fixed."""
    at = F.expr(f"shiftrightunsigned(seed, {64 - FILTER_BITS})")
    row, bit = F.shiftright(at, ROW_BITS).alias("row"), at.bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    known, size = np.zeros((1 << FILTER_BITS) // 8, np.uint8), (1 << ROW_BITS) // 8
    for r in places.groupBy(row).agg(F.bitmap_construct_agg(bit).alias("bits")).collect():
        known[r["row"] * size : (r["row"] + 1) * size] = np.frombuffer(r["bits"], np.uint8)
    return known


def seeds_in(texts: list[bytes], sizes: list[int], known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place in it, seed) of the seeds that the filter lets through, by text and place."""
    hashes, cuts = words(texts)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))]
    for k in sizes:
        h = seeds(hashes, k)
        bit = (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
        at = np.flatnonzero((known[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1)
        owner = np.searchsorted(cuts, at, "right") - 1
        inside = at + k <= cuts[1:][owner]
        at, owner = at[inside], owner[inside]
        found.append((owner, at - cuts[owner], h[at]))
    owner, place, seed = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((place, owner))
    return owner[order], place[order], seed[order]


def _tracks(docs: DataFrame, text: str, sizes: list[int], sent: Broadcast) -> DataFrame:
    """The rows of ``docs`` that hold a seed of an item, with ``starts`` and ``seeds`` in place of
    the text."""
    at = docs.columns.index(text)
    kept = [i for i in range(len(docs.columns)) if i != at]
    schema = StructType([*[docs.schema[i] for i in kept], *StructType.fromDDL("starts array<int>, seeds array<long>")])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            for first, group in T.groups(batch.column(at).to_pylist()):
                owner, place, seed = seeds_in(group, sizes, sent.value)
                if not len(owner):
                    continue
                rows, counts = np.unique(owner, return_counts=True)
                cuts = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
                lists = [place.astype(np.int32), seed.view(np.int64)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).take(pa.array(first + rows)) for i in kept]
                    + [pa.ListArray.from_arrays(cuts, pa.array(x)) for x in lists],
                    names=schema.names,
                )

    return docs.mapInArrow(work, schema)


def cover(starts: np.ndarray, spots: np.ndarray, tokens: np.ndarray, k: int, covered: float) -> tuple[float, int] | None:
    """(coverage, tiles) of an item in a text, if it is enough, from where the text (``starts``)
    has which seeds of the item (``spots``)."""
    need, own = covered * len(tokens), seeds(tokens, k)
    # a token is covered only by a tile, and each place of a tile but its last few is a seed
    held, seeded = np.flatnonzero(np.isin(own, own[np.unique(spots)])), np.zeros(len(tokens), bool)
    for i in range(k):
        seeded[held + i] = True
    if seeded.sum() < need:
        return None
    places, first = np.unique((starts[:, None] + np.arange(k)).ravel(), return_index=True)
    values = tokens[(spots[:, None] + np.arange(k)).ravel()[first]]
    text: list[int | None] = []
    for part in np.split(values, np.flatnonzero(np.diff(places) > 1) + 1):
        text += [None, *part.tolist()]
    found = tiles(text[1:], tokens.tolist(), k)
    size = sum(t[2] for t in found)
    return (size / len(tokens), len(found)) if size >= need else None


def _tiled(pairs: DataFrame, covered: float) -> DataFrame:
    """(k1, k2, item, coverage, tiles) of the pairs (k1, k2, item, k, tokens, found) that leak."""
    pairs = pairs.select("k1", "k2", "item", "k", "tokens", "found.start", "found.spot")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            at, shares, counts = [], [], []
            for i in range(batch.num_rows):
                tokens, starts, spots = (batch.column(c)[i].values.to_numpy() for c in (4, 5, 6))
                if got := cover(starts, spots, tokens.view(np.uint64), batch.column(3)[i].as_py(), covered):
                    at.append(i)
                    shares.append(got[0])
                    counts.append(got[1])
            if at:
                keys = [batch.column(c).take(pa.array(at)) for c in range(3)]
                made = [pa.array(shares, pa.float64()), pa.array(counts, pa.int64())]
                yield pa.RecordBatch.from_arrays([*keys, *made], names=["k1", "k2", "item", "coverage", "tiles"])

    return pairs.mapInArrow(work, "k1 long, k2 long, item long, coverage double, tiles long")


def sought_places(held: np.ndarray, k: int, words: int, covered: float) -> np.ndarray:
    """Which seed places of an item of ``words`` words must be sought: all but the most frequent
    ones (``held``) that together cover too few words for a leak."""
    inside, count = np.zeros(words, bool), 0
    sought = np.ones(len(held), bool)
    for place in np.argsort(-held, kind="stable"):
        new = k - int(inside[place : place + k].sum())
        if count + new < covered * words:
            inside[place : place + k] = True
            sought[place], count = False, count + new
    return sought


def _sought_seeds(places: DataFrame, held: DataFrame, covered: float) -> DataFrame:
    """(seed, item) of the places by which items are sought and that some text has."""
    place = F.struct("spot", "seed", F.coalesce("held", F.lit(0)).alias("held"))
    rows = places.join(held, "seed", "left").groupBy("item", "k", "n").agg(F.array_sort(F.collect_list(place)).alias("all"))
    rows = rows.select("item", "k", "n", "all.seed", "all.held")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found, owner = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for i in range(batch.num_rows):
                item, k, n = (batch.column(c)[i].as_py() for c in range(3))
                seed, count = (batch.column(c)[i].values.to_numpy() for c in (3, 4))
                found.append(np.unique(seed[sought_places(count, k, n, covered) & (count > 0)]))
                owner.append(np.full(len(found[-1]), item))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found)), pa.array(np.concatenate(owner))], names=["seed", "item"])

    return rows.mapInArrow(work, "seed long, item long")


def _covers(tracks: DataFrame, places: DataFrame, kinds: DataFrame, covered: float) -> DataFrame:
    """(k1, k2, item, coverage, tiles) of the distinct texts of ``tracks`` that leak an item.

    A text that has only seed places of an item that cover fewer words than a leak needs is none.
    So each item leaves out such a set of places, those whose seeds are most frequent in the texts,
    and is sought by the others. What many texts hold is sought only where an item has little else.
    """
    texts = stored(tracks.select("k1", "k2", "starts", "seeds").dropDuplicates(["k1", "k2"]), "texts")
    held = texts.select(F.explode("seeds").alias("seed")).groupBy("seed").agg(F.count(F.lit(1)).alias("held"))
    held = stored(held.join(places.select("seed").distinct(), "seed", "left_semi"), "held")
    sought = stored(_sought_seeds(places, held, covered), "sought")
    met = texts.select("k1", "k2", F.explode(F.array_distinct("seeds")).alias("seed")).join(sought, "seed")
    met = stored(met.select("k1", "k2", "item").distinct(), "met")
    first = stored(places.groupBy("item", "seed").agg(F.min("spot").alias("spot")), "first")
    wanted = stored(met.join(first, "item"), "wanted")
    some = texts.join(met.select("k1", "k2").distinct(), ["k1", "k2"], "left_semi")
    hits = some.select("k1", "k2", F.explode(F.arrays_zip("starts", "seeds")).alias("hit"))
    hits = stored(hits.select("k1", "k2", F.col("hit.starts").alias("start"), F.col("hit.seeds").alias("seed")), "hits")
    found = hits.join(wanted, ["k1", "k2", "seed"]).groupBy("k1", "k2", "item")
    found = stored(found.agg(F.collect_list(F.struct("start", "spot")).alias("found")), "found")
    covers = stored(_tiled(found.join(kinds, "item"), covered), "covers")
    dropped(texts, held, sought, met, first, wanted, hits, found)
    return covers


def _sought(docs: DataFrame, benchmark: DataFrame, text: str, item_id: str, item_text: str, least: int, covered: float) -> tuple:
    """Tables of the rows with seeds (with k1 and k2, which tell their texts apart), of the items
    and of what leaks. ``docs`` has k1 and k2."""
    items = item_table(benchmark, item_id, item_text, least)
    kinds = items.dropDuplicates(["item"]).select("item", "tokens", "k", "seeds")
    place = F.posexplode("seeds").alias("spot", "seed")
    places = stored(kinds.select("item", "k", F.size("tokens").alias("n"), place), "places")
    sizes = sorted(r["k"] for r in places.select("k").distinct().collect())  # from 1 to ``least``
    sent = docs.sparkSession.sparkContext.broadcast(seed_filter(places))
    tracks = stored(_tracks(docs, text, sizes, sent), "tracks")
    covers = _covers(tracks, places, kinds.drop("seeds"), covered)
    dropped(places)
    return tracks, items, covers


def _keys(text: str) -> list:
    """Two hashes that tell texts apart."""
    return [F.xxhash64(F.col(text)), F.xxhash64(F.lit(1), F.col(text))]


def leaks(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    least: int = MIN_MATCH, covered: float = COVERED,
) -> DataFrame:
    """(doc_id, item_id, coverage, tiles) for each document and benchmark item where tiles of at
    least ``least`` words cover the share ``covered`` of the item's words, in whatever order. Items
    of fewer words count where a document holds them whole, words side by side.

    Words are runs of letters and digits, A-Z in lower case. The documents are read once and stay
    where they are: a filter of fixed size picks their seeds that items may have, and only these
    are joined with the items' seeds. Texts and items that repeat are compared once. Seeds can
    cover more than tiles, so a pair whose seeds cover too little is done; the others are tiled.

    Null or empty texts, and items without a word, leak nothing. Rows or items that share an id are
    reported each; null ids stay null. A very long text is one row of hits, in the order of its
    words. Empty tables give no rows; other columns are left out, whatever their names.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    k1, k2 = _keys("text")
    rows = rows.withColumns({"k1": k1, "k2": k2})
    tracks, items, covers = _sought(rows, benchmark, "text", item_id, text, least, covered)
    pairs = tracks.select("doc_id", "k1", "k2").join(covers, ["k1", "k2"])
    return pairs.join(items.select("item_id", "item"), "item").select("doc_id", "item_id", "coverage", "tiles")


def clean(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
    least: int = MIN_MATCH, covered: float = COVERED,
) -> DataFrame:
    """The rows of ``docs`` without a leak, with all their columns, whatever their names.

    Null and empty texts stay, and so does everything if either table is empty. Very long texts are
    read whole. Rows with the same text go or stay together, whatever their ids. The texts that
    leak are told by two hashes; Spark sends these to the tasks while they are few, and only moves
    rows if they are too many for that.
    """
    k1, k2 = _keys("text")
    rows = docs.select(F.col(text).alias("text")).withColumns({"k1": k1, "k2": k2})
    tracks, items, covers = _sought(rows, benchmark, "text", item_id, "text", least, covered)
    leaking = stored(covers.select("k1", "k2").distinct(), "leaking")
    dropped(tracks, items, covers)
    a, b = own_names(docs, "_k1", "_k2")
    k1, k2 = _keys(text)
    leaking = leaking.select(F.col("k1").alias(a), F.col("k2").alias(b))
    return docs.withColumns({a: k1, b: k2}).join(leaking, [a, b], "left_anti").select(docs.columns)
