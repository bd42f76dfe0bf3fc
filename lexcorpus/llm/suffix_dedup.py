"""Removal of long repeated strings: shared windows found by anchors, ordered by suffix arrays that
are built by the linear grouping construction."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lexcorpus.llm import texts as T
from lexcorpus.llm.batches import sliced
from lexcorpus.llm.grouping import whole_groups
from lexcorpus.llm.store import dropped, own_names, stored, without

LENGTH = 200
WINDOW = 150  # starts in which an anchor lies for sure
GRAM = 32  # bytes that rank a place as an anchor
CORE = LENGTH - WINDOW + 1  # bytes from an anchor on that every window around it shares
STEP = 8  # starts of a block
BUNDLE = 60_000
HOT = 4096
NUMBER = np.uint64(0xD6E8FEB86659FD93)


def suffix_array(text: list[int]) -> list[int]:
    """The order of all suffixes of ``text``, whose last symbol is its only smallest one.

    Suffixes begin in groups by their first symbol. The groups are taken in descending order; each
    suffix of a group points to its previous smaller one, the nearest to its left in a lower group.
    The suffixes pointed at leave their groups for new ones just above, by how many point at them,
    so a group ends up as the suffixes with one Lyndon prefix. Nothing is renamed or sorted again:
    an ascending sweep then puts, for each suffix found, the one before it and those that its
    pointers lead to in the first free places of their groups.
    """
    n = len(text)
    ranks = {c: k for k, c in enumerate(sorted(set(text)))}
    group = [ranks[c] for c in text]
    members: list[list[int]] = [[] for _ in ranks]
    for i, g in enumerate(group):
        members[g].append(i)
    size = [len(m) for m in members]
    below = [k - 1 for k in range(len(members))]
    above = [k + 1 for k in range(len(members))]
    above[-1] = -1
    left = list(range(n))  # itself while its group is still to come, else a place further left
    smaller = [-1] * n
    done, g = [], len(members) - 1
    while g >= 0:
        own = [i for i in members[g] if group[i] == g]
        members[g] = own
        done.append(g)
        for i in own:
            left[i] = i - 1
        pointed: dict[int, int] = {}
        for i in own:
            p = i - 1
            while p >= 0 and left[p] != p:
                p = left[p]
            j = i
            while j > p and left[j] != p:
                left[j], j = p, left[j]
            smaller[i] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        moved: dict[int, dict[int, list[int]]] = {}
        for p, times in pointed.items():
            moved.setdefault(group[p], {}).setdefault(times, []).append(p)
        for old, sets in moved.items():
            stay = size[old] - sum(map(len, sets.values()))
            at = old
            for k, times in enumerate(sorted(sets)):
                if k == 0 and stay == 0:
                    continue  # the lowest set keeps the group
                new = len(members)
                members.append(sets[times])
                size.append(len(sets[times]))
                size[old] -= len(sets[times])
                above.append(above[at])
                below.append(at)
                if above[at] >= 0:
                    below[above[at]] = new
                above[at] = new
                for p in sets[times]:
                    group[p] = new
                at = new
        g = below[g]
    free, at = [0] * len(members), 0
    for g in reversed(done):
        free[g] = at
        at += len(members[g])
    order, placed = [-1] * n, [False] * n
    order[0], placed[n - 1] = n - 1, True
    for i in range(n):
        s = order[i] - 1
        while s >= 0 and not placed[s]:
            order[free[group[s]]] = s
            free[group[s]] += 1
            placed[s] = True
            s = smaller[s]
    return order


def _key(doc_id: str, text: str) -> list:
    """Two numbers that tell rows apart by id and text; rows with both alike need the same cuts."""
    return [F.coalesce(F.expr(f"try_cast(`{doc_id}` as long)"), F.lit(0)).alias("k1"), F.xxhash64(F.col(doc_id), F.col(text)).alias("k2")]


def _segments(text: bytes) -> Iterator[tuple[int, bytes]]:
    """A long text in parts that share ``LENGTH`` - 1 bytes, so that no window is lost."""
    for at in range(0, max(1, len(text) - LENGTH + 1), T.GROUP_BYTES):
        yield at, text[at : at + T.GROUP_BYTES + LENGTH - 1]


class _Anchored:
    """The anchors of some texts: each start of a window belongs to the least-ranked place among
    the ``WINDOW`` starts from it on, so equal windows have their anchor at the same distance."""

    def __init__(self, texts: list[bytes]):
        data, starts, ends = T.joined(texts)
        n = len(data)
        self.hashes = T.RangeHashes(data)
        rank = T.mixed(self.hashes.of(np.arange(n - GRAM + 1), np.arange(GRAM, n + 1))) if n >= GRAM else np.zeros(0, np.uint64)
        low = np.uint64((1 << 24) - 1)
        rank = (rank & ~low) | np.arange(len(rank), dtype=np.uint64)
        width = 1
        while 2 * width <= WINDOW and len(rank) > width:
            rank = np.minimum(rank[:-width], rank[width:])
            width *= 2
        rest = WINDOW - width
        rank = np.minimum(rank[: len(rank) - rest], rank[rest:]) if len(rank) > rest else rank[:0]
        edge = np.zeros(n + 1, np.int8)
        long = ends - starts >= LENGTH
        edge[starts[long]] = 1
        edge[ends[long] - LENGTH + 1] = -1
        p = np.flatnonzero(np.cumsum(edge[:-1], dtype=np.int8))
        at = (rank[p] & low).astype(np.int64)
        new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (p[1:] != p[:-1] + 1)])) if len(p) else p
        self.first = p[new]  # starts of an anchor: count from first on
        self.count = np.diff(np.append(new, len(p)))
        self.anchor = at[new]
        self.text = np.searchsorted(starts, self.first, "right") - 1
        self.offset = starts

    def core(self) -> np.ndarray:
        return T.mixed(self.hashes.of(self.anchor, self.anchor + CORE))

    def whole(self) -> np.ndarray:
        h = self.hashes.of(self.first, self.first + self.count + LENGTH - 1)
        return T.mixed(h ^ ((self.anchor - self.first + 1).astype(np.uint64) * NUMBER) ^ (self.count.astype(np.uint64) << np.uint64(48)))


def anchors(rows: DataFrame) -> DataFrame:
    """(k1, k2, start, count, away, core, whole) for every anchor of (k1, k2, text): the starts
    that belong to it, how far away from the first it is, and hashes of what all windows of the
    anchor share and of all that they cover."""
    schema = "k1 long, k2 long, start int, count int, away int, core long, whole long"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            held, owner, shift, size = [], [], [], 0

            def flush():
                a = _Anchored(held)
                row = np.array(owner)[a.text]
                made = [
                    k1[row], k2[row], (a.first - a.offset[a.text] + np.array(shift)[a.text]).astype(np.int32),
                    a.count.astype(np.int32), (a.anchor - a.first).astype(np.int32), a.core().view(np.int64), a.whole().view(np.int64),
                ]
                names = ["k1", "k2", "start", "count", "away", "core", "whole"]
                return pa.RecordBatch.from_arrays([pa.array(m) for m in made], names=names)

            for i, text in enumerate(batch.column(2).to_pylist()):
                for at, part in _segments(T.encoded(text)):
                    held.append(part)
                    owner.append(i)
                    shift.append(at)
                    size += len(part)
                    if size >= T.GROUP_BYTES:
                        yield flush()
                        held, owner, shift, size = [], [], [], 0
            if held:
                yield flush()

    return rows.mapInArrow(work, schema)


def _blocks(wanted: DataFrame) -> DataFrame:
    """Blocks of ``STEP`` starts of the wanted anchors (k1, k2, text, [(start, count, away,
    times)]): (key, left, right, valid, times, k1, k2, at). The key is a hash of the bytes that all
    windows of the block share, and how far the anchor is; left and right are the bytes around
    them, and bit i of valid tells that start at + i belongs to the anchor."""
    schema = "key long, left long, right long, valid int, times int, k1 long, k2 long, at int"
    side, names = STEP - 1, [part.split()[0] for part in schema.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            texts, lists = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for i, (text, some) in enumerate(zip(texts, lists, strict=True)):
                text = T.encoded(text)
                info = np.array([(x["start"], x["count"], x["away"], x["times"]) for x in some], np.int64)
                info = info[np.argsort(info[:, 0], kind="stable")]
                for lo, part in _segments(text):
                    here = info[(info[:, 0] >= lo) & (info[:, 0] < lo + T.GROUP_BYTES)] if len(text) > T.GROUP_BYTES else info
                    if not len(here):
                        continue
                    data = np.zeros(len(part) + 4 * STEP, np.uint8)
                    data[2 * STEP : 2 * STEP + len(part)] = np.frombuffer(part, np.uint8)
                    start, count, away, times = (here[:, k] for k in range(4))
                    start = start - lo
                    near, far = away - count + 1, away  # distances of the starts from the anchor
                    first, last = near // STEP, far // STEP
                    n = last - first + 1
                    own = np.repeat(np.arange(len(here)), n)
                    block = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n) + first[own]
                    anchor = (start + away)[own]
                    shared = anchor - block * STEP  # shared bytes begin here
                    at = shared - side
                    i_lo = np.maximum(0, anchor - far[own] - at)
                    i_hi = np.minimum(side, anchor - near[own] - at)
                    valid = (1 << (i_hi + 1)) - (1 << i_lo)
                    hashes = T.RangeHashes(data)
                    begin = shared + 2 * STEP
                    key = T.mixed(hashes.of(begin, begin + LENGTH - side) ^ (block.astype(np.uint64) * NUMBER))
                    around = []
                    for frm, ok in ((at + 2 * STEP, lambda b, lo=i_lo: b >= lo), (begin + LENGTH - side, lambda b, hi=i_hi: b < hi)):
                        packed = np.zeros(len(own), np.int64)
                        for b in range(side):
                            packed |= np.where(ok(b), data[np.clip(frm + b, 0, len(data) - 1)].astype(np.int64), 0) << (8 * b)
                        around.append(packed)
                    made = [
                        key.view(np.int64), *around, valid.astype(np.int32), times[own].astype(np.int32),
                        np.full(len(own), k1[i]), np.full(len(own), k2[i]), (at + lo).astype(np.int32),
                    ]
                    yield pa.RecordBatch.from_arrays([pa.array(m) for m in made], names=names)

    return wanted.mapInArrow(work, schema)


def repeated_starts(keys: np.ndarray, left: np.ndarray, right: np.ndarray, valid: np.ndarray) -> np.ndarray:
    """For each string (bytes around a shared key, one symbol) the bits of its valid starts whose
    window, ``STEP`` symbols, is found at a valid start of another string too. The strings of all
    keys are put in a row, and the suffix array brings equal windows together."""
    side, n = STEP - 1, len(keys)
    wide = 2 * side + 2
    table = np.empty((n, wide), np.int64)
    for b in range(side):
        table[:, b] = ((left >> (8 * b)) & 255) + 2
        table[:, side + 1 + b] = ((right >> (8 * b)) & 255) + 2
    table[:, side] = np.unique(keys, return_inverse=True)[1] + 258
    table[:, -1] = 1
    text = np.append(table.ravel(), 0)
    order = np.array(suffix_array(text.tolist()), np.int64)
    string, start = order // wide, order % wide
    ok = (start < STEP) & (order < n * wide)
    string, start = string[ok], start[ok]
    ok = (valid[string] >> start) & 1 == 1
    string, start = string[ok], start[ok]
    same = np.ones(max(0, len(string) - 1), bool)
    for i in range(STEP):
        symbol = text[string * wide + start + i]
        same &= symbol[1:] == symbol[:-1]
    twice = np.concatenate([same, [False]]) | np.concatenate([[False], same]) if len(string) else np.zeros(0, bool)
    found = np.zeros(n, np.int64)
    np.bitwise_or.at(found, string[twice], 1 << start[twice])
    return found


def _resolved(strings: DataFrame) -> DataFrame:
    """Spans of the starts that the suffix array finds twice, for strings of which few share a key."""
    names = ["key", "left", "right", "valid", "times", "k1", "k2", "at"]
    dealt = strings.select(*names).repartition("key").sortWithinPartitions("key")

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, cuts in whole_groups(frames, ["key"]):
            most = BUNDLE // (2 * STEP)
            a = 0
            while a < len(cuts) - 1:
                b = max(a + 1, int(np.searchsorted(cuts, cuts[a] + most, "right")) - 1)
                part = frame.iloc[cuts[a] : cuts[b]]
                bits = repeated_starts(*[part[c].to_numpy(np.int64) for c in ("key", "left", "right", "valid")])
                some = (bits > 0) & (part["times"].to_numpy() == 1)
                part, bits = part[some], bits[some]
                first = np.log2(bits & -bits).astype(np.int64)
                last = np.floor(np.log2(bits)).astype(np.int64)
                at = part["at"].to_numpy(np.int64)
                yield pd.DataFrame({"k1": part["k1"], "k2": part["k2"], "start": at + first, "end": at + last + LENGTH})
                a = b

    return dealt.mapInPandas(work, SPANS)


SPANS = "k1 long, k2 long, start long, end long"


def repeats(rows: DataFrame, doc_id: str, text: str) -> list[DataFrame]:
    """Tables of spans (k1, k2, start, end) in bytes that together cover exactly the windows of
    ``LENGTH`` bytes that start at two places or more of all texts.

    1. Every window belongs to an anchor near its start. Anchors whose shared bytes occur once are
       done. If all anchors with the same shared bytes cover the same string, all their windows
       repeat. The shared bytes are only counted, with partial sums, so no group is gathered.
    2. The others are told by all that they cover: copies repeat, and one of each is kept.
    3. These are cut into blocks of ``STEP`` starts, which share more bytes. Blocks are counted
       like anchors; equal ones repeat, and blocks that share these bytes but differ beside them
       go, one string of each kind, through the suffix array, which tells start by start.
    4. Blocks with over ``HOT`` strings are told by each of their windows, again only counted.
    """
    spark = rows.sparkSession
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(cleanup, None)
    spark.conf.set(cleanup, "true")  # the steps follow each other and need much disk between them
    try:
        keyed = rows.select(*_key(doc_id, text), F.col(text).alias("text"))
        found = stored(anchors(keyed.where(F.octet_length("text") >= LENGTH)), "anchors")
        shared = found.groupBy("core").agg(
            F.count(F.lit(1)).alias("n"), F.min("whole").alias("low"), F.max("whole").alias("high")
        ).where("n > 1").select("core", (F.col("low") == F.col("high")).alias("same"))
        shared = stored(shared, "shared")  # a join of two tables, of which Spark splits large partitions
        again = stored(found.join(shared, "core"), "again")
        dropped(found, shared)
        end = F.col("start") + F.col("count") + (LENGTH - 1)
        span = [F.col("k1"), F.col("k2"), F.col("start").cast("long").alias("start"), end.cast("long").alias("end")]
        spans = [again.where("same").select(*span)]
        mixed = again.where("not same")
        kinds = stored(mixed.groupBy("core", "whole").agg(
            F.count(F.lit(1)).alias("times"), F.min(F.struct("k1", "k2", "start", "count", "away")).alias("one")
        ), "kinds")
        copies = kinds.where("times > 1").select("core", "whole")
        spans.append(stored(mixed.join(copies, ["core", "whole"]).select(*span), "spans"))
        few = F.least("times", F.lit(2)).cast("int")
        lists = kinds.select("one.*", few.alias("times")).groupBy("k1", "k2").agg(
            F.collect_list(F.struct("start", "count", "away", "times")).alias("some")
        )
        blocks = stored(_blocks(keyed.join(lists, ["k1", "k2"]).select("k1", "k2", "text", "some")), "blocks")
        kind = ["key", "left", "right", "valid"]
        strings = blocks.groupBy(*kind).agg(F.sum("times").alias("times"), F.min(F.struct("k1", "k2", "at")).alias("one"))
        strings = stored(strings.select(*kind, F.least("times", F.lit(2)).cast("int").alias("times"), "one.*"), "strings")
        lowest = F.expr("cast(log2(valid & -valid) as int)")
        highest = F.expr("cast(floor(log2(valid)) as int)")
        both = strings.where("times > 1").select(*kind)
        told = blocks.where("times = 1").join(both, kind).select(
            "k1", "k2", (F.col("at") + lowest).cast("long").alias("start"), (F.col("at") + highest + LENGTH).cast("long").alias("end")
        )
        spans.append(stored(told, "spans"))
        groups = strings.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("times").alias("least")).where("n > 1 and least = 1")
        groups = stored(groups, "groups")
        grouped = stored(strings.join(groups.select("key", "n"), "key"), "grouped")
        spans.append(stored(_resolved(grouped.where(F.col("n") <= HOT)), "spans"))
        spans.append(stored(_by_window(grouped.where(F.col("n") > HOT)), "spans"))
        dropped(kinds, blocks, strings, groups, grouped)
    finally:
        spark.conf.unset(cleanup) if before is None else spark.conf.set(cleanup, before)
    return spans


def _by_window(strings: DataFrame) -> DataFrame:
    """Spans of strings of large blocks: each valid start's window is its own key."""
    i = F.explode(F.sequence(F.lit(0), F.lit(STEP - 1))).alias("i")
    cut = strings.select("key", "left", "right", "valid", "times", "k1", "k2", "at", i).where(
        F.expr("shiftright(valid, i) & 1 = 1")
    )
    cut = cut.withColumn("left", F.expr("shiftrightunsigned(left, 8 * i)")).withColumn(
        "right", F.expr("case when i = 0 then 0L else shiftleft(right, 64 - 8 * i) end")
    )
    window = ["key", "i", "left", "right"]
    twice = cut.groupBy(*window).agg(F.count(F.lit(1)).alias("n"), F.max("times").alias("most")).where("n > 1 or most > 1")
    return cut.where("times = 1").join(twice.select(*window), window).select(
        "k1", "k2", (F.col("at") + F.col("i")).cast("long").alias("start"), (F.col("at") + F.col("i") + LENGTH).cast("long").alias("end")
    )


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the spans."""
    runs: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if runs and a <= runs[-1][1]:
            if b > runs[-1][1]:
                runs[-1] = (runs[-1][0], b)
        else:
            runs.append((a, b))
    return runs


def _cut(rows: DataFrame, doc_id: str, text: str, columns: str, make: Callable[[str | None, list[tuple[int, int]]], tuple]) -> DataFrame:
    """``rows`` without texts and with what ``make`` gives for a text and its runs to remove."""
    spans = None
    for part in repeats(rows, doc_id, text):
        spans = part if spans is None else spans.unionAll(part)
    k1, k2, own = own_names(rows, "_k1", "_k2", "_spans")
    some = F.collect_set(F.struct("start", "end"))  # rows that repeat give each span again
    lists = spans.groupBy(F.col("k1").alias(k1), F.col("k2").alias(k2)).agg(some.alias(own))
    a, b = _key(doc_id, text)
    joined = rows.withColumns({k1: a, k2: b}).join(lists, [k1, k2], "left").drop(k1, k2)
    at = joined.columns.index(text)
    kept = [i for i in range(len(joined.columns) - 1) if i != at]
    schema = StructType([*[joined.schema[i] for i in kept], *StructType.fromDDL(columns)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            out = []
            for t, some in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
                out.append(make(t, merged([(s["start"], s["end"]) for s in some or ()])))
            made = [pa.array(c) for c in zip(*out, strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in kept], *made], names=schema.names)

    return joined.mapInArrow(work, schema)


def _kept(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for a, b in runs:
        parts.append(text[at:a])
        at = b
    return b"".join([*parts, text[at:]])


def deduplicated(rows: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``rows`` without their texts and with ``n_bytes``, ``n_removed``, ``n_spans`` and
    ``kept_sha256``: what is left of a text when every byte is removed that a string of ``LENGTH``
    bytes covers which starts at another place of any text, the same included.

    Null texts are empty; texts shorter than the string keep all; copies of a text remove all of
    each other, and repeated rows count as copies. Ids may be null or repeated. An empty table
    stays empty. Columns called like the results are replaced.
    """
    rows = without(rows, {"n_bytes", "n_removed", "n_spans", "kept_sha256"} - {doc_id, text})

    def make(t: str | None, runs: list[tuple[int, int]]) -> tuple:
        data = T.encoded(t)
        kept = _kept(data, runs)
        return len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest()

    return _cut(rows, doc_id, text, "n_bytes long, n_removed long, n_spans long, kept_sha256 string", make)


def cleaned(rows: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``rows`` with their columns, the repeated strings cut out of the texts. A character that is
    covered in part stays. Null texts stay null."""
    (out,) = own_names(rows, "_kept")

    def make(t: str | None, runs: list[tuple[int, int]]) -> tuple:
        if t is None:
            return (None,)
        data = T.encoded(t)
        whole = []
        for a, b in runs:
            while a < b and data[a] & 0xC0 == 0x80:
                a += 1
            while b < len(data) and b > a and data[b] & 0xC0 == 0x80:
                b -= 1
            whole.append((a, b))
        return (_kept(data, whole).decode("utf-8", "surrogatepass"),)

    cut = _cut(rows, doc_id, text, f"`{out}` string", make)
    return cut.select([F.col(f"`{out}`").alias(c) if c == text else F.col(f"`{c}`") for c in rows.columns])
