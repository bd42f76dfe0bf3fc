"""The trie of all prefixes of conversations: range minima over the sorted common prefixes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lexcorpus.llm.grouping import whole_groups
from lexcorpus.llm.sharding import numbered
from lexcorpus.llm.store import dropped, stored

WORD = r"[^\x20\x09-\x0D]+"
MARK = 16  # bytes of a turn's mark
FIRST = 32  # turns that are compared at first
BLOCK = 512  # sorted sequences of a block, at least
BLOCKS = 65_536  # blocks at most; their summary is all that is sent to every task
CHAIN = 1024  # nodes of an unbranched stretch that one row makes
CHUNK = 65_536  # bytes of member ids in one row


class Minima:
    """A sparse table: least values of all stretches whose length is a power of two."""

    def __init__(self, values: np.ndarray):
        self.levels = [np.asarray(values, np.int64)]
        while (1 << len(self.levels)) <= len(values):
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The least value of low .. high, both included."""
        size = high - low + 1
        level, out = np.frexp(size)[1] - 1, np.empty(len(low), np.int64)
        for k in np.unique(level):
            of, row = np.flatnonzero(level == k), self.levels[k]
            out[of] = np.minimum(row[low[of]], row[high[of] - (1 << int(k)) + 1])
        return out

    def right(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """By binary search the last place r for which all of at+1 .. r are ``depth`` or more."""
        end, n = at.astype(np.int64), len(self.levels[0])
        for k in range(len(self.levels) - 1, -1, -1):
            row, step = self.levels[k], 1 << k
            far = end + step < n
            far &= row[np.minimum(end + 1, len(row) - 1)] >= depth
            end = end + step * far
        return end

    def left(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """By binary search the first place l for which all of l+1 .. at are ``depth`` or more."""
        start = at.astype(np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            row, step = self.levels[k], 1 << k
            far = start - step >= 0
            far &= row[np.clip(start - step + 1, 0, len(row) - 1)] >= depth
            start = start - step * far
        return start


def turns_of(conversations: DataFrame) -> DataFrame:
    """The turns of conversations as ``conv_id``, ``place`` (from 0, in the order of turn, null
    first, then role, the first 64 characters of the text and its hash), ``mark`` (128 bits of role
    and text) and ``words``.

    Null roles and texts are empty; rows without a conversation are left out; repeated rows are
    turns of their own. Only marks are sorted, never texts. The sort is by range over whole rows, so
    a conversation with most turns is spread over tasks. An empty table stays empty; other columns
    are left out, whatever their names.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), F.substring(text, 1, 64).alias("head"),
        F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))).alias("mark"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("head"), F.col("mark")]
    placed = numbered(rows, order, "no").select("conv_id", "no", "mark", "words")
    starts = stored(placed.groupBy("conv_id").agg(F.min("no").alias("start")), "trie-starts")
    return placed.join(starts, "conv_id").select("conv_id", (F.col("no") - F.col("start")).alias("place"), "mark", "words")


def _fingerprint() -> list:
    """Two exclusive ors over the turns of a sequence: they need no order and add up in parts."""
    return [
        F.bit_xor(F.xxhash64("depth", "mark")).alias("f1"),
        F.bit_xor(F.xxhash64("mark", "depth", F.lit(7))).alias("f2"),
    ]


def _depths_to_sort(turns: DataFrame, classes: DataFrame, first: int) -> DataFrame:
    """``rep`` and ``upto`` of each distinct sequence: the turns that tell it from all others. Only
    those that share all turns up to some depth with another are looked at further, four times as
    deep; so a long sequence that is alone is never held whole."""
    longest = classes.agg(F.max("n")).first()[0] or 0
    limits, upto, tied = classes.select("rep", F.lit(first).cast("long").alias("upto")), first, classes.select("rep", "n")
    while upto < longest:
        deep = tied.where(F.col("n") >= upto).select(F.col("rep").alias("conv_id"), "n")
        marks = stored(
            turns.where(F.col("depth") <= upto).join(deep, "conv_id").groupBy("conv_id", "n").agg(*_fingerprint()), "trie-marks"
        )
        same = marks.groupBy("f1", "f2").count().where("count > 1").select("f1", "f2")
        more = marks.where(F.col("n") > upto).join(same, ["f1", "f2"], "left_semi").select(F.col("conv_id").alias("rep"), "n")
        tied = stored(more, "trie-tied")
        dropped(marks)
        if tied.isEmpty():
            break
        upto *= 4
        limits = limits.unionByName(tied.select("rep", F.lit(upto).cast("long").alias("upto")))
    return limits.groupBy("rep").agg(F.max("upto").alias("upto"))


def neighbours(keys: list[bytes]) -> np.ndarray:
    """Common turns of each key and the next."""
    flat = np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)
    sizes = np.fromiter(map(len, keys), np.int64, len(keys)) // MARK
    starts = np.cumsum(sizes) - sizes
    most = np.minimum(sizes[:-1], sizes[1:])
    common = np.zeros(len(most), np.int64)
    active = np.flatnonzero(most > 0)
    while len(active):
        at = common[active]
        active = active[(flat[starts[active] + at] == flat[starts[active + 1] + at]).all(axis=1)]
        common[active] += 1
        active = active[common[active] < most[active]]
    return common


def _in_blocks(rows: DataFrame, *order: str) -> DataFrame:
    return rows.repartition("block").sortWithinPartitions("block", *order)


def _prefixes(classes: DataFrame, size: int) -> DataFrame:
    """Each sequence in order with ``lcp`` and ``next``, the turns it shares with the one before and
    after (-1 where there is none). A block gets the last row before it and the first one after it."""
    block = F.expr(f"pos div {size}")
    near = F.array(
        block,
        F.when(F.col("pos") % size == 0, block - 1),
        F.when(F.col("pos") % size == size - 1, block + 1),
    )
    rows = classes.withColumn("block", F.explode(F.filter(near, lambda b: b.isNotNull() & (b >= 0))))

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, cuts in whole_groups(frames, ["block"]):
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                part = frame.iloc[a:b]
                common = neighbours(part["key"].tolist())
                part = part.assign(lcp=np.append(-1, common), next=np.append(common, -1)).drop(columns="key")
                yield part[part["pos"] // size == part["block"]]

    kinds = "block long, pos long, rep long, n long, convs long, lcp long, next long"
    return _in_blocks(rows.select("block", "pos", "rep", "n", "convs", "key"), "pos").mapInPandas(work, kinds)


class _Blocks:
    """What every task knows of all blocks: least common prefix, conversations, leaves, least id."""

    def __init__(self, table: pd.DataFrame):
        self.lcp, self.rep = Minima(table["lcp"].to_numpy()), Minima(table["rep"].to_numpy())
        self.convs = np.append(0, table["convs"].to_numpy().cumsum())
        self.leaves = np.append(0, table["leaves"].to_numpy().cumsum())
        self.n = len(table)

    def between(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Conversations, leaves and least id of the blocks first .. last, which may be none."""
        some = np.flatnonzero(last >= first)
        low = np.full(len(first), np.iinfo(np.int64).max)
        low[some] = self.rep.least(first[some], last[some])
        last = np.maximum(last, first - 1)
        return self.convs[last + 1] - self.convs[first], self.leaves[last + 1] - self.leaves[first], low


_PART = "{0}right long, {0}after long, {0}convs long, {0}leaves long, {0}low long"
_EXTENTS = f"block long, pos long, lcp long, n long, rep long, a_left long, {_PART.format('a_')}, {_PART.format('b_')}"


def _extents(rows: DataFrame, last_block: int) -> DataFrame:
    """For each sequence two candidate prefixes: a_, what it shares with the one before, and b_, all
    of it. Each binary-searches its left and right extent over the range minima of its block; null
    is an extent that goes on beyond the block. Sums are those of the part inside."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, cuts in whole_groups(frames, ["block"]):
            for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                part = frame.iloc[x:y]
                block, pos, lcp, n, convs, rep, after = (
                    part[c].to_numpy() for c in ("block", "pos", "lcp", "n", "convs", "rep", "next")
                )
                m, at = len(part), np.arange(len(part))
                minima, low = Minima(lcp), Minima(rep)
                convs_to = np.append(0, convs.cumsum())
                leaves_to = np.append(0, (after < n).cumsum())
                left = minima.left(at, lcp)
                left_open = (left == 0) & (lcp[0] >= lcp) & (block > 0)
                out = {"block": block, "pos": pos, "lcp": lcp, "n": n, "rep": rep}
                out["a_left"] = pd.array(pos[left], "Int64")
                out["a_left"][left_open] = pd.NA
                for name, depth, start in (("a_", lcp, left), ("b_", n, at)):
                    right = minima.right(at, depth)
                    right_open = (right == m - 1) & (block[0] < last_block) & (after[-1] >= depth)
                    for what, values in (
                        ("right", pos[right]), ("after", after[right]),
                        ("convs", convs_to[right + 1] - convs_to[start]),
                        ("leaves", leaves_to[right + 1] - leaves_to[start]), ("low", low.least(start, right)),
                    ):
                        out[name + what] = values
                    out[name + "right"] = pd.array(out[name + "right"], "Int64")
                    out[name + "right"][right_open] = pd.NA
                yield pd.DataFrame(out)

    return _in_blocks(rows, "pos").mapInPandas(work, _EXTENTS)


_EDGE = "source long, side int, d long, block long, end long, after long, convs long, leaves long, low long"


def _edges(needs: DataFrame, rows: DataFrame, blocks) -> DataFrame:
    """Where extents end that leave their block: for each block, side (0 left, 1 right) and depth the
    place, with the sums from the block's edge to there. The blocks that lie between are found by a
    search over the blocks' minima, the place inside the last one by a search over its own."""

    def aim(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = blocks.value
        for frame in frames:
            source, side, d = (frame[c].to_numpy() for c in ("block", "side", "d"))
            left = known.lcp.left(np.maximum(source - 1, 0), d)
            right = known.lcp.right(source, d) + 1
            target = np.where(side == 0, left, right)
            convs, leaves, low = known.between(np.where(side == 0, left + 1, source + 1), np.where(side == 0, source, right) - 1)
            # past the last block: the end is the end of the table
            yield pd.DataFrame(
                {"source": source, "side": side, "d": d, "block": target, "end": -1, "after": -1, "convs": convs, "leaves": leaves, "low": low}
            )

    aimed = needs.mapInPandas(aim, _EDGE).withColumn("kind", F.lit(0))
    names = [c.split()[0] for c in _EDGE.split(", ")]
    held = rows.select(
        F.lit(-1).cast("long").alias("source"), F.lit(-1).alias("side"), F.col("n").alias("d"), "block", F.col("pos").alias("end"),
        F.col("lcp").alias("after"), "convs", (F.col("next") < F.col("n")).cast("long").alias("leaves"),
        F.col("rep").alias("low"), F.lit(1).alias("kind"),
    )
    touched = aimed.select("block").distinct()
    both = aimed.unionByName(held.join(touched, "block", "left_semi"))

    def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, cuts in whole_groups(frames, ["block"]):
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                part = frame.iloc[a:b]
                own, asked = part[part["kind"] == 1], part[part["kind"] == 0].copy()
                if len(own):
                    lcp, place = own["after"].to_numpy(), own["end"].to_numpy()
                    convs, leaves = (np.append(0, own[c].to_numpy().cumsum()) for c in ("convs", "leaves"))
                    low, m = own["low"].to_numpy(), len(own)
                    d, on_left = asked["d"].to_numpy(), asked["side"].to_numpy() == 0
                    first = np.searchsorted(-np.minimum.accumulate(lcp), -d, "right")
                    first = np.minimum(first, m - 1)
                    last = np.maximum(m - 1 - np.searchsorted(-np.minimum.accumulate(lcp[::-1]), -d, "right"), 0)
                    before = np.append(np.iinfo(np.int64).max, np.minimum.accumulate(low))
                    behind = np.minimum.accumulate(low[::-1])[::-1]
                    asked["end"] = np.where(on_left, place[last], place[first] - 1)
                    asked["after"] = np.where(on_left, -1, lcp[first])
                    asked["convs"] += np.where(on_left, convs[-1] - convs[last], convs[first])
                    asked["leaves"] += np.where(on_left, leaves[-1] - leaves[last], leaves[first])
                    asked["low"] = np.minimum(asked["low"], np.where(on_left, behind[last], before[first]))
                yield asked[names]

    return _in_blocks(both, "kind", "end", "side", "d").mapInPandas(find, _EDGE)


def _running(rows: DataFrame, order: list[str], amount: str, out: str) -> DataFrame:
    """``rows`` with the sum of ``amount`` over all rows before each in ``order`` as ``out``: a range
    sort, running sums inside its partitions, and the sums of the partitions before."""
    schema = StructType([*rows.schema, *StructType.fromDDL(f"{out} long, part int")])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, part = 0, TaskContext.get().partitionId()
        for batch in batches:
            values = batch.column(batch.schema.get_field_index(amount)).to_numpy(zero_copy_only=False)
            upto = total + np.cumsum(values)
            if len(values):
                total = int(upto[-1])
            made = [pa.array(upto - values), pa.array(np.full(len(values), part, np.int32))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=schema.names)

    summed = stored(rows.orderBy(*order).mapInArrow(work, schema), "trie-running")
    sums = summed.groupBy("part").agg(F.sum(amount).alias("sum"))  # one row per partition of the sort
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("part", F.coalesce(F.sum("sum").over(upto), F.lit(0)).alias("base"))
    return summed.join(F.broadcast(offsets), "part").withColumn(out, F.col(out) + F.col("base")).drop("part", "base")


def _digests(members: DataFrame) -> DataFrame:
    """``rep`` and ``ends``: the SHA-256 of each sequence's conversations, in numeric order, joined
    by commas. Tasks of a range sort join stretches of ids; the hash, which must see them in order,
    then reads one row for some ten thousand conversations and holds one row at a time."""
    key = ["n", "f1", "f2"]

    def join(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, piece = TaskContext.get().partitionId(), 0
        for frame in frames:
            columns = [frame[c].to_numpy() for c in key]
            new = np.ones(len(frame), bool)
            new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
            ids = frame["conv_id"].astype(str).tolist()
            sizes = np.fromiter(map(len, ids), np.int64, len(ids)) + 1
            # a stretch ends with its group, or as soon as it is long
            before = np.cumsum(sizes) - sizes
            within = (before - np.maximum.accumulate(np.where(new, before, 0))) // CHUNK
            new[1:] |= within[1:] != within[:-1]
            at = np.append(np.flatnonzero(new), len(frame))
            lists = [",".join(ids[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
            out = frame.iloc[at[:-1]].assign(part=part, piece=piece + np.arange(len(lists)), ids=lists)
            piece += len(lists)
            yield out

    kinds = "n long, f1 long, f2 long, conv_id long, part int, piece long, ids string"
    rows = members.select(*key, "conv_id").orderBy(*key, "conv_id").mapInPandas(join, kinds)

    def digest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = rep = state = None
        for frame in frames:
            done = []
            for *group, conv, ids in frame[[*key, "conv_id", "ids"]].itertuples(index=False):
                if group != last:
                    if last is not None:
                        done.append((rep, state.hexdigest()))
                    last, rep, state = group, conv, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pd.DataFrame(done, columns=["rep", "ends"]).astype({"rep": "int64", "ends": "object"})
        if last is not None:
            yield pd.DataFrame([(rep, state.hexdigest())], columns=["rep", "ends"])

    dealt = stored(rows, "trie-members").repartition(*key).sortWithinPartitions(*key, "part", "piece")
    return stored(dealt.mapInPandas(digest, "rep long, ends string"), "trie-ends")


NOTHING = hashlib.sha256(b"").hexdigest()


def nodes(turns: DataFrame, convs: DataFrame, first: int = FIRST, block: int = BLOCK) -> DataFrame:
    """One row for each distinct prefix of the sequences of ``turns``, the empty one (depth 0) too.

    ``turns`` has ``conv_id``, ``depth`` (from 1, without gaps), ``mark`` (16 bytes) and ``words``;
    ``convs`` every ``conv_id``, those without turns too. Columns of the result: ``conv_id``, the
    smallest id whose sequence begins so; ``depth``; ``parent_conv_id``, that of the prefix one turn
    shorter (null at depth 0); ``n_convs``; ``n_children``; ``n_leaves``, prefixes below or here that
    nothing continues; ``saved_tokens``, words of the last turn times (n_convs - 1), summed over all
    prefixes below and here; and ``ends_sha256`` of the ids that end here, comma-joined in order.

    Equal sequences are counted first and sorted once. Sorted sequences that begin alike lie side by
    side, so a prefix is a stretch of them, whose ends every candidate finds by binary searches over
    range minima of the common prefixes, without looking at any other candidate. Sorted sequences
    are cut into blocks; what goes beyond a block is found by way of the minima of all blocks, of
    which there are ``BLOCKS`` at most. Memory of a task is that of a block. Nulls don't occur in
    its inputs (``turns_of`` takes them out); an empty ``convs`` gives no rows.
    """
    turns = stored(turns.select("conv_id", "depth", "mark", "words"), "trie-turns")
    marks = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), *_fingerprint())
    members = convs.select("conv_id").join(marks, "conv_id", "left").na.fill(0, ["n", "f1", "f2"])
    members = stored(members, "trie-members")
    classes = members.groupBy("n", "f1", "f2").agg(F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("convs"))
    classes = stored(classes.select("rep", "n", "convs"), "trie-classes")
    limits = _depths_to_sort(turns, classes, first).withColumnRenamed("rep", "conv_id")
    keys = turns.join(limits, "conv_id").where("depth <= upto").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("depth", "mark"))).alias("k"))
    key = F.expr("coalesce(unhex(array_join(transform(k, x -> hex(x.mark)), '')), X'')")
    keyed = classes.join(keys.withColumnRenamed("conv_id", "rep"), "rep", "left").select("rep", "n", "convs", key.alias("key"))
    placed = numbered(keyed, [F.col("key")], "pos")
    total = classes.count()
    size = max(block, -(-total // BLOCKS))
    rows = stored(_prefixes(placed, size), "trie-prefixes")
    leaf = (F.col("next") < F.col("n")).cast("long")
    summary = rows.groupBy("block").agg(
        F.min("lcp").alias("lcp"), F.sum("convs").alias("convs"), F.sum(leaf).alias("leaves"), F.min("rep").alias("rep")
    )
    table = summary.orderBy("block").toPandas()  # BLOCKS rows at most
    found = stored(_extents(rows, len(table) - 1), "trie-extents")
    values = ("right", "after", "convs", "leaves", "low")
    shared = found.where("pos > 0").select("block", F.col("lcp").alias("d"), F.col("a_left").alias("l"), *[F.col(f"a_{v}").alias(v) for v in values])
    whole = found.select("block", F.col("n").alias("d"), F.col("pos").alias("l"), *[F.col(f"b_{v}").alias(v) for v in values])
    candidates = shared.unionByName(whole)
    needs = (
        candidates.where("l is null").select("block", F.lit(0).alias("side"), "d")
        .unionByName(candidates.where("right is null").select("block", F.lit(1).alias("side"), "d"))
        .distinct()
    )
    known = rows.sparkSession.sparkContext.broadcast(_Blocks(table))
    edges = stored(_edges(needs, rows, known), "trie-edges")
    names = ["end", "after", "convs", "leaves", "low"]
    left, right = (
        edges.where(F.col("side") == s).select(F.col("source").alias("block"), "d", *[F.col(c).alias(f"{p}_{c}") for c in names])
        for s, p in ((0, "x"), (1, "y"))
    )
    to_left, to_right = F.col("l").isNull(), F.col("right").isNull()

    def with_edges(value: str):
        return F.col(value) + F.when(to_left, F.col(f"x_{value}")).otherwise(0) + F.when(to_right, F.col(f"y_{value}")).otherwise(0)

    # the end beyond the last block is the end of the table
    end = F.when(F.col("y_end") < 0, F.lit(total - 1)).otherwise(F.col("y_end"))
    opened = candidates.where("l is null or right is null").join(left, ["block", "d"], "left").join(right, ["block", "d"], "left")
    opened = opened.select(
        "d", F.coalesce("l", "x_end").alias("l"), F.coalesce("right", end).alias("right"),
        F.when(to_right, F.col("y_after")).otherwise(F.col("after")).alias("after"),
        with_edges("convs").alias("convs"), with_edges("leaves").alias("leaves"),
        F.least("low", F.when(to_left, F.col("x_low")), F.when(to_right, F.col("y_low"))).alias("low"),
    )
    closed = candidates.where("l is not null and right is not null").drop("block")
    stretches = closed.unionByName(opened).dropDuplicates(["l", "d"])
    place = found.select("block", "pos", "lcp", "rep", "n", "a_left")
    beyond = place.where("a_left is null").withColumnRenamed("lcp", "d").join(left.select("block", "d", "x_end"), ["block", "d"])
    place = place.where("a_left is not null").select("pos", "lcp", "rep", "n", "a_left").unionByName(
        beyond.select("pos", F.col("d").alias("lcp"), "rep", "n", F.col("x_end").alias("a_left"))
    )
    # the parent begins where the deeper of the two neighbours still shares it
    outer = F.greatest("lcp", "after")
    joined = stretches.join(place.withColumnRenamed("pos", "l"), "l").select(
        "l", "d", "right", "convs", "leaves", "low", "rep", "n", "lcp", outer.alias("outer"),
        F.when(F.col("lcp") >= F.col("after"), F.col("a_left")).otherwise(F.col("l")).alias("outer_l"),
    )
    ends = _digests(members)
    joined = joined.join(ends, "rep", "left").withColumn("ends", F.when(F.col("n") == F.col("d"), F.col("ends")))
    joined = stored(joined, "trie-stretches")
    children = joined.where("outer >= 0").groupBy(F.col("outer_l").alias("l"), F.col("outer").alias("d")).agg(F.count(F.lit(1)).alias("n_children"))
    above = joined.select(F.col("l").alias("outer_l"), F.col("d").alias("outer"), F.col("low").alias("above"))
    joined = stored(joined.join(children, ["l", "d"], "left").join(above, ["outer_l", "outer"], "left"), "trie-joined")
    # unbranched stretches become a row for each depth
    parts = joined.withColumn("part", F.explode(F.expr(f"sequence(0, (d - outer - 1) div {CHAIN})"))).repartition("l", "part")
    begin = F.col("outer") + 1 + F.col("part") * CHAIN
    depths = parts.withColumn("depth", F.explode(F.sequence(begin, F.least(F.col("d"), begin + CHAIN - 1)))).drop("part")
    worded = depths.join(turns.select(F.col("conv_id").alias("rep"), "depth", "words"), ["rep", "depth"], "left")
    narrow = worded.select(
        "l", "depth", "d", "right", "convs", ((F.col("convs") - 1) * F.coalesce("words", F.lit(0))).alias("saved"),
        (F.col("depth") == F.col("lcp") + 1).alias("opens"), "leaves", "low", "outer", "above", "n_children", "ends",
    )
    # by place and depth every prefix is followed by all that continue it
    listed = _running(narrow, ["l", "depth"], "saved", "before")
    starts = listed.where("opens").select((F.col("l") - 1).alias("right"), F.col("before").alias("upto"))
    saving = joined.where("convs > 1")
    everything = listed.agg(F.sum("saved")).first()[0] or 0
    sums = saving.select("l", "d", "right").join(starts, "right", "left")
    sums = stored(sums.select("l", "d", F.coalesce("upto", F.lit(everything)).alias("upto")), "trie-sums")
    alone = listed.where("convs = 1").withColumn("saved_tokens", F.lit(0).cast("long"))
    summed = listed.where("convs > 1").join(sums, ["l", "d"]).withColumn("saved_tokens", F.col("upto") - F.col("before")).drop("upto")
    bottom = F.col("depth") == F.col("d")
    return alone.unionByName(summed).select(
        F.col("low").alias("conv_id"), "depth",
        F.when(F.col("depth") > F.col("outer") + 1, F.col("low")).otherwise(F.col("above")).alias("parent_conv_id"),
        F.col("convs").alias("n_convs"), F.when(bottom, F.coalesce("n_children", F.lit(0))).otherwise(1).cast("long").alias("n_children"),
        F.col("leaves").alias("n_leaves"), "saved_tokens",
        F.coalesce(F.when(bottom, F.col("ends")), F.lit(NOTHING)).alias("ends_sha256"),
    )


def trie(conversations: DataFrame) -> DataFrame:
    """The trie of conversations as they are; see ``turns_of`` and ``nodes``."""
    turns = turns_of(conversations).select("conv_id", (F.col("place") + 1).alias("depth"), "mark", "words")
    return nodes(turns, conversations.where("conv_id is not null").select(F.col("conv_id").cast("long")).distinct())
