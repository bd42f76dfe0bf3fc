"""Packing token sequences: non-negative least squares over window fillings, greedy residuals."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lexcorpus.llm import tokens
from lexcorpus.llm.batches import sliced
from lexcorpus.llm.store import stored

WINDOW = 2048
END_ID = 1
GRAIN = 64
WASTE = 32
PIVOTS = 8
SWEEPS = 25

OUT = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def parts(length: int) -> list[tuple[int, int]]:
    """(start, size) of powers of two from WINDOW / 2 down to GRAIN, and what is left."""
    found, at, size = [], 0, WINDOW // 2
    while size >= GRAIN:
        if length & size:
            found.append((at, size))
            at += size
        size //= 2
    if at < length:
        found.append((at, length - at))
    return found


def combinations(histogram: np.ndarray) -> list[tuple[int, ...]]:
    """Fillings of a window by two or three lengths that occur: all pairs, and the triples with one
    of ``PIVOTS`` lengths spread evenly over the rows."""
    have = np.flatnonzero(histogram)
    known = set(have.tolist())
    found = {(a, WINDOW - a) for a in known if a <= WINDOW - a and WINDOW - a in known}
    upto = np.cumsum(histogram[have])
    marks = (np.arange(PIVOTS) + 0.5) / PIVOTS * (upto[-1] if len(upto) else 0)
    for b in {int(have[i]) for i in np.searchsorted(upto, marks) if i < len(have)}:
        for a in known:
            if WINDOW - a - b in known:
                found.add(tuple(sorted((a, b, WINDOW - a - b))))
    return sorted(found)


def least_squares(columns: list[tuple[int, ...]], histogram: np.ndarray) -> np.ndarray:
    """Repeat counts x >= 0 of the columns that minimise |A x - histogram|, where A counts the
    lengths of a column: coordinate descent, each step exact and clipped at zero."""
    x, left = np.zeros(len(columns)), histogram.astype(float).tolist()
    shaped = []
    for c in columns:
        counts = defaultdict(int)
        for n in c:
            counts[n] += 1
        shaped.append((list(counts.items()), sum(v * v for v in counts.values())))
    for _ in range(SWEEPS):
        moved = 0.0
        for j, (counts, norm) in enumerate(shaped):
            step = sum(v * left[n] for n, v in counts) / norm
            step = max(step, -x[j])
            if step:
                x[j] += step
                moved = max(moved, abs(step))
                for n, v in counts:
                    left[n] -= v * step
        if moved < 0.25:
            break
    return x


@dataclass
class Plan:
    """Where the rests of documents go: rank j among those of a length, or a part of them, with
    lo <= j < hi has index i = j - lo + shift; it lies in sequence first + i // per at offset
    base + (i % per) * size. Its size follows from the window and GRAIN, not from the rows."""

    rows: list[tuple[int, int, int, int, int, int, int, int, int]] = field(default_factory=list)
    split_from: dict[int, int] = field(default_factory=dict)
    sequences: int = 0

    def add(self, items: list[tuple[int, int, int, int]], per: int, base: int, size: int, first: int) -> None:
        shift = 0
        for length, part, lo, hi in items:
            self.rows.append((length, part, lo, hi, shift, first, per, base, size))
            shift += hi - lo


def planned(histogram: np.ndarray) -> Plan:
    """A plan for histogram[n] rests of n tokens each.

    The solved repeat counts are rounded down and used as far as rests remain. What is left is
    packed greedily, the longest first with the longest that still fit, as often as all of them
    last. Where that would waste over ``WASTE`` tokens a window, the rests of that length are cut
    into powers of two, which fill windows or shorter sequences exactly, and only what is below
    ``GRAIN`` goes on. So no length, however frequent, leaves windows half empty.
    """
    plan = Plan()
    pool: dict[int, list[tuple[int, int, int, int]]] = {n: [(n, 0, 0, int(h))] for n, h in enumerate(histogram) if n and h}
    left = histogram.astype(np.int64).copy()
    left[0] = 0

    def take(n: int, count: int) -> list[tuple[int, int, int, int]]:
        got, queue = [], pool[n]
        left[n] -= count
        while count:
            length, part, lo, hi = queue[0]
            used = min(count, hi - lo)
            got.append((length, part, lo, lo + used))
            count -= used
            if lo + used == hi:
                queue.pop(0)
            else:
                queue[0] = (length, part, lo + used, hi)
        return got

    def place(filling: dict[int, int], repeats: int) -> None:
        base = 0
        for n, per in filling.items():
            plan.add(take(n, per * repeats), per, base, n, plan.sequences)
            base += per * n
        plan.sequences += repeats

    columns = combinations(left)
    counts = np.floor(least_squares(columns, left) + 1e-6).astype(np.int64)
    for j in np.argsort(-counts, kind="stable"):
        filling = defaultdict(int)
        for n in columns[j]:
            filling[n] += 1
        repeats = min(int(counts[j]), *(int(left[n]) // per for n, per in filling.items()))
        if repeats > 0:
            place(filling, repeats)
    while left.any():
        have = np.flatnonzero(left)
        longest = int(have[-1])
        filling, room = {}, WINDOW
        for n in have[::-1].tolist():
            per = min(room // n, int(left[n]))
            if per:
                filling[n] = per
                room -= per * n
        if room > WASTE and longest >= GRAIN:
            count = int(left[longest])
            for length, part, lo, hi in take(longest, count):  # only whole rests are that long
                plan.split_from[length] = min(lo, plan.split_from.get(length, lo))
                for p, (_, size) in enumerate(parts(length), 1):
                    if size < GRAIN:
                        pool.setdefault(size, []).append((length, p, lo, hi))
                        left[size] += hi - lo
                        continue
                    at, per = lo, WINDOW // size
                    while at < hi:
                        while per > hi - at:
                            per //= 2
                        whole = (hi - at) // per * per
                        plan.add([(length, p, at, at + whole)], per, 0, size, plan.sequences)
                        plan.sequences += whole // per
                        at += whole
            continue
        place(filling, min(int(left[n]) // per for n, per in filling.items()))
    return plan


def tokenized(docs: DataFrame, doc_id: str, text: str, vocabulary: str, ranks: str) -> DataFrame:
    """A row for each document: its tokens (an end id after the text's), checksums of its full
    windows, of its rest and of the rest's parts, and its place in its task's rests of that length."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kinds = "task long, tokens long, rest long, place long, fulls_before long, fulls array<long>, crc long, parts array<long>"
    schema = StructType([rows.schema["doc_id"], *StructType.fromDDL(kinds)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        seen, fulls = np.zeros(WINDOW, np.int64), 0
        for batch in sliced(batches):
            out = []
            for ids in tokens.token_ids(batch.column(1).to_pylist(), vocabulary, ranks):
                data = np.append(ids, np.uint32(END_ID)).astype("<u4").tobytes()
                n = len(data) // 4
                rest = n % WINDOW
                cut = (n - rest) * 4
                crcs = [zlib.crc32(data[i : i + WINDOW * 4]) for i in range(0, cut, WINDOW * 4)]
                own = [zlib.crc32(data[cut + 4 * a : cut + 4 * (a + size)]) for a, size in parts(rest)]
                out.append((task, n, rest, int(seen[rest]), fulls, crcs, zlib.crc32(data[cut:]), own))
                seen[rest] += 1
                fulls += len(crcs)
            if out:
                made = [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _arrow(schema), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=schema.names)

    return rows.mapInArrow(work, schema)


def _arrow(schema: StructType) -> list[pa.Field]:
    return [pa.field(f.name, pa.int64() if isinstance(f.dataType, LongType) else pa.list_(pa.int64())) for f in schema.fields[1:]]


def packed(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
    vocabulary: str = tokens.VOCABULARY, ranks: str = tokens.RANKS,
) -> DataFrame:
    """Pieces of all documents in sequences of at most ``WINDOW`` tokens.

    A document is cut into full windows, each a sequence, and a rest. The histogram of the rests is
    counted over all documents and gives the plan; a rest finds its place from its length and its
    rank among the rests of that length, numbered without a sort: by its place in its task and the
    counts of the tasks before. Null and empty texts are their end id alone. Rows that share an id
    are documents of their own; a null id stays null; an empty table gives no pieces; other columns
    are left out.
    """
    rows = stored(tokenized(docs, doc_id, text, vocabulary, ranks), "tokenized")
    counts = rows.groupBy("task", "rest").agg(F.count(F.lit(1)).alias("n"))
    histogram = np.zeros(WINDOW, np.int64)
    for r in counts.groupBy("rest").agg(F.sum("n").alias("n")).collect():  # WINDOW rows at most
        histogram[r["rest"]] = r["n"]
    plan = planned(histogram)
    before = Window.partitionBy("rest").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    ranks_before = counts.select("task", "rest", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ranks_before"))
    # one row for each task that read texts
    fulls = rows.groupBy("task").agg(F.sum(F.size("fulls")).alias("n"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    fulls = fulls.select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("task_fulls"))
    placed = rows.join(ranks_before, ["task", "rest"]).join(F.broadcast(fulls), "task").select(
        "doc_id", "tokens", "rest", (F.col("place") + F.col("ranks_before")).alias("rank"),
        (F.col("fulls_before") + F.col("task_fulls") + plan.sequences).alias("first_full"), "fulls", "crc", "parts",
    )
    sent = docs.sparkSession.sparkContext.broadcast(plan)
    schema = StructType([placed.schema["doc_id"], *[StructField(n, LongType()) for n in OUT]])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = defaultdict(list)
        for length, part, *entry in sorted(sent.value.rows):
            lookup[length, part].append(entry)
        starts = {k: np.array([e[0] for e in v]) for k, v in lookup.items()}
        split_from = sent.value.split_from

        def found(rest: int, part: int, rank: int) -> tuple[int, int]:
            lo, _, shift, first, per, base, size = lookup[rest, part][np.searchsorted(starts[rest, part], rank, "right") - 1]
            i = rank - lo + shift
            return first + i // per, base + i % per * size

        for batch in sliced(batches):
            at, out = [], []
            for k, (n, rest, rank, first, fulls, crc, own) in enumerate(zip(*[c.to_pylist() for c in batch.columns[1:]], strict=True)):
                pieces = [(i * WINDOW, WINDOW, c, n, first + i, 0) for i, c in enumerate(fulls)]
                done = n - rest
                if rest and rank >= split_from.get(rest, rank + 1):
                    for p, ((a, size), c) in enumerate(zip(parts(rest), own, strict=True), 1):
                        pieces.append((done + a, size, c, n, *found(rest, p, rank)))
                elif rest:
                    pieces.append((done, rest, crc, n, *found(rest, 0, rank)))
                at += [k] * len(pieces)
                out += pieces
            if out:
                made = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), *made], names=schema.names)

    return placed.mapInArrow(work, schema)
