"""Runs of repeating words: longest common extensions from a difference cover, on a harmonic grid."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lexcorpus.llm.batches import extended, sliced
from lexcorpus.llm.store import without

TIMES = 4  # a run holds its period so many times
LEAST = 6  # and so many words
COVER_MOD = 31
#: A perfect difference set: each difference from 1 to 30, modulo 31, is that of one pair.
COVER = np.array([1, 5, 11, 24, 25, 27])
WORDS = 200_000  # words of the texts that are looked at together
POINTS = 1_000_000  # grid points made at once

_SLOT = np.full(COVER_MOD, -1)
_SLOT[COVER] = np.arange(len(COVER))


def _steps() -> np.ndarray:
    """For two residues, the least step after which both places are in the cover."""
    a, b, k = np.ogrid[:COVER_MOD, :COVER_MOD, :COVER_MOD]
    return np.argmax((_SLOT[(a + k) % COVER_MOD] >= 0) & (_SLOT[(b + k) % COVER_MOD] >= 0), axis=2)


STEPS = _steps()


class Extensions:
    """Longest common extensions of places in a sequence of positive numbers.

    Only suffixes at places whose residue is in the cover are sorted: by pairs of their first 31
    words, each time only those still tied, then by doubling, where the rank of a suffix 31 words on
    is known since that place is in the cover too. Common prefixes of neighbours come from the ranks
    of each doubling, and a sparse table gives their least value between any two. Two places are
    compared word by word for the few steps to places in the cover, and from there by one lookup.
    """

    def __init__(self, words: np.ndarray):
        self.n = len(words)
        self.words = np.zeros(self.n + COVER_MOD + 2, np.int64)  # 0 is past the end
        self.words[: self.n] = words
        blocks = np.arange(self.n // COVER_MOD + 1)[:, None] * COVER_MOD + COVER
        self.places = blocks.ravel()[blocks.ravel() < self.n]
        order, levels = self._sorted()
        self.at = np.empty(len(order), np.int64)
        self.at[order] = np.arange(len(order))
        self.table = [self._neighbours(order, levels)]
        while 2 ** len(self.table) <= len(self.table[0]):
            last, half = self.table[-1], 2 ** (len(self.table) - 1)
            self.table.append(np.minimum(last[:-half], last[half:]))

    def _sorted(self) -> tuple[np.ndarray, list[np.ndarray]]:
        """The order of the sampled suffixes, and their ranks by 31, 62, 124, ... words."""
        m, w = len(self.places), self.words
        order, first = np.arange(m), np.zeros(m, bool)
        first[:1] = True

        def refine(key_of) -> bool:
            """Order tied suffixes by a further key; false when none is tied."""
            tied = np.flatnonzero(~(first & np.append(first[1:], True)))
            if not len(tied):
                return False
            group = np.cumsum(first)[tied]
            members = order[tied]
            key = key_of(members)
            by = np.lexsort((key, group))
            order[tied], key = members[by], key[by]
            first[tied[1:]] |= key[1:] != key[:-1]
            return True

        def ranks() -> np.ndarray:
            rank = np.empty(m, np.int64)
            rank[order] = np.cumsum(first)
            return rank

        for t in range(0, COVER_MOD - 1, 2):
            if not refine(lambda i, t=t: (w[self.places[i] + t] << 32) | w[self.places[i] + t + 1]):
                break
        refine(lambda i: w[self.places[i] + COVER_MOD - 1])
        levels, step = [ranks()], len(COVER)

        def later(i: np.ndarray) -> np.ndarray:
            known = np.append(levels[-1], 0)
            return known[np.minimum(i + step, m)]

        while refine(later):
            levels.append(ranks())
            step *= 2
        return order, levels

    def _neighbours(self, order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Common words of each suffix and the next one in order."""
        m, a, b = len(order), order[:-1].copy(), order[1:].copy()
        length = np.zeros(len(a), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            step = len(COVER) << k
            rank = np.append(levels[k], 0)
            same = (a < m) & (b < m)
            same &= rank[np.minimum(a, m)] == rank[np.minimum(b, m)]
            length[same] += COVER_MOD << k
            a[same] += step
            b[same] += step
        return length + self._compared(self.places[order[:-1]] + length, self.places[order[1:]] + length, COVER_MOD)

    def _compared(self, i: np.ndarray, j: np.ndarray, most: np.ndarray | int) -> np.ndarray:
        """Common words from i and j on, looked at one by one, ``most`` at most."""
        length = np.zeros(len(i), np.int64)
        most = np.broadcast_to(most, len(i))
        open_ = np.flatnonzero((most > 0) & (i < self.n) & (j < self.n))
        while len(open_):
            to = length[open_]
            open_ = open_[self.words[i[open_] + to] == self.words[j[open_] + to]]
            length[open_] += 1
            open_ = open_[length[open_] < most[open_]]
        return length

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common words from i and j on, i and j being different places; 0 where one is at the end."""
        inside = (i < self.n) & (j < self.n)
        steps = np.where(inside, STEPS[i % COVER_MOD, j % COVER_MOD], 0)
        length = self._compared(i, j, steps)
        on = np.flatnonzero(inside & (length == steps) & (np.maximum(i, j) + steps < self.n))
        if not len(on):
            return length
        a, b = (self.at[(x // COVER_MOD) * len(COVER) + _SLOT[x % COVER_MOD]] for x in (i[on] + steps[on], j[on] + steps[on]))
        low, high = np.minimum(a, b), np.maximum(a, b)  # neighbours low .. high - 1
        level = np.frexp(high - low)[1] - 1
        for k in np.unique(level):
            of = np.flatnonzero(level == k)
            row = self.table[k]
            length[on[of]] += np.minimum(row[low[of]], row[high[of] - (1 << int(k))])
        return length


def _ranges(counts: np.ndarray) -> np.ndarray:
    """0 .. count - 1 for each count, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def _grid(starts: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and periods to look at: for each period p of a text every 3p-th place. A run of four
    periods has 3p places whose word is repeated p words later, so it holds one of these. A text of
    n words has about n ln(n) / 3 of them."""
    most = lengths // TIMES
    pairs = np.cumsum(most)
    at = 0
    while at < (pairs[-1] if len(pairs) else 0):
        some = np.arange(at, min(at + POINTS // 8, pairs[-1]))
        text = np.searchsorted(pairs, some, "right")
        period = some - (pairs - most)[text] + 1
        points = -(-(lengths[text] - period) // ((TIMES - 1) * period))
        upto = np.searchsorted(np.cumsum(points), POINTS, "right")
        upto = max(1, upto)
        text, period, points = text[:upto], period[:upto], points[:upto]
        step = np.repeat(period, points)
        yield np.repeat(starts[text], points) + _ranges(points) * step * (TIMES - 1), step
        at += upto


def find_runs(texts: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All runs of ``texts`` (numbers of words, equal for equal words of a text): the text, start,
    length and smallest period of each, by text, start and period.

    A run is a longest stretch with a smallest period p of at least max(6, 4p) words. A multiple of
    p is found as a period of the same stretch and left out.
    """
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(lengths) - lengths
    upto, parts = 1, []
    for t in texts:  # numbers of different texts differ, so no stretch passes from one to another
        parts.append(t + upto)
        upto += int(t.max()) + 1 if len(t) else 0
    words = np.concatenate([*parts, np.zeros(LEAST, np.int64)]) if parts else np.zeros(LEAST, np.int64)
    n = len(words) - LEAST
    places, periods = [], []
    need = LEAST - 1  # a run of words of period p has LEAST - 1 places at least that repeat p words later
    for x, p in _grid(starts, lengths):
        same = words[x] == words[np.minimum(x + p, n)]
        x, p = x[same], p[same]
        around, left, right = np.ones(len(x), np.int64), np.ones(len(x), bool), np.ones(len(x), bool)
        for t in range(1, need):
            left &= (x >= t) & (words[x - t] == words[x - t + p])
            right &= words[np.minimum(x + t, n)] == words[np.minimum(x + t + p, n + 1)]
            right &= x + t + p < n
            around += left.astype(np.int64) + right
        places.append(x[around >= need])
        periods.append(p[around >= need])
    x = np.concatenate(places) if places else np.zeros(0, np.int64)
    p = np.concatenate(periods) if periods else np.zeros(0, np.int64)
    if not len(x):
        return (np.zeros(0, np.int64),) * 4
    # only texts with such places need their suffixes sorted
    of = np.searchsorted(starts + lengths, x, "right")
    used = np.unique(of)
    sub = np.concatenate([words[starts[u] : starts[u] + lengths[u]] for u in used])
    moved = np.cumsum(lengths[used]) - lengths[used]
    shift = (starts[used] - moved)[np.searchsorted(used, of)]
    x = x - shift
    m = len(sub)
    after = Extensions(sub).common(x, x + p)
    before = Extensions(sub[::-1]).common(m - x, m - x - p)
    start, end = x - before, x + p + after
    keep = end - start >= np.maximum(LEAST, TIMES * p)
    start, end, p, of, shift = start[keep], end[keep], p[keep], of[keep], shift[keep]
    by = np.lexsort((p, end, start))
    start, end, p, of, shift = start[by], end[by], p[by], of[by], shift[by]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, p, of, shift = start[new], end[new], p[new], of[new], shift[new]
    start, end = start + shift - starts[of], end + shift - starts[of]
    by = np.lexsort((p, start, of))
    return of[by], start[by], (end - start)[by], p[by]


def numbers(words: list[bytes]) -> np.ndarray:
    """Words as numbers from 0, equal for equal words."""
    known = {w: k for k, w in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(known.__getitem__, words), np.int64, len(words))


Runs = list[tuple[int, int, int]]


def _looked_at(texts: list[bytes | None]) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    """The words of each text and its runs, as rows of start, length and period. Texts are taken
    together up to ``WORDS`` words; a longer one is taken alone."""
    held: list[tuple[int, list[bytes]]] = []
    n = 0

    def results() -> Iterator[tuple[int, list[bytes], np.ndarray]]:
        of, *run = find_runs([numbers(words) for _, words in held])
        rows = np.stack(run, axis=1)
        cuts = np.searchsorted(of, np.arange(len(held) + 1))
        for k, (i, words) in enumerate(held):
            yield i, words, rows[cuts[k] : cuts[k + 1]]

    for i, text in enumerate(texts):
        words = (text or b"").split()  # at the ASCII white space 09-0D and 20
        if held and n + len(words) > WORDS:
            yield from results()
            held, n = [], 0
        held.append((i, words))
        n += len(words)
    if held:
        yield from results()


def _kept(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not len(runs):
        return words
    inside = np.zeros(len(words) + 1, np.int64)
    np.add.at(inside, runs[:, 0] + runs[:, 2], 1)
    np.add.at(inside, runs[:, 0] + runs[:, 1], -1)
    return [words[k] for k in np.flatnonzero(np.cumsum(inside[:-1]) == 0)]


SUMMARY = (
    "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
)


def _summary(texts: list[bytes | None]) -> list[pa.Array]:
    rows = []
    for _, words, runs in _looked_at(texts):
        best: tuple = (None, None, None, None)
        if len(runs):
            # the quotients of numbers of this size differ where the fractions do
            start, length, period = runs[np.lexsort((runs[:, 2], runs[:, 0], -(runs[:, 1] / runs[:, 2])))[0]].tolist()
            best = (start, length, period, 1000 * length // period)
        listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs.tolist())
        shown = hashlib.sha256(b" ".join(_kept(words, runs))).hexdigest()
        rows.append((len(runs), *best, hashlib.sha256(listed.encode()).hexdigest(), shown))
    kinds = [pa.int64()] * 5 + [pa.string()] * 2
    return [pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 7, kinds, strict=True)]


def _as_bytes(docs: DataFrame, text: str) -> DataFrame:
    return docs.withColumn(text, F.col(f"`{text}`").cast("binary"))


def summarized(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its texts, with the count of runs, the run of greatest length for its period
    (ties: smallest start, then period), and digests of all runs and of the text without repeats.

    Words are stretches without ASCII white space, compared byte by byte. Rows stay where they are.
    Null and empty texts have no words and no runs: n_runs is 0, the run's columns are null, and the
    digests are those of nothing. A very long text is taken alone, in memory of some hundred bytes a
    word; repeated rows and nulls elsewhere are kept; an empty table stays empty; columns named like
    the new ones are replaced.
    """
    rows = without(docs, [c.split()[0] for c in SUMMARY.split(", ")])
    return extended(_as_bytes(rows, text), text, SUMMARY, _summary)


def run_rows(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row for each run of each row of ``docs``: its columns without the text, and ``start``,
    ``length`` and ``period`` in words. Rows without a run (null and empty texts too) give none;
    else as ``summarized``."""
    rows = _as_bytes(without(docs, ("start", "length", "period")), text)
    at = rows.columns.index(text)
    kept = [i for i in range(len(rows.columns)) if i != at]
    schema = StructType([*[rows.schema[i] for i in kept], *StructType.fromDDL("start long, length long, period long")])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = [(i, runs) for i, _, runs in _looked_at(batch.column(at).to_pylist()) if len(runs)]
            if not found:
                continue
            owner = pa.array(np.concatenate([np.full(len(r), i) for i, r in found]))
            runs = np.concatenate([r for _, r in found])
            made = [pa.array(np.ascontiguousarray(runs[:, k])) for k in range(3)]
            yield pa.RecordBatch.from_arrays([*[batch.column(i).take(owner) for i in kept], *made], names=schema.names)

    return rows.mapInArrow(work, schema)


def collapsed(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with each run cut down to its first period: the words kept, joined by one space.
    Texts without a run stay as they are, null too; else as ``summarized``."""
    schema = docs.schema
    at = docs.columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = batch.column(at).to_pylist()
            for i, words, runs in _looked_at([None if t is None else t.encode() for t in texts]):
                if len(runs):
                    texts[i] = b" ".join(_kept(words, runs)).decode()
            columns = [pa.array(texts, pa.string()) if k == at else batch.column(k) for k in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(work, schema)
