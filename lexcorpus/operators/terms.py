"""Finding the terms of an inventory, in many languages, in whole texts.

An inventory is a table of any length. Each term is filed under one of its stretches of eight
characters, or four if it is shorter, the one that is rarest in texts; a text is looked up by its
stretches, and a term that shares one is compared with the text at that place. So a text is compared
with the few terms it may hold, not with the whole inventory, and no stretch of a text is moved.
"""

from __future__ import annotations

import itertools
import sys
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lexcorpus.functions.text import strip
from lexcorpus.session import written

LONG, SHORT = 8, 4  # characters of a stretch; terms shorter than both are filed whole
SENT = 256 << 20  # bytes of an index that are sent to every task at once
LEAST = 1 << 10  # bytes of an index that are sent at once at least
PROBED = 200  # texts that tell which stretches are common
WINDOW = 8  # bytes compared at once
PIECE = 1 << 20  # places of a text looked up at once
BITS, SLOTS = 22, 8  # of the filter over the windows of an inventory, and its slots for a window, at least


class TermIndex(NamedTuple):
    """Terms by their ``anchor``, with ``lang`` (null: any), ``term``, its lower-case form ``low``,
    its place ``term_ord`` and a number ``id``; the lengths of the anchors; and the bytes of it all."""

    anchors: DataFrame
    lengths: list[int]
    size: int


def _language(lang: Column) -> Column:
    return F.nullif(F.lower(strip(lang)), F.lit(""))


def _text(title: str | None, body: str) -> Column:
    parts = [F.coalesce(F.col(c), F.lit("")) for c in (title, body) if c]
    return F.lower(F.concat_ws(" ", *parts))


def _stretches(text: Column, lengths: list[int]) -> Column:
    """Distinct stretches of these lengths, found in one pass each."""
    found = [F.regexp_extract_all(text, F.lit(rf"(?s)(?=(.{{{n}}}))"), F.lit(1)) for n in lengths]
    return F.array_distinct(F.concat(*found) if len(found) > 1 else found[0])


def term_index(
    terms: DataFrame, docs: DataFrame | None = None, title: str | None = "title", body: str = "full_text"
) -> TermIndex:
    """The index of ``terms`` (``lang``, ``term``, ``ord``). Terms of a null or blank language are
    sought in every text; blank terms are left out; of a term listed twice in a language the first
    place counts. Stretches that ``docs`` hold less often are preferred as anchors; some of its
    texts tell which, and only the speed of the search depends on them."""
    listed = terms.where(strip(F.col("term")) != "").groupBy(_language(F.col("lang")).alias("lang"), "term").agg(
        F.min("ord").alias("term_ord")
    )
    size = F.char_length("low")
    n = F.when(size >= LONG, F.lit(LONG)).otherwise(F.least(F.lit(SHORT), size))
    listed = listed.withColumn("low", F.lower("term")).withColumn("n", n)
    places = F.sequence(F.lit(1), F.char_length("low") - F.col("n") + 1)
    cut = F.transform(places, lambda i: F.substring(F.col("low"), i, F.col("n")))
    filed = listed.withColumn("anchor", F.explode(F.array_distinct(cut)))
    if docs is not None:
        probe = docs.limit(PROBED).select(F.explode(_stretches(_text(title, body), [SHORT, LONG])).alias("anchor"))
        filed = filed.join(probe.groupBy("anchor").agg(F.count(F.lit(1)).alias("seen")), "anchor", "left")
    else:
        filed = filed.withColumn("seen", F.lit(0))
    rarity = F.struct(F.coalesce("seen", F.lit(0)), "anchor")
    anchors = written(
        filed.groupBy("lang", "term", "low", "n", "term_ord").agg(F.min_by("anchor", rarity).alias("anchor"))
        .withColumn("id", F.monotonically_increasing_id())
    )
    size = F.sum(F.octet_length("term") + F.octet_length("low") + 64)
    known = anchors.agg(F.sort_array(F.collect_set("n")).alias("lengths"), size.alias("size")).first()
    return TermIndex(anchors.drop("n"), list(known["lengths"]), known["size"] or 0)


class _Sought:
    """Terms by up to ``WINDOW`` bytes of their anchors."""

    def __init__(self, listed: pa.Table):
        """``listed`` has id, lang, low, and the offset and width of the anchor in bytes."""
        low = listed["low"].cast(pa.large_binary()).combine_chunks()
        bounds = np.frombuffer(low.buffers()[1], np.int64)[low.offset : low.offset + len(low) + 1]
        self.ids, self.size, self.start = listed["id"].to_numpy(), np.diff(bounds), bounds[:-1] - bounds[0]
        self.data = np.frombuffer(low.buffers()[2].to_pybytes()[bounds[0] : bounds[-1]] + bytes(WINDOW), np.uint8)
        lang = listed["lang"].combine_chunks().dictionary_encode()
        self.lang = lang.indices.fill_null(-1).to_numpy()
        self.langs = {name: k for k, name in enumerate(lang.dictionary.to_pylist())}
        self.offset, width = listed["offset"].to_numpy(), listed["width"].to_numpy()
        self.by_width = []
        for n in np.unique(width).tolist():
            terms = np.flatnonzero(width == n)
            keys = _windows(self.data, self.start[terms] + self.offset[terms]) & _mask(n)
            order = np.argsort(keys, kind="stable")
            keys, first = np.unique(keys[order], return_index=True)
            bits = max(BITS, (SLOTS * len(keys)).bit_length())
            some = np.zeros(1 << bits, bool)
            some[_slot(keys, bits)] = True
            self.by_width.append((n, bits, some, keys, np.append(first, len(terms)), terms[order]))

    def found(self, texts: Iterable[bytes], langs: Iterable[str | None] | None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first, texts, place of the text, id) of each term that a text holds, once each, for some
        texts at a time; with ``langs`` a text holds only terms of its language and of none."""
        held, spoken, size, first = [], [], 0, 0
        for text, lang in zip(texts, itertools.repeat(None) if langs is None else langs):
            held.append(text)
            spoken.append(self.langs.get(lang, -1))
            size += len(text)
            if size >= PIECE:
                yield first, len(held), *self._found(held, first, None if langs is None else np.array(spoken))
                held, spoken, size, first = [], [], 0, first + len(held)
        if held:
            yield first, len(held), *self._found(held, first, None if langs is None else np.array(spoken))

    def _found(self, texts: list[bytes], first: int, spoken: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(x) for x in texts])
        ends = np.cumsum(sizes)
        data = np.frombuffer(b"".join(texts) + bytes(WINDOW), np.uint8)
        pairs = [np.zeros(0, np.int64)]
        for at in range(0, int(ends[-1]), PIECE):
            part = data[at : at + PIECE + WINDOW]
            windows = np.lib.stride_tricks.sliding_window_view(part, WINDOW)[: min(PIECE, int(ends[-1]) - at)].copy().view("<u8").ravel()
            for n, bits, some, keys, cuts, terms in self.by_width:
                cut = windows & _mask(n)
                place = np.flatnonzero(some[_slot(cut, bits)])
                cut = cut[place]
                key = np.searchsorted(keys, cut)
                key[key == len(keys)] = 0
                same = keys[key] == cut
                place, key = place[same], key[same]
                low = cuts[key]
                count = cuts[key + 1] - low
                term = terms[np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())]
                pairs.append(self._equal(data, ends, sizes, np.repeat(place + at, count), term, spoken))
        both = np.unique(np.concatenate(pairs))
        return first + both // len(self.ids), self.ids[both % len(self.ids)]

    def _equal(
        self, data: np.ndarray, ends: np.ndarray, sizes: np.ndarray, place: np.ndarray, term: np.ndarray, spoken: np.ndarray | None
    ) -> np.ndarray:
        """Text times terms plus term where the whole term is in the text around the place."""
        row = np.searchsorted(ends, place, "right")
        begin = place - self.offset[term]
        inside = (begin >= ends[row] - sizes[row]) & (begin + self.size[term] <= ends[row])
        if spoken is not None:
            inside &= (self.lang[term] == -1) | (self.lang[term] == spoken[row])
        row, begin, term, at = row[inside], begin[inside], term[inside], 0
        done = [row[:0]]
        while len(term):
            left = np.minimum(self.size[term] - at, WINDOW)
            differ = _windows(data, begin + at) ^ _windows(self.data, self.start[term] + at)
            same = differ & _mask(left) == 0
            at += WINDOW
            last = self.size[term] <= at
            done.append(row[same & last] * len(self.ids) + term[same & last])
            row, begin, term = (x[same & ~last] for x in (row, begin, term))
        return np.concatenate(done)


def _windows(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    return data[places[:, None] + np.arange(WINDOW)].view("<u8").ravel()


def _mask(n: int | np.ndarray) -> np.ndarray:
    return ~np.uint64(0) >> np.asarray(8 * (WINDOW - n), np.uint64)


def _slot(windows: np.ndarray, bits: int) -> np.ndarray:
    return windows * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)


def _held(texts: DataFrame, anchors: DataFrame, by_language: bool, every: bool) -> DataFrame:
    """The columns of ``texts`` but ``_lang`` and ``_text``, and in ``_id`` the id of each of ``anchors``
    that ``_text`` holds; the terms are sent to all tasks. With ``every`` a text without any gives a row
    with a null id."""
    offset = F.octet_length(F.expr("substring_index(low, anchor, 1)")).alias("offset")
    width = F.least(F.octet_length("anchor"), F.lit(WINDOW)).alias("width")
    listed = anchors.select("id", "lang", "low", offset, width).toArrow()  # SENT bytes at most
    sent = texts.sparkSession.sparkContext.broadcast(listed)
    own = [c for c in texts.columns if c not in ("_lang", "_text")]
    schema = StructType([*[texts.schema[c] for c in own], StructField("_id", LongType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sought = None
        for batch in batches:
            sought = sought or _Sought(sent.value)
            langs = batch.column("_lang").to_pylist() if by_language else None
            bodies = (x.as_buffer().to_pybytes() for x in batch.column("_text"))
            for first, n, row, ids in sought.found(bodies, langs):
                none = np.setdiff1d(np.arange(first, first + n), row) if every else row[:0]
                kept = batch.select(own).take(pa.array(np.concatenate([row, none])))
                made = pa.array(np.append(ids, np.zeros(len(none), np.int64)), mask=np.arange(len(ids) + len(none)) >= len(ids))
                yield pa.RecordBatch.from_arrays([*kept.columns, made], names=schema.names)

    return texts.mapInArrow(work, schema)


def _named(
    docs: DataFrame, keep: list[str], index: TermIndex, title: str | None, body: str, lang: str | None, sent: int, every: bool
) -> DataFrame:
    """The columns ``keep`` of ``docs`` with ``term``, ``term_lang`` and ``term_ord`` of each term found.
    An index of over ``sent`` bytes goes in parts, for each of which the texts are read again; ``every``
    needs a single one."""
    language = _language(F.col(lang)) if lang else F.lit(None).cast("string")
    texts = docs.select(*keep, language.alias("_lang"), _text(title, body).alias("_text"))
    names = [F.col("id").alias("_id"), "term", F.col("lang").alias("term_lang"), "term_ord"]
    found = None
    for n in range(parts := _parts(index, sent)):
        some = index.anchors.where(F.pmod(F.xxhash64("id"), F.lit(parts)) == n) if parts > 1 else index.anchors
        held = _held(texts, some, lang is not None, every)
        held = held.join(F.broadcast(some.select(*names)), "_id", "left" if every else "inner").drop("_id")
        found = held if found is None else found.unionAll(held)
    return found


def _parts(index: TermIndex, sent: int) -> int:
    return max(1, -(-index.size // max(sent, LEAST)))


def find_terms(
    docs: DataFrame, index: TermIndex, key: str = "ord", title: str | None = "title", body: str = "full_text",
    lang: str | None = None, sent: int = SENT,
) -> DataFrame:
    """``key``, ``term``, ``term_lang`` and ``term_ord`` of each term found in the title or text of a
    row, ignoring case; with ``lang`` only terms of the row's language and of none are sought.

    The index is sent to all tasks, ``sent`` bytes of it at once, and texts are looked up where they are
    read, byte by byte: neither they nor parts of them are moved. Rows with a null key are looked at like
    others.
    """
    if not index.lengths:  # no terms
        none = [F.lit(None).cast(k).alias(n) for n, k in (("term", "string"), ("term_lang", "string"))]
        place = F.lit(None).cast(dict(index.anchors.dtypes)["term_ord"]).alias("term_ord")
        return docs.select(key, *none, place).where(F.lit(False))
    return _named(docs, [key], index, title, body, lang, sent, False)


def term_rows(
    docs: DataFrame, index: TermIndex, keep: list[str], key: str = "ord", title: str | None = "title",
    body: str = "full_text", lang: str | None = None, sent: int = SENT,
) -> DataFrame:
    """One row per row of ``docs`` and term found, with the columns ``keep``; a row without any term
    gives one with an empty term. ``key`` must be unique. An index that is sent at once moves no row."""
    own = [key, *[c for c in keep if c != key]]
    if index.lengths and _parts(index, sent) == 1:
        rows = _named(docs, own, index, title, body, lang, sent, True)
    else:
        rows = docs.select(*own).join(find_terms(docs, index, key, title, body, lang, sent), key, "left")
    return rows.withColumn("term", F.coalesce("term", F.lit("")))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
