"""Language identification by the nearest of several TF-IDF centroids per language."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexcorpus.llm.batches import extended, filtered
from lexcorpus.llm.store import without

UNKNOWN = "und"
HASH_BITS = 18
GRAMS = 8192
CLUSTERS = 4
SAMPLE = 1000
ROUNDS = 12
#: Of each language, so many grams are in the model, however many languages there are.
LEAST = 512
#: Sizes of texts, as powers of two of their number of grams; a floor is set from so many cosines.
SIZES, ENOUGH = 24, 20
#: The least cosine accepted: this share of the low quantile, or of the median if that is more.
LOW, OF_LOW, OF_MEDIAN = 0.01, 0.9, 0.45
BLOCK_ROWS, BLOCK_CHARS = 128, 500_000

_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def _blocks(texts: Iterable[str | None]) -> Iterator[tuple[int, list[tuple[int, str]]]]:
    """Rows with pieces of their texts: (first row, [(row in the block, piece)]). A long text comes
    in pieces that overlap by two letters, all in one block of rows."""
    held, first, rows, size = [], 0, 0, 0
    for text in texts:
        text = (text or "").lower()
        for at in range(0, max(1, len(text)), BLOCK_CHARS):
            held.append((rows, text[max(0, at - 2) : at + BLOCK_CHARS]))
        rows, size = rows + 1, size + len(text)
        if rows >= BLOCK_ROWS or size >= BLOCK_CHARS:
            yield first, held
            held, first, rows, size = [], first + rows, 0, 0
    if held:
        yield first, held


def _hashed(pieces: list[tuple[int, str]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, hash) of the pairs and triples of letters, runs of other characters standing as one
    space, about ``BLOCK_CHARS`` characters at a time; and the rows that have a letter."""
    k = 0
    while k < len(pieces):
        size, j = 0, k
        while j < len(pieces) and (j == k or size + len(pieces[j][1]) <= 2 * BLOCK_CHARS):
            size += len(pieces[j][1])
            j += 1
        some = pieces[k:j]
        k = j
        codes = np.frombuffer(" ".join([*(p for _, p in some), ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.fromiter((len(p) + 1 for _, p in some), np.int64, len(some))
        owner = np.repeat(np.fromiter((r for r, _ in some), np.int64, len(some)), lengths)
        letter = _letter_table()[codes]
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        codes = np.where(letter, codes, np.uint32(32))[keep]
        owner, letter = owner[keep], letter[keep]
        x = codes * np.uint32(0x9E3779B1)
        x ^= x >> np.uint32(15)
        two = (x[:-1] * np.uint32(0x85EBCA6B)) ^ x[1:]
        three = (two[:-1] * np.uint32(0xC2B2AE35)) ^ x[2:]
        two, three = two * np.uint32(0x27D4EB2F), three * np.uint32(0x165667B1)
        same = owner[:-1] == owner[1:]
        both = same[:-1] & same[1:]
        rows = np.concatenate([owner[:-1][same], owner[:-2][both]])
        grams = np.concatenate([two[same], three[both]]) >> np.uint32(32 - HASH_BITS)
        yield rows, grams.astype(np.int64), np.unique(owner[letter])


@dataclass
class Model:
    """Centroids with their languages and the least cosine that each accepts, by the size of a text."""

    place: np.ndarray  # of a hash among the grams of the model; GRAMS for any other
    idf: np.ndarray
    rare: float  # weight of grams outside the model
    langs: list[str]
    centroids: np.ndarray
    floors: np.ndarray

    def vectors(self, texts: Iterable[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(first row, unit TF-IDF vectors, has a letter, size) of blocks of whole texts. Grams outside
        the model lengthen a vector, so a text that consists of them is near no centroid."""
        wide = len(self.idf) + 1
        for first, pieces in _blocks(texts):
            n = pieces[-1][0] + 1
            counts, letters = np.zeros(n * wide), np.zeros(n, bool)
            for rows, grams, lettered in _hashed(pieces):
                counts += np.bincount(rows * wide + self.place[grams], minlength=n * wide)
                letters[lettered] = True
            counts = counts.reshape(n, wide)
            tf = counts[:, :-1].astype(np.float32)
            some = tf > 0
            tf[some] = 1 + np.log(tf[some])
            tf *= self.idf
            norm = np.sqrt((tf * tf).sum(axis=1) + counts[:, -1] * self.rare**2)
            size = np.log2(np.maximum(counts.sum(axis=1), 1)).astype(int).clip(0, SIZES - 1)
            yield first, tf / np.maximum(norm, 1e-9)[:, None].astype(np.float32), letters, size

    def predict(self, texts: Iterable[str | None]) -> tuple[list[str], list[float], list[bool]]:
        """Language, cosine, and whether it is too small, for each text."""
        lang, score, far = [], [], []
        for _, vectors, letters, size in self.vectors(texts):
            if not len(self.langs):
                lang += [UNKNOWN] * len(vectors)
                score += [0.0] * len(vectors)
                far += [True] * len(vectors)
                continue
            cosines = vectors @ self.centroids.T
            best = cosines.argmax(axis=1)
            top = np.clip(cosines[np.arange(len(best)), best], 0, 1)
            lang += [self.langs[b] if ok else UNKNOWN for b, ok in zip(best, letters, strict=True)]
            score += np.where(letters, top, 0).tolist()
            far += (~letters | (top < self.floors[best, size])).tolist()
        return lang, score, far


def _clusters(unit: np.ndarray) -> np.ndarray:
    """Spherical k-means, begun from the mean and the rows farthest from what is chosen."""
    centre = unit.mean(axis=0)
    chosen = [centre / max(np.linalg.norm(centre), 1e-9)]
    for _ in range(min(CLUSTERS, len(unit)) - 1):
        near = (unit @ np.stack(chosen).T).max(axis=1)
        # a row at the lower quartile, since the farthest ones are odd texts
        chosen.append(unit[np.argsort(near, kind="stable")[len(near) // 4]])
    centroids = np.stack(chosen)
    for _ in range(ROUNDS):
        nearest = (unit @ centroids.T).argmax(axis=1)
        new = [unit[nearest == k].mean(axis=0) for k in range(len(centroids)) if (nearest == k).any()]
        new = np.stack([c / max(np.linalg.norm(c), 1e-9) for c in new])
        if new.shape == centroids.shape and np.allclose(new, centroids, atol=1e-6):
            break
        centroids = new
    return centroids


def floors(near: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The least cosine to accept for each size of a text, from cosines of held-out texts of one
    language: a low quantile, less a margin, so that clean texts of that size stay. Where odd rows
    pull it down, the median holds it up. Sizes that are larger than any take the last one."""
    found, last = np.zeros(SIZES), 0.0
    for k in range(SIZES):
        own = near[size == k]
        if len(own) >= ENOUGH:
            low, middle = np.quantile(own, [LOW, 0.5])
            last = float(max(OF_LOW * low, OF_MEDIAN * middle))
        elif len(own) and not last:
            last = float(own.min()) / 2
        found[k] = last
    return found


def train(docs: DataFrame, text: str = "text", lang: str = "lang", spread: Column | None = None) -> Model:
    """A model of the rows of ``docs`` that have a language and a text.

    Document frequencies come from all of them. Grams are taken by their place among those of each
    language, at least ``LEAST`` of each and ``GRAMS`` together. The centroids of a language are fitted to a sample
    of about ``SAMPLE`` of its distinct texts, all if it has no more, those with the smallest hash of ``spread`` (the text, if not
    given). The least cosine that a language accepts follows the size of a text: it is set from sample
    rows, whole and cut short, against centroids fitted to the other half of the sample (``floors``).
    Rows without a letter teach nothing. Without rows the model knows no language.
    """
    spread = F.col(text) if spread is None else spread
    rows = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"), F.xxhash64(spread).alias("h")
    )

    def frequencies(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[str, np.ndarray] = {}  # the last place counts rows

        def counted() -> Iterator[pd.DataFrame]:
            for name, n in found.items():
                some = np.flatnonzero(n)
                yield pd.DataFrame({"lang": name, "gram": np.where(some < 1 << HASH_BITS, some, -1), "n": n[some]})
            found.clear()

        for frame in frames:
            names = frame["lang"].to_numpy()
            for first, pieces in _blocks(frame["text"]):
                seen = [np.unique((r << HASH_BITS) | g) for r, g, _ in _hashed(pieces)]
                seen = np.unique(np.concatenate(seen)) if len(seen) > 1 else seen[0]
                codes, own = pd.factorize(names[first : first + pieces[-1][0] + 1])
                of = codes[seen >> HASH_BITS]
                for k, name in enumerate(own):
                    if name not in found:
                        if len(found) >= 64:
                            yield from counted()
                        found[name] = np.zeros((1 << HASH_BITS) + 1, np.int64)
                    grams = seen[of == k] & ((1 << HASH_BITS) - 1)
                    found[name][:-1] += np.bincount(grams, minlength=1 << HASH_BITS)
                    found[name][-1] += int((codes == k).sum())
        yield from counted()

    texts = rows.select("lang", "h").distinct()  # copies of a text are in the sample together
    counts = {r["lang"]: r["count"] for r in texts.groupBy("lang").count().collect()}
    df = rows.select("lang", "text").mapInPandas(frequencies, "lang string, gram long, n long")
    df = df.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # the grams of a language by their place in it, so that those of a rare one aren't crowded out
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("gram") >= 0, F.desc("n"), "gram"))
    df = df.withColumn("all", F.sum("n").over(Window.partitionBy("gram"))).withColumn("rank", rank).where(F.col("rank") <= GRAMS + 1)
    df = df.groupBy("gram").agg(F.min("rank").alias("rank"), F.max("all").alias("n"))
    top = df.orderBy("rank", F.col("gram") >= 0, F.desc("n"), "gram").limit(max(GRAMS, LEAST * len(counts)) + 1).collect()
    top = [r for k, r in enumerate(top) if k <= GRAMS or r["rank"] <= LEAST + 1]
    total = next((r["n"] for r in top if r["gram"] < 0), 0)
    top = [r for r in top if r["gram"] >= 0]
    place = np.full(1 << HASH_BITS, len(top), np.int64)
    place[[r["gram"] for r in top]] = np.arange(len(top))
    idf = np.log((1 + total) / (1 + np.array([r["n"] for r in top], float))).astype(np.float32) + np.float32(1)
    model = Model(place, idf, float(np.log(1 + total) + 1) if total else 1.0, [], np.zeros((0, len(top)), np.float32), np.zeros((0, SIZES)))
    if not counts or not top:
        return model
    share = F.create_map(*[F.lit(x) for name, c in sorted(counts.items()) for x in (name, min(1.0, SAMPLE / c))])
    part = (F.shiftrightunsigned("h", 1) / float(1 << 63)) <= F.element_at(share, F.col("lang"))

    def sparse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        taken = set()  # what this task has sent: about a sample of each language
        for frame in frames:
            new = [x not in taken and not taken.add(x) for x in zip(frame["lang"], frame["h"], strict=True)]
            frame = frame[new]
            names, hashes = frame["lang"].to_numpy(), frame["h"].to_numpy()
            cuts = []  # (row, number of halvings, text): whole, and some of the beginnings
            for k, text in enumerate(frame["text"]):
                cuts.append((k, 0, text))
                halvings = range(1, max(1, len(text).bit_length() - 2))
                cuts += [(k, j, text[: len(text) >> j]) for j in halvings if (int(hashes[k]) + j) % 2]
            for first, vectors, letters, size in model.vectors(c[2] for c in cuts):
                out = []
                for at in np.flatnonzero(letters):
                    k, j, _ = cuts[first + at]
                    some = np.flatnonzero(vectors[at])
                    out.append((names[k], hashes[k], j, size[at], some.astype(np.int32), vectors[at, some]))
                yield pd.DataFrame(out, columns=["lang", "h", "cut", "size", "at", "weight"])

    # rows with one hash teach once, so that a table of repeated rows gives no larger sample
    taught = rows.where(part).mapInPandas(sparse, "lang string, h long, cut int, size int, at array<int>, weight array<float>")
    taught = taught.groupBy("lang", "h", "cut").agg(F.first(F.struct("size", "at", "weight")).alias("v")).select("lang", "h", "cut", "v.*")
    wide = len(top)

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["h", "cut"])
        order = np.unique(frame["h"].to_numpy(), return_inverse=True)[1]
        frame, order = frame[order < 2 * SAMPLE], order[order < 2 * SAMPLE]
        whole = frame["cut"].to_numpy() == 0
        unit = np.zeros((int(whole.sum()), wide), np.float32)
        for k, (at, weight) in enumerate(zip(frame["at"][whole], frame["weight"][whole], strict=True)):
            unit[k, at] = weight
        half = order[whole] % 2
        other = [_clusters(unit[half == k] if (half == k).any() else unit) for k in (1, 0)]
        rows = zip(order % 2, frame["at"], frame["weight"], strict=True)
        near = np.array([(other[k][:, at] @ weight).max() for k, at, weight in rows])
        centroids = _clusters(unit)
        least = floors(near, frame["size"].to_numpy())
        return pd.DataFrame({"lang": frame["lang"].iloc[0], "centroid": list(centroids.astype(np.float32)), "floors": [least] * len(centroids)})

    fitted = taught.groupBy("lang").applyInPandas(fit, "lang string, centroid array<float>, floors array<double>").collect()
    fitted = sorted(fitted, key=lambda r: (r["lang"], r["centroid"]))
    if fitted:
        model.langs = [r["lang"] for r in fitted]
        model.centroids = np.array([r["centroid"] for r in fitted], np.float32)
        model.floors = np.array([r["floors"] for r in fitted])
    return model


def identified(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` without its texts and with ``lang_pred``, ``score`` (the cosine to the nearest
    centroid) and ``rejected`` (farther from it than the sample it was fitted to allows).

    Null texts and texts without a letter are ``und`` with score 0 and are rejected, and so is
    everything where the model knows no language. Ties go to the first language by name. Long texts
    are read in pieces; repeated rows get equal results; columns called like a result are replaced.
    """
    docs = without(docs, {"lang_pred", "score", "rejected"} - {text})
    sent = docs.sparkSession.sparkContext.broadcast(model)  # GRAMS floats for each centroid

    def work(texts: list[str | None]) -> list:
        return sent.value.predict(texts)

    return extended(docs, text, "lang_pred string, score double, rejected boolean", work)


def accepted(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model doesn't reject, with all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return filtered(docs, text, lambda texts: ~np.asarray(sent.value.predict(texts)[2]))
