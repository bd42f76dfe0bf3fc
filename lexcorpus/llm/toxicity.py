"""Toxicity scores: gradient-boosted trees over dense features, with isotonic calibration."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexcorpus.llm import texts as T
from lexcorpus.llm.batches import extended
from lexcorpus.llm.store import dropped, own_names, stored, without

SAMPLE = 40_000
LEXICON = 4000
LEAST_TEXTS, LEAST_ODDS = 3, 2.0
STEMS = (4, 5, 6)
NEAR = 40.0
PARTS = {"left": (0, 1), "right": (2, 3), "calibration": (4,)}  # folds of five
PIECE = 500_000

#: Second-person words.
SECOND = (
    "you your yours yourself u ur du dich dir dein deine deiner ihr euch tu te toi ton ta tes vous votre vos "
    "tú ti tuyo usted ustedes vosotros"
).split()

FEATURES = (
    "log_words", "word_density", "word_max", "word_hits", "stem_density", "stem_max", "stem_hits", "second_rate",
    "second_near", "capitals", "shouted", "exclaimed", "asked", "punctuation", "obfuscated", "stretched", "spaced",
    "plain_density",
)

# A-Z in lower case; ASCII that is neither letter nor digit becomes a space
_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32 for c in range(256)
)
#: Characters that stand for letters.
_LOOKALIKE = bytes.maketrans(b"0134578@$!|", b"oieastbasil")
_DISGUISED = re.compile(rb"[A-Za-z][0-9@$!|*]+[A-Za-z]")
_STRETCHED = re.compile(rb"([A-Za-z])\1\1")
_SPACED = re.compile(rb"(?:\b[A-Za-z] ){3,}[A-Za-z]\b")
_SHOUTED = re.compile(rb"\b[A-Z]{3,}\b")


def _plain(text: bytes) -> bytes:
    """The words of a text between single-byte spaces."""
    return b" " + text.translate(_WORDS) + b" "


def _terms(word: bytes) -> list[bytes]:
    """A word and its stems, as they are sought in ``_plain`` texts."""
    return [b" " + word + b" ", *[b" " + word[:n] for n in STEMS if len(word) > n]]


def lexicon(rows: DataFrame) -> dict[bytes, float]:
    """Terms that toxic texts have far more often than others, with their log odds, from ``rows``
    (text, toxic); of more than ``LEXICON`` the ones with the most evidence."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for frame in frames:
            for text, toxic in zip(frame["text"], frame["toxic"], strict=True):
                words = set(T.encoded(text).translate(_WORDS).split())
                found[int(toxic)].update({t for w in words for t in _terms(w)})
                found[int(toxic)][b""] += 1
                for side in found.values():
                    if len(side) > 500_000:
                        yield table(found)
                        found = {0: Counter(), 1: Counter()}
                        break
        yield table(found)

    def table(found: dict[int, Counter]) -> pd.DataFrame:
        terms = [*found[1], *[t for t in found[0] if t not in found[1]]]
        return pd.DataFrame({"term": terms, "bad": [found[1][t] for t in terms], "good": [found[0][t] for t in terms]})

    counts = rows.mapInPandas(count, "term binary, bad long, good long").groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    counts = stored(counts.where(F.col("bad") >= LEAST_TEXTS), "terms")
    total = counts.where(F.col("term") == F.lit(b"")).first()
    if total is None or not total["good"]:
        return {}
    odds = F.log((F.col("bad") + 0.5) / (F.col("good") + 0.5)) + float(np.log(total["good"] / total["bad"]))
    strong = counts.where(F.col("term") != F.lit(b"")).select("term", "bad", odds.alias("odds")).where(F.col("odds") >= LEAST_ODDS)
    best = strong.orderBy(F.desc(F.col("odds") * F.sqrt("bad")), "term").limit(LEXICON).collect()
    dropped(counts)
    return {bytes(r["term"]): r["odds"] for r in best}


class Reader:
    """Features of texts under a lexicon."""

    def __init__(self, terms: dict[bytes, float]):
        self.automaton = ahocorasick.Automaton()
        for term, odds in terms.items():
            kind = 1 if term.endswith(b" ") else 2
            self.automaton.add_word(term.decode("latin-1"), (kind, odds, len(term)))
        for word in SECOND:
            term = f" {word} ".encode()
            if term not in terms:
                self.automaton.add_word(term.decode("latin-1"), (3, 0.0, len(term)))
        self.automaton.make_automaton()

    def _hits(self, text: bytes) -> list[tuple[int, tuple]]:
        return list(self.automaton.iter(text.decode("latin-1")))

    def features(self, text: str | None) -> np.ndarray:
        """A row of FEATURES; rates are per word or per byte. Long texts are read in pieces."""
        data = T.encoded(text)
        counts = np.zeros(256, np.int64)
        words = shouted = disguised = stretched = spaced = 0
        totals, tops, hits, plain = np.zeros(3), np.zeros(3), np.zeros(4), 0.0
        near = np.inf
        at = 0
        while at < len(data) or at == 0:
            end = at + PIECE
            while end < len(data) and not T.SPACE[data[end]]:
                end += 1
            piece, at = data[at:end], max(end, 1)
            counts += np.bincount(np.frombuffer(piece, np.uint8), minlength=256)
            shown = _plain(piece)
            words += len(shown.split())
            shouted += len(_SHOUTED.findall(piece))
            obscured = len(_DISGUISED.findall(piece))
            disguised += obscured
            stretched += len(_STRETCHED.findall(piece))
            spaced += len(_SPACED.findall(piece))
            bad, you = [], []
            for place, (kind, odds, _) in self._hits(shown):
                if kind == 3:
                    you.append(place)
                    hits[3] += 1
                    continue
                bad.append(place)
                totals[kind] += odds
                tops[kind] = max(tops[kind], odds)
                hits[kind] += 1
            if bad and you:
                where = np.searchsorted(you, bad)
                spots = np.array([-np.inf, *you, np.inf])
                near = min(near, np.minimum(bad - spots[where], spots[where + 1] - bad).min())
            if obscured:
                clear = _plain(piece.translate(_LOOKALIKE))
                plain += sum(odds for _, (kind, odds, _) in self._hits(clear) if kind == 1)
        n, letters = max(words, 1), max(int(counts[65:91].sum() + counts[97:123].sum() + counts[128:].sum()), 1)
        signs = int(counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum())
        return np.array([
            np.log1p(words), totals[1] / n, tops[1], hits[1], totals[2] / n, tops[2], hits[2], hits[3] / n,
            0.0 if np.isinf(near) else np.exp(-near / NEAR), counts[65:91].sum() / letters, shouted / n,
            counts[33] / n, counts[63] / n, signs / n, disguised / n, stretched / n, spaced / n, plain / n,
        ])


@dataclass
class Model:
    terms: dict[bytes, float]
    trees: GBTClassificationModel | None
    curve: IsotonicRegressionModel | None
    rate: float


def _featured(docs: DataFrame, terms: dict[bytes, float], text: str, out: str) -> DataFrame:
    """``docs`` without its texts and with their feature vectors."""
    sent = docs.sparkSession.sparkContext.broadcast(terms)  # LEXICON terms at most
    held: list[Reader] = []

    def work(texts: list[str | None]) -> list:
        if not held:
            held.append(Reader(sent.value))
        return [[held[0].features(t).tolist() for t in texts]]

    return extended(docs, text, f"`{out}` array<double>", work).withColumn(out, array_to_vector(out))


def train(docs: DataFrame, labels: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """A model of the labelled documents whose ``learn`` (a condition on labels) holds.

    It is fitted to a sample of about ``SAMPLE`` of them, those with the smallest hash of their id;
    the sample's ids and labels, of that bounded size, go to the texts. A document counts as toxic
    if any of its labels says so. Texts are split by their hash into parts, so that copies stay
    together. Trees learn from two parts, each read with the lexicon of the other; the lexicon of
    both is what texts are read with later; and the third part, read so, gives the calibration. No
    part is scored with what was learned from it. Null labels and texts without a label teach
    nothing. If a part has no document of one kind, scores are the share of toxic ones.
    """
    marks = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).where(learn)
    marks = marks.groupBy(F.col(doc_id).alias("_id")).agg((F.max(label) > 0).cast("int").alias("toxic"))
    total = marks.count()
    if not total:
        return Model({}, None, None, 0.0)
    share = min(1.0, SAMPLE / total)
    marks = marks.where(F.shiftrightunsigned(F.xxhash64("_id"), 1) / float(1 << 63) < share)
    fold = F.pmod(F.xxhash64("text"), F.lit(5)).cast("int").alias("fold")
    texts = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text"))
    rows = stored(texts.join(F.broadcast(marks), "_id").select("text", "toxic", fold), "labelled")
    part = {k: F.col("fold").isin(*v) for k, v in PARTS.items()}
    sides = {(r["part"], r["toxic"]): r["count"] for r in rows.groupBy(
        F.when(part["left"], "left").when(part["right"], "right").otherwise("calibration").alias("part"), "toxic"
    ).count().collect()}
    bad = sum(n for (_, toxic), n in sides.items() if toxic)
    rate = bad / max(1, sum(sides.values()))
    if any(not sides.get((p, k)) for p in PARTS for k in (0, 1)):
        dropped(rows)
        return Model({}, None, None, rate)
    left, right, rest = (rows.where(part[p]) for p in PARTS)
    terms = lexicon(rows.where(~part["calibration"]))
    read = _featured(left, lexicon(right), "text", "features").unionAll(_featured(right, lexicon(left), "text", "features"))
    read = stored(read.unionAll(_featured(rest, terms, "text", "features")), "features")
    featured = read.coalesce(4)  # a sample of bounded size
    label_col = F.col("toxic").cast("double").alias("toxic")
    trees = GBTClassifier(labelCol="toxic", featuresCol="features", maxDepth=4, maxIter=20, stepSize=0.2, seed=7, checkpointInterval=-1)
    trees = trees.fit(featured.where(~part["calibration"]).select("features", label_col))
    raised = trees.transform(featured.where(part["calibration"]).select("features", label_col))
    raised = raised.select(vector_to_array("probability")[1].alias("p"), "toxic")
    curve = IsotonicRegression(labelCol="toxic", featuresCol="p").fit(raised)
    dropped(rows)
    return Model(terms, trees, curve, rate)


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` without its texts and with ``score``: the calibrated chance that a text is toxic.

    Texts on one step of the calibration are told apart by a hundredth of their raw probability.
    Null and empty texts get the score of a text without words. Copies get equal scores, an empty
    table stays empty, and a column called score is replaced.
    """
    docs = without(docs, {"score"} - {text})
    if model.trees is None:
        return docs.drop(text).withColumn("score", F.lit(float(model.rate)))
    vector, raw, chance, out, p, step = own_names(docs, "_features", "_raw", "_chance", "_class", "_p", "_step")
    trees = model.trees.copy().setFeaturesCol(vector).setRawPredictionCol(raw).setProbabilityCol(chance).setPredictionCol(out)
    curve = model.curve.copy().setFeaturesCol(p).setPredictionCol(step)
    rows = trees.transform(_featured(docs, model.terms, text, vector)).withColumn(p, vector_to_array(chance)[1])
    score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col(step) * 0.99 + F.col(p) * 0.01))
    return curve.transform(rows).withColumn("score", score).drop(vector, raw, chance, out, p, step)
