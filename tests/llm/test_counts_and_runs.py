"""Token counts against the library, and runs of words against comparing all words."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.helpers import DOCS, frame, odd_docs, prose
from tokenizers import Tokenizer

from lexcorpus.llm import periodic_runs, queries, token_counts

CLASHING = DOCS + ", N_Bytes long, n_tokens string, over_limit int, n_runs long, START string, length int, period int"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [*odd_docs(), (20, "<|endoftext|> a <|endoftext|>", "a", "s", 1), (21, "x" * 70_000, "a", "s", 1), (22, "don't  stop\n\n\nnow " * 9000, "a", "s", 1)]
    return frame(spark, [(*r, 1, "c", 2, 3, "d", 4, 5) for r in rows], CLASHING)


# token counts


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_equal_the_library(spark, odd, name):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path(name)
    got = token_counts.counted(odd, vocabulary=path, limit=100)
    assert got.columns[:4] == ["doc_id", "lang", "source", "n_chars"] and got.columns[-3:] == ["n_bytes", "n_tokens", "over_limit"]
    rows = sorted(tuple(map(str, (r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]))) for r in got.collect())
    model = sentencepiece.SentencePieceProcessor(model_file=path) if name.endswith("model") else Tokenizer.from_file(path)
    size = (lambda t: len(model.encode(t))) if name.endswith("model") else lambda t: len(model.encode(t, add_special_tokens=False).ids)
    want = [(r["doc_id"], len((r["text"] or "").encode()), size(r["text"] or "")) for r in odd.collect()]
    assert rows == sorted(tuple(map(str, (*w, w[2] > 100))) for w in want)
    assert token_counts.counted(odd.limit(0)).count() == 0


LETTERS = "ab'sdZé1٣ \n\t\r.,;!?(|<>日本、。" + chr(0xA0) + chr(0x3000) + chr(0x2009) + chr(0x85) + chr(0x301) + chr(0x1F600)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(LETTERS, min_size=1, max_size=12), st.just("<|endoftext|>")), max_size=30).map("".join), st.integers(1, 20))
def test_cuts_change_no_count(text, size):
    counter = token_counts.counter(token_counts.VOCABULARY)
    parts = list(token_counts.pieces(text, counter.whole, size))
    assert "".join(parts) == text and sum(counter.lengths(parts)) == counter.lengths([text])[0]


def test_batches_are_balanced():
    counter = token_counts.Counter(token_counts.VOCABULARY)
    sizes, plain = [], counter.lengths
    counter.lengths = lambda texts: sizes.append(sum(map(len, texts))) or plain(texts)
    counter.count([prose(1, 200_000).encode(), None, b"", *[b"one two"] * 1000, prose(2, 90_000).encode()])
    assert len(sizes) > 4 and all(s < token_counts.BATCH_BYTES + 2 * token_counts.PIECE for s in sizes)
    assert all(s >= token_counts.BATCH_BYTES for s in sizes[:-1])


# runs


def brute(words):
    """(start, length, period) of all runs, from comparing every word with that of every period."""
    n, found = len(words), {}
    for p in range(1, n // 4 + 1):
        x = 0
        while x + p < n:
            s = x
            while x + p < n and words[x] == words[x + p]:
                x += 1
            if x > s and x + p - s >= max(6, 4 * p):
                found.setdefault((s, x + p), p)
            x += 1
    return sorted((s, e - s, p) for (s, e), p in found.items())


def as_lists(found, n):
    rows = [[] for _ in range(n)]
    for i, *run in zip(*(x.tolist() for x in found)):
        rows[i].append(tuple(run))
    return rows


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 160), st.integers(1, 4), st.lists(st.tuples(st.integers(0, 160), st.integers(1, 12), st.integers(2, 9)), max_size=4), st.integers(0, 99)), max_size=6))
def test_runs_equal_brute_force(shapes):
    texts = []
    for n, kinds, repeats, seed in shapes:
        rng = random.Random(seed)
        words = [rng.randrange(kinds) for _ in range(n)]
        for at, p, times in repeats:
            for k in range(at + p, min(n, at + p * times)):
                words[k] = words[k - p]
        texts.append(words)
    got = periodic_runs.find_runs([np.array(t, np.int64) for t in texts])
    assert as_lists(got, len(texts)) == [brute(t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 3), min_size=2, max_size=300), st.integers(1, 40), st.data())
def test_common_extensions(words, period, data):
    words = np.array(words + words[-period:] * 4, np.int64)
    i, j = data.draw(st.lists(st.integers(0, len(words)), min_size=2, max_size=2, unique=True))
    length = 0
    while max(i, j) + length < len(words) and words[i + length] == words[j + length]:
        length += 1
    assert periodic_runs.Extensions(words).common(np.array([i]), np.array([j])).tolist() == [length]


def test_cover_meets_every_difference():
    for a in range(31):
        for b in range(31):
            k = periodic_runs.STEPS[a, b]
            assert {(a + k) % 31, (b + k) % 31} <= set(periodic_runs.COVER.tolist())


def test_run_query_and_jobs(spark, odd):
    rows = [*[(r["doc_id"], r["text"]) for r in odd.collect()], *[(i, prose(i, 40 + i)) for i in range(100, 180)], (300, "a b a b a b a b c c c c c c " * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    changed = [(d, bytes(t) if t is not None else None) for d, t in queries.repeating(docs).collect()]
    want, listed, used = [], [], []
    for (d, t), (_, new) in zip(rows, changed):
        words = (t or "").encode().split()
        h = 0 if d is None else zlib.crc32(str(d).encode())
        if d is not None and h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        assert (new or b"").split() == words
        numbers = {w: k for k, w in enumerate(words)}
        runs = brute([numbers[w] for w in words]) if len(words) < 3000 else None
        if runs is None:
            continue
        used.append((d, t))
        dropped = {k for s, n, p in runs for k in range(s + p, s + n)}
        best = min(((-n / p, s, p, n) for s, n, p in runs), default=None)
        best = (None,) * 4 if best is None else (best[1], best[3], best[2], 1000 * best[3] // best[2])
        text = b" ".join(w for k, w in enumerate(words) if k not in dropped)
        digest = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        want.append((d, len(runs), *best, hashlib.sha256(digest.encode()).hexdigest(), hashlib.sha256(text).hexdigest()))
        listed += [(d, *run) for run in runs]
    assert sum(w[1] for w in want) > 10
    small = queries.repeating(spark.createDataFrame(used, docs.schema))
    got = periodic_runs.summarized(small)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    named = frame(spark, [(*r, 7, "s", 8) for r in rows], "doc_id long, text string, Start long, LENGTH string, period int")
    assert periodic_runs.summarized(named).columns == [*periodic_runs.summarized(docs).columns]
    runs = periodic_runs.run_rows(small.withColumn("Start", small["doc_id"]))
    assert runs.columns == ["doc_id", "start", "length", "period"] and sorted(map(str, map(tuple, runs.collect()))) == sorted(map(str, listed))
    short = periodic_runs.collapsed(docs)
    by_id = {r["doc_id"]: r["text"] for r in short.collect()}
    assert by_id[300] == "a b c a b c a b c" and by_id[4] is None and by_id[6] == " \t\n " and by_id[11] == "word"
    for job in (periodic_runs.summarized, periodic_runs.run_rows, periodic_runs.collapsed):
        assert job(docs.limit(0)).count() == 0
