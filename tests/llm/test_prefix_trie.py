"""The prefix trie against a dictionary of all prefixes."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.helpers import key

from lexcorpus.llm import prefix_trie, queries
from lexcorpus.llm.store import stored

SCHEMA = "conv_id long, turn long, role string, text string"


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text))


def sequences(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}


def brute(paths):
    members, ends = defaultdict(list), defaultdict(list)
    for c, path in sorted(paths.items()):
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
        ends[tuple(path)].append(str(c))
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p in members:
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(members[p]) - 1) * words(p[-1][1]) if p else 0
    return sorted(
        (
            (m[0], len(p), members[p[:-1]][0] if p else None, len(m), len(children[p]) if p in children else 0, leaves[p], saved[p], hashlib.sha256(",".join(ends.get(p, [])).encode()).hexdigest())
            for p, m in members.items()
        ),
        key=key,
    )


def rebuilt(paths):
    out = {}
    for c, own in paths.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = paths.get(c - c % 20, [])[:h] + own[h:]
    return out


def conversations(seed, n, turns, kinds):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, turns)):
            rows.append((c, t, rng.choice(["user", "assistant"]) if kinds > 2 else "user", " ".join(["w"] * rng.randint(0, kinds))))
    return rows


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=key)


@pytest.mark.parametrize("block,first", [(4096, 32), (3, 2), (1, 1)])
def test_nodes_equal_brute_force(spark, monkeypatch, block, first):
    monkeypatch.setattr(prefix_trie, "CHAIN", 16)
    rows = conversations(1, 60, 6, 2) + [(100 + k, t, "user", "w") for k in range(25) for t in range(9)]
    rows += [(200 + k, t, "user", f"long {t}") for k in range(3) for t in range(40)] + [(202, 41, "x", "more"), (300, 0, "x", "alone")]
    rows += [(300, t, "y", f"{t}") for t in range(1, 90)]
    paths = sequences(rows)
    paths[999] = []
    turns = [(c, d + 1, f"{r}:{t}", words(t)) for c, path in paths.items() for d, (r, t) in enumerate(path)]
    df = spark.createDataFrame(turns, "conv_id long, depth long, mark string, words long").selectExpr("conv_id", "depth", "unhex(md5(mark)) mark", "words")
    convs = spark.createDataFrame([(c,) for c in paths], "conv_id long")
    assert got(prefix_trie.nodes(df, convs, first=first, block=block)) == brute(paths)


def test_trie_of_odd_rows(spark):
    rows = [
        (1, None, "user", "b"), (1, 0, None, None), (1, 0, None, None), (1, 0, "user", "tie"), (1, 0, "user", "also"), (None, 0, "user", "lost"),
        (2, None, "user", "b"), (2, 0, "", ""), (3, 5, "user", "x " * 50_000), (4, 5, "user", "x " * 50_000), (5, 5, "user", "x " * 50_001), (-7, 1, None, "b"),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS depth", "'m' AS mark", "2 AS words", "3 AS pos", "turn AS N")
    assert got(prefix_trie.trie(df)) == brute(sequences(rows))
    assert prefix_trie.trie(df.limit(0)).collect() == []


def test_rebuilt_conversations(spark):
    rows = conversations(3, 90, 5, 3)
    rows = [r for r in rows if r[0] not in (20, 21, 22)] + [(500 + k, 0, "user", "hi") for k in range(40)]
    paths = rebuilt(sequences(rows))
    turns, convs = queries.rebuilt(stored(prefix_trie.turns_of(spark.createDataFrame(rows, SCHEMA)), "t"))
    assert got(prefix_trie.nodes(turns, convs)) == brute(paths) and [] in paths.values()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-1, 4), min_size=1, max_size=60), st.data())
def test_extents(values, data):
    minima = prefix_trie.Minima(np.array(values))
    at = data.draw(st.integers(0, len(values) - 1))
    depth = data.draw(st.integers(-1, 5))
    r = at
    while r + 1 < len(values) and values[r + 1] >= depth:
        r += 1
    left = at
    while left > 0 and values[left] >= depth:
        left -= 1
    one = lambda x: np.array([x])
    assert minima.right(one(at), one(depth)).tolist() == [r] and minima.left(one(at), one(depth)).tolist() == [left]
    assert minima.least(one(left), one(r)).tolist() == [min(values[left : r + 1])]


def test_ids_of_a_large_group_are_joined_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 50)
    members = spark.range(3000).selectExpr("id * 7 - 50 AS conv_id", "1L AS n", "id % 3 DIV 2 AS f1", "0L AS f2")
    want = defaultdict(list)
    for r in sorted(members.collect()):
        want[r["f1"]].append(r["conv_id"])
    found = {r["rep"]: r["ends"] for r in prefix_trie._digests(members).collect()}
    assert found == {v[0]: hashlib.sha256(",".join(map(str, v)).encode()).hexdigest() for v in want.values()}
