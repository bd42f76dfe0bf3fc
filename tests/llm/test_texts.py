"""Pieces that need no session."""

import random
import zlib

import numpy as np
import pytest
import xxhash

from lexcorpus.llm import chat, decontaminate, packing, sharding, simhash, suffix_dedup, suffix_tree_lm, tokens
from lexcorpus.llm.components import forest
from tests.llm.helpers import prose


def test_suffix_array_is_sorted():
    rng = random.Random(1)
    for _ in range(400):
        text = [rng.randint(1, rng.randint(1, 5)) for _ in range(rng.randint(0, 60))] + [0]
        assert suffix_array_by_sorting(text) == suffix_dedup.suffix_array(text)


def suffix_array_by_sorting(text):
    return sorted(range(len(text)), key=lambda i: text[i:])


def test_repeated_starts_by_comparing_windows():
    rng = random.Random(2)
    n, side = 60, suffix_dedup.STEP - 1
    keys = np.array([rng.randint(0, 5) for _ in range(n)])
    sides = [[rng.randint(0, 1) for _ in range(2 * side)] for _ in range(n)]
    valid = np.array([((1 << rng.randint(1, 8)) - 1) << 0 for _ in range(n)])
    pack = lambda row: sum(b << (8 * i) for i, b in enumerate(row))
    left, right = np.array([pack(s[:side]) for s in sides]), np.array([pack(s[side:]) for s in sides])
    got = suffix_dedup.repeated_starts(keys, left, right, valid)
    for x in range(n):
        for i in range(side + 1):
            own = (keys[x], tuple(sides[x][i : side]), tuple(sides[x][side : side + i]))
            others = [
                y for y in range(n) if y != x and valid[y] >> i & 1
                and (keys[y], tuple(sides[y][i : side]), tuple(sides[y][side : side + i])) == own
            ]
            assert bool(got[x] >> i & 1) == bool(valid[x] >> i & 1 and others)


def test_merged_runs():
    assert suffix_dedup.merged([(5, 9), (0, 3), (3, 4), (6, 8)]) == [(0, 4), (5, 9)]


def test_feistel_is_a_permutation_and_reverses():
    for n in (1, 2, 3, 7, 100, 1025):
        f = sharding.Feistel(n, 9)
        x = np.arange(n)
        y = f.forward(x)
        assert sorted(y.tolist()) == x.tolist()
        assert f.backward(y).tolist() == x.tolist()
    assert sharding.Feistel(1000, 1).forward(np.arange(50)).tolist() != sharding.Feistel(1000, 2).forward(np.arange(50)).tolist()


def test_fingerprint_by_counting_bits(monkeypatch):
    def plain(text):
        words = text.encode().lower().split()
        shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
        counts = [sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in shingles) for b in range(64)]
        return sum(1 << b for b in range(64) if shingles and 2 * counts[b] > len(shingles))

    texts = ["", " ", "a", "A b", "a  B\tc", prose(1, 200), "É é x", "x " * 50]
    assert [simhash.fingerprint(t) for t in texts] == [plain(t) for t in texts]
    monkeypatch.setattr(simhash, "PIECE", 10)
    assert [simhash.fingerprint(t) for t in texts] == [plain(t) for t in texts]
    assert simhash.fingerprint(None) == 0


def test_thresholds_spend_the_budget():
    cost, chosen = simhash.thresholds([[0, 10, 20, 90], [0, 1, 2, 3], [0, 50, 60, 70]], 0)
    assert sum(chosen) == 0 and cost == 3 and chosen == [-1, 2, -1]


def test_forest():
    node, root = forest(np.array([1, 2, 7]), np.array([2, 3, 8]))
    assert dict(zip(node.tolist(), root.tolist())) == {2: 1, 3: 1, 8: 7}


@pytest.mark.parametrize("text", ["", "a<|b", "<|im_end|>", "<\\|x", "<\\\\|<|", "\\<|"])
def test_escapes_reverse(text):
    import re

    escaped = re.sub(chat._CONTROL, r"<\\\1|", text)
    assert "<|" not in escaped and chat.unescaped(escaped) == text
    assert chat.read_back(f"{chat.START}user\n{escaped}{chat.END}\n") == ("user", text)


def test_tiles_catch_reordered_passages():
    item = list(range(40))
    found = decontaminate.tiles(item[20:] + [99] + item[:20], item)
    assert sorted((j, n) for _, j, n in found) == [(0, 20), (20, 20)]
    assert decontaminate.tiles([1, 2, 3, None, 4, 5, 6], [1, 2, 3, 4, 5, 6]) == []
    # the longer match takes the tokens that a shorter one would share
    assert max(n for *_, n in decontaminate.tiles([1, 2, 3, 4, 5, 6, 9, 3, 4, 5, 6, 7, 8, 1], [1, 2, 3, 4, 5, 6, 7, 8])) == 6


def test_tiles_cover_what_a_plain_search_covers():
    rng = random.Random(4)
    for _ in range(60):
        text, item = [rng.randint(0, 3) for _ in range(30)], [rng.randint(0, 3) for _ in range(12)]
        got = decontaminate.tiles(text, item, 3)
        assert sum(n for *_, n in got) == plain_tiling(text, item, 3)
        assert all(text[i : i + n] == item[j : j + n] for i, j, n in got)


def plain_tiling(text, item, least):
    free_t, free_i, total = [True] * len(text), [True] * len(item), 0
    while True:
        best = []
        for i in range(len(text)):
            for j in range(len(item)):
                n = 0
                while i + n < len(text) and j + n < len(item) and free_t[i + n] and free_i[j + n] and text[i + n] == item[j + n]:
                    n += 1
                best.append((n, -i, -j))
        n, i, j = max(best)
        if n < least:
            return total
        free_t[-i : -i + n] = free_i[-j : -j + n] = [False] * n
        total += n


def test_seeds_stay_in_their_text():
    all_known = np.full((1 << decontaminate.FILTER_BITS) // 8, 255, np.uint8)
    texts = [b"a b, C", b"", b"d", b"e f g h"]
    owner, place, seed = decontaminate.seeds_in(texts, [1, 2], all_known)
    assert sorted(zip(owner.tolist(), place.tolist())) == sorted(
        [(0, 0), (0, 1), (0, 2), (0, 0), (0, 1), (2, 0)] + [(3, i) for i in range(4)] + [(3, i) for i in range(3)]
    )
    hashes, cuts = decontaminate.words(texts)
    wanted = {int(h) for a, b in zip(cuts[:-1], cuts[1:]) for k in (1, 2) for h in decontaminate.seeds(hashes[a:b], k)}
    assert {int(h) for h in seed} == wanted
    assert [len(x) for x in decontaminate.seeds_in([], [4], all_known)] == [0, 0, 0]
    assert [len(x) for x in decontaminate.seeds_in(texts, [], all_known)] == [0, 0, 0]


def test_places_left_out_cover_too_little_for_a_leak():
    rng = np.random.default_rng(3)
    for _ in range(200):
        words, k = int(rng.integers(1, 30)), 4
        k = min(k, words)
        held = rng.integers(0, 5, words - k + 1)
        sought = decontaminate.sought_places(held, k, words, 0.6)
        inside = {w for p in np.flatnonzero(~sought) for w in range(p, p + k)}
        assert len(inside) < 0.6 * words and sought.any()
    # a common phrase of eight of thirty words is not sought, rare words beside it are
    held = np.where(np.arange(27) < 5, 100, 1)
    assert not decontaminate.sought_places(held, 4, 30, 0.6)[:5].any()
    assert decontaminate.sought_places(np.ones(1, int), 2, 2, 0.6).all()


def test_token_ids_are_the_tokenizers():
    enc = tokens.encoder()
    texts = ["", None, " a", "a b, c. d\ne\n\nf", "don't we'll x's", "日本語 и русский x y", "<|endoftext|> a b <|endoftext|>c", "é Ã × ÷ ß x",
             "\x1c\x85 x y", "a  b   c \n d", "12 34a 5 a1", prose(1, 300), "word. Next, one! two? three: four; 'tis"]
    for _ in range(2):
        got = [ids.tolist() for ids in tokens.token_ids(texts)]
        assert got == [enc.exact.encode(t or "", add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("rows", ["none", "one", "uniform", "hot", "short"])
def test_plans_place_each_rest_once(rows):
    rng = np.random.default_rng(1)
    histogram = {
        "none": np.zeros(2048, np.int64), "one": np.bincount([700], minlength=2048),
        "uniform": np.bincount(rng.integers(1, 2048, 5000), minlength=2048),
        "hot": np.bincount([*rng.integers(1, 2048, 3000), *[1500] * 1500], minlength=2048),
        "short": np.bincount(rng.integers(1, 40, 500), minlength=2048),
    }[rows]
    plan = packing.planned(histogram)
    held, seen = {}, {}
    for length, part, lo, hi, shift, first, per, base, size in plan.rows:
        for j in range(lo, hi):
            assert (length, part, j) not in seen
            seen[length, part, j] = size
            i = j - lo + shift
            held.setdefault(first + i // per, []).append((base + i % per * size, size))
    for length, count in enumerate(histogram):
        for j in range(count):
            sizes = [size for _, size in packing.parts(length)]
            cut = [seen.get((length, p + 1, j)) for p in range(len(sizes))]
            assert seen.get((length, 0, j)) == length or cut == sizes
    used = full = 0
    for pieces in held.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert at <= 2048
        used, full = used + at, full + (at if at & (at - 1) == 0 else 2048)
    assert sorted(held) == list(range(plan.sequences))
    if rows in ("uniform", "hot"):
        assert used / full > 0.97


def test_parts_add_up():
    for n in range(1, 2048):
        pieces = packing.parts(n)
        assert sum(s for _, s in pieces) == n and [a for a, _ in pieces] == np.cumsum([0, *[s for _, s in pieces]])[:-1].tolist()


def test_least_squares_matches_the_histogram():
    histogram = np.zeros(2048, np.int64)
    histogram[[500, 1548, 1024]] = [30, 30, 20]
    columns = packing.combinations(histogram)
    x = packing.least_squares(columns, histogram)
    assert (x >= 0).all()
    fit = np.zeros(2048)
    for c, v in zip(columns, x):
        np.add.at(fit, list(c), v)
    assert np.abs(fit - histogram).max() < 1


def test_tree_states_and_distributions():
    data = b"\n\n\n\nab ab ab ac\n"
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    symbol = suffix_tree_lm.symbols_of(counts)
    s = symbol[np.frombuffer(data, np.uint8)]
    code = suffix_tree_lm.codes(s).astype(np.int64)
    rows = []
    for k in range(3):
        keys, n = np.unique((code & ((1 << 6 * k) - 1)) << 6 | s[4:], return_counts=True)
        rows.append((k, keys >> 6, keys & 63, n))
    empty = np.zeros(0, np.int64)
    tree = suffix_tree_lm.tree_of([*rows, (3, empty, empty, empty), (4, empty, empty, empty)], symbol)
    chances = 10.0 ** tree.logs.astype(float)
    chances[:, suffix_tree_lm.OTHER] *= 256 - suffix_tree_lm.OTHER
    assert np.allclose(chances.sum(axis=1), 1, atol=1e-5)
    longest = tree.longest()
    a, b, z = (int(symbol[ord(c)]) for c in "abz")
    state = tree.first[1] + int(np.searchsorted(tree.contexts[1], a))
    assert longest[z << 6 | a] == longest[b << 6 | a] == state and longest[z] == 0 != longest[a]


def test_pieces_of_long_texts_agree(monkeypatch):
    text = prose(3, 400)
    whole = [p for *_, p in suffix_tree_lm.pieces([text, None, "", "x y"])]
    words = sorted(h for p in whole for h in p.hashed(*p.spans()).tolist())
    monkeypatch.setattr(suffix_tree_lm, "PIECE", 50)
    parts = [p for *_, p in suffix_tree_lm.pieces([text, None, "", "x y"])]
    assert sorted(h for p in parts for h in p.hashed(*p.spans()).tolist()) == words
    assert zlib.crc32(text.encode()) == zlib.crc32(b"".join(p.data[p.fresh].tobytes() for p in parts)[: len(text)])
