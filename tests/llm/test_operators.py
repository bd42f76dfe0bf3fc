"""Every operator against a brute-force version, on tables that hold the odd cases."""

import base64
import hashlib
import json
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lexcorpus.llm import (
    chat, decontaminate, embed_dedup, lang_id, minhash, packing, queries, sharding, simhash, store, suffix_dedup, suffix_tree_lm,
    tokens, toxicity,
)
from lexcorpus.llm.components import components
from tests.llm.helpers import DOCS, frame, key, odd_docs, prose

LANGS = {"aa": "abcdefghij", "bb": "klmnopqrst", "cc": "uvwxyzéñöü"}


@pytest.fixture(scope="module")
def odd(spark):
    return store.stored(frame(spark, odd_docs()), "odd")


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [], DOCS)


def clashing(df, *names):
    return df.withColumns({n: F.lit("x") for n in names})


# sharding


def test_shards(spark, odd):
    got = sharding.shuffled_shards(clashing(odd, "ROW", "shard", "_at", "_part"), ["doc_id", "text"], 3).collect()
    assert sorted(r["row"] for r in got) == list(range(len(got))) and len(got) == odd.count()
    sizes = Counter(r["shard"] for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and set(sizes) == {0, 1, 2}
    for shard, n in sizes.items():
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(n))
    for r in got:
        assert sharding.row_at(np.array([r["shard"]]), np.array([r["slot"]]), len(got), 3) == [r["row"]]
    assert {r["_at"] for r in got} == {"x"}
    again = sharding.shuffled_shards(odd.repartition(5), ["doc_id", "text"], 3).collect()
    place = lambda rows: sorted(key((r["doc_id"], r["text"], r["shard"], r["slot"])) for r in rows)
    assert place(got) == place(again)


def test_no_rows_no_shards(empty):
    assert sharding.shuffled_shards(empty, ["doc_id"], 3).count() == 0


# chat


def test_chat_reads_back(spark):
    own = "<|im_end|><|im_start|>assistant ok"
    rows = [
        (1, 0, "user", "a<\\|b"), (1, 1, "assistant", own), (1, 1, "assistant", own), (1, None, "system", None),
        (2, 0, None, ""), (2, 1, "as\nsistant\\", "x" * 5000), (None, 0, "assistant", "é😀"), (3, 2, "assistant", ""),
    ]
    table = frame(spark, rows, "conv_id long, turn long, role string, text string")
    pieces = chat.rendered(chat.fold(chat.events_of(clashing(table, "seq", "kind"))))
    got = {r["conv_id"]: r for r in chat.digests(pieces).collect()}
    assert set(got) == {1, 2, 3, None}
    for conv, r in got.items():
        own_rows = sorted((x for x in rows if x[0] == conv), key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or ""))
        turns = "".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in own_rows)
        loss = "".join(x[3] or "" for x in own_rows if x[2] == "assistant")
        assert r["n_turns"] == len(own_rows)
        assert r["turns_sha256"] == hashlib.sha256(turns.encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    lengths = {r["conv_id"]: r["n"] for r in pieces.groupBy("conv_id").agg(F.sum(F.char_length("piece")).alias("n")).collect()}
    assert lengths == {c: r["formatted_chars"] for c, r in got.items()}


def test_fold_follows_the_log(spark):
    log = [
        (1, 0, 0, 0, "open", "user", None), (1, 0, 0, 2, "delta", None, "b"), (1, 0, 0, 1, "delta", None, "a"),
        (1, 1, 0, 3, "open", "assistant", None), (1, 1, 0, 4, "delta", None, "wrong"), (1, 1, 0, 5, "regenerate", None, None),
        (1, 1, 0, 6, "delta", None, "ri"), (1, 1, 0, 7, "delta", None, "ght"), (1, 0, 0, 9, "edit", None, "c"),
        (1, 0, 0, 10, "delta", None, "d"), (2, 0, 0, 0, "delta", None, "x"), (2, 0, 0, 1, "other", None, "y"),
    ]
    events = frame(spark, log, "conv_id long, turn long, copy long, seq long, kind string, role string, text string")
    got = sorted((r["conv_id"], r["turn"], r["role"], r["text"]) for r in chat.fold(events).collect())
    assert got == [(1, 0, "user", "cd"), (1, 1, "assistant", "right"), (2, 0, "", "x")]
    assert chat.digests(chat.rendered(chat.fold(events.limit(0)))).count() == 0


# links


def union(links, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 60, (40, 2))] + [(i, i + 1) for i in range(1000, 1012)] + [(2000, i) for i in range(2001, 2050)]
    got = {r["node"]: r["root"] for r in components(frame(spark, links, "x long, y long"), "x", "y").collect()}
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert got == union([x for x in links if x[0] != x[1]], nodes)
    assert components(frame(spark, [], "x long, y long"), "x", "y").count() == 0


@pytest.mark.parametrize("bucket", [2048, 30])
def test_simhash_links_lose_nothing(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rng = np.random.default_rng(4)
    base = rng.integers(-(1 << 63), 1 << 63, 40)
    values = set(base.tolist())
    for v in [*base[:25], *[base[0]] * 45]:
        for b in rng.choice(64, rng.integers(1, 4), replace=False):
            v = int(np.int64(v) ^ np.array(1 << int(b), np.uint64).view(np.int64))
            values.add(v)
    values = sorted(values)
    prints = frame(spark, [(v,) for v in values], "fp long")
    got = {r["node"]: r["root"] for r in components(simhash.linked(prints, 2), "a", "b").collect()}
    u = np.array(values).view(np.uint64)
    pairs = [(values[i], values[j]) for i in range(len(u)) for j in range(i) if bin(int(u[i] ^ u[j])).count("1") <= 2]
    want = union(pairs, values)
    assert {v: got.get(v, v) for v in values} == want


def test_simhash_groups(spark, odd, empty):
    got = simhash.near_duplicates(clashing(odd, "Fingerprint", "_fp")).collect()
    texts = defaultdict(set)
    for r in odd.collect():
        texts[simhash.fingerprint(r["text"])].add(r["doc_id"])
    assert len(got) == odd.count()
    prints = list(texts)
    roots = union([(a, b) for a in prints for b in prints if bin(a ^ b).count("1") <= 2], prints)
    for r in got:
        ids = {i for p in prints if roots[p] == roots[int(r["fingerprint"], 16)] for i in texts[p] if i is not None}
        assert r["component_id"] == min(ids, default=None)
    kept = simhash.one_of_each(odd).collect()
    assert len(kept) == len(set(roots.values())) and kept[0].asDict().keys() == set(odd.columns)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.one_of_each(empty).count() == 0


@pytest.mark.parametrize("small", [16, 1])
def test_edited_copies_by_comparing_shingles(spark, monkeypatch, odd, empty, small):
    monkeypatch.setattr(minhash, "SMALL", small)
    rng = np.random.default_rng(8)
    texts = [prose(100 + i, 60) for i in range(12)] + ["one two", "One  two", "", None]
    for i in [*range(12), *[0] * 40, *[1] * 10]:
        words = texts[i].split()
        for at in rng.choice(len(words), rng.integers(1, 4), replace=False):
            words[at] = f"edit{rng.integers(1000)}"
        texts.append(" ".join(words))
    rows = list(enumerate(texts)) + [(3, texts[3])]

    def plain(text):
        words = (text or "").lower().split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    sets = [plain(t) for t in texts]
    alike = lambda a, b: a == b or len(a & b) >= 0.8 * len(a | b)
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if alike(sets[i], sets[j])]
    far = [x for x in pairs if bin(simhash.fingerprint(texts[x[0]]) ^ simhash.fingerprint(texts[x[1]])).count("1") > 2]
    assert len(far) > len(pairs) / 2
    got = minhash.one_of_each(frame(spark, rows, "doc_id long, text string")).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(set(union(pairs, range(len(texts))).values()))
    kept = corpus_pipeline.near_duplicates(spark, odd, "").collect()
    assert {r["doc_id"] for r in kept} == {1, 4, 7, 8, 9, 10, 11} | {r["doc_id"] for r in kept if r["doc_id"] is None}
    assert kept[0].asDict().keys() == set(odd.columns) and minhash.one_of_each(empty).count() == 0


def test_vectors(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((40, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    for i in range(120):
        rows.append((100 + i, (base[i % 30] + rng.standard_normal(16) * 0.2).tolist()))
    rows += [(300, (base[0] * 7).tolist()), (301, base[0].tolist()), (302, base[0].tolist())]
    odd = [(400, None), (401, []), (402, [0.0] * 16), (403, [None, *[1.0] * 15]), (404, [math.nan] * 16), (405, [math.inf, *[1.0] * 15])]
    other = [(500, [1.0, 2.0]), (501, [1.0, 2.0]), (None, base[1].tolist()), (None, [5.0, -1.0, 0.0])]
    table = frame(spark, rows + odd + other, "vec_id long, embedding array<double>")
    got = embed_dedup.near_vectors(clashing(table, "label", "class")).collect()
    assert len(got) == len(rows + odd + other)
    sound = [r for r in rows + other if r[1]]
    n, links = Counter(), []
    for x, (a, v) in enumerate(sound):
        for y, (b, w) in enumerate(sound):
            if x != y and len(v) == len(w) and np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w) >= 0.9:
                n[x] += 1
                links.append((x, y))
    roots = union(links, range(len(sound)))
    want = Counter()
    for x, (a, _) in enumerate(sound):
        low = min((sound[y][0] for y in roots if roots[y] == roots[x] and sound[y][0] is not None), default=None)
        want[a, n[x], low, a is not None and a == low] += 1
    want.update((a, 0, a, True) for a, _ in odd)
    assert Counter(tuple(r) for r in got) == want
    none = embed_dedup.near_vectors(table.where("vec_id between 400 and 405")).collect()
    assert {tuple(r) for r in none} == {(i, 0, i, True) for i in range(400, 406)}
    assert embed_dedup.near_vectors(table.limit(0)).count() == 0


def test_vectors_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "BLOCK", 8)
    rng = np.random.default_rng(6)
    base = rng.standard_normal(16)
    rows = [(i, (base + rng.standard_normal(16) * 0.28).tolist()) for i in range(150)]
    got = {r["vec_id"]: r for r in embed_dedup.near_vectors(frame(spark, rows, "vec_id long, embedding array<double>")).collect()}
    unit = np.array([v for _, v in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    found = sum(r["n_links"] for r in got.values())
    assert 0.98 * (near.sum() - 150) <= found <= near.sum() - 150


# repeated strings


def removed(texts):
    """For each text the mask of bytes that a repeated window covers, window by window."""
    seen, masks = defaultdict(list), [np.zeros(len(t), bool) for t in texts]
    for k, t in enumerate(texts):
        for i in range(len(t) - suffix_dedup.LENGTH + 1):
            seen[t[i : i + suffix_dedup.LENGTH]].append((k, i))
    for places in seen.values():
        if len(places) > 1:
            for k, i in places:
                masks[k][i : i + suffix_dedup.LENGTH] = True
    return masks


def repeated_docs():
    a, b, c = prose(20, 90), prose(21, 60), prose(22, 100, "éñxyzüäöab")
    rows = odd_docs()
    rows += [
        (20, a, "aa", "s", 1), (21, "x" + a[50:400] + "y", "aa", "s", 1), (22, a[100:300] + b, None, "s", 1),
        (23, a[100:299] + "Q" + b[:250], None, "s", 1), (24, c, "s", "s", 1), (25, "é" + c[31:260] + "ñ", "s", "s", 1),
        (26, "ab" * 300, "s", "s", 1), (27, "k" * 199, "s", "s", 1), (28, "k" * 200, "s", "s", 1), (29, "z" * 201, "s", "s", 1),
    ]
    rng = np.random.default_rng(7)
    shared = prose(23, 70)
    for k in range(25):  # many surroundings of one passage
        lo, hi = rng.integers(0, 60), rng.integers(300, len(shared))
        rows.append((40 + k, prose(100 + k, 4) + shared[lo:hi] + prose(200 + k, 4), "s", "s", 1))
    return rows


@pytest.mark.parametrize("hot,group", [(4096, 4_000_000), (3, 700)])
def test_repeated_strings(spark, monkeypatch, hot, group):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup.T, "GROUP_BYTES", group)
    rows = [r for r in repeated_docs() if group > 1000 or len(r[1] or "") < 9000]
    texts = [(r[1] or "").encode() for r in rows]
    masks = removed(texts)
    want = Counter()
    for r, t, m in zip(rows, texts, masks, strict=True):
        kept = np.frombuffer(t, np.uint8)[~m].tobytes()
        spans = int((np.diff(np.concatenate([[0], m.astype(int), [0]])) == 1).sum())
        want[r[0], len(t), int(m.sum()), spans, hashlib.sha256(kept).hexdigest()] += 1
    table = frame(spark, rows)
    got = suffix_dedup.deduplicated(clashing(table, "N_bytes", "k1", "_spans")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert Counter(tuple(r) for r in got.collect()) == want


def test_cleaned_texts_stay_texts(spark, empty):
    rows = repeated_docs()
    got = Counter((r["doc_id"], r["text"]) for r in suffix_dedup.cleaned(frame(spark, rows)).collect())
    want = Counter()
    for r, mask in zip(rows, removed([(r[1] or "").encode() for r in rows]), strict=True):
        if r[1] is None:
            want[r[0], None] += 1
            continue
        out, at = [], 0
        for ch in r[1]:
            n = len(ch.encode())
            if not mask[at : at + n].all():
                out.append(ch)
            at += n
        want[r[0], "".join(out)] += 1
    assert got == want
    assert suffix_dedup.cleaned(empty).count() == 0 and suffix_dedup.deduplicated(empty).count() == 0


def test_a_row_repeated_many_times_has_its_spans_once(spark):
    text = " ".join(prose(k, 8) for k in range(60))
    rows = spark.range(20_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit(text).alias("text"))
    rows = rows.unionAll(frame(spark, [(8, text + prose(900, 20), "s", "s", 1)]).select("doc_id", "text"))
    got = suffix_dedup.deduplicated(rows).groupBy("doc_id", "n_bytes", "n_removed", "n_spans").count().collect()
    assert sorted(map(tuple, got)) == [(7, len(text), len(text), 1, 20_000), (8, len(text + prose(900, 20)), len(text), 1, 1)]


# benchmark


def held_whole(text, item):
    return any(text[i : i + len(item)] == item for i in range(len(text) - len(item) + 1))


def all_leaks(rows, items):
    """Every document tiled with every item, without seeds."""
    want = Counter()
    for doc_id, text, *_ in rows:
        for item_id, item in items:
            hashes, cuts = decontaminate.words([(text or "").encode(), (item or "").encode()])
            x, y = hashes[: cuts[1]].tolist(), hashes[cuts[1] :].tolist()
            if not x or not y or len(x) > 3000:
                continue
            if len(y) < decontaminate.MIN_MATCH:
                size = len(y) * held_whole(x, y)
            else:
                size = sum(t[2] for t in decontaminate.tiles(x, y))
            if size and size >= decontaminate.COVERED * len(y):
                want[doc_id, item_id, round(size / len(y), 6)] += 1
    return want


def found_leaks(docs, bench):
    return Counter((r["doc_id"], r["item_id"], round(r["coverage"], 6)) for r in decontaminate.leaks(docs, bench).collect())


def test_leaks_by_tiling_all_pairs(spark, odd, empty):
    items = [
        (1, prose(50, 30)), (2, prose(51, 25)), (3, "one two"), (4, None), (None, prose(52, 20)), (5, ""),
        (6, prose(50, 30)), (6, prose(51, 25).upper()), (7, "-- !"), (8, "zebra"), (9, "word word word"), (10, "日本語 テキスト"),
    ]
    a, b = items[0][1].split(), items[1][1].split()
    rows = odd_docs() + [
        (60, prose(70, 40) + " " + items[0][1].upper() + ". " + prose(71, 40), "s", "s", 1),
        (61, " ".join(a[15:]) + " " + prose(72, 3) + " " + " ".join(a[:15]), "s", "s", 1),
        (62, " ".join(a[:12]), "s", "s", 1), (63, "one, Two", "s", "s", 1), (64, " ".join(a + b), "s", "s", 1),
        (65, items[4][1], "s", "s", 1), (65, items[4][1], "s", "s", 1), (66, " ".join(a[:10] + ["zz"] + a[10:20]), "s", "s", 1),
        (67, "two one", "s", "s", 1), (68, "a Zebra", "s", "s", 1), (69, "one", "s", "s", 1), (70, "two", "s", "s", 1),
    ]
    docs, bench = frame(spark, rows), clashing(frame(spark, items, "item_id long, text string"), "at", "item", "tokens", "k1", "seed")
    want = all_leaks(rows, items)
    assert {d for d, *_ in want} == {8, 11, 60, 61, 63, 64, 65, 66, 68} and want[65, None, 1.0] == 2 and want[60, 6, 1.0] == 1
    assert found_leaks(clashing(docs, "tiles", "k1", "starts", "item_id"), bench) == want
    more = clashing(docs, "tiles", "k1", "_k1", "_K2", "starts", "item_id")
    left = decontaminate.clean(more, bench)
    assert left.columns == more.columns and left.schema == more.schema
    leaking = {d for d, *_ in want}
    assert Counter(r["doc_id"] for r in left.collect()) == Counter(r[0] for r in rows if r[0] not in leaking)
    assert found_leaks(empty, bench) == found_leaks(docs, bench.limit(0)) == Counter()
    assert decontaminate.clean(docs, bench.limit(0)).count() == len(rows) and decontaminate.clean(empty, bench).count() == 0


def test_leaks_of_items_that_share_most_seeds(spark):
    """Texts and items of very few words, so that nearly all seeds are common and repeat."""
    import random

    rng = random.Random(9)
    say = lambda n: " ".join(rng.choices("abc", k=n))
    items = [(i, say(rng.randint(1, 14))) for i in range(60)]
    rows = [(i, say(rng.randint(1, 40)), "s", "s", 1) for i in range(40)]
    rows += [(100 + i, say(9) + " " + " ".join(t.split()[len(t) // 4 :] + t.split()[: len(t) // 4]), "s", "s", 1) for i, t in items[:20]]
    want = all_leaks(rows, items)
    assert found_leaks(frame(spark, rows), frame(spark, items, "item_id long, text string")) == want
    assert len(want) > 300


def test_a_phrase_in_many_items_makes_no_pairs(spark, monkeypatch):
    """Texts that hold only what all items share meet none of them."""
    phrase = prose(40, 8)
    items = [(i, f"{phrase} {prose(1000 + i, 22)}") for i in range(2000)]
    rows = [(i, " ".join([prose(5000 + i, 9), phrase] * 10), "s", "s", 1) for i in range(30)] + [(99, items[7][1], "s", "s", 1)]
    sizes, tiled = [], decontaminate._tiled
    monkeypatch.setattr(decontaminate, "_tiled", lambda pairs, share: (sizes.append(pairs.count()), tiled(pairs, share))[1])
    assert found_leaks(frame(spark, rows), frame(spark, items, "item_id long, text string")) == Counter({(99, 7, 1.0): 1})
    assert sizes == [1]


# language


@pytest.fixture(scope="module")
def spoken(spark):
    rows = [(i, prose(i, 5 + i % 60, LANGS[lang]), lang, "s", 1) for i, lang in enumerate(["aa", "bb", "cc"] * 60)]
    return store.stored(frame(spark, rows), "spoken")


def test_languages(spark, spoken, odd, empty):
    model = lang_id.train(spoken.where(queries.remainder(5) != 0))
    got = lang_id.identified(clashing(spoken, "Score", "rejected"), model).collect()
    assert all(r["lang_pred"] == r["lang"] and 0 <= r["score"] <= 1 and not r["rejected"] for r in got) and len(got) == 180
    rows = {(r["doc_id"], r["n_chars"]): r for r in lang_id.identified(odd, model).collect()}
    assert [rows[k]["lang_pred"] for k in ((4, 0), (5, 0), (6, 0))] == ["und"] * 3
    assert rows[1, 1]["lang_pred"] == rows[10, 5]["lang_pred"] == "aa" and rows[9, 5]["lang_pred"] == "bb"
    assert rows[8, 9]["rejected"] and rows[4, 0]["rejected"] and rows[4, 0]["score"] == 0
    kept = {r["doc_id"] for r in lang_id.accepted(odd, model).collect()}
    assert {1, 2, 9, 10} <= kept and not {4, 5, 6, 8} & kept
    assert lang_id.identified(empty, model).count() == 0
    none = lang_id.identified(odd, lang_id.train(empty)).collect()
    assert {r["lang_pred"] for r in none} == {"und"} and len(none) == odd.count()


WORDS = {
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man sein wurde sei",
    "en": "the of and to in is that it was for on are as with his they at be this have from or one had by word but not what all were we when your can said there use an each which she do how their if will up other about out many then them these so some her would",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha me si sin sobre este ya entre cuando todo esta ser son dos también fue había era muy años hasta desde está mi porque qué sólo han yo hay vez puede todos",
}
FOREIGN = {
    "it": "Il governo ha approvato ieri una nuova legge sulla protezione della natura e delle acque, che entrerà in vigore nel prossimo anno.",
    "fi": "Hallitus hyväksyi eilen uuden lain luonnon ja vesien suojelusta, joka tulee voimaan ensi vuonna julkaisemisen jälkeen.",
    "tr": "Hükümet dün doğanın ve suların korunmasına ilişkin yeni bir yasayı onayladı; yasa gelecek yıl yürürlüğe girecek.",
    "pl": "Rząd przyjął wczoraj nową ustawę o ochronie przyrody i wód, która wejdzie w życie w przyszłym roku po jej ogłoszeniu.",
}


def test_unknown_languages_and_noise_are_rejected(spark):
    rng = np.random.default_rng(9)
    say = lambda lang, n: " ".join(rng.choice(WORDS[lang].split(), n))
    rows = [(i, say(lang, 4 + i % 90), lang, "s", 1) for i, lang in enumerate(["de", "en", "es"] * 150)]
    rows += [(1000 + i, prose(i, 60, "abcdefghijklmnopqrstuvwxyz"), "en", "s", 1) for i in range(5)]  # odd rows
    model = lang_id.train(frame(spark, rows))
    noise = [prose(50, 400, "abcdefghijklmnopqrstuvwxyz"), base64.b64encode(rng.bytes(600)).decode()]
    assert model.predict([*FOREIGN.values(), *[" ".join([t] * 8) for t in FOREIGN.values()], *noise])[2] == [True] * 10
    own = [(lang, say(lang, n)) for lang in WORDS for n in (4, 6, 10, 30, 80, 200, 1000) for _ in range(20)]
    langs, _, far = model.predict([t for _, t in own])
    assert sum(far) <= len(own) // 50 and sum(a != b for a, (b, _) in zip(langs, own, strict=True)) <= len(own) // 50


def test_rare_languages_have_grams_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(lang_id, "GRAMS", 150)
    monkeypatch.setattr(lang_id, "LEAST", 50)
    rows = [(i, prose(i, 40, LANGS[lang]), lang, "s", 1) for i, lang in enumerate(["aa", "bb"] * 100)]
    rows += [(500 + i, prose(i, 40, "αβγδεζηθικ"), "el", "s", 1) for i in range(8)]
    model = lang_id.train(frame(spark, rows))
    langs, score, far = model.predict([prose(90, 40, "αβγδεζηθικ"), prose(91, 40, LANGS["aa"])])
    assert langs == ["el", "aa"] and score[0] > 0.3 and far == [False, False]


def test_copies_teach_their_language(spark, monkeypatch):
    monkeypatch.setattr(lang_id, "SAMPLE", 20)
    rows = [(i, prose(i, 40, LANGS["aa"]), "aa", "s", 1) for i in range(30)]
    rows += [(100 + i, prose(i % 3, 40, LANGS["bb"]), "bb", "s", 1) for i in range(3000)]
    model = lang_id.train(frame(spark, rows))
    assert set(model.langs) == {"aa", "bb"}
    langs, _, far = model.predict([prose(k, 40, LANGS["bb"]) for k in range(3)])
    assert langs == ["bb"] * 3 and far == [False] * 3


def test_long_texts_are_read_whole(monkeypatch, spoken):
    model = lang_id.train(spoken)
    text = prose(8, 20, LANGS["aa"]) + " " + prose(9, 400, LANGS["bb"])
    whole = next(model.vectors([text]))[1]
    monkeypatch.setattr(lang_id, "BLOCK_CHARS", 100)
    parts = next(model.vectors([text]))[1]
    assert float((whole @ parts.T)[0, 0]) > 0.98 and model.predict([text])[0] == ["bb"]


# toxicity


def test_toxicity(spark, odd, empty):
    bad = ["vilezz", "grubxx", "nastqq"]
    rows, labels = [], []
    for i in range(1200):
        text = prose(i, 30)
        if i % 6 == 0:
            text = f"{prose(i, 10)} you {bad[i % 3]} {bad[i % 2]}! {prose(i + 5000, 10)}"
        rows.append((i, text, "aa", "s", 1))
        labels.append((i, int(i % 6 == 0)))
    docs = frame(spark, rows)
    marks = frame(spark, labels + [(1, None), (None, 1), (3, 0), (9999, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, marks, queries.remainder(4) != 2)
    got = {r["doc_id"]: r["score"] for r in toxicity.scored(clashing(docs, "Score", "features"), model).collect()}
    held = [i for i in got if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all((got[i] >= 0.3) == (i % 6 == 0) for i in held) and all(0 <= s <= 1 for s in got.values())
    assert toxicity.scored(odd, model).count() == odd.count() and toxicity.scored(empty, model).count() == 0
    none = toxicity.train(docs, marks.limit(0), queries.remainder(4) != 2)
    assert {r["score"] for r in toxicity.scored(odd, none).collect()} == {0.0}


def test_features_of_pieces(monkeypatch):
    reader = toxicity.Reader({b" idiot ": 5.0, b" idio": 4.0})
    text = "You are an IDIOT! " + "soooo b4d, w o r d s " * 30
    whole = reader.features(text)
    assert dict(zip(toxicity.FEATURES, whole))["word_hits"] == 1 and len(whole) == len(toxicity.FEATURES)
    monkeypatch.setattr(toxicity, "PIECE", 100)
    assert np.allclose(whole[:9], reader.features(text)[:9])
    assert np.isfinite(reader.features(None)).all()


# language model


def test_language_model(spark, odd, empty):
    rows = odd.collect()
    model, counts = suffix_tree_lm.train(odd)
    got = suffix_tree_lm.scored(clashing(odd, "row", "n_tokens"), model, counts).collect()
    plain = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None]
    c = Counter(w for r in rows for w in plain(r["text"]))
    n, v = sum(c.values()), len(c)
    want = Counter()
    for r in rows:
        words = plain(r["text"])
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words)
        want[r["doc_id"], len(words), sum(c[w] > 0 for w in words), n, round(base, 4)] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got) == want
    assert all(r["spelled_score"] < 0 and r["score"] < 0 for r in got)
    assert suffix_tree_lm.scored(empty, model, counts).count() == 0
    model, counts = suffix_tree_lm.train(empty)
    untaught = suffix_tree_lm.scored(odd, model, counts).collect()
    assert len(untaught) == len(rows) and all(r["n_known"] == 0 and r["train_tokens"] == 0 and np.isfinite(r["score"]) for r in untaught)


def test_rare_words_are_joined(spark, monkeypatch, odd):
    model, counts = suffix_tree_lm.train(odd)
    want = sorted(key((r["doc_id"], round(r["score"], 6), round(r["spelled_score"], 6), r["n_known"])) for r in suffix_tree_lm.scored(odd, model, counts).collect())
    monkeypatch.setattr(suffix_tree_lm, "COMMON", 3)
    model, counts = suffix_tree_lm.train(odd)
    assert len(model.common) == 3
    got = sorted(key((r["doc_id"], round(r["score"], 6), round(r["spelled_score"], 6), r["n_known"])) for r in suffix_tree_lm.scored(odd, model, counts).collect())
    assert got == want


# packing


def test_packed_pieces_hold_every_token(spark, odd, empty):
    rows = odd.collect()
    got = packing.packed(clashing(odd, "start", "task", "rest")).collect()
    enc = tokens.encoder()
    want = Counter()
    for r in rows:
        ids = np.array([*enc.exact.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        want[r["doc_id"], len(ids), zlib.crc32(ids.tobytes())] += 1
    sizes, sequences = Counter(), defaultdict(list)
    for r in got:
        sizes[r["doc_id"], r["doc_tokens"]] += r["length"]
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        if r["length"] == r["doc_tokens"]:
            assert want[r["doc_id"], r["doc_tokens"], r["ids_crc32"]]
    assert sizes == Counter({(d, n): n * c for (d, n, _), c in want.items() for _ in [0]} | {}) or sum(sizes.values()) == sum(n * c for (_, n, _), c in want.items())
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= packing.WINDOW
    assert packing.packed(empty).count() == 0


def test_cut_pieces_have_their_own_checksums(spark):
    docs = frame(spark, [(i, prose(i, 300), "s", "s", 1) for i in range(12)] + [(50, prose(60, 9000), "s", "s", 1)])
    got = packing.packed(docs).collect()
    ids = dict(zip([r["doc_id"] for r in docs.collect()], tokens.token_ids([r["text"] for r in docs.collect()])))
    cover = Counter()
    for r in got:
        whole = np.append(ids[r["doc_id"]], 1).astype("<u4")
        assert r["ids_crc32"] == zlib.crc32(whole[r["start"] : r["start"] + r["length"]].tobytes())
        cover[r["doc_id"]] += r["length"]
    assert cover == {d: len(x) + 1 for d, x in ids.items()}


# pipeline and queries


def test_pipeline_stages(spark, tmp_path):
    rows = []
    for i, lang in enumerate(["aa", "bb", "cc"] * 40):
        rows.append((i, prose(i, 60, LANGS[lang]), lang, "s", 1))
    passage = prose(900, 70, LANGS["aa"])
    item = prose(901, 30, LANGS["bb"])
    rows += [
        (200, rows[0][1], "aa", "s", 1), (201, None, "aa", "s", 1), (303, "日本語テキスト" * 20, "aa", "s", 1), (203, rows[0][1], "aa", "s", 1),
        (204, prose(902, 50, LANGS["aa"]) + " " + passage, "aa", "s", 1), (205, passage + " " + prose(903, 50, LANGS["aa"]), "aa", "s", 1),
        (206, prose(904, 50, LANGS["bb"]) + " " + item, "bb", "s", 1),
    ]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    frame(spark, [(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = store.stored(stage(spark, docs, str(tmp_path)), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        seen[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    ids = {r[0] for r in rows}
    assert set(seen["language"]) == ids - {201, 303}
    assert set(seen["near_duplicates"]) == ids - {200, 201, 303, 203}
    assert passage not in seen["repeats"][204] + seen["repeats"][205] and seen["repeats"][5] == rows[5][1]
    assert set(seen["benchmark"]) == set(seen["repeats"]) - {206}
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in pieces} == set(seen["benchmark"])


def test_queries_are_registered():
    names = {n.split("_")[0] for n in queries.QUERIES}
    assert names == {f"op{i}" for i in range(1, 14)} and set(queries.ORACLES) <= set(queries.QUERIES)
    assert json.dumps(sorted(queries.ORACLES))
