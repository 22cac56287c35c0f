"""The trie's parentheses, SimHash's posting lists and the spelling tiles against plain versions, on rows that the tables lack."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docflow.llm import langid, prefix_trie, simhash, spelling, tiling
from docflow.llm.common import components
from tests.llm import brute


def test_find_close():
    rng = random.Random(1)
    for size in (1, 2, 5, 300, 2000):
        opens, depth = [], 0
        for _ in range(2 * size):
            up = depth == 0 or (rng.random() < 0.55 and len(opens) < 2 * size)
            opens.append(up)
            depth += 1 if up else -1
        opens += [False] * depth
        stack, close = [], {}
        for at, up in enumerate(opens):
            if up:
                stack.append(at)
            else:
                close[stack.pop()] = at
        places = np.array(sorted(close))
        found = prefix_trie.Parentheses(np.array(opens)).find_close(places)
        assert found.tolist() == [close[p] for p in places.tolist()]


@pytest.mark.parametrize("shard", [1, 3, 7, 10_000])
def test_spines_of_shards_merge(spark, shard):
    rng = random.Random(shard)
    parent, rows = {0: None}, [(0, 0)]
    for node in range(1, 60):
        parent[node] = rng.choice(rows)[0]
        rows.append((node, 0))
    path = lambda n: [] if n is None else [*path(parent[n]), n]
    kids = {p for p in parent.values()}
    below = {n: [m for m in parent if n in path(m)] for n in parent}
    table = [(n, 2 + n % 3, len(path(n)), 10 * n, n not in kids, [(m, len(path(m))) for m in path(n)]) for n in parent]
    frame = spark.createDataFrame(table, "conv_id long, n_convs long, top long, bytes long, childless boolean, path array<struct<id:long,top:long>>")
    found = {r.conv_id: (r.n_leaves, r.saved) for r in prefix_trie.subtree_sums(frame, shard).collect()}
    expected = {n: (sum(m not in kids for m in below[n]), sum((1 + m % 3) * 10 * m for m in below[n])) for n in parent}
    assert found == expected


def test_trie_in_segments(spark, edge, monkeypatch):
    frame = spark.read.parquet(f"{edge}/conversations.parquet")
    whole = sorted(map(str, prefix_trie.trie(frame).collect()))
    monkeypatch.setattr(prefix_trie, "SEGMENT", 4)
    monkeypatch.setattr(prefix_trie, "IDS", 2)
    assert sorted(map(str, prefix_trie.trie(frame).collect())) == whole


def test_turns_of_one_conversation_over_partitions(spark):
    rows = [(1, t, "r", str(t)) for t in range(400)] + [(2, None, None, None)] * 300
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    found = prefix_trie.numbered_turns(frame).groupBy("conv_id").agg(F.sort_array(F.collect_list("pos")).alias("pos")).collect()
    assert {r.conv_id: r.pos for r in found} == {1: list(range(1, 401)), 2: list(range(1, 301))}


def families(rng):
    prints = {rng.getrandbits(64) for _ in range(300)} | {0}
    for head in list(prints)[:40]:
        chain = head
        for _ in range(12):  # each links with the one before, the ends not with each other
            chain ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
            prints.add(chain)
    prints |= {head ^ 0b111 << rng.randrange(60) for head in list(prints)[:50]}
    return sorted(prints)


def linked(prints):
    label = {p: p for p in prints}

    def top(p):
        while label[p] != p:
            p = label[p]
        return p

    for i, p in enumerate(prints):
        for q in prints[:i]:
            if (p ^ q).bit_count() <= 2:
                a, b = sorted((top(p), top(q)))
                label[b] = a
    groups = {}
    for p in prints:
        groups.setdefault(top(p), set()).add(p)
    return {frozenset(g) for g in groups.values() if len(g) > 1}


@pytest.mark.parametrize("crowded", [simhash.CROWDED, 3])
def test_posting_lists_lose_no_link(spark, monkeypatch, crowded):
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    monkeypatch.setattr(simhash, "BLOCK", 2 if crowded == 3 else tiling.BLOCK)
    prints = families(random.Random(3))
    # A crowd that shares six bytes.
    prints = sorted({*prints, *(0xABCDEF << 40 | i << 24 | j for i in range(0, 256, 7) for j in range(9))})
    signed = np.array(prints, dtype=np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(p,) for p in signed], "print long")
    groups = {}
    for r in components(simhash.link_forest(frame)).collect():
        groups.setdefault(r.component, set()).add(r.node % (1 << 64))
    assert {frozenset(g) for g in groups.values()} == linked(prints)


def test_long_text_fingerprint(monkeypatch):
    text = " ".join(f"Word{i * i % 977}" for i in range(5000)).encode()
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "_STRETCH", 50)
    assert simhash.fingerprint(text) == whole


def near(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


@pytest.mark.parametrize("block", [tiling.BLOCK, 3])
def test_tiles_find_each_pair_once(spark, monkeypatch, block):
    rng = random.Random(5)
    found = {"".join(rng.choice("abé") for _ in range(rng.choice((7, 8, 9)))) for _ in range(900)}
    found |= {"a" * n for n in range(7, 30)} | {"a" * n + "b" for n in range(7, 30)}
    rows = [(w, rng.choice((2, 3, 30, 400))) for w in sorted(found)]
    monkeypatch.setattr(spelling, "tiled", lambda r, k, m: tiling.tiled(r, k, m, block))
    result = spelling.near_words(spark.createDataFrame(rows, "word string, n long"))
    expected = {}
    for w, _ in rows:
        others = [(-m, v) for v, m in rows if abs(len(v) - len(w)) < 2 and near(v, w)]
        if others:
            expected[w] = len(others), min(others)[1], -min(others)[0]
    assert {r.word: (r.n_near, r.best, r.best_n) for r in result.collect()} == expected


def test_roots_follow_long_chains(spark):
    forms = [(f"w{i}", f"w{i + 1}") for i in range(17)] + [("x", "w3"), ("y", "w17")]
    found = spelling.roots(spark.createDataFrame(forms, "word string, form string")).collect()
    assert {r.word: r.root for r in found} == {word: "w17" for word, _ in forms}


def test_pairs_in_tiles():
    rights = [False, False, False, True, False, False, True, True]
    a, b = [0, 0, 0, 0, 1, 1, 1, 1], [0, 0, 0, 0, 2, 2, 2, 2]
    rights[3] = False
    table = pa.table({"a": a, "b": b, "right": rights})
    for most in (1, 3, 100):
        found = [(int(x), int(y)) for i, j in tiling.pairs(table, np.array([0, 4]), most) for x, y in zip(i, j)]
        assert sorted(found) == [(0, 1), (0, 2), (0, 3), (1, 2), (1, 3), (2, 3), (4, 6), (4, 7), (5, 6), (5, 7)]


def test_grams_of_odd_texts(monkeypatch):
    texts = ["", "_", "a", "A_b", "e\u0301te\u0301 \u0301x", "ΟΔΟΣ ΣΑΣ", "İstanbul ß ﬁ", "中文 字", "1a2b", "\u0301", "x\u0301\u0301 \u0301\u0301", "🙂a🙂"]
    decode = lambda g: "".join(chr(c) for c in (g >> 42, g >> 21 & 0x1FFFFF, g & 0x1FFFFF) if c)
    for stretch in (1 << 20, 3):
        monkeypatch.setattr(langid, "_STRETCH", stretch)
        for text in [*texts, " ".join(texts) * 3]:
            found, counts = langid.counted_grams([text])
            assert {decode(int(g)): int(n) for g, n in zip(found, counts)} == dict(brute.grams(text))
            assert (np.diff(found) > 0).all()


def test_memory_of_counting_grams():
    rng = random.Random(5)
    text = "".join(rng.choices("abc déßΣς́ \n一二", k=1_500_000))
    langid._classes.cache_clear()
    tracemalloc.start()
    langid.counted_grams([text, text[:1000]])
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 50_000_000


def test_merging_of_many_distinct_grams(monkeypatch):
    rng = random.Random(6)
    text = "".join(chr(rng.choice([0x20, *range(0x4E00, 0x4E40)])) for _ in range(3000))
    whole, counts = langid.counted_grams([text])
    monkeypatch.setattr(langid, "_STRETCH", 50)
    monkeypatch.setattr(langid, "_MAX_GRAMS", 100)
    merged, again, together = [], langid._together, lambda parts: merged.append(1) or again(parts)
    monkeypatch.setattr(langid, "_together", together)
    found, n = langid.counted_grams([text])
    assert (found == whole).all() and (n == counts).all()
    assert len(merged) <= 10
