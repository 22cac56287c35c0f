"""Registered queries on the smallest tables and on tables of edge cases equal their SQL or a brute-force version."""

import hashlib
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from docflow.llm.registry import QUERIES, SQL
from tests.compare import difference
from tests.llm import brute

TABLES = ("documents", "labels", "pages", "embeddings", "conversations")
FOLDERS = ("edge", "small")


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture(params=FOLDERS)
def folder(request):
    return request.getfixturevalue(request.param)


def rows(folder, name):
    return pq.read_table(f"{folder}/{name}.parquet").to_pylist()


def run(spark, folder, name):
    return [r.asDict() for r in entry.queries()[name](spark, folder).collect()]


def tokens(name, text):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_names():
    numbers = [re.fullmatch(r"op(\d+)_\w+", n) for n in QUERIES]
    assert sorted(int(m[1]) for m in numbers) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, folder, name):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    found = entry.queries()[name](spark, folder).toPandas()
    assert len(found) and difference(found, db.execute(SQL[name]).df()) is None


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty, name):
    assert run(spark, empty, name) == []


def test_packing(spark, folder):
    found = run(spark, folder, "op2_best_fit_packing")
    expected = Counter()
    for row in rows(folder, "documents"):
        ids = tokens("word_bpe_49k.json", row["text"]) + [1]
        for piece, at in enumerate(range(0, len(ids), 4096)):
            cut = ids[at : at + 4096]
            expected[row["doc_id"], piece, at, len(cut), brute.crc(cut)] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == expected
    sequences = defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for placed in sequences.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= 4096
    assert len(sequences) <= -(-sum(r["length"] for r in found) // 4096) + 1


def test_language(spark, folder, small):
    found = run(spark, folder, "op3_language_id")
    docs = rows(folder, "documents")
    assert Counter(r["doc_id"] for r in found) == Counter(d["doc_id"] for d in docs)
    text = {d["doc_id"]: d["text"] for d in docs}
    known = {d["lang"] for d in docs if d["lang"]}
    for r in found:
        assert r["held_out"] == brute.held_out(r["doc_id"], 3, 1) and 0 <= r["score"] <= 1
        if r["doc_id"] is not None:
            letters = any(c.isalpha() for c in text[r["doc_id"]] or "")
            assert r["lang_pred"] in known if letters else r["lang_pred"] == "und"
    if folder == small:
        lang = {d["doc_id"]: d["lang"] for d in docs}
        held = [r["lang_pred"] == lang[r["doc_id"]] for r in found if r["held_out"]]
        assert sum(held) >= 0.97 * len(held)


def test_language_by_plain_profiles(spark, folder):
    docs = rows(folder, "documents")
    counts = defaultdict(Counter)
    for d in docs:
        if not brute.held_out(d["doc_id"], 3, 1) and d["lang"] is not None and d["text"] is not None:
            counts[d["lang"]] += brute.grams(d["text"])
    profiles = {lang: brute.most(found) for lang, found in counts.items() if found}
    found = run(spark, folder, "op3_language_id")
    expected = Counter((d["doc_id"], *brute.closest(d["text"], profiles)) for d in docs)
    assert Counter((r["doc_id"], r["lang_pred"], r["score"]) for r in found) == expected


def test_quality(spark, folder, small):
    found = run(spark, folder, "op5_quality")
    docs = rows(folder, "documents")
    assert Counter(r["doc_id"] for r in found) == Counter(d["doc_id"] for d in docs)
    for r in found:
        assert r["held_out"] == (r["doc_id"] is None or brute.held_out(r["doc_id"], 5, 0))
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
    if folder == small:
        label = {r["doc_id"]: r["quality"] for r in rows(folder, "labels")}
        good = [r["score"] for r in found if label.get(r["doc_id"]) == 1]
        bad = [r["score"] for r in found if label.get(r["doc_id"]) == 0]
        assert np.mean([g > b for g in good for b in bad]) > 0.9


def test_neighbours(spark, folder):
    found = defaultdict(dict)
    for r in run(spark, folder, "op7_nearest_neighbours"):
        found[r["query_id"]].setdefault(r["rank"], []).append((r["vec_id"], r["score"]))
    usable = [
        (r["vec_id"], np.array(r["embedding"], dtype=np.float64)) for r in rows(folder, "embeddings")
        if r["vec_id"] is not None and r["embedding"] and None not in r["embedding"] and np.isfinite(r["embedding"]).all() and any(r["embedding"])
    ]
    dim = Counter(len(v) for _, v in usable).most_common(1)[0][0]
    usable = [(i, v) for i, v in usable if len(v) == dim]
    hits = total = 0
    assert set(found) == {i for i, _ in usable if i % 20 == 0}
    for i in found:
        mine = [v for j, v in usable if j == i]
        if len(mine) > 1:  # two queries of one id
            continue
        best = sorted(((-(v @ mine[0]), j) for j, v in usable if j != i))[:20]
        assert sorted(found[i]) == list(range(1, len(best) + 1))
        got = [found[i][rank][0] for rank in sorted(found[i])]
        assert got == sorted(got, key=lambda x: (-x[1], x[0]))
        hits += len({j for j, _ in got} & {j for _, j in best})
        total += len(best)
    assert hits >= 0.95 * total


def test_token_files(spark, folder):
    found = sorted(run(spark, folder, "op9_token_files"), key=lambda r: r["start"])
    ids = [r["doc_id"] for r in found]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    expected = Counter()
    for row in rows(folder, "documents"):
        own = tokens("byte_bpe_50k.json", row["text"]) + [0]
        expected[row["doc_id"], len(own), brute.crc(own)] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found) == expected
    assert [r["start"] for r in found] == [0, *np.cumsum([r["n_tokens"] for r in found])[:-1]]


def test_fingerprints(spark, folder):
    found = run(spark, folder, "op10_fingerprints")
    docs = [(d["doc_id"], d["text"] or "") for d in rows(folder, "documents")]
    docs.sort(key=lambda d: (-d[0] if d[0] is not None else 10**9, d[1]))
    expected, likes = Counter(), {}
    for (doc_id, text), (_, after) in zip(docs, docs[1:] + docs[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        sha = hashlib.sha256(edited.encode()).hexdigest()
        expected[doc_id, len(text), sha] += 1
        own = brute.shingles(text)
        likes[doc_id, sha] = brute.likeness(own, brute.shingles(edited)), brute.likeness(own, brute.shingles(after))
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in found) == expected
    for r in found:
        near = likes[r["doc_id"], r["edited_sha256"]]
        assert abs(r["near_edited"] - near[0]) < 0.2 and abs(r["near_next"] - near[1]) < 0.2
    by_text = defaultdict(set)
    for r in found:
        by_text[r["n_chars"], r["doc_id"]].add(r["fingerprint"])
    assert by_text[0, 1] == by_text[0, 2] if folder.count("edge") else True


def test_simhash(spark, folder):
    found = run(spark, folder, "op12_simhash_near_dedup")
    docs = [(r["doc_id"], brute.simhash(r["text"])) for r in rows(folder, "documents")]
    prints = sorted({p for _, p in docs})
    near = {p: {q for q in prints if (p ^ q).bit_count() <= 2} for p in prints}
    least = {}
    for p in prints:
        reach, todo = {p}, [p]
        while todo:
            new = near[todo.pop()] - reach
            reach |= new
            todo += new
        least[p] = min((i for i, q in docs if q in reach and i is not None), default=None)
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in found) == Counter((i, f"{p:016x}", least[p]) for i, p in docs)
