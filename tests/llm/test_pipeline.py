"""Each stage on the rows its predecessor kept, against SQL or a brute-force version; and the stages in a row."""

import hashlib
from collections import Counter

import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from docflow.llm import packing, sql
from docflow.llm.common import kept
from tests.llm import brute

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module", params=["edge", "small"])
def results(request, spark):
    """The documents and what each stage made of them."""
    folder = request.getfixturevalue("edge") if request.param == "edge" else "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = kept(stage(spark, docs, folder), f"test-{name}")
        found[name] = docs
    # Arrow for SQL: pandas would make doubles of ids next to a null.
    return folder, {name: df.toPandas() for name, df in found.items()}, {name: df.toArrow() for name, df in found.items()}


def oracle(query, documents):
    db = duckdb.connect()
    db.register("documents", documents)
    return db.execute(query).fetchall()


def test_order():
    assert list(STAGES) == ["language_id", "line_dedup", "ngram_jaccard_join", "mix_sources", "best_fit_packing"]


def test_columns(results):
    frames = list(results[1].values())
    assert all(list(f.columns) == list(frames[0].columns) for f in frames[:-1])


def test_language(results):
    before, after = results[1]["documents"], results[1]["language_id"]
    letters = before[[any(c.isalpha() for c in t or "") for t in before.text]]
    assert Counter(after.text) == Counter(letters.text)


def test_lines(results):
    before, after = results[1]["language_id"], results[1]["line_dedup"]
    expected = oracle(sql.LINES, results[2]["language_id"])
    found = Counter(hashlib.sha256((t or "").encode()).hexdigest() for t in after.text)
    assert found == Counter(r[3] for r in expected) and len(after) == len(before) and sum(r[2] for r in expected)


def test_near_copies(results):
    before, after = results[1]["line_dedup"], results[1]["ngram_jaccard_join"]
    texts = before.text.tolist()
    root = brute.classes(texts)
    least = {}
    for doc_id, r, text in zip(before.doc_id, root, texts):
        if brute.shingles(text):
            least.setdefault(r, []).append(doc_id if doc_id == doc_id else float("inf"))
    expected = Counter(min(v) for v in least.values())
    empty = sum(not brute.shingles(t) for t in texts)
    kept_ids = Counter(i if i == i else float("inf") for i, t in zip(after.doc_id, after.text) if brute.shingles(t))
    assert kept_ids == expected and sum(not brute.shingles(t) for t in after.text) == empty


def test_mix(results):
    before, after = results[1]["ngram_jaccard_join"], results[1]["mix_sources"]
    expected = oracle(sql.MIX, results[2]["ngram_jaccard_join"])
    copies = Counter()
    for doc_id, size, _, _, taken in expected:
        if size:
            copies[float("nan" if doc_id is None else doc_id).hex()] += taken // size
    copies = +copies
    assert Counter(float(i).hex() for i, t in zip(after.doc_id, after.text) if brute.words(t)) == copies


def test_packing(results):
    before, after = results[1]["mix_sources"], results[1]["best_fit_packing"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = Counter()
    for doc_id, text in zip(before.doc_id, before.text):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for piece, at in enumerate(range(0, len(ids), 4096)):
            expected[str(doc_id), piece, brute.crc(ids[at : at + 4096])] += 1
    assert Counter(zip(map(str, after.doc_id), after.piece, after.ids_crc32)) == expected
    assert (after.groupby("sequence_id").length.sum() <= 4096).all()


def test_run_is_the_stages_in_a_row(results, spark):
    folder, frames, _ = results
    found = entry.queries()["pipeline"](spark, folder).toPandas()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    rows = [Counter(map(str, f[names].itertuples(index=False, name=None))) for f in (found, frames["best_fit_packing"])]
    assert rows[0] == rows[1]


def test_stages_read_wide_rows_in_small_batches(spark, edge):
    name = "spark.sql.parquet.columnarReaderBatchSize"
    spark.conf.unset(name)
    STAGES["mix_sources"](spark, spark.read.parquet(f"{edge}/documents.parquet"), edge)
    assert int(spark.conf.get(name)) <= 512


def test_packing_stage_remembers_fewer_chunks(spark, edge, monkeypatch):
    seen, pack = [], packing.pack
    monkeypatch.setattr(packing, "pack", lambda *a, **b: seen.append(b.get("remembered", 500_000)) or pack(*a, **b))
    docs = spark.read.parquet(f"{edge}/documents.parquet")
    found = STAGES["best_fit_packing"](spark, docs, edge).select("doc_id", "piece", "start", "length", "ids_crc32").collect()
    assert seen and seen[0] <= 100_000
    path = public_tokenizers.path("word_bpe_49k.json")
    few = packing.pieces(docs, path, 4096, 1, remembered=2).select("doc_id", "piece", "start", "length", "ids_crc32").collect()
    assert Counter(few) == Counter(found)
