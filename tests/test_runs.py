"""Levelled runs against a dictionary, and what a batch reads and writes."""

import random
import re

import pytest
from pyspark.sql import types as T

from docflow.sources import folders
from docflow.sources.runs import Runs

SCHEMA = T.StructType().add("id", "string").add("m", "string").add("seq", "long")


def size(spark, path):
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    return {r.path: r.length for r in rows.select("path", "length").collect()}


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("history", [False, True])
def test_fifty_batches(spark, tmp_path, history):
    path, rng = str(tmp_path / "state"), random.Random(7)
    table = Runs(spark, path, SCHEMA, "id", buckets=4, fan=3, history=history)
    expected, wrote = {}, []
    before = {}
    for batch in range(50):
        many = 4000 if batch == 0 else 5
        rows = [(f"k{rng.randrange(6000)}", f"{batch}-{i}", i) for i in range(many)]
        rows = list({r[0]: r for r in rows}.values())
        table.append(frame(spark, rows), batch)
        expected |= {r[0]: r[1:] for r in rows}
        now = size(spark, path)
        wrote.append(sum(n for p, n in now.items() if p not in before))
        before = now
        levels = [r["level"] for r in table.manifest()]
        assert all(levels.count(level) < 3 for level in levels) and len(table.manifests()) <= 2
        if batch in (1, 13, 49):
            keys = frame(spark, [(k, None, None) for k in list(expected)[:50] + ["absent"]])
            assert {r.id: (r.m, r.seq) for r in table.read(wanted=keys).collect()} == {k: expected[k] for k in list(expected)[:50]}
    assert {r.id: (r.m, r.seq) for r in table.read().collect()} == expected
    # The first batch is 800 times as large as the others and is carried along by few of the folds only.
    assert sorted(wrote[1:])[len(wrote) // 2] < wrote[0] / 4


def test_a_batch_again_and_as_of(spark, tmp_path):
    table = Runs(spark, str(tmp_path / "t"), SCHEMA, "id", buckets=2, fan=2, history=True)
    get = lambda batch=None: {r.id: r.m for r in table.read(batch, order=("seq",)).collect()}
    assert get() == {} and get(3) == {}
    table.append(frame(spark, [("a", "1", 1), ("a", "2", 2), ("b", "1", 1)]), 0)
    assert get() == {"a": "2", "b": "1"}
    for last in ("x", "y"):  # the second replaces the first
        table.append(frame(spark, [("b", last, 1), ("c", last, 1)]), 1)
    assert get() == {"a": "2", "b": "y", "c": "y"} and get(0) == {"a": "2", "b": "1"}
    for batch in range(2, 7):
        table.append(frame(spark, [("d", str(batch), 1)]), batch)
    assert get() == {"a": "2", "b": "y", "c": "y", "d": "6"} and get(5)["d"] == "5"
    table.append(frame(spark, []), 7)
    assert get()["d"] == "6"
    kept = {r["name"] for batch in (6, 7) for r in table.manifest(batch)}
    there = {f"{level}/{run}" for level in folders.names(spark, f"{tmp_path}/t/runs") for run in folders.names(spark, f"{tmp_path}/t/runs/{level}")}
    assert there == kept


def test_a_lookup_opens_the_buckets_of_its_keys(spark, tmp_path):
    table = Runs(spark, str(tmp_path / "t"), SCHEMA, "id", buckets=16, fan=2)
    for batch in range(2):
        table.append(frame(spark, [(f"k{i}", str(batch), i) for i in range(200)]), batch)
    found = table.read(wanted=frame(spark, [("k7", None, None)]))
    assert {r.id: r.m for r in found.collect()} == {"k7": "1"}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[bucket#\d+ IN|PartitionFilters: \[[^\]]*bucket#\d+ = ", plan)
