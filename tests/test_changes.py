"""Changed-since-last, latest per key and ordering operators against plain statements of their rules."""

import random

from pyspark.sql import functions as F

from docflow.operators import changes
from docflow.operators.changes import changed_rows, hot_keys, latest_per_key, mark_changed
from docflow.operators.ordering import (
    first_rows,
    limit_by_pages,
    number_batches,
    running_total,
    until_empty_page,
)

ROWS = "id string, offset long, m string, ok boolean"


def rule_tried(rows, last=None):
    state, out = dict(last or {}), []
    for key, offset, m, ok in sorted(rows, key=lambda r: r[1]):
        if key in state and state[key] and m and m <= state[key]:
            continue
        out.append(offset)
        if ok:
            state[key] = m
    return out


def random_rows(seed, count=400, keys="aaab"):
    rng = random.Random(seed)
    times = [None, "", "1", "2", "3", "4", "5", "6", "7", "8", "9"]
    offsets = rng.sample(range(5 * count), count)
    return [(rng.choice(keys), o, rng.choice(times[rng.random() < 0.9 :]), rng.random() < 0.8) for o in offsets]


def tried(df, **options):
    rows = mark_changed(df, "id", "offset", "m", **options).filter("changed").select("offset").collect()
    return sorted(r.offset for r in rows)


def test_fixed_rows(spark):
    rows = [("a", i, m, True) for i, m in enumerate(["2", "1", None, "1", "1", "3"])]
    kept = changed_rows(spark.createDataFrame(rows, ROWS), "id", "offset", "m").orderBy("offset").collect()
    assert [r.m for r in kept] == ["2", None, "1", "3"]


def test_equals_the_rule_with_and_without_segments(spark):
    for seed in range(4):
        rows = random_rows(seed)
        df = spark.createDataFrame(rows, ROWS)
        expected = sorted(rule_tried(rows))
        assert tried(df, success=F.col("ok")) == expected
        for segment in (7, 50):
            assert tried(df, success=F.col("ok"), segment_rows=segment) == expected


def test_earlier_state(spark):
    last = {"a": "4", "b": None}
    state = spark.createDataFrame(list(last.items()), "id string, m string")
    for seed in range(3):
        rows = random_rows(seed, 300, "aaabcc")
        df = spark.createDataFrame(rows, ROWS)
        expected = sorted(rule_tried(rows, last))
        for segment in (20, 1_000_000):
            assert tried(df, success=F.col("ok"), last=state, segment_rows=segment) == expected


def test_sparse_offsets_a_null_key_and_earlier_state(spark, monkeypatch):
    """Offsets of a listing leave a segment with few rows; the null key is hot, too, and has no earlier state."""
    monkeypatch.setattr(changes, "SUMMARIES", 20)
    last = {"a": "4", "b": "2"}
    state = spark.createDataFrame(list(last.items()), "id string, m string")
    for seed in range(1):
        rows = [(k if k != "c" else None, (o // 3 << 40) + o % 3, m, ok) for k, o, m, ok in random_rows(seed, 300, "aaabccc")]
        df = spark.createDataFrame(rows, ROWS)
        for segment in (40, 1 << 41):
            assert tried(df, success=F.col("ok"), last=state, segment_rows=segment) == sorted(rule_tried(rows, last))


def test_reads_its_input_twice(spark):
    rows = spark.createDataFrame(random_rows(5), ROWS)
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    df = rows.mapInArrow(counted, ROWS)
    for segment, at_most in ((7, 2), (1_000_000, 2)):
        before = reads.value
        mark_changed(df, "id", "offset", "m", segment_rows=segment).count()
        assert reads.value - before <= at_most * 400


def test_hot_keys(spark):
    df = spark.createDataFrame(random_rows(1), ROWS)
    assert [r.id for r in hot_keys(df, "id", 200).collect()] == ["a"]
    assert hot_keys(df, "id", 1000).count() == 0


def test_latest_per_key(spark):
    rows = [(k, v, f"{k}{v}") for k in "abc" for v in range(5)]
    df = spark.createDataFrame(rows, "k string, v int, x string")
    assert sorted(r.x for r in latest_per_key(df, "k", "v").collect()) == ["a4", "b4", "c4"]
    plan = latest_per_key(df, "k", "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # one row per key and task goes into the shuffle


def test_running_total(spark):
    rng = random.Random(3)
    orders = sorted(rng.sample(range(1 << 62), 200) + list(range(50)) + [-5, -(1 << 40)])
    rows = [(o, rng.randint(0, 9)) for o in orders]
    df = spark.createDataFrame(rows, "o long, n int")
    got = {r.o: r.before for r in running_total(df, "o", F.col("n")).collect()}
    total = 0
    for o, n in rows:
        assert got[o] == total
        total += n


def test_batches_and_limits(spark):
    df = spark.range(0, 250).select((F.col("id") * 3).alias("o"))
    sizes = number_batches(df, "o", 100).groupBy("batch").count().orderBy("batch").collect()
    assert [tuple(r) for r in sizes] == [(0, 100), (1, 100), (2, 50)]
    assert [r.o for r in first_rows(df, "o", 3).collect()] == [0, 3, 6]
    assert first_rows(df, "o", None).count() == 250


def test_limit_by_pages(spark):
    df = spark.createDataFrame([(p,) for p in [0, 0, 0, 1, 1, 1, 2]], "page long")
    for limit, rows in [(1, 3), (2, 3), (3, 3), (4, 6), (6, 6), (7, 7), (100, 7), (0, 7), (None, 7)]:
        assert limit_by_pages(df, "page", limit).count() == rows
    assert limit_by_pages(df.filter("page > 9"), "page", 5).count() == 0


def test_until_empty_page(spark):
    pages = spark.createDataFrame([(0, [1]), (1, [2]), (2, []), (3, [4])], "page_no long, files array<int>")
    assert [r.page_no for r in until_empty_page(pages).orderBy("page_no").collect()] == [0, 1]
    assert until_empty_page(pages.filter("page_no <> 2")).count() == 3
    gone = pages.withColumn("files", F.when(F.col("page_no") != 1, F.col("files")))
    assert until_empty_page(gone).count() == 1
