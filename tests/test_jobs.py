"""Sources, store, extraction and the jobs, in batch and as restarted streams."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from docflow.operators.extraction import assemble_pages, extract_text, html_pages, utf8_pages
from docflow.operators.records import file_records
from docflow.plans.chunk import run_chunk
from docflow.plans.full import run_full
from docflow.plans.listing import run_listing
from docflow.plans.parse import run_parse
from docflow.schemas import CHUNK_RECORD, FILE_RECORD, PARSED_RECORD
from docflow.session import work_folder
from docflow.sources import listing as ls, store as st, topics as tp
from docflow.sources.files import index, open_path, read_bytes, read_paths
from docflow.streaming import stages
from docflow.streaming.changes import changed_writer, read_changed
from tests.test_changes import random_rows, rule_tried

PDF = "application/pdf"


def land(folder, pages):
    folder.mkdir(exist_ok=True)
    for number, (files, token) in pages.items():
        page = {"page_no": number, "kind": "list"}
        if files is not None:
            page["files"] = files
        if token:
            page["nextPageToken"] = token
        (folder / f"{number}.json").write_text(json.dumps(page) + "\n")
    return str(folder)


def files(*ids, **fields):
    return [{"id": i, "name": f"{i}.pdf", "mimeType": PDF, "size": "5", "parents": [], **fields} for i in ids]


def report(spark, source, folder, **options):
    got = run_listing(spark, source, str(folder), **options)
    assert got.pop("duration") > 0 and got.pop("batch_id") >= 0
    return got


def test_listing_run(spark, tmp_path):
    source = land(tmp_path / "in", {0: (files("a", "b"), "t1"), 1: (files("c", size="many"), None)})
    got = report(spark, source, tmp_path / "t", max_files=5)
    assert got == {"processed": 3, "sent": 2, "failed": 1, "next_page_token": None}
    assert tp.read_rejects(spark, str(tmp_path / "t"), FILE_RECORD).first().reason == "size is not a number"
    assert [r.name for r in ls.drain(ls.read_pages(spark, source)).orderBy("offset").collect()] == [
        "a.pdf", "b.pdf", "c.pdf",
    ]


def test_listing_limits_and_tokens(spark, tmp_path):
    source = land(
        tmp_path / "in",
        {0: (files("a", "b", "c"), "t1"), 1: (files("d"), "t2"), 2: ([], "t3"), 3: (files("e"), None)},
    )
    assert report(spark, source, tmp_path / "1", max_files=2) == {
        "processed": 3, "sent": 3, "failed": 0, "next_page_token": "t1",
    }
    assert report(spark, source, tmp_path / "2", token="t1") == {
        "processed": 1, "sent": 1, "failed": 0, "next_page_token": "t2",
    }
    assert report(spark, source, tmp_path / "3", token="t2") == {
        "processed": 0, "sent": 0, "failed": 0, "next_page_token": "t2",
    }
    assert report(spark, source, tmp_path / "4", token="t3", batch_size=2)["processed"] == 1
    empty = land(tmp_path / "none", {0: (None, None)})
    assert report(spark, empty, tmp_path / "5")["processed"] == 0


def test_topic_batches_replace_themselves(spark, tmp_path):
    topic = str(tmp_path / "topic")
    rows = spark.createDataFrame([(k, o) for o, k in enumerate("aababb")], "id string, offset long")
    messages = file_records(rows, ["offset"])
    for batch in (0, 1, 1):
        tp.write_topic(messages.withColumn("offset", F.col("offset") + 10 * batch), topic, batch)
    stored = tp.read_rows(spark, topic, FILE_RECORD)
    assert stored.count() == 12 and tp.read_topic(spark, topic, FILE_RECORD).count() == 12
    assert stored.filter(F.col("batch_id") == 1).agg(F.min("offset")).first()[0] == 10
    assert stored.groupBy("key").agg(F.countDistinct("partition").alias("n")).filter("n > 1").count() == 0


def test_store(spark, tmp_path):
    store = str(tmp_path / "store")
    schema = "path string, content string, metadata map<string,string>, seq long"
    wanted = spark.createDataFrame([("test/file.txt",), ("absent",)], "path string")

    def contents(**options):
        return {r.path: r.content for r in st.load(spark, store, wanted, **options).collect()}

    assert contents() == {"test/file.txt": None, "absent": None}
    rows = [("test/file.txt", "old", {"a": "1"}, 1), ("test/file.txt", "new", {}, 2), ("other", "x", None, 1)]
    st.save(spark.createDataFrame(rows, schema), store, 0)
    assert contents() == {"test/file.txt": "new", "absent": None}
    assert st.load(spark, store, wanted.limit(1)).first().metadata is None
    st.delete(wanted, store, 1)
    st.delete(wanted, store, 1)
    assert contents() == {"test/file.txt": None, "absent": None}
    assert contents(as_of=0)["test/file.txt"] == "new"
    st.save(spark.createDataFrame([("test/file.txt", "again", None, 1)], schema), store, 2)
    assert contents()["test/file.txt"] == "again"
    st.compact(spark, store, str(tmp_path / "small"), 2)
    held = st.read_store(spark, str(tmp_path / "small")).collect()
    assert {r.path: (r.content, r.version) for r in held} == {"test/file.txt": ("again", 2), "other": ("x", 2)}


def test_store_lookups_open_what_they_want(spark, tmp_path):
    store = str(tmp_path / "store")
    schema = "path string, content string, metadata map<string,string>, seq long"
    expected = {}
    for version in range(10):
        rows = [(f"p{i}", f"text {i} of {version}", None, 1) for i in range(version, 60, 3)]
        assert st.save(spark.createDataFrame(rows, schema), store, unique=version % 2 == 0) == version
        expected |= {r[0]: r[1] for r in rows}
    assert st.delete(spark.createDataFrame([("p59",)], "path string"), store) == 10
    del expected["p59"]
    assert {r.path: r.content for r in st.read_store(spark, store).collect()} == expected
    wanted = spark.createDataFrame([("p30",), ("p59",), ("absent",)], "path string")
    found = st.read_store(spark, store, wanted=wanted)
    assert {r.path: r.content for r in found.collect()} == {"p30": expected["p30"]}
    assert len({f.split("write=")[1].split("/")[0] for f in found.inputFiles() if "/data/" in f}) == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ (=|IN)", plan)
    lengths = {r.path: r.length for r in st.held(spark, store).collect()}
    assert lengths == {p: len(t) for p, t in expected.items()}
    assert {r.path for r in st.read_store(spark, store, 1).collect()} == {f"p{i}" for i in (*range(0, 60, 3), *range(1, 60, 3))}


def test_two_topics_on_one_store(spark, tmp_path):
    store = str(tmp_path / "s")
    for name in ("one", "two", "one"):
        content = spark.createDataFrame([(name, name.encode())], "id string, content binary")
        run_parse(spark, messages(spark, [(0, name, None, PDF)]), content, store, str(tmp_path / name))
    assert {r.path: r.content for r in st.read_store(spark, store).collect()} == {"parsed/one.txt": "one", "parsed/two.txt": "two"}


def broken(content):
    raise RuntimeError("cannot read")


def test_extraction(spark):
    rows = [("two", b"Page 1 content\fPage  2 content"), ("blank", b" \n\f "), ("bad", b"\xff"), ("none", None)]
    df = spark.createDataFrame(rows, "id string, content binary")
    got = {r.id: (r.text, r.status, r.text_length) for r in extract_text(df, utf8_pages).collect()}
    assert got == {
        "two": ("Page 1 content Page 2 content", "success", 29), "blank": (None, "empty", None),
        "bad": (None, "failed", None), "none": (None, "failed", None),
    }
    assert {r.status for r in extract_text(df, broken).collect()} == {"failed"}
    page = b"<html><script>var x;</script><p>a&amp;b</p>\n<style>p{}</style><b>c</b></html>"
    html = spark.createDataFrame([(page,)], "content binary")
    assert extract_text(html, html_pages).first().text == "a&b c"


def test_extraction_from_files(spark, tmp_path):
    folder = tmp_path / "files"
    folder.mkdir()
    (folder / "a b+c.pdf").write_bytes(b"text of a")
    landed = read_bytes(spark, str(folder))
    assert landed.first().id == "a b+c"
    wanted = spark.createDataFrame([("a b+c",), ("missing",)], "path string")
    rows = read_paths(wanted, landed.withColumnRenamed("id", "path"))
    got = {r.path: (r.text, r.status) for r in extract_text(rows, utf8_pages).collect()}
    assert got == {"a b+c": ("text of a", "success"), "missing": (None, "failed")}


def test_page_assembly(spark):
    rows = [("a", p, f"t{p}") for p in range(2500)] + [("b", 1, None), ("b", 0, "x")]
    random.Random(1).shuffle(rows)
    got = {r.id: r.text for r in assemble_pages(spark.createDataFrame(rows, "id string, page int, text string"), "id").collect()}
    assert got == {"a": "".join(f"t{p}\n" for p in range(2500)), "b": "x\n\n"}


def messages(spark, rows):
    df = spark.createDataFrame(rows, "offset long, id string, modifiedTime string, mimeType string")
    return file_records(df.withColumn("name", F.concat(F.lit("n"), "offset")), ["offset"]).select("key", "offset", "value")


def parsed(spark, topic):
    rows = tp.read_rows(spark, topic, PARSED_RECORD).select("offset", "value.parseStatus", "reason").collect()
    return sorted((r.offset, r.parseStatus, r.reason) for r in rows)


CONTENT = [("good", b"some text"), ("blank", b"  "), ("bad", b"\xff")]


def test_parse_job(spark, tmp_path):
    store, topic = str(tmp_path / "s"), str(tmp_path / "t")
    content = spark.createDataFrame(CONTENT, "id string, content binary")
    first = messages(
        spark,
        [(0, "good", "2", PDF), (1, "good", "1", PDF), (2, "good", "3", PDF), (3, "bad", "1", PDF), (4, "bad", "1", PDF),
         (5, "blank", "1", PDF), (6, "gone", "1", PDF), (7, "good", "9", "text/plain")],
    )
    run_parse(spark, first, content, store, topic)
    expected = [
        (0, "success", None), (2, "success", None), (3, "failed", "text extraction: failed"),
        (4, "failed", "text extraction: failed"), (5, "skipped", "text extraction: empty"),
        (6, "failed", "text extraction: failed"),
    ]
    assert parsed(spark, topic) == expected
    row = st.read_store(spark, store).first()
    assert (row.path, row.content) == ("parsed/good.txt", "some text")
    assert row.metadata == {"file_id": "good", "file_name": "n2", "mime_type": PDF}

    # a later batch starts from the last success; a failed file is tried again, now with bytes
    later = messages(spark, [(10, "good", "3", PDF), (11, "good", "4", PDF), (12, "bad", "1", PDF)])
    mended = spark.createDataFrame([("good", b"new"), ("bad", b"mended")], "id string, content binary")
    for _ in range(2):  # once more is no change
        run_parse(spark, later, mended, store, topic, number=1)
        assert parsed(spark, topic) == expected + [(11, "success", None), (12, "success", None)]
        assert {r.path: r.content for r in st.read_store(spark, store).collect()} == {
            "parsed/good.txt": "new", "parsed/bad.txt": "mended",
        }


def test_parse_limit(spark, tmp_path):
    content = spark.createDataFrame(CONTENT, "id string, content binary")
    rows = [(0, "bad", "1", PDF)] + [(o, "good", f"{o:03}", PDF) for o in range(1, 9)] + [(9, "bad", "1", PDF)]
    topic = str(tmp_path / "t")
    run_parse(spark, messages(spark, rows), content, str(tmp_path / "s"), topic, max_files=3)
    assert [r[0] for r in parsed(spark, topic)] == [0, 1, 2, 3]


def test_files_are_opened_by_need_and_in_waves(spark, tmp_path):
    """500 files, every third of them no text; ten are wanted, and ten more after those."""
    landed, calls = tmp_path / "files", tmp_path / "calls"
    landed.mkdir(), calls.mkdir()
    for i in range(500):
        (landed / f"f{i:03}.pdf").write_bytes(b"\xff" if i % 3 == 2 else f"text {i}".encode())
    folder = str(calls)

    def reader(path):
        import uuid

        with open(f"{folder}/{path.rsplit('/', 1)[1]}.{uuid.uuid4().hex}", "w"):
            return open_path(path)

    feed = messages(spark, [(2 * o, f"f{o:03}", "1", PDF) for o in range(500)])
    content, topic = index(spark, str(landed)), str(tmp_path / "t")
    assert content.columns == ["id", "path", "length", "landed"]
    got = run_parse(spark, feed, content, str(tmp_path / "s"), topic, max_files=10, reader=reader)
    assert got.end == 26 and sum(r[1] == "success" for r in parsed(spark, topic)) == 10
    opened = [p.name[:4] for p in calls.iterdir()]
    assert len(opened) == len(set(opened)) <= 20
    left = feed.filter(F.col("offset") > got.end)
    after = run_parse(spark, left, content, str(tmp_path / "s"), topic, max_files=10, reader=reader)
    rows = parsed(spark, topic)
    assert after.end == 56 and [r[0] for r in rows] == list(range(0, 57, 2)) and sum(r[1] == "success" for r in rows) == 20
    none = feed.filter("offset > 5000")
    assert run_parse(spark, none, content, str(tmp_path / "s"), topic, max_files=3, reader=reader).end is None
    # A file that is gone when it is opened fails alone.
    some = content.filter("id < 'f005'").unionByName(content.filter("id = 'f005'").withColumn("path", F.lit("/absent/f005.pdf")))
    all_of = str(tmp_path / "u")
    run_parse(spark, feed.filter("offset < 12"), some, str(tmp_path / "v"), all_of)
    assert [r[1] for r in parsed(spark, all_of)] == ["success", "success", "failed", "success", "success", "failed"]


def chunks(spark, topic):
    rows = tp.read_topic(spark, topic, CHUNK_RECORD).collect()
    return sorted((r.offset, r.key, r.value.fileName, r.value.chunkText, r.value.totalChunks) for r in rows)


def test_full_run_and_limits(spark, tmp_path):
    content = spark.createDataFrame([("good", b"one two three. four five six"), ("bad", b"\xff")], "id string, content binary")
    feed = messages(spark, [(0, "good", "1", PDF), (1, "bad", "1", PDF), (2, "good", "2", PDF)])
    store, topic, out = (str(tmp_path / n) for n in "stc")
    run_full(spark, feed, content, store, topic, out, window=16, overlap=2)
    got = chunks(spark, out)
    assert [g[:4] for g in got if g[0] == 0] == [
        (0, "good_chunk_0", "n0", "one two three."), (0, "good_chunk_1", "n0", "e. four five six"), (0, "good_chunk_2", "n0", "ix"),
    ]
    assert [g[1:2] + g[3:] for g in got if g[0] == 0] == [g[1:2] + g[3:] for g in got if g[0] == 2]
    first = str(tmp_path / "first")
    assert run_chunk(spark, tp.read_topic(spark, topic, PARSED_RECORD), store, first, 16, 2, max_files=1) == 0
    assert {g[0] for g in chunks(spark, first)} == {0}


def test_streams_equal_batch_with_restarts(spark, tmp_path):
    """Listing, extraction, parsing and chunking as streams that stop and start again after each batch of input."""
    landed = tmp_path / "files"
    landed.mkdir()
    texts = {"a": "alpha beta. " * 30, "b": "gamma " * 50, "blank": "  "}
    for name, text in texts.items():
        (landed / f"{name}.pdf").write_text(text)
    rng = random.Random(4)
    ids = ["a", "a", "b", "blank", "gone"]
    pages = {
        p: ([{"id": rng.choice(ids), "name": f"n{p}", "mimeType": rng.choice([PDF, "text/plain"]),
              "modifiedTime": rng.choice([None, "1", "2", "3"])} for _ in range(12)], f"t{p + 1}")
        for p in range(3)
    }
    topics = {n: str(tmp_path / n) for n in ("files-topic", "parsed", "chunks", "texts")}
    marks = {n: str(tmp_path / f"mark-{n}") for n in topics}
    tp.run_available(stages.extract_stage(spark, str(landed), topics["texts"], marks["texts"]))
    source = tmp_path / "pages"
    for number, page in pages.items():
        land(source, {number: page})
        tp.run_available(stages.listing_stage(spark, str(source), topics["files-topic"], marks["files-topic"]))
        tp.run_available(
            stages.parse_stage(spark, topics["files-topic"], topics["texts"], topics["parsed"], marks["parsed"])
        )
        last = tp.run_available(
            stages.chunk_stage(spark, topics["parsed"], topics["texts"], topics["chunks"], marks["chunks"], 100, 20)
        )
    assert sum(p["input_rows"] for p in stages.progress(last)) > 0

    batch = {n: str(tmp_path / f"batch-{n}") for n in ("topic", "store", "parsed", "chunks")}
    run_listing(spark, str(source), batch["topic"])
    feed = tp.read_topic(spark, batch["topic"], FILE_RECORD)
    run_full(spark, feed, read_bytes(spark, str(landed)), batch["store"], batch["parsed"], batch["chunks"], window=100, overlap=20)
    assert parsed(spark, topics["parsed"]) == parsed(spark, batch["parsed"])
    assert chunks(spark, topics["chunks"]) == chunks(spark, batch["chunks"]) and chunks(spark, topics["chunks"])


def test_changed_stream_equals_the_rule(spark, tmp_path):
    rows = sorted(random_rows(11, 300, "aaabc"), key=lambda r: r[1])
    source, kept, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    schema = "id string, offset long, m string, ok boolean, size long"
    for part in range(3):
        some = [(*r, None if r[1] % 2 else 1 << 60) for r in rows[part * 100 : part * 100 + 100]]
        spark.createDataFrame(some, schema).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        tp.run_available(changed_writer(stream, "id", "offset", "m", "ok", kept, mark))
    got = read_changed(spark, kept).collect()
    assert sorted(r.offset for r in got) == sorted(rule_tried(rows))
    assert {(r.offset % 2, r.size) for r in got} == {(1, None), (0, 1 << 60)}


def test_work_folder(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    a, b = work_folder(spark, "x"), work_folder(spark, "x")
    assert a != b and a.rsplit("/docflow/", 1)[0] == b.rsplit("/docflow/", 1)[0]
    if before:
        assert a.startswith(before)


def test_unknown_policy(spark):
    with pytest.raises(ValueError):
        file_records(spark.createDataFrame([("a",)], "id string"), null_policy="other")


def test_listing_ends_at_a_page_without_token(spark, tmp_path):
    source = land(tmp_path / "in", {0: (files("a", "b"), "t1"), 1: (files("c", "d"), None), 2: (files("e"), None)})
    got = report(spark, source, tmp_path / "t")
    assert got["processed"] == 4 and got["next_page_token"] is None
    with pytest.raises(ValueError):
        run_listing(spark, source, str(tmp_path / "u"), token="unknown")


def test_runs_add_to_a_topic(spark, tmp_path):
    source = land(tmp_path / "in", {0: (files("a", "b"), "t1"), 1: (files("c", "d"), "t2"), 2: (files("e"), None)})
    topic = str(tmp_path / "t")
    assert report(spark, source, topic, max_files=2)["next_page_token"] == "t1"
    assert report(spark, source, topic, token="t1")["processed"] == 3
    assert {r.key for r in tp.read_topic(spark, topic, FILE_RECORD).collect()} == set("abcde")
    rows = tp.read_topic(spark, topic, FILE_RECORD)
    again = str(tmp_path / "again")
    assert [tp.write_topic(rows, again, 0)["accepted"] for _ in range(2)] == [5, 5]
    assert tp.read_topic(spark, again, FILE_RECORD).count() == 5


def test_a_page_has_a_greatest_length(spark):
    page = spark.range(1).select(F.lit(0).cast("long").alias("page_no"), F.expr(
        f"transform(sequence(1, {(1 << ls.PAGE_BITS) + 1}), i -> named_struct('id', 'x'))").alias("files"))
    with pytest.raises(Exception, match="more than"):
        ls.list_files(page).agg(F.max("offset")).collect()
