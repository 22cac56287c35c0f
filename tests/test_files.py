"""Files written by tasks, and texts chunked once for all their messages."""

import time

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from docflow.checks import inputs as I
from docflow.operators import large_texts
from docflow.plans.chunk import chunk_messages
from docflow.schemas import CHUNK_RECORD, FILE_RECORD
from docflow.sources import files, topics as tp
from docflow.streaming import stages


def test_files_are_landed_without_a_folder_each(spark, tmp_path):
    rows = spark.range(0, 2500, numPartitions=2).select("id", F.concat(F.lit("é "), "id").alias("line"))
    twice = spark.createDataFrame([(1, "again"), (-3, None), (None, "no id")], "id long, line string")
    files.write_files(rows.union(twice.coalesce(1)), str(tmp_path / "files"), "id", "line")
    folders = list((tmp_path / "files").iterdir())
    assert len(folders) <= 6 and max(len(list(f.iterdir())) for f in folders) <= files.FOLDER
    got = files.read_bytes(spark, str(tmp_path / "files"), I.landed_id).select("id", F.decode("content", "UTF-8")).collect()
    expected = [(str(i), f"é {i}\n") for i in range(2500)] + [("1", "again\n"), ("", "\n"), ("", "no id\n")]
    assert sorted(map(tuple, got)) == sorted(expected)


def test_lines_of_a_key_in_one_partition_make_one_file(spark, tmp_path):
    rows = spark.createDataFrame([("a/b", "1"), ("c", "x"), ("a/b", "2")], "name string, line string").coalesce(1)
    files.write_files(rows, str(tmp_path / "files"), "name", "line")
    got = [(p.name, sorted(p.read_text().split())) for p in (tmp_path / "files").rglob("*.txt")]
    assert sorted(got) == [("name=a%2Fb.txt", ["1", "2"]), ("name=c.txt", ["x"])]


def test_a_text_is_chunked_before_it_meets_its_messages(spark):
    messages = [(i, f"id{i % 2}", "n", f"p{i % 2}") for i in range(6)] + [(9, "id9", "n", None)]
    messages = spark.createDataFrame(messages, "offset long, id string, name string, storagePath string")
    texts = spark.createDataFrame([("p0", "some words. " * 200), ("p1", " \t")], "path string, content string")
    rows = chunk_messages(messages, texts)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.index("Join") < plan.index("regexp_extract_all")
    alone = chunk_messages(messages.filter("offset = 2"), texts).select("key", "value.chunkText").collect()
    assert len(alone) > 1
    assert sorted(rows.select("key", "value.chunkText").collect()) == sorted(alone * 3)


def test_arrow_batches_are_bounded_by_bytes(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["size"])

    rows = spark.range(0, 300, numPartitions=1).select(F.repeat(F.lit("x"), 100_000).alias("content"))
    got = [r.size for r in rows.mapInArrow(sizes, "size long").collect()]
    assert sum(got) > 30_000_000 and max(got) < 8_000_000


def test_a_range_map_is_smaller_than_its_text():
    text = np.array([ord(c) for c in "Some words of a sentence that ends. " * 100], dtype=np.uint32)
    for start, n in ((0, len(text)), (500, len(text)), (3500, len(text))):
        exits, counts = large_texts.range_map(text[start : start + 1500], start, 500, n, 1000, 200)
        data = large_texts.packed(exits, counts)
        again = large_texts.unpacked(data)
        assert (again[0] == exits).all() and (again[1] == counts).all()
        assert len(data) < 500


def test_landed_files_are_streamed_without_the_driver_listing_them(spark, tmp_path, monkeypatch):
    """Files in nested folders, a log file for each few of them, a bounded drain and a stream that runs on."""
    monkeypatch.setattr(stages, "FOLDER", 2)
    monkeypatch.setattr(files, "FOLDER", 2)
    monkeypatch.setattr(stages, "LISTED_EVERY", 1)
    source, texts, mark = tmp_path / "in", str(tmp_path / "texts"), str(tmp_path / "mark")
    names = [f"{folder}/f {i}.txt" for i, folder in enumerate(("a", "a", "a", "a/b", "a/b", "."))]
    hidden = ["_temporary/x.txt", ".y.txt", "a/z.txt._COPYING_"]
    for name in names + hidden:
        (source / name).parent.mkdir(parents=True, exist_ok=True)
        (source / name).write_text(f"text of {name}")

    def stage():
        return stages.extract_stage(spark, f"file://{source}", texts, mark, max_files=4)

    def found():
        return sorted((r.id, r.content) for r in stages.read_texts(spark, texts).collect())

    def rows(some):
        return sorted((name.split("/")[-1][:-4], f"text of {name}") for name in some)

    def logged():
        return spark.read.schema(files.LANDED).parquet(f"{mark}/landed")

    query = stage().trigger(availableNow=True).start()
    query.awaitTermination()
    assert found() == rows(names)
    # What the stream was given is files of the log, two landed files to each.
    sources = list((tmp_path / "mark/sources/0").glob("[0-9]*"))
    assert sources and not any("/in/" in s.read_text() for s in sources)
    assert max(logged().groupBy(F.input_file_name()).count().toPandas()["count"]) <= 2
    assert all(p["numInputRows"] <= 4 for p in query.recentProgress) and len(sources) >= 2

    # Modified files are not new, later ones are.
    (source / "a/f 0.txt").write_text("another text")
    later = ["c/d/f 6.txt"]
    (source / "c/d").mkdir(parents=True)
    (source / later[0]).write_text(f"text of {later[0]}")
    tp.run_available(stage())
    assert found() == rows(names + later)
    before = logged().count()
    query = stage().trigger(processingTime="200 milliseconds").start()
    try:
        (source / "a/f 7.txt").write_text("text of a/f 7.txt")
        end = time.monotonic() + 60
        while len(found()) < 8 and time.monotonic() < end:
            time.sleep(0.5)
    finally:
        query.stop()
    assert found() == rows([*names, *later, "a/f 7.txt"])
    assert logged().count() == before + 1


def test_files_that_land_late_are_parsed_and_not_named_to_the_driver(spark, tmp_path, monkeypatch):
    """Files land after their messages, all in one micro-batch: the driver gets a name for each ten of them, and every file is chunked."""
    monkeypatch.setattr(stages, "FOLDER", 10)
    topics = {n: str(tmp_path / n) for n in ("files", "texts", "parsed", "chunks")}
    marks = {n: str(tmp_path / f"mark-{n}") for n in topics}
    rows = spark.range(0, 60).select(F.col("id").alias("offset"), F.col("id").cast("string").alias("id"), F.concat(F.lit("n"), "id").alias("name"),
                                     F.lit("application/pdf").alias("mimeType"))
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in FILE_RECORD if f.name not in rows.columns]
    value = F.struct(*[F.col(f.name) for f in FILE_RECORD])
    messages = rows.select("*", *empty).select(F.col("id").alias("key"), "offset", value.alias("value"))

    def drain():
        tp.run_available(stages.parse_stage(spark, topics["files"], topics["texts"], topics["parsed"], marks["parsed"]))
        tp.run_available(stages.chunk_stage(spark, topics["parsed"], topics["texts"], topics["chunks"], marks["chunks"]))

    tp.write_topic(messages, topics["files"])
    drain()
    assert tp.read_topic(spark, topics["chunks"], CHUNK_RECORD).count() == 0
    source = str(tmp_path / "in")
    files.write_files(rows.filter("id % 2 = 0").withColumn("line", F.concat(F.lit("text "), "id")), source, "id", "line")
    id_ = lambda path: F.regexp_extract(path, r"/id=(\d+)\.", 1)
    tp.run_available(stages.extract_stage(spark, source, topics["texts"], marks["texts"], id_of=id_, max_files=1 << 20))
    tp.write_topic(messages.limit(0), topics["files"])
    drain()
    found = tp.read_topic(spark, topics["chunks"], CHUNK_RECORD).select("key", "value.chunkText").collect()
    assert sorted(map(tuple, found)) == sorted((f"{i}_chunk_0", f"text {i}") for i in range(0, 60, 2))
    named = [line for s in (tmp_path / "mark-texts/sources/0").glob("[0-9]*") for line in s.read_text().splitlines() if "path" in line]
    assert named and not any("id=" in line for line in named)
    assert all(r["count"] <= 10 for r in spark.read.schema(files.LANDED).parquet(f"{marks['texts']}/landed").groupBy(F.input_file_name()).count().collect())


def test_streams_of_what_tasks_cannot_list(spark, tmp_path):
    assert files.listable(str(tmp_path)) and files.listable(f"file://{tmp_path}")
    assert not files.listable(f"{tmp_path}/*") and not files.listable("viewfs://store/in")
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text("alpha")
    tp.run_available(stages.extract_stage(spark, f"{tmp_path}/i*", str(tmp_path / "texts"), str(tmp_path / "mark")))
    assert [r.content for r in stages.read_texts(spark, str(tmp_path / "texts")).collect()] == ["alpha"]
