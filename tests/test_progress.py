"""Progress of streams."""

from docflow.streaming.progress import ProgressLog, kept_progress
from docflow.streaming.stages import progress


def test_progress_of_all_batches(spark, tmp_path):
    """A query remembers its last hundred micro-batches; the log has each, once, also after a restart."""
    source, log, sink = (str(tmp_path / name) for name in ("in", "log", "out"))
    assert kept_progress(spark, log).count() == 0
    (tmp_path / "in").mkdir()
    listener = ProgressLog(spark, log)
    spark.streams.addListener(listener)
    try:
        for first, last in ((0, 105), (105, 108)):
            for i in range(first, last):
                (tmp_path / "in" / f"{i:03}.json").write_text('{"x": 1}\n' * (i % 3 + 1))
            stream = spark.readStream.schema("x long").option("maxFilesPerTrigger", 1).json(source)
            writer = stream.writeStream.format("noop").option("checkpointLocation", sink).trigger(availableNow=True)
            query = writer.start()
            query.awaitTermination()
            assert listener.wait(query)
            assert len(progress(query)) <= 100
    finally:
        spark.streams.removeListener(listener)
    rows = kept_progress(spark, log).filter("input_rows > 0").collect()
    assert sorted(r.batch_id for r in rows) == list(range(108))
    assert sum(r.input_rows for r in rows) == sum(i % 3 + 1 for i in range(108))
    assert len({r.query_id for r in rows}) == 1 and len({r.run_id for r in rows}) == 2
