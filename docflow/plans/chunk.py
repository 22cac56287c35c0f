"""Parsed topic to chunks topic."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docflow.functions.text import has_text
from docflow.operators.chunking import check_window, chunk_list, chunk_statistics, explode_chunks
from docflow.operators.lookups import with_path, with_status
from docflow.operators.ordering import first_rows
from docflow.operators.records import chunk_record
from docflow.schemas import CHUNK_RECORD, OVERLAP, WINDOW_SIZE
from docflow.sources.store import held, read_store
from docflow.sources.topics import read_topic, write_topic


def chunkable(parsed: DataFrame) -> DataFrame:
    """Parsed files to be chunked: parsed with success and stored somewhere."""
    files = parsed.select("offset", "value.id", "value.name", "value.storagePath", "value.parseStatus")
    return with_path(with_status(files)).drop("parseStatus")


def chunk_messages(
    files: DataFrame, texts: DataFrame, window: int = WINDOW_SIZE, overlap: int = OVERLAP, now: Column | None = None
) -> DataFrame:
    """Topic rows, keyed by chunk id, of files whose text is among `texts` (path, content). Chunks of a file share the offset of its message.

    Each text is chunked once, before the join, however many messages name it.
    """
    # Blank texts go first: a test on the list itself would build each list twice.
    some = texts.filter(has_text(F.col("content")))
    # Chunking is heavy and texts are small: partitions merged by their bytes would be too few tasks.
    session = texts.sparkSession
    tasks = max(session.sparkContext.defaultParallelism, int(session.conf.get("spark.sql.shuffle.partitions")))
    some = some.repartition(tasks, "path")
    lists = some.select(F.col("path").alias("storagePath"), chunk_list(F.col("content"), window, overlap).alias("chunks"))
    return _keyed(explode_chunks(files.join(lists, "storagePath"), F.col("chunks"), "id", ["offset", "id", "name"]), now)


def _keyed(chunks: DataFrame, now: Column | None) -> DataFrame:
    value = chunk_record(F.col("id"), F.col("name"), now)
    return chunks.select(F.col("chunkId").alias("key"), "offset", value.alias("value"))


def run_chunk(
    spark: SparkSession,
    parsed: DataFrame,
    store: str,
    topic: str,
    window: int = WINDOW_SIZE,
    overlap: int = OVERLAP,
    max_files: int | None = None,
    number: int | None = None,
    as_of: int | None = None,
    now: Column | None = None,
    run: str = "",
) -> int | None:
    """Chunk a batch of parsed files with the texts the store holds.

    Returns the offset of the last file taken, to go on from if `max_files` was met; null if there is none. A call with the `number` of a
    batch of the run that was written writes nothing.
    """
    check_window(window, overlap)
    files = chunkable(parsed)
    if max_files is not None:
        # The limit is on narrow rows: the index of the store knows which files have content.
        there = held(spark, store, as_of, files.select(F.col("storagePath").alias("path"))).filter("length > 0")
        named = files.join(there.select(F.col("path").alias("storagePath")), "storagePath", "left_semi")
        end = first_rows(named.select("offset"), "offset", max_files).agg(F.max("offset")).first()[0]
        files = files.filter(F.col("offset") <= F.lit(end))
    texts = read_store(spark, store, as_of, files.select(F.col("storagePath").alias("path")))
    write_topic(chunk_messages(files, texts, window, overlap, now), topic, number, run)
    return files.agg(F.max("offset")).first()[0] if max_files is None else end


def chunk_report(spark: SparkSession, topic: str, by_file: bool = False) -> DataFrame:
    """Chunk statistics of a chunks topic, over all or per file."""
    chunks = read_topic(spark, topic, CHUNK_RECORD).select("value.fileId", "value.chunkText")
    return chunk_statistics(chunks, ["fileId"] if by_file else None)
