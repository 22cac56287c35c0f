"""The stages as streaming queries. Each has its own checkpoint and can be stopped and started alone."""

import hashlib
import threading
import time
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from docflow.functions.files import storage_path
from docflow.operators.changes import latest_per_key
from docflow.operators.extraction import Extractor, extract_text, utf8_pages
from docflow.plans.chunk import chunk_messages, chunkable
from docflow.plans.full import run_full
from docflow.plans.listing import listing_messages
from docflow.plans.parse import last_parsed, parse_attempts, parsed_messages, pdf_messages, save_state
from docflow.schemas import FILE_RECORD, OVERLAP, PARSED_RECORD, WINDOW_SIZE
from docflow.sources import folders
from docflow.sources.files import FOLDER, file_id, listable, note_landed, read_bytes_stream
from docflow.sources.listing import list_files, read_page_stream
from docflow.sources.topics import batch_of, follow, topic_stream_writer, write_topic
from docflow.streaming.progress import report

TEXTS = "path string, id string, content string, text_length long, landed timestamp, status string"
# Seconds between two listings of the folder where files land, while a stream runs on.
LISTED_EVERY = 10


def listing_stage(
    spark: SparkSession, source: str, topic: str, checkpoint: str, max_files: int = 1000, **options
) -> DataStreamWriter:
    """Landed pages to the files topic."""
    pages = read_page_stream(spark, source, max_files)
    return topic_stream_writer(listing_messages(list_files(pages), **options), topic, checkpoint)


def extract_stage(
    spark: SparkSession, source: str, texts: str, checkpoint: str, extractor: Extractor = utf8_pages,
    id_of: Callable[[Column], Column] = file_id, max_files: int = 1000,
) -> DataStreamWriter:
    """Landed files to texts by path, each landed file extracted once.

    The files are listed by tasks, into a log beside the checkpoint that the stream follows; patterns and schemes that Python has no file
    system for are listed by Spark on the driver.
    """
    if not listable(source):
        return texts_writer(extract_text(read_bytes_stream(spark, source, id_of, max_files), extractor), texts, checkpoint)
    log = f"{checkpoint}/landed"
    landed = read_bytes_stream(spark, source, id_of, max_files, log)
    return texts_writer(extract_text(landed, extractor), texts, checkpoint, lambda: note_landed(spark, source, log, min(FOLDER, max_files)))


class LandedWriter(DataStreamWriter):
    """Of a stream that follows a log: `note` adds to the log when the stream starts and, unless that drains what there is, while it runs."""

    def __init__(self, df: DataFrame, note: Callable[[], None]):
        super().__init__(df)
        self._note, self._drains = note, False

    def trigger(self, **options) -> DataStreamWriter:
        self._drains = bool(options.get("availableNow") or options.get("once"))
        return super().trigger(**options)

    def start(self, *args, **options) -> StreamingQuery:
        self._note()
        query = super().start(*args, **options)
        if not self._drains:
            threading.Thread(target=self._go_on, args=(query,), daemon=True).start()
        return query

    def _go_on(self, query: StreamingQuery) -> None:
        while query.isActive:
            time.sleep(LISTED_EVERY)
            try:
                if query.isActive:
                    self._note()
            except Exception:
                # A stream that no longer hears of new files must not look as if it ran.
                query.stop()
                raise


def texts_writer(extracted: DataFrame, texts: str, checkpoint: str, note: Callable[[], None] | None = None) -> DataStreamWriter:
    """Extracted files to a table partitioned by status, so that lookups of texts open successful files only."""
    rows = extracted.select(
        storage_path(F.col("id")).alias("path"), "id", F.col("text").alias("content"), "text_length", "landed", "status"
    )
    writer = rows.writeStream if note is None else LandedWriter(rows, note)
    return (
        writer.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", texts)
        .partitionBy("status")
    )


def read_texts(spark: SparkSession, texts: str) -> DataFrame:
    """The texts there are now; none before the first is written."""
    if not folders.exists(spark, texts):
        return spark.createDataFrame([], TEXTS)
    return spark.read.schema(TEXTS).parquet(texts)


def waiting(spark: SparkSession, topic: str, run: str, number: int, like: DataFrame) -> DataFrame:
    """Messages that the micro-batch before left to be tried again."""
    left = _waiting(topic, run, number - 1)
    if not folders.exists(spark, left):
        return spark.createDataFrame([], like.schema)
    return spark.read.schema(like.schema).parquet(left)


def _waiting(topic: str, run: str, number: int) -> str:
    return f"{topic}/waiting/run={hashlib.sha256(run.encode()).hexdigest()[:16]}/number={number}"


def parse_stage(
    spark: SparkSession, files_topic: str, texts: str, parsed_topic: str, checkpoint: str,
    max_batches: int | None = None, now: Column | None = None,
) -> DataStreamWriter:
    """Files topic to parsed topic, with the last parsed time per file as state.

    How an extraction ended is looked up within the micro-batch; the texts take no part. A message of a file without bytes is `failed`,
    as in the batch job, and waits: it is tried again in the next micro-batches, and parsed once the bytes are there.
    """

    def run(messages: DataFrame, number: int) -> None:
        session = messages.sparkSession
        batch_id, done = batch_of(session, parsed_topic, checkpoint, number)
        if done:
            return
        new = pdf_messages(messages)
        old = waiting(session, parsed_topic, checkpoint, number, new)
        files = new.withColumn("again", F.lit(False)).unionByName(old.withColumn("again", F.lit(True)))
        outcome = latest_per_key(read_texts(session, texts).select("id", "status", "text_length", "landed"), "id", "landed")
        outcome = outcome.join(files.select("id").distinct(), "id", "left_semi")
        last = last_parsed(session, parsed_topic, batch_id, files)
        attempts = parse_attempts(files, outcome, last).filter("NOT again OR status <> 'failed'")
        # Kept on executor disks for several writes; what is lost is computed again.
        attempts = attempts.persist(StorageLevel.DISK_ONLY)
        try:
            absent = files.join(outcome, "id", "left_anti").drop("again")
            absent.write.mode("overwrite").parquet(_waiting(parsed_topic, checkpoint, number))
            save_state(attempts, parsed_topic, batch_id)
            write_topic(parsed_messages(attempts, now), parsed_topic, number, checkpoint)
        finally:
            attempts.unpersist()

    return follow(spark, files_topic, FILE_RECORD, run, checkpoint, max_batches)


def chunk_stage(
    spark: SparkSession, parsed_topic: str, texts: str, chunks_topic: str, checkpoint: str, window: int = WINDOW_SIZE,
    overlap: int = OVERLAP, max_batches: int | None = None, now: Column | None = None,
) -> DataStreamWriter:
    """Parsed topic to chunks topic. Texts are looked up within the micro-batch; a file without one waits for it."""

    def run(messages: DataFrame, number: int) -> None:
        session = messages.sparkSession
        new = chunkable(messages)
        files = new.unionByName(waiting(session, chunks_topic, checkpoint, number, new))
        held = read_texts(session, texts).filter("status = 'success'")
        wanted = files.select(F.col("storagePath").alias("path")).distinct()
        absent = files.join(held.select(F.col("path").alias("storagePath")), "storagePath", "left_anti")
        absent.write.mode("overwrite").parquet(_waiting(chunks_topic, checkpoint, number))
        held = latest_per_key(held.join(wanted, "path", "left_semi").select("path", "content", "landed"), "path", "landed")
        write_topic(chunk_messages(files, held, window, overlap, now), chunks_topic, number, checkpoint)

    return follow(spark, parsed_topic, PARSED_RECORD, run, checkpoint, max_batches)


def full_stage(
    spark: SparkSession, files_topic: str, content: Callable[[SparkSession], DataFrame], store: str, parsed_topic: str,
    chunks_topic: str, checkpoint: str, extractor: Extractor = utf8_pages, window: int = WINDOW_SIZE,
    overlap: int = OVERLAP, max_batches: int | None = None, now: Column | None = None,
) -> DataStreamWriter:
    """Files topic to store, parsed topic and chunks topic: the batch job on each micro-batch.

    `content` gives the file bytes there are at the time of a micro-batch. A stream with a new checkpoint is a new run: its batches
    and store versions come after those there are. Files with very many messages are cut into segments here, as in the batch job.
    """

    def run(messages: DataFrame, number: int) -> None:
        session = messages.sparkSession
        run_full(
            session, messages, content(session), store, parsed_topic, chunks_topic, extractor, window, overlap,
            number=number, now=now, run=checkpoint,
        )

    return follow(spark, files_topic, FILE_RECORD, run, checkpoint, max_batches)


def progress(query: StreamingQuery) -> list[dict]:
    """Batch number, rows (of a topic: messages) in and rows per second of the batches a query has run lately; `ProgressLog` keeps those of all."""
    return [report(p) for p in query.recentProgress]
