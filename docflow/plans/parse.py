"""Files topic to content store and parsed topic."""

import math
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from docflow.functions.files import is_pdf
from docflow.operators.changes import latest_per_key, mark_changed
from docflow.operators.extraction import Extractor, Reader, extract_paths, extract_text, utf8_pages
from docflow.operators.ordering import first_rows
from docflow.operators.records import parsed_record
from docflow.schemas import PARSED_RECORD
from docflow.session import written
from docflow.sources.files import open_path
from docflow.sources.runs import Runs
from docflow.sources.store import content_rows, save
from docflow.sources.topics import batch_of, commits, read_rows, write_topic

STATE = T.StructType().add("id", T.StringType()).add("modifiedTime", T.StringType())


def pdf_messages(messages: DataFrame) -> DataFrame:
    """Metadata of the files whose type carries text, one row per message."""
    files = messages.select("offset", "value.id", "value.name", "value.mimeType", "value.modifiedTime")
    return files.filter(is_pdf(F.col("mimeType")))


def parse_state(spark: SparkSession, topic: str) -> Runs:
    """Per id the modified time of the last file that was parsed, as each batch of the topic left it."""
    return Runs(spark, f"{topic}/state", STATE, "id")


def last_parsed(spark: SparkSession, topic: str, before: int, files: DataFrame) -> DataFrame:
    """Of the ids of `files`, the modified time of the last file the batches before parsed. The log decides which batches count."""
    newest = commits(spark, topic).filter(F.col("batch_id") < before).agg(F.max("batch_id")).first()[0]
    state = parse_state(spark, topic)
    return state.read(-1 if newest is None else newest, files).select("id", "modifiedTime")


def save_state(attempts: DataFrame, topic: str, batch_id: int) -> None:
    """Add a batch's successes to the state for the next batch."""
    won = attempts.filter("status = 'success'").select("id", "offset", "modifiedTime")
    parse_state(attempts.sparkSession, topic).append(latest_per_key(won, "id", "offset"), batch_id)


def extract_needed(
    files: DataFrame, content: DataFrame, extractor: Extractor, last: DataFrame, reader: Reader = open_path, done: DataFrame | None = None
) -> DataFrame:
    """(id, text, status, text_length), each file with bytes once, whatever the number of its messages.

    `content` has (id, content), or (id, path) of `sources.files.index`: then the files wanted are opened by the tasks that extract them.
    Files all of whose messages are no newer than what was parsed last are not read, nor those of `done`.
    """
    known = F.nullif(F.col("_last"), F.lit(""))
    time = F.nullif(F.col("modifiedTime"), F.lit(""))
    maybe = files.join(last.select("id", F.col("modifiedTime").alias("_last")), "id", "left").filter(
        time.isNull() | known.isNull() | (time > known)
    )
    # Distinct first: one task must not get all messages of a hot file.
    needed = maybe.select("id").distinct()
    if done is not None:
        needed = needed.join(done.select("id"), "id", "left_anti")
    if "content" in content.columns:
        return extract_text(content.select("id", "content").join(needed, "id", "left_semi"), extractor)
    chosen = content.select("id", "path").join(needed, "id", "left_semi")
    # Paths are small and files are not: a merged partition would hold too many of them.
    tasks = chosen.sparkSession.sparkContext.defaultParallelism
    return extract_paths(chosen.repartition(tasks, "path"), extractor, reader)


def parse_attempts(files: DataFrame, extracted: DataFrame, last: DataFrame | None = None, **options) -> DataFrame:
    """Messages that were worth an attempt, with status and text_length; a file without bytes is `failed`.

    Only success moves a file's last modified time, so a failed file is tried again at its next message. The
    texts take no part in this.
    """
    outcome = extracted.select("id", "status", "text_length")
    judged = files.join(outcome, "id", "left").withColumn("status", F.coalesce("status", F.lit("failed")))
    marked = mark_changed(judged, "id", "offset", "modifiedTime", F.col("status") == "success", last, **options)
    return marked.filter("changed").drop("changed")


def limit_successes(attempts: DataFrame, max_files: int | None) -> DataFrame:
    """Attempts up to the `max_files`-th success in arrival order."""
    if max_files is None:
        return attempts
    won = first_rows(attempts.filter("status = 'success'").select("offset"), "offset", max_files)
    end = won.agg(F.when(F.count("*") >= max_files, F.max("offset")).otherwise(F.lit(2**63 - 1)).alias("end"))
    return attempts.filter(F.col("offset") <= end.scalar())


def parsed_messages(attempts: DataFrame, now: Column | None = None) -> DataFrame:
    """Topic rows of attempts. Those without text carry a reason; an empty file has the status `skipped`."""
    won = F.col("status") == "success"
    status = F.when(F.col("status") == "empty", F.lit("skipped")).otherwise(F.col("status"))
    reason = F.when(~won, F.concat(F.lit("text extraction: "), F.col("status")))
    value = parsed_record(
        F.col("id"), F.col("name"), F.col("mimeType"), F.col("modifiedTime"), F.col("text_length"), status, reason, now
    )
    return attempts.select(F.col("id").alias("key"), "offset", value.alias("value"), reason.alias("reason"))


class ParseRun(NamedTuple):
    """The batch that a run wrote, and the offset of the last message it took: a run after it goes on from there. Null without messages."""

    batch_id: int
    end: int | None
    # of the store, after the run; null if the batch had been written before
    version: int | None = None


def in_waves(files: DataFrame, content: DataFrame, extractor: Extractor, last: DataFrame, max_files: int, reader: Reader) -> tuple[DataFrame, DataFrame, int | None]:
    """Extracted files, attempts up to the `max_files`-th success in arrival order, and the offset of the last message taken.

    Messages are taken in waves by offset. A wave is as long as what is still wanted over the rate of successes so far, so the work follows the
    limit and not the number of messages that wait; a file is extracted in one wave only.
    """
    extracted, reached, tried, won = None, None, 0, 0
    while True:
        rate = max(won / tried, 0.02) if tried else 1.0
        length = math.ceil((max_files - won) / rate)
        ahead = files if reached is None else files.filter(F.col("offset") > reached)
        end, taken = first_rows(ahead.select("offset"), "offset", length).agg(F.max("offset"), F.count("*")).first()
        if end is None:
            upto = files
        else:
            upto = files.filter(F.col("offset") <= end)
            wave = upto if reached is None else upto.filter(F.col("offset") > reached)
            new = written(extract_needed(wave, content, extractor, last, reader, extracted), "extracted")
            extracted, reached, tried = new if extracted is None else extracted.unionByName(new), end, tried + taken
        if extracted is None:
            extracted = extract_needed(files, content, extractor, last, reader)
        attempts = parse_attempts(upto, extracted, last)
        won = attempts.filter("status = 'success'").count()
        if won >= max_files:
            attempts = limit_successes(attempts, max_files)
            return extracted, attempts, attempts.agg(F.max("offset")).first()[0]
        if end is None or taken < length:
            return extracted, attempts, reached


def run_parse(
    spark: SparkSession,
    messages: DataFrame,
    content: DataFrame,
    store: str,
    topic: str,
    extractor: Extractor = utf8_pages,
    max_files: int | None = None,
    number: int | None = None,
    now: Column | None = None,
    run: str = "",
    reader: Reader = open_path,
) -> ParseRun:
    """Parse a batch of file messages: texts to the store, parsed files and rejects to the topic.

    `content` is as in `extract_needed`. A call with the `number` of a batch of the run that was written does nothing; without a number it is
    one more batch. The store comes first, so no parsed file is without its text. After a run with `max_files`, messages with a greater
    offset than the returned one are left for the next run.
    """
    batch_id, done = batch_of(spark, topic, run, number)
    if done:
        rows = read_rows(spark, topic, PARSED_RECORD, F.col("batch_id") == batch_id)
        return ParseRun(batch_id, rows.agg(F.max("offset")).first()[0])
    files = pdf_messages(messages)
    last = last_parsed(spark, topic, batch_id, files)
    if max_files is None:
        # Kept on executor disks to extract once for two writes; what is lost is extracted again.
        extracted = extract_needed(files, content, extractor, last, reader).persist(StorageLevel.DISK_ONLY)
        attempts, end = parse_attempts(files, extracted, last), None
    else:
        extracted, attempts, end = in_waves(files, content, extractor, last, max_files, reader)
    attempts = attempts.persist(StorageLevel.DISK_ONLY)
    try:
        newest = latest_per_key(attempts.filter("status = 'success'"), "id", "offset")
        texts = newest.select("id", "offset", "name", "mimeType").join(extracted.select("id", "text"), "id")
        version = save(content_rows(texts), store, unique=True)
        save_state(attempts, topic, batch_id)
        write_topic(parsed_messages(attempts, now), topic, number, run)
        return ParseRun(batch_id, files.agg(F.max("offset")).first()[0] if max_files is None else end, version)
    finally:
        attempts.unpersist()
        extracted.unpersist()
