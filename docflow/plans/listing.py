"""Listing to topic."""

import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from docflow.operators.ordering import number_batches, pages_within, until_empty_page
from docflow.operators.records import delivery_counts, file_records
from docflow.schemas import FILE_RECORD
from docflow.sources.listing import from_token, list_files, page_of, page_sizes, read_pages, until_last_page
from docflow.sources.topics import read_rows, write_topic


def pages_of_run(sizes: DataFrame, max_files: int | None = None, token: str | None = None) -> DataFrame:
    """Pages one run takes: from `token` on, up to the first page that is empty or has no token, whole pages until `max_files` is met."""
    taken = until_empty_page(until_last_page(from_token(sizes, token)), rows=F.col("files"))
    return pages_within(taken, "page_no", F.col("files"), max_files)


def listing_messages(files: DataFrame, **options) -> DataFrame:
    """Topic rows of listed files; rows that break the record's rules carry a reason."""
    return file_records(files, keep=["offset"], **options)


def sent_counts(spark: SparkSession, topic: str, batch_size: int | None, batch_id: int) -> DataFrame:
    """success, failure and total per batch of a written run: a page each, or `batch_size` files each."""
    rows = read_rows(spark, topic, FILE_RECORD, F.col("batch_id") == batch_id)
    rows = rows.select("offset", F.col("accepted").alias("valid"))
    if batch_size is None:
        batched = rows.withColumn("batch", page_of(F.col("offset")))
    else:
        batched = number_batches(rows, "offset", batch_size)
    return delivery_counts(batched, ["batch"])


def run_listing(
    spark: SparkSession,
    source: str,
    topic: str,
    batch_size: int | None = None,
    max_files: int | None = None,
    token: str | None = None,
    number: int | None = None,
    **options,
) -> dict:
    """Write one run of a landed listing to a topic, as one more batch of it, and report on it.

    The report holds processed, sent, failed, duration and the token to go on from. The listing is read twice: for
    the sizes of its pages, from which follows what the run takes, and for the files. A run with the `number` of one
    that was written writes nothing and reports on that one.
    """
    started = time.monotonic()
    pages = read_pages(spark, source)
    sizes = page_sizes(pages).persist()
    try:
        run = pages_of_run(sizes, max_files, token).agg(
            F.min("page_no").alias("first"), F.max("page_no").alias("last"),
            F.max_by("nextPageToken", "page_no").alias("next_page_token"),
        ).first()
    finally:
        sizes.unpersist()
    taken = F.lit(False) if run["first"] is None else F.col("page_no").between(run["first"], run["last"])
    written = write_topic(listing_messages(list_files(pages.filter(taken)), **options), topic, number)
    sent, failed = written["accepted"], written["rejected"]
    report = {"processed": sent + failed, "sent": sent, "failed": failed, "batch_id": written["batch_id"]}
    if batch_size is not None:
        report["batches"] = sent_counts(spark, topic, batch_size, written["batch_id"]).count()
    report["next_page_token"] = token if run["first"] is None else run["next_page_token"]
    report["duration"] = time.monotonic() - started
    return report
