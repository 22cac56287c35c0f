"""Both stages after the listing, one after the other."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docflow.operators.extraction import Extractor, utf8_pages
from docflow.plans.chunk import run_chunk
from docflow.plans.parse import run_parse
from docflow.schemas import OVERLAP, PARSED_RECORD, WINDOW_SIZE
from docflow.sources.topics import read_topic


def run_full(
    spark: SparkSession,
    messages: DataFrame,
    content: DataFrame,
    store: str,
    parsed_topic: str,
    chunks_topic: str,
    extractor: Extractor = utf8_pages,
    window: int = WINDOW_SIZE,
    overlap: int = OVERLAP,
    max_files: int | None = None,
    number: int | None = None,
    now: Column | None = None,
    run: str = "",
) -> None:
    """Parse a batch of file messages and chunk what came of it; `number` and `run` name it in both topics."""
    done = run_parse(spark, messages, content, store, parsed_topic, extractor, max_files, number, now, run)
    parsed = read_topic(spark, parsed_topic, PARSED_RECORD, F.col("batch_id") == done.batch_id)
    run_chunk(spark, parsed, store, chunks_topic, window, overlap, max_files, number, done.version, now, run)
