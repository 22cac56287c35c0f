"""Landed listing pages: one JSON object per page."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docflow.operators.ordering import until_empty_page
from docflow.schemas import LISTING_PAGE

# A page holds fewer than 2**PAGE_BITS files, so that page and place on the page make one unique order value.
PAGE_BITS = 20


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages as landed. Reading by schema is the field mask: other fields are never parsed into columns."""
    return spark.read.schema(LISTING_PAGE).json(path)


def read_page_stream(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    return spark.readStream.schema(LISTING_PAGE).option("maxFilesPerTrigger", max_files).json(path)


def from_token(pages: DataFrame, token: str | None) -> DataFrame:
    """Pages from the one `token` stands for: the page after the one that handed it out. None starts at the first.

    A token that no page handed out is an error.
    """
    if token is None:
        return pages
    before = pages.filter(F.col("nextPageToken") == token).agg(F.max("page_no")).first()[0]
    if before is None:
        raise ValueError(f"no page hands out the token {token!r}")
    return pages.filter(F.col("page_no") > before)


def until_last_page(pages: DataFrame) -> DataFrame:
    """Pages up to the first one without a token for the next: the end of the listing."""
    ends = pages.filter(F.nullif(F.col("nextPageToken"), F.lit("")).isNull()).agg(F.min("page_no").alias("end"))
    return pages.filter(F.col("page_no") <= F.coalesce(ends.scalar(), F.lit(2**63 - 1)))


def page_sizes(pages: DataFrame) -> DataFrame:
    """page_no, nextPageToken and number of files of each page."""
    return pages.select("page_no", "nextPageToken", F.greatest(F.size("files"), F.lit(0)).alias("files"))


def next_token(pages: DataFrame) -> DataFrame:
    """The token to go on from: that of the last page; null after the end of the listing."""
    return pages.agg(F.max_by("nextPageToken", "page_no").alias("next_token"))


def list_files(pages: DataFrame) -> DataFrame:
    """One row per listed file, with page_no, pos and `offset`, which orders all files of the listing."""
    files = pages.select("page_no", F.posexplode("files").alias("pos", "file"))
    # A page too long for its offsets must not run into those of the next.
    too_long = F.raise_error(F.concat(F.lit(f"more than {1 << PAGE_BITS} files on page "), F.col("page_no")))
    place = F.when(F.col("pos") < 1 << PAGE_BITS, F.col("pos")).otherwise(too_long.cast("int"))
    return files.select((F.shiftleft("page_no", PAGE_BITS) + place).alias("offset"), "page_no", "pos", "file.*")


def page_of(offset: Column) -> Column:
    """Page of a file from its offset."""
    return F.shiftright(offset, PAGE_BITS)


def drain(pages: DataFrame, stop_at_empty: bool = False) -> DataFrame:
    """Files of all pages; with `stop_at_empty` only of those before the first page without files."""
    return list_files(until_empty_page(pages) if stop_at_empty else pages)
