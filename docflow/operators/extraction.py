"""Bytes to text with a pluggable extractor, and assembly of page texts."""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from docflow.functions.text import clean_extracted, parse_status, text_length
from docflow.sources.files import open_path

# bytes -> texts of the pages, in page order; may raise
Extractor = Callable[[bytes], list[str]]
# path -> bytes; may raise
Reader = Callable[[str], bytes]

# Pages joined at a time; a file's blocks of pages are joined after that.
PAGE_BLOCK = 1000


def utf8_pages(content: bytes) -> list[str]:
    """One page of UTF-8 text; form feeds part pages."""
    return content.decode("utf-8").split("\f")


def html_pages(content: bytes) -> list[str]:
    """One page: the text of an HTML document without scripts and styles."""
    import html.parser

    class Text(html.parser.HTMLParser):
        hidden = 0

        def handle_starttag(self, tag, attrs):
            self.hidden += tag in ("script", "style")

        def handle_endtag(self, tag):
            self.hidden -= tag in ("script", "style") and self.hidden > 0

        def handle_data(self, data):
            if not self.hidden:
                parts.append(data)

    parts: list[str] = []
    reader = Text(convert_charrefs=True)
    reader.feed(content.decode("utf-8"))
    reader.close()
    return [" ".join(parts)]


def page_texts(content: Column, extractor: Extractor, reader: Reader | None = None) -> Column:
    """`array<string>` of page texts; null if there are no bytes or the extractor raises.

    Only the bytes go to Python; the other columns of the row stay in the JVM. With a reader `content` is a path, which is opened where it is
    extracted, one file at a time; null if that fails.
    """

    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def pages(value):
            if value is None:
                return None
            try:
                return [str(page) for page in extractor(bytes(value) if reader is None else reader(value))]
            except Exception:  # a file that cannot be read must not end the job
                return None

        for batch in batches:
            yield pd.Series([pages(value) for value in batch], dtype=object)

    # The types are given here: as text the annotations would have to be importable on the workers.
    extract.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(extract, "array<string>")(content)


def join_pages(pages: Column) -> Column:
    """Page texts in order, each followed by a newline; null stays null."""
    return F.array_join(F.transform(pages, lambda p: F.concat(F.coalesce(p, F.lit("")), F.lit("\n"))), "")


def extract_paths(df: DataFrame, extractor: Extractor, reader: Reader = open_path, path: str = "path") -> DataFrame:
    """`extract_text` of the files at the paths of df; the files' bytes do not leave the tasks that open them."""
    return extract_text(df, extractor, path, reader)


def extract_text(df: DataFrame, extractor: Extractor, content: str = "content", reader: Reader | None = None) -> DataFrame:
    """Replace `content` by text, status (`success`, `empty`, `failed`) and text_length; text is null unless success."""
    raw = df.withColumn("_pages", page_texts(F.col(content), extractor, reader)).drop(content)
    cleaned = raw.withColumn("_text", F.when(F.col("_pages").isNotNull(), clean_extracted(join_pages(F.col("_pages")))))
    judged = cleaned.withColumn("status", parse_status(F.col("_text")))
    text = F.when(F.col("status") == "success", F.col("_text"))
    return judged.withColumn("text", text).withColumn("text_length", text_length(text)).drop("_pages", "_text")


def assemble_pages(pages: DataFrame, key: str, page: str = "page", text: str = "text") -> DataFrame:
    """One row per file: its page texts in page order, each followed by a newline.

    Blocks of pages are joined first and the blocks of a file after that, so no task holds the single pages of a
    file. The text of a file is one value, as large as a value can be.
    """

    def joined(order: str, part: str) -> Column:
        parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(part).alias("t"))))
        return F.array_join(F.transform(parts, lambda p: p["t"]), "")

    line = F.concat(F.coalesce(F.col(text), F.lit("")), F.lit("\n"))
    blocks = (
        pages.select(key, page, line.alias("_line"), F.floor(F.col(page) / PAGE_BLOCK).alias("_block"))
        .groupBy(key, "_block")
        .agg(joined(page, "_line").alias("_text"))
    )
    return blocks.groupBy(key).agg(joined("_block", "_text").alias(text))
