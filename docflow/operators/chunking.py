"""Overlapping chunks of documents.

All of it is Spark expressions. A document is first cut into blocks of fixed length, so that reading a window
at any position touches two blocks only: the cost of a document grows with its length, not with its square.
"""

import math

from pyspark.sql import Column, DataFrame, functions as F

from docflow.functions.files import chunk_id
from docflow.functions.lets import let
from docflow.functions.text import boundary_cut, clean_for_chunking, has_text
from docflow.schemas import OVERLAP, SENTENCE_LOOK_BACK, WINDOW_SIZE

CHUNK_FIELDS = ["chunkIndex", "chunkText", "startPosition", "endPosition", "totalChunks"]
SPAN = "struct<s:int,e:int,t:string>"

# Chunks gathered before they are appended to a document's list, which keeps appending cheap for long ones.
STRIDE = 256


def check_window(window: int, overlap: int) -> None:
    if overlap >= window:
        raise ValueError("Overlap must be less than window size")
    if window <= 0 or overlap < 0:
        raise ValueError("Window size must be positive and overlap must be non-negative")


def _blocks(text: Column, size: int) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))


def _block(blocks: Column, index: Column) -> Column:
    return F.coalesce(F.get(blocks, index), F.lit(""))


def _length(blocks: Column, size: int) -> Column:
    last = F.size(blocks) - 1
    return F.when(last < 0, F.lit(0)).otherwise(last * size + F.length(F.get(blocks, last)))


def _span(start: Column, end: Column, text: Column) -> Column:
    return F.struct(start.cast("int").alias("s"), end.cast("int").alias("e"), text.alias("t"))


def boundary_spans(text: Column, window: int = WINDOW_SIZE, overlap: int = OVERLAP) -> Column:
    """`array<struct<s,e,t>>` of the chunks of a cleaned text, ends moved back to sentence or word boundaries.

    The list of chunks is the whole state: the next position follows from the last chunk. Only one chunk at a
    time passes through `let`, which copies what it returns.
    """
    check_window(window, overlap)
    least_advance = max(1, window - (SENTENCE_LOOK_BACK - 1) - overlap)
    none = F.array().cast(f"array<{SPAN}>")

    def next_position(spans: Column, start: Column) -> Column:
        last = F.get(spans, F.size(spans) - 1)
        back = last["e"] - overlap
        return F.when(F.size(spans) == 0, start).when(back > last["s"], back).otherwise(last["e"])

    def piece_at(blocks: Column, p: Column) -> Column:
        index = F.floor(p / window).cast("int")
        two = F.concat(_block(blocks, index), _block(blocks, index + 1))
        return F.substring(two, p - index * window + 1, F.lit(window))

    def chunk_at(blocks: Column, n: Column, p: Column) -> Column:
        def cut(piece: Column) -> Column:
            kept = F.when(p + window >= n, n - p).otherwise(boundary_cut(piece))
            return let(kept, lambda kept: _span(p, p + kept, F.substring(piece, F.lit(1), kept)))

        return F.array(let(piece_at(blocks, p), cut))

    def stride(blocks: Column, n: Column, steps: Column, start: Column) -> Column:
        def step(spans: Column) -> Column:
            p = next_position(spans, start)
            more = let(p, lambda p: F.when(p < n, chunk_at(blocks, n, p)).otherwise(none))
            return F.concat(spans, more)

        return F.aggregate(
            F.sequence(F.lit(1), F.least(F.lit(STRIDE), steps)), none, lambda spans, _: step(spans)
        )

    def all_spans(blocks: Column) -> Column:
        n = _length(blocks, window)
        steps = F.ceil(n / least_advance).cast("int") + 2
        strides = F.ceil(steps / STRIDE).cast("int")
        return F.when(n <= window, F.array(_span(F.lit(0), n, _block(blocks, F.lit(0))))).otherwise(
            F.aggregate(
                F.sequence(F.lit(1), strides),
                none,
                lambda spans, _: F.concat(spans, stride(blocks, n, steps, next_position(spans, F.lit(0)))),
            )
        )

    return let(_blocks(text, window), all_spans)


def simple_spans(text: Column, window: int = WINDOW_SIZE, overlap: int = OVERLAP) -> Column:
    """`array<struct<s,e,t>>` of windows at every `window - overlap` characters of a cleaned text."""
    check_window(window, overlap)
    step = window - overlap
    reach = math.ceil(window / step)

    def span(blocks: Column, n: Column, i: Column) -> Column:
        start = i * step
        joined = F.array_join(F.slice(blocks, i + 1, F.lit(reach)), "")
        return _span(start, F.least(start + window, n), F.substring(joined, F.lit(1), F.lit(window)))

    def spans(blocks: Column, n: Column) -> Column:
        whole = F.array_join(blocks, "")
        return F.when(n <= window, F.array(_span(F.lit(0), n, whole))).otherwise(
            F.transform(F.sequence(F.lit(0), F.size(blocks) - 1), lambda i: span(blocks, n, i))
        )

    return let(_blocks(text, step), lambda b: let(_length(b, step), lambda n: spans(b, n)))


def chunk_list(
    text: Column, window: int = WINDOW_SIZE, overlap: int = OVERLAP, boundaries: bool = True
) -> Column:
    """`array<struct>` of a document's chunks with index, text, positions and their number.

    Index and number come from the list itself, so no window function and no shuffle is needed for them. Text
    that is only control characters gives one empty chunk; look for blank text with `has_text` first.
    """
    spans = (boundary_spans if boundaries else simple_spans)(clean_for_chunking(text), window, overlap)

    def row(span: Column, index: Column, total: Column) -> Column:
        values = [index, span["t"], span["s"], span["e"], total]
        return F.struct(*[value.alias(name) for name, value in zip(CHUNK_FIELDS, values)])

    return let(spans, lambda all_: F.transform(all_, lambda span, i: row(span, i, F.size(all_))))


def explode_chunks(rows: DataFrame, chunks: Column, id_col: str, keep: list[str]) -> DataFrame:
    """One row per chunk of a list that is never empty: `keep` columns, chunkId and the fields of the chunk."""
    # The outer form keeps Spark from testing for empty lists, for which it would build each list twice.
    exploded = rows.select(*dict.fromkeys([*keep, id_col]), F.inline_outer(chunks).alias(*CHUNK_FIELDS))
    key = chunk_id(F.col(id_col).cast("string"), F.col("chunkIndex"))
    return exploded.select(*keep, key.alias("chunkId"), *CHUNK_FIELDS)


def chunk_documents(
    df: DataFrame,
    id_col: str,
    text_col: str,
    keep: list[str] | None = None,
    window: int = WINDOW_SIZE,
    overlap: int = OVERLAP,
    boundaries: bool = True,
) -> DataFrame:
    """One row per chunk of the documents that have text; nothing is shuffled."""
    kept = keep if keep is not None else [c for c in df.columns if c != text_col]
    chunks = chunk_list(F.col(text_col), window, overlap, boundaries)
    return explode_chunks(df.filter(has_text(F.col(text_col))), chunks, id_col, kept)


def chunk_statistics(chunks: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Count, total, average, least and greatest chunk length, all 0 without chunks."""
    size = F.length("chunkText")
    return chunks.groupBy(*(by or [])).agg(
        F.count("*").alias("total_chunks"),
        F.coalesce(F.sum(size), F.lit(0)).cast("long").alias("total_characters"),
        F.coalesce(F.avg(size), F.lit(0.0)).alias("average_chunk_size"),
        F.coalesce(F.min(size), F.lit(0)).alias("min_chunk_size"),
        F.coalesce(F.max(size), F.lit(0)).alias("max_chunk_size"),
    )
