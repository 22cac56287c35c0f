"""Boundary chunks of texts too large for one task, by a parallel prefix.

Where a chunk starts follows from the chunk before it, from the start of a text on. A text is cut into ranges, and each range works
out, for every position at which the chain of chunks can enter it, where the chain leaves it and after how many chunks: a map of as many entries as
the window has characters. Maps of neighbours are composed into maps of groups of ranges, those into maps of groups of groups. On the way
back down every range is told where the chain really enters it, and all ranges emit their chunks at once.

A text comes as one row or as many pieces in order; neither its characters nor its ranges ever meet in one task. Neighbouring short ranges are
one row, a stretch: the window that a row has after its own characters would else be most of what is shuffled and written, and the maps
the rest. Their maps are composed where they are made. Characters are written once, and shuffled by no more than two exchanges of a job.
"""

import zlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from docflow.functions.files import chunk_id
from docflow.functions.text import CONTROL, collapse_spaces, has_text
from docflow.operators.chunking import CHUNK_FIELDS, check_window
from docflow.operators.prefix import earlier
from docflow.schemas import OVERLAP, SENTENCE_LOOK_BACK, WINDOW_SIZE, WORD_LOOK_BACK
from docflow.session import written

BLOCK = 100_000
# Stretches, or groups of them, that are composed into one.
GROUP = 256
# Characters of the ranges that make a stretch; a range as long as this is one by itself.
STRETCH = 100_000
SENTENCE_ENDS = np.array([ord(c) for c in ".!?\n"], dtype=np.uint32)
# chunks: those of a chain that enters at the first place; map: exits and counts of all places, see `packed`.
MAP = "idx long, chunks long, map binary"


# --- the rule on a stretch of text --------------------------------------------------------------


def chunk_steps(points: np.ndarray, limit: int, left: int, n: int, window: int, overlap: int) -> tuple[np.ndarray, np.ndarray]:
    """For a chunk at each of the first `limit` places of a stretch: its end and the next chunk's start, counted from the stretch's start.

    points: the stretch's code points and those of a window more, if the text has them; left: how long the text is from here; n: as a whole.
    """
    p = np.arange(limit)
    if n <= window:
        return np.full(limit, left), np.full(limit, left)
    at = np.arange(len(points))
    last = lambda hit: np.maximum.accumulate(np.where(hit, at, -1))
    whole = p + window >= left
    tail = np.minimum(p + window, len(points)) - 1
    sentence = last(np.isin(points, SENTENCE_ENDS))[tail]
    space = last(points == 32)[tail]
    end = np.where(space >= np.maximum(p + 1, p + window - WORD_LOOK_BACK), space, p + window)
    end = np.where(sentence >= np.maximum(p, p + window - SENTENCE_LOOK_BACK), sentence + 1, end)
    end = np.where(whole, left, end)
    return end, np.where(end - overlap > p, end - overlap, end)


def leave(following: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From each place, the first place outside that the chain comes to, and how many chunks start inside; by doubling the steps."""
    to, count = following.copy(), np.ones(len(following), dtype=np.int64)
    while True:
        inside = np.flatnonzero(to < len(to))
        if not len(inside):
            return to, count
        then = to[inside]
        count[inside] += count[then]
        to[inside] = to[then]


def range_map(points: np.ndarray, start: int, block: int, n: int, window: int, overlap: int) -> tuple[np.ndarray, np.ndarray]:
    """Per entry, counted from the range's start: the place of exit, counted from the next range's start, and the chunks between."""
    return next(range_maps(points, start, block, 1, n, window, overlap))


def range_maps(points: np.ndarray, start: int, block: int, ranges: int, n: int, window: int, overlap: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The maps of the ranges of a stretch, up to the end of the text; of a stretch after that end, that of the first."""
    limit = min(ranges * block, n - start)
    following = chunk_steps(points, limit, n - start, n, window, overlap)[1] if limit > 0 else np.empty(0, dtype=np.int64)
    for at in range(0, max(limit, 1), block):
        exits, counts = np.arange(window) - block, np.zeros(window, dtype=np.int64)
        own = following[at : at + block]
        if len(own):
            to, count = leave(own - at)
            first = min(window, len(own))
            exits[:first], counts[:first] = to[:first] - block, count[:first]
        yield np.clip(exits, 0, window - 1), counts


def then(before: tuple[np.ndarray, np.ndarray] | None, after: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The map of two neighbours."""
    if before is None:
        return after
    to, total = before
    exits, counts = after
    return exits[to], total + counts[to]


# --- pieces to ranges ---------------------------------------------------------------------------


def cut_pieces(df: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """key, seq, text: texts cut into pieces of `size` code points, dealt out to all tasks. A text without characters is one piece."""
    parts = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    cut = df.select(key, F.posexplode_outer(parts).alias("seq", "text"))
    cut = cut.select(key, F.coalesce("seq", F.lit(0)).cast("long").alias("seq"), F.coalesce("text", F.lit("")).alias("text"))
    return cut.repartition(key, "seq")


def cleaned_pieces(pieces: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The pieces of the cleaned texts, with their place (key, body, place), and (key, n) of the texts that are not blank.

    The same text as cleaning the whole gives: white space that goes on in the next piece is one space, and spaces at both ends of
    the whole go after control characters have gone.
    """
    c = collapse_spaces(F.col("text"))
    ends = F.when(F.length("c") > 0, F.struct("seq", F.col("c").endswith(" ").alias("space")))
    # Of the text without the control characters; a space at its start is there before they go.
    measured = pieces.select(key, "seq", c.alias("c"), has_text(F.col("text")).alias("some")).withColumn("body", _without_control(F.col("c"))).select(
        key, "seq", "some", ends.alias("ends"), F.col("c").startswith(" ").alias("lead"), F.length("body").cast("long").alias("size"),
        F.length(F.ltrim("body")).alias("from"), F.length(F.rtrim("body")).alias("to"),
    )
    measured = written(measured, "measures", tidy=True)
    before = earlier(measured.select(key, "seq", "ends"), [key], "seq", {"last": ("max", F.col("ends"))})
    before = written(before.select(key, "seq", F.coalesce("last.space", F.lit(False)).alias("after_space")), "spaces", tidy=True)
    rows = measured.drop("ends").join(before, [key, "seq"])
    less = (F.col("after_space") & F.col("lead")).cast("int")
    rows = rows.select(key, "seq", "some", (F.col("size") - less).alias("size"), "from", (F.col("to") - less).alias("to"))
    placed = earlier(rows, [key], "seq", {"place": ("sum", F.col("size"))}).withColumn("place", F.coalesce("place", F.lit(0)))
    letters = F.col("from") > 0
    texts = placed.groupBy(key).agg(
        F.min(F.when(letters, F.col("place") + F.col("size") - F.col("from"))).alias("first"),
        F.max(F.when(letters, F.col("place") + F.col("to"))).alias("last"),
        F.max("some").alias("some"),
    )
    texts = texts.filter("some").select(key, F.coalesce("first", F.lit(0)).alias("first"), (F.coalesce("last", F.lit(0)) - F.coalesce("first", F.lit(0))).alias("n"))
    places = written(placed.join(texts, key).select(key, "seq", (F.col("place") - F.col("first")).alias("place"), "n"), "places", tidy=True)
    body = F.when(F.col("after_space") & F.col("c").startswith(" "), F.substring("c", F.lit(2), F.length("c"))).otherwise(F.col("c"))
    rows = pieces.join(before, [key, "seq"]).join(places, [key, "seq"]).withColumn("c", c).select(key, _without_control(body).alias("body"), "place", "n")
    return rows, places.select(key, "n").distinct()


def _without_control(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(CONTROL), F.lit(""))


def ranges(pieces: DataFrame, texts: DataFrame, key: str, block: int, window: int) -> DataFrame:
    """key, idx, n, text, parts: the stretches, of `block` characters, of the cleaned texts, each with the window after it. A text without characters has one.

    Pieces that share a key and a seq overlap: `parts` has those of such a stretch with their places, and is null else.
    """
    size = F.length("body")
    start, end = F.greatest("place", F.lit(0)), F.least(F.col("place") + size, F.col("n"))
    lowest = F.greatest(F.lit(0), F.floor((start - window) / block))
    inside = pieces.filter(start < end).withColumn("idx", F.explode(F.sequence(lowest, F.floor((end - 1) / block))))
    low = F.greatest(start, F.col("idx") * block)
    high = F.least(end, (F.col("idx") + 1) * block + window)
    part = F.struct(low.alias("at"), F.substring("body", (low - F.col("place") + 1).cast("int"), (high - low).cast("int")).alias("text"))
    parts = inside.filter(low < high).select(key, "idx", "n", part.alias("part")).groupBy(key, "idx", "n").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    text = F.array_join("parts.text", "")
    apart = F.length(text) == F.least(F.col("n"), (F.col("idx") + 1) * block + window) - F.col("idx") * block
    found = parts.select(key, "idx", "n", F.when(apart, text).alias("text"), F.when(~apart, F.col("parts")).alias("parts"))
    none = texts.filter("n = 0").select(key, F.lit(0).cast("long").alias("idx"), "n", F.lit("").alias("text"), F.lit(None).cast(found.schema["parts"].dataType).alias("parts"))
    return found.unionByName(none)


# --- maps up and entries down -------------------------------------------------------------------


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)


def _readings(text: str | None, parts: list[dict] | None, start: int, block: int, size: int, n: int, window: int) -> list[tuple[int, int, str]]:
    """Start, length and text of what of a stretch is read at once: all of it, or each range if pieces overlap."""
    if parts is None:
        return [(start, size, text)]
    found = []
    for at in range(start, min(start + size, n), block):
        end = min(n, at + block + window)
        own = ((p["at"], p["text"]) for p in parts if p["at"] < end and p["at"] + len(p["text"]) > at)
        own = sorted((max(place, at), part[max(at - place, 0) : end - place]) for place, part in own)
        found.append((at, block, "".join(part for _, part in own)))
    return found


def packed(exits: np.ndarray, counts: np.ndarray) -> bytes:
    """A map in few bytes: chains of neighbouring places soon meet, so nearly all differences between neighbours are 0 or 1."""
    return zlib.compress(np.diff(exits, prepend=0).astype(np.int32).tobytes() + np.diff(counts, prepend=0).astype(np.int64).tobytes(), 1)


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zlib.decompress(data)
    window = len(raw) // 12
    exits, counts = np.frombuffer(raw, np.int32, window), np.frombuffer(raw, np.int64, window, 4 * window)
    return np.cumsum(exits), np.cumsum(counts)


def _map_batch(keys: pa.Array, maps: Iterable[tuple], key: str) -> pa.RecordBatch:
    """Rows of MAP of (idx, exits, counts) with their keys; a map is packed before the next is taken."""
    rows = [(idx, int(counts[0]), packed(exits, counts)) for idx, exits, counts in maps]
    arrays = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary()))]
    return pa.RecordBatch.from_arrays([keys, *arrays], names=[key, "idx", "chunks", "map"])


def _maps(found: DataFrame, key: str, block: int, per: int, window: int, overlap: int) -> DataFrame:
    """The maps of stretches of `per` ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("idx", "n", "text", "parts")))
            maps = ((idx, *reduce(then, of_stretch(idx, n, text, parts), None)) for idx, n, text, parts in rows)
            yield _map_batch(batch.column(key), maps, key)

    def of_stretch(idx, n, text, parts):
        for at, size, read in _readings(text, parts, idx * per * block, block, per * block, n, window):
            yield from range_maps(_code_points(read), at, block, size // block, n, window, overlap)

    return found.select(key, "idx", "n", "text", "parts").mapInArrow(run, f"{_type(found, key)}, {MAP}")


def _type(df: DataFrame, key: str) -> str:
    return f"`{key}` {df.schema[key].dataType.simpleString()}"


def _map_rows(batch: pa.RecordBatch, key: str, *more: str) -> Iterator[tuple]:
    """(key, group), idx, exits, counts, ... of the rows of a batch, one map at a time."""
    names, groups, places, maps, *others = (batch.column(c).to_pylist() for c in (key, "_group", "idx", "map", *more))
    for name, group, idx, data, *rest in zip(names, groups, places, maps, *others):
        yield (name, group), idx, *unpacked(data), *rest


def _grouped(maps: DataFrame, key: str) -> DataFrame:
    """Rows of a group next to each other, in order."""
    rows = maps.withColumn("_group", F.floor(F.col("idx") / GROUP))
    return rows.repartition(key, "_group").sortWithinPartitions(key, "_group", "idx")


def _composed(maps: DataFrame, key: str) -> DataFrame:
    """The maps of groups. A group is read as a stream: only the map so far is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = so_far = kind = None
        for batch in batches:
            kind, done = batch.column(key).type, []
            for own, _, exits, counts in _map_rows(batch, key):
                if own != last:
                    if last is not None:
                        done.append((last, *so_far))
                    last, so_far = own, None
                so_far = then(so_far, (exits, counts))
            yield groups(done, kind)
        if last is not None:
            yield groups([(last, *so_far)], kind)

    def groups(done, kind):
        return _map_batch(pa.array([name for (name, _), _, _ in done], kind), [(group, to, total) for (_, group), to, total in done], key)

    return _grouped(maps, key).mapInArrow(run, f"{_type(maps, key)}, {MAP}")


def _entered(maps: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """key, idx, entry, first: where the chain enters each row's range and the number of its first chunk, from those of the groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, at, number = None, 0, 0
        for batch in batches:
            found = []
            for own, _, exits, counts, entry, first in _map_rows(batch, key, "entry", "first"):
                if own != last:
                    last, at, number = own, entry, first
                found.append((at, number))
                at, number = int(exits[at]), number + int(counts[at])
            entered = [pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(key), batch.column("idx"), *entered], names=[key, "idx", "entry", "first"])

    groups = groups.withColumnRenamed("idx", "_group")
    rows = maps.withColumn("_group", F.floor(F.col("idx") / GROUP)).join(groups, [key, "_group"])
    rows = rows.repartition(key, "_group").sortWithinPartitions(key, "_group", "idx")
    return rows.mapInArrow(run, f"{_type(maps, key)}, idx long, entry long, first long")


def entries(found: DataFrame, key: str, block: int, per: int, window: int, overlap: int) -> DataFrame:
    """key, idx, entry, first, total: for each stretch where the chain enters, the number of its first chunk, and all chunks of its text."""
    levels = [written(_maps(found, key, block, per, window, overlap), "range-maps", tidy=True)]
    while (levels[-1].agg(F.max("idx")).first()[0] or 0) > 0:
        levels.append(written(_composed(levels[-1], key), "group-maps", tidy=True))
    zero = F.lit(0).cast("long")
    top = levels.pop()
    totals = top.select(key, F.col("chunks").alias("total"))
    entered = top.select(key, "idx", zero.alias("entry"), zero.alias("first"))
    for maps in reversed(levels):
        entered = _entered(maps, entered, key)
    return entered.join(totals, key)


def _emitted(found: DataFrame, key: str, block: int, per: int, window: int, overlap: int) -> DataFrame:
    fields = "chunkIndex long, chunkText string, startPosition long, endPosition long, totalChunks long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = ("idx", "n", "text", "parts", "entry", "first", "total")
            rows, own = [], []
            for i, (idx, n, text, parts, p, first, total) in enumerate(zip(*(batch.column(c).to_pylist() for c in names))):
                spans = [("", 0, 0)] if n == 0 else []
                for at, size, read in _readings(text, parts, idx * per * block, block, per * block, n, window):
                    limit = min(size, n - at)
                    ends, following = chunk_steps(_code_points(read), limit, n - at, n, window, overlap) if p < limit else ((), ())
                    while p < limit:
                        end = int(ends[p])
                        spans.append((read[p:end], at + p, at + end))
                        p = int(following[p])
                    p = min(max(p - size, 0), window - 1)
                rows += [(first + k, *span, max(total, 1)) for k, span in enumerate(spans)]
                own += [i] * len(spans)
            if rows:
                arrays = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()))]
                yield pa.RecordBatch.from_arrays([batch.column(key).take(pa.array(own)), *arrays], names=[key, *CHUNK_FIELDS])

    columns = found.select(key, "idx", "n", "text", "parts", "entry", "first", "total")
    return columns.mapInArrow(run, f"{_type(found, key)}, {fields}")


def chunk_pieces(pieces: DataFrame, key: str, window: int = WINDOW_SIZE, overlap: int = OVERLAP, block: int = BLOCK) -> DataFrame:
    """key, chunkId and the chunk fields, as longs, of the texts that the pieces (key, seq, text) of each key make in order of seq.

    The chunks are those of `chunk_documents` of the whole text: a text that is blank as a whole has none, one of control characters only has an
    empty one. A null text is an empty piece. seq is unique within a key; rows without key or seq belong to no text.
    """
    check_window(window, overlap)
    if block <= 0:
        raise ValueError("A range has at least one character")
    whole = pieces.filter(F.col(key).isNotNull() & F.col("seq").isNotNull())
    whole = whole.select(key, F.col("seq").cast("long").alias("seq"), F.coalesce("text", F.lit("")).alias("text"))
    cleaned, texts = cleaned_pieces(whole, key)
    per = max(1, STRETCH // block)
    found = written(ranges(cleaned, texts, key, per * block, window), "ranges", tidy=True)
    rows = _emitted(found.join(entries(found, key, block, per, window, overlap), [key, "idx"]), key, block, per, window, overlap)
    number: Column = F.col("chunkIndex")
    return rows.select(key, chunk_id(F.col(key).cast("string"), number).alias("chunkId"), *CHUNK_FIELDS)


def chunk_large_texts(
    df: DataFrame, key: str, text: str, window: int = WINDOW_SIZE, overlap: int = OVERLAP, block: int = BLOCK
) -> DataFrame:
    """`chunk_pieces` of texts of a row each (key unique), which are cut into pieces first."""
    return chunk_pieces(cut_pieces(df, key, text, 8 * block), key, window, overlap, block)
