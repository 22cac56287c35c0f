"""Shared pieces: scratch tables, words, word shingles, connected components."""

import contextlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docflow.session import work_folder
from docflow.sources import folders

# What parts words everywhere in this package: space, tab to carriage return.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
SHINGLE_WORDS = 5
LIKENESS = 0.75

_MASK = np.uint64(0xFFFFFFFFFFFFFFFF)


# What a Python worker holds at once: two of them share an executor's memory with its heap.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "16m"}


# Rows that hold a text or a set of shingles: by default a task's Parquet reader makes arrays for 4096 of them at once, anew for each file.
WIDE_ROWS = {"spark.sql.parquet.columnarReaderBatchSize": "512"}


def bounded(spark: SparkSession, wide: bool = False) -> SparkSession:
    """Bound the Arrow batches that Python workers get; with `wide` also the batches of rows that a task reads from Parquet."""
    for key, value in {**BATCHES, **(WIDE_ROWS if wide else {})}.items():
        spark.conf.set(key, value)
    return spark


# Folders and tables that pipeline stages have made, and whether one is being built just now.
_scratch: list[tuple[str, str | None]] = []
_recording = False


def scratch(spark: SparkSession, name: str, table: str | None = None) -> str:
    """A fresh folder for what an operator writes on its way, with the table of that name on it."""
    path = work_folder(spark, name)
    if _recording:
        _scratch.append((path, table))
    return path


@contextlib.contextmanager
def stage_scratch(spark: SparkSession) -> Iterator[None]:
    """What is written in this block goes when the next such block begins: by then a stage's result has been written."""
    global _recording
    while _scratch:
        path, name = _scratch.pop()
        if name is not None:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        folders.delete(spark, path)
    _recording = True
    try:
        yield
    finally:
        _recording = False


def kept(df: DataFrame, name: str) -> DataFrame:
    """Write a table to a fresh folder under spark.checkpoint.dir and read it from there: cuts the lineage, is computed once
    and survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(*tables: DataFrame) -> None:
    """Remove what `kept` wrote for these tables. No result that is still to be computed may read them."""
    for rows in tables:
        for path in {name.rsplit("/", 1)[0] for name in rows.inputFiles()}:
            folders.delete(rows.sparkSession, path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`; 0 for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % parts, F.lit(0))


# --- words and shingles inside tasks ------------------------------------------------------------


class WordTable(dict):
    """What `make` gives for a word. Remembers the last `limit` to 2 * `limit` words of up to 64 letters or bytes."""

    def __init__(self, make, limit: int = 300_000):
        super().__init__()
        self.make, self.limit, self.older = make, limit, {}

    def __missing__(self, word):
        value = self.older.get(word)
        if value is None:
            value = self.make(word)
        if len(word) <= 64:
            if len(self) >= self.limit:
                self.older = dict(self)
                self.clear()
            self[word] = value
        return value


def _random_words(name: str, n: int) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(f"{name} {i}") for i in range(n)], dtype=np.uint64)


_FACTORS = _random_words("place", 64) | np.uint64(1)
_SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
# A value per byte: A-Z have those of a-z, white space has none.
_BYTES = _random_words("byte", 256)
_BYTES[65:91] = _BYTES[97:123]
_BYTES[_SPACES] = 0
_BASE = xxhash.xxh3_64_intdigest("base") | 1
_STRETCH = 1 << 18


class _Powers:
    """Powers of an odd 64-bit base and their inverses, as many as were asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            k = len(self.up)
            step, back = pow(_BASE, k, 1 << 64), pow(_BASE, -k, 1 << 64)
            self.up = np.concatenate([self.up, self.up * np.uint64(step)])
            self.down = np.concatenate([self.down, self.down * np.uint64(back)])
        return self.up[:n], self.down[:n]


_powers = _Powers()


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word of a text, in order, A-Z lower-cased; by polynomials over its bytes, without a word table."""
    if len(text) > 2 * _STRETCH:
        # Cut long texts where a word ends.
        done, at = [], 0
        while at < len(text):
            end = at + _STRETCH
            while end < len(text) and not _SPACES[text[end]]:
                end += 1
            done.append(_stretch_hashes(text[at:end]))
            at = end
        return np.concatenate(done)
    return _stretch_hashes(text)


def _stretch_hashes(text: bytes) -> np.ndarray:
    points = np.frombuffer(text, dtype=np.uint8)
    up, down = _powers.get(len(points))
    space = np.ones(len(points) + 2, dtype=bool)
    space[1:-1] = _SPACES[points]
    edges = np.flatnonzero(space[1:] != space[:-1])
    start, end = edges[::2], edges[1::2]
    sums = np.zeros(len(points) + 1, dtype=np.uint64)
    np.cumsum(_BYTES[points] * up, out=sums[1:])
    return (sums[end] - sums[start]) * down[start]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def texts_as_bytes(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of each text."""
    return column.cast(pa.binary()).to_pylist()


def shingle_hashes(text: bytes | None, width: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text, A-Z lower-cased.

    A text with fewer words than `width` has its whole word sequence as one shingle; null or no word gives none.
    """
    hashes = word_hashes(text) if text else ()
    if not len(hashes):
        return np.empty(0, dtype=np.uint64)
    if len(hashes) < width:
        total = np.add.reduce(hashes * _FACTORS[: len(hashes)], keepdims=True) + np.uint64(len(hashes))
        return mixed(total)
    n = len(hashes) - width + 1
    total = hashes[:n] * _FACTORS[0]
    for i in range(1, width):
        total = total + hashes[i : n + i] * _FACTORS[i]
    total = mixed(total)
    total.sort()
    return total[np.concatenate([[True], total[1:] != total[:-1]])]


def set_hash(tokens: np.ndarray) -> int:
    """A signed 64-bit hash of a set of 64-bit hashes."""
    again = mixed(tokens ^ np.uint64(0x9E3779B97F4A7C15))
    folded = int(np.bitwise_xor.reduce(again)) * int(_FACTORS[0]) + int(np.add.reduce(again)) * int(_FACTORS[1]) + len(tokens)
    folded = (folded ^ (folded >> 64)) & 0xFFFFFFFFFFFFFFFF
    return folded - (1 << 64) if folded >> 63 else folded


# --- connected components -----------------------------------------------------------------------


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component: the least node reachable by edges, for each node of an edge.

    Large-star and small-star steps in turn until the edges are stars. Every step groups with a partial minimum and
    joins it back, so a node with very many edges is split by the join; no component ever meets in one task.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    pairs, before = kept(pairs, "edges"), None
    while True:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        larger = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        larger = larger.filter("u <> v").distinct()
        least = larger.groupBy("u").agg(F.min("v").alias("m"))
        smaller = larger.join(least, "u")
        smaller = smaller.select(F.col("v").alias("u"), F.col("m").alias("v")).union(smaller.select("u", F.col("m").alias("v")))
        done, pairs = pairs, kept(smaller.filter("u <> v").distinct(), "edges")
        release(done)
        now = pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            break
        before = now
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
