"""Token ids in files of independent zstandard frames with a trailing seek table.

A file: zstandard frames, each the same number of bytes of ids (the last may be shorter); a skippable frame with the index
of documents (doc_id, number of ids); a skippable frame with the seek table in the published seekable format: per frame its
compressed and raw size and the low 32 bits of the XXH64 of its raw bytes. Any zstandard reader can decompress the file; a reader of single
documents fetches the tables and the frames those documents lie in.
"""

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from io import BytesIO

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from docflow.llm.common import kept, text_or_empty, texts_as_bytes
from docflow.llm.tokens import encoder
from docflow.session import work_folder

# Fixed values of the seekable format.
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SKIPPABLE_INDEX = 0x184D2A50
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

FRAME_BYTES = 256 * 1024
ID_BYTES = 4
MANIFEST = "shard long, path string, n_docs long, n_ids long"
_INDEX = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64())])


def file_system(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system of a folder, on this or any other machine, and the path in it."""
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return (arrow_fs.LocalFileSystem(), uri) if uri.startswith("/") else arrow_fs.FileSystem.from_uri(uri)


class FileWriter:
    """Writes documents' ids one after the other; holds one frame and the index."""

    def __init__(self, stream, level: int = 3):
        self.stream, self.compressor = stream, zstandard.ZstdCompressor(level=level)
        self.held, self.frames, self.doc_ids, self.sizes = bytearray(), [], [], []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.doc_ids.append(doc_id)
        self.sizes.append(len(ids) // ID_BYTES)
        self.held += ids
        while len(self.held) >= FRAME_BYTES:
            self._frame(bytes(self.held[:FRAME_BYTES]))
            del self.held[:FRAME_BYTES]

    def _frame(self, raw: bytes) -> None:
        packed = self.compressor.compress(raw)
        self.stream.write(packed)
        self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))

    def close(self) -> None:
        if self.held:
            self._frame(bytes(self.held))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, _INDEX) as out:
            out.write_batch(pa.record_batch([pa.array(self.doc_ids, pa.int64()), pa.array(self.sizes, pa.int64())], schema=_INDEX))
        index = self.compressor.compress(sink.getvalue().to_pybytes())
        self.stream.write(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
        entries = b"".join(struct.pack("<III", *frame) for frame in self.frames)
        foot = struct.pack("<IBI", len(self.frames), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.stream.write(struct.pack("<II", SKIPPABLE_SEEK_TABLE, len(entries) + len(foot)) + entries + foot)


class FileReader:
    """Reads single documents: decompresses only the frames they lie in and checks each frame's checksum."""

    def __init__(self, file):
        self.file, size = file, file.size()
        n, flags, magic = struct.unpack("<IBI", self._bytes(size - 9, 9))
        if magic != SEEKABLE_MAGIC or flags != CHECKSUM_FLAG:
            raise ValueError("no seek table with checksums")
        entries = np.frombuffer(self._bytes(size - 9 - 12 * n, 12 * n), dtype="<u4").reshape(n, 3)
        self.packed, self.raw, self.sums = (entries[:, i].astype(np.int64) for i in range(3))
        self.at = np.r_[0, np.cumsum(self.packed)]
        table = size - 9 - 12 * n - 8
        magic, length = struct.unpack("<II", self._bytes(int(self.at[-1]), 8))
        if magic != SKIPPABLE_INDEX or int(self.at[-1]) + 8 + length != table:
            raise ValueError("no document index")
        index = zstandard.ZstdDecompressor().decompress(self._bytes(int(self.at[-1]) + 8, length))
        index = pa.ipc.open_stream(BytesIO(index)).read_all()
        self.doc_ids, self.sizes = index.column("doc_id").to_pylist(), index.column("n_tokens").to_numpy()
        self.starts = np.r_[0, np.cumsum(self.sizes)]
        self.frame = lru_cache(maxsize=4)(self._frame)

    def _bytes(self, start: int, length: int) -> bytes:
        self.file.seek(start)
        return self.file.read(length)

    def _frame(self, number: int) -> bytes:
        packed = self._bytes(int(self.at[number]), int(self.packed[number]))
        raw = zstandard.ZstdDecompressor().decompress(packed, max_output_size=int(self.raw[number]))
        if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.sums[number]:
            raise ValueError(f"frame {number}: wrong checksum")
        return raw

    def ids(self, place: int) -> bytes:
        """The ids of the document at a place of the file."""
        start, stop = int(self.starts[place]) * ID_BYTES, int(self.starts[place + 1]) * ID_BYTES
        if start == stop:
            return b""
        first, last = start // FRAME_BYTES, (stop - 1) // FRAME_BYTES
        found = b"".join(self.frame(i) for i in range(first, last + 1))
        return found[start - first * FRAME_BYTES : stop - first * FRAME_BYTES]


def write_tokens(docs: DataFrame, definition: str, end_id: int, folder: str | None = None) -> DataFrame:
    """Write the ids of docs (doc_id long, text), each with the end id, in ascending doc_id order; gives the manifest.

    Null ids come first, equal ids in the order of a hash of their text and of the text. Null text is empty. The manifest has a row per file: shard
    (files in order), path, n_docs, n_ids. A task writes a file of a name of its own, and only files of tasks that succeeded are in
    the manifest. The folder must be one that every executor can reach; by default one under spark.checkpoint.dir.
    """
    folder = folder or work_folder(docs.sparkSession, "token-files")
    rows = docs.select("doc_id", text_or_empty().alias("text")).withColumn("tie", F.xxhash64("text"))
    # By the tie, too: rows that share an id are no reason for one large file.
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(definition, False).ids, end_id.to_bytes(ID_BYTES, "little")
        shard, writer, n_ids = TaskContext.get().partitionId(), None, 0
        system, root = file_system(folder)
        name = f"part-{shard:06d}-{uuid.uuid4().hex}.tokens.zst"
        for batch in batches:
            if batch.num_rows and writer is None:
                system.create_dir(root, recursive=True)
                writer = FileWriter(system.open_output_stream(f"{root}/{name}", compression=None))
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_as_bytes(batch.column("text"))):
                ids = encode(text) + end
                writer.add(doc_id, ids)
                n_ids += len(ids) // ID_BYTES
        if writer is not None:
            writer.close()
            writer.stream.close()
            row = {"shard": [shard], "path": [f"{folder}/{name}"], "n_docs": [len(writer.sizes)], "n_ids": [n_ids]}
            yield pa.RecordBatch.from_pydict(row)

    return kept(rows.mapInArrow(run, MANIFEST), "token-manifest")


def read_tokens(manifest: DataFrame, doc_ids: DataFrame | None = None) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and ids (binary) of the written documents.

    With doc_ids (a column doc_id) only those documents; only their frames are decompressed.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = manifest.withColumn("first", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    files = files.repartition(max(1, manifest.count()), "shard")
    if doc_ids is None:
        return files.mapInArrow(_read_all, _READ)
    # Which file a document is in stands in the files' indexes; places by file then say what to decompress.
    places = files.mapInArrow(_read_index, "shard long, path string, first long, doc_id long, place long")
    wanted = places.join(doc_ids.select("doc_id").distinct(), "doc_id")
    wanted = wanted.groupBy("shard", "path", "first", F.floor(F.col("place") / 10_000).alias("run")).agg(
        F.sort_array(F.collect_list("place")).alias("places")
    )
    return wanted.select("path", "first", "places").mapInArrow(_read_places, _READ)


_READ = "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"


def _reader(path: str) -> FileReader:
    system, inner = file_system(path)
    return FileReader(system.open_input_file(inner))


def _documents(reader: FileReader, first: int, places: Iterable[int]) -> Iterator[pa.RecordBatch]:
    rows, held = [], 0
    for place in places:
        ids = reader.ids(place)
        rows.append((reader.doc_ids[place], first + int(reader.starts[place]), len(ids) // ID_BYTES, zlib.crc32(ids), ids))
        held += len(ids)
        if held > 8_000_000:
            yield _batch(rows)
            rows, held = [], 0
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def _read_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            reader = _reader(row["path"])
            yield from _documents(reader, row["first"], range(len(reader.sizes)))


def _read_index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = _reader(row["path"]).doc_ids
            n = len(ids)
            yield pa.RecordBatch.from_pydict(
                {"shard": [row["shard"]] * n, "path": [row["path"]] * n, "first": [row["first"]] * n, "doc_id": pa.array(ids, pa.int64()),
                 "place": list(range(n))}
            )


def _read_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            yield from _documents(_reader(row["path"]), row["first"], row["places"])


def tokenizer_definition(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def round_trip(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write all documents and read them back from the files."""
    return read_tokens(write_tokens(docs, tokenizer_definition(tokenizer), end_id))
