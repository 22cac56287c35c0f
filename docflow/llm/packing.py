"""Packing documents into token sequences: best-fit decreasing, certified by lower bounds, repacked where there is a gap."""

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from docflow.llm.common import kept
from docflow.llm.tokens import REMEMBERED, map_ids

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
)
PACKED = T.StructType(
    [*PIECES, *(T.StructField(name, T.LongType()) for name in ("part", "sequence_id", "offset", "bins", "bound", "given"))]
)
# Partitions that exchange documents meet so many at a time.
MEET = 4


def pieces(docs: DataFrame, tokenizer: str, length: int, end_id: int, remembered: int = REMEMBERED) -> DataFrame:
    """The documents' pieces: ids of the text and the end id, cut every `length` ids. Null text is empty: the end id alone."""
    end = end_id.to_bytes(4, "little")

    def make(doc_ids, texts, encode):
        ids_of, number, start, size, crc = [], [], [], [], []
        for doc_id, text in zip(doc_ids, texts):
            ids = encode(text) + end
            for piece, at in enumerate(range(0, len(ids), 4 * length)):
                cut = ids[at : at + 4 * length]
                ids_of.append(doc_id)
                number.append(piece)
                start.append(at // 4)
                size.append(len(cut) // 4)
                crc.append(zlib.crc32(cut))
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return [pa.array(c, k) for c, k in zip((ids_of, number, start, size, crc), kinds)]

    return map_ids(docs, tokenizer, True, make, PIECES, remembered)


def least_bins(lengths: np.ndarray, capacity: int) -> int:
    """A lower bound of the bins that any packing takes, by dual-feasible functions.

    Each function maps lengths so that what fits into a bin still fits; the mapped total over the capacity bounds the bins.
    Two families: small lengths to 0 and lengths over capacity minus the same to 1; and lengths rounded to k-ths.
    """
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    up_to = np.cumsum(count * size)
    over = len(lengths) - np.cumsum(count)
    small = np.arange(0, capacity // 2 + 1)
    middle = up_to[capacity - small] - np.where(small > 0, up_to[np.maximum(small - 1, 0)], 0)
    best = int(np.max(-(-(over[capacity - small] * capacity + middle) // capacity)))
    for k in range(1, 33):
        whole, part = np.divmod((k + 1) * size, capacity)
        # k times the mapped length: (k x) where (k + 1) x is whole, else floor((k + 1) x), with x the share of a bin.
        mapped = np.where(part == 0, k * size, whole * capacity)
        best = max(best, int(-(-int(np.sum(mapped * count)) // (k * capacity))))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, by best-fit decreasing."""
    bins, offsets = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, used = 0, 0  # bit r of rooms: some bin has room r
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, at, used = capacity, used, used + 1
        bins[i], offsets[i] = at, capacity - room
        left = room - length
        if left:
            if not by_room[left]:
                rooms |= 1 << left
            by_room[left].append(at)
    return bins, offsets


def _packer(turn: int, last: bool, length: int, exchange: int) -> Callable[[pa.Table], pa.Table]:
    """Packs one partition's pieces; sequence_id -1 marks what is given away."""

    def run(group: pa.Table) -> pa.Table:
        lengths = group.column("length").to_numpy()
        bins, offsets = best_fit(lengths, length)
        used = int(bins.max()) + 1
        sequence = (turn << 56) + (group.column("part")[0].as_py() << 24) + bins
        bound, away = least_bins(lengths, length), 0
        if not last:
            gap = used - bound
            room = length - np.bincount(bins, weights=lengths, minlength=used)
            given = np.argsort(-room, kind="stable")[: max(1, gap * exchange)]
            open_bin = np.zeros(used, dtype=bool)
            open_bin[given[room[given] > 0]] = True
            sequence, away = np.where(open_bin[bins], -1, sequence), int(open_bin.sum())
        counts = [pa.array(np.full(len(lengths), n, dtype=np.int64)) for n in (used, bound, away)]
        columns = [*(group.column(f.name) for f in PIECES), group.column("part"), pa.array(sequence), pa.array(offsets), *counts]
        return pa.Table.from_arrays(columns, names=PACKED.names)

    return run


def pack(
    docs: DataFrame, tokenizer: str, length: int = 4096, end_id: int = 1, pieces_per_partition: int = 50_000, exchange: int = 8,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of all pieces of docs (doc_id long, text).

    Pieces are dealt evenly to partitions of bounded size, whatever their documents. Each partition is packed by best-fit
    decreasing. Where the bins equal the lower bound of `least_bins`, the packing is certified and only its emptiest bin is given
    away; elsewhere the `exchange` emptiest bins for each bin above the bound are. What is given away meets with that of
    other partitions, four at a time, and is packed again, until one partition is left.
    Null text is a document of the end id alone; a null doc_id is kept; repeated rows are packed each on its own; no documents
    give no rows.
    """
    return pack_with_bounds(docs, tokenizer, length, end_id, pieces_per_partition, exchange, remembered)[0]


def pack_with_bounds(
    docs: DataFrame, tokenizer: str, length: int = 4096, end_id: int = 1, pieces_per_partition: int = 50_000, exchange: int = 8,
    remembered: int = REMEMBERED,
) -> tuple[DataFrame, DataFrame]:
    """The rows of `pack`, and turn, part, bins, bound, given of each partition that was packed, the last one too.

    bound is what any packing of the partition's pieces takes at least: bins equal to it are certified. given of the bins were
    given away to the next turn. The bounds hold for their partitions, not for all pieces together.
    """
    rows = kept(pieces(docs, tokenizer, length, end_id, remembered), "pieces")
    parts = max(1, -(-rows.count() // pieces_per_partition))
    # The rows of a written table keep their place, also when they are read again.
    rows = rows.withColumn("part", F.pmod(F.monotonically_increasing_id(), F.lit(parts)))
    done, bounds, turn = None, None, 0
    while True:
        last = parts == 1
        packed = kept(rows.groupBy("part").applyInArrow(_packer(turn, last, length, exchange), PACKED), "packed")
        own = packed.select(F.lit(turn).alias("turn"), "part", "bins", "bound", "given").distinct()
        bounds = own if bounds is None else bounds.unionByName(own)
        final = packed.filter("sequence_id >= 0").drop("part", "bins", "bound", "given")
        done = final if done is None else done.unionByName(final)
        if last:
            return done, bounds
        parts, turn = -(-parts // MEET), turn + 1
        rows = packed.filter("sequence_id < 0").select(*PIECES.names, F.floor(F.col("part") / MEET).alias("part"))
