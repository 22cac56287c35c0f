"""Pairs within groups of rows, tile by tile: a group of any size is cut into blocks, and each pair of blocks is a tile of its own.

Tiles are dealt out by group and blocks, so a large group is spread over tasks and no task holds more than a tile at once.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

BLOCK = 256
# So many pairs are looked at in one go.
PAIRS = 1 << 18


def tiled(rows: DataFrame, keys: list[str], member: str, block: int = BLOCK) -> DataFrame:
    """The rows of groups (by `keys`) that have several rows, once per tile: adds a <= b, the tile's blocks, and `right`, in which.

    A row's block follows from a hash of `member`, which is unique within a group. Sorted by tile within partitions.
    """
    counts = rows.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1")
    blocks = F.ceil(F.col("_n") / block)
    own = rows.join(counts, keys).withColumn("_own", F.pmod(F.xxhash64(F.lit("block"), F.col(member)), blocks).cast("int"))
    tile = F.transform(
        F.sequence(F.lit(0), (blocks - 1).cast("int")),
        lambda o: F.struct(F.least(o, "_own").alias("a"), F.greatest(o, "_own").alias("b"), (o < F.col("_own")).alias("right")),
    )
    dealt = own.withColumn("_tile", F.explode(tile)).select(*rows.columns, "_tile.*")
    return dealt.repartition(*keys, "a", "b").sortWithinPartitions(*keys, "a", "b", "right")


def whole_tiles(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole tiles, with the place where each tile starts, from the batches of a partition of `tiled`."""
    rest = None
    for batch in batches:
        if batch.num_rows:
            rest = pa.concat_tables([*([rest] if rest is not None else []), pa.Table.from_batches([batch])]).combine_chunks()
            starts = _starts(rest, keys)
            if len(starts) > 1:
                yield rest.slice(0, starts[-1]), starts[:-1]
                rest = rest.slice(starts[-1])
    if rest is not None:
        yield rest, _starts(rest, keys)


def _starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(table.num_rows, dtype=bool)
    new[0] = True
    for key in (*keys, "a", "b"):
        values = table.column(key).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def pairs(table: pa.Table, starts: np.ndarray, most: int = PAIRS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers i, j of all pairs to look at in these tiles, at most about `most` at once."""
    n = table.num_rows
    ends = np.append(starts[1:], n)
    sizes = ends - starts
    right = table.column("right").to_numpy(zero_copy_only=False)
    first_right = np.repeat(ends - np.add.reduceat(right.astype(np.int64), starts), sizes)
    one = np.repeat(table.column("a").to_numpy()[starts] == table.column("b").to_numpy()[starts], sizes)
    at = np.arange(n)
    low = np.where(one, at + 1, first_right)
    count = np.where(right, 0, np.repeat(ends, sizes) - low)
    before = np.concatenate([[0], np.cumsum(count)])
    start = 0
    while start < n:
        end = max(start + 1, int(np.searchsorted(before, before[start] + most, "right")) - 1)
        if total := before[end] - before[start]:
            i = np.repeat(at[start:end], count[start:end])
            j = np.arange(total) - np.repeat(before[start:end] - before[start] - low[start:end], count[start:end])
            yield i, j
        start = end
