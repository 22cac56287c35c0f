"""Nearest neighbours by inner product on randomly rotated one-bit codes.

A vector is a common center plus a residual; the residual's direction is rotated by one random rotation and kept as a sign bit per
dimension, with two correction scalars: the residual's length, and the inner product of the direction with its code. From
these a query's inner product is estimated without bias, with a bound on the error that holds with high probability. The
vectors whose upper bound reaches the k-th best found are looked at in full, in double precision.

Queries meet all vectors in blocks: where vectors have no clusters, the cells of a partition
would nearly all have to be visited.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from docflow.llm.common import kept

# The center is the mean of at most so many vectors, drawn by a hash of their id. Every vector is indexed.
SAMPLE = 20_000
# Width of the error bound in standard deviations of a random rotation: a neighbour is missed with a chance of 0.6 %.
EPSILON = 2.5
BLOCK_VECTORS, BLOCK_QUERIES = 20_000, 50_000
_RESULT = "asked long, query_id long, vec_id long, score double"


def usable(vector: str) -> Column:
    """Not null, not zero, no null and no non-finite component."""
    x = F.col(vector)
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return x.isNotNull() & ~F.coalesce(odd, F.lit(False)) & F.coalesce(F.exists(x, lambda v: v != 0), F.lit(False))


def rotation(dim: int, seed: int = 11) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, center: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, length of the residual, and inner product of its direction with its code."""
    rest = (vectors - center) @ turn.T
    length = np.sqrt((rest * rest).sum(axis=1))
    direction = rest / np.where(length > 0, length, 1)[:, None]
    agree = np.abs(direction).sum(axis=1) / np.sqrt(vectors.shape[1])
    return np.packbits(rest > 0, axis=1), length, np.where(length > 0, agree, 1.0)


class Codes:
    """A block of codes, ready for estimates."""

    def __init__(self, packed: np.ndarray, length: np.ndarray, agree: np.ndarray, center: np.ndarray, turn: np.ndarray):
        dim = len(center)
        self.signs = (np.unpackbits(packed, axis=1, count=dim).astype(np.float32) * 2 - 1).T
        self.signs *= (length / agree / np.sqrt(dim)).astype(np.float32)
        # What a random rotation may be off by, and what single precision may lose.
        spread = EPSILON * np.sqrt(np.maximum(1 - agree**2, 0)) / agree * length / np.sqrt(max(dim - 1, 1))
        self.bound = (spread + 1e-5 * (1 + length)).astype(np.float32)
        self.center, self.turn = center, turn

    def estimate(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimated inner products, queries by vectors, and their upper bounds."""
        near = (queries @ self.turn.T).astype(np.float32) @ self.signs + (queries @ self.center).astype(np.float32)[:, None]
        norm = np.sqrt((queries * queries).sum(axis=1)).astype(np.float32)
        return near, near + norm[:, None] * self.bound


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


def _nearest(x, ids, near, upper, query, name, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k best of a block for one query: the best by estimate first, then all whose bound reaches their k-th."""
    other = ids != name
    cut = -np.inf
    if other.sum() > k:
        first = np.argpartition(np.where(other, near, -np.inf), len(near) - k)[len(near) - k :]
        cut = np.min((x[first] * query).sum(axis=1))
    take = np.flatnonzero((upper >= cut) & other)
    score = (x[take] * query).sum(axis=1)
    order = np.lexsort((ids[take], -score))[:k]
    return ids[take][order], score[order]


def search(vectors: DataFrame, every: int = 20, k: int = 20, id_: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k nearest other rows of each query: query_id, rank (from 1), vec_id, score.

    Queries are the rows whose id is divisible by `every`, candidates all rows but those of the query's own id; nearest is the
    largest inner product of the original vectors in double precision, ties to the smaller id. Vectors that are null, zero or
    hold null or non-finite components take no part, nor do those of another dimension than the most frequent one, nor rows
    without id. Repeated rows are candidates each and queries each: a query id of several rows has the ranks 1 to k for each of
    its rows. Fewer candidates than k give all of them; no vectors give no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_).alias("vec_id"), F.col(vector).alias("vector")).filter(F.col("vec_id").isNotNull() & usable("vector"))
    sizes = rows.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, number = sizes
    rows = rows.filter(F.size("vector") == dim)

    drawn = rows.orderBy(F.xxhash64("vec_id", F.lit(5)), "vec_id").limit(SAMPLE).select("vector").toArrow()
    center, turn = _matrix(drawn.column("vector"), dim).mean(axis=0), rotation(dim)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, length, agree = encode(_matrix(batch.column("vector"), dim), center, turn)
            code = pa.array([c.tobytes() for c in codes], pa.binary())
            columns = [batch.column("vec_id"), code, pa.array(length), pa.array(agree), batch.column("vector")]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "code", "length", "agree", "vector"])

    kind = rows.schema["vector"].dataType.simpleString()
    indexed = kept(rows.mapInArrow(index, f"vec_id long, code binary, length double, agree double, vector {kind}"), "ann-index")
    # Each query has a number of its own, as its id may come again.
    asked = indexed.filter(F.col("vec_id") % every == 0).select("vec_id", "vector")
    asked = kept(asked.withColumn("asked", F.monotonically_increasing_id()), "ann-asked")
    v_blocks, q_blocks = -(-number // BLOCK_VECTORS), max(1, -(-asked.count() // BLOCK_QUERIES))
    # Dealt by place, not by id: repeated ids make no block larger. Each block of vectors meets each block of queries.
    place = F.monotonically_increasing_id()
    left = indexed.withColumn("vb", F.pmod(place, F.lit(v_blocks)).cast("int"))
    left = left.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
    right = asked.withColumn("qb", F.pmod(place, F.lit(q_blocks)).cast("int"))
    right = right.withColumn("vb", F.explode(F.sequence(F.lit(0), F.lit(v_blocks - 1))))

    def meet(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        found = []
        if mine.num_rows and theirs.num_rows:
            x, ids = _matrix(mine.column("vector"), dim), mine.column("vec_id").to_numpy()
            packed = np.frombuffer(b"".join(mine.column("code").to_pylist()), dtype=np.uint8).reshape(len(ids), -1)
            codes = Codes(packed, mine.column("length").to_numpy(), mine.column("agree").to_numpy(), center, turn)
            queries, names = _matrix(theirs.column("vector"), dim), theirs.column("vec_id").to_numpy()
            numbers = theirs.column("asked").to_numpy()
            for at in range(0, len(names), 64):
                near, upper = codes.estimate(queries[at : at + 64])
                for i, query in enumerate(queries[at : at + 64]):
                    found.append((numbers[at + i], names[at + i], *_nearest(x, ids, near[i], upper[i], query, names[at + i], k)))
        columns = [
            np.concatenate([np.full(len(ids), number) for number, _, ids, _ in found] or [np.empty(0)]).astype(np.int64),
            np.concatenate([np.full(len(ids), name) for _, name, ids, _ in found] or [np.empty(0)]).astype(np.int64),
            np.concatenate([ids for _, _, ids, _ in found] or [np.empty(0)]).astype(np.int64),
            np.concatenate([score for _, _, _, score in found] or [np.empty(0)]),
        ]
        return pa.Table.from_arrays([pa.array(c) for c in columns], names=["asked", "query_id", "vec_id", "score"])

    near = left.groupBy("vb", "qb").cogroup(right.groupBy("vb", "qb")).applyInArrow(meet, _RESULT)
    order = Window.partitionBy("asked").orderBy(F.desc("score"), "vec_id")
    near = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return near.select("query_id", "rank", "vec_id", "score")
