"""Document fingerprints: bottom-k sketches of shingle hashes."""

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from docflow.llm.common import shingle_hashes, text_or_empty

K = 128


class Sketch:
    """The k least of a set's hashes. Sketches of parts merge into the sketch of the whole."""

    def __init__(self, hashes: np.ndarray, k: int = K):
        """hashes: sorted distinct unsigned 64-bit hashes."""
        self.hashes, self.k = hashes[:k], k

    @classmethod
    def of(cls, text: str | bytes | None, k: int = K) -> "Sketch":
        return cls(shingle_hashes(text.encode() if isinstance(text, str) else text), k)

    @classmethod
    def parse(cls, fingerprint: str) -> "Sketch":
        k, _, packed = fingerprint.partition(":")
        return cls(np.frombuffer(base64.b64decode(packed), dtype="<u8"), int(k))

    def __str__(self) -> str:
        return f"{self.k}:{base64.b64encode(self.hashes.astype('<u8').tobytes()).decode()}"

    def merge(self, other: "Sketch") -> "Sketch":
        return Sketch(np.union1d(self.hashes, other.hashes), min(self.k, other.k))

    def count(self) -> float:
        """Distinct shingles: exact below k, else estimated from the k-th least hash."""
        if len(self.hashes) < self.k:
            return float(len(self.hashes))
        return (self.k - 1) / ((float(self.hashes[-1]) + 1) / 2.0**64)

    def resemblance(self, other: "Sketch") -> float:
        """Estimated share of the union's shingles that both sets have; 1 for two empty sets."""
        union = self.merge(other).hashes
        if not len(union):
            return 1.0
        both = np.isin(union, self.hashes, assume_unique=True) & np.isin(union, other.hashes, assume_unique=True)
        return float(both.sum() / len(union))

    def containment(self, other: "Sketch") -> float:
        """Estimated share of this set's shingles that the other set has; 1 for an empty set."""
        if not len(self.hashes):
            return 1.0
        return min(1.0, self.resemblance(other) * self.merge(other).count() / self.count())


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many (or all) of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _part(ids: Column, bounds: list[int]) -> Column:
    """How many of the falling bounds an id is below."""
    rising = np.array(sorted(bounds), dtype=np.int64)

    @F.pandas_udf("int")
    def part(values: pd.Series) -> pd.Series:
        return pd.Series(len(rising) - np.searchsorted(rising, values.to_numpy(dtype=np.int64), side="right"), dtype="int32")

    return part(ids)


def with_following(docs: DataFrame, parts: int) -> DataFrame:
    """id, text, part, peek: ranges of falling id, sorted; each part ends with the first row of the next (peek = 1).

    The last part ends with the first row of all. Only ids decide the ranges; the text of each document is shuffled once, and
    those at the head of a range twice. Null ids come last; rows of one id are ordered by text.
    """
    least = -(2**63)
    rows = docs.select(F.col("doc_id").alias("id"), text_or_empty().alias("text"), F.coalesce("doc_id", F.lit(least)).alias("key"))
    cuts = [i / parts for i in range(1, parts)]
    bounds = rows.agg(F.percentile_approx("key", cuts, 10_000)).first()[0] if cuts else []
    rows = rows.withColumn("part", _part(F.col("key"), sorted(set(bounds or []))))
    heads = sorted((r[0], r[1]) for r in rows.groupBy("part").agg(F.max("key")).collect())
    peeks = [(head, heads[i - 1][0]) for i, (_, head) in enumerate(heads)]  # heads[-1] is the last part
    peeks = docs.sparkSession.createDataFrame(peeks, "key long, to int")
    rows = rows.join(F.broadcast(peeks), "key", "left")  # as many rows as parts
    own = F.struct("part", F.lit(0).alias("peek"))
    rows = rows.withColumn(
        "at", F.explode(F.when(F.col("to").isNull(), F.array(own)).otherwise(F.array(own, F.struct(F.col("to").alias("part"), F.lit(1).alias("peek")))))
    )
    rows = rows.select("id", "text", "key", F.col("at.part").alias("part"), F.col("at.peek").alias("peek"))
    return rows.repartition(parts, "part").sortWithinPartitions("part", "peek", F.desc("key"), "text").drop("key")


def compare_with_following(docs: DataFrame, k: int = K, parts: int | None = None) -> DataFrame:
    """Fingerprints of docs (doc_id long, text), of their edited texts, and how alike each is to both neighbours.

    Gives doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_shingles (estimated distinct shingles), contained
    (estimated share of the text's shingles in the edited text). The next document is that of the next lower doc_id, after the last
    the first. Null text is empty; texts without words have an empty sketch, like another empty one (1.0) and unlike all others (0.0).
    A null doc_id comes after all others, equal ids in the order of their texts. A single document is its own next. No
    documents give no rows.
    """
    parts = parts or max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            found = []
            columns = (batch.column(name).to_pylist() for name in ("id", "text", "part", "peek"))
            for doc_id, text, part, peek in zip(*columns):
                sketch = Sketch.of(text, k) if last is None or last[1] != text else last[2]
                if last is not None and last[3] == part:
                    found.append(_row(last, text, sketch, k))
                # Of several peeked rows of a part only the first counts.
                last = None if peek else (doc_id, text, sketch, part)
            if found:
                yield _batch(found)

    return with_following(docs, parts).mapInArrow(run, _SCHEMA)


_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double,"
    " n_shingles double, contained double"
)
_NAMES = [column.split()[0] for column in _SCHEMA.split(",")]


def _row(last: tuple, following: str, sketch: Sketch, k: int) -> tuple:
    doc_id, text, own, _ = last
    other = edited(text, following)
    changed = Sketch.of(other, k)
    digest = hashlib.sha256(other.encode()).hexdigest()
    near = own.resemblance(changed), own.resemblance(sketch)
    return doc_id, len(text), digest, str(own), str(changed), *near, own.count(), own.containment(changed)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), *[pa.float64()] * 4]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=_NAMES)
