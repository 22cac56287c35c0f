"""SimHash near-duplicates: a byte-position inverted index with count filtering.

A fingerprint of 64 bits is eight bytes at eight positions. Fingerprints that differ in at most `bits` bits share at least 8 - bits
of their positional bytes: that many matches are guaranteed. Shared positional bytes are tallied for the pairs that a posting list
brings together, pairs below the guaranteed number go, and the others are verified bit by bit.

One byte a list would bring nearly all pairs together, so a posting holds the bytes of four positions: of four pairs of positions two
differing bytes leave two alone, so the six pairs of pairs meet every link. A crowded list is indexed again by two of its other positions;
six positions are the guaranteed number, and as only two bytes are left, such a list has at most 65,536 members however large the
input is. Lists are cut into tiles.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from docflow.llm.common import components, kept, texts_as_bytes
from docflow.llm.tiling import BLOCK, pairs, tiled, whole_tiles

BITS = 2
WIDTH = 3
SEED = 42
# Longer posting lists are indexed by two more positions.
CROWDED = 1024
_STRETCH = 1 << 20
_SPACE = b" \t\n\r\x0b\x0c"


def _stretches(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in lists of about _STRETCH bytes."""
    at = 0
    while at < len(text):
        end = at + _STRETCH
        while end < len(text) and text[end] not in _SPACE:
            end += 1
        yield text[at:end].split()
        at = end


def shingle_hashes(text: bytes, width: int = WIDTH) -> Iterator[np.ndarray]:
    """XXH64 of the word shingles of a text in UTF-8, repeats included, A-Z lower-cased, joined by a space."""
    digest, tail, met = xxhash.xxh64_intdigest, [], 0
    for found in _stretches(text.lower()):
        words = tail + found
        met += len(found)
        tail = words[-(width - 1) :]
        if len(words) >= width:
            shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
            yield np.fromiter((digest(s, SEED) for s in shingles), dtype=np.uint64, count=len(words) - width + 1)
    if 0 < met < width:
        yield np.array([digest(b" ".join(tail), SEED)], dtype=np.uint64)


def fingerprint(text: bytes | None) -> int:
    """The bits set in over half of a text's shingle hashes; 0 without words."""
    ones, n = np.zeros(64, dtype=np.int64), 0
    for hashes in shingle_hashes(text or b""):
        for part in np.array_split(hashes, -(-len(hashes) // 65_536)):
            bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.uint32)
            n += len(part)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, print (the fingerprint as a signed long) of each row of docs (doc_id long, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(text) for text in texts_as_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.array(found, dtype=np.uint64).view(np.int64))], names=["doc_id", "print"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, print long")


def _mask(positions: tuple[int, ...]) -> int:
    value = sum(0xFF << (8 * p) for p in positions)
    return value - (1 << 64) if value >> 63 else value


# Which positions a posting holds: two of the four pairs of positions.
LISTS = [a + b for a, b in combinations([(0, 1), (2, 3), (4, 5), (6, 7)], 2)]


def postings(prints: DataFrame) -> DataFrame:
    """list, key, print: the posting lists each fingerprint is in."""
    entries = [F.struct(F.lit(i).alias("list"), F.col("print").bitwiseAND(_mask(places)).alias("key")) for i, places in enumerate(LISTS)]
    return prints.select(F.explode(F.array(*entries)).alias("_e"), "print").select("_e.*", "print")


def _crowded_again(rows: DataFrame) -> DataFrame:
    """The postings of crowded lists, by two of the four other positions."""
    further = F.array()
    for i, places in enumerate(LISTS):
        others = [p for p in range(8) if p not in places]
        entries = [
            F.struct(F.lit(len(LISTS) * (1 + i) + k).alias("list"), F.col("print").bitwiseAND(_mask(places + two)).alias("key"))
            for k, two in enumerate(combinations(others, 2))
        ]
        further = F.when(F.col("list") == i, F.array(*entries)).otherwise(further) if i else F.array(*entries)
    return rows.select(F.explode(further).alias("_e"), "print").select("_e.*", "print")


def links_in_tiles(bits: int):
    """For mapInArrow on tiles: a spanning forest of the links of each run of tiles, as a (a fingerprint) and b (the least it is tied to)."""
    guaranteed = 8 - bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_tiles(batches, ["list", "key"]):
            prints = table.column("print").to_numpy()
            ends = []
            for i, j in pairs(table, starts):
                differing = (prints[i] ^ prints[j]).view(np.uint64)
                tally = (differing.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1, dtype=np.uint8)
                some = np.flatnonzero(tally >= guaranteed)
                some = some[np.bitwise_count(differing[some]) <= bits]
                ends.append((i[some], j[some]))
            i, j = (np.concatenate(x) for x in zip(*ends)) if ends else ([], [])
            if len(i):
                a, b = spanning(prints, i, j)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def spanning(prints: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each distinct value that links tie to a lesser one, with the least value its links lead to."""
    values, at = np.unique(prints, return_inverse=True)
    i, j, label = at[i], at[j], np.arange(len(values))
    while True:
        before = label.copy()
        least = np.minimum(label[i], label[j])
        np.minimum.at(label, i, least)
        np.minimum.at(label, j, least)
        label = label[label]
        if (label == before).all():
            break
    tied = np.flatnonzero(label != np.arange(len(values)))
    return values[tied], values[label[tied]]


def link_forest(prints: DataFrame, bits: int = BITS) -> DataFrame:
    """a, b: edges that connect just the fingerprints (print, distinct) which links of at most `bits` differing bits connect."""
    if not 0 <= bits <= BITS:
        raise ValueError("the posting lists meet fingerprints of at most two differing bits")
    rows = kept(postings(prints), "postings")
    crowded = rows.groupBy("list", "key").agg(F.count("*").alias("members")).filter(F.col("members") > CROWDED)
    crowded = kept(crowded.select("list", "key"), "crowded-lists")
    again = _crowded_again(rows.join(crowded, ["list", "key"], "left_semi"))
    rows = rows.join(crowded, ["list", "key"], "left_anti").union(again)
    return tiled(rows, ["list", "key"], "print", BLOCK).mapInArrow(links_in_tiles(bits), "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id for each row of docs (doc_id long, text).

    Documents link if their fingerprints differ in at most two bits; component_id is the smallest doc_id reachable by links, the row's
    own included, and null where all ids are. Null texts and texts without words have the fingerprint zero and link like any other.
    Repeated rows are returned each; no documents give no rows.
    """
    of_doc = kept(fingerprints(docs), "fingerprints")
    prints = kept(of_doc.groupBy("print").agg(F.min("doc_id").alias("least")), "prints")
    tied = components(link_forest(prints.select("print")))
    classes = prints.join(tied, F.col("print") == F.col("node"), "left").withColumn("class", F.coalesce("component", "print"))
    least = classes.groupBy("class").agg(F.min("least").alias("component_id"))
    named = classes.select("print", "class").join(least, "class").select("print", "component_id")
    rows = of_doc.join(named, "print")
    return rows.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")
