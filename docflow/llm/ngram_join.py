"""Jaccard join of word-shingle sets on parity sketches.

The sketch of a set: each shingle hash flips one bit of one of k segments, so the Hamming distance of two sketches is at most
the symmetric difference of the sets. Two sets of sizes a and b that are alike enough differ in at most
D = floor((a + b) * (1 - t) / (1 + t)) shingles: at least k - D of their k segments are equal (pigeonhole).

* A segment has 2**64 places and is kept as the XOR of the places set in it; equal segments have equal XORs. Pairs are looked at
  with the sketch folded to a few bits per shingle: its Hamming distance, too, is at most the symmetric difference.
* k depends on the size band, an octave of set sizes. A set enters its own band and, if a partner could be there, the next.
* Segments are ranked by one rule for all sets: those with more shingles first, very common ones last. Two alike sets
  share at least l segments among the first D + l of each, so only these are shuffled; l is 1 for small sets and grows with the band.
* Sets that share a segment are compared with the least one there; whoever links is in one component and needs no second look.
  Segments whose sets end up in several components are taken up again: a set that has fewer than l of them is done, and of
  the others' segments the l - 1 with most sets need no look. Every pair of sets in different components that still
  shares a segment is compared, in the end on the shingle sets.
* Where the sets of a segment would make many pairs each (a passage that many texts share, a large family with members far from its
  head), its sets are joined anew on single shingles, the rarest first. How many of a set's shingles take part depends on the size
  of the partner, too: far members of a family meet on what they have beside the family's text only.
* Sets of one family meet on what they differ in from the shingles that most of the family have. Two sets that differ from these by r1
  and r2 shingles and are alike share (r1 + r2 - D) / 2 of those at least; where that is none, both are alike with the set nearest to them.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from docflow.llm.common import (
    LIKENESS,
    SHINGLE_WORDS,
    components,
    kept,
    mixed,
    release,
    set_hash,
    shingle_hashes,
    text_or_empty,
    texts_as_bytes,
)

LEAST_BITS = 1024
LEAST_SEGMENTS = 64
# A bounded sample of texts, taken by hash, finds segments that a large share of all texts have.
SAMPLE_TEXTS = 20_000
COMMON_IN_SAMPLE = 32
SALTS = 64
# Segments that would make more pairs for each of their sets than this are joined on single shingles.
CROWDED = 8
# So many shingles of crowded sets, those in most sets, go last in the order; all others are taken as rare.
COMMON_SHINGLES = 200_000
# Sizes of one class differ by less than 1 part in so many.
SIZE_CLASSES = 24
STAR_ROUNDS = 4
# A table of at most so many narrow rows may be broadcast; a longer one is shuffled.
BROADCAST_ROWS = 400_000

_U = np.uint64


class Bands:
    """The numbers of the size bands for a likeness threshold given in percent."""

    def __init__(self, percent: int):
        self.percent = percent

    def most(self, a: int, b: int) -> int:
        """Largest symmetric difference of alike sets of sizes a and b."""
        return (a + b) * (100 - self.percent) // (100 + self.percent)

    def of(self, size: int) -> list[tuple[int, int, int]]:
        """(band, segments, segments to share) for each band a set of this size enters."""
        own = size.bit_length() - 1
        partner = size * 100 // self.percent
        return [
            (band, self.segments(band), self.most(size, min(partner, (2 << band) - 1)) + least_shared(band))
            for band in (own, own + 1)
            if partner >= 1 << band
        ]

    def segments(self, band: int) -> int:
        largest = (2 << band) - 1
        return max(LEAST_SEGMENTS, -(-5 * (self.most(largest, largest) + least_shared(band)) // 4))


def least_shared(band: int) -> int:
    """How many of the segments they send two alike sets of a band share at least."""
    return max(1, (1 << band) // 12)


def sketch_segments(tokens: np.ndarray, bands: Bands, common: np.ndarray | None = None) -> np.ndarray:
    """The first segments of a set by rank: signed 64-bit values that hold the band in bits 1 to 5; odd ones name a common segment.

    tokens: sorted distinct hashes. common: sorted values of segments that go last.
    """
    places = mixed(tokens ^ _U(0xA0761D6478BD642F))
    found = []
    for band, k, share in bands.of(len(tokens)):
        part = ((tokens >> _U(32)) * _U(k)) >> _U(32)  # rising, as the tokens are sorted
        starts = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1])
        counts = np.diff(starts, append=len(part)).astype(np.uint64)
        values = np.bitwise_xor.reduceat(places, starts)
        names = mixed(part[starts] + _U(band << 32)) + counts * _U(0x8EBC6AF09C88C6E3)
        segments = mixed(values ^ names)
        if len(segments) < share:
            # Empty segments are equal, too. They are of use where a small set fills few.
            empty = np.setdiff1d(np.arange(k, dtype=np.uint64), part[starts])[: share - len(segments)]
            segments = np.r_[segments, mixed(mixed(empty + _U(band << 32)))]
            counts = np.r_[counts, np.zeros(len(empty), dtype=np.uint64)]
        segments = (segments & ~_U(63)) | _U(band << 1)
        rank = ((_U(7) - np.minimum(counts, _U(7))) << _U(60)) | (segments >> _U(4))
        late = None
        if common is not None and len(common):
            late = common[np.minimum(np.searchsorted(common, segments), len(common) - 1)] == segments
            rank |= late.astype(np.uint64) << _U(63)
        first = np.argpartition(rank, share - 1)[:share] if share < len(rank) else slice(None)
        segments = segments[first]
        if late is not None and (late := late[first]).any():
            which = np.searchsorted(common, segments[late]).astype(np.uint64)
            salt = mixed(np.add.reduce(tokens, keepdims=True))[0] % _U(SALTS)
            segments[late] = ((which * _U(SALTS) + salt) << _U(6)) | _U(band << 1) | _U(1)
        found.append(segments)
    return np.concatenate(found).view(np.int64)


def folded(tokens: np.ndarray) -> bytes:
    """The parity sketch folded to a power of two of bits, at least LEAST_BITS and twice the number of tokens."""
    bits = max(LEAST_BITS, 2 << (len(tokens) - 1).bit_length())
    parity = np.bincount((tokens & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").tobytes()


def folded_distance(x: bytes, y: bytes) -> int:
    """Hamming distance of two folded sketches; the longer one is folded on to the length of the other."""
    a, b = (np.frombuffer(v, dtype=np.uint64) for v in (x, y))
    if len(a) > len(b):
        a, b = b, a
    if len(a) < len(b):
        b = np.bitwise_xor.reduce(b.reshape(-1, len(a)), axis=0)
    return int(np.bitwise_count(a ^ b).sum())


# --- stages -------------------------------------------------------------------------------------


def sets_of(texts: DataFrame, bands: Bands, width: int, sample_below: int) -> DataFrame:
    """One row per text: id, same, node (hash of its shingle set, null if empty), n, and segments for texts drawn into the sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sizes, folds, sample = [], [], [], []
            for text in texts_as_bytes(batch.column("text")):
                tokens = shingle_hashes(text, width)
                node = set_hash(tokens) if len(tokens) else None
                nodes.append(node)
                sizes.append(len(tokens))
                folds.append(folded(tokens) if len(tokens) else None)
                drawn = node is not None and node % (1 << 32) < sample_below
                sample.append(sketch_segments(tokens, bands) if drawn else None)
            arrays = [
                batch.column("id"),
                batch.column("same"),
                pa.array(nodes, pa.int64()),
                pa.array(sizes, pa.int64()),
                pa.array(folds, pa.binary()),
                pa.array(sample, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "same", "node", "n", "folded", "sample"])

    return texts.mapInArrow(run, "id long, same long, node long, n long, folded binary, sample array<long>")


def segments_of(texts: DataFrame, bands: Bands, width: int, common: np.ndarray) -> DataFrame:
    """segment, node of all texts. A task that meets a set again does not send it again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in batches:
            segments, nodes, held = [], [], 0
            for text in texts_as_bytes(batch.column("text")):
                tokens = shingle_hashes(text, width)
                if not len(tokens) or (node := set_hash(tokens)) in met:
                    continue
                if len(met) < 1_000_000:
                    met.add(node)
                segments.append(sketch_segments(tokens, bands, common))
                nodes.append(np.full(len(segments[-1]), node, dtype=np.int64))
                held += len(nodes[-1])
                if held > 200_000:
                    yield _rows(segments, nodes)
                    segments, nodes, held = [], [], 0
            if held:
                yield _rows(segments, nodes)

    return texts.mapInArrow(run, "segment long, node long")


def _rows(segments: list[np.ndarray], nodes: list[np.ndarray]) -> pa.RecordBatch:
    arrays = [pa.array(np.concatenate(segments)), pa.array(np.concatenate(nodes))]
    return pa.RecordBatch.from_arrays(arrays, names=["segment", "node"])


def shared(segments: DataFrame) -> DataFrame:
    """segment, node, center: the sets of each segment that several sets have, with the least of them.

    Reads sorted partitions as a stream; a group is never held. A common segment comes in salted groups, whose centers
    are then joined under the segment's own least.
    """
    dealt = segments.repartition("segment").sortWithinPartitions("segment", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, center, previous = None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            segment = batch.column("segment").to_numpy()
            node = batch.column("node").to_numpy()
            new = np.r_[last is None or segment[0] != last, segment[1:] != segment[:-1]]
            begins = np.maximum.accumulate(np.where(new, np.arange(len(new)), -1))
            centers = np.where(begins >= 0, node[begins], 0 if center is None else center)
            before = np.r_[node[0] if previous is None else previous, node[:-1]]
            member = (node != centers) & (new | (node != before))
            salted = new & ((segment & 1) == 1)
            at = np.flatnonzero(member | salted)
            last, center, previous = segment[-1], centers[-1], node[-1]
            if len(at):
                real = np.where(salted[at], node[at], centers[at])
                arrays = [pa.array(segment[at]), pa.array(node[at]), pa.array(real)]
                yield pa.RecordBatch.from_arrays(arrays, names=["segment", "node", "center"])

    found = dealt.mapInArrow(run, "segment long, node long, center long")
    return kept(found, "shared-segments")


def joined_salts(found: DataFrame) -> DataFrame:
    """segment, node, center, band: the rows of `shared`, with the salted groups of a common segment joined by their centers."""
    odd = F.col("segment").bitwiseAND(1) == 1
    band = F.shiftright("segment", 1).bitwiseAND(31).cast("int").alias("band")
    # Without the salt; the low bits stay, so that no other segment has the name.
    name = F.when(odd, F.floor(F.shiftright("segment", 6) / SALTS) * 64 + F.col("segment").bitwiseAND(63)).otherwise(F.col("segment"))
    heads = found.filter(odd & (F.col("node") == F.col("center"))).select(name.alias("segment"), "node", band)
    least = heads.groupBy("segment").agg(F.min("node").alias("center"))
    heads = heads.join(least, "segment").filter("node <> center").select("segment", "node", "center", "band")
    return found.filter("node <> center").select(name.alias("segment"), "node", "center", band).union(heads)


def small(rows: DataFrame) -> DataFrame:
    """Marked for broadcast if it is counted to be short; else as it is, to be shuffled like the other side of the join."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


class Verifier:
    """Compares pairs of sets in full: first by size and by the Hamming distance of folded sketches, then by the sets."""

    def __init__(self, sketches: DataFrame, sets: DataFrame, percent: int):
        self.sketches, self.sets, self.percent = sketches, sets, percent

    def links(self, pairs: DataFrame) -> DataFrame:
        """The rows a, b of `pairs` whose sets are alike enough, as a table."""
        sketch = self.sketches
        for side in ("a", "b"):
            own = [F.col("node").alias(side), F.col("n").alias(f"n{side}"), F.col("folded").alias(f"f{side}")]
            pairs = pairs.join(sketch.select(*own), side)
        smaller, larger = F.least("na", "nb"), F.greatest("na", "nb")
        pairs = pairs.filter(100 * smaller >= self.percent * larger)
        near = pairs.mapInArrow(_near_by_sketch(Bands(self.percent)), "a long, b long, na long, nb long")
        pairs = near = kept(near, "near-pairs")
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        sets = self.sets.join(small(nodes), "node")
        for side in ("a", "b"):
            pairs = pairs.join(sets.select(F.col("node").alias(side), F.col("tokens").alias(f"t{side}")), side)
        common = F.size(F.array_intersect("ta", "tb")).cast("long")
        alike = 100 * common >= self.percent * (F.col("na") + F.col("nb") - common)
        links = kept(pairs.filter(alike).select("a", "b"), "links")
        release(near)
        return links


def _near_by_sketch(bands: Bands):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = ("na", "nb", "fa", "fb")
            near = [folded_distance(x, y) <= bands.most(a, b) for a, b, x, y in zip(*(batch.column(n).to_pylist() for n in names))]
            yield batch.select(["a", "b", "na", "nb"]).filter(pa.array(near, pa.bool_()))

    return run


def labelled(rows: DataFrame, label: DataFrame, node: str = "node", name: str = "label") -> DataFrame:
    """Add the component of a node; a node without a link is its own."""
    label = label.select(F.col("node").alias("_n"), F.col("component").alias("_c"))
    return rows.join(label, F.col(node) == F.col("_n"), "left").withColumn(name, F.coalesce("_c", node)).drop("_n", "_c")


def need(band: str = "band") -> Column:
    """least_shared of a band column."""
    return F.expr(f"greatest(1L, shiftleft(1L, {band}) div 12L)")


def open_members(members: DataFrame) -> DataFrame:
    """A table: rows of `members` (key, node, label, band, weight) of keys with several labels, where an alike set may still be met.

    Two alike sets of different labels share open keys of a weight of `need` at least. So a set with less of them goes, and of
    each set's keys those with most sets may go, up to a weight of one less. Adds crowded (whether a key makes more than CROWDED pairs a
    set), first_label and first_head.
    """
    rows, written = members, []
    for _ in range(2):
        heads = rows.groupBy("key", "label").agg(F.min("node").alias("head"), F.count("*").alias("n"))
        keys = heads.groupBy("key").agg(F.count("*").alias("labels"), F.sum("n").alias("sets")).filter("labels > 1").drop("labels")
        rows = kept(rows.join(keys, "key"), "open")
        release(*written)
        written = [rows]
        enough = rows.groupBy("node", "band").agg(F.sum("weight").alias("all")).filter(F.col("all") >= need())
        rows = rows.join(enough, ["node", "band"])
        before = Window.partitionBy("node", "band").orderBy("sets", "key").rowsBetween(Window.unboundedPreceding, -1)
        rows = rows.withColumn("before", F.coalesce(F.sum("weight").over(before), F.lit(0)))
        trimmed = rows.filter(F.col("before") <= F.col("all") - need()).drop("before", "sets", "all")
        rows = rows.drop("before", "sets", "all")
    heads = trimmed.groupBy("key", "label").agg(F.min("node").alias("head"), F.count("*").cast("double").alias("n"))
    keys = heads.groupBy("key").agg(
        F.count("*").alias("labels"),
        ((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))) / 2 > CROWDED * F.sum("n")).alias("crowded"),
        F.min(F.struct("label", "head")).alias("first"),
    )
    keys = keys.filter("labels > 1").select("key", "crowded", "first.*").withColumnsRenamed({"label": "first_label", "head": "first_head"})
    found = kept(trimmed.join(keys, "key"), "open")
    release(*written)
    return found


def one_of_equal_keys(found: DataFrame) -> DataFrame:
    """A table of key, node, band, weight: the members of each segment, once for all `weight` segments that the very same sets share.

    The sets of a segment are all its nodes and centers: a common segment has several centers, and only as a whole it is another's equal.
    """
    rows = found.select(F.col("segment").alias("key"), "node", "band")
    # A set that came from several tasks is in a segment several times, and a center once for each of its nodes.
    rows = kept(rows.union(found.select("segment", "center", "band")).distinct(), "segment-sets")
    own = F.xxhash64("node")
    who = rows.groupBy("key", "band").agg(F.count("*").alias("n"), F.bit_xor(own).alias("x"), F.bit_xor(F.xxhash64(own)).alias("y"))
    one = who.groupBy("band", "n", "x", "y").agg(F.min("key").alias("key"), F.count("*").alias("weight"))
    members = kept(rows.join(one.select("key", "weight"), "key").select("key", "node", "band", "weight"), "members")
    release(rows)
    return members


def cross_pairs(rows: DataFrame) -> DataFrame:
    """a < b: all pairs of nodes that share a key and have different labels. Nodes of one label are never paired."""
    labels = rows.select("key", "label").distinct()
    two = labels.alias("x").join(labels.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.label") < F.col("y.label")))
    two = two.select("x.key", F.col("x.label").alias("l1"), F.col("y.label").alias("l2"))
    left = rows.select("key", F.col("label").alias("l1"), F.col("node").alias("n1"))
    right = rows.select("key", F.col("label").alias("l2"), F.col("node").alias("n2"))
    pairs = two.join(left, ["key", "l1"]).join(right, ["key", "l2"])
    return pairs.select(F.least("n1", "n2").alias("a"), F.greatest("n1", "n2").alias("b")).distinct()


def size_class(n: int) -> int:
    """A number that rises with the size."""
    octave = n.bit_length() - 1
    return octave * SIZE_CLASSES + ((n - (1 << octave)) * SIZE_CLASSES >> octave)


def least_size(size: Column) -> Column:
    """The least size that may be in a size class."""
    power = F.pow(F.lit(2.0), F.floor(size / SIZE_CLASSES))
    return (power + F.ceil(power * (size % SIZE_CLASSES) / SIZE_CLASSES)).cast("long")


def _slices(lists: pa.Array) -> Iterator[tuple[int, int]]:
    """First row and number of rows of parts of a list column: not more than some million shingles are sorted at once, however long the sets."""
    rows = 0
    while rows < len(lists):
        part, held = rows, 0
        while rows < len(lists) and (not held or held + len(lists[rows]) <= 2_000_000):
            held += len(lists[rows])
            rows += 1
        yield part, rows - part


def shingle_counts(sets: DataFrame) -> DataFrame:
    """key, sets: in how many rows of `sets` a shingle is; counted within tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("tokens")
            for part, n in _slices(lists):
                keys, counts = np.unique(lists.slice(part, n).flatten().to_numpy(zero_copy_only=False), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["key", "sets"])

    return sets.select("tokens").mapInArrow(run, "key long, sets long").groupBy("key").agg(F.sum("sets").alias("sets"))


def frequent(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The keys of `counts` (key, sets) that most sets have, sorted, and in how many they are."""
    often = counts.filter(F.col("sets") > CROWDED).orderBy(F.desc("sets"), "key").limit(COMMON_SHINGLES).toArrow()
    keys, sets = (often.column(c).to_numpy() for c in ("key", "sets"))
    order = np.argsort(keys)
    return keys[order], sets[order]


def _rarest_first(keys: np.ndarray, common: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The keys by counts, by their value among equal ones; one that is not in `common` (sorted) counts as none."""
    often = np.zeros(len(keys), dtype=np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, keys), len(common) - 1)
        often = np.where(common[at] == keys, counts[at], 0)
    return keys[np.lexsort((keys, often))]


def rare_shingles(sets: DataFrame, percent: int, common: np.ndarray, counts: np.ndarray) -> DataFrame:
    """key, place, node, label, family, n, size (class), low (least class of a partner): the first shingles of each set, rarest first.

    Alike sets share one of the first n - ceil(t n) + 1 shingles of each in any common order. Here it is that of `_rarest_first`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            who = (batch.column(c).to_numpy() for c in ("node", "label", "family"))
            for node, label, family, tokens in zip(*who, batch.column("tokens")):
                tokens = tokens.values.to_numpy()
                n = len(tokens)
                first = _rarest_first(tokens, common, counts)[: n - -(-n * percent // 100) + 1]
                alone = [node, label, family, n, size_class(n), size_class(max(1, -(-n * percent // 100)))]
                same = [pa.array(np.full(len(first), value, dtype=np.int64)) for value in alone]
                places = pa.array(np.arange(1, len(first) + 1))
                names = ["key", "place", "node", "label", "family", "n", "size", "low"]
                yield pa.RecordBatch.from_arrays([pa.array(first), places, *same], names=names)

    return sets.mapInArrow(run, "key long, place long, node long, label long, family long, n long, size long, low long")


def rare_shingle_pairs(crowd: DataFrame, percent: int) -> DataFrame:
    """a < b: pairs of the nodes of `crowd` (node, label, family, tokens) of different labels and families that share one of their rarest shingles.

    Sets of sizes m and n that are alike share o = ceil(t (m + n) / (1 + t)) shingles at least, so one of the first n - o + 1 of each. A
    row goes to each class of sizes that its shingle is found with, as long as its place is one of those for the least size there.
    """
    rows = first = kept(rare_shingles(crowd, percent, *frequent(shingle_counts(crowd))), "rare-shingles")

    # Shingles with one label or one family end here.
    partners = rows.groupBy("key").agg(
        *(f(c).alias(f"{name}_{c}") for c in ("label", "family") for f, name in ((F.min, "least"), (F.max, "most"))),
        F.collect_set("size").alias("others"),
    )
    partners = partners.filter("least_label < most_label AND least_family < most_family").select("key", "others")
    rows = rows.join(partners, "key").withColumn("other", F.explode("others")).drop("others")
    least = F.greatest(least_size(F.col("other")), F.ceil(F.col("n") * percent / 100))
    shared = F.ceil((F.col("n") + least) * percent / (100 + percent))
    rows = kept(rows.filter((F.col("other") >= F.col("low")) & (F.col("place") <= F.col("n") - shared + 1)), "rare-shingles")
    release(first)

    labels = rows.select("key", "size", "other", "label", "family").distinct()
    same = [F.col("x.key") == F.col("y.key"), F.col("x.size") == F.col("y.other"), F.col("x.other") == F.col("y.size")]
    unlike = [F.col("x.label") < F.col("y.label"), F.col("x.family") != F.col("y.family")]
    two = labels.alias("x").join(labels.alias("y"), [*same, *unlike])
    own = [F.col(f"{side}.{c}").alias(f"{c}{i}") for i, side in ((1, "x"), (2, "y")) for c in ("label", "family")]
    two = two.select("x.key", "x.size", "x.other", *own)
    left = rows.select("key", "size", "other", *(F.col(c).alias(f"{c}1") for c in ("label", "family", "node")))
    swapped = [F.col("size").alias("other"), F.col("other").alias("size")]
    right = rows.select("key", *swapped, *(F.col(c).alias(f"{c}2") for c in ("label", "family", "node")))
    pairs = two.join(left, ["key", "size", "other", "label1", "family1"]).join(right, ["key", "size", "other", "label2", "family2"])
    return pairs.select(F.least("node1", "node2").alias("a"), F.greatest("node1", "node2").alias("b")).distinct()


def _of_family(family: int, tokens: np.ndarray) -> np.ndarray:
    """Names of shingles that differ between families."""
    return (tokens.view(np.uint64) ^ mixed(np.array([family]).view(np.uint64))).view(np.int64)


def family_counts(members: DataFrame) -> DataFrame:
    """family, key, sets: in how many sets of its family a shingle is; counted within tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            families, lists = batch.column("family").to_numpy(), batch.column("tokens")
            for part, n in _slices(lists):
                held: dict[int, list[np.ndarray]] = {}
                for family, tokens in zip(families[part : part + n].tolist(), lists.slice(part, n)):
                    held.setdefault(family, []).append(tokens.values.to_numpy())
                for family, some in held.items():
                    keys, counts = np.unique(_of_family(family, np.concatenate(some)), return_counts=True)
                    columns = [pa.array(np.full(len(keys), family)), pa.array(keys), pa.array(counts)]
                    yield pa.RecordBatch.from_arrays(columns, names=["family", "key", "sets"])

    found = members.select("family", "tokens").mapInArrow(run, "family long, key long, sets long")
    return found.groupBy("family", "key").agg(F.sum("sets").alias("sets"))


def differences(members: DataFrame, percent: int, common: np.ndarray, counts: np.ndarray) -> DataFrame:
    """key, node, label, family, over, most: what each set of `members` differs in from its family's base, rarest first, and a row without a key.

    Let r be the number of differences of a set of n shingles, and over = (100 + percent) r - (100 - percent) n. Two sets are alike if
    they share s = (over1 + over2) / (2 (100 + percent)) differences or more, so one of the first r - s + 1 of each, if s is above 0.
    A row is of these where the other set's `over` is not above `most`.
    """
    whole = 100 + percent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            who = (batch.column(c).to_numpy() for c in ("node", "label", "family"))
            for node, label, family, tokens, base in zip(*who, batch.column("tokens"), batch.column("base")):
                tokens = tokens.values.to_numpy()
                base = base.values.to_numpy() if base.is_valid else np.empty(0, dtype=np.int64)
                keys = _rarest_first(np.setxor1d(_of_family(family, tokens), base, assume_unique=True), common, counts)
                over = whole * len(keys) - (100 - percent) * len(tokens)
                most = 2 * whole * (len(keys) - np.arange(len(keys))) - over
                same = [pa.array(np.full(len(keys) + 1, value, dtype=np.int64)) for value in (node, label, family, over)]
                columns = [pa.array([None, *keys.tolist()], pa.int64()), *same, pa.array([None, *most.tolist()], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "node", "label", "family", "over", "most"])

    return members.mapInArrow(run, "key long, node long, label long, family long, over long, most long")


def family_pairs(crowd: DataFrame, percent: int) -> DataFrame:
    """a < b: pairs of the nodes of `crowd` (node, label, family, tokens) of different labels and one family that hold all its components together.

    Sets of which two are alike by their distances from the base alone are alike with the set nearest to it, too; they are paired with
    that one only. All others meet on a shared difference.
    """
    sizes = crowd.groupBy("family").agg(F.count("*").alias("size"), F.countDistinct("label").alias("labels"))
    members = crowd.join(sizes.filter("labels > 1").drop("labels"), "family")
    counts = family_counts(members).join(sizes.select("family", "size"), "family")
    counts = kept(counts.filter(f"2 * sets > size OR sets > {CROWDED}"), "family-counts")
    base = counts.filter("2 * sets > size").groupBy("family").agg(F.collect_list("key").alias("base"))
    common = frequent(counts.select("key", F.least("sets", F.col("size") - F.col("sets")).alias("sets")))
    found = kept(differences(members.drop("size").join(base, "family", "left"), percent, *common), "differences")
    release(counts)

    alone = found.filter("key IS NULL")
    nearest = alone.groupBy("family").agg(F.min(F.struct("over", "node", "label")).alias("m"))
    star = alone.join(nearest, "family").filter("label <> m.label AND over + m.over <= 0").select("node", F.col("m.node").alias("to"))

    # Sets paired with the nearest one have its label from here on. Differences that no other label has, or none within reach, end here.
    rows = found.filter("key IS NOT NULL").join(nearest, "family")
    rows = rows.withColumn("label", F.expr("IF(over + m.over <= 0, m.label, label)")).drop("m")
    lows = rows.groupBy("key", "label").agg(F.min("over").alias("low"))
    lined = Window.partitionBy("key").orderBy("low", "label")
    lows = lows.withColumn("second", F.lead("low").over(lined)).withColumn("rank", F.row_number().over(lined))
    lows = lows.filter("rank = 1 AND second IS NOT NULL").select("key", F.col("label").alias("first"), "low", "second")
    rows = rows.join(lows, "key").filter("most >= IF(label = first, second, low)").select("key", "node", "label", "over", "most")
    rows = kept(rows, "differences")
    near = ["x.key = y.key", "x.label < y.label", "x.over + y.over > 0", "x.over <= y.most", "y.over <= x.most"]
    met = rows.alias("x").join(rows.alias("y"), F.expr(" AND ".join(near))).select(F.col("x.node"), F.col("y.node").alias("to"))
    return star.union(met).select(F.least("node", "to").alias("a"), F.greatest("node", "to").alias("b")).distinct()


def families(rows: DataFrame) -> DataFrame:
    """node, label, family: the sets of crowded rows of `open_members`, each in the family of the head it shares most segments with."""
    heads = rows.filter("crowded").groupBy("node", "label", "first_head").agg(F.sum("weight").alias("weight"))
    return heads.groupBy("node", "label").agg(F.max_by("first_head", F.struct("weight", "first_head")).alias("family"))


def open_pairs(rows: DataFrame, sets: DataFrame, percent: int, all_links: bool = False) -> DataFrame:
    """a < b: the pairs of nodes with different labels to compare for the rows of `open_members`.

    They hold every component together; with `all_links` there is every pair that may be alike.
    """
    crowd = rows.filter("crowded").select("node", "label", F.col("label").alias("family")).distinct() if all_links else families(rows)
    pairs = cross_pairs(rows.filter("NOT crowded").select("key", "node", "label"))
    if not crowd.isEmpty():
        crowd = kept(crowd.join(sets, "node").select("node", "label", "family", "tokens"), "crowd")
        pairs = pairs.union(rare_shingle_pairs(crowd, percent))
        if not all_links:
            pairs = pairs.union(family_pairs(crowd, percent))
        pairs = pairs.distinct()
        release(crowd)
    return pairs


# --- the operator -------------------------------------------------------------------------------


def similarity_classes(docs: DataFrame, percent: int = round(100 * LIKENESS), width: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of docs (doc_id long, text).

    component_id is the smallest doc_id reachable by links, the row's own included. In a component of null ids only it is null.
    For links and empty texts see `text_classes`.
    """
    return _least_ids(text_classes(docs, percent, width)).select("doc_id", "n_shingles", "component_id")


def _least_ids(rows: DataFrame) -> DataFrame:
    """Add component_id, the smallest doc_id of the class; without a class the row's own."""
    least = rows.filter("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("least"))
    rows = rows.join(least.withColumnRenamed("class", "_class"), F.col("class") == F.col("_class"), "left")
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return rows.withColumn("component_id", component)


def similarity_links(docs: DataFrame, percent: int = round(100 * LIKENESS), width: int = SHINGLE_WORDS) -> DataFrame:
    """As `similarity_classes`, with n_links: how many other rows each row links with, rows of the same set included."""
    members, links = set_links(docs, percent, width)
    sizes = members.filter("node IS NOT NULL").groupBy("node").agg(F.count("*").alias("size"))
    both = links.select(F.col("a").alias("_to"), F.col("b").alias("node")).union(links.select("b", "a"))
    linked = both.join(sizes, "node").groupBy("_to").agg(F.sum("size").alias("others"))
    own = sizes.join(linked, F.col("node") == F.col("_to"), "left")
    own = own.select(F.col("node").alias("_own"), (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    rows = _least_ids(labelled(members, components(links), name="class"))
    rows = rows.join(own, F.col("node") == F.col("_own"), "left")
    return rows.select("doc_id", "n_shingles", "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def set_links(docs: DataFrame, percent: int = round(100 * LIKENESS), width: int = SHINGLE_WORDS) -> tuple[DataFrame, DataFrame]:
    """doc_id, n_shingles, node (the set) of each row, and a < b of all links between different sets.

    Rows of one set link with each other without a pair of their own; null nodes link with nothing. All pairs of sets that
    share enough segments are compared, within components, too: the work grows with the links there are.
    """
    of_doc, found, sets, check = _prepared(docs, percent, width)
    members = one_of_equal_keys(found)
    # Each set is a label of its own, so no pair is left out for being of one component.
    rows = open_members(members.withColumn("label", F.col("node")))
    links = check.links(kept(open_pairs(rows, sets, percent, all_links=True), "pairs"))
    return of_doc.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "node"), links


def text_classes(docs: DataFrame, percent: int = round(100 * LIKENESS), width: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, same (hash of the text), n_shingles and class (a number per component) for each row of docs (doc_id long, text).

    Two texts link when 100 * |A and B| >= percent * |A or B| for their sets of distinct `width`-word shingles, A-Z lower-cased;
    a shorter text is one shingle. Null texts and texts without words have an empty set, n_shingles 0 and no class: they link
    with nothing, not even each other. Equal texts link, so repeated rows share a class. A null doc_id is kept. No documents give
    no rows. Sets are named by 64-bit hashes of 64-bit shingle hashes.
    """
    of_doc, found, sets, check = _prepared(docs, percent, width)

    # First each set with the center it shares most segments with.
    edges = found.groupBy("node", "center", "band").count().filter(F.col("count") >= need())
    best = edges.groupBy("node").agg(F.max_by("center", F.struct("count", -F.col("center"))).alias("center"))
    done = kept(best.select(F.least("node", "center").alias("a"), F.greatest("node", "center").alias("b")).distinct(), "pairs")
    links = check.links(done)
    label = components(links)
    members = one_of_equal_keys(found)

    # Then heads of components with the first head, as long as that closes a good part of the segments.
    rows = open_members(labelled(members, label))
    n_rows = rows.count()
    for _ in range(STAR_ROUNDS if n_rows else 0):
        star = rows.groupBy("key", "label", "first_label", "first_head").agg(F.min("node").alias("head"))
        star = star.filter("label <> first_label")
        pairs = star.select(F.least("head", "first_head").alias("a"), F.greatest("head", "first_head").alias("b")).distinct()
        pairs = kept(pairs.join(done, ["a", "b"], "left_anti"), "pairs")
        new = check.links(pairs)
        done, before = done.union(pairs), n_rows
        if not new.isEmpty():
            links = links.union(new)
            label = components(links)
            closed, rows = rows, open_members(labelled(members, label))
            release(closed)
            n_rows = rows.count()
        if n_rows > 0.8 * before:
            break

    # What is still open is compared in full.
    pairs = open_pairs(rows, sets, percent)
    new = check.links(pairs.join(done, ["a", "b"], "left_anti"))
    if not new.isEmpty():
        label = components(links.union(new))

    rows = labelled(of_doc.select("id", "same", "node", "n"), label, name="class")
    return rows.select(F.col("id").alias("doc_id"), "same", F.col("n").alias("n_shingles"), "class")


def _prepared(docs: DataFrame, percent: int, width: int) -> tuple[DataFrame, DataFrame, DataFrame, Verifier]:
    """Rows with their sets, segments with their sets and centers, token sets of those, and what compares them."""
    bands = Bands(percent)
    texts = docs.select(F.col("doc_id").alias("id"), F.xxhash64(text_or_empty()).alias("same"), text_or_empty().alias("text"))
    number = docs.count()
    below = min(1 << 32, (SAMPLE_TEXTS << 32) // max(number, 1))
    of_doc = kept(sets_of(texts, bands, width, below), "sets")

    often = of_doc.filter("sample IS NOT NULL").dropDuplicates(["node"]).select(F.explode("sample").alias("segment")).groupBy("segment").count()
    often = often.filter(F.col("count") >= COMMON_IN_SAMPLE).select("segment")
    common = np.sort(np.array([r[0] for r in often.collect()], dtype=np.int64).view(np.uint64))
    found = joined_salts(shared(segments_of(texts.select("text"), bands, width, common)))

    nodes = of_doc.filter("node IS NOT NULL").groupBy("node").agg(
        F.min("id").alias("doc"), F.first("n").alias("n"), F.first("folded").alias("folded")
    )
    involved = found.select("node").union(found.select("center")).distinct()
    sketches = kept(nodes.join(involved, "node"), "sketches")
    sets = kept(_token_sets(docs, sketches, width), "token-sets")
    check = Verifier(sketches.select("node", "n", "folded"), sets, percent)
    return of_doc, found, sets, check


def _token_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """node, tokens of the wanted nodes, from the text of the document that stands for each."""
    wanted = small(wanted.select("node", F.col("doc").alias("_doc")))
    rows = docs.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("_doc"))).select("node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in batches:
            nodes, sets = [], []
            for node, text in zip(batch.column("node").to_pylist(), texts_as_bytes(batch.column("text"))):
                if node in met:  # a repeated row
                    continue
                tokens = shingle_hashes(text, width)
                # Rows of one doc_id may have other texts.
                if len(tokens) and set_hash(tokens) == node:
                    met.add(node)
                    nodes.append(node)
                    sets.append(tokens.view(np.int64))
            arrays = [pa.array(nodes, pa.int64()), pa.array(sets, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["node", "tokens"])

    return rows.mapInArrow(run, "node long, tokens array<long>")
