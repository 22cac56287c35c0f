"""Prefix trie of conversations in balanced parentheses.

1. Turns are numbered by one range sort, and every conversation is rebuilt from its family's first turns and its own.
2. A node is a sequence of turns; its name is its depth and the XOR of hashes of (depth, turn), two of 64 bits. Nodes come out of one
   aggregation of the rebuilt turns.
3. Nodes with the same members follow each other in a chain, known by its least member and their number; the trie of chains has
   at most two per distinct conversation. A chain's path, the least members and depths of the chains above it, orders chains as a walk through
   the trie does.
4. A shard is a run of chains in that order: an open parenthesis where a chain is entered, a closing one where it is left, before it the spine,
   the open chains the shard starts in. Blocks with the least excess of each find where a parenthesis closes, the rank of leaf pairs counts
   leaves, cumulative arrays sum savings. A chain that goes over several shards is on the spine of the later ones: its parts
   are summed up by chain.

No conversation, node or chain is held in one task: numbers and sums along a long one are carried from segment to segment.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from docflow.llm.common import kept

FAMILY = 5
SHARED = 9
# Turns of a segment of a conversation or chain.
SEGMENT = 4096
SHARD = 65_536
BLOCK = 256
# Ids of a range of so many values are joined in one string.
IDS = 65_536


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), h1, h2 (hashes of role and text), bytes of the text, in order of turn, null first; ties by role and text."""
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        # Rows that are the same in all else can be dealt to several partitions.
        F.monotonically_increasing_id().alias("_row"),
    )
    order = ["conv_id", "turn", "role", "text", "_row"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.select(
        "conv_id",
        F.xxhash64("role", "text").alias("h1"),
        F.xxhash64(F.lit("second"), "role", "text").alias("h2"),
        F.octet_length("text").cast("long").alias("bytes"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = kept(rows, "sorted-turns").withColumn("part", F.shiftright("row", 33))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("conv_id", "part").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    parts = parts.select("conv_id", "part", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first") + 1).alias("shift"))
    rows = rows.join(parts, ["conv_id", "part"])
    return rows.select("conv_id", (F.col("row") + F.col("shift")).alias("pos"), "h1", "h2", "bytes")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations' turns (conv_id, depth, h1, h2, bytes, length) and the conversations (conv_id, length)."""
    base = (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base")
    of = kept(
        turns.groupBy("conv_id").agg(F.max("pos").alias("n")).select("conv_id", base, (F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED).alias("h"), "n"),
        "conversations",
    )
    bases = of.select(F.col("conv_id").alias("base"), F.col("n").alias("of_base"))
    taken = F.least("h", F.coalesce("of_base", F.lit(0))).cast("long")
    of = of.join(bases, "base", "left").withColumn("taken", taken)
    of = of.withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    own = turns.join(of, "conv_id").filter((F.col("pos") > F.col("h")) | (F.col("conv_id") == F.col("base")))
    # A base is its own base: it takes its first turns and goes on after them.
    depth = F.when(F.col("conv_id") == F.col("base"), F.col("pos")).otherwise(F.col("pos") - F.col("h") + F.col("taken"))
    own = own.select("conv_id", depth.alias("depth"), "h1", "h2", "bytes", "length")
    early = turns.filter((F.col("pos") < SHARED) & (F.col("conv_id") % FAMILY == 0)).withColumnRenamed("conv_id", "base")
    borrowed = of.filter("conv_id <> base").join(early, "base").filter(F.col("pos") <= F.col("taken"))
    borrowed = borrowed.select("conv_id", F.col("pos").alias("depth"), "h1", "h2", "bytes", "length")
    return own.union(borrowed), of.select("conv_id", "length")


def running(rows: DataFrame, keys: list[str], at: str, sums: dict[str, tuple[str, Column, Column]]) -> DataFrame:
    """Add columns that run along `at` (unique for a key, from 0 or 1): name -> (SQL aggregate, its column, how to join it with `_carry`,
    the aggregate of the segments before). A key is cut into segments; none is ordered in one task."""
    rows = rows.withColumn("_segment", F.floor(F.col(at) / SEGMENT))
    within = Window.partitionBy(*keys, "_segment").orderBy(at).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy(*keys).orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    own = {name: F.call_function(how, what).over(within) for name, (how, what, _) in sums.items()}
    totals = rows.groupBy(*keys, "_segment").agg(*(F.call_function(how, what).alias(f"_{name}") for name, (how, what, _) in sums.items()))
    carries = [F.call_function(how, F.col(f"_{name}")).over(earlier).alias(f"_{name}") for name, (how, _, _) in sums.items()]
    totals = totals.select(*keys, "_segment", *carries).filter("_segment > 0")
    rows = rows.withColumns(own).join(totals, [*keys, "_segment"], "left")
    joined = {name: F.when(F.col(f"_{name}").isNull(), F.col(name)).otherwise(join(F.col(name), F.col(f"_{name}"))) for name, (_, _, join) in sums.items()}
    return rows.withColumns(joined).drop("_segment", *(f"_{name}" for name in sums))


def prefixes(turns: DataFrame) -> DataFrame:
    """Add the names of the node each turn leads to (x1, x2) and of its parent (p1, p2)."""
    marks = turns.withColumn("s1", F.xxhash64("depth", "h1")).withColumn("s2", F.xxhash64("h2", "depth"))
    xor = lambda a, b: a.bitwiseXOR(b)
    marks = running(marks, ["conv_id"], "depth", {"x1": ("bit_xor", F.col("s1"), xor), "x2": ("bit_xor", F.col("s2"), xor)})
    parent = {"p1": F.col("x1").bitwiseXOR(F.col("s1")), "p2": F.col("x2").bitwiseXOR(F.col("s2"))}
    return marks.withColumns(parent).select("conv_id", "depth", "x1", "x2", "p1", "p2", "bytes", "length")


NODE = ["depth", "x1", "x2"]


def nodes(marks: DataFrame, of: DataFrame) -> DataFrame:
    """depth, x1, x2, conv_id, n_convs, bytes, parent_conv_id, n_parent (the parent's n_convs), n_children, ends_sha256."""
    zero = F.lit(0).cast("long")
    root = of.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    root = root.select(zero.alias("depth"), zero.alias("x1"), zero.alias("x2"), zero.alias("p1"), zero.alias("p2"), "conv_id", "n_convs", zero.alias("bytes"))
    found = marks.groupBy(*NODE).agg(
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("bytes").alias("bytes")
    )
    found = kept(found.union(root), "nodes")
    up = (F.col("depth") - 1).alias("depth")
    children = found.filter("depth > 0").groupBy(up, F.col("p1").alias("x1"), F.col("p2").alias("x2")).agg(F.count("*").alias("n_children"))
    parents = found.select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("conv_id").alias("parent_conv_id"), F.col("n_convs").alias("n_parent"))
    ends = marks.filter("depth = length").select(*NODE, "conv_id")
    ends = ends.union(of.filter("length = 0").select(zero, zero, zero, "conv_id"))
    rows = found.join(parents, ["depth", "p1", "p2"], "left").join(children, NODE, "left").join(end_hashes(ends), NODE, "left")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return rows.select(
        *NODE, "conv_id", "n_convs", "bytes", "parent_conv_id", "n_parent",
        F.coalesce("n_children", zero).alias("n_children"), F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
    )


def end_hashes(ends: DataFrame) -> DataFrame:
    """Per node, the SHA-256 of the ids (conv_id) in numerical order, joined by commas.

    Ids are joined within ranges of values first. Nodes with several ranges are hashed as a stream of those strings; a hash of one sequence
    has no parts that tasks could share.
    """
    ranged = ends.groupBy(*NODE, F.floor(F.col("conv_id") / IDS).alias("range"))
    ranged = kept(ranged.agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")), "ends")
    per = ranged.groupBy(*NODE).agg(F.count("*").alias("ranges"), F.min("ids").alias("ids"))
    single = per.filter("ranges = 1").select(*NODE, F.sha2("ids", 256).alias("ends_sha256"))
    several = ranged.join(per.filter("ranges > 1").select(*NODE), NODE)
    several = several.repartition(*NODE).sortWithinPartitions(*NODE, "range").select(*NODE, "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        for batch in batches:
            done = []
            for node, ids in zip(zip(*(batch.column(c).to_pylist() for c in NODE)), batch.column("ids").to_pylist()):
                if node != last:
                    if last is not None:
                        done.append((*last, state.hexdigest()))
                    last, state = node, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield rows_of(done)
        if last is not None:
            yield rows_of([(*last, state.hexdigest())])

    def rows_of(done):
        arrays = [pa.array(c, t) for c, t in zip(zip(*done), [pa.int64()] * 3 + [pa.string()])]
        return pa.RecordBatch.from_arrays(arrays, names=[*NODE, "ends_sha256"])

    return single.union(several.mapInArrow(run, "depth long, x1 long, x2 long, ends_sha256 string"))


def chains(found: DataFrame, marks: DataFrame) -> DataFrame:
    """conv_id, n_convs, top (least depth), bytes (of all its nodes), childless and path of each chain of nodes."""
    rows = found.groupBy("conv_id", "n_convs").agg(
        F.min("depth").alias("top"), F.sum("bytes").alias("bytes"), (F.max_by("n_children", "depth") == 0).alias("childless")
    )
    heads = found.filter("depth > 0 AND n_convs > 1 AND n_convs <> n_parent").select(*NODE, F.col("conv_id").alias("head"))
    # Only a shared chain can have others below it. A path has no more chains than its conversation has turns.
    least = found.select("conv_id").distinct()
    above = marks.select("conv_id", *NODE).join(least, "conv_id", "left_semi").join(heads, NODE)
    above = above.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("depth", "head"))).alias("above"))
    root = found.filter("depth = 0").select("conv_id").first()  # none without conversations
    root = F.struct(F.lit(root and root[0]).cast("long").alias("id"), F.lit(0).cast("long").alias("top"))
    path = F.filter(F.coalesce("above", F.array().cast("array<struct<depth:bigint,head:bigint>>")), lambda s: s.depth < F.col("top"))
    own = F.struct(F.col("conv_id").alias("id"), F.col("top"))
    path = F.concat(F.array(root), F.transform(path, lambda s: F.struct(s.head.alias("id"), s.depth.alias("top"))), F.array(own))
    rows = rows.join(above, "conv_id", "left")
    return rows.select("conv_id", "n_convs", "top", "bytes", "childless", F.when(F.col("top") == 0, F.array(root)).otherwise(path).alias("path"))


class Parentheses:
    """A balanced sequence with the least and greatest excess of each block."""

    def __init__(self, opens: np.ndarray):
        self.opens = opens
        self.excess = np.cumsum(np.where(opens, 1, -1))
        starts = np.arange(0, len(opens), BLOCK)
        self.least = np.minimum.reduceat(self.excess, starts)
        self.most = np.maximum.reduceat(self.excess, starts)

    def find_close(self, at: np.ndarray) -> np.ndarray:
        """Where the parentheses opened at these places close: the next place whose excess is one less than before the opening one."""
        target = self.excess[at] - 1
        found = np.full(len(at), -1)
        self._scan(np.arange(len(at)), at + 1, target, found)
        left = np.flatnonzero(found < 0)
        block = at[left] // BLOCK + 1
        while True:  # on to the next block whose excess reaches the target
            behind = np.flatnonzero((self.least[block] > target[left]) | (self.most[block] < target[left]))
            if not len(behind):
                break
            block[behind] += 1
        self._scan(left, block * BLOCK, target, found)
        return found

    def _scan(self, which: np.ndarray, start: np.ndarray, target: np.ndarray, found: np.ndarray) -> None:
        """Set found[which] to the first place of the block of `start`, from there, with the target's excess."""
        end = np.minimum((start // BLOCK + 1) * BLOCK, len(self.excess))
        end = np.where(start % BLOCK == 0, np.minimum(start + BLOCK, len(self.excess)), end)
        for step in range(BLOCK):
            inside = start + step < end
            which, start, end = which[inside], start[inside], end[inside]
            if not len(which):
                return
            hit = self.excess[start + step] == target[which]
            found[which[hit]] = start[hit] + step
            which, start, end = which[~hit], start[~hit], end[~hit]


def shard_sums(depths: np.ndarray, saved: np.ndarray, childless: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Leaves and savings in this shard of the subtrees of the spine's chains, root first, and of the shard's chains; and the spine's length.

    depths: of the shard's chains in walking order, 1 for the root. Only what lies in this shard counts.
    """
    spine, n = int(depths[0]) - 1, len(depths)
    closes = np.concatenate([[0], depths[:-1] - depths[1:] + 1])  # before each chain's opening one
    at = spine + np.cumsum(closes) + np.arange(n)
    opens = np.zeros(2 * (spine + n), dtype=bool)
    opens[:spine] = True
    opens[at] = True
    sequence = Parentheses(opens)
    places = np.concatenate([np.arange(spine), at])
    close = sequence.find_close(places)
    pair = np.zeros(len(opens), dtype=np.int64)
    pair[:-1] = opens[:-1] & ~opens[1:]
    if not childless[-1]:  # its children are in the next shard
        pair[at[-1]] = 0
    leaves = np.concatenate([[0], np.cumsum(pair)])
    weights = np.zeros(len(opens), dtype=np.int64)
    weights[at] = saved
    sums = np.concatenate([[0], np.cumsum(weights)])
    return leaves[close + 1] - leaves[places], sums[close + 1] - sums[places], spine


def subtree_sums(found: DataFrame, shard: int = SHARD) -> DataFrame:
    """conv_id, top, n_leaves, saved of the subtrees of the chains with several members, in shards of so many chains."""

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, rows = [], 0
        for batch in batches:
            while rows + batch.num_rows >= shard:
                held.append(batch.slice(0, shard - rows))
                batch = batch.slice(shard - rows)
                yield pa.Table.from_batches(held).combine_chunks()
                held, rows = [], 0
            held.append(batch)
            rows += batch.num_rows
        if rows:
            yield pa.Table.from_batches(held).combine_chunks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in shards(batches):
            lengths = table.column("length").to_numpy().astype(np.int64)
            leaves, saved, spine = shard_sums(lengths, table.column("saved").to_numpy(), table.column("childless").to_numpy(zero_copy_only=False))
            first = table.column("path")[0].as_py()[:spine]
            ids = np.concatenate([np.array([p["id"] for p in first], dtype=np.int64), table.column("conv_id").to_numpy()])
            tops = np.concatenate([np.array([p["top"] for p in first], dtype=np.int64), table.column("top").to_numpy()])
            shared = np.concatenate([np.ones(spine, dtype=bool), table.column("n_convs").to_numpy() > 1])
            arrays = [pa.array(x[shared]) for x in (ids, tops, leaves, saved)]
            yield pa.RecordBatch.from_arrays(arrays, names=["conv_id", "top", "n_leaves", "saved"])

    walk = found.repartitionByRange("path").sortWithinPartitions("path")
    saved = ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved")
    walk = walk.select("conv_id", "top", "n_convs", saved, "childless", F.size("path").alias("length"), "path")
    parts = walk.mapInArrow(run, "conv_id long, top long, n_leaves long, saved long")
    return parts.groupBy("conv_id", "top").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))


def trie(conversations: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of each node of the trie of
    the rebuilt conversations (conversations: conv_id long, turn, role, text; rebuilt as in `rebuilt`).

    conv_id: the smallest member. The root has depth 0 and no parent. Null role or text is empty; equal turns of a conversation are in order of
    role and text, repeated rows are turns of their own. Rows without conv_id belong to no conversation. No conversations have no trie.
    """
    turns = kept(numbered_turns(conversations), "turns")
    rows, of = rebuilt(turns)
    of = kept(of, "lengths")
    marks = kept(prefixes(rows), "prefixes")
    found = kept(nodes(marks, of), "trie-nodes")
    line = chains(found, marks)
    line = kept(line, "chains")
    sums = subtree_sums(line).join(line.filter("n_convs > 1").select("conv_id", "top", "n_convs"), ["conv_id", "top"])
    shared = found.filter("n_convs > 1").select("conv_id", "n_convs", "depth", "bytes")
    shared = running(shared, ["conv_id", "n_convs"], "depth", {"so_far": ("sum", F.col("bytes"), lambda a, b: a + b)})
    shared = shared.join(sums.drop("top"), ["conv_id", "n_convs"])
    above = (F.col("n_convs") - 1) * (F.col("so_far") - F.col("bytes"))
    shared = shared.select("conv_id", "depth", "n_leaves", (F.col("saved") - above).alias("saved_tokens"))
    rows = found.join(shared, ["conv_id", "depth"], "left")
    return rows.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        F.coalesce("n_leaves", F.lit(1).cast("long")).alias("n_leaves"), F.coalesce("saved_tokens", F.lit(0).cast("long")).alias("saved_tokens"),
        "ends_sha256",
    )
