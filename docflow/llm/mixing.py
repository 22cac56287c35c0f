"""Mixing sources to target weights by capped water-filling."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from docflow.llm.common import WORD, kept

# Two rounds of so many bits of a row's draw narrow a source's cut down to 2**-20 of its rows.
DRAW_BITS = 10


def word_count(text: str = "text") -> Column:
    """Number of words as a long, 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def ranked(sources: DataFrame, source: str) -> DataFrame:
    """Add `rank`, from 0: the place of each distinct source by code point, null last.

    Sources are sorted by ranges; only the row counts of the ranges meet in one task.
    """
    nulls = F.col(source).isNull()
    placed = kept(sources.repartitionByRange(nulls, source).withColumn("_range", F.spark_partition_id()), "ranks")
    sizes = placed.groupBy("_range").count()
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("_range").orderBy(nulls, source)
    return (
        placed.join(starts, "_range")
        .withColumn("rank", F.col("_start") + F.row_number().over(within) - 1)
        .drop("_range", "_start")
    )


def targets(sources: DataFrame, total: int, max_epochs: int) -> DataFrame:
    """Add `target` to rows with `source_size` and `weight` (a positive whole number).

    Sources whose share by weight is above `max_epochs` times their size are clamped there; the others share what is left by
    weight; again, until no share is above its cap. A round is one aggregate of two numbers.
    """
    cap = F.col("source_size") * max_epochs
    sources = sources.withColumn("clamped", F.lit(False))
    clamped = -1
    while True:
        open_ = ~F.col("clamped")
        taken, weights, closed = sources.agg(
            F.coalesce(F.sum(F.when(F.col("clamped"), cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(open_, F.col("weight"))), F.lit(0)),
            F.count_if("clamped"),
        ).first()
        left, weights = total - taken, max(weights, 1)
        # Whole numbers are compared, so that a share equal to its cap is no rounding matter.
        if closed == clamped:
            share = (F.lit(left).cast("double") * F.col("weight")) / F.lit(weights).cast("double")
            return sources.withColumn("target", F.when(F.col("clamped"), cap.cast("double")).otherwise(share)).drop("clamped")
        over = F.lit(left).cast("decimal(38,0)") * F.col("weight") > cap.cast("decimal(38,0)") * weights
        sources, clamped = sources.withColumn("clamped", F.col("clamped") | over), closed


def mix(docs: DataFrame, weights: DataFrame, max_epochs: int = 3, seed: int = 17, keep: list[str] | None = None) -> DataFrame:
    """How many words of each document a mix by weights takes.

    docs: doc_id, source, size, further columns `keep`; weights: source, weight (positive whole numbers; null is a source of
    its own). All shares together are the size of all documents. Each document is taken whole, floor(target / source_size)
    times; what a target still lacks is filled by one more copy of documents in the order of a seeded draw, as far as
    that comes closer to the target. So a source ends within half a document of its target, and no document is taken more
    than max_epochs times.

    Adds source_size, target, copies, taken (copies * size). Rows are told apart by doc_id, size and the columns kept; equal rows are alike.
    A source without weight row, or without words, takes nothing: its target is 0. No documents give no rows.
    """
    keep = keep or []
    # The draw: 60 bits of a digest that any SQL engine has. A null id draws as the empty text.
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    draw = F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
    docs = kept(docs.select("doc_id", "source", "size", *keep).withColumn("draw", draw), "mix")
    ties = [F.xxhash64(*own)] if (own := [c for c, kind in docs.dtypes if c in keep and "map<" not in kind]) else []
    sizes = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    total = docs.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    same = sizes["source"].eqNullSafe(weights["source"])
    weighted = sizes.join(weights, same, "left").select(
        sizes["source"], "source_size", F.coalesce("weight", F.lit(0)).cast("long").alias("weight")
    )
    share = targets(kept(weighted, "mix-weights"), total, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    share = kept(share.withColumn("whole", whole).withColumn("rest", F.col("target") - whole * F.col("source_size")), "mix-targets")

    # Where the cut falls in each source: first among slices of the draw, then among slices of the slice it falls into.
    first = F.shiftright("draw", 60 - DRAW_BITS)
    second = F.shiftright("draw", 60 - 2 * DRAW_BITS).bitwiseAND(2**DRAW_BITS - 1)
    rest = share.select(F.col("source").alias("_source"), "rest")
    outer = _cut(docs.groupBy("source", first.alias("slice")).agg(F.sum("size").alias("size")), rest, "slice")
    outer = kept(outer.select(F.col("_source"), F.col("slice").alias("_slice"), F.col("rest")), "mix-cut")
    inside = docs.withColumn("_first", first).join(
        outer, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_first") == F.col("_slice"))
    )
    inner = _cut(
        inside.groupBy("source", second.alias("slice")).agg(F.sum("size").alias("size")),
        outer.select("_source", "rest"),
        "slice",
    )
    inner = inner.select("_source", F.col("slice").alias("_second"), F.col("rest").alias("_left"))
    cuts = share.select(F.col("source").alias("_name"), "source_size", "target", "whole").join(
        outer.select("_source", "_slice"), F.col("_name").eqNullSafe(F.col("_source")), "left"
    ).drop("_source")
    cuts = kept(cuts.join(inner, F.col("_name").eqNullSafe(F.col("_source")), "left").drop("_source"), "mix-cuts")

    placed = docs.join(cuts, F.col("source").eqNullSafe(F.col("_name"))).withColumn(
        "_side",
        F.when(F.col("_slice").isNull() | (first > F.col("_slice")), 0)
        .when(first < F.col("_slice"), 1)
        .when(F.col("_second").isNull() | (second > F.col("_second")), 0)
        .when(second < F.col("_second"), 1),
    )
    # Only the 2**-20 of a source's rows that share the last slice are put in order.
    order = Window.partitionBy("source").orderBy("draw", "doc_id", "size", *ties)
    before = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    edge = placed.filter("_side IS NULL").withColumn("_before", before)
    edge = edge.withColumn("_side", (2 * F.col("_before") + F.col("size") < 2 * F.col("_left")).cast("int")).drop("_before")
    copies = (F.col("whole") + F.col("_side")).cast("int")
    return (
        placed.filter("_side IS NOT NULL")
        .unionByName(edge)
        .withColumn("copies", copies)
        .withColumn("taken", (F.col("copies") * F.col("size")).cast("long"))
        .select("doc_id", "source", *keep, "size", "source_size", "target", "copies", "taken")
    )


def _cut(slices: DataFrame, rest: DataFrame, name: str) -> DataFrame:
    """The slice of each source in which the sum of sizes reaches `rest`, and what is left of `rest` at its start."""
    up_to = Window.partitionBy("source").orderBy(name).rowsBetween(Window.unboundedPreceding, 0)
    slices = slices.withColumn("_end", F.sum("size").over(up_to))
    held = slices.join(rest, F.col("source").eqNullSafe(F.col("_source"))).filter("_end >= rest AND _end - size < rest")
    first = Window.partitionBy("source").orderBy(name)
    return held.withColumn("_n", F.row_number().over(first)).filter("_n = 1").withColumn(
        "rest", F.col("rest") - (F.col("_end") - F.col("size"))
    )


def cycled_weights(docs: DataFrame, cycle: int = 3) -> DataFrame:
    """source, weight: the sources by code point, null last, weigh 1, 2, ... `cycle`, repeating."""
    sources = ranked(docs.select("source").distinct(), "source")
    return sources.select("source", (F.col("rank") % cycle + 1).cast("long").alias("weight"))
