"""Rows that changed since the last one kept, and the latest row per key."""

import math

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window, functions as F

from docflow.operators.prefix import RANGE_BITS, earlier
from docflow.session import written

# A key with more rows than this is worked on in segments of its order column.
SEGMENT_ROWS = 1_000_000
# So many keys at most are worked on in segments, those with most rows. Any other has less than one row in so many.
MAX_HOT_KEYS = 100_000
# So many summaries of a key's segments at most are carried on by one window.
SUMMARIES = 1 << RANGE_BITS


def hot_keys(df: DataFrame, key: str, rows: int) -> DataFrame:
    """Keys holding more than `rows` rows; of more than MAX_HOT_KEYS of them those with most rows."""
    counts = df.groupBy(key).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > rows)
    return counts.orderBy(F.desc("_rows")).limit(MAX_HOT_KEYS).select(key)


def mark_changed(
    df: DataFrame,
    key: str,
    order: str,
    modified: str,
    success: Column | None = None,
    last: DataFrame | None = None,
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """Add `changed`: the row is the first of its key, has no modified time, or one above the last kept.

    Only rows with `success` become the last kept one. A kept row without modified time makes the next row count
    as changed. `last` (key, modified) gives what earlier runs kept. `order` is a unique long that grows with arrival.

    Within a key the last kept time is a running maximum that starts anew after each kept row without a time. Rows are counted per key
    first, which runs at once. If no key is hot, which is the rule, one window does. Else rows are written once, so `df` is read
    twice in all, and hot keys are cut into segments of `segment_rows` order values. A segment is summed up by whether it starts anew
    and its closing maximum; both are carried on over ranges of segments, ranges of ranges and so on, so no task sees more than a segment of
    a hot key, or more than 2**RANGE_BITS summaries, however sparse `order` is.
    """
    success = F.lit(True) if success is None else F.coalesce(success, F.lit(False))
    time = F.nullif(F.col(modified), F.lit(""))
    rows = df.withColumns({"_time": F.when(success, time), "_resets": (success & time.isNull()).cast("long")})
    kept = None if last is None else last.select(F.col(key).alias("_key"), F.nullif(F.col(modified), F.lit("")).alias("_last"))

    hot = hot_keys(df, key, segment_rows).persist(StorageLevel.DISK_ONLY)
    try:
        if not hot.count():
            return _marked(_carried_keys(rows, key, order, kept), time, df.columns)
        rows = written(_with_hot(rows, key, hot, kept), "segments")
    finally:
        hot.unpersist()
    cold = _carried_keys(rows.filter("_hot IS NULL").drop("_last"), key, order, kept)
    large = _carried_segments(rows.filter("_hot IS NOT NULL"), order, segment_rows)
    return _marked(cold, time, df.columns).unionByName(_marked(large, time, df.columns))


def _marked(rows: DataFrame, time: Column, columns: list[str]) -> DataFrame:
    """Rows with `changed`, from the running maximum of their stretch and what was carried into the first stretch."""
    known = F.when(F.col("_epoch") == 0, F.greatest("_before", "_start")).otherwise(F.col("_before"))
    return rows.withColumn("changed", time.isNull() | known.isNull() | (time > known)).select(*columns, "changed")


def _with_hot(rows: DataFrame, key: str, hot: DataFrame, kept: DataFrame | None) -> DataFrame:
    """Add to the rows of hot keys a number for the key, `_hot`, and the time carried from earlier runs, `_last`."""
    named = hot.select(F.col(key).alias("_key"), F.monotonically_increasing_id().alias("_hot"))
    if kept is None:
        named = named.withColumn("_last", F.lit(None).cast("string"))
    else:
        named = named.join(kept, "_key", "left")
    # Null is a key like any other. The size of the kept keys is known, so Spark decides whether to broadcast them.
    return rows.join(named, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")


def _carried_keys(rows: DataFrame, key: str, order: str, kept: DataFrame | None) -> DataFrame:
    """Rows of keys that fit into a task, with the state before each."""
    marked = _with_epochs(rows, [key], order)
    if kept is None:
        return marked.withColumn("_start", F.lit(None).cast("string"))
    # Rows are partitioned by key already, which is what this join asks for.
    return marked.join(kept, F.col(key) == F.col("_key"), "left").drop("_key").withColumnRenamed("_last", "_start")


def _carried_segments(rows: DataFrame, order: str, segment_rows: int) -> DataFrame:
    """Rows of hot keys with the state before each: that within the segment, and what the segments before carry into it."""
    segment = F.floor(F.col(order) / F.lit(segment_rows)).cast("long")
    marked = _with_epochs(rows.withColumn("_segment", segment), ["_hot", "_segment"], order)
    starts = _segment_starts(marked, segment_rows)
    # Rows are partitioned by key and segment already.
    joined = marked.join(starts, ["_hot", "_segment"])
    return joined.withColumn("_start", F.when(F.col("_restarted"), F.col("_start")).otherwise(F.greatest("_start", "_last")))


def _with_epochs(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Number the stretches between kept rows without time, and take the running maximum within each.

    Epochs never fall, so the greatest (epoch, time) so far is the greatest time of the newest epoch: both windows
    share one sort.
    """
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    numbered = rows.withColumn("_epoch", F.coalesce(F.sum("_resets").over(before), F.lit(0)))
    seen = numbered.withColumn("_seen", F.max(F.struct("_epoch", "_time")).over(before))
    return seen.withColumn("_before", F.when(F.col("_seen._epoch") == F.col("_epoch"), F.col("_seen._time")))


def _segment_starts(rows: DataFrame, segment_rows: int) -> DataFrame:
    """Per segment of a hot key: the maximum it starts from, and whether a kept row without time came before it.

    The greatest (starts so far, closing maximum) of the segments before is the maximum since the newest start, as in `_with_epochs`.
    """
    closing = (
        rows.groupBy("_hot", "_segment")
        .agg(F.max(F.struct("_epoch", "_resets")).alias("_end"), F.max(F.struct("_epoch", "_time")).alias("_top"))
        .select(
            "_hot",
            "_segment",
            ((F.col("_end._epoch") > 0) | (F.col("_end._resets") > 0)).cast("long").alias("_restarts"),
            F.when(F.col("_end._resets") == 0, F.col("_top._time")).alias("_closing"),
        )
    )
    # Few and narrow, and read several times below.
    closing = written(closing, "closing")
    most = closing.groupBy("_hot").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    # Above this many, ranges of segments: the window above the topmost ranges has no more summaries than a range.
    number_bits = 64 - (segment_rows.bit_length() - 1)
    levels = 0 if most <= SUMMARIES else max(1, math.ceil((number_bits - RANGE_BITS) / RANGE_BITS))
    counted = earlier(closing, ["_hot"], "_segment", {"_run": ("sum", F.col("_restarts"))}, levels)
    counted = counted.withColumn("_run", F.coalesce("_run", F.lit(0)))
    counted = written(counted, "closing") if levels else counted
    newest = F.struct((F.col("_run") + F.col("_restarts")).alias("run"), F.col("_closing").alias("time"))
    carried = earlier(counted, ["_hot"], "_segment", {"_carried": ("max", newest)}, levels)
    return carried.select("_hot", "_segment", F.col("_carried.time").alias("_start"), (F.col("_run") > 0).alias("_restarted"))


def changed_rows(df: DataFrame, key: str, order: str, modified: str, **options) -> DataFrame:
    """The rows `mark_changed` keeps."""
    return mark_changed(df, key, order, modified, **options).filter("changed").drop("changed")


def latest_per_key(df: DataFrame, key: str | list[str], *order: str) -> DataFrame:
    """The row with the greatest `order` of each key.

    Spark keeps one row per key and task before the shuffle, so a hot key sends no more than one row per task.
    """
    keys = [key] if isinstance(key, str) else key
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")
