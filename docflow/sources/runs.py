"""A keyed table as levelled runs: each batch adds a small one, and every so many of a level are folded into one of the next.

A batch writes what it changes. Runs of the first level are files with the bucket of the key in a column; folded ones have a folder for each bucket
(hash of the key), so a reader with some keys opens the buckets these are in. A manifest per batch names the runs there are; the last two
are kept with their runs, so a batch that comes again, under its own number, starts from what the batch before left. What no kept manifest
names is removed. With `fan` runs to a fold, a row is written once per level: as often as the logarithm of the number of batches.

The manifest is read and written by the driver. It has fewer than `fan` names a level.
"""

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from docflow.operators.changes import latest_per_key
from docflow.sources import folders

# Of a new table, unless the session says otherwise; a table keeps the number it began with.
BUCKETS = 16
BUCKETS_SETTING = "spark.docflow.buckets"
FAN = 8
KEPT = 2


class Runs:
    """Rows of `schema` by `key`; the row of the greatest batch counts, by `order` within the batch.

    With history, older rows of a key are folded along and can be read as of a batch; else they go when runs are folded.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int | None = None, fan: int = FAN, history: bool = False
    ):
        self.spark, self.path, self.key, self.fan, self.history = spark, path, key, fan, history
        if folders.exists(spark, f"{path}/buckets"):
            self.buckets = int(folders.read_text(spark, f"{path}/buckets"))
        else:
            self.buckets = buckets or int(spark.conf.get(BUCKETS_SETTING, str(BUCKETS)))
        self.schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema]).add("batch", T.LongType())
        self.stored = T.StructType([*self.schema, T.StructField("bucket", T.IntegerType())])

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    # --- manifests

    def manifests(self) -> list[int]:
        return [int(name) for name in folders.names(self.spark, f"{self.path}/manifests") if name.isdigit()]

    def manifest(self, batch: int | None = None) -> list[dict]:
        """The runs there were after a batch, or are now: name, level."""
        there = [m for m in self.manifests() if batch is None or m <= batch]
        return json.loads(folders.read_text(self.spark, f"{self.path}/manifests/{max(there):020d}")) if there else []

    def _put(self, batch: int, runs: list[dict], before: list[dict]) -> None:
        folders.write_text(self.spark, f"{self.path}/manifests/{batch:020d}", json.dumps(runs))
        numbers = sorted(m for m in self.manifests() if m <= batch)
        for old in [*numbers[:-KEPT], *(m for m in self.manifests() if m > batch)]:
            folders.delete(self.spark, f"{self.path}/manifests/{old:020d}")
        live = {r["name"] for r in [*runs, *before]}
        for level in folders.names(self.spark, f"{self.path}/runs"):
            for name in folders.names(self.spark, f"{self.path}/runs/{level}"):
                if f"{level}/{name}" not in live:
                    folders.delete(self.spark, f"{self.path}/runs/{level}/{name}")

    # --- rows

    def _rows(self, runs: list[dict], buckets: list[int] | None = None) -> DataFrame:
        """The rows of runs, of some buckets."""
        found = self.spark.createDataFrame([], self.stored)
        for flat in (True, False):
            paths = [f"{self.path}/runs/{r['name']}" for r in runs if (r["level"] == 0) == flat]
            if paths:
                reader = self.spark.read.schema(self.stored)
                rows = (reader if flat else reader.option("basePath", f"{self.path}/runs")).parquet(*paths).select(*self.stored.names)
                found = found.unionByName(rows if buckets is None else rows.filter(F.col("bucket").isin(buckets)))
        return found

    def all_rows(self, batch: int | None = None, wanted: DataFrame | None = None) -> DataFrame:
        """The rows of all batches up to one that are still there, of the keys of `wanted`: only their buckets are opened."""
        buckets = None
        if wanted is not None:
            wanted = wanted.select(self.key).filter(F.col(self.key).isNotNull()).distinct()
            # One number for each bucket at most.
            buckets = [r[0] for r in wanted.select(self.bucket().alias("b")).distinct().collect()]
        # With history the newest manifest has the rows of all batches before, however long ago.
        rows = self._rows(self.manifest(None if self.history else batch), buckets)
        if wanted is not None:
            rows = rows.join(wanted, self.key, "left_semi")
        return rows if batch is None else rows.filter(F.col("batch") <= batch)

    def read(self, batch: int | None = None, wanted: DataFrame | None = None, order: tuple[str, ...] = ()) -> DataFrame:
        """The newest row of each key as of a batch."""
        return latest_per_key(self.all_rows(batch, wanted), self.key, "batch", *order).drop("bucket")

    def append(self, rows: DataFrame, batch: int, order: tuple[str, ...] = ()) -> None:
        """Add the rows of a batch; the same batch again replaces it, and all that came after it."""
        before = self.manifest(batch - 1)
        if not folders.exists(self.spark, f"{self.path}/buckets"):
            folders.write_text(self.spark, f"{self.path}/buckets", str(self.buckets))
        name = f"level=0/run={uuid.uuid4().hex}"
        fields = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema if f.name != "batch"]
        added = rows.select(*fields, F.lit(batch).cast("long").alias("batch")).withColumn("bucket", self.bucket())
        # As many files as the rows need; sorted, so that a reader skips row groups of other buckets.
        added.hint("rebalance").sortWithinPartitions("bucket", self.key).write.parquet(f"{self.path}/runs/{name}")
        self._put(batch, self._folded([*before, {"name": name, "level": 0}], order), before)

    def _folded(self, runs: list[dict], order: tuple[str, ...]) -> list[dict]:
        """Fold the runs of full levels, from the lowest on; a fold that fills the next level takes that one along."""
        level = -1
        while len([r for r in runs if r["level"] == level + 1]) + (level >= 0) >= self.fan:
            level += 1
        if level < 0:
            return runs
        rows = self._rows([r for r in runs if r["level"] <= level])
        if not self.history:
            rows = latest_per_key(rows, self.key, "batch", *order)
        name = f"level={level + 1}/run={uuid.uuid4().hex}"
        spread = rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", self.key)
        spread.write.partitionBy("bucket").parquet(f"{self.path}/runs/{name}")
        return [r for r in runs if r["level"] > level] + [{"name": name, "level": level + 1}]
