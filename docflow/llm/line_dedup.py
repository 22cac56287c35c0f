"""Line dedup on levelled sorted runs of line hashes."""

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docflow.llm.common import kept, scratch, text_or_empty

WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """A line without white space at its ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(WHITE)), UPPER, LOWER)


class LineRuns:
    """An index of line hashes that grows by batches: sorted runs on levels, `fanout` runs of a level make one of the next.

    A run is a table bucketed and sorted by the 128-bit hash, so that a batch is merge-joined with it where it lies: only the
    batch is shuffled. Its rows: h1, h2, keeper (the document that brought the line into the index; null if an older run
    has the line) and docs (documents of the batch that hold it). Runs lie under spark.checkpoint.dir.
    """

    def __init__(self, spark: SparkSession, fanout: int = 3, buckets: int | None = None):
        if fanout < 2:
            raise ValueError("fanout must be at least 2")
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.paths: dict[str, str] = {}

    def add(self, lines: DataFrame) -> None:
        """Take in a batch of rows doc, h1, h2. The documents of a batch must be in no other batch.

        The batch is anti-joined with every run: lines that no run has get a keeper, the batch's largest document.
        """
        own = lines.groupBy(KEY).agg(F.count_distinct("doc").alias("docs"), F.max("doc").alias("keeper"))
        seen = F.lit(False)
        for i, run in enumerate(run for level in self.levels for run in level):
            older = self.spark.table(run).filter("keeper IS NOT NULL").select(*KEY, F.lit(True).alias(f"in{i}"))
            own = own.join(older, KEY, "left")
            seen = seen | F.coalesce(F.col(f"in{i}"), F.lit(False))
        self._write(own.select(*KEY, F.when(~seen, F.col("keeper")).alias("keeper"), "docs"), 0)

    def lines(self) -> DataFrame:
        """h1, h2, keeper, docs of all batches."""
        runs = [run for level in self.levels for run in level]
        return self._merged(runs) if runs else self.spark.createDataFrame([], "h1 long, h2 long, keeper long, docs long")

    def _merged(self, runs: list[str]) -> DataFrame:
        # Read as plain files: Spark 4.1 takes a union of bucketed scans for partitioned by the buckets, and then reads the scans
        # without them, so that a group by the hash would leave a line's rows apart.
        rows = self.spark.read.schema(self.spark.table(runs[0]).schema).parquet(*[self.paths[run] for run in runs])
        return rows.groupBy(KEY).agg(F.max("keeper").alias("keeper"), F.sum("docs").alias("docs"))

    def _write(self, run: DataFrame, level: int) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        self.paths[name] = scratch(self.spark, "line-runs", name)
        (
            run.repartition(self.buckets, *KEY)
            .write.bucketBy(self.buckets, *KEY)
            .sortBy(*KEY)
            .option("path", self.paths[name])
            .saveAsTable(name)
        )
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) == self.fanout:
            runs, self.levels[level] = self.levels[level], []
            self._write(self._merged(runs), level + 1)


def drop_lines(
    docs: DataFrame, min_chars: int = 40, min_docs: int = 5, batches: int = 4, fanout: int = 3
) -> DataFrame:
    """Drop lines that many documents hold from all of them but the one with the largest doc_id.

    docs: doc_id (long), text, further columns. A line's key is the line stripped and A-Z lower-cased; keys of at least
    `min_chars` code points in at least `min_docs` documents lose their lines outside the largest doc_id that holds them.
    The documents enter the index of line runs in `batches` of falling doc_id, so the first batch that brings a line keeps it.

    Adds n_lines, n_dropped and kept (what stays, joined by newlines); columns of these names are replaced. Null or empty
    text is one empty line. Rows with a null doc_id stay whole and count for nothing. Rows of the same doc_id count as
    one document. Equal rows are alike. No documents give no rows.
    """
    spark = docs.sparkSession
    docs = docs.drop("n_lines", "n_dropped", "kept")
    split = F.split(text_or_empty(), "\n")
    same = F.xxhash64(text_or_empty())
    lines = docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").alias("doc"), same.alias("same"), F.posexplode(split))
    lines = lines.withColumn("key", line_key(F.col("col"))).filter(F.length("key") >= min_chars)
    hashes = (F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"))
    lines = kept(lines.select("doc", "same", "pos", *hashes), "lines")

    cuts = [i / batches for i in range(1, batches)]
    bounds = lines.agg(F.percentile_approx("doc", cuts, 1000)).first()[0] if cuts else []
    bounds = sorted(set(bounds or []), reverse=True)
    runs = LineRuns(spark, fanout)
    for upper, lower in zip([None, *bounds], [*bounds, None]):
        batch = lines if upper is None else lines.filter(F.col("doc") <= upper)
        runs.add(batch if lower is None else batch.filter(F.col("doc") > lower))

    common = kept(runs.lines().filter(F.col("docs") >= min_docs).select(*KEY, "keeper"), "common-lines")
    drops = lines.join(common, KEY).filter("doc <> keeper").groupBy("doc", "same").agg(F.collect_set("pos").alias("drops"))
    held = F.struct(*docs.columns).alias("row")
    # The split comes before the join, so that no lambda below can hold it.
    rows = docs.select(F.col("doc_id").alias("doc"), same.alias("same"), split.alias("lines"), held)
    rows = rows.join(drops, ["doc", "same"], "left")
    n_lines, n_dropped = F.size("lines"), F.coalesce(F.size("drops"), F.lit(0))
    stay = F.array_except(F.sequence(F.lit(0), n_lines - 1), "drops")
    text = F.when(n_dropped > 0, F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n")).otherwise(
        F.array_join("lines", "\n")
    )
    return rows.select(
        "row.*", n_lines.cast("long").alias("n_lines"), n_dropped.cast("long").alias("n_dropped"), text.alias("kept")
    )
