"""Content store: text and metadata by path.

Texts lie in folders by version and by bucket, a hash of the path. An index of levelled runs has a narrow row per path and version: the bucket, the
length of the text, the folder it is in, and whether the path was deleted. A lookup ranks index rows only, opens the buckets of the paths it wants
in the folders that hold a newest text of theirs, and reads those texts once. A save or delete costs what it touches.
`compact` folds the texts into a new store.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from docflow.functions.files import file_metadata, storage_path
from docflow.schemas import STORE_ROW
from docflow.sources.runs import Runs

INDEX = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("deleted", T.BooleanType()),
        T.StructField("folder", T.StringType()),
        T.StructField("length", T.LongType()),
    ]
)
# Tasks a bucket's share of a save is dealt to.
PARTS = 16


def index(spark: SparkSession, store: str) -> Runs:
    return Runs(spark, f"{store}/index", INDEX, "path", history=True)


def next_version(spark: SparkSession, store: str) -> int:
    """The version after all there are: the store's own number, whoever saves."""
    return max(index(spark, store).manifests(), default=-1) + 1


def content_rows(
    files: DataFrame, text: str = "text", file_id: str = "id", name: str = "name", mime_type: str = "mimeType",
    seq: str = "offset",
) -> DataFrame:
    """Store rows of extracted files; `seq` orders saves of one path within a version."""
    return files.select(
        storage_path(F.col(file_id)).alias("path"),
        F.col(text).alias("content"),
        file_metadata(F.col(file_id), F.col(name), F.col(mime_type)).alias("metadata"),
        F.col(seq).cast("long").alias("seq"),
    )


def save(rows: DataFrame, store: str, version: int | None = None, unique: bool = False) -> int:
    """Save (path, content, metadata, seq) as a version, by default the next; the last of several saves of a path wins. Returns the version.

    Saving the same version again replaces it and what came after it. Texts are shuffled once, by bucket and path; rows that are
    known to have a path each are not ranked.
    """
    spark = rows.sparkSession
    version = next_version(spark, store) if version is None else version
    table = index(spark, store)
    metadata = F.when(F.size("metadata") > 0, F.col("metadata")).alias("metadata")
    dealt = rows.select("path", "content", metadata, F.col("seq").cast("long").alias("seq")).withColumn("bucket", table.bucket())
    dealt = dealt.withColumn("_part", F.pmod(F.hash("path"), F.lit(PARTS))).repartition("bucket", "_part")
    if not unique:
        # The window asks for no other partitioning than the one there is.
        newest = Window.partitionBy("bucket", "_part", "path").orderBy(F.col("seq").desc())
        dealt = dealt.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")
    folder = f"version={version}/write={uuid.uuid4().hex}"
    dealt.drop("_part").sortWithinPartitions("bucket", "path").write.partitionBy("bucket").parquet(f"{store}/data/{folder}")
    saved = _texts(spark, store, [folder])
    length = F.coalesce(F.length("content"), F.lit(0)).cast("long").alias("length")
    table.append(saved.select("path", "seq", F.lit(False).alias("deleted"), F.lit(folder).alias("folder"), length), version)
    return version


def delete(paths: DataFrame, store: str, version: int | None = None) -> int:
    """Mark paths as removed, content and metadata; a path that is not there is no error. Returns the version."""
    spark = paths.sparkSession
    version = next_version(spark, store) if version is None else version
    gone = paths.select("path").distinct()
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in INDEX if f.name not in ("path", "deleted")]
    index(spark, store).append(gone.select("path", F.lit(True).alias("deleted"), *nothing), version)
    return version


def _texts(spark: SparkSession, store: str, of: list[str]) -> DataFrame:
    """path, content, metadata, seq, bucket, write of some folders."""
    schema = T.StructType([*STORE_ROW]).add("version", T.LongType()).add("write", T.StringType()).add("bucket", T.IntegerType())
    paths = [f"{store}/data/{folder}" for folder in of]
    rows = spark.read.schema(schema).option("basePath", f"{store}/data").parquet(*paths) if of else spark.createDataFrame([], schema)
    return rows.drop("version")


def held(spark: SparkSession, store: str, as_of: int | None = None, wanted: DataFrame | None = None) -> DataFrame:
    """path, length, version, folder and bucket of the newest content per path, from the index alone."""
    rows = index(spark, store).all_rows(as_of, wanted)
    newest = Window.partitionBy("path").orderBy(F.col("batch").desc(), F.col("seq").desc())
    rows = rows.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1 AND NOT deleted")
    return rows.select("path", "length", F.col("batch").alias("version"), "folder", "bucket")


def read_store(spark: SparkSession, store: str, as_of: int | None = None, wanted: DataFrame | None = None) -> DataFrame:
    """Newest content per path, as of a version if given, of the `wanted` paths if given.

    Which folders and buckets are opened is asked of the index when this is called: one row per bucket of a save that still holds a newest text.
    """
    newest = held(spark, store, as_of, wanted)
    places = newest.select("folder", "bucket").distinct().collect()
    buckets = sorted({p.bucket for p in places})
    texts = _texts(spark, store, sorted({p.folder for p in places})).filter(F.col("bucket").isin(buckets))
    write = F.regexp_extract("folder", "write=(.*)$", 1).alias("write")
    winners = newest.select("path", "bucket", write, "version")
    return texts.join(winners, ["path", "bucket", "write"]).select("path", "content", "metadata", "version")


def load(spark: SparkSession, store: str, wanted: DataFrame, as_of: int | None = None) -> DataFrame:
    """`wanted` paths with their content and metadata; null where there is none."""
    found = read_store(spark, store, as_of, wanted.select("path"))
    return wanted.join(found.select("path", "content", "metadata"), "path", "left")


def compact(spark: SparkSession, store: str, target: str, version: int | None = None) -> int:
    """Write the newest text of each path as a version of a new store."""
    rows = read_store(spark, store).select("path", "content", "metadata", F.lit(0).cast("long").alias("seq"))
    return save(rows, target, version, unique=True)
