"""Small questions to the file system that holds the tables, asked through Hadoop, so that any path Spark can read will do."""

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _at(spark, path)
    return system.exists(place)


def make(spark: SparkSession, path: str) -> None:
    """A folder and those above it; one that is there is no error."""
    system, place = _at(spark, path)
    system.mkdirs(place)


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds; nothing if it is not there."""
    system, place = _at(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(place)) if system.exists(place) else []


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder or file with all that is in it; one that is not there is no error."""
    system, place = _at(spark, path)
    system.delete(place, True)


def read_text(spark: SparkSession, path: str) -> str:
    system, place = _at(spark, path)
    with_stream = system.open(place)
    try:
        return bytes(with_stream.readAllBytes()).decode()
    finally:
        with_stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under another name first: a reader sees all of it or the one before."""
    system, place = _at(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{place.getName()}.draft")
    stream = system.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    system.delete(place, False)
    system.rename(draft, place)
