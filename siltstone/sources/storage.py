"""Folder operations on whatever file system the cluster uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    fs, location = _resolve(spark, path)
    return fs.exists(location)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below the folder; none when it does not exist."""
    fs, location = _resolve(spark, path)
    if not fs.exists(location):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(location))


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, location = _resolve(spark, path)
    fs.delete(location, True)


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file."""
    fs, location = _resolve(spark, path)
    fs.create(location).close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    fs, location = _resolve(spark, path)
    stream = fs.open(location)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file beside its place and move it there, so that it is never seen half written."""
    fs, location = _resolve(spark, path)
    _, aside = _resolve(spark, f"{path.rpartition('/')[0]}/_{path.rpartition('/')[2]}.writing")
    stream = fs.create(aside, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    fs.delete(location, False)
    if not fs.rename(aside, location):
        raise OSError(f"{path} could not be written")


def bytes_below(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    fs, location = _resolve(spark, path)
    return fs.getContentSummary(location).getLength()


def replace_folder(spark: SparkSession, source: str, target: str) -> None:
    """Put a folder in the place of another."""
    fs, location = _resolve(spark, source)
    _, place = _resolve(spark, target)
    fs.delete(place, True)
    if not fs.rename(location, place):
        raise OSError(f"{source} could not be moved to {target}")
