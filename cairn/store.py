"""Small files and folders of any store that Spark reads, by Hadoop's file systems."""

from __future__ import annotations

import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _missing(error: Py4JJavaError) -> bool:
    return "FileNotFoundException" in str(error.java_exception.getClass().getName())


def modified(spark: SparkSession, path: str) -> dict[str, int]:
    """Names in a folder, and when each was last changed, in milliseconds; none where there is no folder."""
    at, fs = _at(spark, path)
    try:
        return {s.getPath().getName(): s.getModificationTime() for s in fs.listStatus(at)}
    except Py4JJavaError as error:
        if _missing(error):
            return {}
        raise


def names(spark: SparkSession, path: str) -> list[str]:
    return list(modified(spark, path))


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, or None where there is none."""
    at, fs = _at(spark, path)
    try:
        stream = fs.open(at)
    except Py4JJavaError as error:
        if _missing(error):
            return None
        raise
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Put a file in place whole, under a name that must be free; False where it is taken."""
    at, fs = _at(spark, path)
    made = at.suffix(f".{uuid.uuid4().hex}.tmp")
    out = fs.create(made, False)
    out.write(bytearray(text.encode()))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri() if at.toUri().getScheme() else fs.getUri(), spark._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(made, at, none)
        return True
    except Py4JJavaError as error:
        fs.delete(made, False)
        if "FileAlreadyExistsException" in str(error.java_exception.getClass().getName()):
            return False
        raise


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file; one that is there is replaced."""
    at, fs = _at(spark, path)
    out = fs.create(at, True)
    out.write(bytearray(text.encode()))
    out.close()


def move(spark: SparkSession, path: str, to: str) -> None:
    """Move a folder to a free name."""
    at, fs = _at(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(to)
    fs.mkdirs(target.getParent())
    if not fs.rename(at, target):
        raise OSError(f"{path} cannot be moved to {to}")


def remove(spark: SparkSession, path: str) -> None:
    at, fs = _at(spark, path)
    fs.delete(at, True)


def now(spark: SparkSession) -> float:
    """The time in milliseconds."""
    return time.time() * 1000
