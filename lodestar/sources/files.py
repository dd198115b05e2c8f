"""The few file operations Spark's readers and writers do not offer, on any
Hadoop file system."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _local(spark: SparkSession, p):
    return spark._jvm.java.io.File(p.toUri().getPath()).toPath()


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in ``folder``; none if it does not exist."""
    fs, p = _open(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _open(spark, path)
    fs.delete(p, True)


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Put a file in place in one atomic step; False if it is there already.

    The text is written beside it and then moved: HDFS and its kind refuse a
    rename onto a file that exists; a local folder gets a hard link, which
    fails the same way.
    """
    fs, p = _open(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(
        p.getParent(), f"_{p.getName()}.{uuid.uuid4().hex}")
    out = fs.create(beside)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if fs.getScheme() != "file":
            return bool(fs.rename(beside, p))
        nio = spark._jvm.java.nio.file
        try:
            nio.Files.createLink(_local(spark, p), _local(spark, beside))
        except Exception as e:
            if "FileAlreadyExists" in str(e):
                return False
            raise
        return True
    finally:
        fs.delete(beside, False)
