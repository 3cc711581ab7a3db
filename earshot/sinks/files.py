"""The few file operations that sinks need, in any file system that Spark reaches."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _at(spark, path)
    return system.exists(place)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders directly below ``path``; none if it is absent."""
    system, place = _at(spark, path)
    if not system.exists(place):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(place))


def age_hours(spark: SparkSession, path: str) -> float:
    """Hours since a file or folder was last changed."""
    system, place = _at(spark, path)
    return time.time() / 3600 - system.getFileStatus(place).getModificationTime() / 3_600_000


def delete(spark: SparkSession, path: str) -> None:
    """Removes a file or a folder with all it holds; an absent one is left alone."""
    system, place = _at(spark, path)
    system.delete(place, True)


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Creates a file with ``text`` and tells whether it did: of two callers only one does.

    The file system has to refuse to create a file twice, as local disks, HDFS and object
    stores with conditional writes do.
    """
    system, place = _at(spark, path)
    try:
        out = system.create(place, False)
    except Exception as error:
        if system.exists(place):
            return False
        raise error
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    system, place = _at(spark, path)
    opened = system.open(place)
    try:
        return bytes(opened.readAllBytes()).decode()
    finally:
        opened.close()
