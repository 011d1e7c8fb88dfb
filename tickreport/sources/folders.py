"""Folder operations through Hadoop's file system API, which reaches whatever
store the path names (HDFS, object store, local in tests)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _on(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _on(spark, path)
    return bool(fs.exists(place))


def matches(spark: SparkSession, pattern: str) -> bool:
    fs, place = _on(spark, pattern)
    found = fs.globStatus(place)
    return found is not None and len(found) > 0


def delete(spark: SparkSession, path: str) -> None:
    fs, place = _on(spark, path)
    fs.delete(place, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, place = _on(spark, source)
    there = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(there.getParent())
    if not fs.rename(place, there):
        raise OSError(f"could not move {source} to {target}")
