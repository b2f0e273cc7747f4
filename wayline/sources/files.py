"""Small questions about paths, asked through Hadoop so that any shared store works."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target)


def committed(spark: SparkSession, path: str) -> bool:
    """True once a Spark write to `path` has completed."""
    return exists(spark, f"{path}/_SUCCESS")


def children(spark: SparkSession, path: str) -> list[str]:
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def mark(spark: SparkSession, path: str) -> None:
    """An empty folder that says something happened."""
    fs, target = _fs(spark, path)
    fs.mkdirs(target)


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    fs.delete(target, True)
