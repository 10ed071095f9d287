"""Folder questions asked through Hadoop, so they work on any storage Spark can read."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _folder(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, or anything matching a glob, exists."""
    fs, hadoop_path = _folder(spark, path)
    return bool(fs.globStatus(hadoop_path))


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, hadoop_path = _folder(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files below a folder."""
    fs, hadoop_path = _folder(spark, path)
    return int(fs.getContentSummary(hadoop_path).getLength())


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _folder(spark, path)
    fs.delete(hadoop_path, True)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, its folder included."""
    fs, hadoop_path = _folder(spark, path)
    fs.create(hadoop_path, True).close()


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds a file that readers see."""
    return any(not name.startswith(("_", ".")) for name in child_names(spark, path))


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, in order."""
    fs, hadoop_path = _folder(spark, pattern)
    return sorted(status.getPath().toString() for status in fs.globStatus(hadoop_path) or ())
