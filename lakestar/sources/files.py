"""Listing folders through the file system of their path, without a Spark job."""

from __future__ import annotations

from pyspark.sql import SparkSession


def matching_paths(spark: SparkSession, pattern: str) -> list:
    """Paths that match a glob pattern."""
    target = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return [status.getPath() for status in found or []]


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder and its content, if it exists."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
