"""Paths on any file system that Spark reaches."""

from __future__ import annotations

from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, path: str):
    """The JVM's path object, with its file system named."""
    plain = spark._jvm.org.apache.hadoop.fs.Path(path)
    return plain.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(plain)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on any file system Spark can reach."""
    plain = spark._jvm.org.apache.hadoop.fs.Path(path)
    return plain.getFileSystem(spark._jsc.hadoopConfiguration()).exists(plain)


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there."""
    plain = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = plain.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.exists(plain) and files.getFileStatus(plain).isDirectory()
