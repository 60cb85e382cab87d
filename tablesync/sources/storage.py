"""Small file-system helpers through Hadoop's API, so any shared store works."""

from __future__ import annotations

from pyspark.sql import SparkSession

__all__ = ["list_dirs", "exists", "delete_dir"]


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the directories directly under a path; empty if it does not exist."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def delete_dir(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)
