"""Small file-system helpers that work on any Hadoop-compatible path."""

from __future__ import annotations

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path as its own kind."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.delete(p, True)


def rename(spark: SparkSession, source: str, target: str) -> bool:
    fs, p = file_system(spark, source)
    return fs.rename(p, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target))


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder; empty when there is no such folder."""
    fs, p = file_system(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small text value, replaced as a whole."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0].rstrip("\n")
