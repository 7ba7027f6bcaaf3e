"""Folders of the shared file system, through Hadoop's API on the driver.

Used for names and single marker files only; all rows are read and written by Spark.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    fs, p = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Data files of a folder; names that start with ``_`` or ``.`` are not data."""
    return [f"{path}/{n}" for n in names(spark, path) if n[:1] not in "_."]


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def first_line(spark: SparkSession, path: str) -> str:
    """First line of a small file."""
    return spark.read.text(path).first()[0]


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty marker file; False if it exists already."""
    fs, p = _file_system(spark, path)
    fs.mkdirs(p.getParent())
    return fs.createNewFile(p)
