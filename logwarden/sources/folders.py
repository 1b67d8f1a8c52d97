"""Folders of any store that Spark reaches: create, test, delete."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _store(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def make_folder(spark: SparkSession, path: str) -> None:
    store, target = _store(spark, path)
    store.mkdirs(target)


def exists(spark: SparkSession, path: str) -> bool:
    store, target = _store(spark, path)
    return store.exists(target)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder and what is in it; nothing happens where there is none."""
    store, target = _store(spark, path)
    store.delete(target, True)
