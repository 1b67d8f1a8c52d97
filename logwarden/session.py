"""Session helpers: settings for stand-alone runs and durable intermediate results."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from logwarden.sources.folders import delete_folder


def local_session(cores: str | int = "*", app: str = "logwarden", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster the caller brings the session."""
    partitions = cores if isinstance(cores, int) else 8
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate results that all executors share.

    The session's ``spark.checkpoint.dir``; where that is unset, a folder in the warehouse.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_intermediate"


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    For results whose row numbers or partition layout must not change between uses. It
    survives the loss of executors, unlike cached blocks.
    """
    return stored(df)


_scratch = threading.local()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that ``stored`` writes inside the block when it ends.

    For steps that end by writing their result: what is read lazily later must not be inside.
    """
    outer, _scratch.paths = getattr(_scratch, "paths", None), []
    try:
        yield
    finally:
        paths, _scratch.paths = _scratch.paths, outer
        for path in paths:
            delete_folder(spark, path)


def stored(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """``df`` written as a Parquet table: later reads prune columns, filters and partitions."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/logwarden-{uuid.uuid4().hex}"
    if getattr(_scratch, "paths", None) is not None:
        _scratch.paths.append(path)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
