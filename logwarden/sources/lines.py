"""Log text as a table of lines: ``file, pos, line``."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REPLACEMENT = "\N{REPLACEMENT CHARACTER}"


def decoded(value: Column, undecodable: str = "replace") -> Column:
    """Text with undecodable bytes replaced by U+FFFD, or dropped."""
    text = F.make_valid_utf8(value)
    if undecodable == "drop":
        return F.translate(text, REPLACEMENT, "")
    if undecodable != "replace":
        raise ValueError(f"undecodable must be 'replace' or 'drop', got {undecodable!r}")
    return text


def read_lines(spark: SparkSession, path: str | list[str], undecodable: str = "replace") -> DataFrame:
    """Scan log files; ``\\n``, ``\\r\\n`` and ``\\r`` all end a line.

    ``pos`` is unique and grows with the line number within each file (Spark numbers the
    splits of a file in offset order). It stays a plain ``bigint`` so that "first line"
    aggregates remain hash aggregates. Numbers of different files are not comparable.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file", metadata={"scanned_file": True}),
        F.monotonically_increasing_id().alias("pos"),
        decoded(F.col("value"), undecodable).alias("line"),
    )


def list_files(spark: SparkSession, path: str | list[str], empty: bool = True) -> DataFrame:
    """All files under ``path``.

    Names of files with content come from the tasks of a scan that opens none of them. Every
    scan leaves out empty files; their names are known to Spark's file index in the driver
    alone. With ``empty`` they are taken from there, which passes the index through the
    driver's Python; leave it out where there are millions of files.
    """
    filled = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("file"))
    if not empty:
        return filled
    # local files are listed as file:///x but called file:/x by the scan's metadata
    names = [(re.sub("^file:///", "file:/", name),) for name in spark.read.text(path).inputFiles()]
    return filled.union(spark.createDataFrame(names, "file string").join(filled, "file", "left_anti"))


def start_time(spark: SparkSession, marker: str) -> int:
    """When following began, in microseconds: the time of the first call with this ``marker``.

    It is kept as a small table, so that a restarted query goes on from its own beginning and
    reads what landed while it was down.
    """
    try:
        return spark.read.schema("started bigint").parquet(marker).first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    now = spark.range(1).select(F.unix_micros(F.current_timestamp()).alias("started"))
    now.coalesce(1).write.parquet(marker)
    return spark.read.schema("started bigint").parquet(marker).first()[0]


def stream_lines(
    spark: SparkSession,
    path: str,
    follow_from: str | None = None,
    undecodable: str = "drop",
    max_files_per_batch: int | None = None,
) -> DataFrame:
    """Lines of files as they land in ``path``.

    With ``follow_from``, a path beside the query's checkpoint, only files modified after the
    first start count; that time is kept there and holds for later starts.
    """
    reader = spark.readStream.format("text")
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    raw = reader.load(path)
    if follow_from:
        started = start_time(spark, follow_from)
        raw = raw.filter(F.unix_micros(F.col("_metadata.file_modification_time")) > started)
    return raw.select(
        F.col("_metadata.file_path").alias("file"), decoded(F.col("value"), undecodable).alias("line")
    )
