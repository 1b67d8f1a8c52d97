"""Whitelists and blocklists: text files with one address per line."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logwarden.functions.addresses import is_valid_ip

_BLANKS = " \t\n\r\f\v"


def ip_entries(line: Column, comments: bool) -> Column:
    """The address of a list line, null for comments, blank lines and anything invalid."""
    ip = F.btrim(line, F.lit(_BLANKS))
    wanted = is_valid_ip(ip)
    if comments:
        wanted = wanted & ~F.startswith(ip, F.lit("#"))
    return F.when(wanted, ip)


def ip_list(lines: DataFrame, column: str = "value", comments: bool = True) -> DataFrame:
    entries = lines.select(ip_entries(F.col(column), comments).alias("ip"))
    return entries.filter(F.col("ip").isNotNull()).distinct()


def read_whitelist(spark: SparkSession, path: str | None) -> DataFrame:
    """Distinct addresses of a whitelist; no path means an empty list."""
    if path is None:
        return spark.createDataFrame([], "ip string")
    return ip_list(spark.read.text(path), comments=True)


def read_blocklist(spark: SparkSession, path: str) -> DataFrame:
    """Distinct addresses already written; a missing file is an empty list."""
    try:
        return ip_list(spark.read.option("recursiveFileLookup", "true").text(path), comments=False)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "ip string")
