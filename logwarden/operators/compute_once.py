"""Keep an expensive expression from being evaluated again by every later filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_struct(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add ``value`` as a column that later filters cannot be pushed through.

    Catalyst moves a filter below the projection it refers to and repeats the projected
    expression there; for a cascade of regular expressions that doubles the cost of a
    scan. A generated column is opaque to that rule, stays inside whole-stage codegen, and
    the one-element array yields exactly one row per input row.
    """
    return df.select("*", F.explode_outer(F.array(value)).alias(name))
