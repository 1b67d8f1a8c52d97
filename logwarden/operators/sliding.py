"""Aggregate over a sliding time window without joining events to events.

For each probe time, combine the facts of the same key whose time lies in a window of
fixed width next to the probe. The time axis is cut into blocks as wide as the window, so
that a window is the tail of one block plus the head of the next; tails and heads are
running aggregates, read off two sorted passes over a block. Work is O(n log n) in the
rows of a block, against O(rows x window) for a sliding RANGE frame and O(n^2) for a join.

Skew: a hot key spreads over its blocks. Within a block, facts and probes of the same time
are merged first, with map-side combine, so a block holds at most two rows per distinct
time plus two per probe time: for logs with one-second times and a window of 30 minutes at
most a few thousand rows, however many events one key has.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logwarden.functions.timestamps import floor_div

_FACT, _TAIL, _HEAD = 0, 1, 2

COMBINE = {"sum": F.sum, "min": F.min, "max": F.max}


def window_aggregate(
    rows: DataFrame,
    keys: list[str],
    at: str,
    is_fact: Column,
    is_probe: Column,
    start: int,
    width: int,
    measures: dict[str, tuple[Column, str]],
) -> DataFrame:
    """``keys, at, <measures>, probes``: one row per distinct probe (keys, at) with facts.

    ``rows`` holds facts and probes; a row can be both. The window of a probe at time p is
    ``p + start <= fact time < p + start + width``, all integers of the unit of ``at``.
    ``measures`` maps names to (expression over a fact row, 'sum' | 'min' | 'max').
    ``probes`` is the number of probe rows at that time. Empty windows give no row.
    """
    if width < 1:
        raise ValueError("the window must be at least one time unit wide")
    time = F.col(at)
    first, last = time + start, time + (start + width - 1)

    def place(side: int, position: Column) -> Column:
        return F.struct(
            floor_div(position, width).alias("block"), position.alias("position"), F.lit(side).alias("side")
        )

    # a probe whose window starts on a block border lies in one block: no head needed
    two_blocks = floor_div(first, width) != floor_div(last, width)
    places = F.array(
        F.when(is_fact, place(_FACT, time)),
        F.when(is_probe, place(_TAIL, first)),
        F.when(is_probe & two_blocks, place(_HEAD, last)),
    )
    side = F.col("side")
    inputs = [value.alias(name) for name, (value, _) in measures.items()]
    placed = (
        rows.select(*keys, *inputs, F.inline(places).alias("block", "position", "side"))
        .filter(side.isNotNull())
        .select(*keys, "block", "position", "side", *[F.when(side == _FACT, F.col(m)).alias(m) for m in measures])
    )
    merged = placed.groupBy(*keys, "block", "position", "side").agg(
        *[COMBINE[how](name).alias(name) for name, (_, how) in measures.items()], F.count("*").alias("probes")
    )

    block = Window.partitionBy(*keys, "block")
    # facts sort before the probes of the same time, in both directions
    upto = block.orderBy("position", "side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    onward = block.orderBy(F.desc("position"), "side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tail = side == _TAIL
    swept = merged.select(
        *keys,
        "position",
        "side",
        "probes",
        *[COMBINE[how](name).over(upto).alias(f"{name}_head") for name, (_, how) in measures.items()],
        *[COMBINE[how](name).over(onward).alias(f"{name}_tail") for name, (_, how) in measures.items()],
    )
    probe_time = F.when(tail, F.col("position") - start).otherwise(F.col("position") - (start + width - 1))
    parts = swept.filter(side != _FACT).select(
        *keys,
        probe_time.alias(at),
        "probes",
        *[F.when(tail, F.col(f"{m}_tail")).otherwise(F.col(f"{m}_head")).alias(m) for m in measures],
    )
    found = reduce(lambda a, b: a | b, [F.col(m).isNotNull() for m in measures])
    return (
        parts.filter(found)
        .groupBy(*keys, at)
        .agg(*[COMBINE[how](name).alias(name) for name, (_, how) in measures.items()], F.max("probes").alias("probes"))
    )
