"""Rendezvous hashing of record keys over weighted shards.

Every shard draws a number for every key, and the highest wins: -weight / ln(u), with u in
(0, 1) from a hash of key and shard. A shard's share is its weight's, and a new shard takes
keys only into itself, since the numbers of the other shards stay the same.

Slots number the rows of a shard without gaps. They are dealt by cells (shard, hash of the
key): the counts of all cells give each cell its first slot, and only the rows of one cell
are numbered together.

Null keys are hashed as empty text, so they share a shard. Rows with equal keys share a
shard and take slots in the order of ``order``. Columns of the table stay as they are, but for
those added here.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logwarden.session import stored


@dataclass(frozen=True)
class Params:
    weights: tuple[float, ...] = (1.0,) * 16
    grown: tuple[float, ...] = (1.0,) * 17
    cells: int = 1024  # per shard
    seed: str = "shard"


def draw(key: Column, shard: int, seed: str) -> Column:
    """In (0, 1): 48 bits of a hash of key and shard."""
    text = F.concat(F.lit(f"{seed}/{shard}/"), key)
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def shard_of(key: Column, weights: tuple[float, ...], seed: str) -> Column:
    """The shard with the highest number; of equal numbers, the lowest shard."""
    scores = [F.struct((-w / F.log(draw(key, i, seed))).alias("score"), F.lit(-i).alias("shard")) for i, w in enumerate(weights) if w > 0]
    return -F.array_max(F.array(*scores))["shard"]


def sharded(rows: DataFrame, key: str, order: list[str], params: Params = Params()) -> DataFrame:
    """``rows`` with ``shard``, ``slot`` and ``grown_shard`` (replaced where they exist)."""
    kept = rows.drop("shard", "slot", "grown_shard")
    given = F.coalesce(F.col(key).cast("string"), F.lit(""))
    cell = F.pmod(F.conv(F.substring(F.md5(given.cast("binary")), 1, 8), 16, 10).cast("bigint"), F.lit(params.cells))
    placed = kept.select(
        F.struct(*kept.columns).alias("row"),
        shard_of(given, params.weights, params.seed).alias("shard"),
        shard_of(given, params.grown, params.seed).alias("grown_shard"),
        cell.alias("cell"),
    )
    cells = placed.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    before = W.partitionBy("shard").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    firsts = stored(cells.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))
    within = F.row_number().over(W.partitionBy("shard", "cell").orderBy(*[F.col(f"row.{c}") for c in (key, *order)]))
    numbered = placed.withColumn("place", within).join(firsts, ["shard", "cell"])
    return numbered.select("row.*", "shard", (F.col("first") + F.col("place") - 1).alias("slot"), "grown_shard")
