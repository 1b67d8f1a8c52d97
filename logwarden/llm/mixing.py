"""Mixing sources to target weights by systematic sampling.

Every source gets a target; a document of the source is expected to be taken
target / size of the source times. Expectations are summed up in an order, one offset per
source is added, and a document is taken once for each whole number that the running sum
crosses at it. Documents are ordered by size first, so that what is taken comes near the
target in words and not only in documents.

Targets share the total by weight. Sources by code point, null last, weigh 1, 2, 3 and so on
again; a target stops at ``limit`` times its source, the excess goes to the others by weight.

How it scales: no window spans a source. Rows fall into cells (source, size band, hash of the
id); sums over cells, then bands, then sources give each cell its starting point, and only
the rows of one cell are numbered together. All sums are integers, so reruns agree.

Edge cases: documents of size 0 cost nothing and are taken like others; a source without
words has target 0 and nothing is taken. Null ids are hashed as empty text; equal rows in one
cell share its copies in any order. Columns named like the four added ones are replaced; all
other columns of the table stay as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logwarden.session import stored


ADDED = ("size", "source_size", "target", "copies")


@dataclass(frozen=True)
class Params:
    weights: tuple[int, ...] = (1, 2, 3)
    limit: int = 3
    cells: int = 4096  # per source and size band
    seed: str = "mix"
    unit: int = 1 << 24  # fixed-point representation of one copy


def band(size: Column) -> Column:
    """Size classes some six percent wide, from integers alone."""
    bits = F.length(F.bin(size + 1))
    return bits * 16 + F.call_function("shiftright", (size + 1) * 16, bits)


def hashed(text: Column, modulus: int) -> Column:
    return F.pmod(F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("bigint"), F.lit(modulus))


def targets(sizes: DataFrame, params: Params = Params()) -> DataFrame:
    """``no_source, source, source_size`` with ``target``. One row per source, so one task orders them."""
    order = W.orderBy("no_source", "source")
    weight = F.element_at(F.array(*[F.lit(w) for w in params.weights]), F.pmod(F.row_number().over(order) - 1, F.lit(len(params.weights))).cast("int") + 1)
    rows = sizes.withColumn("weight", weight.cast("bigint")).withColumn("top", params.limit * F.col("source_size"))
    # sources stop at their limit in the order of limit / weight; the rest shares what is left
    ranked = W.orderBy(F.col("top") / F.col("weight"), "no_source", "source")
    before = ranked.rowsBetween(W.unboundedPreceding, -1)
    onward = ranked.rowsBetween(0, W.unboundedFollowing)
    everything = W.partitionBy()
    rows = rows.withColumn("left", F.sum("source_size").over(everything) - F.coalesce(F.sum("top").over(before), F.lit(0)))
    rows = rows.withColumn("heft", F.sum("weight").over(onward))
    # the first source that its share doesn't bring to its limit fixes the share of all after it
    rows = rows.withColumn("open", F.col("left") * F.col("weight") <= F.col("top") * F.col("heft"))
    level = F.min(F.when(F.col("open"), F.struct((F.col("top") / F.col("weight")).alias("at"), "no_source", "source", "left", "heft"))).over(everything)
    rows = rows.withColumn("level", level)
    full = F.col("level").isNull() | (F.struct(F.col("top") / F.col("weight"), "no_source", "source") < F.struct("level.at", "level.no_source", "level.source"))
    share = (F.col("weight") * F.col("level.left")).cast("double") / F.col("level.heft")
    target = F.when(full, F.col("top").cast("double")).otherwise(share)
    return rows.select("no_source", "source", "source_size", target.alias("target"))


def mixed(docs: DataFrame, size: Column, doc_id: str = "doc_id", source: str = "source", params: Params = Params()) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``copies`` (replaced where they exist)."""
    kept = [c for c in docs.columns if c.lower() not in ADDED]
    spread = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    rows = docs.select(F.struct(*kept).alias("row"), size.cast("bigint").alias("size"), F.col(source).alias("source"), spread.alias("spread"))
    no_source = F.col("source").isNull()
    rows = rows.select(
        "row", "size", no_source.alias("no_source"), F.coalesce("source", F.lit("")).alias("source"), "spread", band(F.col("size")).alias("band"), hashed(F.col("spread"), params.cells).alias("cell")
    )
    keys = ["no_source", "source", "band", "cell"]
    counted = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.sum("size").alias("words"))
    cells = stored(counted)
    bands = cells.groupBy("no_source", "source", "band").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
    sizes = bands.groupBy("no_source", "source").agg(F.sum("words").alias("source_size"))
    aims = targets(sizes, params)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = hashed(F.concat_ws("/", F.lit(params.seed), F.col("no_source").cast("string"), F.col("source")), params.unit)
    aims = aims.withColumn("rate", F.floor(rate * params.unit)).withColumn("offset", offset)
    running = lambda *by: W.partitionBy(*by)
    earlier = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    bands = bands.select("no_source", "source", "band", earlier(running("no_source", "source").orderBy("band")).alias("in_source"))
    starts = cells.select(*keys, earlier(running("no_source", "source", "band").orderBy("cell")).alias("in_band"))
    starts = starts.join(bands, ["no_source", "source", "band"]).join(aims, ["no_source", "source"])
    starts = starts.select(*keys, (F.col("in_source") + F.col("in_band")).alias("start"), "source_size", "target", "rate", "offset")
    within = F.row_number().over(W.partitionBy(*keys).orderBy("size", "spread"))
    ranked = rows.withColumn("rank", within).join(stored(starts), keys)
    whole = lambda k: F.call_function("div", (F.col("start") + k) * F.col("rate") + F.col("offset"), F.lit(params.unit))
    copies = whole(F.col("rank")) - whole(F.col("rank") - 1)
    return ranked.select("row.*", "size", "source_size", "target", copies.cast("bigint").alias("copies"))


def emitted(docs: DataFrame) -> DataFrame:
    """Each row as often as ``copies`` says, numbered by ``copy`` (replaced where it exists)."""
    return docs.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
