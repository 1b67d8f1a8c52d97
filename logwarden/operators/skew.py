"""Join rows to facts of their key when one key may hold a large part of all rows.

Adaptive execution splits a skewed join only if both inputs come straight from an
exchange; the output of an aggregate, which most of our facts are, does not qualify. So
hot keys are treated explicitly: their facts are broadcast and their rows spread evenly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of one key that a single task still copes with (they are small, and sorts spill).
# Fewer than rows / HOT_ROWS keys can be hot: 100,000 keys, some 10 MB, for 10**12 rows.
HOT_ROWS = 10_000_000
_SPREAD = 1_000_000


def join_facts(
    rows: DataFrame,
    facts: DataFrame,
    keys: list[str],
    spread_by: str,
    counts: DataFrame | None = None,
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Equi-join ``rows`` to ``facts``, which has one row per key.

    A key is hot by the number of its ``rows``, whether or not there are facts for it.
    ``counts`` (the keys and ``n``) saves counting them where that is known already. Rows of
    hot keys, and rows whose key is null, get distinct partition keys from ``spread_by``, a
    column that is unique per row. ``how`` is inner or left.
    """
    values = [c for c in facts.columns if c not in keys]
    if counts is None:
        counts = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    hot = F.broadcast(counts.filter(F.col("n") >= hot_rows).select(*keys))
    packed = facts.select(*keys, F.struct(*values).alias("_packed"))
    known = packed.join(hot, keys).withColumnRenamed("_packed", "_hot")
    hot = hot.join(F.broadcast(known), keys, "left").withColumn("_is_hot", F.lit(True))

    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    scattered = F.pmod(F.xxhash64(spread_by), F.lit(_SPREAD)).cast("int") + 1
    spread = F.when(F.col("_is_hot") | no_key, scattered).otherwise(0)
    # one struct as the key: as a column of its own, the constant of the facts would be
    # folded into a filter and the rows dealt by the key alone
    cold = packed.select(F.struct(*keys, F.lit(0).alias("spread")).alias("_place"), F.col("_packed").alias("_cold"))
    joined = (
        rows.join(F.broadcast(hot), keys, "left")
        .withColumn("_place", F.struct(*keys, spread.alias("spread")))
        .join(cold, "_place", "left")
        .withColumn("_facts", F.coalesce("_hot", "_cold"))
    )
    if how == "inner":
        joined = joined.filter(F.col("_facts").isNotNull())
    return joined.select(*rows.columns, *[F.col(f"_facts.{v}").alias(v) for v in values])
