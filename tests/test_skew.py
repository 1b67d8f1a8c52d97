"""Hot keys: exact results, and no task that holds the hot group."""

import pytest
from pyspark.sql import functions as F

from logwarden.operators.numbering import number_within
from logwarden.operators.skew import join_facts


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


def hot_rows(spark, n=3000):
    """Two thirds of the rows on key 'hot', some without key, the rest spread thin."""
    key = (
        F.when(F.col("id") % 3 != 0, "hot")
        .when(F.col("id") % 12 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.pmod("id", F.lit(90)).cast("string")))
    )
    return spark.range(n).select(F.col("id").alias("pos"), key.alias("key"))


def facts_of(rows, absent="k3"):
    known = rows.filter(F.col("key").isNotNull() & (F.col("key") != absent)).select("key").distinct()
    return known.withColumn("fact", F.concat(F.lit("f-"), "key"))


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("counted", [True, False])
@pytest.mark.parametrize("absent", ["k3", "hot"])
@pytest.mark.parametrize("hot_at", [100, 10**9])
def test_join_equals_plain_join(spark, no_broadcast, how, counted, absent, hot_at):
    rows = hot_rows(spark)
    facts = facts_of(rows, absent)
    counts = rows.groupBy("key").agg(F.count("*").alias("n")) if counted else None
    got = join_facts(rows, facts, ["key"], "pos", counts=counts, how=how, hot_rows=hot_at)
    want = rows.join(facts, "key", how).select("pos", "key", "fact")
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


@pytest.mark.parametrize("absent", ["k3", "hot"])
def test_hot_rows_are_spread(spark, no_broadcast, absent):
    rows = hot_rows(spark, 20_000)
    got = join_facts(rows, facts_of(rows, absent), ["key"], "pos", how="left", hot_rows=1000)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        # the fact is read, so that the join cannot be left out
        read = got.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.count("fact").alias("facts"))
        sizes = [r["n"] for r in read.collect()]
        plan = read._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 20_000
    # two thirds of the rows have the same key, yet no partition has much more than its part
    assert max(sizes) < 1.3 * 20_000 / 4
    assert "hashpartitioning(_place" in plan


def test_numbers_run_through_a_hot_group(spark):
    rows = spark.range(1000).select(
        F.when(F.col("id") % 10 < 9, "hot").otherwise("cold").alias("g"),
        ((F.col("id") * 7919) % 1000).alias("order"),
    )
    got = number_within(rows.repartition(8), "g", ["order"]).collect()
    by_group = {}
    for r in got:
        by_group.setdefault(r.g, []).append((r.order, r.number))
    for numbered in by_group.values():
        assert [n for _, n in sorted(numbered)] == list(range(1, len(numbered) + 1))
