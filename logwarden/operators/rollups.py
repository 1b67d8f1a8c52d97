"""Counts over alerts for reports and dashboards.

Input: alerts as returned by ``all_alerts``, enriched or not. Every rollup combines on the
map side, so a hot address or type costs no more than a cold one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.functions import timestamps as t
from logwarden.functions.lookups import technique_id, technique_name
from logwarden.functions.severity import SEVERITIES, severity_name, severity_rank
from logwarden.operators.detections import LOCALHOST


def severity_counts(alerts: DataFrame) -> DataFrame:
    """``severity, severity_rank, count`` for all four severities, zeros included."""
    return severity_rows(alerts.agg(*severity_totals()))


def severity_totals() -> list[Column]:
    """Aggregates: the number of alerts of each severity."""
    return [F.count_if(F.col("severity") == s).alias(s) for s in SEVERITIES]


def severity_rows(counts: DataFrame) -> DataFrame:
    """One row per severity from one row with ``severity_totals``."""
    rows = F.array(
        *[F.struct(F.lit(s).alias("severity"), F.lit(i).alias("severity_rank"), F.col(s).alias("count"))
          for i, s in enumerate(SEVERITIES)]
    )
    return counts.select(F.inline(rows))


def type_counts(alerts: DataFrame) -> DataFrame:
    """``type, count``, most frequent first; ties by first alert.

    A detector yields one type, so (time, detector) decides which type came first.
    """
    counted = alerts.groupBy("type").agg(
        F.count("*").alias("count"), F.min("ts_us").alias("first_us"), F.min("detector").alias("detector")
    )
    return counted.orderBy(F.desc("count"), "first_us", "detector")


def unique_ips(alerts: DataFrame) -> DataFrame:
    """One row: distinct addresses without and with the host itself."""
    ip = F.col("ip")
    return alerts.agg(
        F.count_distinct(F.when(ip != LOCALHOST, ip)).alias("attacker_ips"),
        F.count_distinct(ip).alias("all_ips"),
    )


def overall_severity(alerts: DataFrame) -> DataFrame:
    """One row: the most severe severity present, LOW without alerts."""
    return alerts.agg(worst_severity())


def worst_severity() -> Column:
    """Aggregate ``overall_severity``."""
    return severity_name(F.min(severity_rank(F.col("severity")))).alias("overall_severity")


def alert_groups(alerts: DataFrame) -> DataFrame:
    """Alerts per type and per address and severity, from one pass: ``type, ip, severity, n, first``.

    Rows of a type have neither address nor severity. ``first`` is the place of the first
    alert in the report: time, detector and position, packed into one number, which a hash
    aggregate can keep in place.
    """
    start = (F.col("ts_us") * 10 + F.col("detector")).cast("decimal(18,0)") * F.lit(str(_POSITIONS)).cast("decimal(20,0)")
    first = F.min((start + F.col("pos")).cast("decimal(38,0)")).alias("first")
    sets = [[F.col("type")], [F.col("ip"), F.col("severity")]]
    grouped = alerts.groupingSets(sets, "type", "ip", "severity").agg(F.grouping("type").alias("by_ip"), F.count("*").alias("n"), first)
    return grouped.select("type", "ip", "severity", (F.col("by_ip") == 1).alias("by_ip"), "n", "first")


_POSITIONS = 10**19


def flagged_ips(alerts: DataFrame) -> DataFrame:
    """``ip``, its alerts by severity, and the display text, for all addresses but the host."""
    return flagged_of(alert_groups(alerts))


def flagged_of(groups: DataFrame) -> DataFrame:
    """``flagged_ips`` from ``alert_groups``.

    The text lists severities by count, ties by first alert; an address has four at most.
    """
    per_severity = groups.filter(F.col("by_ip") & (F.col("ip") != LOCALHOST))
    entry = F.struct((-F.col("n")).alias("order"), "first", "severity", "n")
    counts = [F.coalesce(F.sum(F.when(F.col("severity") == s, F.col("n"))), F.lit(0)).alias(s.lower()) for s in SEVERITIES]
    per_ip = per_severity.groupBy("ip").agg(*counts, F.array_sort(F.collect_list(entry)).alias("entries"))
    texts = F.transform("entries", lambda e: F.concat(e["severity"], F.lit(":"), e["n"].cast("string")))
    return per_ip.withColumn("severities", F.array_join(texts, "  ")).drop("entries")


def types_of(groups: DataFrame) -> DataFrame:
    """``type, count, start`` from ``alert_groups``; ``start`` orders types by their first alert."""
    start = F.floor(F.col("first") / F.lit(str(_POSITIONS)).cast("decimal(20,0)")).cast("bigint")
    return groups.filter(~F.col("by_ip")).select("type", F.col("n").alias("count"), start.alias("start"))


def _top(alerts: DataFrame, column: str, limit: int) -> DataFrame:
    counted = alerts.groupBy(column).agg(F.count("*").alias("count"))
    return counted.orderBy(F.desc("count"), column).limit(limit)


def top_ips(alerts: DataFrame, limit: int = 10) -> DataFrame:
    return _top(alerts, "ip", limit)


def top_users(alerts: DataFrame, limit: int = 10) -> DataFrame:
    return _top(alerts, "user", limit)


def hourly_timeline(alerts: DataFrame) -> DataFrame:
    """``hour, count``: alerts per wall-clock hour, those without time left out."""
    hours = alerts.filter(F.col("ts_us").isNotNull()).groupBy(t.floor_to(F.col("ts_us"), t.HOUR_US).alias("hour_us"))
    counted = hours.agg(F.count("*").alias("count"))
    return counted.select(t.from_micros(F.col("hour_us")).alias("hour"), "count").orderBy("hour")


def technique_rollup(alerts: DataFrame) -> DataFrame:
    """``technique_id, technique_name, count``, most frequent first."""
    per_type = alerts.groupBy("type").agg(F.count("*").alias("n"))
    named = per_type.withColumns({"technique_id": technique_id(F.col("type")), "technique_name": technique_name(F.col("type"))})
    counted = named.groupBy("technique_id", "technique_name").agg(F.sum("n").alias("count"))
    return counted.orderBy(F.desc("count"), "technique_id")


def with_technique(alerts: DataFrame) -> DataFrame:
    return alerts.withColumns(
        {"technique_id": technique_id(F.col("type")), "technique_name": technique_name(F.col("type"))}
    )


def report_metadata(alerts: DataFrame) -> DataFrame:
    """One row: total and per-severity alert counts."""
    counts = [F.count_if(F.col("severity") == s).alias(s.lower()) for s in SEVERITIES]
    return alerts.agg(F.count("*").alias("total_alerts"), *counts)
