"""Severity order, threat classes and the scores that lead to them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Most severe first; the position is the rank.
SEVERITIES = ("CRITICAL", "HIGH", "MEDIUM", "LOW")


def parse_severity(name: str) -> str:
    """Canonical severity name; case does not matter, unknown names raise."""
    upper = str(name).upper()
    if upper not in SEVERITIES:
        raise ValueError(f"unknown severity {name!r}, expected one of {', '.join(SEVERITIES)}")
    return upper


def rank_of(name: str) -> int:
    return SEVERITIES.index(parse_severity(name))


def severity_rank(severity: Column) -> Column:
    """0 for CRITICAL up to 3 for LOW; anything else counts as LOW."""
    chain = F.when(severity == SEVERITIES[0], 0)
    for rank, name in enumerate(SEVERITIES[1:], start=1):
        chain = chain.when(severity == name, rank)
    return chain.otherwise(len(SEVERITIES) - 1)


def severity_name(rank: Column) -> Column:
    names = F.array(*[F.lit(s) for s in SEVERITIES])
    return F.coalesce(F.get(names, rank), F.lit(SEVERITIES[-1]))


def at_least(severity: Column, threshold: str) -> Column:
    """True where ``severity`` is ``threshold`` or worse."""
    return severity_rank(severity) <= rank_of(threshold)


def classify_threat(failures: Column, rate: Column, duration_us: Column, params) -> Column:
    """Threat class of one source address from its failure count, rate and time span."""
    window_us = params.micros(params.time_window_minutes)
    burst = (failures >= params.max_attempts) & (duration_us <= window_us)
    return (
        F.when(burst & (rate >= 2.0), "CRITICAL")
        .when(burst | (failures >= params.block_threshold), "HIGH")
        .when((failures >= params.monitor_threshold) | (rate > 1.0), "MEDIUM")
        .otherwise("LOW")
    )


def recommended_action(severity: Column) -> Column:
    return (
        F.when(severity.isin("CRITICAL", "HIGH"), "BLOCK")
        .when(severity == "MEDIUM", "MONITOR")
        .otherwise("ALLOW")
    )


def compromise_severity(failures: Column, sensitive: Column, off_hours: Column) -> Column:
    """Points for failures, a sensitive command and the time of day, turned into a severity."""
    points = reduce(
        lambda a, b: a + b,
        [
            F.when(failures >= 5, 2).when(failures >= 2, 1).otherwise(0),
            F.when(sensitive, 2).otherwise(0),
            F.when(off_hours, 1).otherwise(0),
        ],
    )
    return F.when(points >= 4, "CRITICAL").when(points >= 2, "HIGH").otherwise("MEDIUM")


def upgrade_severity(severity: Column, score: Column, minimum: int) -> Column:
    """One step more severe when the reputation score reaches ``minimum``."""
    one_up = severity_name(F.greatest(severity_rank(severity) - 1, F.lit(0)))
    return F.when(score >= minimum, one_up).otherwise(severity)
