"""Threat summary per source address from authentication attempts.

Input: ``pos, ip, username, ts_us, tz_offset_min, success, event`` (see ``attempts``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logwarden.functions import timestamps as t
from logwarden.functions.addresses import is_local_or_private
from logwarden.functions.severity import at_least, classify_threat, recommended_action, severity_rank
from logwarden.functions.text import csv_guard, two_decimals, with_thousands
from logwarden.params import DEFAULTS, Params

# Header of the summary file.
CSV_COLUMNS = (
    "IP",
    "Attempts",
    "Attack_Rate",
    "Severity",
    "Action",
    "Duration",
    "Window_Start",
    "Window_End",
)


def ip_user_failures(attempts: DataFrame) -> DataFrame:
    """``ip, username, attempts, first_pos``: failed attempts per address and account."""
    return (
        attempts.filter(~F.col("success"))
        .groupBy("ip", "username")
        .agg(F.count("*").alias("attempts"), F.min("pos").alias("first_pos"))
    )


def ip_totals(attempts: DataFrame) -> DataFrame:
    """Failures and time span per address, in one hash aggregate with map-side combine.

    Only failures count, but accepted logins widen the time span and fix the address's
    place in the log.
    """
    aggregates = [
        F.count_if(~F.col("success")).alias("attempts"),
        F.count("*").alias("seen"),
        F.min("ts_us").alias("first_us"),
        F.max("ts_us").alias("last_us"),
        F.min_by("tz_offset_min", "ts_us").alias("first_offset"),
        F.max_by("tz_offset_min", "ts_us").alias("last_offset"),
    ]
    if "pos" in attempts.columns:
        aggregates.append(F.min("pos").alias("first_pos"))
    return attempts.groupBy("ip").agg(*aggregates)


def attack_rate(failures: Column, duration_us: Column) -> Column:
    """Failures per minute; spans under a minute count as one."""
    return failures / F.greatest(duration_us / F.lit(float(t.MINUTE_US)), F.lit(1.0))


def classify(totals: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Rate, severity and action for per-address totals; addresses without failure drop out."""
    rated = totals.filter(F.col("attempts") > 0).withColumn("duration_us", F.col("last_us") - F.col("first_us"))
    rated = rated.withColumn("attack_rate", attack_rate(F.col("attempts"), F.col("duration_us")))
    severity = classify_threat(F.col("attempts"), F.col("attack_rate"), F.col("duration_us"), params)
    return rated.withColumn("severity", severity).withColumns(
        {
            "severity_rank": severity_rank(F.col("severity")),
            "action": recommended_action(F.col("severity")),
        }
    )


def ip_summary(attempts: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    return classify(ip_totals(attempts), params)


def blocklist_candidates(
    summary: DataFrame, whitelist: DataFrame | None = None, params: Params = DEFAULTS
) -> DataFrame:
    """Addresses to block: severe enough, not whitelisted, neither loopback nor private."""
    severe = summary.filter(
        at_least(F.col("severity"), params.blocklist_threshold) & ~is_local_or_private(F.col("ip"))
    )
    return severe if whitelist is None else severe.join(whitelist.select("ip"), "ip", "left_anti")


def mark_blocked(
    summary: DataFrame, whitelist: DataFrame | None = None, params: Params = DEFAULTS
) -> DataFrame:
    """Action ``BLOCKED`` for the addresses that the blocklist export covers."""
    blocked = at_least(F.col("severity"), params.blocklist_threshold) & ~is_local_or_private(F.col("ip"))
    if whitelist is not None:
        listed = whitelist.select("ip").distinct().withColumn("_listed", F.lit(True))
        summary = summary.join(listed, "ip", "left")
        blocked = blocked & F.col("_listed").isNull()
    action = F.when(blocked, "BLOCKED").otherwise(F.col("action"))
    return summary.withColumn("action", action).drop("_listed")


def not_yet_written(candidates: DataFrame, written: DataFrame) -> DataFrame:
    return candidates.join(written.select("ip"), "ip", "left_anti")


def in_threat_order(summary: DataFrame) -> DataFrame:
    """Most severe first, then most attempts; ties by first appearance in the log."""
    return summary.orderBy("severity_rank", F.desc("attempts"), "first_pos")


def severity_filter(summary: DataFrame, threshold: str | None) -> DataFrame:
    return summary if threshold is None else summary.filter(at_least(F.col("severity"), threshold))


def top_threats(summary: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """The first ``summary_limit`` rows of the filtered table, and how many remain."""
    shown = severity_filter(summary, params.filter_severity)
    total = shown.agg(F.count("*")).scalar()
    top = in_threat_order(shown).limit(params.summary_limit)
    return top.withColumn("remaining", F.greatest(total - params.summary_limit, F.lit(0)))


def threat_ranks(summary: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` addresses in threat order, numbered from 1 (so few that one task will do)."""
    top = in_threat_order(summary).limit(limit)
    order = Window.orderBy("severity_rank", F.desc("attempts"), "first_pos")
    return top.withColumn("rank", F.row_number().over(order))


def breakdown(attempts: DataFrame, summary: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Targeted accounts of the top addresses: one row per rank and account.

    Ranks count all addresses; the severity filter applies afterwards, so fewer than
    ``verbose_limit`` may remain. Accounts order by ``first_pos``.
    """
    top = severity_filter(threat_ranks(summary, params.verbose_limit), params.filter_severity)
    top = top.select("ip", "rank", "severity", F.col("attempts").alias("total_attempts"), "attack_rate", "duration_us")
    # at most verbose_limit rows
    return ip_user_failures(attempts).join(F.broadcast(top), "ip")


def summary_footer(
    summary: DataFrame, whitelist: DataFrame | None = None, params: Params = DEFAULTS
) -> DataFrame:
    """One row: addresses shown, hidden by the filter, suspicious, and to be blocked."""
    shown = F.lit(True) if params.filter_severity is None else at_least(F.col("severity"), params.filter_severity)
    marked = mark_blocked(summary, whitelist, params)
    return marked.agg(
        F.count_if(shown).alias("shown"),
        F.count_if(~shown).alias("hidden"),
        F.count_if(shown & (F.col("severity") != "LOW")).alias("suspicious"),
        F.count_if(F.col("action") == "BLOCKED").alias("blocked"),
    )


def coverage(attempts: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """One row: addresses, attempts and the time covered.

    Parser statistics (first and last time in line order) take precedence over the
    extremes of the attempts, as long as both are known.
    """
    found = attempts.agg(
        F.count_distinct("ip").alias("ips"),
        F.count("*").alias("attempts"),
        F.min("ts_us").alias("first_us"),
        F.max("ts_us").alias("last_us"),
    )
    if stats is not None:
        read = stats.agg(F.struct(F.min("first_us").alias("first"), F.max("last_us").alias("last")))
        found = found.withColumn("_read", read.scalar())
        known = F.col("_read.first").isNotNull() & F.col("_read.last").isNotNull()
        found = found.withColumns(
            {
                "first_us": F.when(known, F.col("_read.first")).otherwise(F.col("first_us")),
                "last_us": F.when(known, F.col("_read.last")).otherwise(F.col("last_us")),
            }
        ).drop("_read")
    return found.withColumn("duration_us", F.col("last_us") - F.col("first_us"))


def coverage_text(covered: DataFrame) -> DataFrame:
    """``line_no, line``: the time covered and what was parsed, for people to read."""
    clock = lambda c: F.substring(t.from_micros(F.col(c)).cast("string"), 1, 19)
    window = F.concat(F.lit("Window: "), clock("first_us"), F.lit(" to "), clock("last_us"), F.lit(" ("), t.duration_text(F.col("duration_us")), F.lit(")"))
    parsed = F.concat(F.lit("Parsed IPs: "), with_thousands(F.col("ips")), F.lit(" | Attempts: "), with_thousands(F.col("attempts")))
    lines = F.when(F.col("first_us").isNull(), F.array(F.lit("No parsed attempts found."))).otherwise(F.array(window, parsed))
    return covered.select(F.posexplode(lines).alias("line_no", "line"))


def _top_addresses(rows: DataFrame, limit: int) -> DataFrame:
    counted = rows.groupBy("ip").agg(F.count("*").alias("events"), F.min("pos").alias("first_pos"))
    return counted.orderBy(F.desc("events"), "first_pos").limit(limit)


def top_invalid_user(attempts: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Addresses with most attempts on accounts that do not exist."""
    return _top_addresses(attempts.filter(F.col("event") == "invalid_user"), max(1, params.summary_limit // 2))


def top_accepted(attempts: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Addresses with most accepted logins, by any method."""
    return _top_addresses(attempts.filter(F.col("success")), max(1, params.summary_limit // 2))


def _instant_text(us: Column, offset: Column) -> Column:
    wall = t.from_micros(us + F.coalesce(offset, F.lit(0)).cast("bigint") * t.MINUTE_US)
    return F.concat(t.iso_text(wall), t.offset_text(offset))


def csv_rows(summary: DataFrame) -> DataFrame:
    """The summary as text columns, safe to open in a spreadsheet, in threat order."""
    values = (
        F.col("ip"),
        F.col("attempts").cast("string"),
        two_decimals(F.col("attack_rate")),
        F.col("severity"),
        F.col("action"),
        t.duration_text(F.col("duration_us")),
        _instant_text(F.col("first_us"), F.col("first_offset")),
        _instant_text(F.col("last_us"), F.col("last_offset")),
    )
    ordered = in_threat_order(summary) if "first_pos" in summary.columns else summary.orderBy(
        "severity_rank", F.desc("attempts"), "ip"
    )
    return ordered.select(*[csv_guard(v).alias(name) for name, v in zip(CSV_COLUMNS, values)])
