"""Batch job from log text to the per-address threat summary."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from logwarden.operators import threat
from logwarden.operators.attempts import scan_once, with_format_name
from logwarden.operators.formats import AsOf
from logwarden.params import DEFAULTS, Params
from logwarden.session import stored
from logwarden.sources.ip_lists import read_whitelist
from logwarden.sources.lines import list_files, read_lines
from logwarden.sources.sinks import append_blocklist, write_summary_csv


def today() -> AsOf:
    now = date.today()
    return AsOf(now.year, now.month)


@dataclass(frozen=True)
class ThreatSummary:
    """Results as DataFrames over stored attempts and counters; the text is read once."""

    stats: DataFrame
    attempts: DataFrame
    summary: DataFrame
    coverage: DataFrame
    footer: DataFrame
    top: DataFrame
    breakdown: DataFrame
    top_invalid_user: DataFrame
    top_accepted: DataFrame


def summarize(
    spark: SparkSession,
    log_path: str,
    as_of: AsOf | None = None,
    format: str | None = None,
    whitelist_path: str | None = None,
    csv_path: str | None = None,
    blocklist_path: str | None = None,
    params: Params = DEFAULTS,
) -> ThreatSummary:
    """Parse, aggregate, classify; write the summary file and the blocklist where asked."""
    lines = read_lines(spark, log_path, undecodable="drop")
    scan = scan_once(lines, as_of or today(), format, files=list_files(spark, log_path))
    stats, found = with_format_name(scan.stats), scan.attempts
    whitelist = read_whitelist(spark, whitelist_path)
    # one row per address: small against the lines, read by all outputs
    summary = stored(threat.ip_summary(found, params))
    marked = threat.mark_blocked(summary, whitelist, params) if blocklist_path else summary
    if csv_path:
        write_summary_csv(marked, csv_path)
    if blocklist_path:
        append_blocklist(threat.blocklist_candidates(summary, whitelist, params), blocklist_path)
    return ThreatSummary(
        stats=stats,
        attempts=found,
        summary=threat.in_threat_order(marked),
        coverage=threat.coverage(found, stats),
        footer=threat.summary_footer(summary, whitelist, params),
        top=threat.top_threats(marked, params),
        breakdown=threat.breakdown(found, summary, params),
        top_invalid_user=threat.top_invalid_user(found, params),
        top_accepted=threat.top_accepted(found, params),
    )
