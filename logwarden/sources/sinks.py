"""Result files. Every sink writes a folder of part files; sorted results stay sorted across them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logwarden.functions import timestamps as t
from logwarden.operators import report as r
from logwarden.operators import rollups
from logwarden.operators.threat import csv_rows, not_yet_written
from logwarden.session import stored
from logwarden.sources.alerts import TIMELINE_JSON
from logwarden.sources.ip_lists import read_blocklist


def write_summary_csv(summary: DataFrame, path: str) -> bool:
    """Replace the summary file with all rows, never filtered. Writes nothing for an empty summary."""
    rows = csv_rows(summary)
    if summary.isEmpty():
        return False
    rows.write.mode("overwrite").option("header", True).csv(path)
    return True


def append_blocklist(candidates: DataFrame, path: str) -> None:
    """Append the addresses that are not in the list yet; written addresses stay for good.

    Running it again with the same candidates adds nothing. The list is read once, for the one
    comparison of a batch job; the live summary remembers listed addresses as state instead.
    """
    fresh = stored(not_yet_written(candidates.select("ip").distinct(), read_blocklist(candidates.sparkSession, path)))
    if not fresh.isEmpty():
        fresh.write.mode("append").text(path)


def alert_json_rows(alerts: DataFrame) -> DataFrame:
    """Alerts with times as ISO text, most severe first."""
    step = lambda s: F.struct(
        s["event"].alias("event"),
        s["count"].alias("count"),
        t.iso_text(s["first_seen"]).alias("first_seen"),
        t.iso_text(s["last_seen"]).alias("last_seen"),
        t.iso_text(s["timestamp"]).alias("timestamp"),
        s["ip"].alias("ip"),
        s["user"].alias("user"),
        s["command"].alias("command"),
    )
    columns = ["type", "severity", "ip", "user", t.iso_text(F.col("ts")).alias("timestamp"), "detail"]
    columns.append(F.transform("timeline", step).cast(TIMELINE_JSON).alias("timeline"))
    if "threat_intel" in alerts.columns:
        columns.append("threat_intel")
    return r.in_severity_order(alerts).select(*columns)


def write_alerts(alerts: DataFrame, path: str) -> None:
    """JSON lines; fields that are null are left out."""
    alert_json_rows(alerts).write.mode("overwrite").json(path)


def write_report_metadata(alerts: DataFrame, path: str, generated_at: datetime, tool: str = "logwarden") -> None:
    """One JSON row: when, by what, and how many alerts of each severity."""
    counts = rollups.report_metadata(alerts)
    severities = F.struct(*[F.col(s.lower()).alias(s) for s in rollups.SEVERITIES])
    counts.select(
        F.lit(generated_at.isoformat()).alias("generated_at"),
        F.lit(tool).alias("tool"),
        "total_alerts",
        severities.alias("severity_counts"),
    ).write.mode("overwrite").json(path)


def write_report(alerts: DataFrame, path: str, source: str, generated_at: datetime) -> None:
    """The incident report as ordered text parts (concatenate them by name for one file)."""
    lines = r.report_lines(alerts, source, generated_at)
    lines.orderBy(*r.ORDER).select("line").write.mode("overwrite").text(path)
