"""Batch jobs from log text to alerts and reports."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logwarden.operators import rollups
from logwarden.operators.auth_events import auth_events
from logwarden.operators.detections import DETECTORS, Detector, all_alerts, in_report_order
from logwarden.operators.enrich import enrich
from logwarden.operators.report import console_rows
from logwarden.params import DEFAULTS, Params
from logwarden.session import durable, scratch, stored
from logwarden.sources.lines import read_lines
from logwarden.sources.sinks import write_alerts, write_report, write_report_metadata


def event_table(spark: SparkSession, log_path: str, year: int | None = None) -> DataFrame:
    """Parse logs once into a stored table.

    Six detectors read it. Partitioned by kind, each reads only its own rows and columns,
    where the text would be parsed again by every one of them.

    ``pos`` goes through the files in the order of their names, so a log may lie in any number
    of parts: the line numbers of a split are moved past those of all splits before it.
    """
    events = auth_events(read_lines(spark, log_path), year or date.today().year, kept=("file",))
    split, line = F.shiftright("pos", 33), F.col("pos").bitwiseAND(F.lit((1 << 33) - 1))
    events = events.withColumns({"split": split, "pos": line})
    events = stored(events, partition_by="kind")
    # one row per file and split of the scan
    splits = events.groupBy("file", "split").agg((F.max("pos") + 1).alias("n"))
    earlier = Window.orderBy("file", "split").rowsBetween(Window.unboundedPreceding, -1)
    splits = stored(splits.select("file", "split", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first")))
    placed = events.join(F.broadcast(splits), ["file", "split"])
    return placed.select((F.col("first") + F.col("pos")).alias("pos"), "kind", "ip", "user", "command", "ts", "ts_us")


def detect(
    spark: SparkSession,
    log_path: str,
    year: int | None = None,
    params: Params = DEFAULTS,
    detectors: dict[str, Detector] = DETECTORS,
) -> DataFrame:
    """All alerts of a log, in report order."""
    return in_report_order(all_alerts(event_table(spark, log_path, year), params, detectors))


@dataclass(frozen=True)
class ReportPaths:
    alerts: str
    metadata: str
    report: str


def write_reports(alerts: DataFrame, source: str, out: str, generated_at: datetime | None = None) -> ReportPaths:
    """Alerts as JSON lines, their metadata row and the incident report, under ``out``."""
    now = generated_at or datetime.now()
    paths = ReportPaths(f"{out}/alerts", f"{out}/report_metadata", f"{out}/incident_report")
    write_alerts(alerts, paths.alerts)
    write_report_metadata(alerts, paths.metadata, now)
    write_report(alerts, paths.report, source, now)
    return paths


def detect_and_report(
    spark: SparkSession,
    log_path: str,
    out: str,
    year: int | None = None,
    abuse: DataFrame | None = None,
    verdicts: DataFrame | None = None,
    params: Params = DEFAULTS,
    generated_at: datetime | None = None,
) -> ReportPaths:
    """Detect, enrich, report. The alerts are computed once and stored for the three outputs."""
    with scratch(spark):
        events = event_table(spark, log_path, year)
        alerts = durable(enrich(all_alerts(events, params), abuse, verdicts, params))
        return write_reports(alerts, log_path, out, generated_at)


def console_summary(alerts: DataFrame) -> dict[str, DataFrame]:
    """What an analyst sees first: counts, distinct attackers, and one line per alert."""
    return {
        "severities": rollups.severity_counts(alerts),
        "totals": rollups.report_metadata(alerts).select("total_alerts"),
        "unique_ips": rollups.unique_ips(alerts).select("attacker_ips"),
        "alerts": console_rows(alerts),
    }
