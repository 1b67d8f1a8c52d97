"""The numbers behind a dashboard over stored alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logwarden.operators import rollups
from logwarden.sources.alerts import read_alerts


def dashboard(alerts: DataFrame) -> dict[str, DataFrame]:
    return {
        "totals": rollups.report_metadata(alerts),
        "severities": rollups.severity_counts(alerts),
        "unique_ips": rollups.unique_ips(alerts).select("all_ips"),
        "top_ips": rollups.top_ips(alerts),
        "top_users": rollups.top_users(alerts),
        "timeline": rollups.hourly_timeline(alerts),
        "techniques": rollups.technique_rollup(alerts),
    }


def dashboard_of(spark: SparkSession, alerts_path: str, document: bool = False) -> dict[str, DataFrame]:
    return dashboard(read_alerts(spark, alerts_path, document))
