"""Stored alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logwarden.functions import timestamps as t
from logwarden.operators.enrich import ABUSE, VERDICT

TIMELINE_JSON = (
    "array<struct<event:string,count:bigint,first_seen:string,last_seen:string,"
    "timestamp:string,ip:string,user:string,command:string>>"
)
ALERT_JSON = (
    "type string, severity string, ip string, user string, timestamp string, detail string, "
    f"timeline {TIMELINE_JSON}, threat_intel struct<abuseipdb:{ABUSE},virustotal:{VERDICT}>"
)


def typed_alerts(rows: DataFrame) -> DataFrame:
    """Add ``ts`` and ``ts_us`` to alerts with a text ``timestamp``; bad times become null."""
    ts = F.col("timestamp").try_cast("timestamp_ntz")
    return rows.withColumn("ts", ts).withColumn("ts_us", t.micros_of(F.col("ts"))).drop("timestamp")


def read_alerts(spark: SparkSession, path: str, document: bool = False) -> DataFrame:
    """Alerts from JSON lines, or from one JSON document with an ``alerts`` array.

    A document is read by one task; large exports should be JSON lines.
    """
    if not document:
        return typed_alerts(spark.read.schema(ALERT_JSON).json(path))
    fields = ", ".join(part.replace(" ", ":", 1) for part in ALERT_JSON.split(", "))
    payload = spark.read.schema(f"alerts array<struct<{fields}>>").json(path, multiLine=True)
    return typed_alerts(payload.select(F.explode("alerts").alias("a")).select("a.*"))
