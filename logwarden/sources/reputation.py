"""Address reputations from snapshots of two services' JSON answers, one object per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logwarden.params import DEFAULTS, Params

ABUSE_JSON = """
ip string, queried_at string,
data struct<abuseConfidenceScore:int, totalReports:int, countryCode:string, isp:string,
            isWhitelisted:boolean, lastReportedAt:string>
"""

VERDICT_JSON = """
ip string, queried_at string,
data struct<attributes:struct<
  last_analysis_stats:struct<malicious:int, harmless:int, suspicious:int>,
  total_votes:struct<malicious:int, harmless:int>,
  reputation:int>>
"""


def newest(answers: DataFrame, name: str, value: Column) -> DataFrame:
    """``ip`` and ``value`` of its latest answer, one row per address; answers without address are left out."""
    rows = answers.filter("ip is not null").select("ip", F.struct("queried_at", value.alias(name)).alias("answer"))
    return rows.groupBy("ip").agg(F.max("answer").alias("answer")).select("ip", F.col(f"answer.{name}").alias(name))


def abuse_dim(answers: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """``ip`` and the struct ``abuse``; missing fields get their defaults."""
    d = lambda field: F.col(f"data.{field}")
    score = F.coalesce(d("abuseConfidenceScore"), F.lit(0))
    abuse = F.struct(
        score.alias("abuse_confidence_score"),
        F.coalesce(d("totalReports"), F.lit(0)).alias("total_reports"),
        F.coalesce(d("countryCode"), F.lit("Unknown")).alias("country_code"),
        F.coalesce(d("isp"), F.lit("Unknown")).alias("isp"),
        F.coalesce(d("isWhitelisted"), F.lit(False)).alias("is_whitelisted"),
        (score >= params.malicious_score).alias("is_malicious"),
        d("lastReportedAt").alias("last_reported_at"),
        F.col("queried_at").alias("queried_at"),
    )
    return newest(answers, "abuse", abuse)


def verdict_dim(answers: DataFrame) -> DataFrame:
    """``ip`` and the struct ``verdict``: engine detections and community votes."""

    def a(field):
        return F.coalesce(F.col(f"data.attributes.{field}"), F.lit(0))

    verdict = F.struct(
        (a("last_analysis_stats.malicious") + a("last_analysis_stats.suspicious")).alias("malicious_detections"),
        a("reputation").alias("reputation"),
        (a("total_votes.malicious") - a("total_votes.harmless")).alias("community_score"),
        F.col("queried_at").alias("queried_at"),
    )
    return newest(answers, "verdict", verdict)


def read_abuse(spark: SparkSession, path: str, params: Params = DEFAULTS) -> DataFrame:
    return abuse_dim(spark.read.schema(ABUSE_JSON).json(path), params)


def read_verdicts(spark: SparkSession, path: str) -> DataFrame:
    return verdict_dim(spark.read.schema(VERDICT_JSON).json(path))
