"""Alerts joined with address reputations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.functions.addresses import is_public
from logwarden.functions.severity import upgrade_severity
from logwarden.operators.detections import LOCALHOST
from logwarden.operators.skew import join_facts
from logwarden.params import DEFAULTS, Params

ABUSE = (
    "struct<abuse_confidence_score:int,total_reports:int,country_code:string,isp:string,"
    "is_whitelisted:boolean,is_malicious:boolean,last_reported_at:string,queried_at:string>"
)
VERDICT = "struct<malicious_detections:int,reputation:int,community_score:int,queried_at:string>"


def public_addresses(alerts: DataFrame) -> DataFrame:
    """Distinct public addresses of alerts: the ones worth looking up."""
    return alerts.select("ip").distinct().filter(is_public(F.col("ip")))


def abuse_note(abuse: Column, params: Params = DEFAULTS) -> Column:
    score = abuse["abuse_confidence_score"]
    note = F.concat(
        F.lit(" | AbuseIPDB: "),
        score.cast("string"),
        F.lit("% confidence malicious ("),
        abuse["total_reports"].cast("string"),
        F.lit(" report(s), "),
        abuse["country_code"],
        F.lit(")."),
    )
    return F.when(score >= params.malicious_score, note).otherwise("")


def verdict_note(verdict: Column) -> Column:
    flagged = verdict["malicious_detections"]
    note = F.concat(
        F.lit(" | VirusTotal: "),
        flagged.cast("string"),
        F.lit(" engines flagged, reputation "),
        verdict["reputation"].cast("string"),
        F.lit(", community "),
        verdict["community_score"].cast("string"),
        F.lit("."),
    )
    return F.when(flagged > 0, note).otherwise("")


def enrich(
    alerts: DataFrame,
    abuse: DataFrame | None = None,
    verdicts: DataFrame | None = None,
    params: Params = DEFAULTS,
) -> DataFrame:
    """Add ``threat_intel``, raise the severity of alerts from notorious addresses, extend ``detail``.

    Only public addresses have a reputation; alerts of all others (those about the host
    itself are often the largest group) do not take part in the join. The sources are
    joined to one row per address first, so the alerts move once at most. Without any source
    ``threat_intel`` is null; with one, unknown addresses get a struct of nulls.
    """
    intel = f"struct<abuseipdb:{ABUSE},virustotal:{VERDICT}>"
    if abuse is None and verdicts is None:
        return alerts.withColumn("threat_intel", F.lit(None).cast(intel))

    public = (F.col("ip") != LOCALHOST) & is_public(F.col("ip"))
    rows = alerts.withColumn("_key", F.when(public, F.col("ip"))).withColumn("_row", F.struct("detector", "pos"))
    rows = join_facts(rows, _reputations(abuse, verdicts), ["_key"], "_row", how="left")
    score = F.col("abuse.abuse_confidence_score")
    notes = [F.coalesce(note, F.lit("")) for note in (abuse_note(F.col("abuse"), params), verdict_note(F.col("verdict")))]
    both = F.struct(F.col("abuse").alias("abuseipdb"), F.col("verdict").alias("virustotal"))
    return rows.select(
        *[c for c in alerts.columns if c not in ("severity", "detail")],
        upgrade_severity(F.col("severity"), score, params.upgrade_score).alias("severity"),
        F.concat("detail", *notes).alias("detail"),
        both.alias("threat_intel"),
    ).select(*alerts.columns, "threat_intel")


def _reputations(abuse: DataFrame | None, verdicts: DataFrame | None) -> DataFrame:
    """``_key, abuse, verdict``: one row per address that any source knows."""
    dims = []
    for dim, name, kind in ((abuse, "abuse", ABUSE), (verdicts, "verdict", VERDICT)):
        if dim is not None:
            dims.append(dim.select(F.col("ip").alias("_key"), F.col(name).cast(kind).alias(name)))
    if len(dims) == 2:
        return dims[0].join(dims[1], "_key", "full")
    missing = ("verdict", VERDICT) if verdicts is None else ("abuse", ABUSE)
    return dims[0].withColumn(missing[0], F.lit(None).cast(missing[1]))


def intel_lines(intel: Column) -> Column:
    """Array of report lines about an alert's reputation."""
    abuse, verdict = intel["abuseipdb"], intel["virustotal"]
    text = lambda c: F.coalesce(c.cast("string"), F.lit("None"))
    head = "      Threat Intel  : "
    abuse_line = F.concat(
        F.lit(head + "AbuseIPDB Score "),
        text(abuse["abuse_confidence_score"]),
        F.lit("%, Country "),
        text(abuse["country_code"]),
        F.lit(", ISP "),
        text(abuse["isp"]),
        F.lit(", Malicious "),
        F.when(abuse["is_malicious"], "Yes").otherwise("No"),
    )
    verdict_line = F.concat(
        F.lit(head + "VirusTotal Malicious "),
        text(verdict["malicious_detections"]),
        F.lit(", Reputation "),
        text(verdict["reputation"]),
        F.lit(", Community "),
        text(verdict["community_score"]),
    )
    found = F.array_compact(
        F.array(
            F.when(abuse["abuse_confidence_score"].isNotNull(), abuse_line),
            F.when(verdict["malicious_detections"].isNotNull(), verdict_line),
        )
    )
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(head + "N/A")))


def intel_suffix(intel: Column) -> Column:
    """The reputation part of a console row; empty when nothing is known."""
    abuse, verdict = intel["abuseipdb"], intel["virustotal"]
    text = lambda c: F.coalesce(c.cast("string"), F.lit("None"))
    abuse_part = F.concat(
        F.lit("  TI: "),
        text(abuse["abuse_confidence_score"]),
        F.lit("% "),
        text(abuse["country_code"]),
        F.lit(" "),
        text(abuse["isp"]),
        F.lit(" Malicious:"),
        F.when(abuse["is_malicious"], "Yes").otherwise("No"),
    )
    verdict_part = F.concat(
        F.lit("  VT: "),
        text(verdict["malicious_detections"]),
        F.lit(" Rep:"),
        text(verdict["reputation"]),
        F.lit(" Comm:"),
        text(verdict["community_score"]),
    )
    return F.concat(
        F.when(abuse["abuse_confidence_score"].isNotNull(), abuse_part).otherwise(""),
        F.when(verdict["malicious_detections"].isNotNull(), verdict_part).otherwise(""),
    )
