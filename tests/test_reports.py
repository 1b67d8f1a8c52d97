"""Enrichment, stored alerts, the incident report, dashboards."""

import glob
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from test_detections import SAMPLE

from logwarden.operators import report as r
from logwarden.operators import rollups
from logwarden.operators.detections import all_alerts
from logwarden.operators.enrich import enrich, public_addresses
from logwarden.plans import detections as plan
from logwarden.plans.dashboard import dashboard_of
from logwarden.session import durable
from logwarden.sources.alerts import read_alerts
from logwarden.sources.reputation import read_abuse, read_verdicts

NOW = datetime(2026, 5, 26, 12, 5, 0)


@pytest.fixture(scope="module")
def alerts(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("sample") / "auth.log"
    path.write_text("\n".join(SAMPLE) + "\n")
    return durable(all_alerts(plan.event_table(spark, str(path), 2026)))


@pytest.fixture
def sources(spark, tmp_path):
    abuse = [
        {"ip": "77.88.55.66", "data": {"abuseConfidenceScore": 92, "totalReports": 7, "countryCode": "RU", "isp": "X"}},
        {"ip": "103.25.59.88", "data": {"abuseConfidenceScore": 75}},
        {"ip": "10.0.0.55", "data": {"abuseConfidenceScore": 100}},  # private: never looked at
    ]
    verdicts = [
        {"ip": "77.88.55.66", "data": {"attributes": {"last_analysis_stats": {"malicious": 3, "suspicious": 1}, "total_votes": {"malicious": 2, "harmless": 5}, "reputation": -8}}},
        {"ip": "92.118.160.22", "data": {"attributes": {}}},
    ]
    (tmp_path / "abuse.json").write_text("\n".join(map(json.dumps, abuse)))
    (tmp_path / "verdicts.json").write_text("\n".join(map(json.dumps, verdicts)))
    return read_abuse(spark, str(tmp_path / "abuse.json")), read_verdicts(spark, str(tmp_path / "verdicts.json"))


def test_enrichment(alerts, sources):
    before = {(a.detector, a.pos): a for a in alerts.collect()}
    rows = enrich(alerts, *sources).collect()
    assert len(rows) == len(before) == 17
    by_ip = {}
    for a in rows:
        by_ip.setdefault(a.ip, []).append(a)
    for a in by_ip["77.88.55.66"]:
        old = before[a.detector, a.pos]
        assert a.severity == {"MEDIUM": "HIGH", "HIGH": "CRITICAL", "CRITICAL": "CRITICAL"}[old.severity]
        assert a.detail == (
            old.detail + " | AbuseIPDB: 92% confidence malicious (7 report(s), RU)."
            " | VirusTotal: 4 engines flagged, reputation -8, community -3."
        )
    for a in by_ip["103.25.59.88"]:
        assert a.severity == before[a.detector, a.pos].severity
        assert a.detail.endswith(" | AbuseIPDB: 75% confidence malicious (0 report(s), Unknown).")
        assert a.threat_intel.virustotal is None and a.threat_intel.abuseipdb.is_malicious
    assert [a.detail == before[a.detector, a.pos].detail for a in by_ip["92.118.160.22"]] == [True]
    assert by_ip["10.0.0.55"][0].threat_intel.abuseipdb is None
    assert all(a.threat_intel is not None for a in by_ip["localhost"])


def test_enrichment_by_shuffle_join(spark, alerts, sources):
    expected = sorted(enrich(alerts, *sources).collect(), key=str)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(enrich(alerts, *sources).collect(), key=str) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_source(alerts):
    assert {a.threat_intel for a in enrich(alerts).collect()} == {None}


def test_public_addresses(alerts):
    got = {a.ip for a in public_addresses(alerts).collect()}
    assert got == {"185.72.33.10", "92.118.160.22", "45.33.32.156", "103.25.59.88", "77.88.55.66"}


def report(alerts):
    lines = r.report_lines(alerts, "/var/log/auth.log", NOW)
    return [row.line for row in lines.orderBy(*r.ORDER).collect()]


def test_report_text(alerts):
    lines = report(alerts)
    at = lines.index("-- EXECUTIVE SUMMARY " + "-" * 56)
    assert lines[:at] == [
        "=" * 78,
        "                 ENTERPRISE SOC INCIDENT REPORT",
        "=" * 78,
        "  Incident ID     : INC-20260526-120500",
        "  Generated At    : 2026-05-26 12:05:00",
        "  Log Source      : /var/log/auth.log",
        "  Overall Severity: CRITICAL",
        "  Analyst         : [L1 SOC Analyst]",
        "  Status          : Open — Pending L2 Review",
        "=" * 78,
        "",
    ]
    assert lines[at + 1 : at + 24] == [
        "  Total Alerts   : 17",
        "  CRITICAL       : 3",
        "  HIGH           : 9",
        "  MEDIUM         : 5",
        "  LOW            : 0",
        "  Unique IPs     : 7",
        "",
        "  Alert Types Detected:",
        "    - FAILED_LOGIN_BURST             5 alert(s)",
        "    - PRIVILEGE_ESCALATION           4 alert(s)",
        "    - OFF_HOURS_LOGIN                3 alert(s)",
        "    - BRUTEFORCE_SUCCESS             3 alert(s)",
        "    - UNKNOWN_USER_LOGIN             1 alert(s)",
        "    - ACCOUNT_COMPROMISE             1 alert(s)",
        "",
        "-- FLAGGED IP ADDRESSES " + "-" * 51,
        "  10.0.0.55            HIGH:1",
        "  103.25.59.88         MEDIUM:1  HIGH:1",
        "  185.72.33.10         MEDIUM:1  CRITICAL:1  HIGH:1",
        "  203.0.113.45         HIGH:1",
        "  45.33.32.156         MEDIUM:1",
        "  77.88.55.66          CRITICAL:2  MEDIUM:1  HIGH:1",
        "  92.118.160.22        MEDIUM:1",
    ]
    at = lines.index("-- ALERT DETAILS " + "-" * 60)
    assert lines[at + 1 : at + 18] == [
        "",
        "  [CRIT] CRITICAL (3 alert(s))",
        "  " + "-" * 72,
        "  [1] Incident ID    : INC-20260526-120500-C001",
        "      Severity       : CRITICAL",
        "      Detection Type : OFF_HOURS_LOGIN",
        "      MITRE ATT&CK   : T1078 - Valid Accounts",
        "      Source IP      : 185.72.33.10",
        "      Username       : root",
        "      Timestamp      : 2026-05-26T02:13:13",
        "      Threat Intel  : N/A",
        "      Analyst Notes  : Successful login by 'root' from 185.72.33.10 at 02:13:13 — late night (22:00–06:00). Investigate whether this is an authorized session.",
        "      Recommended Actions:",
        "        - Validate off-hours access with account owners.",
        "        - Confirm change windows or approved maintenance.",
        "        - Enable MFA if not already in place.",
        "",
    ]
    heads = [x for x in lines if x.startswith(("  [CRIT]", "  [HIGH]", "  [ MED]", "  [ LOW]"))]
    assert heads == ["  [CRIT] CRITICAL (3 alert(s))", "  [HIGH] HIGH (9 alert(s))", "  [ MED] MEDIUM (5 alert(s))"]
    ids = [x.split(": ")[1] for x in lines if "] Incident ID    :" in x]
    assert len(ids) == len(set(ids)) == 17 and ids[3] == "INC-20260526-120500-H001"
    at = lines.index("-- RECOMMENDED ACTIONS (SUMMARY) " + "-" * 42)
    assert [x[:12] for x in lines[at + 1 : at + 9]] == ["  [CRITICAL]"] * 2 + ["  [ACTION]  "] * 6
    assert lines[-3:] == ["=" * 78, "  Report generated by logwarden", "=" * 78]


def test_report_with_reputation(alerts, sources):
    lines = report(enrich(alerts, *sources))
    assert lines.count("      Threat Intel  : AbuseIPDB Score 92%, Country RU, ISP X, Malicious Yes") == 4
    assert lines.count("      Threat Intel  : VirusTotal Malicious 4, Reputation -8, Community -3") == 4
    assert lines.count("      Threat Intel  : VirusTotal Malicious 0, Reputation 0, Community 0") == 1
    assert lines.count("      Threat Intel  : N/A") == 10


def test_report_without_alerts(alerts):
    lines = report(alerts.limit(0))
    assert "  Overall Severity: LOW" in lines and "  Total Alerts   : 0" in lines
    assert not any("FLAGGED" in x for x in lines)


def test_written_outputs(spark, alerts, sources, tmp_path):
    enriched = enrich(alerts, *sources)
    paths = plan.write_reports(enriched, "/var/log/auth.log", str(tmp_path), NOW)
    rows = [json.loads(x) for f in sorted(glob.glob(f"{paths.alerts}/part-*")) for x in open(f)]
    ranks = ["CRITICAL", "HIGH", "MEDIUM", "LOW"]
    assert [ranks.index(x["severity"]) for x in rows] == sorted(ranks.index(x["severity"]) for x in rows)
    chain = next(x for x in rows if x["type"] == "ACCOUNT_COMPROMISE")
    assert chain["timeline"] == [
        {"event": "FAILED_LOGIN_BURST", "count": 5, "first_seen": "2026-05-26T23:58:01", "last_seen": "2026-05-26T23:58:09"},
        {"event": "LOGIN_SUCCESS", "timestamp": "2026-05-26T23:58:11", "ip": "77.88.55.66", "user": "root"},
        {"event": "PRIVILEGE_ESCALATION", "timestamp": "2026-05-26T23:59:00", "command": "/bin/bash"},
    ]
    meta = [json.loads(x) for f in glob.glob(f"{paths.metadata}/part-*") for x in open(f)]
    assert len(meta) == 1 and meta[0]["total_alerts"] == 17
    assert sum(meta[0]["severity_counts"].values()) == 17 and meta[0]["severity_counts"]["LOW"] == 0
    text = "".join(open(f).read() for f in sorted(glob.glob(f"{paths.report}/part-*"))).splitlines()
    assert text == report(enriched)

    boards = dashboard_of(spark, paths.alerts)
    assert boards["totals"].first().total_alerts == 17
    assert boards["unique_ips"].first().all_ips == 8
    assert [(x.ip, x["count"]) for x in boards["top_ips"].limit(2).collect()] == [("77.88.55.66", 4), ("localhost", 4)]
    assert boards["timeline"].agg(F.sum("count")).first()[0] == 17
    assert [(x.technique_id, x["count"]) for x in boards["techniques"].collect()] == [("N/A", 5), ("T1078", 5), ("T1548", 4), ("T1110", 3)]


def test_document_with_bad_time(spark, tmp_path):
    doc = {"report_metadata": {"total_alerts": 2}, "alerts": [
        {"type": "OFF_HOURS_LOGIN", "severity": "HIGH", "ip": "1.2.3.4", "user": "x", "timestamp": "2026-05-26T08:15:10", "detail": "d"},
        {"type": "OFF_HOURS_LOGIN", "severity": "HIGH", "ip": "1.2.3.4", "user": "x", "timestamp": "never", "detail": "d", "threat_intel": None},
    ]}
    path = tmp_path / "alerts.json"
    path.write_text(json.dumps(doc, indent=2))
    rows = read_alerts(spark, str(path), document=True)
    assert sorted(str(x.ts) for x in rows.collect()) == ["2026-05-26 08:15:10", "None"]
    assert [x["count"] for x in rollups.hourly_timeline(rows).collect()] == [1]


def test_console(alerts):
    summary = plan.console_summary(alerts)
    lines = [x.line for x in summary["alerts"].collect()]
    assert lines[0] == "  [CRITICAL]  2026-05-26 02:13:13  OFF_HOURS_LOGIN            MITRE: T1078   IP: 185.72.33.10  USER: root"
    assert summary["unique_ips"].first().attacker_ips == 7 and summary["totals"].first().total_alerts == 17


def test_report_reads_alerts_twice(alerts):
    plan = r.report_lines(alerts, "/var/log/auth.log", NOW)._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    reads = [leaves.apply(i).toString() for i in range(leaves.size())]
    # the groups, stored before, are the other pass
    assert sum("_row#" in read for read in reads) == 1
