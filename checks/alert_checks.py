"""Detections, enrichment, rollups and reports over the derived ``auth`` events."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import views as v
from logwarden.functions import timestamps as t
from logwarden.operators import detections as d
from logwarden.operators import enrich as e
from logwarden.operators import report as r
from logwarden.operators import rollups
from logwarden.operators.numbering import number_within
from logwarden.params import Params
from logwarden.plans.detections import detect
from logwarden.session import durable, shared_folder, stored
from logwarden.sources import reputation
from logwarden.sources.alerts import read_alerts
from logwarden.sources.sinks import write_alerts

PARAMS = Params(known_users=tuple(f"u{i}" for i in range(12)))

_KNOWN = ", ".join(f"'u{i}'" for i in range(12))
# Commands that are sensitive, said apart from the library's own list.
SENSITIVE = (
    "/bin/bash", "/bin/sh", "/bin/su", "/usr/bin/passwd", "/usr/sbin/useradd", "/usr/sbin/usermod", "/usr/bin/vi /etc/sudoers", "/bin/mount",
)
_SENSITIVE = "(" + " or ".join(f"starts_with(command, '{c}')" for c in SENSITIVE) + ")"


def _clock(seconds: str) -> str:
    return f"strftime(make_timestamp(({seconds}) * 1000000), '%H:%M:%S')"


def _iso(seconds: str) -> str:
    return f"strftime(make_timestamp(({seconds}) * 1000000), '%Y-%m-%dT%H:%M:%S')"


# failures of the same address in the 30 minutes before a login, as a plain join
_EVIDENCE = """
evidence as (
  select s.pos, s.ip, s.usr, s.ts_s, count(*) as failures, min(f.ts_s) as first_s, max(f.ts_s) as last_s
  from auth s join auth f on s.ip = f.ip and f.kind = 'failed' and f.ts_s >= s.ts_s - 1800 and f.ts_s < s.ts_s
  where s.kind = 'success' group by all having count(*) >= 2)"""

_BURSTS = """
bursts as (
  select f.ip, l.pos, l.last_s, count(*) as failures
  from auth f join (select ip, max(ts_s) as last_s, min(pos) as pos from auth where kind = 'failed' group by ip) l
    on f.ip = l.ip and f.kind = 'failed' and f.ts_s >= l.last_s - 600
  group by all)"""

_CHAINS = f"""
chains as (
  select c.*, {_SENSITIVE} as sensitive, (c.ts_s // 3600) % 24 not between 9 and 17 as off_hours
  from (select e.*, x.pos as sudo_pos, x.ts_s as sudo_s, x.command,
               row_number() over (partition by e.pos order by x.pos) as nth
        from evidence e join auth x on x.usr = e.usr and x.kind = 'sudo' and x.ts_s between e.ts_s and e.ts_s + 1800) c
  where nth = 1),
scored as (
  select *, case when points >= 4 then 'CRITICAL' when points >= 2 then 'HIGH' else 'MEDIUM' end as severity
  from (select *, case when failures >= 5 then 2 else 1 end + case when sensitive then 2 else 0 end
                  + case when off_hours then 1 else 0 end as points from chains) p)"""

_HOUR = "(ts_s // 3600) % 24"
_OFF_HOURS = f"""
select 1 as detector, pos, 'OFF_HOURS_LOGIN' as type,
  case when {_HOUR} < 6 or {_HOUR} >= 22 then 'CRITICAL' else 'HIGH' end as severity, ip, usr as "user", ts_s,
  concat('Successful login by ''', usr, ''' from ', ip, ' at ', {_clock("ts_s")}, ' — ',
         case when {_HOUR} < 6 or {_HOUR} >= 22 then 'late night (22:00–06:00)'
              else 'outside business hours (9:00–18:00)' end,
         '. Investigate whether this is an authorized session.') as detail
from auth where kind = 'success' and ({_HOUR} < 9 or {_HOUR} >= 18)"""

_BRUTEFORCE = f"""
select 2 as detector, pos, 'BRUTEFORCE_SUCCESS' as type,
  case when failures >= 10 then 'CRITICAL' when failures >= 5 then 'HIGH' else 'MEDIUM' end as severity,
  ip, usr as "user", ts_s,
  concat('IP ', ip, ' had ', failures, ' failed login attempt(s) before successfully authenticating as ''', usr,
         ''' at ', {_clock("ts_s")},
         '. This matches a credential brute-force success pattern. Escalate immediately.') as detail
from evidence"""

_ESCALATION = f"""
select 3 as detector, pos, 'PRIVILEGE_ESCALATION' as type, case when {_SENSITIVE} then 'HIGH' else 'MEDIUM' end as severity,
  'localhost' as ip, usr as "user", ts_s,
  concat('User ''', usr, ''' executed elevated command: [', command, '] at ', {_clock("ts_s")}, '. ',
         case when {_SENSITIVE} then '⚠ Sensitive command — verify authorization.' else 'Review for compliance.' end) as detail
from auth where kind = 'sudo'"""

_UNKNOWN = f"""
select 4 as detector, pos, 'UNKNOWN_USER_LOGIN' as type, 'HIGH' as severity, ip, usr as "user", ts_s,
  concat('Successful login by unrecognized user ''', usr, ''' from ', ip, ' at ', {_clock("ts_s")},
         '. Verify if this account is legitimate. Could indicate backdoor account creation.') as detail
from auth where kind = 'success' and usr not in ({_KNOWN})"""

_BURST = """
select 5 as detector, pos, 'FAILED_LOGIN_BURST' as type, 'MEDIUM' as severity, ip, '<multiple>' as "user", last_s as ts_s,
  concat(failures, ' failed logins from ', ip, ' within 10 minutes.') as detail
from bursts where failures >= 5"""

_COMPROMISE = """
select 6 as detector, pos, 'ACCOUNT_COMPROMISE' as type, severity, ip, usr as "user", sudo_s as ts_s,
  concat('Correlation detected: ', failures, ' failed login(s) from ', ip,
         ' followed by successful login and privilege escalation for ''', usr, '''.') as detail
from scored"""

_PARTS = {
    "off_hours": _OFF_HOURS,
    "bruteforce": _BRUTEFORCE,
    "escalation": _ESCALATION,
    "unknown_user": _UNKNOWN,
    "burst": _BURST,
    "compromise": _COMPROMISE,
}

_ALERTS = "alerts as (" + "\nunion all".join(_PARTS.values()) + ")"
_RANK = "case severity when 'CRITICAL' then 0 when 'HIGH' then 1 when 'MEDIUM' then 2 else 3 end"


def _with_alerts(sql: str, *more: str, views: tuple[str, ...] = ()) -> str:
    return v.duck_views(*views) + ",\n" + ",\n".join([_EVIDENCE, _BURSTS, _CHAINS, _ALERTS, *more]) + "\n" + sql


_ALERT_COLUMNS = 'detector, pos, type, severity, ip, "user", ' + _iso("ts_s") + " as at, detail"


def flat(alerts: DataFrame) -> DataFrame:
    return alerts.select(
        "detector", "pos", "type", "severity", "ip", "user", t.iso_text(F.col("ts")).alias("at"), "detail"
    )


def all_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # six detectors read the events, each its own kinds
    return d.all_alerts(stored(v.events(spark, sf_dir), partition_by="kind"), PARAMS)


def _detector(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return flat(d.DETECTORS[name](v.events(spark, sf_dir), PARAMS))

    sql = v.duck_views() + ",\n" + ",\n".join([_EVIDENCE, _BURSTS, _CHAINS])
    return run, f"{sql}\nselect {_ALERT_COLUMNS} from ({_PARTS[name]}) p"


def _of_alerts(step, sql: str, *more: str, views: tuple[str, ...] = ()):
    return lambda spark, sf_dir: step(all_alerts(spark, sf_dir)), _with_alerts(sql, *more, views=views)


def sorted_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(d.in_report_order(all_alerts(spark, sf_dir)))


def failure_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = d.suspicious_logins(v.events(spark, sf_dir), PARAMS.bruteforce_minutes)
    return found.select("pos", "ip", "user", "ts_us", "failures", "first_us", "last_us")


def last_bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.last_bursts(v.events(spark, sf_dir), PARAMS.burst_minutes)


def compromise_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The timelines of compromise alerts, one row per step."""
    found = d.account_compromises(v.events(spark, sf_dir), PARAMS)
    steps = found.select("pos", F.posexplode("timeline").alias("step", "s"))
    text = lambda c: t.iso_text(F.col(c))
    return steps.select(
        "pos", "step", F.col("s.event").alias("event"), F.col("s.count").alias("failures"),
        text("s.first_seen").alias("first_seen"), text("s.last_seen").alias("last_seen"),
        text("s.timestamp").alias("at"), F.col("s.ip").alias("ip"), F.col("s.user").alias("user"),
        F.col("s.command").alias("command"),
    )


_TIMELINE_SQL = f"""
select pos, 0 as step, 'FAILED_LOGIN_BURST' as event, failures, {_iso("first_s")} as first_seen,
  {_iso("last_s")} as last_seen, null as at, null as ip, null as "user", null as command from scored
union all
select pos, 1, 'LOGIN_SUCCESS', null, null, null, {_iso("ts_s")}, ip, usr, null from scored
union all
select pos, 2, 'PRIVILEGE_ESCALATION', null, null, null, {_iso("sudo_s")}, null, null, command from scored"""


# --- reputation ----------------------------------------------------------------------


def _octet(factor: int, modulus: int):
    return F.pmod(F.col("o") * factor, F.lit(modulus)).cast("int")


def abuse_answers(rows: DataFrame) -> DataFrame:
    """Service answers as JSON text, some fields left out, parsed with the reader's schema."""
    o = F.col("o")
    data = F.struct(
        _octet(37, 101).alias("abuseConfidenceScore"),
        F.when(o % 10 != 3, _octet(1, 50)).alias("totalReports"),
        F.when(o % 10 != 4, F.when(o % 2 == 0, "US").otherwise("RU")).alias("countryCode"),
        F.concat(F.lit("isp"), (o % 5).cast("string")).alias("isp"),
    )
    answer = F.to_json(F.struct("ip", data.alias("data")))
    return rows.select(F.from_json(answer, reputation.ABUSE_JSON).alias("a")).select("a.*")


def verdict_answers(rows: DataFrame) -> DataFrame:
    o = F.col("o")
    stats = F.struct(_octet(1, 7).alias("malicious"), F.when(o % 2 == 0, 1).alias("suspicious"))
    votes = F.struct(_octet(1, 5).alias("malicious"), _octet(1, 3).alias("harmless"))
    attributes = F.struct(
        stats.alias("last_analysis_stats"), votes.alias("total_votes"), (-_octet(1, 11)).alias("reputation")
    )
    answer = F.to_json(F.struct("ip", F.struct(attributes.alias("attributes")).alias("data")))
    return rows.select(F.from_json(answer, reputation.VERDICT_JSON).alias("a")).select("a.*")


def abuse_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reputation.abuse_dim(abuse_answers(v.reputation_rows(spark, sf_dir)))


def verdict_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reputation.verdict_dim(verdict_answers(v.reputation_rows(spark, sf_dir)))


_DIMS = """
dims as (
  select ip, (o * 37) % 101 as score, case when o % 10 = 3 then 0 else o % 50 end as reports,
    case when o % 10 = 4 then 'Unknown' when o % 2 = 0 then 'US' else 'RU' end as country,
    concat('isp', o % 5) as isp, o % 7 + case when o % 2 = 0 then 1 else 0 end as engines,
    -(o % 11) as reputation, o % 5 - o % 3 as community
  from rep)"""

_ENRICHED = (
    _DIMS
    + """,
enriched as (
  select a.detector, a.pos, a.type, a."user", a.ip, a.ts_s, d.score, d.engines, d.isp, d.country, d.reputation, d.community,
    case when d.score >= 90 and a.severity = 'HIGH' then 'CRITICAL' when d.score >= 90 and a.severity = 'MEDIUM' then 'HIGH'
         else a.severity end as severity,
    concat(a.detail,
      case when d.score >= 75 then concat(' | AbuseIPDB: ', d.score, '% confidence malicious (', d.reports, ' report(s), ', d.country, ').') else '' end,
      case when d.engines > 0 then concat(' | VirusTotal: ', d.engines, ' engines flagged, reputation ', d.reputation, ', community ', d.community, '.') else '' end) as detail
  from alerts a left join dims d on a.ip = d.ip)"""
)


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    alerts = durable(all_alerts(spark, sf_dir))
    return e.enrich(alerts, abuse_dim(spark, sf_dir), verdict_dim(spark, sf_dir), PARAMS)


def enriched_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    intel = F.col("threat_intel")
    return enriched(spark, sf_dir).select(
        "detector", "pos", "type", "severity", "ip", "user", "detail",
        intel["abuseipdb"]["abuse_confidence_score"].cast("bigint").alias("score"),
        intel["abuseipdb"]["isp"].alias("isp"),
        intel["virustotal"]["malicious_detections"].cast("bigint").alias("engines"),
    )


def one_source_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enrichment with engine verdicts only: severities stay, half of the struct is null."""
    rows = e.enrich(all_alerts(spark, sf_dir), None, verdict_dim(spark, sf_dir), PARAMS)
    intel = F.col("threat_intel")
    return rows.select(
        "detector", "pos", "severity", "detail", intel["abuseipdb"].isNull().alias("no_abuse"),
        intel["virustotal"]["community_score"].cast("bigint").alias("community"),
    )


def abuse_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = F.col("abuse")
    return abuse_dim(spark, sf_dir).select(
        "ip", a["abuse_confidence_score"].cast("bigint").alias("score"), a["total_reports"].cast("bigint").alias("reports"),
        a["country_code"].alias("country"), a["isp"].alias("isp"), a["is_whitelisted"].alias("is_whitelisted"),
        a["is_malicious"].alias("is_malicious"),
    )


def verdict_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = F.col("verdict")
    names = {"malicious_detections": "engines", "reputation": "reputation", "community_score": "community"}
    return verdict_dim(spark, sf_dir).select("ip", *[a[f].cast("bigint").alias(n) for f, n in names.items()])


def _rep(sql: str) -> str:
    return v.duck_views("rep") + "," + _DIMS + "\n" + sql


# --- reports -------------------------------------------------------------------------


def incident_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = r.incident_numbers(all_alerts(spark, sf_dir))
    name = r.incident_id(F.lit("INC"), F.col("severity"), F.col("number"))
    return numbered.select("detector", "pos", "severity", "number", name.alias("incident_id"))


def alert_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts numbered in report order."""
    every = all_alerts(spark, sf_dir).withColumn("every", F.lit(0))
    return number_within(every, "every", ["ts_us", "detector", "pos"]).select("number", "detector", "pos", "type")


def intel_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reputation lines of the report, one row each."""
    rows = enriched(spark, sf_dir)
    return rows.select("detector", "pos", F.posexplode(e.intel_lines(F.col("threat_intel"))).alias("line_no", "line"))


def console_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.console_rows(enriched(spark, sf_dir))


def report_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole incident report of the enriched alerts, in order."""
    lines = r.report_lines(enriched(spark, sf_dir), "auth.log", datetime(2026, 5, 26, 12, 5, 0))
    return lines.orderBy(*r.ORDER)


def extra_detector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A detector of the caller's beside the registered ones: logins from the local network."""

    def local_logins(events: DataFrame, params) -> DataFrame:
        found = d.off_hours_logins(events.filter(F.startswith("ip", F.lit("10."))), params)
        return found.withColumns({"detector": F.lit(9), "type": F.lit("LOCAL_LOGIN")})

    mixed = d.all_alerts(v.events(spark, sf_dir), PARAMS, {"burst": d.DETECTORS["burst"], "local": local_logins})
    return mixed.groupBy("type", "severity").agg(F.count("*").alias("count"))


# --- from log text ----------------------------------------------------------------------


def log_folder(spark: SparkSession, sf_dir: str, files: int) -> str:
    """The derived log lines as text files."""
    path = f"{shared_folder(spark)}/log-{uuid.uuid4().hex}"
    dealt = v.lines(spark, sf_dir).repartition(files, F.substring("line", 1, 9)).sortWithinPartitions("pos")
    dealt.select("line").write.text(path)
    return path


def log_in_parts(spark: SparkSession, sf_dir: str) -> str:
    """The derived log lines as one log in line order, in as many parts as tasks write."""
    path = f"{shared_folder(spark)}/log-{uuid.uuid4().hex}"
    dealt = v.lines(spark, sf_dir).repartitionByRange("pos").sortWithinPartitions("pos")
    dealt.select("line").write.text(path)
    return path


def detect_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All detections from log text."""
    return flat(detect(spark, log_in_parts(spark, sf_dir), 2024, PARAMS)).drop("pos")


def stored_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts written as JSON lines and read back."""
    path = f"{shared_folder(spark)}/alerts-{spark.sparkContext.applicationId}-{abs(hash(sf_dir))}"
    write_alerts(all_alerts(spark, sf_dir), path)
    rows = read_alerts(spark, path)
    return rows.select(
        "type", "severity", "ip", "user", t.iso_text(F.col("ts")).alias("at"), "detail",
        F.size(F.coalesce("timeline", F.array().cast(rows.schema["timeline"].dataType))).cast("bigint").alias("steps"),
    )


_NOTE_LINES = """
select detector, pos, line_no, line from (
  select detector, pos, 0 as line_no, concat('      Threat Intel  : AbuseIPDB Score ', score, '%, Country ', country, ', ISP ', isp,
    ', Malicious ', case when score >= 75 then 'Yes' else 'No' end) as line from enriched where score is not null
  union all
  select detector, pos, 1, concat('      Threat Intel  : VirusTotal Malicious ', engines, ', Reputation ', reputation, ', Community ', community)
  from enriched where engines is not null
  union all
  select detector, pos, 0, '      Threat Intel  : N/A' from enriched where score is null) n"""

_TECHNIQUE = """
case type when 'BRUTEFORCE_SUCCESS' then 'T1110' when 'PRIVILEGE_ESCALATION' then 'T1548'
  when 'FAILED_LOGIN_BURST' then 'N/A' else 'T1078' end"""
_TECHNIQUE_NAME = """
case type when 'BRUTEFORCE_SUCCESS' then 'Brute Force' when 'PRIVILEGE_ESCALATION' then 'Abuse Elevation Control Mechanism'
  when 'FAILED_LOGIN_BURST' then 'Unknown' else 'Valid Accounts' end"""

_CONSOLE = f"""
select detector, pos, severity,
  concat('  [', rpad(severity, 8, ' '), ']  ', strftime(make_timestamp(ts_s * 1000000), '%Y-%m-%d %H:%M:%S'), '  ', rpad(type, 25, ' '),
    '  MITRE: ', rpad({_TECHNIQUE}, 6, ' '), '  IP: ', ip, '  USER: ', "user",
    case when score is null then '' else concat('  TI: ', score, '% ', country, ' ', isp, ' Malicious:', case when score >= 75 then 'Yes' else 'No' end) end,
    case when engines is null then '' else concat('  VT: ', engines, ' Rep:', reputation, ' Comm:', community) end) as line
from enriched"""

_FLAGGED = """
select ip, sum(n) filter (severity = 'CRITICAL') as c, sum(n) filter (severity = 'HIGH') as h, sum(n) filter (severity = 'MEDIUM') as m,
  sum(n) filter (severity = 'LOW') as l, string_agg(concat(severity, ':', n), '  ' order by n desc, first_s, first_d, first_p) as severities
from (select ip, severity, count(*) as n, min((ts_s, detector, pos))[1] as first_s, min((ts_s, detector, pos))[2] as first_d,
             min((ts_s, detector, pos))[3] as first_p from alerts where ip <> 'localhost' group by ip, severity) g
group by ip"""

_ACTIONS = [
    ("BRUTEFORCE_SUCCESS", 0, "Rotate credentials for affected accounts."),
    ("BRUTEFORCE_SUCCESS", 1, "Block offending IPs at firewall/fail2ban."),
    ("BRUTEFORCE_SUCCESS", 2, "Review authentication logs for lateral movement."),
    ("PRIVILEGE_ESCALATION", 0, "Review sudo/su logs for unauthorized privilege use."),
    ("PRIVILEGE_ESCALATION", 1, "Verify sudoers configuration and least-privilege controls."),
    ("PRIVILEGE_ESCALATION", 2, "Check for persistence or account misuse."),
    ("OFF_HOURS_LOGIN", 0, "Validate off-hours access with account owners."),
    ("OFF_HOURS_LOGIN", 1, "Confirm change windows or approved maintenance."),
    ("OFF_HOURS_LOGIN", 2, "Enable MFA if not already in place."),
    ("UNKNOWN_USER_LOGIN", 0, "Audit /etc/passwd for unauthorized accounts."),
    ("UNKNOWN_USER_LOGIN", 1, "Disable or lock suspicious accounts."),
    ("UNKNOWN_USER_LOGIN", 2, "Review recent account creation and access events."),
    ("FAILED_LOGIN_BURST", 0, "Review alert context and validate user activity."),
    ("ACCOUNT_COMPROMISE", 0, "Review alert context and validate user activity."),
]
_ACTION_VALUES = ", ".join(f"('{a}', {i}, '{text}')" for a, i, text in _ACTIONS)

_SUMMARY_ACTIONS = """
select line_no, line from (values
  (0, 'CRITICAL', '  [CRITICAL] Escalate immediately to L2 analyst.'),
  (1, 'CRITICAL', '  [CRITICAL] Isolate affected systems if active breach is suspected.'),
  (2, 'BRUTEFORCE_SUCCESS', '  [ACTION]   Rotate credentials for all users authenticated from flagged IPs.'),
  (3, 'BRUTEFORCE_SUCCESS', '  [ACTION]   Block offending IPs at firewall/fail2ban.'),
  (4, 'PRIVILEGE_ESCALATION', '  [ACTION]   Review sudo logs for unauthorized privilege use.'),
  (5, 'PRIVILEGE_ESCALATION', '  [ACTION]   Verify sudoers configuration and restrict where possible.'),
  (6, 'OFF_HOURS_LOGIN', '  [ACTION]   Confirm off-hours sessions with account owners.'),
  (7, 'UNKNOWN_USER_LOGIN', '  [ACTION]   Audit /etc/passwd for unauthorized accounts.')) a(line_no, cause, line)
where cause in (select severity from alerts union select type from alerts)"""

_SEVERITY_COUNTS = """
select s.severity, s.r as severity_rank, count(a.type) as count
from (values ('CRITICAL', 0), ('HIGH', 1), ('MEDIUM', 2), ('LOW', 3)) s(severity, r)
left join alerts a on a.severity = s.severity group by all"""

_BAR = "=" * 78
_ADVICE = """
(values
  (0, 'CRITICAL', '  [CRITICAL] Escalate immediately to L2 analyst.'),
  (1, 'CRITICAL', '  [CRITICAL] Isolate affected systems if active breach is suspected.'),
  (2, 'BRUTEFORCE_SUCCESS', '  [ACTION]   Rotate credentials for all users authenticated from flagged IPs.'),
  (3, 'BRUTEFORCE_SUCCESS', '  [ACTION]   Block offending IPs at firewall/fail2ban.'),
  (4, 'PRIVILEGE_ESCALATION', '  [ACTION]   Review sudo logs for unauthorized privilege use.'),
  (5, 'PRIVILEGE_ESCALATION', '  [ACTION]   Verify sudoers configuration and restrict where possible.'),
  (6, 'OFF_HOURS_LOGIN', '  [ACTION]   Confirm off-hours sessions with account owners.'),
  (7, 'UNKNOWN_USER_LOGIN', '  [ACTION]   Audit /etc/passwd for unauthorized accounts.')) a(no, cause, line)"""
# the expected text of a report: lists of lines with their place
_REPORT = f"""
numbered as (
  select *, {_RANK} as sr, row_number() over (partition by severity order by ts_s, detector, pos) as number from enriched),
totals as (
  select count(*) as total, count(distinct ip) filter (ip <> 'localhost') as ips, min(sr) as worst,
    count(*) filter (severity = 'CRITICAL') as c, count(*) filter (severity = 'HIGH') as h,
    count(*) filter (severity = 'MEDIUM') as m, count(*) filter (severity = 'LOW') as l from numbered),
lists as (
  select 1 as section, 0 as grp, 0 as num, '' as key, ['{_BAR}', '                 ENTERPRISE SOC INCIDENT REPORT', '{_BAR}',
    '  Incident ID     : INC-20260526-120500', '  Generated At    : 2026-05-26 12:05:00', '  Log Source      : auth.log',
    '  Overall Severity: ' || case worst when 0 then 'CRITICAL' when 1 then 'HIGH' when 2 then 'MEDIUM' else 'LOW' end,
    '  Analyst         : [L1 SOC Analyst]', '  Status          : Open — Pending L2 Review', '{_BAR}', ''] as lines from totals
  union all
  select 2, 0, 0, '', ['-- EXECUTIVE SUMMARY {"-" * 56}', '  Total Alerts   : ' || total, '  CRITICAL       : ' || c,
    '  HIGH           : ' || h, '  MEDIUM         : ' || m, '  LOW            : ' || l, '  Unique IPs     : ' || ips, '',
    '  Alert Types Detected:'] from totals
  union all
  select 2, 1, 0, lpad(cast(1000000000000000 - count(*) as varchar), 16, '0') || lpad(cast(min(ts_s * 10000000 + detector) as varchar), 20, '0'),
    ['    - ' || rpad(type, 30, ' ') || ' ' || count(*) || ' alert(s)'] from numbered group by type
  union all
  select 2, 2, 0, '', ['']
  union all
  select 3, 0, 0, '', ['-- FLAGGED IP ADDRESSES {"-" * 51}'] from totals where ips > 0
  union all
  select 3, 1, 0, ip, ['  ' || rpad(ip, 20, ' ') || ' ' || severities] from ({_FLAGGED.replace("from alerts", "from numbered")}) f
  union all
  select 3, 2, 0, '', [''] from totals where ips > 0
  union all
  select 4, -1, 0, '', ['-- ALERT DETAILS {"-" * 60}']
  union all
  select 4, sr, 0, '', ['', '  ' || case severity when 'CRITICAL' then '[CRIT]' when 'HIGH' then '[HIGH]' when 'MEDIUM' then '[ MED]' else '[ LOW]' end
    || ' ' || severity || ' (' || count(*) || ' alert(s))', '  {"-" * 72}'] from numbered group by sr, severity
  union all
  select 4, sr, number, '', ['  [' || number || '] Incident ID    : INC-20260526-120500-' || severity[1] ||
      case when number < 1000 then lpad(cast(number as varchar), 3, '0') else cast(number as varchar) end,
    '      Severity       : ' || severity, '      Detection Type : ' || type,
    '      MITRE ATT&CK   : ' || {_TECHNIQUE} || ' - ' || {_TECHNIQUE_NAME},
    '      Source IP      : ' || ip, '      Username       : ' || "user", '      Timestamp      : ' || {_iso("ts_s")}]
    || case when score is null then ['      Threat Intel  : N/A'] else [
      '      Threat Intel  : AbuseIPDB Score ' || score || '%, Country ' || country || ', ISP ' || isp || ', Malicious ' || case when score >= 75 then 'Yes' else 'No' end,
      '      Threat Intel  : VirusTotal Malicious ' || engines || ', Reputation ' || reputation || ', Community ' || community] end
    || ['      Analyst Notes  : ' || detail, '      Recommended Actions:']
    || (select list('        - ' || action order by action_no) from (values {_ACTION_VALUES}) x(cause, action_no, action) where cause = numbered.type)
    || [''] from numbered
  union all
  select 5, -1, 0, '', ['-- RECOMMENDED ACTIONS (SUMMARY) {"-" * 42}']
  union all
  select 5, 0, no, '', [line] from {_ADVICE} where cause in (select severity from numbered union select type from numbered)
  union all
  select 5, 1, 0, '', ['']
  union all
  select 6, 0, 0, '', ['{_BAR}', '  Report generated by logwarden', '{_BAR}'])"""

CHECKS = {
    **{name: _detector(name) for name in _PARTS},
    "all_alerts": (sorted_alerts, _with_alerts(f"select {_ALERT_COLUMNS} from alerts")),
    "failure_evidence": (
        failure_evidence,
        v.duck_views()
        + ","
        + _EVIDENCE
        + """ select pos, ip, usr as "user", ts_s * 1000000 as ts_us, failures,
        first_s * 1000000 as first_us, last_s * 1000000 as last_us from evidence""",
    ),
    "last_bursts": (
        last_bursts,
        v.duck_views() + "," + _BURSTS + " select ip, pos, last_s * 1000000 as last_us, failures from bursts",
    ),
    "compromise_timeline": (compromise_timeline, _with_alerts(_TIMELINE_SQL)),
    "abuse_reputation": (
        abuse_reputation,
        _rep("select ip, score, reports, country, isp, false as is_whitelisted, score >= 75 as is_malicious from dims"),
    ),
    "verdict_reputation": (verdict_reputation, _rep("select ip, engines, reputation, community from dims")),
    "enriched_alerts": (
        enriched_alerts,
        _with_alerts(
            'select detector, pos, type, severity, ip, "user", detail, score, isp, engines from enriched',
            _ENRICHED,
            views=("rep",),
        ),
    ),
    "one_source_enriched": (
        one_source_enriched,
        _with_alerts(
            """select a.detector, a.pos, a.severity, true as no_abuse, d.community,
              concat(a.detail, case when d.engines > 0 then concat(' | VirusTotal: ', d.engines, ' engines flagged, reputation ',
                d.reputation, ', community ', d.community, '.') else '' end) as detail
            from alerts a left join dims d on a.ip = d.ip""",
            _DIMS,
            views=("rep",),
        ),
    ),
    "public_addresses": _of_alerts(
        e.public_addresses, "select distinct ip from alerts where ip <> 'localhost' and ip not like '10.%'"
    ),
    "severity_counts": _of_alerts(rollups.severity_counts, _SEVERITY_COUNTS),
    "type_counts": _of_alerts(
        lambda a: rollups.type_counts(a).select("type", "count"), "select type, count(*) as count from alerts group by type"
    ),
    "unique_ips": _of_alerts(
        rollups.unique_ips,
        "select count(distinct ip) filter (ip <> 'localhost') as attacker_ips, count(distinct ip) as all_ips from alerts",
    ),
    "overall_severity": _of_alerts(
        rollups.overall_severity,
        f"""select case min({_RANK}) when 0 then 'CRITICAL' when 1 then 'HIGH' when 2 then 'MEDIUM' else 'LOW' end
        as overall_severity from alerts""",
    ),
    "report_metadata": _of_alerts(
        rollups.report_metadata,
        """select count(*) as total_alerts, count(*) filter (severity = 'CRITICAL') as critical,
        count(*) filter (severity = 'HIGH') as high, count(*) filter (severity = 'MEDIUM') as medium,
        count(*) filter (severity = 'LOW') as low from alerts""",
    ),
    "flagged_ips": _of_alerts(
        rollups.flagged_ips,
        f"""select ip, cast(coalesce(c, 0) as bigint) as critical, cast(coalesce(h, 0) as bigint) as high,
        cast(coalesce(m, 0) as bigint) as medium, cast(coalesce(l, 0) as bigint) as low, severities from ({_FLAGGED}) f""",
    ),
    "top_ips": _of_alerts(
        rollups.top_ips, "select ip, count(*) as count from alerts group by ip order by count desc, ip limit 10"
    ),
    "top_users": _of_alerts(
        rollups.top_users,
        'select "user", count(*) as count from alerts group by "user" order by count desc, "user" limit 10',
    ),
    "hourly_timeline": _of_alerts(
        lambda a: rollups.hourly_timeline(a).select(t.iso_text(F.col("hour")).alias("hour"), "count"),
        f"select {_iso('ts_s - ts_s % 3600')} as hour, count(*) as count from alerts group by ts_s - ts_s % 3600",
    ),
    "technique_rollup": _of_alerts(
        rollups.technique_rollup,
        f"""select {_TECHNIQUE} as technique_id, {_TECHNIQUE_NAME} as technique_name, count(*) as count
        from alerts group by 1, 2""",
    ),
    "alert_techniques": _of_alerts(
        lambda a: rollups.with_technique(a).select("detector", "pos", "technique_id", "technique_name"),
        f"select detector, pos, {_TECHNIQUE} as technique_id, {_TECHNIQUE_NAME} as technique_name from alerts",
    ),
    "incident_ids": (
        incident_ids,
        _with_alerts(
            """select detector, pos, severity, number, concat('INC-', severity[1],
              case when number < 1000 then lpad(cast(number as varchar), 3, '0') else cast(number as varchar) end) as incident_id
            from (select *, row_number() over (partition by severity order by ts_s, detector, pos) as number from alerts) n"""
        ),
    ),
    "alert_numbers": (
        alert_numbers,
        _with_alerts("select row_number() over (order by ts_s, detector, pos) as number, detector, pos, type from alerts"),
    ),
    "alert_actions": _of_alerts(
        r.alert_actions,
        f"""select detector, pos, a.type, action_no, action from alerts a
        join (values {_ACTION_VALUES}) x(type, action_no, action) on a.type = x.type""",
    ),
    "summary_actions": _of_alerts(r.summary_actions, _SUMMARY_ACTIONS),
    "intel_lines": (intel_lines, _with_alerts(_NOTE_LINES, _ENRICHED, views=("rep",))),
    "console_lines": (console_lines, _with_alerts(_CONSOLE, _ENRICHED, views=("rep",))),
    "stored_alerts": (
        stored_alerts,
        _with_alerts(
            f"""select type, severity, ip, "user", {_iso("ts_s")} as at, detail,
            cast(case when type = 'ACCOUNT_COMPROMISE' then 3 else 0 end as bigint) as steps from alerts"""
        ),
    ),
    "report_text": (
        report_text,
        _with_alerts(
            "select section, grp, num, key, unnest(generate_series(0, len(lines) - 1)) as line_no, unnest(lines) as line from lists",
            _ENRICHED,
            _REPORT,
            views=("rep",),
        ),
    ),
    "extra_detector": (
        extra_detector,
        _with_alerts(
            f"""select type, severity, count(*) as count from (
              select type, severity from alerts where type = 'FAILED_LOGIN_BURST'
              union all select 'LOCAL_LOGIN', severity from ({_OFF_HOURS}) o where ip like '10.%') m group by type, severity"""
        ),
    ),
    "detect_text": (detect_text, _with_alerts(f"select {_ALERT_COLUMNS.replace('pos, ', '')} from alerts")),
}
