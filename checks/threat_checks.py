"""The threat summary over the logins of the derived ``auth`` events."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import views as v
from checks.alert_checks import log_folder
from logwarden.operators import threat as th
from logwarden.operators.formats import AsOf
from logwarden.params import DEFAULTS
from logwarden.plans.threat_summary import summarize

_WHITELIST = [f"185.72.33.{i}" for i in range(5)]
_LISTED = ", ".join(f"'{ip}'" for ip in _WHITELIST)
_ORDER = "severity_rank, attempts desc, first_pos"

SUMMARY = """
summary as (
  select *, case severity when 'CRITICAL' then 0 when 'HIGH' then 1 when 'MEDIUM' then 2 else 3 end as severity_rank,
    case when severity in ('CRITICAL', 'HIGH') then 'BLOCK' when severity = 'MEDIUM' then 'MONITOR' else 'ALLOW' end as action
  from (select *, case when attempts >= {max} and duration_us <= 600000000 and attack_rate >= 2.0 then 'CRITICAL'
      when attempts >= {max} and duration_us <= 600000000 then 'HIGH'
      when attempts >= {block} then 'HIGH' when attempts >= {monitor} then 'MEDIUM'
      when attack_rate > 1.0 then 'MEDIUM' else 'LOW' end as severity
    from (select *, attempts / greatest(duration_us / 60000000.0::double, 1.0::double) as attack_rate
      from (select ip, count(*) filter (kind = 'failed') as attempts, min(ts_s) * 1000000 as first_us,
              max(ts_s) * 1000000 as last_us, (max(ts_s) - min(ts_s)) * 1000000 as duration_us, min(pos) as first_pos
            from auth where kind in ('failed', 'success') group by ip) g where attempts > 0) r) c)"""


def _sql(text: str, max=5, block=50, monitor=20) -> str:
    return v.duck_views() + "," + SUMMARY.format(max=max, block=block, monitor=monitor) + "\n" + text


def summary(spark: SparkSession, sf_dir: str, params=DEFAULTS) -> DataFrame:
    return th.ip_summary(v.attempts(spark, sf_dir), params)


def whitelist(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(ip,) for ip in _WHITELIST], "ip string")


_COLUMNS = ["ip", "attempts", "attack_rate", "severity", "action", "duration_us", "first_us", "last_us", "first_pos"]
_SELECT = "select " + ", ".join(_COLUMNS) + " from summary"
_GUARD = "ip not like '10.%' and ip not like '127.%' and ip not like '192.168.%'"


def ip_summary(spark, sf_dir):
    return th.in_threat_order(summary(spark, sf_dir)).select(*_COLUMNS)


def strict_summary(spark, sf_dir):
    return summary(spark, sf_dir, DEFAULTS.strict()).select(*_COLUMNS)


def severity_filter(spark, sf_dir):
    return th.severity_filter(summary(spark, sf_dir), "medium").select(*_COLUMNS)


def threat_top_n(spark, sf_dir):
    params = replace(DEFAULTS, filter_severity="HIGH")
    return th.top_threats(summary(spark, sf_dir), params).select("ip", "attempts", "severity", "attack_rate", "action", "remaining")


def breakdown(spark, sf_dir):
    params = replace(DEFAULTS, filter_severity="HIGH")
    rows = th.breakdown(v.attempts(spark, sf_dir), summary(spark, sf_dir), params)
    return rows.select(F.col("rank").cast("bigint").alias("rank"), "ip", "total_attempts", "username", "attempts", "first_pos")


def footer(spark, sf_dir):
    params = replace(DEFAULTS, filter_severity="MEDIUM")
    return th.summary_footer(summary(spark, sf_dir), whitelist(spark), params)


def marked_actions(spark, sf_dir):
    return th.mark_blocked(summary(spark, sf_dir), whitelist(spark)).select("ip", "severity", "action")


def candidates(spark, sf_dir):
    return th.blocklist_candidates(summary(spark, sf_dir), whitelist(spark)).select("ip")


def delta(spark, sf_dir):
    """Candidates beyond those of the first half of the day (written earlier)."""
    first = v.attempts(spark, sf_dir).filter(F.pmod(F.col("ts_us"), F.lit(86_400_000_000)) < 43_200_000_000)
    written = th.blocklist_candidates(th.ip_summary(first), whitelist(spark)).select("ip")
    return th.not_yet_written(candidates(spark, sf_dir), written)


def csv_summary(spark, sf_dir):
    return th.csv_rows(summary(spark, sf_dir))


_DURATION = """case when duration_us // 3600000000 > 0 then concat(duration_us // 3600000000, 'h ') else '' end
  || concat(duration_us % 3600000000 // 60000000, 'm ', duration_us % 60000000 // 1000000, 's')"""

def coverage_text(spark, sf_dir):
    return th.coverage_text(th.coverage(v.attempts(spark, sf_dir)))


def summarize_text(spark, sf_dir):
    """The summary of log text in several files, read once."""
    result = summarize(spark, log_folder(spark, sf_dir, 8), AsOf(2024, 6))
    return result.summary.select(*[c for c in _COLUMNS if c != "first_pos"])


def text_stats(spark, sf_dir):
    """Parse counters over all files of the same log text."""
    stats = summarize(spark, log_folder(spark, sf_dir, 8), AsOf(2024, 6)).stats
    counters = ["lines_read", "extract_matches", "failed_timestamps"]
    return stats.agg(*[F.sum(c).alias(c) for c in counters], F.min("first_us").alias("first_us"), F.max("last_us").alias("last_us"))


_DURATION = """case when duration_us >= 3600000000 then concat(duration_us // 3600000000, 'h ', duration_us // 60000000 % 60, 'm ', duration_us // 1000000 % 60, 's')
  else concat(duration_us // 60000000, 'm ', duration_us // 1000000 % 60, 's') end"""
_WALL = "strftime(make_timestamp({}), '%Y-%m-%d %H:%M:%S')"
_COVERED = """
covered as (
  select count(distinct ip) as ips, count(*) as attempts, min(ts_s) * 1000000 as first_us, max(ts_s) * 1000000 as last_us,
    (max(ts_s) - min(ts_s)) * 1000000 as duration_us from auth where kind in ('failed', 'success'))"""

CHECKS = {
    "ip_user_failures": (
        lambda spark, sf_dir: th.ip_user_failures(v.attempts(spark, sf_dir)),
        v.duck_views()
        + """select ip, usr as username, count(*) as attempts, min(pos) as first_pos from auth
        where kind = 'failed' group by ip, usr""",
    ),
    "ip_summary": (ip_summary, _sql(_SELECT)),
    "strict_summary": (strict_summary, _sql(_SELECT, max=1, block=5, monitor=1)),
    "severity_filter": (severity_filter, _sql(_SELECT + " where severity_rank <= 2")),
    "threat_top_n": (
        threat_top_n,
        _sql(
            f"""select ip, attempts, severity, attack_rate, action,
            (select greatest(count(*) - 20, 0) from summary where severity_rank <= 1) as remaining
            from summary where severity_rank <= 1 order by {_ORDER} limit 20"""
        ),
    ),
    "threat_breakdown": (
        breakdown,
        _sql(
            f"""select rank, t.ip, t.attempts as total_attempts, f.usr as username, f.n as attempts, f.first_pos
            from (select *, row_number() over (order by {_ORDER}) as rank from summary) t
            join (select ip, usr, count(*) as n, min(pos) as first_pos from auth where kind = 'failed' group by ip, usr) f on f.ip = t.ip
            where rank <= 10 and severity_rank <= 1"""
        ),
    ),
    "summary_footer": (
        footer,
        _sql(
            f"""select count(*) filter (severity_rank <= 2) as shown, count(*) filter (severity_rank > 2) as hidden,
            count(*) filter (severity_rank <= 2 and severity <> 'LOW') as suspicious,
            count(*) filter (severity_rank <= 1 and {_GUARD} and ip not in ({_LISTED})) as blocked from summary"""
        ),
    ),
    "marked_actions": (
        marked_actions,
        _sql(
            f"""select ip, severity, case when severity_rank <= 1 and {_GUARD} and ip not in ({_LISTED}) then 'BLOCKED'
            else action end as action from summary"""
        ),
    ),
    "coverage": (
        lambda spark, sf_dir: th.coverage(v.attempts(spark, sf_dir)),
        v.duck_views()
        + """select count(distinct ip) as ips, count(*) as attempts, min(ts_s) * 1000000 as first_us,
        max(ts_s) * 1000000 as last_us, (max(ts_s) - min(ts_s)) * 1000000 as duration_us
        from auth where kind in ('failed', 'success')""",
    ),
    "invalid_user_top": (
        lambda spark, sf_dir: th.top_invalid_user(v.attempts(spark, sf_dir)),
        v.duck_views()
        + """select ip, count(*) as events, min(pos) as first_pos from auth where kind = 'failed' and pos % 7 = 0
        group by ip order by events desc, first_pos limit 10""",
    ),
    "accepted_top": (
        lambda spark, sf_dir: th.top_accepted(v.attempts(spark, sf_dir)),
        v.duck_views()
        + """select ip, count(*) as events, min(pos) as first_pos from auth where kind = 'success'
        group by ip order by events desc, first_pos limit 10""",
    ),
    "blocklist_candidates": (
        candidates,
        _sql(f"select ip from summary where severity_rank <= 1 and {_GUARD} and ip not in ({_LISTED})"),
    ),
    "blocklist_delta": (
        delta,
        _sql(f"select ip from summary where severity_rank <= 1 and {_GUARD} and ip not in ({_LISTED})")
        + "\nexcept\n("
        + v.duck_views().replace("auth as (", "whole as (", 1)
        + ", auth as (select * from whole where ts_s % 86400 < 43200),"
        + SUMMARY.format(max=5, block=50, monitor=20)
        + f"\nselect ip from summary where severity_rank <= 1 and {_GUARD} and ip not in ({_LISTED}))",
    ),
    "csv_summary": (
        csv_summary,
        _sql(
            f"""select ip as "IP", cast(attempts as varchar) as "Attempts", printf('%.2f', attack_rate) as "Attack_Rate",
            severity as "Severity", action as "Action", {_DURATION} as "Duration",
            strftime(make_timestamp(first_us), '%Y-%m-%dT%H:%M:%S') as "Window_Start",
            strftime(make_timestamp(last_us), '%Y-%m-%dT%H:%M:%S') as "Window_End" from summary"""
        ),
    ),
    "coverage_text": (
        coverage_text,
        v.duck_views()
        + ","
        + _COVERED
        + f"""
        select 0 as line_no, concat('Window: ', {_WALL.format("first_us")}, ' to ', {_WALL.format("last_us")}, ' (', {_DURATION}, ')') as line from covered
        union all select 1, format('Parsed IPs: {{:,}} | Attempts: {{:,}}', ips, attempts) from covered""",
    ),
    "summarize_text": (summarize_text, _sql("select " + ", ".join(c for c in _COLUMNS if c != "first_pos") + " from summary")),
    "text_stats": (
        text_stats,
        v.duck_views()
        + """
        select cast(count(*) as bigint) as lines_read, count(*) filter (kind in ('failed', 'success')) as extract_matches,
          cast(0 as bigint) as failed_timestamps, min(ts_s) * 1000000 as first_us, max(ts_s) * 1000000 as last_us from auth""",
    ),
}
