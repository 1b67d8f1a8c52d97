"""Parsing of log lines derived from the ``events`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import views as v
from checks.patterns import ACCEPTED, FAILED, FIRST_LOOK, LAYOUTS, MESSAGES, SU, SUDO, Message
from logwarden.functions import timestamps as t
from logwarden.operators import attempts as a
from logwarden.operators import formats as fm
from logwarden.operators.attempt_rules import RULES, Rule
from logwarden.operators.auth_events import auth_events
from logwarden.sources.ip_lists import ip_list

AS_OF = fm.AsOf(2024, 6)
EXTRA_MESSAGE = Message("received_disconnect", r"Received disconnect from ([0-9a-fA-F:.]+): 11", None, 1, False)
EXTRA_RULE = Rule("received_disconnect", r"Received disconnect from ([0-9a-fA-F:.]+): 11", user_group=None, ip_group=1)


def _q(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


# --- events --------------------------------------------------------------------------


def _events_sql(view: str) -> str:
    g = lambda p, i: f"regexp_extract(line, {_q(p)}, {i})"
    return (
        v.duck_views(view)
        + f"""select pos, kind, ip, "user", command, strftime(ts, '%Y-%m-%dT%H:%M:%S') as at, epoch_us(ts) as ts_us
from (select *, try_strptime(concat('2024 ', regexp_replace(stamp, '\\s+', ' ', 'g')), '%Y %b %d %H:%M:%S') as ts
  from (select pos,
    case shape when 4 then 'sudo' when 3 then 'sudo' when 2 then 'success' else 'failed' end as kind,
    case shape when 1 then {g(FAILED, 3)} when 2 then {g(ACCEPTED, 3)} end as ip,
    case shape when 1 then {g(FAILED, 2)} when 2 then {g(ACCEPTED, 2)} when 3 then {g(SUDO, 2)} else {g(SU, 3)} end as "user",
    case shape when 3 then trim({g(SUDO, 3)}) when 4 then concat('su to ', {g(SU, 2)}) end as command,
    case shape when 1 then {g(FAILED, 1)} when 2 then {g(ACCEPTED, 1)} when 3 then {g(SUDO, 1)} else {g(SU, 1)} end as stamp
    from (select *, case when regexp_matches(line, {_q(FAILED)}) then 1 when regexp_matches(line, {_q(ACCEPTED)}) then 2
                    when regexp_matches(line, {_q(SUDO)}) then 3 when regexp_matches(line, {_q(SU)}) then 4 end as shape
          from {view}) s where shape is not null) e) x
where ts is not null"""
    )


def _flat_events(events: DataFrame) -> DataFrame:
    return events.select("pos", "kind", "ip", "user", "command", t.iso_text(F.col("ts")).alias("at"), "ts_us")


def parse_auth_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_events(auth_events(v.lines(spark, sf_dir), 2024))


def parse_mixed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_events(auth_events(v.mixed_lines(spark, sf_dir), 2024))


# --- layouts and attempts ------------------------------------------------------------

_PATTERNS = [pattern for _, pattern, _ in LAYOUTS]
_FIRST_FORMAT = "case " + " ".join(f"when regexp_matches(line, {_q(p)}) then {i}" for i, p in enumerate(_PATTERNS)) + " end"
_NAME = "case format " + " ".join(f"when {i} then '{name}'" for i, (name, _, _) in enumerate(LAYOUTS)) + " end"

_ISO_FULL = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?([+-]\d{2}:\d{2})?$"


def _scan_ctes(chosen: str, rules: tuple[Message, ...] = MESSAGES) -> str:
    """CTEs ``looked`` (layout per line), ``timed`` (message and time) and ``found`` (attempts)."""
    info = "case format " + " ".join(
        f"when {i} then regexp_extract(line, {_q(pattern)}, {group})" for i, (_, pattern, group) in enumerate(LAYOUTS)
    )
    matched = "case format " + " ".join(f"when {i} then regexp_matches(line, {_q(p)})" for i, p in enumerate(_PATTERNS))
    token = "split_part(line, ' ', 1)"
    offset = lambda i: f"regexp_extract({token}, '([+-])(\\d{{2}}):(\\d{{2}})$', {i})"
    is_rule = [f"regexp_matches(info, {_q(r.pattern)})" for r in rules]
    by = lambda f: "case rule when -1 then {} ".format(f(FIRST_LOOK)) + " ".join(
        f"when {i} then {f(r)}" for i, r in enumerate(rules)
    ) + " end"
    user = by(lambda r: "''" if r.user_group is None else f"regexp_extract(info, {_q(r.pattern)}, {r.user_group})")
    ip = by(lambda r: f"regexp_extract(info, {_q(r.pattern)}, {r.ip_group})")
    events = "case rule when -1 then 'invalid_user' " + " ".join(f"when {i} then '{r.event}'" for i, r in enumerate(rules)) + " end"
    wins = ", ".join(str(i) for i, r in enumerate(rules) if r.success)
    octet = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
    return f"""
looked as ({chosen}),
timed as (
  select *, epoch_us(ts) - case when tz is null then 0 else tz::bigint * 60000000 end as ts_us
  from (select file, pos, format, coalesce({matched} end, false) as matched, {info} end as info,
      case when format in (0, 1) and regexp_matches({token}, {_q(_ISO_FULL)}) then try_cast(left({token}, 10) || ' ' || regexp_extract({token}, 'T([0-9:.]+)', 1) as timestamp)
           when format in (2, 3)
           then try_strptime(concat(case when position(left(line, 3) in 'JulAugSepOctNovDec') > 0 then '2023 ' else '2024 ' end, left(line, 15)), '%Y %b %d %H:%M:%S') end as ts,
      case when format in (0, 1) and regexp_matches({token}, '[+-]\\d{{2}}:\\d{{2}}$')
           then (cast({offset(2)} as int) * 60 + cast({offset(3)} as int)) * case {offset(1)} when '-' then -1 else 1 end end as tz
    from looked) m),
ruled as (
  select *, case when not matched or ts is null then null when regexp_matches(info, {_q(FIRST_LOOK.pattern)}) then -1
    {" ".join(f"when {c} then {i}" for i, c in enumerate(is_rule))} end as rule
  from timed),
found as (
  select *, regexp_matches(ip, '^{octet}(\\.{octet}){{3}}$') as valid
  from (select *, {user} as u, {ip} as ip, {events} as event, rule in ({wins}) as success from ruled) r)
"""


_STICKY = f"""
select l.*, c.format from mixed l left join (
  select file, arg_min(f, pos) as format from (select file, pos, {_FIRST_FORMAT} as f from mixed) x where f is not null group by file) c
on l.file = c.file"""
_PER_LINE = f"select *, {_FIRST_FORMAT} as format from mixed"
_FORCED = "select *, 3 as format from mixed"

_ATTEMPT_COLUMNS = """
select file, pos, ip, case when u = '' then '<unknown>' else u end as username, ts_us, tz as tz_offset_min, success, event
from found where rule is not null and valid"""


def _flat(attempts: DataFrame) -> DataFrame:
    return attempts.select("file", "pos", "ip", "username", "ts_us", "tz_offset_min", "success", "event")


def match_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = v.mixed_lines(spark, sf_dir)
    return lines.select("pos", fm.first_format(F.col("line")).cast("bigint").alias("format"))


def detect_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fm.detect_formats(v.mixed_lines(spark, sf_dir)).drop("lines")
    return a.with_format_name(found)


def extract_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(a.scan_once(v.mixed_lines(spark, sf_dir), AS_OF).attempts)


def line_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(a.attempts(a.scan_lines(v.mixed_lines(spark, sf_dir), AS_OF, sticky=False)))


def forced_format_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(a.scan_once(v.mixed_lines(spark, sf_dir), AS_OF, format="generic SYSLOG").attempts)


def extended_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = v.mixed_lines(spark, sf_dir)
    return _flat(a.scan_once(lines, AS_OF, rules=(*RULES, EXTRA_RULE)).attempts)


def parse_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = a.with_format_name(a.scan_once(v.mixed_lines(spark, sf_dir), AS_OF).stats)
    return stats.select(
        "file", "lines_read", "format_matches", "extract_matches", "failed_timestamps", "format", "first_us", "last_us"
    )


def admitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts with broken addresses, times and missing names, through admission."""
    rows = v.attempts(spark, sf_dir)
    pos = F.col("pos")
    broken = rows.select(
        "pos",
        F.when(pos % 11 == 0, "").when(pos % 13 == 0, F.concat("ip", F.lit("/24"))).otherwise(F.col("ip")).alias("ip"),
        F.when(pos % 7 != 0, F.col("username")).alias("username"),
        F.when(pos % 17 != 0, F.col("ts")).alias("ts"),
        "ts_us",
        F.when(pos % 5 != 0, F.col("success")).alias("success"),
        "event",
    )
    return a.admit(broken).select("pos", "ip", "username", "ts_us", "success")


_LIST_LINES = """
select case pos % 8 when 0 then concat('# ', ip) when 1 then concat('  ', ip, ' ') when 2 then '' when 3 then concat(ip, '/32')
  when 4 then 'example.com' when 5 then concat('#', ip) when 6 then concat(ip, '.7') else ip end as value from {auth} a"""


def whitelist_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.sql(_LIST_LINES.format(auth="{auth}"), auth=v.auth(spark, sf_dir))
    return ip_list(lines, comments=True)


# a layout and a rule of the caller's
_DOTTED = fm.LogFormat(
    "dotted",
    r"^<\d+> (\S+ \S+) \| (.*)$",
    2,
    fields=lambda line: F.array(F.regexp_extract(line, r"> (\S+ \S+)", 1)),
    clock=lambda fields, as_of: F.try_to_timestamp(F.get(fields, 0), F.lit("dd.MM.yyyy HH:mm:ss")).cast("timestamp_ntz"),
)
_BAD_LOGIN = Rule("bad_login", r"bad login (\w+)@([\d.]+)")


def more_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = v.dotted_lines(spark, sf_dir)
    return _flat(a.scan_once(lines, AS_OF, formats=(*fm.FORMATS, _DOTTED), rules=(*RULES, _BAD_LOGIN)).attempts)


CHECKS = {
    "parse_auth_lines": (parse_auth_lines, _events_sql("lines")),
    "parse_mixed_lines": (parse_mixed_lines, _events_sql("mixed")),
    "match_formats": (match_formats, v.duck_views("mixed") + f"select pos, cast({_FIRST_FORMAT} as bigint) as format from mixed"),
    "detect_formats": (
        detect_formats,
        v.duck_views("mixed")
        + f"""select file, {_NAME} as format from (select file, arg_min(f, pos) as format
          from (select file, pos, {_FIRST_FORMAT} as f from mixed) x where f is not null group by file) c""",
    ),
    "extract_attempts": (extract_attempts, v.duck_views("mixed") + "," + _scan_ctes(_STICKY) + _ATTEMPT_COLUMNS),
    "line_attempts": (line_attempts, v.duck_views("mixed") + "," + _scan_ctes(_PER_LINE) + _ATTEMPT_COLUMNS),
    "forced_format_attempts": (forced_format_attempts, v.duck_views("mixed") + "," + _scan_ctes(_FORCED) + _ATTEMPT_COLUMNS),
    "extended_rules": (
        extended_rules,
        v.duck_views("mixed") + "," + _scan_ctes(_STICKY, (*MESSAGES, EXTRA_MESSAGE)) + _ATTEMPT_COLUMNS,
    ),
    "more_layouts": (
        more_layouts,
        v.duck_views("dotted")
        + """select concat('d', cast(pos % 3 as varchar)) as file, pos, ip, usr as username, ts_s * 1000000 as ts_us,
          cast(null as integer) as tz_offset_min, false as success, 'bad_login' as event from auth where kind = 'failed'""",
    ),
    "parse_stats": (
        parse_stats,
        v.duck_views("mixed")
        + ","
        + _scan_ctes(_STICKY)
        + f"""select file, count(*) as lines_read, count(*) filter (matched) as format_matches,
          count(*) filter (rule is not null and valid) as extract_matches,
          count(*) filter (matched and ts is null) as failed_timestamps, {_NAME.replace("format when", "max(format) when", 1)} as format,
          arg_min(ts_us, pos) filter (matched and ts is not null) as first_us,
          arg_max(ts_us, pos) filter (matched and ts is not null) as last_us
        from found group by file""",
    ),
    "admitted_attempts": (
        admitted,
        v.duck_views()
        + """select pos, ip, case when pos % 7 <> 0 then usr else '<unknown>' end as username, ts_s * 1000000 as ts_us,
          case when pos % 5 <> 0 then kind = 'success' else false end as success
        from auth where kind in ('failed', 'success') and pos % 11 <> 0 and pos % 13 <> 0 and pos % 17 <> 0""",
    ),
    "whitelist_entries": (
        whitelist_entries,
        v.duck_views()
        + """select distinct ip from auth where pos % 8 in (1, 7)""",
    ),
}
