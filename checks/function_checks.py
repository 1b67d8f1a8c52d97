"""Scalar expressions over texts and numbers derived from the ``events`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import views as v
from logwarden.functions import addresses as ad
from logwarden.functions import severity as s
from logwarden.functions import text as x
from logwarden.functions import timestamps as t

# address-like texts: valid ones all over the IPv4 space and many broken ones
_ADDRESSES = """
select pos, case
  when pos % 23 = 0 then concat('0', a, '.', b, '.1.1') when pos % 29 = 0 then concat(a, '.', b, '.1')
  when pos % 31 = 0 then concat(a, '.', b, '.1.', 256 + c) when pos % 37 = 0 then concat(a, '.', b, '.1.', c, '/24')
  when pos % 41 = 0 then concat(a, '.', b, '.x.', c) when pos % 43 = 0 then '' when pos % 47 = 0 then concat(' ', a, '.', b, '.2.', c, ' ')
  when pos % 53 = 0 then 'localhost'
  else concat(a, '.', b, '.', d, '.', c) end as ip
from (select pos, case pos % 17 when 0 then 0 when 1 then 10 when 2 then 127 when 3 then 169 when 4 then 172 when 5 then 192 when 6 then 198
        when 7 then 203 when 8 then 224 when 9 then 240 when 10 then 255 when 11 then 100 else (pos * 7) % 256 end as a,
      case pos % 11 when 0 then 0 when 1 then 168 when 2 then 254 when 3 then 16 when 4 then 31 when 5 then 32 when 6 then 18 when 7 then 19
        when 8 then 51 when 9 then 64 else (pos * 13) % 256 end as b,
      (pos * 3) % 256 as c,
      case pos % 5 when 0 then 0 when 1 then 2 when 2 then 113 when 3 then 100 else (pos * 11) % 256 end as d
      from {auth} a0) n"""

_OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


def _addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_ADDRESSES.format(auth="{auth}"), auth=v.auth(spark, sf_dir))


def address_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    ip = F.col("ip")
    return _addresses(spark, sf_dir).select(
        "pos", ad.is_valid_ip(ip).alias("valid"), ad.is_local_or_private(ip).alias("guarded"), ad.is_public(ip).alias("public")
    )


_ADDRESS_SQL = (
    v.duck_views()
    + ", texts as ("
    + _ADDRESSES.format(auth="auth")
    + f"""), parts as (
  select pos, regexp_matches(trim(ip), '^{_OCTET}(\\.{_OCTET}){{3}}$') as valid, regexp_matches(ip, '^{_OCTET}(\\.{_OCTET}){{3}}$') as exact,
    try_cast(split_part(ip, '.', 1) as int) as a, try_cast(split_part(ip, '.', 2) as int) as b,
    try_cast(split_part(ip, '.', 3) as int) as c, try_cast(split_part(ip, '.', 4) as int) as d from texts)
select pos, valid, exact and coalesce(a in (10, 127) or (a = 172 and b between 16 and 31) or (a = 192 and b = 168), false) as guarded,
  exact and coalesce(not (a in (0, 10, 127) or a >= 224 or (a = 169 and b = 254) or (a = 172 and b between 16 and 31)
    or (a = 192 and b = 168) or (a = 192 and b = 0 and c = 0 and d not in (9, 10)) or (a = 192 and b = 0 and c = 2)
    or (a = 198 and b in (18, 19)) or (a = 198 and b = 51 and c = 100) or (a = 203 and b = 0 and c = 113)), false) as public
from parts"""
)

# the same events' addresses as IPv6 texts: mapped, documentation, global, broken
_V6 = """
select pos, case pos % 10 when 0 then concat('::ffff:', ip) when 1 then concat('2001:db8::', usr_no) when 2 then concat('2606:4700::', usr_no)
  when 3 then '::1' when 4 then concat('fe80::', usr_no) when 5 then concat('1:2:3:4:5:6:7:', usr_no) when 6 then concat('1::2::', usr_no)
  when 7 then concat('2001:20::', usr_no) when 8 then concat('fd00:0:0:0:0:0:0:', usr_no) else concat('12345::', usr_no) end as ip
from (select pos, ip, substr(usr, 2) as usr_no from {auth} a0) n"""


def v6_address_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    ip = F.col("ip")
    rows = spark.sql(_V6.format(auth="{auth}"), auth=v.auth(spark, sf_dir))
    return rows.select(
        "pos", ad.is_valid_ip(ip).alias("valid"), ad.is_local_or_private(ip).alias("guarded"), ad.is_public(ip).alias("public")
    )


_V6_SQL = v.duck_views() + (
    "select pos, pos % 10 not in (6, 9) as valid, pos % 10 = 3 as guarded, pos % 10 in (2, 7) as public from auth"
)

_STAMPS = """
select pos, concat(case pos % 15 when 12 then 'feb' when 13 then 'Xyz' when 14 then 'SEP' else substr('JanFebMarAprMayJunJulAugSepOctNovDec', cast(1 + 3 * (pos % 12) as int), 3) end,
  case when pos % 2 = 0 then '  ' else ' ' end, cast(pos % 33 as string), ' ', cast(pos % 25 as string), ':', cast(pos % 61 as string), ':', cast(pos % 62 as string)) as stamp
from {auth} a0"""


def syslog_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times without a year, read with a fixed year and with the rollover rule."""
    rows = spark.sql(_STAMPS.format(auth="{auth}"), auth=v.auth(spark, sf_dir))
    stamp = t.syslog_fields(F.col("stamp"))
    return rows.select(
        "pos",
        t.iso_text(t.syslog_clock(stamp, 2023, any_case=True)).alias("fixed"),
        t.iso_text(t.syslog_clock(stamp, 2024, 6)).alias("rolled"),
    )


_STAMP_PARTS = """
parts as (select pos, left(stamp, 3) as m, pos % 33 as d, pos % 25 as hh, pos % 61 as mi, pos % 62 as ss,
  case upper(left(stamp, 3)) when 'JAN' then 1 when 'FEB' then 2 when 'MAR' then 3 when 'APR' then 4 when 'MAY' then 5 when 'JUN' then 6
    when 'JUL' then 7 when 'AUG' then 8 when 'SEP' then 9 when 'OCT' then 10 when 'NOV' then 11 when 'DEC' then 12 end as mo from stamps),
timed as (select *, case when m not in ('feb', 'SEP') then case when mo > 6 then 2023 else 2024 end end as y2 from parts)
"""


def _stamp_text(year: str) -> str:
    parsed = f"try_strptime(concat({year}, '-', mo, '-', d, ' ', hh, ':', mi, ':', ss), '%Y-%m-%d %H:%M:%S')"
    return f"case when mo is not null and ss <= 59 and {year} is not null then strftime({parsed}, '%Y-%m-%dT%H:%M:%S') end"


_STAMP_SQL = (
    v.duck_views()
    + ", stamps as ("
    + _STAMPS.format(auth="auth")
    + "), "
    + _STAMP_PARTS
    + f"select pos, {_stamp_text('2023')} as fixed, {_stamp_text('y2')} as rolled from timed"
)


def csv_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formula-like texts made of the events' properties."""
    lead = F.get(F.array(*[F.lit(c) for c in ("=", "+", "-", "@", "\t", "\r", "'", "a", "")]), F.pmod(F.col("event_id"), F.lit(9)).cast("int"))
    rows = v.events_table(spark, sf_dir)
    return rows.select("event_id", x.csv_guard(F.concat(lead, F.col("props"))).alias("value"))


_GUARD_SQL = """
select event_id, case when event_id % 9 < 6 then concat('''', raw) else raw end as value
from (select event_id, concat(case event_id % 9 when 0 then '=' when 1 then '+' when 2 then '-' when 3 then '@' when 4 then chr(9)
  when 5 then chr(13) when 6 then '''' when 7 then 'a' else '' end, props) as raw from events) r"""


def number_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Durations and two-decimal rates of made-up totals per event."""
    rows = v.events_table(spark, sf_dir).select("event_id", (F.col("event_id") * 1_234_567).alias("us"), (F.col("event_id") / 8).alias("eighths"))
    return rows.select(
        "event_id",
        t.duration_text(F.col("us")).alias("duration"),
        x.two_decimals(F.col("eighths")).alias("ties"),
        x.two_decimals(F.col("us") / 60_000_000.0).alias("minutes"),
    )


_NUMBER_SQL = """
select event_id, case when us // 3600000000 > 0 then concat(us // 3600000000, 'h ') else '' end
    || concat(us % 3600000000 // 60000000, 'm ', us % 60000000 // 1000000, 's') as duration,
  printf('%.2f', event_id / 8.0::double) as ties, printf('%.2f', us / 60000000.0::double) as minutes
from (select event_id, event_id * 1234567 as us from events) r"""


def severity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compromise score, upgrade and rank for combinations taken from the events."""
    rows = v.auth(spark, sf_dir)
    scored = s.compromise_severity(F.pmod("pos", F.lit(8)), F.col("command").startswith("/bin"), F.pmod("pos", F.lit(3)) == 0)
    rows = rows.select("pos", scored.alias("severity"), F.pmod(F.col("pos") * 7, F.lit(101)).alias("score"))
    return rows.select(
        "pos",
        "severity",
        s.upgrade_severity(F.col("severity"), F.col("score"), 90).alias("upgraded"),
        s.severity_rank(F.col("severity")).cast("bigint").alias("rank"),
        s.recommended_action(F.col("severity")).alias("action"),
    )


_SCORE_SQL = (
    v.duck_views()
    + """select pos, severity, case when score < 90 then severity when severity = 'MEDIUM' then 'HIGH' else 'CRITICAL' end as upgraded,
  cast(case severity when 'CRITICAL' then 0 when 'HIGH' then 1 else 2 end as bigint) as rank,
  case severity when 'MEDIUM' then 'MONITOR' else 'BLOCK' end as action
from (select pos, (pos * 7) % 101 as score, case when points >= 4 then 'CRITICAL' when points >= 2 then 'HIGH' else 'MEDIUM' end as severity
  from (select pos, case when pos % 8 >= 5 then 2 when pos % 8 >= 2 then 1 else 0 end + case when command like '/bin%' then 2 else 0 end
    + case when pos % 3 = 0 then 1 else 0 end as points from auth) p) q"""
)

CHECKS = {
    "address_checks": (address_checks, _ADDRESS_SQL),
    "v6_address_checks": (v6_address_checks, _V6_SQL),
    "syslog_times": (syslog_times, _STAMP_SQL),
    "csv_guard": (csv_guard, _GUARD_SQL),
    "number_texts": (number_texts, _NUMBER_SQL),
    "severity_scores": (severity_scores, _SCORE_SQL),
}
