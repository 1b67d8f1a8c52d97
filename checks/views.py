"""Authentication events, log lines and reputations derived from the ``events`` table.

The driver tables hold no authentication logs. The derivation is the same SQL text in
Spark and DuckDB, apart from the base that turns ``ts`` into microseconds and a calendar day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logwarden.functions import timestamps as t
from logwarden.operators.compute_once import with_struct

DUCK_BASE = "select event_id, event_type, user_id, epoch_us(ts) as us, year(ts) as yr, month(ts) as mon, day(ts) as dom from events"

_AUTH = """
select event_id as pos,
  case when event_type in ('click','error','view') then 'failed'
       when event_type = 'purchase' then 'success' else 'sudo' end as kind,
  case when event_id % 6 = 0 then concat('10.0.0.', cast(user_id % 50 as string))
       when hr % 3 = 0 then concat('45.33.', cast(cast(((hr % 720) - (hr % 720) % 256) / 256 as bigint) as string),
                                   '.', cast((hr % 720) % 256 as string))
       else concat('185.72.33.', cast(hr % 40 as string)) end as ip,
  case when event_id % 5 = 0 then concat('u', cast(user_id % 30 as string))
       else concat('u', cast(hr % 12 as string)) end as usr,
  case event_id % 4 when 0 then '/bin/bash' when 1 then '/usr/bin/apt update'
       when 2 then '/usr/bin/passwd root' else 'su to root' end as command,
  hr * 3600 + cast((sec_of_hr - sec_of_hr % 12) / 12 as bigint) as ts_s, yr, mon, dom
from ({hours}) c
"""

_HOURS = """
select *, cast((us - us % 3600000000) / 3600000000 as bigint) as hr,
       cast(((us - us % 1000000) / 1000000) as bigint) % 3600 as sec_of_hr
from ({base}) b
"""

_CLOCK = """
select *,
  lpad(cast(dom as string), 2, '0') as dd,
  concat(cast(yr as string), '-', lpad(cast(mon as string), 2, '0'), '-', lpad(cast(dom as string), 2, '0')) as ymd,
  substr('JanFebMarAprMayJunJulAugSepOctNovDec', cast(mon * 3 - 2 as int), 3) as mname,
  concat(lpad(cast(cast((ts_s % 86400 - ts_s % 3600) / 3600 as bigint) as string), 2, '0'), ':',
         lpad(cast(cast((ts_s % 3600 - ts_s % 60) / 60 as bigint) as string), 2, '0'), ':',
         lpad(cast(ts_s % 60 as string), 2, '0')) as hms
from {auth} a
"""

# plain syslog lines
_LINES = """
select pos, concat(mname, ' ', dd, ' ', hms, ' host1 ',
  case when kind = 'failed' and pos % 7 = 0 then concat('sshd[', cast(pos as string), ']: Failed password for invalid user ', usr, ' from ', ip, ' port 22 ssh2')
       when kind = 'failed' then concat('sshd[', cast(pos as string), ']: Failed password for ', usr, ' from ', ip, ' port 22 ssh2')
       when kind = 'success' and pos % 2 = 0 then concat('sshd[', cast(pos as string), ']: Accepted publickey for ', usr, ' from ', ip, ' port 22 ssh2')
       when kind = 'success' then concat('sshd[', cast(pos as string), ']: Accepted password for ', usr, ' from ', ip, ' port 22 ssh2')
       when command = 'su to root' then concat('su[', cast(pos as string), ']: Successful su for root by ', usr)
       else concat('sudo[', cast(pos as string), ']:   ', usr, ' : TTY=pts/0 ; PWD=/ ; USER=root ; COMMAND=', command) end) as line
from ({clock}) d
"""

# Every message and layout the parsers know, and lines they have to reject, spread over
# ten files that start with different layouts: first messages, then lines.
_MESSAGES = """
select pos, file_no, dd, ymd, mname, hms, concat('[', cast(pos as string), ']') as pid,
  case when file_no = 3 and pos < 40 then 'cron'
       when pos % 17 = 0 then 'cron' when pos % 19 = 0 then 'systemd-logind' else 'sshd' end as proc,
  case pos % 24
    when 0 then concat('Failed password for invalid user ', usr, ' from ', addr, ' port 22 ssh2')
    when 1 then concat('Failed password for ', usr, ' from ', addr, ' port 22 ssh2')
    when 2 then concat('Invalid user ', usr, ' from ', addr, ' port 22')
    when 3 then concat('Failed none for invalid user ', usr, ' from ', addr, ' port 22 ssh2')
    when 4 then concat('Failed publickey for ', usr, ' from ', addr, ' port 22 ssh2')
    when 5 then concat('pam_unix(sshd:auth): authentication failure; logname= uid=0 euid=0 tty=ssh ruser= rhost=', addr, '  user=', usr)
    when 6 then concat('Connection closed by authenticating user ', usr, ' ', addr, ' port 4000 [preauth]')
    when 7 then concat('Disconnected from authenticating user ', usr, ' ', addr, ' port 4000 [preauth]')
    when 8 then concat('Connection reset by ', usr, ' ', addr, ' port 4000 [preauth]')
    when 9 then concat('error: maximum authentication attempts exceeded for ', usr, ' from ', addr, ' port 22 ssh2 [preauth]')
    when 10 then concat('Disconnecting invalid user ', usr, ' ', addr, ' port 22: Too many authentication failures')
    when 11 then concat('reverse mapping checking getaddrinfo for x.example [', addr, '] for ', addr, ' failed - POSSIBLE BREAK-IN ATTEMPT!')
    when 12 then concat('Accepted password for ', usr, ' from ', addr, ' port 22 ssh2')
    when 13 then concat('Accepted publickey for ', usr, ' from ', addr, ' port 22 ssh2: RSA SHA256:x')
    when 14 then concat('Accepted keyboard-interactive/pam for ', usr, ' from ', addr, ' port 22 ssh2')
    when 15 then concat('Accepted gssapi-with-mic for ', usr, ' from ', addr, ' port 22 ssh2')
    when 16 then concat('Connection closed by ', addr, ' port 4000 [preauth]')
    when 17 then concat('Invalid user ', usr, ' from 999.1.1.', cast(pos % 300 as string))
    when 18 then concat('Failed password for ', usr, ' from 10.0.0.', cast(pos % 400 as string), ' port 22 ssh2')
    when 19 then concat('Received disconnect from ', addr, ': 11: bye')
    when 20 then concat('Connection reset by ', addr, ' port 4000 [preauth]')
    when 21 then concat('session opened for user ', usr)
    when 22 then concat('pam_unix(sshd:auth): authentication failure; logname= ruser=', usr, ' rhost=', addr)
    else concat('Failed password for ', usr, ' from ', addr, ' port 22 ssh2') end as info
from (select *, pos % 10 as file_no,
    case when pos % 29 = 0 then '' when pos % 31 = 0 then '01.2.3.4'
         else ip end as addr
    from ({clock}) d) e
"""

_MIXED = """
select concat('f', cast(file_no as string)) as file, pos,
  case when file_no % 5 = 0 then concat(ymd, 'T', hms, case pos % 3 when 0 then '.25+02:00' when 1 then '-05:30' else '' end, ' host1 ', proc, pid, ': ', info)
       when file_no % 5 = 1 then concat(ymd, 'T', hms, '.125000+01:00 host1 ', proc, ': ', info)
       when pos % 53 = 0 then concat(mname, ' 32 ', hms, ' host1 ', proc, pid, ': ', info)
       when pos % 59 = 0 then concat(ymd, 'T', hms, 'Z host1 ', proc, pid, ': ', info)
       else concat(case when pos % 4 = 0 then 'Dec' else mname end, ' ', dd, ' ', hms, ' host1 ', proc, pid, ': ', info) end as line
from {messages} g
"""

# lines of a layout that the parsers do not know by themselves
_DOTTED = """
select concat('d', cast(pos % 3 as string)) as file, pos,
  concat('<13> ', dd, '.', substr(ymd, 6, 2), '.', substr(ymd, 1, 4), ' ', hms, ' | ',
         case when kind = 'failed' then concat('bad login ', usr, '@', ip) else concat('good login ', usr) end) as line
from ({clock}) d
"""

# reputation dimensions of the public addresses; the last octet decides the values
_REPUTATION = """
select distinct ip, cast(regexp_extract(ip, '[0-9]+$', 0) as bigint) as o from {auth} a
where ip not like '10.%'
"""


def _duck_auth() -> str:
    return _AUTH.format(hours=_HOURS.format(base=DUCK_BASE))


def duck_views(*names: str) -> str:
    """A WITH clause defining ``auth`` and the requested views."""
    clock = _CLOCK.format(auth="auth")
    available = {
        "lines": _LINES.format(clock=clock),
        "mixed": _MIXED.format(messages=f"({_MESSAGES.format(clock=clock)})"),
        "dotted": _DOTTED.format(clock=clock),
        "rep": _REPUTATION.format(auth="auth"),
    }
    parts = [f"auth as ({_duck_auth()})"] + [f"{n} as ({available[n]})" for n in names]
    return "with " + ",\n".join(parts) + "\n"


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def auth_from(events: DataFrame) -> DataFrame:
    """The ``auth`` view over an ``events`` DataFrame, batch or streaming."""
    spark = events.sparkSession
    day = (F.year("ts").alias("yr"), F.month("ts").alias("mon"), F.day("ts").alias("dom"))
    base = events.select("event_id", "event_type", "user_id", t.micros_of(F.col("ts")).alias("us"), *day)
    timed = spark.sql(_HOURS.format(base="select * from {base}"), base=base)
    # the hour is used many times below: do not let filters repeat its derivation
    kept = ["event_id", "event_type", "user_id", "yr", "mon", "dom"]
    bound = with_struct(timed.select(*kept, "hr", "sec_of_hr"), "h", F.struct("hr", "sec_of_hr"))
    plain = bound.select(*kept, "h.hr", "h.sec_of_hr")
    return spark.sql(_AUTH.format(hours="select * from {plain}"), plain=plain)


def auth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return auth_from(events_table(spark, sf_dir))


def as_events(view: DataFrame) -> DataFrame:
    """``auth`` rows with the columns of ``auth_events``."""
    ts_us = F.col("ts_s") * 1_000_000
    return view.select(
        "pos", "kind", "ip", F.col("usr").alias("user"), "command", t.from_micros(ts_us).alias("ts"), ts_us.alias("ts_us")
    )


def as_attempts(view: DataFrame) -> DataFrame:
    """The logins among ``auth`` rows with the columns of ``attempts``."""
    ts_us = F.col("ts_s") * 1_000_000
    failed = F.col("kind") == "failed"
    return view.filter(F.col("kind").isin("failed", "success")).select(
        "pos",
        "ip",
        F.col("usr").alias("username"),
        t.from_micros(ts_us).alias("ts"),
        F.lit(None).cast("int").alias("tz_offset_min"),
        ts_us.alias("ts_us"),
        (~failed).alias("success"),
        F.when(failed & (F.col("pos") % 7 == 0), "invalid_user")
        .when(failed, "failed_password_user")
        .otherwise("accepted_password")
        .alias("event"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_events(auth(spark, sf_dir))


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_attempts(auth(spark, sf_dir))


def _over_clock(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    clock = _CLOCK.format(auth="{auth}")
    rows = auth(spark, sf_dir)
    # bound before they are used: a method that derives them as well is too large for the JIT
    names = ["kind", "ip", "usr", "command", "ts_s"]
    bound = with_struct(rows, "a", F.struct(*names)).drop(*names).select("*", "a.*").drop("a")
    return spark.sql(text.format(clock=clock), auth=bound)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _over_clock(spark, sf_dir, _LINES)


def mixed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = _over_clock(spark, sf_dir, _MESSAGES)
    # a step of its own: in one with the lines, the generated method is too large for the JIT
    bound = with_struct(messages.select("*"), "m", F.struct("proc", "info")).drop("proc", "info").select("*", "m.*").drop("m")
    return spark.sql(_MIXED.format(messages="{messages}"), messages=bound)


def dotted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _over_clock(spark, sf_dir, _DOTTED)


def reputation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_REPUTATION.format(auth="{auth}"), auth=auth(spark, sf_dir))
