"""Alerts from authentication events.

Input: ``pos, kind, ip, user, command, ts, ts_us`` (see ``auth_events``). Every detector
returns alerts ``detector, pos, type, severity, ip, user, ts, ts_us, detail, timeline``;
``(ts_us, detector, pos)`` is their report order, where ``pos`` is the order of the input.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.functions import timestamps as t
from logwarden.functions.severity import compromise_severity
from logwarden.functions.text import starts_with_any
from logwarden.operators.skew import join_facts
from logwarden.operators.sliding import window_aggregate
from logwarden.params import DEFAULTS, Params
from logwarden.session import stored

TIMELINE = (
    "array<struct<event:string,count:bigint,first_seen:timestamp_ntz,last_seen:timestamp_ntz,"
    "timestamp:timestamp_ntz,ip:string,user:string,command:string>>"
)

# Fixed value: the address of alerts that concern the host itself.
LOCALHOST = "localhost"
MANY_USERS = "<multiple>"


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _alert(rows: DataFrame, detector: str, severity, ip, user, ts_us, detail, timeline=None) -> DataFrame:
    """Project ``rows`` (with ``pos``) to the alert schema."""
    kind, rank = DETECTOR_TYPES[detector]
    return rows.select(
        F.lit(rank).alias("detector"),
        "pos",
        F.lit(kind).alias("type"),
        severity.alias("severity"),
        ip.alias("ip"),
        user.alias("user"),
        t.from_micros(ts_us).alias("ts"),
        ts_us.alias("ts_us"),
        detail.alias("detail"),
        (F.lit(None) if timeline is None else timeline).cast(TIMELINE).alias("timeline"),
    )


def _minutes(value: float) -> str:
    return str(int(value) if value == int(value) else value)


def is_off_hours(ts_us: Column, params: Params = DEFAULTS) -> Column:
    hour = t.hour_of(ts_us)
    return (hour < params.business_start) | (hour >= params.business_end)


def _clock(ts_us: Column) -> Column:
    return t.clock_text(t.from_micros(ts_us))


def off_hours_logins(events: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Accepted logins outside business hours; at night they are critical."""
    logins = events.filter((F.col("kind") == "success") & is_off_hours(F.col("ts_us"), params))
    hour, user, ip, ts_us = t.hour_of(F.col("ts_us")), F.col("user"), F.col("ip"), F.col("ts_us")
    night = (hour < 6) | (hour >= 22)
    hours = f"outside business hours ({params.business_start}:00–{params.business_end}:00)"
    when = F.when(night, "late night (22:00–06:00)").otherwise(hours)
    detail = _text(
        "Successful login by '", user, "' from ", ip, " at ", _clock(ts_us), " — ", when,
        ". Investigate whether this is an authorized session.",
    )
    return _alert(logins, "off_hours", F.when(night, "CRITICAL").otherwise("HIGH"), ip, user, ts_us, detail)


def failure_evidence(events: DataFrame, minutes: float) -> DataFrame:
    """``ip, ts_us, failures, first_us, last_us, probes`` for each distinct login (address, time).

    The failures of the same address in the ``minutes`` before the login, the login's own
    time excluded and the far end included. Logins with fewer than two are left out.
    """
    width = Params.micros(minutes)
    kind = F.col("kind")
    evidence = window_aggregate(
        events.filter(kind.isin("failed", "success")).select("ip", "ts_us", "kind"),
        keys=["ip"],
        at="ts_us",
        is_fact=kind == "failed",
        is_probe=kind == "success",
        start=-width,
        width=max(width, 1),
        measures={
            "failures": (F.lit(1).cast("bigint"), "sum"),
            "first_us": (F.col("ts_us"), "min"),
            "last_us": (F.col("ts_us"), "max"),
        },
    )
    # an empty window [p, p) has no failures
    return evidence.filter((F.col("failures") >= 2) & F.lit(width > 0))


def suspicious_logins(events: DataFrame, minutes: float) -> DataFrame:
    """Accepted logins with their failure evidence, ``pos, ip, user, ts_us, failures, …``.

    The evidence has one row per (ip, ts_us), which very many logins may share.
    """
    logins = events.filter(F.col("kind") == "success").select("pos", "ip", "user", "ts_us")
    evidence = stored(failure_evidence(events, minutes).drop("probes"))
    return join_facts(logins, evidence, ["ip", "ts_us"], "pos")


def bruteforce_success(events: DataFrame, params: Params = DEFAULTS, logins: DataFrame | None = None) -> DataFrame:
    """Accepted logins that follow at least two failures from the same address.

    ``logins`` are ``suspicious_logins`` where they are there already.
    """
    if logins is None:
        logins = suspicious_logins(events, params.bruteforce_minutes)
    n, user, ip, ts_us = F.col("failures"), F.col("user"), F.col("ip"), F.col("ts_us")
    severity = F.when(n >= 10, "CRITICAL").when(n >= 5, "HIGH").otherwise("MEDIUM")
    detail = _text(
        "IP ", ip, " had ", n, " failed login attempt(s) before successfully authenticating as '", user,
        "' at ", _clock(ts_us), ". This matches a credential brute-force success pattern. Escalate immediately.",
    )
    return _alert(logins, "bruteforce", severity, ip, user, ts_us, detail)


def privilege_escalations(events: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Every sudo and su; sensitive commands weigh more."""
    sudo = events.filter(F.col("kind") == "sudo")
    user, command, ts_us = F.col("user"), F.col("command"), F.col("ts_us")
    sensitive = starts_with_any(command, params.sensitive_commands)
    advice = F.when(sensitive, "⚠ Sensitive command — verify authorization.").otherwise("Review for compliance.")
    detail = _text("User '", user, "' executed elevated command: [", command, "] at ", _clock(ts_us), ". ", advice)
    severity = F.when(sensitive, "HIGH").otherwise("MEDIUM")
    return _alert(sudo, "escalation", severity, F.lit(LOCALHOST), user, ts_us, detail)


def unknown_user_logins(
    events: DataFrame, params: Params = DEFAULTS, known: DataFrame | None = None
) -> DataFrame:
    """Accepted logins of accounts that are not expected to exist.

    ``known`` (column ``user``) replaces the parameter for lists too long for a literal.
    """
    logins = events.filter(F.col("kind") == "success")
    if known is None:
        logins = logins.filter(~F.col("user").isin(*params.known_users))
    else:
        listed = known.select("user").distinct().withColumn("_listed", F.lit(True))
        logins = join_facts(logins, listed, ["user"], "pos", how="left").filter(F.col("_listed").isNull())
    user, ip, ts_us = F.col("user"), F.col("ip"), F.col("ts_us")
    detail = _text(
        "Successful login by unrecognized user '", user, "' from ", ip, " at ", _clock(ts_us),
        ". Verify if this account is legitimate. Could indicate backdoor account creation.",
    )
    return _alert(logins, "unknown_user", F.lit("HIGH"), ip, user, ts_us, detail)


def last_bursts(events: DataFrame, minutes: float) -> DataFrame:
    """``ip, pos, last_us, failures``: failures up to the last one of each address.

    Counts the ``minutes`` before the last failure, both ends included. ``pos`` is the
    address's first failure. Only the two blocks of time that the window touches are
    joined, on (ip, block), after counting per distinct time.
    """
    width = Params.micros(minutes)
    failures = events.filter(F.col("kind") == "failed").select("ip", "ts_us", "pos")
    block = lambda c: t.floor_div(c, width + 1)
    lasts = failures.groupBy("ip").agg(F.max("ts_us").alias("last_us"), F.min("pos").alias("pos"))
    blocks = F.array_distinct(F.array(block(F.col("last_us")), block(F.col("last_us") - width)))
    touched = lasts.withColumn("block", F.explode(blocks))
    counted = failures.groupBy("ip", block(F.col("ts_us")).alias("block"), "ts_us").agg(F.count("*").alias("n"))
    inside = F.col("ts_us") >= F.col("last_us") - width
    return (
        counted.join(touched, ["ip", "block"])
        .filter(inside)
        .groupBy("ip", "pos", "last_us")
        .agg(F.sum("n").alias("failures"))
    )


def failed_login_bursts(events: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Addresses with many failures shortly before, and including, their last one."""
    bursts = last_bursts(events, params.burst_minutes).filter(F.col("failures") >= params.burst_min_failures)
    detail = _text(
        F.col("failures"), " failed logins from ", F.col("ip"), f" within {_minutes(params.burst_minutes)} minutes."
    )
    return _alert(
        bursts, "burst", F.lit("MEDIUM"), F.col("ip"), F.lit(MANY_USERS), F.col("last_us"), detail
    )


def first_escalations(logins: DataFrame, events: DataFrame, minutes: float) -> DataFrame:
    """``user, ts_us, sudo, probes``: the first sudo, in log order, of the user after each login time.

    Both ends of the ``minutes`` after the login count. ``sudo`` is ``pos, ts_us, command``.
    """
    sudo = events.filter(F.col("kind") == "sudo").select(
        "user",
        "ts_us",
        F.struct("pos", "ts_us", "command").alias("sudo"),
    )
    probes = logins.select("user", "ts_us").withColumn("sudo", F.lit(None).cast(sudo.schema["sudo"].dataType))
    fact = F.col("sudo").isNotNull()
    return window_aggregate(
        sudo.unionByName(probes),
        keys=["user"],
        at="ts_us",
        is_fact=fact,
        is_probe=~fact,
        start=0,
        width=Params.micros(minutes) + 1,
        measures={"sudo": (F.col("sudo"), "min")},
    )


def account_compromises(events: DataFrame, params: Params = DEFAULTS, logins: DataFrame | None = None) -> DataFrame:
    """Failures, then a login from the same address, then a sudo of the same user.

    Each alert carries its three-step timeline. ``logins`` are ``suspicious_logins`` where they
    are there already; they are read twice.
    """
    if logins is None:
        logins = stored(suspicious_logins(events, params.compromise_minutes))
    escalations = stored(first_escalations(logins, events, params.compromise_minutes).drop("probes"))
    chains = join_facts(logins, escalations, ["user", "ts_us"], "pos")
    n, user, ip, ts_us = F.col("failures"), F.col("user"), F.col("ip"), F.col("ts_us")
    sudo_us, command = F.col("sudo.ts_us"), F.col("sudo.command")
    severity = compromise_severity(
        n, starts_with_any(command, params.sensitive_commands), is_off_hours(ts_us, params)
    )
    detail = _text(
        "Correlation detected: ", n, " failed login(s) from ", ip,
        " followed by successful login and privilege escalation for '", user, "'.",
    )
    none = F.lit(None)
    steps = [
        ("FAILED_LOGIN_BURST", n, t.from_micros(F.col("first_us")), t.from_micros(F.col("last_us")), none, none, none, none),
        ("LOGIN_SUCCESS", none, none, none, t.from_micros(ts_us), ip, user, none),
        ("PRIVILEGE_ESCALATION", none, none, none, t.from_micros(sudo_us), none, none, command),
    ]
    names = ("event", "count", "first_seen", "last_seen", "timestamp", "ip", "user", "command")
    types = ("string", "bigint", *["timestamp_ntz"] * 3, *["string"] * 3)

    def step(name, *values):
        columns = zip(names, types, (F.lit(name), *values))
        return F.struct(*[value.cast(kind).alias(field) for field, kind, value in columns])

    timeline = F.array(*[step(*s) for s in steps])
    return _alert(chains, "compromise", severity, ip, user, sudo_us, detail, timeline)


Detector = Callable[[DataFrame, Params], DataFrame]

# Alert type and report order of each detector.
DETECTOR_TYPES = {
    "off_hours": ("OFF_HOURS_LOGIN", 1),
    "bruteforce": ("BRUTEFORCE_SUCCESS", 2),
    "escalation": ("PRIVILEGE_ESCALATION", 3),
    "unknown_user": ("UNKNOWN_USER_LOGIN", 4),
    "burst": ("FAILED_LOGIN_BURST", 5),
    "compromise": ("ACCOUNT_COMPROMISE", 6),
}

DETECTORS: dict[str, Detector] = {
    "off_hours": off_hours_logins,
    "bruteforce": bruteforce_success,
    "escalation": privilege_escalations,
    "unknown_user": unknown_user_logins,
    "burst": failed_login_bursts,
    "compromise": account_compromises,
}


def all_alerts(
    events: DataFrame, params: Params = DEFAULTS, detectors: dict[str, Detector] | None = None
) -> DataFrame:
    """The bag union of all detectors. Sort with ``in_report_order`` when order matters.

    Events are read once per detector; pass a stored table (or a persisted DataFrame). Logins
    after failures, which two detectors look at, are found once per width of their window.
    """
    widths = {bruteforce_success: params.bruteforce_minutes, account_compromises: params.compromise_minutes}
    suspicious: dict[float, DataFrame] = {}
    found = []
    for detect in (detectors or DETECTORS).values():
        if detect not in widths:
            found.append(detect(events, params))
            continue
        minutes = widths[detect]
        if minutes not in suspicious:
            suspicious[minutes] = stored(suspicious_logins(events, minutes))
        found.append(detect(events, params, suspicious[minutes]))
    return reduce(DataFrame.unionByName, found)


def in_report_order(alerts: DataFrame) -> DataFrame:
    """By time; ties keep detector order, then input order."""
    return alerts.orderBy("ts_us", "detector", "pos")
