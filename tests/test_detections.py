"""Detections: a small log with known alerts, and brute force over random events."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from logwarden.functions import timestamps as t
from logwarden.operators import detections as d
from logwarden.operators import rollups
from logwarden.params import KNOWN_USERS, SENSITIVE_COMMANDS, Params
from logwarden.plans import detections as plan


def failures(ip, count, last, user="root"):
    """``count`` failed logins, one every second, the last at ``last``."""
    h, m, s = map(int, last.split(":"))
    total = h * 3600 + m * 60 + s
    out = []
    for back in reversed(range(count)):
        at = total - back
        clock = f"{at // 3600:02d}:{at % 3600 // 60:02d}:{at % 60:02d}"
        out.append(f"May 26 {clock} srv sshd[100]: Failed password for {user} from {ip} port 22 ssh2")
    return out


def accepted(user, ip, at):
    return f"May 26 {at} srv sshd[100]: Accepted password for {user} from {ip} port 22 ssh2"


def sudo(user, command, at):
    return f"May 26 {at} srv sudo[200]:   {user} : TTY=pts/0 ; PWD=/ ; USER=root ; COMMAND={command}"


SAMPLE = [
    *failures("185.72.33.10", 6, "02:13:11"),
    accepted("root", "185.72.33.10", "02:13:13"),
    *failures("92.118.160.22", 8, "03:44:35"),
    accepted("developer", "203.0.113.45", "08:15:10"),
    sudo("developer", "/bin/bash", "08:15:12"),
    *failures("45.33.32.156", 5, "09:30:08"),
    sudo("john", "/usr/bin/passwd root", "11:00:05"),
    sudo("john", "/bin/su", "11:00:10"),
    *failures("103.25.59.88", 5, "14:22:19"),
    accepted("ubuntu", "103.25.59.88", "14:22:21"),
    accepted("newuser", "10.0.0.55", "16:05:00"),
    *[
        f"May 26 {at} srv sshd[100]: Failed password for invalid user root from 77.88.55.66 port 22 ssh2"
        for at in ("23:58:01", "23:58:03", "23:58:05", "23:58:07", "23:58:09")
    ],
    accepted("root", "77.88.55.66", "23:58:11"),
    sudo("root", "/bin/bash", "23:59:00"),
]

NIGHT = "late night (22:00–06:00). Investigate whether this is an authorized session."
PATTERN = "This matches a credential brute-force success pattern. Escalate immediately."
SENSITIVE = "⚠ Sensitive command — verify authorization."

# The alerts of the sample log, in report order.
EXPECTED = [
    ("FAILED_LOGIN_BURST", "MEDIUM", "185.72.33.10", "<multiple>", "02:13:11", "6 failed logins from 185.72.33.10 within 10 minutes."),
    ("OFF_HOURS_LOGIN", "CRITICAL", "185.72.33.10", "root", "02:13:13", f"Successful login by 'root' from 185.72.33.10 at 02:13:13 — {NIGHT}"),
    ("BRUTEFORCE_SUCCESS", "HIGH", "185.72.33.10", "root", "02:13:13", f"IP 185.72.33.10 had 6 failed login attempt(s) before successfully authenticating as 'root' at 02:13:13. {PATTERN}"),
    ("FAILED_LOGIN_BURST", "MEDIUM", "92.118.160.22", "<multiple>", "03:44:35", "8 failed logins from 92.118.160.22 within 10 minutes."),
    ("OFF_HOURS_LOGIN", "HIGH", "203.0.113.45", "developer", "08:15:10", "Successful login by 'developer' from 203.0.113.45 at 08:15:10 — outside business hours (9:00–18:00). Investigate whether this is an authorized session."),
    ("PRIVILEGE_ESCALATION", "HIGH", "localhost", "developer", "08:15:12", f"User 'developer' executed elevated command: [/bin/bash] at 08:15:12. {SENSITIVE}"),
    ("FAILED_LOGIN_BURST", "MEDIUM", "45.33.32.156", "<multiple>", "09:30:08", "5 failed logins from 45.33.32.156 within 10 minutes."),
    ("PRIVILEGE_ESCALATION", "HIGH", "localhost", "john", "11:00:05", f"User 'john' executed elevated command: [/usr/bin/passwd root] at 11:00:05. {SENSITIVE}"),
    ("PRIVILEGE_ESCALATION", "HIGH", "localhost", "john", "11:00:10", f"User 'john' executed elevated command: [/bin/su] at 11:00:10. {SENSITIVE}"),
    ("FAILED_LOGIN_BURST", "MEDIUM", "103.25.59.88", "<multiple>", "14:22:19", "5 failed logins from 103.25.59.88 within 10 minutes."),
    ("BRUTEFORCE_SUCCESS", "HIGH", "103.25.59.88", "ubuntu", "14:22:21", f"IP 103.25.59.88 had 5 failed login attempt(s) before successfully authenticating as 'ubuntu' at 14:22:21. {PATTERN}"),
    ("UNKNOWN_USER_LOGIN", "HIGH", "10.0.0.55", "newuser", "16:05:00", "Successful login by unrecognized user 'newuser' from 10.0.0.55 at 16:05:00. Verify if this account is legitimate. Could indicate backdoor account creation."),
    ("FAILED_LOGIN_BURST", "MEDIUM", "77.88.55.66", "<multiple>", "23:58:09", "5 failed logins from 77.88.55.66 within 10 minutes."),
    ("OFF_HOURS_LOGIN", "CRITICAL", "77.88.55.66", "root", "23:58:11", f"Successful login by 'root' from 77.88.55.66 at 23:58:11 — {NIGHT}"),
    ("BRUTEFORCE_SUCCESS", "HIGH", "77.88.55.66", "root", "23:58:11", f"IP 77.88.55.66 had 5 failed login attempt(s) before successfully authenticating as 'root' at 23:58:11. {PATTERN}"),
    ("PRIVILEGE_ESCALATION", "HIGH", "localhost", "root", "23:59:00", f"User 'root' executed elevated command: [/bin/bash] at 23:59:00. {SENSITIVE}"),
    ("ACCOUNT_COMPROMISE", "CRITICAL", "77.88.55.66", "root", "23:59:00", "Correlation detected: 5 failed login(s) from 77.88.55.66 followed by successful login and privilege escalation for 'root'."),
]


@pytest.fixture(scope="module")
def sample(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("sample") / "auth.log"
    path.write_text("\n".join(SAMPLE) + "\n")
    return plan.detect(spark, str(path), year=2026).collect()


def test_sample_log_gives_the_known_alerts_in_order(sample):
    got = [(r.type, r.severity, r.ip, r.user, f"{r.ts:%H:%M:%S}", r.detail) for r in sample]
    assert got == EXPECTED
    assert {f"{r.ts:%Y-%m-%d}" for r in sample} == {"2026-05-26"}


def test_compromise_timeline(sample):
    steps = next(r.timeline for r in sample if r.type == "ACCOUNT_COMPROMISE")
    assert [s.event for s in steps] == ["FAILED_LOGIN_BURST", "LOGIN_SUCCESS", "PRIVILEGE_ESCALATION"]
    burst, login, sudo_step = steps
    assert (burst["count"], f"{burst.first_seen:%H:%M:%S}", f"{burst.last_seen:%H:%M:%S}") == (5, "23:58:01", "23:58:09")
    assert (f"{login.timestamp:%H:%M:%S}", login.ip, login.user) == ("23:58:11", "77.88.55.66", "root")
    assert (f"{sudo_step.timestamp:%H:%M:%S}", sudo_step.command) == ("23:59:00", "/bin/bash")


def test_sample_rollups(spark, sample):
    alerts = spark.createDataFrame(sample)
    types = [(r.type, r["count"]) for r in rollups.type_counts(alerts).collect()]
    assert types == [
        ("FAILED_LOGIN_BURST", 5),
        ("PRIVILEGE_ESCALATION", 4),
        ("OFF_HOURS_LOGIN", 3),
        ("BRUTEFORCE_SUCCESS", 3),
        ("UNKNOWN_USER_LOGIN", 1),
        ("ACCOUNT_COMPROMISE", 1),
    ]
    texts = {r.ip: r.severities for r in rollups.flagged_ips(alerts).collect()}
    assert texts == {
        "10.0.0.55": "HIGH:1",
        "103.25.59.88": "MEDIUM:1  HIGH:1",
        "185.72.33.10": "MEDIUM:1  CRITICAL:1  HIGH:1",
        "203.0.113.45": "HIGH:1",
        "45.33.32.156": "MEDIUM:1",
        "77.88.55.66": "CRITICAL:2  MEDIUM:1  HIGH:1",
        "92.118.160.22": "MEDIUM:1",
    }
    counts = {r.severity: r["count"] for r in rollups.severity_counts(alerts).collect()}
    assert counts == {"CRITICAL": 3, "HIGH": 9, "MEDIUM": 5, "LOW": 0}
    assert rollups.unique_ips(alerts).first().asDict() == {"attacker_ips": 7, "all_ips": 8}


# --- brute force over random events ---------------------------------------------------


def random_events(seed, n=400, span=4000, base=0):
    rng = random.Random(seed)
    rows = []
    for pos in range(n):
        kind = rng.choice(["failed", "failed", "failed", "success", "sudo"])
        ip = "1.1.1.1" if rng.random() < 0.4 else f"2.2.2.{rng.randrange(4)}"
        user = "root" if rng.random() < 0.5 else rng.choice(["john", "eve"])
        rows.append((pos, kind, ip, user, rng.choice(["/bin/bash", "/bin/ls"]), base + rng.randrange(span)))
    return rows


def as_events(spark, rows):
    df = spark.createDataFrame(rows, "pos bigint, kind string, ip string, user string, command string, s bigint")
    us = F.col("s") * 1_000_000
    return df.withColumns({"ts_us": us, "ts": t.from_micros(us)})


def expected_chains(rows, window):
    """Per login position: failures, first, last and first later sudo, by nested loops."""
    by_ip, by_user = defaultdict(list), defaultdict(list)
    for pos, kind, ip, user, command, s in rows:
        if kind == "failed":
            by_ip[ip].append(s)
        if kind == "sudo":
            by_user[user].append((pos, s, command))
    out = {}
    for pos, kind, ip, user, _, s in rows:
        if kind == "success":
            prior = [f for f in by_ip[ip] if s - window <= f < s]
            if len(prior) >= 2:
                later = [x for x in by_user[user] if s <= x[1] <= s + window]
                out[pos] = (len(prior), min(prior), max(prior), later[0] if later else None)
    return out


@pytest.mark.parametrize("seed, minutes, base", [(1, 1, 0), (2, 30, -2000), (3, 0.05, 17), (4, 200, -100_000)])
def test_windows_equal_nested_loops(spark, seed, minutes, base):
    rows = random_events(seed, base=base)
    events = as_events(spark, rows)
    window = minutes * 60
    want = expected_chains(rows, window)

    logins = d.suspicious_logins(events, minutes)
    got = {r.pos: (r.failures, r.first_us // 10**6, r.last_us // 10**6) for r in logins.collect()}
    assert got == {pos: chain[:3] for pos, chain in want.items()}

    sudo_rows = d.first_escalations(logins, events, minutes).collect()
    found = {(r.user, r.ts_us // 10**6): tuple(r.sudo) for r in sudo_rows}
    user_at = {pos: (user, s) for pos, _, _, user, _, s in rows}
    for pos, (_, _, _, later) in want.items():
        got_sudo = found.get(user_at[pos])
        assert (got_sudo and (got_sudo[0], got_sudo[1] // 10**6, got_sudo[2])) == later

    bursts = {r.ip: r.failures for r in d.last_bursts(events, minutes).collect()}
    want_bursts = {}
    for ip in {r[2] for r in rows}:
        times = [r[5] for r in rows if r[1] == "failed" and r[2] == ip]
        if times:
            want_bursts[ip] = sum(max(times) - x <= window for x in times)
    assert bursts == want_bursts


def test_zero_window_finds_no_bruteforce(spark):
    events = as_events(spark, random_events(5))
    assert d.bruteforce_success(events, Params(bruteforce_minutes=0)).isEmpty()
    assert d.account_compromises(events, Params(compromise_minutes=0)).isEmpty()


def test_one_address_at_one_instant(spark):
    """All logins of one address at one time: one evidence row, joined to every login."""
    rows = [(i, "failed", "1.1.1.1", "root", "", 100) for i in range(3)]
    rows += [(10 + i, "success", "1.1.1.1", "root", "", 101) for i in range(500)]
    alerts = d.bruteforce_success(as_events(spark, rows))
    assert alerts.count() == 500
    assert d.failure_evidence(as_events(spark, rows), 30).count() == 1


def test_burst_is_anchored_at_the_last_failure(spark):
    rows = [(i, "failed", "1.1.1.1", "root", "", i) for i in range(20)]  # an early burst
    rows += [(50, "failed", "1.1.1.1", "root", "", 5000)]
    assert d.failed_login_bursts(as_events(spark, rows)).isEmpty()


def test_window_borders(spark):
    w = 1800
    at = lambda *ts: [(i, "failed", "1.1.1.1", "root", "", x) for i, x in enumerate(ts)]
    login = [(100, "success", "1.1.1.1", "root", "", 3 * w)]
    count = lambda rows: [r.failures for r in d.suspicious_logins(as_events(spark, rows), 30).collect()]
    assert count(at(2 * w, 3 * w - 1) + login) == [2]  # the far end counts
    assert count(at(2 * w - 1, 3 * w - 1) + login) == []  # just outside
    assert count(at(2 * w, 3 * w) + login) == []  # the login's own time does not count


def test_registry_takes_other_detectors(spark):
    events = as_events(spark, random_events(7))
    only = d.all_alerts(events, Params(), {"escalation": d.privilege_escalations})
    assert {r.type for r in only.select("type").distinct().collect()} == {"PRIVILEGE_ESCALATION"}


def test_known_users_from_a_table(spark):
    events = as_events(spark, random_events(8))
    known = spark.createDataFrame([("root",), ("john",)], "user string")
    by_table = d.unknown_user_logins(events, known=known).select("pos").collect()
    by_list = d.unknown_user_logins(events, Params(known_users=("root", "john"))).select("pos").collect()
    assert sorted(by_table) == sorted(by_list) != []


def test_defaults():
    assert Params().known_users == KNOWN_USERS == Params(known_users=()).known_users
    assert "/bin/sh" in SENSITIVE_COMMANDS
