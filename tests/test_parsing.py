"""Log text to events and attempts."""

import pytest
from pyspark.sql import functions as F

from logwarden.operators import attempts as a
from logwarden.operators.attempt_rules import RULES, Rule
from logwarden.operators.auth_events import auth_events
from logwarden.operators.formats import FORMATS, AsOf, LogFormat, format_index, format_names
from logwarden.sources.lines import list_files, read_lines

AS_OF = AsOf(2026, 6)


def scan(spark, path, **options):
    return a.scan_lines(read_lines(spark, path, undecodable="drop"), AS_OF, **options)


def found(spark, path, **options):
    rows = a.attempts(scan(spark, path, **options)).orderBy("pos").collect()
    return [(r.ip, r.username, r.event, r.success) for r in rows]


def sshd(message, pid="[123]", at="May 26 10:00:00"):
    return f"{at} server sshd{pid}: {message}"


# --- scanning -------------------------------------------------------------------------


def test_all_line_ends_count(spark, log_file):
    path = log_file(b"one\r\ntwo\nthree\rfour")
    assert [r.line for r in read_lines(spark, path).orderBy("pos").collect()] == ["one", "two", "three", "four"]


def test_undecodable_bytes(spark, log_file):
    path = log_file(b"a\xffb\n", b"\x00\x01c\n")
    assert [r.line for r in read_lines(spark, path).orderBy("pos").collect()] == ["a�b", "\x00\x01c"]
    assert [r.line for r in read_lines(spark, path, "drop").orderBy("pos").collect()] == ["ab", "\x00\x01c"]
    with pytest.raises(ValueError):
        read_lines(spark, path, "strict")


def test_line_order_across_splits(spark, log_file):
    path = log_file(*[f"line {i}" for i in range(5000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        lines = read_lines(spark, path)
        assert lines.rdd.getNumPartitions() > 5
        assert [r.line for r in lines.orderBy("pos").collect()] == [f"line {i}" for i in range(5000)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


# --- events ---------------------------------------------------------------------------


def events(spark, path):
    rows = auth_events(read_lines(spark, path), 2026).orderBy("pos").collect()
    return [(r.kind, r.ip, r.user, r.command, f"{r.ts:%m-%d %H:%M:%S}") for r in rows]


def test_event_lines(spark, log_file):
    path = log_file(
        sshd("Failed password for root from 1.2.3.4 port 22 ssh2"),
        sshd("Failed password for invalid user eve from not-an-ip port 22 ssh2"),
        sshd("Accepted publickey for git from ::1 port 22 ssh2"),
        sshd("Accepted keyboard-interactive/pam for git from ::1 port 22 ssh2"),
        "may  6 1:2:3 h sudo[9]:   john : TTY=x ; COMMAND=/bin/ls COMMAND=  /bin/cat x  ",
        "May 26 10:00:00 h sudo: john : COMMAND=/bin/ls",
        "May 26 10:00:00 h su[12]: Successful su for root by john",
        "2026-05-26T10:00:00 h sshd[1]: Failed password for root from 1.2.3.4 port 22",
        sshd("Failed password for root from 1.2.3.4"),
    )
    assert events(spark, path) == [
        ("failed", "1.2.3.4", "root", None, "05-26 10:00:00"),
        ("failed", "not-an-ip", "eve", None, "05-26 10:00:00"),
        ("success", "::1", "git", None, "05-26 10:00:00"),
        ("sudo", None, "john", "/bin/cat x", "05-06 01:02:03"),
        ("sudo", None, "john", "su to root", "05-26 10:00:00"),
    ]


def test_bad_time_consumes_the_line(spark, log_file):
    both = "sshd[1]: Failed password for root from 1.2.3.4 port 22 sshd[1]: Accepted password for root from 1.2.3.4 port 22"
    path = log_file(f"May 32 10:00:00 h {both}", f"Feb 29 10:00:00 h {both}", f"May 26 10:00:60 h {both}")
    assert events(spark, path) == []


# --- attempts -------------------------------------------------------------------------

MESSAGES = [
    ("Failed password for invalid user eve from 1.2.3.4 port 22 ssh2", "eve", "failed_password_invalid", False),
    ("Failed password for root from 1.2.3.4 port 22 ssh2", "root", "failed_password_user", False),
    ("Invalid user eve from 1.2.3.4 port 22", "eve", "invalid_user", False),
    ("Failed none for invalid user eve from 1.2.3.4 port 22 ssh2", "eve", "failed_none", False),
    ("Failed publickey for root from 1.2.3.4 port 22 ssh2", "root", "failed_publickey", False),
    ("pam_unix(sshd:auth): authentication failure; logname= ruser= rhost=1.2.3.4  user=root", "<unknown>", "authentication_failure", False),
    ("Connection closed by authenticating user root 1.2.3.4 port 22 [preauth]", "root", "connection_closed_preauth", False),
    ("Disconnected from authenticating user root 1.2.3.4 port 22 [preauth]", "root", "disconnected_preauth", False),
    ("Connection reset by root 1.2.3.4 port 22 [preauth]", "root", "connection_reset_preauth", False),
    ("error: maximum authentication attempts exceeded for root from 1.2.3.4 port 22", "root", "max_auth_attempts", False),
    ("Disconnecting invalid user eve 1.2.3.4 port 22: Too many authentication failures", "eve", "too_many_auth_failures", False),
    ("reverse mapping checking getaddrinfo for x [1.2.3.4] for 1.2.3.4 failed - POSSIBLE BREAK-IN ATTEMPT!", "<unknown>", "break_in_attempt", False),
    ("Accepted password for root from 1.2.3.4 port 22 ssh2", "root", "accepted_password", True),
    ("Accepted publickey for root from 1.2.3.4 port 22 ssh2", "root", "accepted_publickey", True),
    ("Accepted keyboard-interactive/pam for root from 1.2.3.4 port 22 ssh2", "root", "accepted_keyboard_interactive", True),
    ("Accepted gssapi-with-mic for root from 1.2.3.4 port 22 ssh2", "root", "accepted_gssapi", True),
]


def test_every_rule(spark, log_file):
    assert [m[2] for m in MESSAGES] == [r.event for r in RULES]
    path = log_file(*[sshd(m[0]) for m in MESSAGES])
    assert found(spark, path) == [("1.2.3.4", user, event, ok) for _, user, event, ok in MESSAGES]


def test_lines_that_yield_nothing(spark, log_file):
    path = log_file(
        sshd("Connection closed by 1.2.3.4 port 22 [preauth]"),  # the name swallows the address
        sshd("Invalid user eve from 2001:db8::1 port 22"),  # only digits and dots are looked at first
        sshd("Invalid user eve from 999.1.1.1 port 22"),
        sshd("Failed password for root from 256.1.1.1 port 22"),
        sshd("session opened for user root"),
        "",
        "garbage",
    )
    assert found(spark, path) == []


def test_v6_addresses(spark, log_file):
    path = log_file(
        sshd("Failed password for root from 2001:db8::1 port 22"), sshd("Invalid user eve from fe80::1 port 22")
    )
    assert found(spark, path) == [
        ("2001:db8::1", "root", "failed_password_user", False),
        ("fe80::1", "eve", "invalid_user", False),
    ]


def test_hostile_names_are_data(spark, log_file):
    names = ["'; DROP TABLE users; --", "$(rm -rf /)", "<script>alert(1)</script>", "\x1b[31mred\x1b[0m", "../../etc/passwd", "a" * 10_000]
    names = [n.replace(" ", "_") for n in names]
    path = log_file(*[sshd(f"Failed password for {n} from 1.2.3.4 port 22") for n in names])
    assert [f[1] for f in found(spark, path)] == names


def test_duplicates_are_kept_and_long_lines_pass(spark, log_file):
    line = sshd("Invalid user admin from 192.0.2.10 port 5555")
    path = log_file(*[line] * 1000, "x" * 100_000)
    assert len(found(spark, path)) == 1000


FAIL = "Failed password for root from 1.2.3.4 port 22 ssh2"


def test_first_readable_line_fixes_the_layout_per_file(spark, tmp_path, log_file):
    log_file("noise", "May 26 10:00:00 h cron[1]: x", "May 26 10:00:00 h other[1]: " + FAIL, name="generic.log")
    log_file(sshd(FAIL), "May 26 10:00:00 h other[1]: " + FAIL, f"2026-05-26T10:00:00 h sshd[1]: {FAIL}", name="rhel.log")
    log_file(f"2026-05-26T10:00:00+02:00 h other[1]: {FAIL}", f"2026-05-26T10:00:00 h sshd: {FAIL}", sshd(FAIL), name="iso.log")
    log_file(f"2026-05-26T10:00:00.5+02:00 h sshd: {FAIL}", f"2026-05-26T10:00:00 h sshd[1]: {FAIL}", name="journald.log")
    log_file("nothing here", name="none.log")
    scanned = scan(spark, str(tmp_path))
    stats = a.with_format_name(a.parse_stats(scanned)).collect()
    got = {r.file.rsplit("/", 1)[1]: (r.format, r.lines_read, r.format_matches, r.extract_matches) for r in stats}
    assert got == {
        "generic.log": ("Generic syslog", 3, 2, 1),
        "rhel.log": ("CentOS/RHEL (syslog)", 3, 1, 1),
        "iso.log": ("Ubuntu/Debian (ISO 8601)", 3, 1, 1),
        "journald.log": ("systemd journald", 2, 1, 1),
        "none.log": (None, 1, 0, 0),
    }


def test_forced_layout(spark, log_file):
    path = log_file(sshd(FAIL), "May 26 10:00:00 h other[1]: " + FAIL)
    assert len(found(spark, path)) == 1
    assert len(found(spark, path, format="generic SYSLOG")) == 2
    assert found(spark, path, format="systemd journald") == []
    with pytest.raises(ValueError):
        format_index("no such layout")
    assert format_names()[0] == "Ubuntu/Debian (ISO 8601)"


def test_layout_per_line(spark, log_file):
    path = log_file(sshd(FAIL), f"2026-05-26T10:00:00 h sshd[1]: {FAIL}", "May 26 10:00:00 h other[1]: " + FAIL)
    assert len(found(spark, path, sticky=False)) == 3


def test_year_rollover_and_offsets(spark, log_file):
    path = log_file(sshd(FAIL, at="Jun 30 23:59:59"), sshd(FAIL, at="Jul  1 00:00:00"), sshd(FAIL, at="jul  1 00:00:00"))
    rows = scan(spark, path).orderBy("pos").collect()
    assert [r.ts and f"{r.ts:%Y-%m-%d}" for r in rows] == ["2026-06-30", "2025-07-01", None]
    path = log_file(f"2026-05-26T10:00:00.123456789+02:00 h sshd[1]: {FAIL}", name="iso.log")
    row = scan(spark, path).first()
    assert (str(row.ts), row.tz_offset_min, row.ts_us % 86_400_000_000) == ("2026-05-26 10:00:00.123456", 120, 28_800_123_456)


def test_failed_times_are_counted(spark, log_file):
    path = log_file(sshd(FAIL), sshd(FAIL, at="May 32 10:00:00"), sshd(FAIL, at="May 26 25:61:61"), sshd(FAIL, at="Feb 29 10:00:00"))
    stats = a.parse_stats(scan(spark, path)).first()
    assert (stats.lines_read, stats.format_matches, stats.extract_matches, stats.failed_timestamps) == (4, 4, 1, 3)


def test_stats_keep_line_order_and_empty_files(spark, tmp_path, log_file):
    log_file(sshd(FAIL, at="May 26 12:00:00"), sshd("x", at="May 25 09:00:00"), sshd("x", at="May 26 11:00:00"), name="a.log")
    log_file(name="empty.log")
    stats = a.parse_stats(scan(spark, str(tmp_path)), list_files(spark, str(tmp_path)))
    got = {r.file.rsplit("/", 1)[1]: r for r in stats.collect()}
    assert (str(got["a.log"].first_ts), str(got["a.log"].last_ts)) == ("2026-05-26 12:00:00", "2026-05-26 11:00:00")
    empty = got["empty.log"]
    assert (empty.lines_read, empty.format_matches, empty.extract_matches, empty.failed_timestamps) == (0, 0, 0, 0)
    assert empty.first_ts is None and empty.format is None


def test_more_rules_and_layouts(spark, log_file):
    path = log_file("<13> 26.05.2026 10:00 | bad login bob@1.2.3.4")
    layout = LogFormat(
        "dotted",
        r"^<\d+> (\S+ \S+) \| (.*)$",
        2,
        fields=lambda line: F.array(F.regexp_extract(line, r"> (\S+ \S+)", 1)),
        clock=lambda fields, as_of: F.try_to_timestamp(F.get(fields, 0), F.lit("dd.MM.yyyy HH:mm")).cast("timestamp_ntz"),
    )
    rule = Rule("bad_login", r"bad login (\w+)@([\d.]+)")
    assert found(spark, path, formats=(*FORMATS, layout), rules=(*RULES, rule)) == [("1.2.3.4", "bob", "bad_login", False)]


def test_each_line_is_matched_once(spark, log_file):
    """Filters must not push the pattern cascade through a projection and repeat it."""
    path = log_file(sshd(FAIL))
    plan = auth_events(read_lines(spark, path), 2026)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Failed password for (?:") == 1
    plan = a.attempts(scan(spark, path, format="Generic syslog"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("accepted_gssapi") == 1


def test_line_order_goes_through_the_parts_of_a_log(spark, tmp_path):
    from logwarden.plans.detections import event_table

    # the scan takes larger files first, whatever their names
    sizes, names, n = (1, 40, 3), [], 0
    for part, size in enumerate(sizes):
        users = [f"u{n + i}" for i in range(size)]
        n += size
        names += users
        lines = [f"Jan 05 10:00:00 host1 sshd[1]: Failed password for {u} from 10.0.0.1 port 22 ssh2\n" for u in users]
        (tmp_path / f"part-{part:05}.txt").write_text("".join(lines))
    rows = event_table(spark, str(tmp_path), 2026).orderBy("pos").collect()
    assert [r.user for r in rows] == names and len({r.pos for r in rows}) == n
