"""Threat summary: classification, order, limits, sinks."""

import csv
import glob
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from logwarden.functions import timestamps as t
from logwarden.functions.severity import classify_threat
from logwarden.operators import threat as th
from logwarden.operators.formats import AsOf
from logwarden.params import Params
from logwarden.plans.threat_summary import summarize
from logwarden.sources.ip_lists import read_blocklist, read_whitelist
from logwarden.sources.sinks import append_blocklist

START = datetime(2026, 5, 26, 10, 0, 0)


def attempts(spark, rows):
    """Rows of (ip, seconds after start, success[, username[, event]])."""
    full = []
    for pos, row in enumerate(rows):
        ip, seconds, success, user, event = (*row, "root", "failed_password_user")[:5] if len(row) == 3 else (*row, "failed_password_user")[:5]
        full.append((pos, ip, user, START + timedelta(seconds=seconds), success, event))
    df = spark.createDataFrame(full, "pos bigint, ip string, username string, ts timestamp_ntz, success boolean, event string")
    return df.withColumns({"ts_us": t.micros_of(F.col("ts")), "tz_offset_min": F.lit(None).cast("int")})


def by_ip(df):
    return {r.ip: r for r in df.collect()}


@pytest.mark.parametrize(
    "n, rate, minutes, want",
    [(10, 3.0, 5, "CRITICAL"), (6, 1.5, 5, "HIGH"), (60, 0.5, 60, "HIGH"), (25, 0.5, 60, "MEDIUM"), (4, 1.2, 60, "MEDIUM"), (5, 0.2, 60, "LOW")],
)
def test_classes(spark, n, rate, minutes, want):
    got = spark.range(1).select(classify_threat(F.lit(n), F.lit(rate), F.lit(minutes * t.MINUTE_US), Params()))
    assert got.first()[0] == want


def test_many_in_a_second_are_critical(spark):
    rows = [("8.8.8.8", i / 10_000, False) for i in range(10_000)]
    row = th.ip_summary(attempts(spark, rows)).first()
    assert (row.attempts, row.severity, row.attack_rate) == (10_000, "CRITICAL", 10_000.0)


def test_no_time_span(spark):
    row = th.ip_summary(attempts(spark, [("8.8.8.8", 0, False)] * 100)).first()
    assert (row.duration_us, row.attack_rate, row.severity) == (0, 100.0, "CRITICAL")


def test_thresholds(spark):
    rows = [(f"8.8.8.{n}", s, False) for n in (10, 20, 50, 9, 51) for s in range(n)]
    got = by_ip(th.ip_summary(attempts(spark, rows), Params(max_attempts=10)))
    assert {ip: r.attempts for ip, r in got.items()} == {f"8.8.8.{n}": n for n in (10, 20, 50, 9, 51)}
    assert got["8.8.8.9"].severity == "MEDIUM" and got["8.8.8.10"].severity == "CRITICAL"


def test_successes_widen_the_span_but_do_not_count(spark):
    rows = [("8.8.8.8", 0, True), ("8.8.8.8", 60, False), ("8.8.8.8", 660, False), ("9.9.9.9", 0, True)]
    got = by_ip(th.ip_summary(attempts(spark, rows)))
    assert set(got) == {"8.8.8.8"}
    assert (got["8.8.8.8"].attempts, got["8.8.8.8"].duration_us) == (2, 660 * 10**6)


def test_times_before_1970(spark):
    rows = [("8.8.8.8", -10**10, False), ("8.8.8.8", -(10**10) + 1, False)]
    assert th.ip_summary(attempts(spark, rows)).first().duration_us == 10**6


def test_order_limits_and_rest(spark):
    rows = [(f"8.8.{i}.{j}", j, False) for i in range(3) for j in range(10)]
    summary = th.ip_summary(attempts(spark, rows))
    top = th.top_threats(summary, Params(summary_limit=4)).collect()
    assert [r.ip for r in top] == ["8.8.0.0", "8.8.0.1", "8.8.0.2", "8.8.0.3"]  # ties: first seen
    assert {r.remaining for r in top} == {26}
    assert {r.remaining for r in th.top_threats(summary, Params(summary_limit=50)).collect()} == {0}


def test_breakdown_ranks_before_it_filters(spark):
    rows = [("1.1.1.1", s, False, u) for s, u in enumerate("abcabcab")]  # critical
    rows += [("2.2.2.2", 0, False, "x"), ("3.3.3.3", 0, False, "y")]  # low
    data = attempts(spark, rows)
    summary = th.ip_summary(data)
    got = th.breakdown(data, summary, Params(verbose_limit=2, filter_severity="HIGH")).orderBy("first_pos").collect()
    assert [(r["rank"], r.ip, r.username, r.attempts) for r in got] == [(1, "1.1.1.1", "a", 3), (1, "1.1.1.1", "b", 3), (1, "1.1.1.1", "c", 2)]
    everything = th.breakdown(data, summary, Params(verbose_limit=2)).select("ip").distinct().collect()
    assert {r.ip for r in everything} == {"1.1.1.1", "2.2.2.2"}


def test_blocklist_candidates(spark):
    ips = ["8.8.8.8", "8.8.8.80", "10.0.0.1", "127.0.0.1", "192.168.1.1", "172.16.0.1", "::1", "0:0:0:0:0:0:0:1", "169.254.1.1", "fd00::1"]
    summary = th.ip_summary(attempts(spark, [(ip, s, False) for ip in ips for s in range(20)]))
    white = spark.createDataFrame([("8.8.8.8",)], "ip string")
    assert {r.ip for r in th.blocklist_candidates(summary, white).collect()} == {"8.8.8.80", "169.254.1.1", "fd00::1"}
    actions = {r.ip: r.action for r in th.mark_blocked(summary, white).collect()}
    assert actions["8.8.8.80"] == "BLOCKED" and actions["8.8.8.8"] == "BLOCK" and actions["10.0.0.1"] == "BLOCK"


def test_event_tops(spark):
    rows = [("1.1.1.1", i, False, "u", "invalid_user") for i in range(3)]
    rows += [("2.2.2.2", i, False, "u", "invalid_user") for i in range(3)]
    rows += [("3.3.3.3", i, True, "u", "accepted_gssapi") for i in range(2)]
    data = attempts(spark, rows)
    assert [(r.ip, r.events) for r in th.top_invalid_user(data, Params(summary_limit=1)).collect()] == [("1.1.1.1", 3)]
    assert [(r.ip, r.events) for r in th.top_accepted(data).collect()] == [("3.3.3.3", 2)]


def test_blocklist_only_grows(spark, tmp_path):
    path = str(tmp_path / "blocklist")
    as_df = lambda *ips: spark.createDataFrame([(ip,) for ip in ips], "ip string")
    written = lambda: sorted(r.ip for r in read_blocklist(spark, path).collect())
    assert written() == []
    append_blocklist(as_df("8.8.8.8", "9.9.9.9"), path)
    append_blocklist(as_df("8.8.8.8", "9.9.9.9"), path)  # a retried batch adds nothing
    append_blocklist(as_df("7.7.7.7"), path)
    assert written() == ["7.7.7.7", "8.8.8.8", "9.9.9.9"]
    lines = [x for f in glob.glob(f"{path}/part-*") for x in open(f).read().split()]
    assert sorted(lines) == written()


def test_whitelist_file(spark, log_file):
    path = log_file("# office", " 8.8.8.8 ", "", "bad", "#9.9.9.9", "1.2.3.0/24", "8.8.8.8", "2001:db8::1", name="white.txt")
    assert sorted(r.ip for r in read_whitelist(spark, path).collect()) == ["2001:db8::1", "8.8.8.8"]
    assert read_whitelist(spark, None).isEmpty()


LINE = "Dec 28 10:00:00 server sshd[123]: Invalid user admin from 192.0.2.10 port 5555"


def test_log_to_csv_and_blocklist(spark, tmp_path, log_file):
    log = log_file(*[LINE] * 100)
    out, block = str(tmp_path / "csv"), str(tmp_path / "block")
    result = summarize(spark, log, AsOf(2026, 5), csv_path=out, blocklist_path=block)
    rows = [r for f in sorted(glob.glob(f"{out}/part-*.csv")) for r in csv.reader(open(f))]
    assert rows[0] == ["IP", "Attempts", "Attack_Rate", "Severity", "Action", "Duration", "Window_Start", "Window_End"]
    assert rows[1:] == [["192.0.2.10", "100", "100.00", "CRITICAL", "BLOCKED", "0m 0s", "2025-12-28T10:00:00", "2025-12-28T10:00:00"]]
    assert [r.ip for r in read_blocklist(spark, block).collect()] == ["192.0.2.10"]
    assert result.coverage.first().attempts == 100
    assert result.footer.first().asDict() == {"shown": 1, "hidden": 0, "suspicious": 1, "blocked": 1}
    assert result.stats.first().format == "CentOS/RHEL (syslog)"
    assert [r.events for r in result.top_invalid_user.collect()] == [100]


def test_whitelisted_address_is_not_blocked(spark, tmp_path, log_file):
    log = log_file(*[LINE] * 100)
    white = log_file("192.0.2.10", name="white.txt")
    block = str(tmp_path / "block")
    summarize(spark, log, AsOf(2026, 5), whitelist_path=white, blocklist_path=block)
    assert read_blocklist(spark, block).isEmpty()


def test_empty_log(spark, tmp_path, log_file):
    log, out = log_file(), tmp_path / "csv"
    result = summarize(spark, log, AsOf(2026, 5), csv_path=str(out), blocklist_path=str(tmp_path / "block"))
    assert not out.exists() and not (tmp_path / "block").exists()
    assert result.summary.isEmpty() and result.stats.first().lines_read == 0
    assert result.coverage.first().attempts == 0


def test_coverage_prefers_parser_times(spark, log_file):
    log = log_file(
        "May 26 09:00:00 server sshd[1]: Server listening on 0.0.0.0 port 22.",
        "May 26 10:00:00 server sshd[1]: Failed password for root from 8.8.8.8 port 22",
        "May 26 12:00:00 server sshd[1]: Received signal 15; terminating.",
    )
    assert summarize(spark, log, AsOf(2026, 6)).coverage.first().duration_us == 3 * t.HOUR_US


def test_offsets_in_window_texts(spark, log_file):
    fail = "Failed password for root from 8.8.8.8 port 22"
    log = log_file(f"2026-05-26T10:00:00+02:00 h sshd[1]: {fail}", f"2026-05-26T09:30:00.5 h sshd[1]: {fail}")
    row = th.csv_rows(th.ip_summary(summarize(spark, log, AsOf(2026, 6)).attempts)).first()
    assert (row.Window_Start, row.Window_End) == ("2026-05-26T10:00:00+02:00", "2026-05-26T09:30:00.500000")
    assert row.Duration == "1h 30m 0s"
