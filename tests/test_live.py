"""Streams: files that land one per micro-batch give the batch result; the blocklist only grows."""

import glob
import os
import time

import pytest

from logwarden.operators import threat as th
from logwarden.operators.attempts import attempts, scan_lines
from logwarden.operators.formats import AsOf
from logwarden.params import Params
from logwarden.session import shared_folder
from logwarden.sources.ip_lists import read_blocklist
from logwarden.sources.lines import read_lines, stream_lines
from logwarden.streaming import live
from logwarden.streaming.versions import VersionedTable

AS_OF = AsOf(2026, 6)


def line(ip, minute, second=0, user="root"):
    return f"May 26 {10 + minute // 60:02d}:{minute % 60:02d}:{second:02d} h sshd[1]: Failed password for {user} from {ip} port 22 ssh2"


# the first address is severe in the second file, then fades as its time span grows
BATCHES = [
    [line("8.8.8.8", 0, s) for s in range(3)] + [line("9.9.9.9", 0)] + ["noise"],
    [line("8.8.8.8", 0, s) for s in range(10, 15)] + [line("10.0.0.1", 0, s) for s in range(20)],
    [line("8.8.8.8", 400), f"2026-05-26T17:00:00+00:00 h sshd[1]: Accepted password for root from 9.9.9.9 port 22"],
]


def land(folder, batches, start=0):
    os.makedirs(folder, exist_ok=True)
    for i, rows in enumerate(batches, start):
        with open(f"{folder}/{i}.log", "w") as f:
            f.write("\n".join(rows) + "\n")
        os.utime(f"{folder}/{i}.log", (1_700_000_000 + i, 1_700_000_000 + i))


def drain(spark, folder, out, **options):
    found = live.live_attempts(stream_lines(spark, folder, max_files_per_batch=1), AS_OF)
    live.start_live_summary(found, out, drain=True, **options).awaitTermination()


def rows(df):
    columns = ["ip", "attempts", "severity", "action", "first_us", "last_us"]
    return sorted(df.select(*columns).collect())


def test_stream_equals_batch(spark, tmp_path):
    folder, out = str(tmp_path / "logs"), str(tmp_path / "out")
    land(folder, BATCHES)
    drain(spark, folder, out)
    batch = th.ip_summary(attempts(scan_lines(read_lines(spark, folder), AS_OF, sticky=False)))
    assert rows(live.current_summary(spark, out)) == rows(batch)
    severity = {r.ip: r.severity for r in batch.collect()}
    assert severity["8.8.8.8"] == "LOW"  # it was severe in between ...
    assert [r.ip for r in read_blocklist(spark, f"{out}/blocklist").collect()] == ["8.8.8.8"]  # ... and stays listed
    coverage = live.current_coverage(spark, out).first()
    assert (coverage.ips, coverage.attempts) == (3, 31)
    csv = spark.read.option("header", True).csv(live.current_csv(spark, out))
    assert csv.count() == 3 and {r.Attempts for r in csv.collect()} == {"9", "1", "20"}


def test_state_survives_a_restart(spark, tmp_path):
    folder, out = str(tmp_path / "logs"), str(tmp_path / "out")
    land(folder, BATCHES[:1])
    drain(spark, folder, out)
    land(folder, BATCHES[1:], start=1)
    drain(spark, folder, out)
    drain(spark, folder, out)  # nothing new
    batch = th.ip_summary(attempts(scan_lines(read_lines(spark, folder), AS_OF, sticky=False)))
    assert rows(live.current_summary(spark, out)) == rows(batch)


def test_blocklist_only_mode(spark, tmp_path):
    folder, out = str(tmp_path / "logs"), str(tmp_path / "out")
    land(folder, BATCHES)
    white = spark.createDataFrame([("9.9.9.9",)], "ip string")
    drain(spark, folder, out, snapshot=False, whitelist=white, params=Params(blocklist_threshold="LOW"))
    assert [r.ip for r in read_blocklist(spark, f"{out}/blocklist").collect()] == ["8.8.8.8"]
    assert live.current_csv(spark, out) is None
    batch = th.ip_summary(attempts(scan_lines(read_lines(spark, folder), AS_OF, sticky=False)))
    assert rows(live.current_summary(spark, out)) == rows(batch)
    assert live.write_current_csv(spark, out, f"{out}/asked")
    csv = spark.read.option("header", True).csv(f"{out}/asked")
    assert csv.count() == 3 and {r.Attempts for r in csv.collect()} == {"9", "1", "20"}
    assert live.current_coverage(spark, out).first().attempts == 31


class Stop(Exception):
    pass


@pytest.mark.parametrize("step", ["merge", "publish"])
def test_readers_see_whole_refreshes_only(spark, tmp_path, monkeypatch, step):
    folder, out = str(tmp_path / "logs"), str(tmp_path / "out")
    land(folder, BATCHES[:2])
    drain(spark, folder, out)
    before = rows(live.current_summary(spark, out)), live.current_csv(spark, out)
    land(folder, BATCHES[2:], start=2)
    original = getattr(VersionedTable, step)

    def fails(self, *args, **options):
        if step == "merge":
            original(self, *args, **options)  # everything is written but the manifest
        raise Stop

    with monkeypatch.context() as patch:
        patch.setattr(VersionedTable, step, fails)
        with pytest.raises(Exception, match="Stop"):
            drain(spark, folder, out)
    # half of a refresh, and half of a summary file, lie about
    assert (rows(live.current_summary(spark, out)), live.current_csv(spark, out)) == before
    assert spark.read.option("header", True).csv(before[1]).count() == 3
    drain(spark, folder, out)
    batch = th.ip_summary(attempts(scan_lines(read_lines(spark, folder), AS_OF, sticky=False)))
    assert rows(live.current_summary(spark, out)) == rows(batch)
    assert [r.ip for r in read_blocklist(spark, f"{out}/blocklist").collect()] == ["8.8.8.8"]


def test_a_refresh_writes_only_what_changed(spark, tmp_path):
    folder, out = str(tmp_path / "logs"), str(tmp_path / "out")
    land(folder, [[line(f"8.{i}.8.8", i % 60) for i in range(200)]] + [[line("8.1.8.8", m), line("8.2.8.8", m)] for m in range(61, 70)])
    drain(spark, folder, out, snapshot=False)
    table = live.totals_table(spark, out)
    refreshes = table.refreshes()
    assert [r.batch for r in refreshes] == [7, 8, 9]  # older ones are deleted
    touched = {e.bucket for e in refreshes[-1].entries if e.version > 1}
    assert 0 < len(touched) <= 2 and len({e.bucket for e in refreshes[-1].entries}) > 20
    versions = {p.rsplit("=", 1)[1] for p in glob.glob(f"{out}/totals/data/version=*/bucket=*/..") for p in [os.path.dirname(os.path.dirname(p))]}
    needed = {str(e.version) for r in refreshes for e in r.entries}
    assert needed <= versions
    sizes = {v: sum(spark.read.parquet(p).count() for p in glob.glob(f"{out}/totals/data/version={v}/bucket=*")) for v in range(2, 20, 2) if glob.glob(f"{out}/totals/data/version={v}/bucket=*")}
    assert set(sizes.values()) == {2}
    batch = th.ip_summary(attempts(scan_lines(read_lines(spark, folder), AS_OF, sticky=False)))
    assert rows(live.current_summary(spark, out)) == rows(batch)


def test_landing_leaves_no_scratch_tables(spark, tmp_path):
    folder, out = str(tmp_path / "logs"), str(tmp_path / "out")
    land(folder, BATCHES)
    shared = shared_folder(spark)
    before = set(glob.glob(f"{shared}/logwarden-*"))
    live.start_live_attempts(stream_lines(spark, folder, max_files_per_batch=1), AS_OF, out, drain=True).awaitTermination()
    assert set(glob.glob(f"{shared}/logwarden-*")) == before
    # as in batch: each file is read with the layout of its first readable line
    assert spark.read.parquet(f"{out}/attempts").count() == attempts(scan_lines(read_lines(spark, folder), AS_OF)).count() == 30


def test_the_blocklist_reads_new_candidates_only(spark, tmp_path, monkeypatch):
    folder, out = str(tmp_path / "logs"), str(tmp_path / "out")
    monkeypatch.setattr("logwarden.sources.sinks.read_blocklist", None)  # nobody reads the list
    low = Params(blocklist_threshold="LOW")
    reads = []
    for n in range(4):
        land(folder, [[line(f"8.{n}.{i}.8", i) for i in range(5)] + [line("9.9.9.9", n)]], start=n)
        found = live.live_attempts(stream_lines(spark, folder), AS_OF)
        query = live.start_live_summary(found, out, params=low, snapshot=False, drain=True)
        query.awaitTermination()
        reads.append(sum(p.numInputRows for p in query.blocklist.recentProgress))
    assert reads == [6, 6, 6, 6]  # five new ones and one that is listed already
    listed = [r.value for r in spark.read.text(f"{out}/blocklist").collect()]
    assert len(listed) == len(set(listed)) == 21


def test_a_file_keeps_its_layout_over_landings(spark, tmp_path):
    folder, out = tmp_path / "logs", str(tmp_path / "out")
    folder.mkdir()
    generic = "May 26 10:{:02d}:00 h other[1]: Failed password for root from 8.8.8.8 port 22 ssh2"

    def landed(n, *lines):
        (folder / f"auth.log.{n}").write_text("\n".join(lines) + "\n")
        live.start_live_attempts(stream_lines(spark, str(folder)), AS_OF, out, drain=True).awaitTermination()

    # the first line fixes the layout that reads lines of every program
    landed(0, "noise", generic.format(0), line("8.8.8.8", 1))
    # by itself this landing would be read with the sshd layout, and its second line be lost
    landed(1, line("8.8.8.8", 2), generic.format(3), "2026-05-26T10:04:00+00:00 h sshd[1]: Failed password for root from 8.8.8.8 port 22")
    found = live.landed_attempts(spark, out)
    live.start_live_summary(found, f"{out}/summary", drain=True).awaitTermination()
    row = live.current_summary(spark, f"{out}/summary").first()
    assert (row.ip, row.attempts) == ("8.8.8.8", 4)
    # a batch that is retried after it landed adds nothing
    live.start_live_attempts(stream_lines(spark, str(folder)), AS_OF, out, drain=True).awaitTermination()
    live.start_live_summary(live.landed_attempts(spark, out), f"{out}/summary", drain=True).awaitTermination()
    assert live.current_summary(spark, f"{out}/summary").first().attempts == 4


def test_following_from_the_end(spark, tmp_path):
    folder, out = str(tmp_path / "logs"), str(tmp_path / "out")
    land(folder, BATCHES[:1])

    def follow(ip, name, later):
        lines = stream_lines(spark, folder, follow_from=f"{out}/started")
        with open(f"{folder}/{name}", "w") as f:
            f.write(line(ip, 1) + "\n")
        os.utime(f"{folder}/{name}", (time.time() + later, time.time() + later))
        return live.live_attempts(lines, AS_OF, format="CentOS/RHEL (syslog)")

    live.start_live_summary(follow("7.7.7.7", "new.log", 60), out, drain=True).awaitTermination()
    assert [r.ip for r in live.current_summary(spark, out).collect()] == ["7.7.7.7"]
    # landed while the query was down, before the second start
    found = follow("7.7.7.8", "down.log", 1)
    time.sleep(2)
    live.start_live_summary(found, out, drain=True).awaitTermination()
    assert {r.ip for r in live.current_summary(spark, out).collect()} == {"7.7.7.7", "7.7.7.8"}


def test_refreshing_query(spark, tmp_path):
    folder, out = str(tmp_path / "logs"), str(tmp_path / "out")
    land(folder, BATCHES[:2])
    found = live.live_attempts(stream_lines(spark, folder), AS_OF)
    query = live.start_live_summary(found, out, refresh=0.2, params=Params().quiet())
    try:
        query.processAllAvailable()
        assert {r.ip for r in live.current_summary(spark, out, Params().quiet()).collect()} == {"8.8.8.8", "10.0.0.1"}
    finally:
        query.stop()


@pytest.mark.parametrize("given, want", [(None, 5.0), (0.01, 0.01), (300, 300.0), (2, 2.0)])
def test_refresh_interval(given, want):
    assert live.refresh_seconds(given) == want


def test_refresh_interval_must_be_positive():
    with pytest.raises(ValueError):
        live.refresh_seconds(0)


def test_nothing_finished_yet(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        live.current_totals(spark, str(tmp_path))
