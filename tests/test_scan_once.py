"""One pass over the text: the same attempts and counters as the two-pass reading; what the JIT compiles."""

import random
import re

import pytest
from pyspark.sql import functions as F

from logwarden.operators import attempts as a
from logwarden.operators.attempt_rules import RULES, Dispatch, Rule
from logwarden.operators.auth_events import auth_events
from logwarden.operators.formats import FORMATS, AsOf, first_format
from logwarden.sources.lines import list_files, read_lines

AS_OF = AsOf(2026, 6)
STATS = ["file", "lines_read", "format_matches", "extract_matches", "failed_timestamps", "format", "first_ts", "last_ts", "first_us", "last_us"]
FAIL = "Failed password for root from 1.2.3.4 port 22 ssh2"


def line(rng):
    message = rng.choice([FAIL, "Invalid user eve from 9.9.9.9 port 22", "session opened", "Accepted password for bob from 5.6.7.8 port 22 ssh2", "Invalid user x from 999.1.1.1", ""])
    at = f"{rng.randint(1, 32):2d} {rng.randint(0, 24):02d}:{rng.randint(0, 59):02d}:00"
    day = rng.randint(10, 32)
    return rng.choice(
        [
            f"May {at} h sshd[1]: {message}",
            f"May {at} h other[1]: {message}",
            f"May {at} h sshd: {message}",
            f"2026-05-{day}T10:00:00+02:00 h sshd[1]: {message}",
            f"2026-05-{day}T10:00:00 h cron[1]: {message}",
            f"2026-05-{day}T10:00:00.5+02:00 h sshd: {message}",
            f"May {at} h sshd[2026-05-26T10:00:00.5+02:00 h sshd: {message}",
            "noise",
            "",
        ]
    )


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("logs")
    rng = random.Random(3)
    for i in range(14):
        first = ["noise"] * rng.randint(0, 4)
        (path / f"{i}.log").write_text("\n".join(first + [line(rng) for _ in range(rng.randint(1, 60))]) + "\n")
    (path / "nothing.log").write_text("noise\n\n")
    (path / "empty.log").write_text("")
    return str(path)


def rows(df, columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("format", [None, "Generic syslog", "systemd journald"])
@pytest.mark.parametrize("batch", ["10000", "7"])
def test_equals_the_reading_in_two_passes(spark, folder, format, batch):
    lines, files = read_lines(spark, folder, "drop"), list_files(spark, folder)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        scan = a.scan_once(lines, AS_OF, format, files=files)
        got = rows(scan.attempts, a.COLUMNS), rows(scan.stats, STATS)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    scanned = a.scan_lines(lines, AS_OF, format)
    assert got == (rows(a.attempts(scanned), a.COLUMNS), rows(a.parse_stats(scanned, files), STATS))
    assert len(got[0]) > 20 or format == "systemd journald"


def test_layouts_that_differ_in_meaning(spark, tmp_path):
    # both syslog layouts match, journald matches inside the line and means something else
    both = f"May 26 10:00:00 h sshd[1]: x 2026-05-26T10:00:00.5+02:00 h sshd: {FAIL}"
    (tmp_path / "a.log").write_text(f"{both}\n2026-05-26T10:00:00.5+02:00 h sshd: {FAIL}\n")
    (tmp_path / "b.log").write_text(f"May 26 10:00:00 h other[1]: x\n{both}\n")
    lines = read_lines(spark, str(tmp_path))
    scan, scanned = a.scan_once(lines, AS_OF), a.scan_lines(lines, AS_OF)
    assert rows(scan.attempts, a.COLUMNS) == rows(a.attempts(scanned), a.COLUMNS)
    assert rows(scan.stats, STATS) == rows(a.parse_stats(scanned), STATS)


def test_stored_rows_are_attempts_and_few_counters(spark, tmp_path):
    (tmp_path / "a.log").write_text("".join(f"May 26 10:00:00 h sshd[1]: {FAIL if i % 10 == 0 else 'x'}\n" for i in range(5000)))
    lines = read_lines(spark, str(tmp_path))
    table = a._stored_readings(lines, AS_OF, FORMATS, RULES)
    counts = dict(table.groupBy("kind").count().collect())
    assert counts["attempt"] == 500 and counts["counter"] <= 4
    plan = a.scan_once(lines, AS_OF).attempts._jdf.queryExecution().executedPlan().toString()
    assert "FileScan text" not in plan


def test_files_are_listed_by_tasks(spark, folder):
    files = list_files(spark, folder)
    assert {r.file.rsplit("/", 1)[1] for r in files.collect()} == {*(f"{i}.log" for i in range(14)), "nothing.log", "empty.log"}
    filled = list_files(spark, folder, empty=False)
    assert {r.file.rsplit("/", 1)[1] for r in filled.collect()} == {*(f"{i}.log" for i in range(14)), "nothing.log"}
    plan = filled._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan and "LocalTableScan" not in plan


def test_dispatch_takes_the_first_rule_that_matches(spark):
    rules = [Rule("a", r"x(\d) from (\w+)", literal="x"), Rule("b", r"from (\w+)", user_group=None, ip_group=1), Rule("c", r"(y) (z)", literal="y z")]
    texts = ["from p then x1 from q", "from p only", "y z", "y z from t", "xx", "none", None, "x9 from", "y z x2 from s"]
    found = Dispatch(rules)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, info string")
    hit = found.hit(found.subject(F.col("info"), [None] * 3))
    df = df.select("i", hit.alias("hit")).select("i", found.of_rule(F.get("hit", 0), ["a", "b", "c"]).alias("rule"), F.get("hit", 1).alias("u"), F.get("hit", 2).alias("ip"))
    got = {r.i: (r.rule, r.u, r.ip) for r in df.collect()}
    none = (None, None, None)
    want = [("a", "1", "q"), ("b", "", "p"), ("c", "y", "z"), ("b", "", "t"), none, none, none, none, ("a", "2", "s")]
    assert [got[i] for i in range(9)] == want


def method_sizes(df):
    """Bytes of the largest generated method of each stage."""
    text = df.sparkSession.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
    return [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]


def test_no_method_is_too_large_for_the_jit(spark, folder):
    lines = read_lines(spark, folder, "drop")
    read = {
        "line": a.scan_lines(lines, AS_OF, sticky=False),
        "forced": a.scan_lines(lines, AS_OF, format="Generic syslog"),
        "events": auth_events(lines, 2026),
        "layout": lines.select(first_format(F.col("line"))),
    }
    stored = []
    for name, df in read.items():
        sizes = method_sizes(df)
        assert sizes and max(sizes) < 8000, (name, sizes)
        stored.append(max(sizes))
    assert max(stored) > 1000  # the figures are there


def test_readings_of_one_scan_are_compiled_too(spark, folder, monkeypatch):
    seen = []
    monkeypatch.setattr(a, "stored", lambda df, partition_by=None: seen.append(df) or df)
    a._stored_readings(read_lines(spark, folder, "drop"), AS_OF, FORMATS, RULES)
    sizes = method_sizes(seen[0])
    assert sizes and max(sizes) < 8000, sizes
