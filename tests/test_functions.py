import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from logwarden.functions import addresses as ad
from logwarden.functions import severity as s
from logwarden.functions import text as x
from logwarden.functions import timestamps as t
from logwarden.params import Params

VALID = [
    "192.168.1.1", "0.0.0.0", "255.255.255.255", "127.0.0.1", "::1",
    "2001:0db8:85a3:0000:0000:8a2e:0370:7334", "2001:db8::1", "fe80::1",
]
INVALID = [
    "999.999.999.999", "256.1.1.1", "192.168.1", "192.168.1.1.1", "", "localhost", "example.com", "192.168.1.1/24",
    "192.168.1.-1", "192.168.1.1a", "192.168..1", "......", "' OR '1'='1", "../../etc/passwd", "<script>alert('xss')</script>",
]


def values(spark, kind, items, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_valid_addresses(spark):
    got = values(spark, "string", VALID + INVALID + [None], ad.is_valid_ip)
    assert got == [True] * len(VALID) + [False] * (len(INVALID) + 1)


def test_addresses_agree_with_the_standard_library(spark):
    rng = random.Random(5)
    edge = [0, 1, 9, 10, 100, 113, 127, 168, 169, 172, 192, 198, 203, 224, 240, 254, 255]
    texts = [".".join(str(rng.choice(edge)) for _ in range(4)) for _ in range(400)]
    texts += [str(ipaddress.IPv6Address(rng.getrandbits(128) >> rng.choice([0, 64, 100]))) for _ in range(300)]
    texts += ["".join(rng.choice("0:::12fe.") for _ in range(rng.randrange(1, 14))) for _ in range(400)]
    heads = [0x2001, 0x2002, 0x2606, 0x3FFF, 0xFEC0, 0xFE80, 0xFF00, 0xFD00]
    seconds = [0, 1, 2, 3, 4, 0x20, 0x30, 0xDB8, 0x1FF, 0x200]
    texts += [str(ipaddress.IPv6Address(rng.choice(heads) << 112 | rng.choice(seconds) << 96 | rng.randrange(3))) for _ in range(300)]
    texts += ["::ffff:8.8.8.8", "::ffff:10.0.0.1", "1:2:3:4:5:6:7::", "1::2::3", "::1%eth0", "1:2:3:4:5:6:1.2.3.4", "192.0.0.9"]
    guarded = [ipaddress.ip_network(n) for n in ("127.0.0.0/8", "::1/128", "10.0.0.0/8", "172.16.0.0/12", "192.168.0.0/16")]

    def expected(text):
        try:
            a = ipaddress.ip_address(text)
        except ValueError:
            return (False, False, False)
        special = a.is_private or a.is_loopback or a.is_link_local or a.is_reserved or a.is_multicast or a.is_unspecified
        return (True, any(a in n for n in guarded), not special)

    tests = zip(*[values(spark, "string", texts, f) for f in (ad.is_valid_ip, ad.is_local_or_private, ad.is_public)])
    wrong = [(text, got, expected(text)) for text, got in zip(texts, tests) if got != expected(text)]
    assert wrong == []


def test_two_decimals_like_c(spark):
    rng = random.Random(3)
    items = [0.625, 0.125, 1.005, 1.015, 0.005, 0.0, 99.995, 10 / 3, 600000.0]
    items += [rng.randrange(1, 20000) / 200 for _ in range(300)] + [rng.randrange(1, 2000) / 8 for _ in range(100)]
    assert values(spark, "double", items, x.two_decimals) == [f"{v:.2f}" for v in items]


def test_durations(spark):
    items = [0, 59_999_999, 424_000_000, 7_395_000_000, -424_000_000]
    assert values(spark, "bigint", items, t.duration_text) == ["0m 0s", "0m 59s", "7m 4s", "2h 3m 15s", "7m 4s"]


def test_times_do_not_depend_on_the_session_zone(spark):
    df = spark.sql("select explode(array('2024-03-10 02:30:00.123456', '1965-01-01 00:00:00.5', '2024-11-03 01:30:00')) as s")
    ts = F.col("s").cast("timestamp_ntz")
    rows = df.select("s", t.from_micros(t.micros_of(ts)).cast("string").alias("back"), t.iso_text(ts).alias("iso")).collect()
    assert [r.back for r in rows] == [r.s for r in rows]
    assert [r.iso for r in rows] == ["2024-03-10T02:30:00.123456", "1965-01-01T00:00:00.500000", "2024-11-03T01:30:00"]


def test_csv_guard(spark):
    items = ["=1+1", "+1", "-1", "@x", "\tx", "\rx", "x=1", "'x", "", None]
    assert values(spark, "string", items, x.csv_guard) == ["'=1+1", "'+1", "'-1", "'@x", "'\tx", "'\rx", "x=1", "'x", "", None]


def test_zero_padding_never_cuts(spark):
    assert values(spark, "int", [7, 123, 12345], lambda c: x.zero_padded(c, 3)) == ["007", "123", "12345"]


def test_severity_names():
    assert s.parse_severity("high") == "HIGH"
    with pytest.raises(ValueError):
        s.parse_severity("severe")


def test_compromise_scores(spark):
    cases = [(5, True, False), (5, False, True), (2, False, False), (2, True, True), (1, False, True), (5, False, False)]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, n int, s boolean, o boolean")
    rows = df.orderBy("i").select(s.compromise_severity(F.col("n"), F.col("s"), F.col("o")))
    assert [r[0] for r in rows.collect()] == ["CRITICAL", "HIGH", "MEDIUM", "CRITICAL", "MEDIUM", "HIGH"]


def test_upgrades(spark):
    df = spark.createDataFrame([("LOW", 90), ("MEDIUM", 95), ("HIGH", 100), ("CRITICAL", 100), ("LOW", 89), ("HIGH", None)], "s string, n int")
    got = [r[0] for r in df.select(s.upgrade_severity(F.col("s"), F.col("n"), 90)).collect()]
    assert got == ["MEDIUM", "HIGH", "CRITICAL", "CRITICAL", "LOW", "HIGH"]


@pytest.mark.parametrize(
    "bad",
    [
        {"max_attempts": -1}, {"max_attempts": True}, {"max_attempts": 2.5}, {"summary_limit": 0}, {"verbose_limit": "5"},
        {"burst_minutes": -1}, {"business_start": 25}, {"blocklist_threshold": "x"}, {"filter_severity": "none"},
    ],
)
def test_bad_parameters(bad):
    with pytest.raises(ValueError):
        Params(**bad)


def test_presets():
    strict = Params().strict()
    assert (strict.max_attempts, strict.monitor_threshold, strict.block_threshold) == (1, 1, 5)
    assert Params().quiet().filter_severity == "HIGH"
    assert Params(filter_severity="low").filter_severity == "LOW"
