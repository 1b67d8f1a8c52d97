"""Typed authentication events from syslog text: failed and accepted logins, sudo, su.

Output: ``pos, kind, ip, user, command, ts, ts_us`` with kind ``failed``, ``success`` or
``sudo``. Only ``Mon dd hh:mm:ss`` lines qualify; the year is a parameter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.functions import timestamps as t
from logwarden.operators.compute_once import with_struct

# Line patterns in order of precedence. Groups: time, then user and address, user and command, or target and actor.
STAMP = r"(\w+\s+\d+\s+\d+:\d+:\d+)"
FAILED = STAMP + r".*sshd.*Failed password for (?:invalid user )?(\S+) from (\S+) port"
ACCEPTED = STAMP + r".*sshd.*Accepted (?:password|publickey) for (\S+) from (\S+) port"
SUDO = STAMP + r".*sudo\[\d+\]:\s+(\S+)\s*:.*COMMAND=(.*)"
SU = STAMP + r".*su\[.*\].*Successful su for (\S+) by (\S+)"

# Unicode character classes, and a dot that stops at \n only
JAVA_FLAGS = "(?Ud)"

_BLANKS = " \t\n\r\f\v"


# Literals that every match contains; testing them first spares most regular expressions.
_LITERALS = {
    FAILED: "Failed password for ",
    ACCEPTED: "Accepted p",
    SUDO: "COMMAND=",
    SU: "Successful su for ",
}


def _match(line: Column, pattern: str) -> Column:
    """The matching part of a line; empty or null where the pattern does not match."""
    found = F.regexp_extract(line, JAVA_FLAGS + pattern, 0)
    return F.when(F.contains(line, F.lit(_LITERALS[pattern])), found)


def _word(text: Column, from_end: int) -> Column:
    """The n-th blank-separated word of a match, counted from its end."""
    return F.substring_index(F.substring_index(text, " ", -from_end), " ", 1)


def auth_events(lines: DataFrame, year: int, kept: tuple[str, ...] = ()) -> DataFrame:
    """Events of a ``pos, line`` table, in one pass and without a shuffle; with its columns ``kept``.

    A line belongs to the first pattern that matches it, even if its time is invalid. Each
    line is matched once; user and address are then cut from the end of the match, where
    the patterns allow single blanks only.
    """
    line = F.col("line")
    patterns = {"failed": FAILED, "accepted": ACCEPTED, "sudo": SUDO, "su": SU}
    matches = F.struct(*[_match(line, p).alias(name) for name, p in patterns.items()])
    matched = with_struct(lines.select(*kept, "pos", "line"), "m", matches)

    hit = {name: F.col(f"m.{name}") != "" for name in patterns}

    def first(**values: Column) -> Column:
        choice = F.when(F.lit(False), F.lit(None).cast("string"))
        for name in patterns:
            choice = choice.when(hit[name], values.get(name, F.lit(None)))
        return choice

    failed, accepted, sudo, su = (F.col(f"m.{name}") for name in patterns)
    stamp = F.regexp_extract(first(failed=failed, accepted=accepted, sudo=sudo, su=su), JAVA_FLAGS + "^" + STAMP, 1)
    event = F.struct(
        first(failed=F.lit("failed"), accepted=F.lit("success"), sudo=F.lit("sudo"), su=F.lit("sudo")).alias("kind"),
        first(failed=_word(failed, 2), accepted=_word(accepted, 2)).alias("ip"),
        first(
            failed=_word(failed, 4),
            accepted=_word(accepted, 4),
            sudo=F.regexp_extract(sudo, JAVA_FLAGS + SUDO, 2),
            su=_word(su, 1),
        ).alias("user"),
        first(
            sudo=F.btrim(F.substring_index(sudo, "COMMAND=", -1), F.lit(_BLANKS)),
            su=F.concat(F.lit("su to "), _word(su, 3)),
        ).alias("command"),
        t.syslog_fields(stamp).alias("time"),
    )
    parsed = with_struct(matched.select(*kept, "pos", "m"), "e", event)
    ts = t.syslog_clock(F.col("e.time"), year, any_case=True)
    events = with_struct(parsed.select(*kept, "pos", "e"), "ts", ts).filter(F.col("ts").isNotNull())
    return events.select(*kept, "pos", "e.kind", "e.ip", "e.user", "e.command", "ts", t.micros_of(F.col("ts")).alias("ts_us"))
