"""Log layouts, and the one layout that each file is read with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.functions import timestamps as t
from logwarden.operators.attempt_rules import Rule
from logwarden.operators.auth_events import JAVA_FLAGS
from logwarden.operators.skew import join_facts


# Layout names and patterns.
ISO_NAME = "Ubuntu/Debian (ISO 8601)"
ISO = (
    r"^\d{4}-\d{1,2}-\d{1,2}T\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:[+-]\d{2}:\d{2})?"
    r"\s+(\S+)\s+(\S+?)(?:\[\d+\]):\s+(.*)$"
)
JOURNALD_NAME = "systemd journald"
JOURNALD = r"(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d+\+\d{2}:\d{2})\s+(\S+)\s+sshd(?:\[\d+\])?:\s+(.*)$"
RHEL_NAME = "CentOS/RHEL (syslog)"
RHEL = r"^(\w+\s+\d{1,2}\s+\d{2}:\d{2}:\d{2})\s+(\S+)\s+(sshd)(?:\[\d+\])?:\s+(.*)$"
SYSLOG_NAME = "Generic syslog"
SYSLOG = r"^(\w+\s+\d{1,2}\s+\d{2}:\d{2}:\d{2})\s+(\S+)\s+(\S+?)(?:\[\d+\])?:\s+(.*)$"
FIRST_LOOK = Rule("invalid_user", r"Invalid user (\S+) from ([\d.]+)", literal="Invalid user ")


@dataclass(frozen=True)
class AsOf:
    """The month a log is read in; it decides the year of lines that carry none."""

    year: int
    month: int


@dataclass(frozen=True)
class LogFormat:
    """A line layout: where the message is, and how to read the time (native expressions).

    ``fields`` cuts the texts that make up the time out of a line; ``clock`` and ``offset``
    (in minutes) read that array. ``first_look`` is tried on the message before the general
    rules; when it matches, the result is final. ``literal`` is text that every match contains.
    """

    name: str
    pattern: str
    info_group: int
    fields: Callable[[Column], Column]
    clock: Callable[[Column, AsOf], Column]
    offset: Callable[[Column], Column] = lambda fields: F.lit(None).cast("int")
    first_look: Rule | None = FIRST_LOOK
    literal: str | None = None

    def matches(self, line: Column) -> Column:
        found = line.rlike(JAVA_FLAGS + self.pattern)
        return F.contains(line, F.lit(self.literal)) & found if self.literal else found

    def info(self, line: Column) -> Column:
        """The message of a line, null where the layout does not match. A line has no line break."""
        whole = self.pattern if self.pattern[0] == "^" and self.pattern[-1] == "$" else f"^.*?(?:{self.pattern}).*$"
        found = F.regexp_replace(line, JAVA_FLAGS + whole, f"\n${self.info_group}")
        if self.literal:
            found = F.when(F.contains(line, F.lit(self.literal)), found)
        return found

    def reader(self) -> tuple:
        """Layouts with the same reader make the same of equal messages."""
        return self.fields, self.clock, self.offset, self.first_look


def _until_blank(line: Column) -> Column:
    return F.array(F.substring_index(line, " ", 1))


def _first_word(line: Column) -> Column:
    return F.array(F.regexp_extract(line, r"(?Ud)^\s*(\S+)", 1))


def _iso_clock(fields: Column, as_of: AsOf) -> Column:
    return t.iso_clock(F.get(fields, 0))


def _iso_offset(fields: Column) -> Column:
    return t.iso_offset_minutes(F.get(fields, 0))


def _syslog_fields(line: Column) -> Column:
    return t.syslog_fields(F.regexp_extract(line, r"(?Ud)^(\w+\s+\d{1,2}\s+\d{2}:\d{2}:\d{2})", 1))


def _syslog_clock(fields: Column, as_of: AsOf) -> Column:
    return t.syslog_clock(fields, as_of.year, as_of.month)


# In order of precedence.
FORMATS = (
    LogFormat(ISO_NAME, ISO, 3, _until_blank, _iso_clock, _iso_offset),
    # its pattern is not anchored and slow to fail; few other lines contain a plus
    LogFormat(JOURNALD_NAME, JOURNALD, 3, _first_word, _iso_clock, _iso_offset, literal="+"),
    LogFormat(RHEL_NAME, RHEL, 4, _syslog_fields, _syslog_clock, literal="sshd"),
    LogFormat(SYSLOG_NAME, SYSLOG, 4, _syslog_fields, _syslog_clock),
)


def format_names(formats: tuple[LogFormat, ...] = FORMATS) -> list[str]:
    return [f.name for f in formats]


def format_index(name: str, formats: tuple[LogFormat, ...] = FORMATS) -> int:
    """Position of a layout by name, in any case."""
    for i, known in enumerate(formats):
        if known.name.lower() == name.lower():
            return i
    raise ValueError(f"unknown format {name!r}, expected one of {format_names(formats)}")


def first_format(line: Column, formats: tuple[LogFormat, ...] = FORMATS) -> Column:
    """Index of the first layout that matches a line, null if none does."""
    return F.coalesce(*[F.when(known.matches(line), i) for i, known in enumerate(formats)])


def files_seen(lines: DataFrame, formats: tuple[LogFormat, ...] = FORMATS) -> DataFrame:
    """``file, format, lines``: the layout of the first line of each file that fits any layout, or null.

    A hash aggregate with map-side combine: one row per file and task is shuffled.
    """
    looked = lines.select("file", "pos", first_format(F.col("line"), formats).alias("format"))
    first = F.min_by("format", F.when(F.col("format").isNotNull(), F.col("pos")))
    return looked.groupBy("file").agg(first.alias("format"), F.count("*").alias("lines"))


def detect_formats(lines: DataFrame, formats: tuple[LogFormat, ...] = FORMATS) -> DataFrame:
    """``file, format, lines`` of the files that have a layout."""
    return files_seen(lines, formats).filter(F.col("format").isNotNull())


def with_format(
    lines: DataFrame, formats: tuple[LogFormat, ...] = FORMATS, forced: str | None = None
) -> DataFrame:
    """Add the layout index that each line has to be read with, null if the file has none.

    A forced layout needs no detection scan. Detection joins one row per file back to the
    lines; the lines of hot files are spread.
    """
    if forced is not None:
        return lines.withColumn("format", F.lit(format_index(forced, formats)))
    seen = files_seen(lines, formats)
    counts = seen.select("file", F.col("lines").alias("n"))
    return join_facts(lines, seen.select("file", "format"), ["file"], "pos", counts=counts, how="left")
