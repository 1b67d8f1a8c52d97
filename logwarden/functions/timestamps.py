"""Time expressions that never look at the session time zone.

Event times are wall clocks (``timestamp_ntz``). Arithmetic happens on ``bigint``
microseconds since 1970-01-01 00:00; several Spark functions on ``timestamp_ntz``
(``unix_micros``, ``timestampdiff``, ``date_trunc``) go through the session zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND_US = 1_000_000
MINUTE_US = 60 * SECOND_US
HOUR_US = 60 * MINUTE_US
DAY_US = 24 * HOUR_US

# Month abbreviations used by syslog.
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def micros_of(ts: Column) -> Column:
    """``timestamp_ntz`` -> microseconds since the epoch."""
    seconds = F.call_function("date_part", F.lit("SECOND"), ts)  # decimal(8,6)
    return (
        F.unix_date(ts.cast("date")).cast("bigint") * DAY_US
        + F.hour(ts).cast("bigint") * HOUR_US
        + F.minute(ts).cast("bigint") * MINUTE_US
        + (seconds * SECOND_US).cast("bigint")
    )


def from_micros(us: Column) -> Column:
    """Microseconds since the epoch -> ``timestamp_ntz``."""
    of_day = F.pmod(us, F.lit(DAY_US)).cast("decimal(18,0)")
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(
        days=floor_div(us, DAY_US).cast("int"),
        secs=(of_day / F.lit(SECOND_US)).cast("decimal(18,6)"),
    )


def floor_div(value: Column, unit: int) -> Column:
    """Exact floored integer division, also for negative values."""
    return F.call_function("div", floor_to(value, unit), F.lit(unit).cast("bigint"))


def floor_to(value: Column, unit: int) -> Column:
    return value - F.pmod(value, F.lit(unit).cast("bigint"))


def hour_of(us: Column) -> Column:
    return floor_div(F.pmod(us, F.lit(DAY_US)), HOUR_US).cast("int")


def iso_text(ts: Column) -> Column:
    """``2026-05-26T02:13:13``, with six fraction digits only when there is a fraction."""
    text = F.replace(ts.cast("string"), F.lit(" "), F.lit("T"))
    whole, fraction = F.split_part(text, F.lit("."), F.lit(1)), F.split_part(text, F.lit("."), F.lit(2))
    return F.when(fraction == "", whole).otherwise(F.concat(whole, F.lit("."), F.rpad(fraction, 6, "0")))


def offset_text(minutes: Column) -> Column:
    """UTC offset as ``+02:00``; empty for a wall clock without offset."""
    size = F.abs(minutes)
    hours, rest = floor_div(size, 60), F.pmod(size, F.lit(60))
    return F.when(minutes.isNull(), "").otherwise(
        F.concat(
            F.when(minutes < 0, "-").otherwise("+"),
            F.lpad(hours.cast("string"), 2, "0"),
            F.lit(":"),
            F.lpad(rest.cast("string"), 2, "0"),
        )
    )


def clock_text(ts: Column) -> Column:
    return F.substring(ts.cast("string"), 12, 8)


def duration_text(us: Column) -> Column:
    """``2h 3m 15s`` or ``7m 4s``, truncated to seconds."""
    total = floor_div(F.abs(us), SECOND_US)
    hours = floor_div(total, 3600)
    minutes = floor_div(F.pmod(total, F.lit(3600)), 60)
    seconds = F.pmod(total, F.lit(60))
    short = F.concat(minutes.cast("string"), F.lit("m "), seconds.cast("string"), F.lit("s"))
    return F.when(hours > 0, F.concat(hours.cast("string"), F.lit("h "), short)).otherwise(short)


def month_number(name: Column, any_case: bool) -> Column:
    """1..12 for a month abbreviation, else null."""
    names = "".join(MONTHS)
    found = F.instr(F.lit(names.lower()), F.lower(name)) if any_case else F.instr(F.lit(names), name)
    aligned = (F.length(name) == 3) & (F.pmod(found, F.lit(3)) == 1)
    return F.when(aligned, floor_div(found + 2, 3).cast("int"))


def _number(text: Column) -> Column:
    return F.when(F.length(text) <= 2, text.try_cast("int"))


def _wall_clock(year, month, day, hour, minute, second) -> Column:
    # the constructor would roll second 60 over into the next minute
    return F.when(
        second < 60,
        F.call_function("try_make_timestamp_ntz", year, month, day, hour, minute, second.cast("decimal(16,6)")),
    )


def syslog_fields(stamp: Column) -> Column:
    """``May 26 02:13:01`` -> array of month, day, hour, minute and second texts."""
    # split() would compile the pattern anew for every row
    return F.split(F.regexp_replace(stamp, r"(?U)[\s:]+", " "), " ")


def syslog_clock(
    fields: Column, as_of_year: int, as_of_month: int | None = None, any_case: bool = False
) -> Column:
    """Syslog fields -> ``timestamp_ntz``, null when they are no valid time.

    Syslog carries no year. Without ``as_of_month`` the year is ``as_of_year``; with it,
    months after ``as_of_month`` belong to the year before.
    """
    month = month_number(F.get(fields, 0), any_case)
    year = F.lit(as_of_year)
    if as_of_month is not None:
        year = F.when(month > as_of_month, as_of_year - 1).otherwise(as_of_year)
    return _wall_clock(year, month, *[_number(F.get(fields, i)) for i in (1, 2, 3, 4)])


_ISO = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:[+-]\d{2}:\d{2})?$"


def iso_clock(token: Column) -> Column:
    """ISO date-time token -> wall clock; fraction digits after the sixth are cut off."""
    part = lambda start, size: F.substring(token, start, size).try_cast("int")
    fraction = F.regexp_extract(token, r"\.(\d{1,6})", 1)
    second = F.concat(F.substring(token, 18, 2), F.lit("."), F.rpad(fraction, 6, "0")).try_cast("decimal(16,6)")
    valid = token.rlike(_ISO) & (part(1, 4) >= 1) & F.coalesce(F.abs(iso_offset_minutes(token)) < 1440, F.lit(True))
    return F.when(valid, _wall_clock(part(1, 4), part(6, 2), part(9, 2), part(12, 2), part(15, 2), second))


def iso_offset_minutes(token: Column) -> Column:
    """UTC offset of an ISO token in minutes, null when it has none."""
    tail = F.substring(token, -6, 6)
    size = F.substring(tail, 2, 2).try_cast("int") * 60 + F.substring(tail, 5, 2).try_cast("int")
    minus = F.startswith(tail, F.lit("-"))
    return F.when(minus | F.startswith(tail, F.lit("+")), F.when(minus, -size).otherwise(size))
