"""Text rendering helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def csv_guard(value: Column) -> Column:
    """Prefix text that a spreadsheet would run as a formula with a quote."""
    return F.when(value.rlike(r"^[=+\-@\t\r]"), F.concat(F.lit("'"), value)).otherwise(value)


def two_decimals(value: Column) -> Column:
    """A non-negative double with two decimals, rounded like C's ``%.2f``.

    The exact binary value decides and ties go to the even digit; Spark's own ``round``,
    ``bround`` and ``format_string`` start from the shortest decimal text instead. The
    fraction times 2**60 is a whole number for every value that rounds to 0.01 or more.
    """
    scale = 2**60
    unit = F.lit(scale).cast("decimal(20,0)")

    def cents(v: Column) -> Column:
        scaled = ((v - F.floor(v)) * float(scale)).cast("bigint").cast("decimal(20,0)") * F.lit(100)
        down = F.call_function("div", scaled, unit)
        rest = scaled - down.cast("decimal(20,0)") * unit
        total = F.floor(v) * 100 + down
        half = F.lit(scale // 2).cast("decimal(20,0)")
        up = (rest > half) | ((rest == half) & (F.pmod(total, F.lit(2)) == 1))
        return total + F.when(up, 1).otherwise(0)

    def text(n: Column) -> Column:
        parts = [F.call_function("div", n, F.lit(100)), F.lpad(F.pmod(n, F.lit(100)).cast("string"), 2, "0")]
        return F.concat_ws(".", parts[0].cast("string"), parts[1])

    # each step refers to its input several times: bind it once
    totals = F.transform(F.array(value), cents)
    return F.get(F.transform(totals, text), F.lit(0))


def zero_padded(number: Column, width: int) -> Column:
    """Pad with zeros, never cutting longer numbers."""
    text = number.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def with_thousands(number: Column) -> Column:
    """``1,234,567``."""
    return F.format_number(number, 0)


def padded_right(text: Column, width: int) -> Column:
    """Pad with blanks, never cutting longer text."""
    return F.when(F.length(text) >= width, text).otherwise(F.rpad(text, width, " "))


def starts_with_any(text: Column, prefixes: tuple[str, ...]) -> Column:
    if not prefixes:
        return F.lit(False)
    return F.exists(F.array(*[F.lit(p) for p in prefixes]), lambda p: F.startswith(text, p))
