"""Authentication attempts from log lines of any known layout.

Output of ``attempts``: ``file, pos, ip, username, ts, tz_offset_min, ts_us, success,
event``. ``ts`` is the wall clock of the line; ``ts_us`` is the instant, with lines that
state no UTC offset taken as UTC.

A file is read with the layout of its first readable line. ``scan_once`` reads the text a
single time all the same: it keeps what each line means in every layout that matches it
(most lines mean the same in all of them) and decides at the end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.functions import timestamps as t
from logwarden.functions.addresses import is_valid_ip
from logwarden.operators.attempt_rules import RULES, Dispatch, Rule
from logwarden.operators.compute_once import with_struct
from logwarden.operators.formats import FORMATS, AsOf, LogFormat, format_index, with_format
from logwarden.operators.skew import join_facts
from logwarden.session import stored

UNKNOWN_USER = "<unknown>"
STATS_COUNTERS = ["lines_read", "format_matches", "extract_matches", "failed_timestamps"]
COLUMNS = ("ip", "username", "ts", "tz_offset_min", "ts_us", "success", "event")


def _by_format(fmt: Column, formats: tuple[LogFormat, ...], key, value) -> Column:
    """``value`` of the layout; layouts with equal ``key`` share one branch."""
    branches: dict = {}
    for i, known in enumerate(formats):
        branches.setdefault(key(known), []).append(i)
    choice = F.when(F.lit(False), None)
    for numbers in branches.values():
        choice = choice.when(fmt.isin(numbers), value(formats[numbers[0]]))
    return choice


def _candidates(formats: tuple[LogFormat, ...], rules: tuple[Rule, ...]) -> list[tuple[Rule, list[int] | None]]:
    """Rules in order of precedence, with the layouts they are limited to."""
    looks: dict[Rule, list[int]] = {}
    for i, known in enumerate(formats):
        if known.first_look:
            looks.setdefault(known.first_look, []).append(i)
    return [*looks.items(), *[(rule, None) for rule in rules]]


def _with_attempt(read: DataFrame, info: Column, fmt: Column, formats: tuple[LogFormat, ...], rules: tuple[Rule, ...]) -> DataFrame:
    """Add the struct ``attempt``: what the first matching rule found, even an invalid address."""
    candidates = _candidates(formats, rules)
    dispatch = Dispatch([rule for rule, _ in candidates])
    allowed = [None if limited is None or len(limited) == len(formats) else fmt.isin(limited) for _, limited in candidates]
    read = with_struct(read, "subject", dispatch.subject(info, allowed))
    read = with_struct(read.drop("message"), "hit", dispatch.hit(F.col("subject")))
    mark, user = F.get("hit", 0), F.get("hit", 1)
    fields = F.struct(
        dispatch.of_rule(mark, [rule.event for rule in dispatch.rules]).alias("event"),
        dispatch.of_rule(mark, [rule.success for rule in dispatch.rules]).alias("success"),
        F.when(user == "", UNKNOWN_USER).otherwise(user).alias("username"),
        F.get("hit", 2).alias("ip"),
    )
    return with_struct(read.drop("subject"), "attempt", F.when(F.col("hit").isNotNull(), fields))


def _messages(formats: tuple[LogFormat, ...]) -> Column:
    """For each layout the message after a line break; without one, the layout does not match."""
    return F.struct(*[known.info(F.col("line")).alias(f"f{i}") for i, known in enumerate(formats)])


def _readings(formats: tuple[LogFormat, ...]) -> Column:
    """What a line may mean, by the first layout of each meaning: ``format, mask, info``.

    The mask has a bit for every layout in which the line means the same.
    """
    column = [F.col(f"found.f{i}") for i in range(len(formats))]
    fits = [F.coalesce(F.startswith(c, F.lit("\n")), F.lit(False)) for c in column]
    readings = []
    for i, known in enumerate(formats):
        earlier = [j for j in range(i) if formats[j].reader() == known.reader()]
        later = [j for j in range(i + 1, len(formats)) if formats[j].reader() == known.reader()]
        own = fits[i]
        for j in earlier:
            own = own & ~(fits[j] & (column[j] == column[i]))
        mask = F.lit(1 << i)
        for j in later:
            mask = mask + F.when(fits[j] & (column[j] == column[i]), 1 << j).otherwise(0)
        readings.append(F.when(own, F.struct(F.lit(i).alias("format"), mask.alias("mask"), F.substring(column[i], 2, 1 << 30).alias("info"))))
    return F.filter(F.array(*readings), lambda r: r.isNotNull())


def _parsed(read: DataFrame, as_of: AsOf, formats: tuple[LogFormat, ...], rules: tuple[Rule, ...], keep: list[str]) -> DataFrame:
    """``keep`` and what was read from ``line`` by ``format`` and ``info`` (null where nothing fits)."""
    line, fmt, info = F.col("line"), F.col("format"), F.col("info")
    read = with_struct(read, "time", F.when(info.isNotNull(), _by_format(fmt, formats, lambda f: f.fields, lambda f: f.fields(line))))
    read = read.drop("line")
    # one step per kind of clock: together they exceed what the JIT compiles of one method
    clocks = []
    for clock in dict.fromkeys(known.clock for known in formats):
        mine = [i for i, known in enumerate(formats) if known.clock is clock]
        clocks.append(f"clock{len(clocks)}")
        read = with_struct(read, clocks[-1], F.when(info.isNotNull() & fmt.isin(mine), clock(F.col("time"), as_of)))
    offset = _by_format(fmt, formats, lambda f: f.offset, lambda f: f.offset(F.col("time")))
    read = with_struct(read, "clock", F.when(info.isNotNull(), F.struct(F.coalesce(*clocks).alias("ts"), offset.alias("tz_offset_min"))))
    read = read.drop("time", *clocks)
    ts, offset = F.col("clock.ts"), F.col("clock.tz_offset_min")
    read = _with_attempt(read, F.when(ts.isNotNull(), info), fmt, formats, rules)
    read = with_struct(read, "valid", is_valid_ip(F.col("attempt.ip")))
    us = t.micros_of(ts) - F.coalesce(offset, F.lit(0)).cast("bigint") * t.MINUTE_US
    return read.select(
        *keep,
        "format",
        info.isNotNull().alias("matched"),
        F.when(F.col("valid"), F.col("attempt.ip")).alias("ip"),
        F.col("attempt.username").alias("username"),
        ts.alias("ts"),
        offset.alias("tz_offset_min"),
        us.alias("ts_us"),
        F.col("attempt.success").alias("success"),
        F.col("attempt.event").alias("event"),
    )


def scan_lines(
    lines: DataFrame,
    as_of: AsOf,
    format: str | None = None,
    sticky: bool = True,
    formats: tuple[LogFormat, ...] = FORMATS,
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """Every line with what could be read from it; ``ip`` is null without a valid attempt.

    By default each file keeps the layout of its first readable line, which takes a second
    look at all lines (see ``scan_once`` for attempts and counters from one). ``format``
    forces one layout; ``sticky=False`` lets each line choose.
    """
    keep = [c for c in ("file", "pos") if c in lines.columns]
    found = lambda value: F.when(F.startswith(value, F.lit("\n")), F.substring(value, 2, 1 << 30))
    if format is not None:
        number = format_index(format, formats)
        read = with_struct(lines.withColumn("format", F.lit(number)), "message", formats[number].info(F.col("line")))
        read = with_struct(read, "info", found(F.col("message"))).drop("message")
    elif sticky:
        read = with_struct(with_format(lines, formats), "message", _by_format(F.col("format"), formats, id, lambda f: f.info(F.col("line"))))
        read = with_struct(read, "info", found(F.col("message"))).drop("message")
    else:
        read = with_struct(lines, "found", _messages(formats))
        read = with_struct(read, "reading", F.get(_readings(formats), 0))
        read = read.select(*keep, "line", "reading.format", "reading.info")
    return _parsed(read, as_of, formats, rules, keep)


# --- one scan -------------------------------------------------------------------------

_COUNTERS = ("lines", "matches", "extracts", "failed")
_ATTEMPT, _COUNTER = "attempt", "counter"


@dataclass(frozen=True)
class Scan:
    """What one pass over the text left: attempts, parse statistics per file (see ``parse_stats``), layouts."""

    attempts: DataFrame
    stats: DataFrame
    layouts: DataFrame


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The attempts of a batch of readings, and counters per file and mask."""
    names = ("kind", "file", "pos", "mask", *COLUMNS, *_COUNTERS, "first_pos", "timed_from", "timed_to", "first_ts", "last_ts", "first_us", "last_us")
    schema = None
    for batch in batches:
        table = pa.Table.from_batches([batch]).sort_by("pos")
        kinds = {f.name: f.type for f in table.schema}
        kinds |= {"kind": pa.string(), **{c: pa.int64() for c in (*_COUNTERS, "first_pos", "timed_from", "timed_to", "first_us", "last_us")}}
        kinds |= {"first_ts": kinds["ts"], "last_ts": kinds["ts"]}
        schema = schema or pa.schema([(n, kinds[n]) for n in names])

        def out(columns: dict, rows: int) -> Iterator[pa.RecordBatch]:
            arrays = [columns[n].combine_chunks().cast(schema.field(n).type) if n in columns else pa.nulls(rows, schema.field(n).type) for n in names]
            return iter(pa.Table.from_arrays(arrays, schema=schema).to_batches())  # noqa: B023

        attempts = table.filter(pc.is_valid(table.column("ip")))
        marked = {c: attempts.column(c) for c in ("file", "pos", "mask", *COLUMNS)}
        yield from out(marked | {"kind": pa.chunked_array([pa.array([_ATTEMPT] * len(attempts), pa.string())])}, len(attempts))
        sums = [("lines", "sum"), ("matches", "sum"), ("extracts", "sum"), ("failed", "sum"), ("pos", "min"), ("timed", "min"), ("timed", "max")]
        ends = [(c, e) for c in ("ts", "ts_us") for e in ("first", "last")]
        found = table.group_by(["file", "mask"], use_threads=False).aggregate([*sums, *ends])
        get = {c: found.column(f"{c}_sum") for c in _COUNTERS} | {"file": found.column("file"), "mask": found.column("mask")}
        get |= {"first_pos": found.column("pos_min"), "timed_from": found.column("timed_min"), "timed_to": found.column("timed_max")}
        get |= {"first_ts": found.column("ts_first"), "last_ts": found.column("ts_last"), "first_us": found.column("ts_us_first"), "last_us": found.column("ts_us_last")}
        yield from out(get | {"kind": pa.chunked_array([pa.array([_COUNTER] * len(found), pa.string())])}, len(found))


def _stored_readings(lines: DataFrame, as_of: AsOf, formats: tuple[LogFormat, ...], rules: tuple[Rule, ...]) -> DataFrame:
    """Attempts in any layout, and counters per file, mask and batch of lines, as one stored table."""
    read = with_struct(lines, "found", _messages(formats))
    read = with_struct(read, "readings", _readings(formats)).drop("found")
    read = read.select("file", "pos", "line", F.posexplode_outer("readings").alias("nth", "reading"))
    read = read.select("file", "pos", "line", F.coalesce("nth", F.lit(0)).alias("nth"), "reading.*")
    rows = _parsed(read, as_of, formats, rules, ["file", "pos", "mask", "nth"])
    one = lambda condition: F.when(condition, F.lit(1).cast("bigint")).otherwise(0)
    timed = F.col("ts").isNotNull()
    rows = rows.select(
        "file",
        "pos",
        F.coalesce("mask", F.lit(0)).alias("mask"),
        *COLUMNS,
        one(F.col("nth") == 0).alias("lines"),
        one(F.col("matched")).alias("matches"),
        one(F.col("ip").isNotNull()).alias("extracts"),
        one(F.col("matched") & ~timed).alias("failed"),
        F.when(timed, F.col("pos")).alias("timed"),
    )
    types = dict(rows.dtypes)
    fields = [("kind", "string"), *[(c, types[c]) for c in ("file", "pos", "mask", *COLUMNS)], *[(c, "bigint") for c in (*_COUNTERS, "first_pos", "timed_from", "timed_to")]]
    fields += [("first_ts", "timestamp_ntz"), ("last_ts", "timestamp_ntz"), ("first_us", "bigint"), ("last_us", "bigint")]
    return stored(rows.mapInArrow(_partial, ", ".join(f"{n} {kind}" for n, kind in fields)), partition_by="kind")


def scan_once(
    lines: DataFrame,
    as_of: AsOf,
    format: str | None = None,
    formats: tuple[LogFormat, ...] = FORMATS,
    rules: tuple[Rule, ...] = RULES,
    files: DataFrame | None = None,
    known: Callable[[DataFrame], DataFrame] | None = None,
) -> Scan:
    """Attempts and statistics of ``file, pos, line`` from a single pass over the lines.

    What is stored grows with the attempts; lines without one leave counters per file and
    batch. Which layout a file has is then read from the counters, and the attempts of that
    layout are kept. ``files`` (see ``list_files``) adds files without lines, with zeros.
    ``known`` gives layouts found earlier (``file, layout``) for the files of a table; these
    hold whatever the lines say.
    """
    if format is not None:
        number = format_index(format, formats)
        kept, offset = (formats[number],), number
    else:
        kept, offset = formats, 0
    table = _stored_readings(lines, as_of, kept, rules)
    counters = table.filter(F.col("kind") == _COUNTER)
    lowest = F.coalesce(*[F.when(F.col("mask").bitwiseAND(1 << i) != 0, i) for i in range(len(kept))])
    first = F.min(F.when(F.col("mask") > 0, F.struct("first_pos", lowest.alias("format"))))
    # with a forced layout, files that it does not fit have it as well
    layout = F.coalesce(first["format"], F.lit(0)) if format is not None else first["format"]
    layouts = stored(counters.groupBy("file").agg(layout.alias("layout"), F.sum("extracts").alias("n")))
    if known is not None and format is None:
        before = known(layouts).select("file", F.col("layout").alias("before"))
        layouts = stored(layouts.join(before, "file", "left").select("file", F.coalesce("before", "layout").alias("layout"), "n"))
    has_layout = F.call_function("shiftright", F.col("mask"), F.col("layout")).bitwiseAND(1) == 1
    found = table.filter(F.col("kind") == _ATTEMPT).select("file", "pos", "mask", *COLUMNS)
    joined = join_facts(found, layouts.select("file", "layout"), ["file"], "pos", counts=layouts.select("file", "n"))
    attempts = joined.filter(has_layout).select("file", "pos", *COLUMNS)

    placed = counters.join(layouts.select("file", "layout"), "file")
    of_layout = lambda c: F.when(has_layout, F.col(c))
    total = lambda c: F.coalesce(F.sum(of_layout(c)), F.lit(0).cast("bigint"))
    stats = placed.groupBy("file").agg(
        F.sum("lines").alias("lines_read"),
        total("matches").alias("format_matches"),
        total("extracts").alias("extract_matches"),
        total("failed").alias("failed_timestamps"),
        F.max(F.col("layout") + offset).alias("format"),
        F.min_by(of_layout("first_ts"), of_layout("timed_from")).alias("first_ts"),
        F.max_by(of_layout("last_ts"), of_layout("timed_to")).alias("last_ts"),
        F.min_by(of_layout("first_us"), of_layout("timed_from")).alias("first_us"),
        F.max_by(of_layout("last_us"), of_layout("timed_to")).alias("last_us"),
    )
    if files is not None:
        stats = files.select("file").join(stats, "file", "left").fillna(0, STATS_COUNTERS)
    return Scan(attempts, stats, layouts.select("file", (F.col("layout") + offset).alias("layout")))


def attempts(scanned: DataFrame) -> DataFrame:
    """The valid attempts among scanned lines."""
    keep = [c for c in ("file", "pos") if c in scanned.columns]
    return scanned.filter(F.col("ip").isNotNull()).select(*keep, *COLUMNS)


def admit(rows: DataFrame) -> DataFrame:
    """Keep attempts from other sources only with a valid address and time.

    Names may be anything, also hostile text: they are data and pass unchanged.
    """
    kept = rows.filter(is_valid_ip(F.col("ip")) & F.col("ts").isNotNull())
    return kept.withColumns(
        {
            "username": F.coalesce("username", F.lit(UNKNOWN_USER)),
            "success": F.coalesce(F.col("success").cast("boolean"), F.lit(False)),
        }
    )


def parse_stats(scanned: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Counters per file, and the first and last time in line order (not the extremes).

    Pass ``files`` (see ``list_files``) to report empty files with zeros.
    """
    timed = F.when(F.col("ts").isNotNull(), F.col("pos"))
    stats = scanned.groupBy("file").agg(
        F.count("*").alias("lines_read"),
        F.count_if("matched").alias("format_matches"),
        F.count("ip").alias("extract_matches"),
        F.count_if(F.col("matched") & F.col("ts").isNull()).alias("failed_timestamps"),
        F.max("format").alias("format"),
        F.min_by("ts", timed).alias("first_ts"),
        F.max_by("ts", timed).alias("last_ts"),
        F.min_by("ts_us", timed).alias("first_us"),
        F.max_by("ts_us", timed).alias("last_us"),
    )
    if files is None:
        return stats
    return files.select("file").join(stats, "file", "left").fillna(0, STATS_COUNTERS)


def with_format_name(stats: DataFrame, formats: tuple[LogFormat, ...] = FORMATS) -> DataFrame:
    """Replace the layout index by its name."""
    names = F.array(*[F.lit(f.name) for f in formats])
    return stats.withColumn("format", F.get(names, F.col("format")))
