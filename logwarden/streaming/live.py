"""The threat summary of a growing log, with Structured Streaming.

Lines arrive as files landing in a folder. The running totals per address live in the
state store; a refresh brings the totals of the addresses that changed, which go into a
versioned table (see ``versions``), so it costs what arrived, however long the history is.
Readers see one refresh as a whole, or the one before. State is unbounded in the number of
addresses, as it has to be for an exact cumulative summary.

The blocklist is a stream of its own: addresses that a refresh found severe land in a folder,
and those that the state store has not seen yet are appended. No refresh reads the list.

``start_live_attempts`` reads lines with a memory of each file's layout, and lands attempts
that the summary can follow.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logwarden.operators import threat
from logwarden.operators.attempts import COLUMNS, attempts, scan_lines, scan_once
from logwarden.operators.formats import AsOf
from logwarden.params import DEFAULTS, Params
from logwarden.session import scratch
from logwarden.sources.folders import exists, make_folder
from logwarden.sources.sinks import write_summary_csv
from logwarden.streaming.versions import Refresh, VersionedTable

DEFAULT_REFRESH_SECONDS = 5.0
CSV = "summary_csv"
_TOTALS = "ip string, attempts bigint, seen bigint, first_us bigint, last_us bigint, first_offset int, last_offset int"
_ATTEMPTS = "file string, ip string, username string, ts timestamp_ntz, tz_offset_min int, ts_us bigint, success boolean, event string"


def live_attempts(lines: DataFrame, as_of: AsOf, format: str | None = None) -> DataFrame:
    """Attempts of streaming lines. Each line chooses its layout unless one is forced."""
    return attempts(scan_lines(lines, as_of, format, sticky=False))


def refresh_seconds(value: float | None) -> float:
    """The refresh interval: any positive number of seconds, 5 by default."""
    seconds = DEFAULT_REFRESH_SECONDS if value is None else float(value)
    if not seconds > 0:
        raise ValueError(f"the refresh interval must be positive, got {value!r}")
    return seconds


def totals_table(spark: SparkSession, out: str) -> VersionedTable:
    return VersionedTable(spark, f"{out}/totals", _TOTALS, "ip")


@dataclass
class LiveSummary:
    """The summary's query, and the blocklist's, which follows it."""

    summary: StreamingQuery
    blocklist: StreamingQuery | None
    drained: object = None  # starts the blocklist's query once the summary's has drained

    def awaitTermination(self, timeout: float | None = None) -> bool | None:
        """Wait for the end of the summary (with ``drain``, of both)."""
        done = self.summary.awaitTermination(timeout) if timeout else self.summary.awaitTermination()
        if self.drained and done is not False:
            self.blocklist, self.drained = self.drained(), None
            self.blocklist.awaitTermination()
        return done

    def processAllAvailable(self) -> None:
        self.summary.processAllAvailable()
        if self.blocklist:
            self.blocklist.processAllAvailable()

    def stop(self) -> None:
        for query in (self.summary, self.blocklist):
            if query:
                query.stop()

    @property
    def isActive(self) -> bool:
        return self.summary.isActive

    def exception(self):
        return self.summary.exception() or (self.blocklist and self.blocklist.exception())


def _triggered(writer, drain: bool, refresh: float | None) -> StreamingQuery:
    if drain:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{int(refresh_seconds(refresh) * 1000)} milliseconds").start()


def start_live_summary(
    found: DataFrame,
    out: str,
    params: Params = DEFAULTS,
    whitelist: DataFrame | None = None,
    refresh: float | None = None,
    snapshot: bool = True,
    drain: bool = False,
) -> LiveSummary:
    """Keep the summary under ``out`` up to date from streaming attempts.

    Every refresh publishes the totals of the addresses that changed and extends the
    blocklist. ``snapshot=True`` also writes the summary file of each refresh, which sorts
    all addresses; without it, ``publish_csv`` writes one when it is asked for. ``drain=True``
    processes what is there and stops (also the way to get a final summary after a stop).

    The blocklist is append-only: an address stays even if its severity falls later, over
    restarts too. The folders ``out/checkpoint`` and ``out/blocklist_checkpoint`` hold
    offsets and state.
    """
    spark = found.sparkSession
    make_folder(spark, f"{out}/candidates")

    def publish(changed: DataFrame, batch_id: int) -> None:
        table = totals_table(changed.sparkSession, out)
        published = table.latest()
        if published and published.batch >= batch_id:
            return  # retried after it had been published
        stored, now = table.merge(changed, batch_id)
        severe = threat.blocklist_candidates(threat.classify(stored, params), whitelist, params)
        severe.select("ip").write.mode("append").parquet(f"{out}/candidates")
        csv = published.extra(CSV) if published else None
        if snapshot and write_summary_csv(threat.classify(table.read(now), params), table.extra_folder(CSV, batch_id)):
            csv = batch_id
        table.publish(now, **{CSV: csv})

    totals = threat.ip_totals(found.drop("pos"))
    writer = totals.writeStream.foreachBatch(publish).outputMode("update").option("checkpointLocation", f"{out}/checkpoint")

    def blocklist() -> StreamingQuery:
        return _start_blocklist(spark, out, refresh, drain)

    summary = _triggered(writer, drain, refresh)
    return LiveSummary(summary, None, blocklist) if drain else LiveSummary(summary, blocklist())


def _start_blocklist(spark: SparkSession, out: str, refresh: float | None, drain: bool) -> StreamingQuery:
    """Append the candidates that were never seen before; the state store remembers them."""
    landed = spark.readStream.schema("ip string").option("cleanSource", "delete").option("ignoreMissingFiles", True)
    fresh = landed.parquet(f"{out}/candidates").dropDuplicates(["ip"])

    def append(batch: DataFrame, batch_id: int) -> None:
        # a retried batch overwrites its own part
        batch.write.mode("overwrite").text(f"{out}/blocklist/batch={batch_id}")

    writer = fresh.writeStream.foreachBatch(append).outputMode("append").option("checkpointLocation", f"{out}/blocklist_checkpoint")
    return _triggered(writer, drain, refresh)


def _published(spark: SparkSession, out: str) -> Refresh:
    refresh = totals_table(spark, out).latest()
    if refresh is None:
        raise FileNotFoundError(f"no refresh has finished under {out}")
    return refresh


def current_totals(spark: SparkSession, out: str) -> DataFrame:
    """The totals of the latest finished refresh."""
    return totals_table(spark, out).read(_published(spark, out))


def current_summary(spark: SparkSession, out: str, params: Params = DEFAULTS) -> DataFrame:
    """The latest summary, filtered by ``params.filter_severity``."""
    return threat.severity_filter(threat.classify(current_totals(spark, out), params), params.filter_severity)


def current_coverage(spark: SparkSession, out: str) -> DataFrame:
    """One row: addresses, attempts and the time covered so far."""
    found = current_totals(spark, out).agg(
        F.count("*").alias("ips"),
        F.sum("seen").alias("attempts"),
        F.min("first_us").alias("first_us"),
        F.max("last_us").alias("last_us"),
    )
    return found.withColumn("duration_us", F.col("last_us") - F.col("first_us"))


def current_csv(spark: SparkSession, out: str) -> str | None:
    """The folder of the latest finished summary file; None before there is one."""
    version = _published(spark, out).extra(CSV)
    return None if version is None else totals_table(spark, out).extra_folder(CSV, version)


def write_current_csv(spark: SparkSession, out: str, path: str, params: Params = DEFAULTS) -> bool:
    """Write the summary file of the latest finished refresh to ``path``."""
    return write_summary_csv(threat.classify(current_totals(spark, out), params), path)


# --- attempts of lines, with a memory of layouts ---------------------------------------

def part_of(file: Column) -> Column:
    """The log that a landed file continues: its path without a number at the end (``auth.log.17``)."""
    return F.regexp_replace(file, "[.-][0-9]+$", "")


def start_live_attempts(
    lines: DataFrame,
    as_of: AsOf,
    out: str,
    format: str | None = None,
    log: Callable[[Column], Column] = part_of,
    refresh: float | None = None,
    drain: bool = False,
) -> StreamingQuery:
    """Land the attempts of streaming lines under ``out``; follow them with ``landed_attempts``.

    The first readable line of a log decides its layout for good, also for the parts of it
    that land in later batches and after a restart; ``log`` tells from a file's path which log
    it is part of. Each batch reads its lines once. The layouts are a versioned table, of which
    a batch reads the buckets of its own logs.
    """
    make_folder(lines.sparkSession, f"{out}/attempts")

    def land(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        table = VersionedTable(spark, f"{out}/layouts", "file string, layout int", "file")
        published = table.latest()
        if published and published.batch >= batch_id:
            return
        with scratch(spark):
            read(batch, batch_id, table, published)

    def read(batch: DataFrame, batch_id: int, table: VersionedTable, published: Refresh | None) -> None:
        spark, target = batch.sparkSession, f"{out}/attempts/batch={batch_id}"
        numbered = batch.withColumns({"file": log(F.col("file")), "pos": F.monotonically_increasing_id()})
        known = lambda files: table.read(published, sorted(r[0] for r in files.select(table.bucket_of()).distinct().collect()))
        scan = scan_once(numbered, as_of, format, known=known)
        # complete or absent: attempts that the summary may have followed are not written again
        if not exists(spark, f"{target}/_SUCCESS"):
            scan.attempts.select("file", *COLUMNS).write.mode("overwrite").parquet(target)
        _, now = table.merge(scan.layouts.filter("layout is not null"), batch_id)
        table.publish(now)

    writer = lines.writeStream.foreachBatch(land).option("checkpointLocation", f"{out}/attempts_checkpoint")
    return _triggered(writer, drain, refresh)


def landed_attempts(spark: SparkSession, out: str) -> DataFrame:
    """The attempts that ``start_live_attempts`` lands, as a stream."""
    make_folder(spark, f"{out}/attempts")
    return spark.readStream.schema(f"{_ATTEMPTS}, batch bigint").parquet(f"{out}/attempts").drop("batch")
