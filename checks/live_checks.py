"""Streams over the ``events`` table, drained to their end; results equal the batch ones."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import threat_checks as tc
from checks import views as v
from checks.alert_checks import log_folder
from logwarden.operators.formats import AsOf
from logwarden.params import DEFAULTS
from logwarden.session import shared_folder
from logwarden.sources.ip_lists import read_blocklist
from logwarden.sources.lines import stream_lines
from logwarden.streaming import live


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = v.events_table(spark, sf_dir).schema
    landed = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return v.as_attempts(v.auth_from(landed)).drop("pos")


def _drained(spark: SparkSession, sf_dir: str, snapshot: bool = False) -> str:
    out = f"{shared_folder(spark)}/live-{uuid.uuid4().hex}"
    query = live.start_live_summary(
        _stream(spark, sf_dir), out, whitelist=tc.whitelist(spark), snapshot=snapshot, drain=True
    )
    query.awaitTermination()
    return out


def live_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = live.current_summary(spark, _drained(spark, sf_dir))
    return found.select(*[c for c in tc._COLUMNS if c != "first_pos"])


def live_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live.current_coverage(spark, _drained(spark, sf_dir))


def live_blocklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_blocklist(spark, f"{_drained(spark, sf_dir)}/blocklist")


def _csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).csv(path).select(*[F.col(c) for c in tc.th.CSV_COLUMNS])


def live_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary file of a stream that writes one per refresh."""
    return _csv(spark, live.current_csv(spark, _drained(spark, sf_dir, snapshot=True)))


def live_csv_asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary file written when it is asked for."""
    out = _drained(spark, sf_dir)
    live.write_current_csv(spark, out, f"{out}/asked")
    return _csv(spark, f"{out}/asked")


def live_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log text in several files, streamed: attempts land first, the summary follows them."""
    out = f"{shared_folder(spark)}/live-{uuid.uuid4().hex}"
    lines = stream_lines(spark, log_folder(spark, sf_dir, 8), max_files_per_batch=3)
    live.start_live_attempts(lines, AsOf(2024, 6), out, drain=True).awaitTermination()
    found = live.landed_attempts(spark, out)
    live.start_live_summary(found, f"{out}/summary", snapshot=False, drain=True).awaitTermination()
    return live.current_summary(spark, f"{out}/summary").select(*[c for c in tc._COLUMNS if c != "first_pos"])


def live_quiet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The preset that shows severe addresses only."""
    found = live.current_summary(spark, _drained(spark, sf_dir), DEFAULTS.quiet())
    return found.select(*[c for c in tc._COLUMNS if c != "first_pos"])


_LIVE_COLUMNS = ", ".join(c for c in tc._COLUMNS if c != "first_pos")

CHECKS = {
    "live_summary": (live_summary, tc._sql(f"select {_LIVE_COLUMNS} from summary")),
    "live_text": (live_text, tc._sql(f"select {_LIVE_COLUMNS} from summary")),
    "live_quiet": (live_quiet, tc._sql(f"select {_LIVE_COLUMNS} from summary where severity in ('CRITICAL', 'HIGH')")),
    "live_coverage": (live_coverage, tc.CHECKS["coverage"][1]),
    "live_blocklist": (live_blocklist, tc.CHECKS["blocklist_candidates"][1]),
    "live_csv": (live_csv, tc.CHECKS["csv_summary"][1]),
    "live_csv_asked": (live_csv_asked, tc.CHECKS["csv_summary"][1]),
}
