"""Wall seconds of headline queries; prints one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores. Each query runs ``BENCH_RUNS``
times (2) from building its plan on; the best run counts. Parsing is also measured in lines
per second on replicas of the generated log text (``BENCH_REPLICAS``, 0 leaves it out).
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from checks import registry  # noqa: E402
from checks import views as v  # noqa: E402
from logwarden.operators import threat  # noqa: E402
from logwarden.operators.attempts import scan_once  # noqa: E402
from logwarden.operators.auth_events import auth_events  # noqa: E402
from logwarden.operators.formats import AsOf  # noqa: E402
from logwarden.session import local_session, shared_folder  # noqa: E402
from logwarden.sources.lines import read_lines  # noqa: E402

HEADLINES = (
    "parse_auth_lines extract_attempts off_hours bruteforce burst compromise all_alerts ip_summary threat_top_n "
    "threat_breakdown coverage blocklist_candidates enriched_alerts flagged_ips hourly_timeline incident_ids live_summary"
).split()


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def best(action, runs: int) -> float:
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def text_rates(spark: SparkSession, sf_dir: str, replicas: int, runs: int) -> dict[str, float]:
    """Million lines per second from log text on disk."""
    folder = f"{shared_folder(spark)}/bench-{uuid.uuid4().hex}"
    copies = spark.range(replicas).select(F.col("id").alias("copy"))
    lines = v.lines(spark, sf_dir).select("line")
    lines.join(F.broadcast(copies)).select("line").repartition(8).write.mode("overwrite").text(folder)
    count = spark.read.text(folder).count()

    def events() -> DataFrame:
        return auth_events(read_lines(spark, folder), 2024)

    def found() -> DataFrame:
        return scan_once(read_lines(spark, folder, "drop"), AsOf(2024, 6)).attempts

    def summary() -> DataFrame:
        return threat.ip_summary(found())

    jobs = {"text_to_events": events, "text_to_attempts": found, "text_to_summary": summary}
    return {name: round(count / best(lambda job=job: run(job()), runs) / 1e6, 3) for name, job in jobs.items()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    replicas = int(os.environ.get("BENCH_REPLICAS", "10"))
    cpus = int(os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8)))
    spark = local_session(cpus, app="bench", **{"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    wanted = os.environ.get("BENCH_QUERIES", "").split() or HEADLINES
    queries = registry.queries()
    seconds = {}
    for name in wanted:
        seconds[name] = best(lambda name=name: run(queries[name](spark, sf_dir)), runs)
        print(name, seconds[name], file=sys.stderr, flush=True)
    rates = text_rates(spark, sf_dir, replicas, runs) if replicas else {}
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")),
        "text_million_lines_per_sec": rates,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
