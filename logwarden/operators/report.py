"""The incident report and the console summary, as tables of text lines.

Lines carry their sort key, so that a report of any size is written by a distributed sort:
``section, grp, num, key, line_no, line``.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.functions import timestamps as t
from logwarden.functions.lookups import SUMMARY_ACTIONS, recommendations, technique_id, technique_name
from logwarden.functions.severity import SEVERITIES, severity_rank
from logwarden.functions.text import padded_right, zero_padded
from logwarden.operators import rollups
from logwarden.operators.detections import LOCALHOST
from logwarden.operators.enrich import intel_lines, intel_suffix
from logwarden.operators.numbering import number_within
from logwarden.session import durable

HEADER, EXECUTIVE, FLAGGED, DETAILS, ACTIONS, FOOTER = range(1, 7)
ORDER = ["section", "grp", "num", "key", "line_no"]

# Severity tags of the detail section.
TAGS = {"CRITICAL": "[CRIT]", "HIGH": "[HIGH]", "MEDIUM": "[ MED]", "LOW": "[ LOW]"}


def incident_numbers(alerts: DataFrame) -> DataFrame:
    """Number alerts 1, 2, 3 … within each severity, in report order (column ``number``)."""
    ranked = alerts.withColumn("severity_rank", severity_rank(F.col("severity")))
    return number_within(ranked, "severity_rank", ["ts_us", "detector", "pos"])


def incident_id(prefix: Column, severity: Column, number: Column) -> Column:
    """``<prefix>-C001``; the severity's letter keeps ids unique although numbers restart."""
    return F.concat(prefix, F.lit("-"), F.substring(severity, 1, 1), zero_padded(number, 3))


def alert_actions(alerts: DataFrame) -> DataFrame:
    """One row per alert and recommended action, with the action's place in its list."""
    return alerts.select(
        "detector", "pos", "type", F.posexplode(recommendations(F.col("type"))).alias("action_no", "action")
    )


def summary_actions(alerts: DataFrame) -> DataFrame:
    """``line_no, line``: closing advice for the severities and types that occur."""
    return _advice_rows(alerts.agg(*_advice_wanted()))


def _advice_wanted() -> list[Column]:
    return [F.max(F.col(field) == value).alias(f"a{i}") for i, (field, value, _) in enumerate(SUMMARY_ACTIONS)]


def _advice_rows(present: DataFrame) -> DataFrame:
    rows = F.array(
        *[F.struct(F.lit(i).alias("line_no"), F.lit(line).alias("line"), F.col(f"a{i}").alias("wanted"))
          for i, (_, _, line) in enumerate(SUMMARY_ACTIONS)]
    )
    return present.select(F.inline(rows)).filter(F.col("wanted")).select("line_no", "line")


def _rule(title: str, dashes: int) -> str:
    return f"-- {title} " + "-" * dashes


def _lines(df: DataFrame, section: int, lines: Column, grp=None, num=None, key=None) -> DataFrame:
    """Explode an array of lines into report rows; lines that are null are left out."""
    number = lambda c, kind: F.lit(0).cast(kind) if c is None else c.cast(kind)
    return df.select(
        F.lit(section).alias("section"),
        number(grp, "int").alias("grp"),
        number(num, "bigint").alias("num"),
        (F.lit("") if key is None else key).alias("key"),
        F.posexplode(lines).alias("line_no", "line"),
    ).filter(F.col("line").isNotNull())


def _texts(*lines: str | Column) -> Column:
    return F.array(*[F.lit(line) if isinstance(line, str) else line for line in lines])


def _labelled(label: str, value: Column) -> Column:
    return F.concat(F.lit(label), value.cast("string"))


def report_lines(
    alerts: DataFrame,
    source: str,
    generated_at: datetime,
    analyst: str = "[L1 SOC Analyst]",
    tool: str = "logwarden",
) -> DataFrame:
    """All lines of the incident report, unsorted (sort by ``ORDER``).

    Alerts are numbered, and thereby stored, once. Two passes over that table make the report:
    one aggregate by type and by address and severity, from which all sections but the last
    come, and the details.
    """
    prefix = f"INC-{generated_at:%Y%m%d-%H%M%S}"
    numbered = incident_numbers(alerts)
    bar = "=" * 78

    groups = durable(rollups.alert_groups(numbered))
    per_ip = F.col("by_ip")
    of_severity = lambda x: F.sum(F.when(per_ip & (F.col("severity") == x), F.col("n")))
    totals = durable(
        groups.agg(
            F.coalesce(F.sum(F.when(per_ip, F.col("n"))), F.lit(0)).alias("total"),
            F.count_distinct(F.when(per_ip & (F.col("ip") != LOCALHOST), F.col("ip"))).alias("ips"),
            rollups.worst_severity(),
            *[F.coalesce(of_severity(x), F.lit(0)).alias(x) for x in SEVERITIES],
            *_advice_wanted(),
        )
    )
    header = _lines(
        totals,
        HEADER,
        _texts(
            bar,
            "                 ENTERPRISE SOC INCIDENT REPORT",
            bar,
            f"  Incident ID     : {prefix}",
            f"  Generated At    : {generated_at:%Y-%m-%d %H:%M:%S}",
            f"  Log Source      : {source}",
            _labelled("  Overall Severity: ", F.col("overall_severity")),
            f"  Analyst         : {analyst}",
            "  Status          : Open — Pending L2 Review",
            bar,
            "",
        ),
    )

    executive = _lines(
        totals,
        EXECUTIVE,
        _texts(
            _rule("EXECUTIVE SUMMARY", 56),
            _labelled("  Total Alerts   : ", F.col("total")),
            *[_labelled(f"  {s:<15}: ", F.col(s)) for s in SEVERITIES],
            _labelled("  Unique IPs     : ", F.col("ips")),
            "",
            "  Alert Types Detected:",
        ),
    )
    per_type = rollups.types_of(groups)
    type_line = F.concat(
        F.lit("    - "), padded_right(F.col("type"), 30), F.lit(" "), F.col("count").cast("string"), F.lit(" alert(s)")
    )
    by_count = F.concat(F.lpad((F.lit(10**15) - F.col("count")).cast("string"), 16, "0"), F.lpad(F.col("start").cast("string"), 20, "0"))
    types = _lines(per_type, EXECUTIVE, _texts(type_line), F.lit(1), key=by_count)
    after_types = _lines(totals, EXECUTIVE, _texts(""), F.lit(2))

    some_ip = F.col("ips") > 0
    flagged_head = _lines(totals, FLAGGED, _texts(F.when(some_ip, _rule("FLAGGED IP ADDRESSES", 51))))
    ip_line = F.concat(F.lit("  "), padded_right(F.col("ip"), 20), F.lit(" "), F.col("severities"))
    flagged = _lines(rollups.flagged_of(groups), FLAGGED, _texts(ip_line), F.lit(1), key=F.col("ip"))
    flagged_end = _lines(totals, FLAGGED, _texts(F.when(some_ip, "")), F.lit(2))

    details_head = _lines(totals, DETAILS, _texts(_rule("ALERT DETAILS", 60)), F.lit(-1))
    counts = rollups.severity_rows(totals).filter(F.col("count") > 0)
    tag = F.create_map(*[F.lit(x) for pair in TAGS.items() for x in pair])[F.col("severity")]
    severity_heads = _lines(
        counts,
        DETAILS,
        _texts(
            "",
            F.concat(F.lit("  "), tag, F.lit(" "), F.col("severity"), F.lit(" ("), F.col("count").cast("string"), F.lit(" alert(s))")),
            "  " + "-" * 72,
        ),
        F.col("severity_rank"),
    )
    details = _lines(
        numbered, DETAILS, detail_lines(numbered, prefix), F.col("severity_rank"), F.col("number")
    )

    advice_head = _lines(totals, ACTIONS, _texts(_rule("RECOMMENDED ACTIONS (SUMMARY)", 42)), F.lit(-1))
    advice = _lines(_advice_rows(totals), ACTIONS, _texts(F.col("line")), num=F.col("line_no"))
    advice_end = _lines(totals, ACTIONS, _texts(""), F.lit(1))
    footer = _lines(totals, FOOTER, _texts(bar, f"  Report generated by {tool}", bar))

    sections = [
        header, executive, types, after_types, flagged_head, flagged, flagged_end,
        details_head, severity_heads, details, advice_head, advice, advice_end, footer,
    ]
    return reduce(DataFrame.unionByName, sections)


def detail_lines(alerts: DataFrame, prefix: str) -> Column:
    """Array of report lines of one numbered alert."""
    if "threat_intel" in alerts.columns:
        intel = intel_lines(F.col("threat_intel"))
    else:
        intel = F.array(F.lit("      Threat Intel  : N/A"))
    kind = F.col("type")
    name = incident_id(F.lit(prefix), F.col("severity"), F.col("number"))
    return F.concat(
        _texts(
            F.concat(F.lit("  ["), F.col("number").cast("string"), F.lit("] Incident ID    : "), name),
            _labelled("      Severity       : ", F.col("severity")),
            _labelled("      Detection Type : ", kind),
            F.concat(F.lit("      MITRE ATT&CK   : "), technique_id(kind), F.lit(" - "), technique_name(kind)),
            _labelled("      Source IP      : ", F.col("ip")),
            _labelled("      Username       : ", F.col("user")),
            _labelled("      Timestamp      : ", t.iso_text(F.col("ts"))),
        ),
        intel,
        _texts(_labelled("      Analyst Notes  : ", F.col("detail")), "      Recommended Actions:"),
        F.transform(recommendations(kind), lambda a: F.concat(F.lit("        - "), a)),
        _texts(""),
    )


def console_rows(alerts: DataFrame) -> DataFrame:
    """One text row per alert, most severe first."""
    kind = F.col("type")
    suffix = intel_suffix(F.col("threat_intel")) if "threat_intel" in alerts.columns else F.lit("")
    line = F.concat(
        F.lit("  ["), padded_right(F.col("severity"), 8), F.lit("]  "),
        F.substring(F.col("ts").cast("string"), 1, 19), F.lit("  "), padded_right(kind, 25),
        F.lit("  MITRE: "), padded_right(technique_id(kind), 6), F.lit("  IP: "), F.col("ip"),
        F.lit("  USER: "), F.col("user"), suffix,
    )
    ordered = in_severity_order(alerts)
    return ordered.select("detector", "pos", "severity", line.alias("line"))


def in_severity_order(alerts: DataFrame) -> DataFrame:
    """Most severe first, report order within a severity."""
    return alerts.orderBy(severity_rank(F.col("severity")), "ts_us", "detector", "pos")

