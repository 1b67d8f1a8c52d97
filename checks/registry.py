"""Named queries over the driver tables, each with its SQL twin where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks import alert_checks, function_checks, live_checks, parse_checks, threat_checks

Query = Callable[[SparkSession, str], DataFrame]

_MODULES = (alert_checks, parse_checks, threat_checks, function_checks, live_checks)


def queries() -> dict[str, Query]:
    return {name: query for module in _MODULES for name, (query, _) in module.CHECKS.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, (_, sql) in module.CHECKS.items() if sql}
