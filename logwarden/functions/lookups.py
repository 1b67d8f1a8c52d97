"""Constant lookup tables, used as map literals so that no join is needed."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# ATT&CK technique of each alert type.
TECHNIQUES = {
    "BRUTEFORCE_SUCCESS": ("T1110", "Brute Force"),
    "PRIVILEGE_ESCALATION": ("T1548", "Abuse Elevation Control Mechanism"),
    "OFF_HOURS_LOGIN": ("T1078", "Valid Accounts"),
    "UNKNOWN_USER_LOGIN": ("T1078", "Valid Accounts"),
    "ACCOUNT_COMPROMISE": ("T1078", "Valid Accounts"),
}
NO_TECHNIQUE = ("N/A", "Unknown")

# Recommended actions of each alert type.
RECOMMENDATIONS = {
    "BRUTEFORCE_SUCCESS": (
        "Rotate credentials for affected accounts.",
        "Block offending IPs at firewall/fail2ban.",
        "Review authentication logs for lateral movement.",
    ),
    "PRIVILEGE_ESCALATION": (
        "Review sudo/su logs for unauthorized privilege use.",
        "Verify sudoers configuration and least-privilege controls.",
        "Check for persistence or account misuse.",
    ),
    "OFF_HOURS_LOGIN": (
        "Validate off-hours access with account owners.",
        "Confirm change windows or approved maintenance.",
        "Enable MFA if not already in place.",
    ),
    "UNKNOWN_USER_LOGIN": (
        "Audit /etc/passwd for unauthorized accounts.",
        "Disable or lock suspicious accounts.",
        "Review recent account creation and access events.",
    ),
}
DEFAULT_RECOMMENDATIONS = ("Review alert context and validate user activity.",)

# Closing advice of a report, and the severity or type that calls for it.
SUMMARY_ACTIONS = (
    ("severity", "CRITICAL", "  [CRITICAL] Escalate immediately to L2 analyst."),
    ("severity", "CRITICAL", "  [CRITICAL] Isolate affected systems if active breach is suspected."),
    ("type", "BRUTEFORCE_SUCCESS", "  [ACTION]   Rotate credentials for all users authenticated from flagged IPs."),
    ("type", "BRUTEFORCE_SUCCESS", "  [ACTION]   Block offending IPs at firewall/fail2ban."),
    ("type", "PRIVILEGE_ESCALATION", "  [ACTION]   Review sudo logs for unauthorized privilege use."),
    ("type", "PRIVILEGE_ESCALATION", "  [ACTION]   Verify sudoers configuration and restrict where possible."),
    ("type", "OFF_HOURS_LOGIN", "  [ACTION]   Confirm off-hours sessions with account owners."),
    ("type", "UNKNOWN_USER_LOGIN", "  [ACTION]   Audit /etc/passwd for unauthorized accounts."),
)


def _literal_map(table: dict, value) -> Column:
    return F.create_map(*chain.from_iterable((F.lit(k), value(v)) for k, v in table.items()))


def technique_id(alert_type: Column) -> Column:
    ids = _literal_map(TECHNIQUES, lambda v: F.lit(v[0]))
    return F.coalesce(ids[alert_type], F.lit(NO_TECHNIQUE[0]))


def technique_name(alert_type: Column) -> Column:
    names = _literal_map(TECHNIQUES, lambda v: F.lit(v[1]))
    return F.coalesce(names[alert_type], F.lit(NO_TECHNIQUE[1]))


def recommendations(alert_type: Column) -> Column:
    """Array of recommended actions."""
    as_array = lambda actions: F.array(*[F.lit(a) for a in actions])
    return F.coalesce(_literal_map(RECOMMENDATIONS, as_array)[alert_type], as_array(DEFAULT_RECOMMENDATIONS))
