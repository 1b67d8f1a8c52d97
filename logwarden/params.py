"""Job parameters: one frozen object, validated once, passed everywhere."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from logwarden.functions.severity import parse_severity

# Accounts expected to log in, and commands that make a sudo sensitive.
KNOWN_USERS = ("john", "developer", "ubuntu", "deploy", "git", "admin", "root")
SENSITIVE_COMMANDS = (
    "/bin/bash",
    "/bin/sh",
    "/bin/su",
    "/usr/bin/passwd",
    "/usr/sbin/useradd",
    "/usr/sbin/usermod",
    "/usr/bin/vi /etc/sudoers",
    "/bin/mount",
)

_AT_LEAST_ONE = ("summary_limit", "verbose_limit", "burst_min_failures")
_AT_LEAST_ZERO = ("max_attempts", "block_threshold", "monitor_threshold")
_MINUTES = ("time_window_minutes", "bruteforce_minutes", "burst_minutes", "compromise_minutes")
_HOURS = ("business_start", "business_end")

MINUTE_US = 60_000_000


@dataclass(frozen=True)
class Params:
    # threat summary
    max_attempts: int = 5
    time_window_minutes: float = 10
    block_threshold: int = 50
    monitor_threshold: int = 20
    summary_limit: int = 20
    verbose_limit: int = 10
    blocklist_threshold: str = "HIGH"
    filter_severity: str | None = None
    # detections
    bruteforce_minutes: float = 30
    burst_minutes: float = 10
    burst_min_failures: int = 5
    compromise_minutes: float = 30
    business_start: int = 9
    business_end: int = 18
    known_users: tuple[str, ...] = KNOWN_USERS
    sensitive_commands: tuple[str, ...] = SENSITIVE_COMMANDS
    # enrichment
    malicious_score: int = 75
    upgrade_score: int = 90

    def __post_init__(self):
        for field in fields(self):
            value = getattr(self, field.name)
            if field.name in _AT_LEAST_ONE + _AT_LEAST_ZERO + _HOURS:
                if isinstance(value, bool) or not isinstance(value, int):
                    raise ValueError(f"{field.name} must be an integer, got {value!r}")
            if field.name in _AT_LEAST_ONE and value < 1:
                raise ValueError(f"{field.name} must be at least 1, got {value}")
            if field.name in _AT_LEAST_ZERO and value < 0:
                raise ValueError(f"{field.name} must not be negative, got {value}")
            if field.name in _MINUTES and (isinstance(value, bool) or not value >= 0):
                raise ValueError(f"{field.name} must not be negative, got {value!r}")
            if field.name in _HOURS and not 0 <= value <= 24:
                raise ValueError(f"{field.name} must be an hour of the day, got {value}")
        object.__setattr__(self, "blocklist_threshold", parse_severity(self.blocklist_threshold))
        if self.filter_severity is not None:
            object.__setattr__(self, "filter_severity", parse_severity(self.filter_severity))
        # an empty set means "not configured"
        object.__setattr__(self, "known_users", tuple(self.known_users) or KNOWN_USERS)
        object.__setattr__(self, "sensitive_commands", tuple(self.sensitive_commands))

    def strict(self) -> Params:
        """Preset that reacts to the first failure."""
        return replace(self, max_attempts=1, monitor_threshold=1, block_threshold=5)

    def quiet(self) -> Params:
        """Preset for a watch floor: only HIGH and above are shown."""
        return replace(self, filter_severity="HIGH")

    @staticmethod
    def micros(minutes: float) -> int:
        return int(round(minutes * MINUTE_US))


DEFAULTS = Params()
