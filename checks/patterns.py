"""What the SQL twins expect of log lines, said apart from the library's own rules.

A pattern that is mistyped in the library shows as a difference.
"""

from __future__ import annotations

from typing import NamedTuple


class Message(NamedTuple):
    event: str
    pattern: str
    user_group: int | None
    ip_group: int
    success: bool


# Event line patterns.
STAMP = r"(\w+\s+\d+\s+\d+:\d+:\d+)"
FAILED = STAMP + r".*sshd.*Failed password for (?:invalid user )?(\S+) from (\S+) port"
ACCEPTED = STAMP + r".*sshd.*Accepted (?:password|publickey) for (\S+) from (\S+) port"
SUDO = STAMP + r".*sudo\[\d+\]:\s+(\S+)\s*:.*COMMAND=(.*)"
SU = STAMP + r".*su\[.*\].*Successful su for (\S+) by (\S+)"

# Layout names, patterns and the group of the message, in order of precedence.
LAYOUTS = (
    ("Ubuntu/Debian (ISO 8601)", r"^\d{4}-\d{1,2}-\d{1,2}T\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:[+-]\d{2}:\d{2})?\s+(\S+)\s+(\S+?)(?:\[\d+\]):\s+(.*)$", 3),
    ("systemd journald", r"(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d+\+\d{2}:\d{2})\s+(\S+)\s+sshd(?:\[\d+\])?:\s+(.*)$", 3),
    ("CentOS/RHEL (syslog)", r"^(\w+\s+\d{1,2}\s+\d{2}:\d{2}:\d{2})\s+(\S+)\s+(sshd)(?:\[\d+\])?:\s+(.*)$", 4),
    ("Generic syslog", r"^(\w+\s+\d{1,2}\s+\d{2}:\d{2}:\d{2})\s+(\S+)\s+(\S+?)(?:\[\d+\])?:\s+(.*)$", 4),
)

# Looked for before the messages below.
FIRST_LOOK = Message("invalid_user", r"Invalid user (\S+) from ([\d.]+)", 1, 2, False)

# Message patterns in order of precedence.
MESSAGES = (
    Message("failed_password_invalid", r"Failed password for invalid user (\S+) from ([0-9a-fA-F:.]+)", 1, 2, False),
    Message("failed_password_user", r"Failed password for (\S+) from ([0-9a-fA-F:.]+)", 1, 2, False),
    Message("invalid_user", r"Invalid user (\S+) from ([0-9a-fA-F:.]+)", 1, 2, False),
    Message("failed_none", r"Failed none for (?:invalid user )?(\S+) from ([0-9a-fA-F:.]+)", 1, 2, False),
    Message("failed_publickey", r"Failed publickey for (?:invalid user )?(\S+) from ([0-9a-fA-F:.]+)", 1, 2, False),
    Message("authentication_failure", r"pam_unix\(sshd:auth\): authentication failure;.*ruser=(\S*)\s+rhost=([0-9a-fA-F:.]+)", 1, 2, False),
    Message("connection_closed_preauth", r"Connection closed by (?:authenticating user )?(\S+)?\s*([0-9a-fA-F:.]+) port \d+ \[preauth\]", 1, 2, False),
    Message("disconnected_preauth", r"Disconnected from (?:authenticating user )?(\S+)?\s*([0-9a-fA-F:.]+) port \d+ \[preauth\]", 1, 2, False),
    Message("connection_reset_preauth", r"Connection reset by (\S+)?\s*([0-9a-fA-F:.]+) port \d+ \[preauth\]", 1, 2, False),
    Message("max_auth_attempts", r"error: maximum authentication attempts exceeded for (?:invalid user )?(\S+) from ([0-9a-fA-F:.]+)", 1, 2, False),
    Message("too_many_auth_failures", r"Disconnecting (?:invalid user )?(\S+) ([0-9a-fA-F:.]+).*Too many authentication failures", 1, 2, False),
    Message("break_in_attempt", r"reverse mapping checking .* for ([0-9a-fA-F:.]+) .* POSSIBLE BREAK-IN ATTEMPT", None, 1, False),
    Message("accepted_password", r"Accepted password for (\S+) from ([0-9a-fA-F:.]+)", 1, 2, True),
    Message("accepted_publickey", r"Accepted publickey for (\S+) from ([0-9a-fA-F:.]+)", 1, 2, True),
    Message("accepted_keyboard_interactive", r"Accepted keyboard-interactive(?:/pam)? for (\S+) from ([0-9a-fA-F:.]+)", 1, 2, True),
    Message("accepted_gssapi", r"Accepted gssapi-with-mic for (\S+) from ([0-9a-fA-F:.]+)", 1, 2, True),
)
