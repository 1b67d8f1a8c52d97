"""Rules that turn an sshd message into an authentication attempt.

Rules are data: append a ``Rule`` to ``RULES`` to cover another message. All rules together
become one pattern (``Dispatch``), so their number hardly shows in the size of the plan.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from logwarden.operators.auth_events import JAVA_FLAGS


@dataclass(frozen=True)
class Rule:
    """``literal`` is text that every match contains; only then is the pattern tried."""

    event: str
    pattern: str
    success: bool = False
    user_group: int | None = 1
    ip_group: int = 2
    literal: str | None = None


class Dispatch:
    """Which of several rules is the first to match a message, and what it captures.

    The subject is a line of marks, one for each rule whose literal occurs, and then the
    message. One alternation tries the rules in order; an alternative begins with its mark, so
    rules without one fail within a few characters. Captured marks, user and address come out
    as three lines. A message has no line break, and the lazy prefix of an alternative finds
    the same leftmost match as a search. Patterns may not refer back to groups by number.
    """

    _FIRST_MARK = 0x4E00

    def __init__(self, rules: list[Rule]):
        self.rules = rules
        self.marks = [chr(self._FIRST_MARK + i) for i in range(len(rules))]
        alternatives, picked, users, ips, groups = [], "", "", "", 0
        for rule, mark in zip(rules, self.marks):
            alternatives.append(rf"[^\n]*?({mark})[^\n]*\n.*?(?:{rule.pattern}).*")
            picked += f"${groups + 1}"
            users += "" if rule.user_group is None else f"${groups + 1 + rule.user_group}"
            ips += f"${groups + 1 + rule.ip_group}"
            groups += 1 + re.compile(rule.pattern).groups
        self.pattern = f"{JAVA_FLAGS}^(?:{'|'.join(alternatives)})$"
        self.replacement = f"{picked}\n{users}\n{ips}"

    def subject(self, info: Column, allowed: list[Column | None]) -> Column:
        """The marked message, null where no rule comes into question; ``allowed`` limits single rules."""
        parts = []
        for rule, mark, condition in zip(self.rules, self.marks, allowed):
            if rule.literal:
                found = F.contains(info, F.lit(rule.literal))
                condition = found if condition is None else condition & found
            parts.append(F.lit(mark) if condition is None else F.when(condition, mark).otherwise(""))
        marks = F.concat(*parts)
        return F.when(marks != "", F.concat(marks, F.lit("\n"), info))

    def hit(self, subject: Column) -> Column:
        """Number of the rule, user and address (texts) for a subject that a rule matches, else null."""
        lines = F.split(F.regexp_replace(subject, self.pattern, self.replacement), "\n")
        return F.when(F.size(lines) == 3, lines)

    def of_rule(self, mark: Column, values: list) -> Column:
        """The value of the rule that a mark stands for."""
        return F.get(F.array(*[F.lit(v) for v in values]), F.ascii(mark) - self._FIRST_MARK)


# Message patterns in order of precedence. Groups: user, address.
RULES = (
    Rule(
        "failed_password_invalid",
        r"Failed password for invalid user (\S+) from ([0-9a-fA-F:.]+)",
        literal="Failed password for invalid user ",
    ),
    Rule(
        "failed_password_user",
        r"Failed password for (\S+) from ([0-9a-fA-F:.]+)",
        literal="Failed password for ",
    ),
    Rule(
        "invalid_user",
        r"Invalid user (\S+) from ([0-9a-fA-F:.]+)",
        literal="Invalid user ",
    ),
    Rule(
        "failed_none",
        r"Failed none for (?:invalid user )?(\S+) from ([0-9a-fA-F:.]+)",
        literal="Failed none for ",
    ),
    Rule(
        "failed_publickey",
        r"Failed publickey for (?:invalid user )?(\S+) from ([0-9a-fA-F:.]+)",
        literal="Failed publickey for ",
    ),
    Rule(
        "authentication_failure",
        r"pam_unix\(sshd:auth\): authentication failure;.*ruser=(\S*)\s+rhost=([0-9a-fA-F:.]+)",
        literal="pam_unix(sshd:auth): authentication failure;",
    ),
    Rule(
        "connection_closed_preauth",
        r"Connection closed by (?:authenticating user )?(\S+)?\s*([0-9a-fA-F:.]+) port \d+ \[preauth\]",
        literal="Connection closed by ",
    ),
    Rule(
        "disconnected_preauth",
        r"Disconnected from (?:authenticating user )?(\S+)?\s*([0-9a-fA-F:.]+) port \d+ \[preauth\]",
        literal="Disconnected from ",
    ),
    Rule(
        "connection_reset_preauth",
        r"Connection reset by (\S+)?\s*([0-9a-fA-F:.]+) port \d+ \[preauth\]",
        literal="Connection reset by ",
    ),
    Rule(
        "max_auth_attempts",
        r"error: maximum authentication attempts exceeded for (?:invalid user )?(\S+) from ([0-9a-fA-F:.]+)",
        literal="error: maximum authentication attempts exceeded for ",
    ),
    Rule(
        "too_many_auth_failures",
        r"Disconnecting (?:invalid user )?(\S+) ([0-9a-fA-F:.]+).*Too many authentication failures",
        literal="Too many authentication failures",
    ),
    Rule(
        "break_in_attempt",
        r"reverse mapping checking .* for ([0-9a-fA-F:.]+) .* POSSIBLE BREAK-IN ATTEMPT",
        user_group=None,
        ip_group=1,
        literal="POSSIBLE BREAK-IN ATTEMPT",
    ),
    Rule(
        "accepted_password",
        r"Accepted password for (\S+) from ([0-9a-fA-F:.]+)",
        success=True,
        literal="Accepted password for ",
    ),
    Rule(
        "accepted_publickey",
        r"Accepted publickey for (\S+) from ([0-9a-fA-F:.]+)",
        success=True,
        literal="Accepted publickey for ",
    ),
    Rule(
        "accepted_keyboard_interactive",
        r"Accepted keyboard-interactive(?:/pam)? for (\S+) from ([0-9a-fA-F:.]+)",
        success=True,
        literal="Accepted keyboard-interactive",
    ),
    Rule(
        "accepted_gssapi",
        r"Accepted gssapi-with-mic for (\S+) from ([0-9a-fA-F:.]+)",
        success=True,
        literal="Accepted gssapi-with-mic for ",
    ),
)
