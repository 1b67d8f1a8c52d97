"""IP address predicates as plain column expressions (no Python per row).

An IPv4 address has one spelling only, so its ranges are patterns of its text. IPv6
addresses are spelled out to 32 hex digits, so that their ranges are ranges of strings;
that work is bound to one lambda variable and done only for texts with a colon.
Validity needs no spelling out: it is one pattern per version.
"""

from __future__ import annotations

import ipaddress
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_DOTTED = rf"{_OCTET}(?:\.{_OCTET}){{3}}"
_IPV4 = f"^{_DOTTED}$"


def _ipv6_pattern() -> str:
    """Eight groups of hex digits; ``::`` stands for one or more; a dotted tail for two."""
    group = "[0-9a-fA-F]{1,4}"
    forms = [f"(?:{group}:){{7}}{group}", f"(?:{group}:){{6}}{_DOTTED}"]
    for before in range(8):
        head = f"(?:{group}:){{{before - 1}}}{group}" if before else ""
        after = 7 - before
        tails = [f"(?:{group}:){{0,{after - 1}}}{group}"] if after else []
        tails += [f"(?:{group}:){{0,{after - 2}}}{_DOTTED}"] if after > 1 else []
        forms.append(f"{head}::" + (f"(?:{'|'.join(tails)})?" if tails else ""))
    return f"^(?:{'|'.join(forms)})(?:%[^%]+)?$"


_IPV6 = _ipv6_pattern()

# Ranges that are never put on a blocklist.
# 127.0.0.0/8, 10.0.0.0/8, 172.16.0.0/12, 192.168.0.0/16
GUARDED_V4 = r"^(?:127|10)\.|^172\.(?:1[6-9]|2[0-9]|3[01])\.|^192\.168\."
LOOPBACK_V6 = "0" * 31 + "1"

# Special-purpose ranges of the IANA registries. IPv4:
# 0.0.0.0/8, 10.0.0.0/8, 127.0.0.0/8, 169.254.0.0/16, 172.16.0.0/12, 192.0.0.0/24 (without
# .9 and .10), 192.0.2.0/24, 192.168.0.0/16, 198.18.0.0/15, 198.51.100.0/24, 203.0.113.0/24,
# 224.0.0.0/4, 240.0.0.0/4
SPECIAL_V4 = (
    r"^(?:0|10|127)\.|^169\.254\.|^172\.(?:1[6-9]|2[0-9]|3[01])\.|^192\.0\.0\.(?!(?:9|10)$)|^192\.0\.2\."
    r"|^192\.168\.|^198\.1[89]\.|^198\.51\.100\.|^203\.0\.113\.|^(?:22[4-9]|2[3-5][0-9])\."
)
# Outside these the IPv6 space is reserved, private, link-local or multicast.
ROUTED_V6 = ("2000::/3", "fec0::/10")
SPECIAL_V6 = ("2001::/23", "2001:db8::/32", "2002::/16")
REACHABLE_V6 = (
    "2001:1::1/128",
    "2001:1::2/128",
    "2001:3::/32",
    "2001:4:112::/48",
    "2001:20::/28",
    "2001:30::/28",
)


def is_ipv4(ip: Column) -> Column:
    return ip.rlike(_IPV4)


def _bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated, and written into the plan, only once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _tail_as_groups(ip: Column) -> Column:
    """Rewrite a dotted IPv4 tail of an IPv6 address as two hex groups."""
    tail = F.substring_index(ip, ":", -1)
    head = F.substring(ip, F.lit(1), F.length(ip) - F.length(tail))
    octet = lambda i: F.lpad(F.hex(F.split_part(tail, F.lit("."), F.lit(i)).try_cast("bigint")), 2, "0")
    groups = F.concat(octet(1), octet(2), F.lit(":"), octet(3), octet(4))
    return F.when(is_ipv4(tail), F.concat(head, groups)).otherwise(ip)


def _groups(text: Column) -> Column:
    return F.filter(F.split(text, ":"), lambda g: g != "")


def is_ipv6(ip: Column) -> Column:
    """Textual IPv6, with or without a zone."""
    return ip.contains(":") & ip.rlike(_IPV6)


def is_valid_ip(ip: Column) -> Column:
    """True for an IPv4 or IPv6 address, blanks around it allowed; never null."""
    text = F.btrim(ip, F.lit(" \t\n\r\f\v"))
    return F.coalesce(is_ipv4(text) | is_ipv6(text), F.lit(False))


def ipv6_digits(ip: Column) -> Column:
    """IPv6 address as 32 lower-case hex digits; null for anything else."""

    def spelled(text: Column) -> Column:
        left = _groups(F.substring_index(text, "::", 1))
        right = F.when(text.contains("::"), _groups(F.substring_index(text, "::", -1))).otherwise(
            F.array().cast("array<string>")
        )
        zeros = F.array_repeat(F.lit("0"), F.greatest(F.lit(8) - F.size(left) - F.size(right), F.lit(0)))
        return F.array_join(F.transform(F.concat(left, zeros, right), lambda g: F.lpad(g, 4, "0")), "")

    def digits(text: Column) -> Column:
        bare = F.lower(F.split_part(text, F.lit("%"), F.lit(1)))
        return F.when(is_ipv6(text), _bound(_bound(bare, _tail_as_groups), spelled))

    return F.when(ip.contains(":"), _bound(ip, digits))


def _in_v6(digits: Column, networks: tuple[str, ...]) -> Column:
    nets = [ipaddress.ip_network(n) for n in networks]
    text = lambda a: a.exploded.replace(":", "")
    tests = [digits.between(text(n.network_address), text(n.broadcast_address)) for n in nets]
    return reduce(lambda a, b: a | b, tests)


def _routed_v6(digits: Column) -> Column:
    return _in_v6(digits, ROUTED_V6) & (~_in_v6(digits, SPECIAL_V6) | _in_v6(digits, REACHABLE_V6))


def is_local_or_private(ip: Column) -> Column:
    """Loopback and RFC 1918 addresses: never blocked. False for invalid text."""
    v4 = is_ipv4(ip) & ip.rlike(GUARDED_V4)
    return F.coalesce(v4 | F.coalesce(ipv6_digits(ip) == LOOPBACK_V6, F.lit(False)), F.lit(False))


def is_public(ip: Column) -> Column:
    """Globally routable addresses: the only ones that carry a reputation."""
    v4 = is_ipv4(ip) & ~ip.rlike(SPECIAL_V4)
    v6 = F.when(ip.contains(":"), F.coalesce(_bound(ipv6_digits(ip), _routed_v6), F.lit(False)))
    return F.coalesce(v6, v4, F.lit(False))
