"""Format-preserving pseudonyms for personal data.

Numbers that pass their check (card and account numbers, addresses of the network, phone and
social security numbers), real dates, mail addresses and access keys are replaced by others
of the same format: a keyed Feistel network permutes the values of a format, walking on
until the result is valid itself. Equal values get equal pseudonyms in all documents, and
different values different ones, so records stay linked; the key undoes it.

The value alone decides its pseudonym, whatever stands beside it. A pseudonym may so join its
neighbours to something that reads as a longer value; ``spans`` says where the pseudonyms
are, and ``restored`` undoes them by it. Null texts stay null, empty ones empty, and texts
without such values unchanged. Spans do not overlap; where formats compete, the earlier in
``KINDS`` wins. Other columns stay as they are, but for ``spans``, which is replaced.
"""

from __future__ import annotations

import datetime
import hashlib
import ipaddress
import re
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from logwarden.llm.common import column

_ROUNDS = 8
_FIRST_DAY, _DAYS = datetime.date(1900, 1, 1).toordinal(), 73_049  # to the end of 2099
# Letters of scripts that put spaces between words, and accents that follow their letter.
_LETTERS = "\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F\u0300-\u036F\u0370-\u06FF\u1E00-\u1FFF"
_SPACED = re.compile(f"[{_LETTERS}]")
_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


class Feistel:
    """Keyed permutations of 0 .. n - 1 for any n; ``kind`` separates formats."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def round(self, kind: str, turn: int, half: int, bits: int) -> int:
        data = f"{kind}/{turn}/{bits}/{half}".encode()
        size = min(64, bits // 8 + 1)
        digest = hashlib.blake2b(data, key=self.key, digest_size=size).digest()
        while len(digest) * 8 < bits:
            digest += hashlib.blake2b(digest, key=self.key, digest_size=64).digest()
        return int.from_bytes(digest, "big") & ((1 << bits) - 1)

    def step(self, kind: str, value: int, n: int, back: bool) -> int:
        bits = max(1, (n - 1).bit_length() + 1 >> 1)
        left, right = value >> bits, value & ((1 << bits) - 1)
        for turn in reversed(range(_ROUNDS)) if back else range(_ROUNDS):
            if back:
                left, right = right ^ self.round(kind, turn, left, bits), left
            else:
                left, right = right, left ^ self.round(kind, turn, right, bits)
        return left << bits | right

    def walk(self, kind: str, value: int, n: int, valid: Callable[[int], bool] | None = None, back: bool = False) -> int:
        """The image of ``value``, which must be valid itself; so is the image."""
        while True:
            value = self.step(kind, value, n, back)
            if value < n and (valid is None or valid(value)):
                return value


def to_number(text: str, alphabets: list[str]) -> int:
    number = 0
    for c, a in zip(text, alphabets):
        number = number * len(a) + a.index(c)
    return number


def from_number(number: int, alphabets: list[str]) -> str:
    out = []
    for a in reversed(alphabets):
        number, k = divmod(number, len(a))
        out.append(a[k])
    return "".join(reversed(out))


_CLASSES: dict[str, str] = {}  # a plain dictionary: it travels to executors with the functions


def class_of(c: str) -> str:
    """The class of a character: others of its block and category for letters and digits beyond ASCII, itself for signs."""
    if c.isascii() or not c.isalnum():
        return next((a for a in (_DIGITS, _LOWER, _UPPER) if c in a), c)
    block, kind, spaced = ord(c) >> 8 << 8, unicodedata.category(c), bool(_SPACED.match(c))
    others = map(chr, range(max(block, 128), block + 256))
    return "".join(x for x in others if x.isalnum() and unicodedata.category(x) == kind and bool(_SPACED.match(x)) == spaced)


def alphabet_of(c: str) -> str:
    found = _CLASSES.get(c)
    if found is None:
        found = _CLASSES[c] = class_of(c)
    return found


def permuted(feistel: Feistel, kind: str, text: str, valid: Callable[[str], bool] | None = None, back: bool = False) -> str:
    """Digits, lower-case and upper-case letters permuted within their classes, the rest unchanged."""
    alphabets = [alphabet_of(c) for c in text]
    n = 1
    for a in alphabets:
        n *= len(a)
    signs = {_DIGITS: "0", _LOWER: "a", _UPPER: "A"}
    shape = "".join(signs.get(a, a) for a in alphabets)
    check = (lambda v: valid(from_number(v, alphabets))) if valid else None
    return from_number(feistel.walk(f"{kind}:{shape}", to_number(text, alphabets), n, check, back), alphabets)


def laid(digits: str, pattern: str) -> str:
    """``digits`` in the places that ``pattern`` has digits."""
    left = iter(digits)
    return "".join(next(left) if c in _DIGITS else c for c in pattern)


def digits_of(text: str) -> str:
    return "".join(c for c in text if c in _DIGITS)


def luhn_digit(body: str) -> str:
    """The last digit that makes the sum right."""
    total = 0
    for i, c in enumerate(reversed(body)):
        d = int(c) * (1 if i % 2 else 2)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def card(f: Feistel, text: str, back: bool) -> str | None:
    digits = digits_of(text)
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
        return None
    body = permuted(f, "card", digits[:-1], lambda b: len(set(b)) > 1, back)
    return laid(body + luhn_digit(body), text)


def iban_check(country: str, rest: str) -> str:
    number = "".join(str(int(c, 36)) for c in rest + country + "00")
    return f"{98 - int(number) % 97:02d}"


def iban(f: Feistel, text: str, back: bool) -> str | None:
    packed = text.replace(" ", "")
    country, check, rest = packed[:2], packed[2:4], packed[4:]
    if not 15 <= len(packed) <= 34 or iban_check(country, rest) != check:
        return None
    fresh = permuted(f, "iban", rest, None, back)
    left = iter(country + iban_check(country, fresh) + fresh)
    return "".join(c if c == " " else next(left) for c in text)


def social(f: Feistel, text: str, back: bool) -> str | None:
    fits = lambda d: d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"
    digits = digits_of(text)
    return laid(permuted(f, "social", digits, fits, back), text) if fits(digits) else None


_NATIONAL = re.compile(r"(?:1[ .-])?[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}")


def phone(f: Feistel, text: str, back: bool) -> str | None:
    digits = digits_of(text)
    national = digits[1:] if len(digits) == 11 and digits[0] == "1" else digits
    # area codes ending in 00 are in use from 500 on, and not 600
    american = lambda d: d[0] in "23456789" and d[3] in "23456789" and d[:3] not in ("200", "300", "400", "600")
    # a plus, or an area code in brackets, tells a phone number where the national rule does not
    explicit = text.startswith("+") or ("(" in text and ")" in text)
    if len(national) == 10 and not (text.startswith("+") and len(digits) == 10):
        if american(national) and (explicit or _NATIONAL.fullmatch(text)):
            return laid(digits[: -len(national)] + permuted(f, "phone", national, american, back), text)
        if not explicit:
            return None
        other = permuted(f, "phone other", national, lambda d: not american(d), back)
        return laid(digits[: -len(national)] + other, text)
    if text.startswith("+") and 8 <= len(digits) <= 15:
        return laid(digits[:2] + permuted(f, "phone", digits[2:], None, back), text)
    if explicit and 8 <= len(digits) <= 15:
        # eleven digits from 1 on are read as a national number
        return laid(permuted(f, "phone other", digits, lambda d: len(d) != 11 or d[0] != "1", back), text)
    return None


def network(f: Feistel, text: str, back: bool) -> str | None:
    parts = text.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    number = f.walk("network", int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, None, back)
    return ".".join(map(str, number.to_bytes(4, "big")))


def network6(f: Feistel, text: str, back: bool) -> str | None:
    groups = [g for g in text.split(":") if g]
    try:
        ipaddress.IPv6Address(text)
    except ValueError:
        return None
    if len(groups) < 2 or sum(map(len, groups)) < 5 or not any(c in _DIGITS for c in text):
        return None
    # hexadecimal digits in the case of the text; with a letter if and only if it has one
    upper, lettered = any(c in "ABCDEF" for c in text), bool(re.search("[A-Fa-f]", text))
    alphabets = ["0123456789abcdef" if c != ":" else c for c in text]

    def readable(value: int) -> bool:
        new = from_number(value, alphabets)
        return bool(re.search("[a-f]", new)) == lettered and bool(re.search("[0-9]", new))

    shape = "".join(":" if c == ":" else "h" for c in text)
    new = f.walk(f"network6:{shape}", to_number(text.lower(), alphabets), 16 ** (len(text) - text.count(":")), readable, back)
    return from_number(new, alphabets).upper() if upper else from_number(new, alphabets)


def date(f: Feistel, text: str, back: bool) -> str | None:
    a, mark, b, _, c = re.split(r"([-./])", text)
    year_first = len(a) == 4
    orders = [(a, b, c)] if year_first else [(c, b, a), (c, a, b)] if mark != "/" else [(c, a, b), (c, b, a)]
    for which, (y, m, d) in enumerate(orders):
        try:
            day = datetime.date(int(y), int(m), int(d)).toordinal() - _FIRST_DAY
        except ValueError:
            continue
        if not 0 <= day < _DAYS:
            return None
        # order and widths of day and month must be read the same way again
        def readable(v: int) -> bool:
            new = datetime.date.fromordinal(v + _FIRST_DAY)
            short = (len(m) == 1 and new.month > 9) or (len(d) == 1 and new.day > 9)
            return not short and (which == 0 or new.day > 12)

        new = datetime.date.fromordinal(f.walk(f"date{which}", day, _DAYS, readable, back) + _FIRST_DAY)
        y2, m2, d2 = f"{new.year:04d}", f"{new.month:0{len(m)}d}", f"{new.day:0{len(d)}d}"
        if year_first:
            return mark.join((y2, m2, d2))
        month_first = (which == 0) == (mark == "/")
        return mark.join((m2, d2, y2) if month_first else (d2, m2, y2))
    return None


def mail(f: Feistel, text: str, back: bool) -> str | None:
    name, _, domain = text.rpartition("@")
    if len(name) >= 4:
        return permuted(f, "mail", name, None, back) + "@" + domain
    # short names have too few pseudonyms of their own: the host changes with them
    host, _, top = domain.rpartition(".")
    return permuted(f, "mail", f"{name}@{host}", None, back) + "." + top


def secret(f: Feistel, text: str, back: bool) -> str | None:
    return text[:4] + permuted(f, "secret", text[4:], None, back)


def key_token(f: Feistel, text: str, back: bool) -> str | None:
    head = _KEY_HEAD.match(text).group()
    return head + in_pieces(f, "key", text[len(head) :], back)


_PIECE = 128


def in_pieces(f: Feistel, kind: str, value: str, back: bool) -> str:
    # the cost of one permutation grows with the square of the length
    pieces = [value[i : i + _PIECE] for i in range(0, len(value), _PIECE)]
    return "".join(permuted(f, f"{kind}{i or ''}", p, None, back) for i, p in enumerate(pieces))


_SECRET = re.compile(r"(?:AKIA|ASIA)[A-Z0-9]{16}")
_KEY_HEAD = re.compile(r"github_pat_|gh[opsur]_|glpat-|sk[-_](?:live_|test_|proj-)?|xox[abeprs]-|AIza")


def assigned(f: Feistel, text: str, back: bool) -> str | None:
    m = _ASSIGNMENT.match(text)
    head, value = text[: m.end()], text[m.end() :]
    # a key that is known by itself has the same pseudonym wherever it stands
    if _SECRET.fullmatch(value):
        return head + secret(f, value, back)
    if _KEY.fullmatch(value):
        return head + key_token(f, value, back)
    return head + in_pieces(f, "assigned", value, back)


def bearer(f: Feistel, text: str, back: bool) -> str | None:
    head = re.match(r"\S+\s+", text).group()
    return head + in_pieces(f, "assigned", text[len(head) :], back)


_KEY = re.compile(rf"(?:{_KEY_HEAD.pattern})(?=[A-Za-z_-]*[0-9])[A-Za-z0-9_-]{{16,}}")
# What a value is assigned to, the sign and an opening quote.
_SECRET_NAME = r"(?i:(?<![a-z])(?:token|secret|password|passwd|pwd|api_?key|access_?key|private_?key|secret_?key))[\"']?"
_ASSIGNMENT = re.compile(rf"{_SECRET_NAME}\s{{0,4}}[=:]\s{{0,4}}[\"']?")
_VALUE = r"[^\s\"'`,;<>(){}\[\]]"
_END = r"(?<=[A-Za-z0-9_=/+\-$#@!%&*~])(?![\w(])"
# In quotes or directly after an equals sign any value; else one that prose would not have there.
_ASSIGNED = re.compile(
    rf"{_SECRET_NAME}(?:\s{{0,4}}[=:]\s{{0,4}}[\"']{_VALUE}{{6,}}(?=[\"'])|=(?!=){_VALUE}{{6,}}{_END}"
    rf"|\s{{0,4}}[=:]\s{{0,4}}(?=[^\s0-9]{{0,64}}[0-9]|[^\s]{{0,64}}[a-z][A-Z]){_VALUE}{{6,}}{_END})"
)


_NAME = rf"A-Za-z0-9._%+\-{_LETTERS}"
_HOST = rf"(?:[A-Za-z0-9{_LETTERS}-]{{1,63}}\.){{1,8}}[A-Za-z]{{2,24}}(?![A-Za-z0-9_-])"

# What is looked for, most telling first: kind, what must be in the text, pattern, replacement.
# Borders are ASCII letters and digits: other scripts may put no space before or after a value.
KINDS: list[tuple[str, str, re.Pattern, Callable]] = [
    # a name in a script without spaces only where it stands directly before the @
    ("mail", "@", re.compile(rf"(?:(?<![{_NAME}])[{_NAME}]{{1,64}}|(?<![\w.%+-])[\w.%+-]{{0,63}}(?![{_NAME}])\w)@{_HOST}"), mail),
    ("assigned", "", _ASSIGNED, assigned),
    ("bearer", "", re.compile(r"(?<![A-Za-z])[Bb]earer\s{1,4}(?=[A-Za-z._~+/\-]*[0-9])[A-Za-z0-9._~+/\-]{15,}[A-Za-z0-9_~+/\-]={0,2}"), bearer),
    ("key", "", re.compile(rf"(?<![A-Za-z0-9_]){_KEY.pattern}(?![A-Za-z0-9_])"), key_token),
    ("secret", "", re.compile(rf"(?<![A-Za-z0-9]){_SECRET.pattern}(?![A-Za-z0-9])"), secret),
    ("network6", ":", re.compile(r"(?<![A-Za-z0-9:.])(?:[0-9A-Fa-f]{1,4}:|:(?=:)|(?<=:):){2,7}(?:[0-9A-Fa-f]{1,4}|(?<=:):?)(?![A-Za-z0-9:]|\.[0-9])"), network6),
    ("network", ".", re.compile(r"(?<![A-Za-z0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![A-Za-z0-9]|\.[0-9])"), network),
    (
        "date",
        "",
        re.compile(
            r"(?<![A-Za-z0-9./-])(?:[0-9]{4}([-./])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-./])[0-9]{1,2}\2[0-9]{4})(?![A-SU-Za-z0-9/-]|T(?![0-9])|\.[0-9])"
        ),
        date,
    ),
    ("iban", "", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])"), iban),
    # in the usual groups first, so that digits before a card are not read as its beginning
    ("card", "", re.compile(r"(?<![A-Za-z0-9.+])(?:(?:[3-6][0-9]|2[2-7])[0-9]{2}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}|3[47][0-9]{2}([ -]?)[0-9]{6}\2[0-9]{5})(?![A-Za-z0-9])"), card),
    ("card", "", re.compile(r"(?<![A-Za-z0-9.+-])[0-9](?:[ -]?[0-9]){12,18}(?![A-Za-z0-9-])"), card),
    ("social", "", re.compile(r"(?<![A-Za-z0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9-])"), social),
    (
        "phone",
        "",
        re.compile(
            r"(?<![A-Za-z0-9])\+[0-9]{1,3}(?:[ .()/-]{1,2}[0-9]{1,6}){1,7}(?![A-Za-z0-9-])"
            r"|(?<![A-Za-z0-9+(])(?:\+[0-9]{1,3}[ .-]?)?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}[ .-][0-9]{2,4}(?:[ .-][0-9]{2,4}){0,2}(?![A-Za-z0-9-])"
            r"|(?<![A-Za-z0-9])\+[0-9]{8,15}(?![A-Za-z0-9])"
        ),
        phone,
    ),
]
_TELLING = re.compile("[0-9@=:]")


_GROUP = re.compile(r"[^ ./-]+")
_REACH = 128  # longer than any candidate that can fail its check


def candidates(text: str, pattern: re.Pattern) -> Iterator[tuple[int, int, list[int]]]:
    """Start, longest end and shorter ends (at separators) of what may be a value.

    The caller sends the end of the value it took, or None; then the search goes on after the
    first group of the match, where a value may start as well.
    """
    at = 0
    while m := pattern.search(text, at):
        start, end, last = m.start(), m.end(), m.end()
        while True:
            groups = [g.end() + start for g in _GROUP.finditer(text[start:end])]
            took = yield start, end, [e for e in reversed(groups[-40:]) if e < end]
            if took is not None:
                at = took
                break
            # a later group of the failed match, whatever separator is before it
            after = next((g.start() + start for g in _GROUP.finditer(text[start:last]) if g.start()), None)
            if after is None:
                at = last
                break
            start = after
            m = pattern.match(text[start : start + _REACH])
            end = start + m.end() if m else start
            last = max(last, end)


def replaced(text: str, feistel: Feistel, back: bool = False, kinds: list | None = None) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms, and kind, start and end of each in the new text.

    Where a match fails its check or overlaps a taken span, shorter ones and later starts within
    it are tried, at separators. ``back`` undoes the pseudonyms it finds by reading; ``restored``
    undoes those of known spans.
    """
    if not _TELLING.search(text):
        return text, []
    found: list[tuple[int, int, str, str]] = []
    taken = bytearray(len(text))
    for kind, needed, pattern, change in kinds or KINDS:
        if needed and needed not in text:
            continue
        search, took = candidates(text, pattern), None
        while True:
            try:
                start, longest, shorter = search.send(took)
            except StopIteration:
                break
            took = None
            for end in (longest, *shorter):
                value = text[start:end]
                if any(taken[start:end]) or (end < longest or start == end) and not pattern.fullmatch(value):
                    continue
                new = change(feistel, value, back)
                if new is None:
                    continue
                taken[start:end] = bytes([1]) * (end - start)
                found.append((start, end, kind, new))
                took = end
                break
    parts, spans, at, size = [], [], 0, 0
    for a, b, kind, new in sorted(found):
        parts += [text[at:a], new]
        size += a - at
        spans.append((kind, size, size + len(new)))
        size += len(new)
        at = b
    return "".join([*parts, text[at:]]), spans


def restored(text: str, spans: list, feistel: Feistel) -> str:
    """The text before ``replaced`` gave it pseudonyms at ``spans`` (kind, start, end)."""
    changes = {kind: change for kind, _, _, change in KINDS}
    parts, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: s[1]):
        parts += [text[at:start], changes[kind](feistel, text[start:end], True)]
        at = end
    return "".join([*parts, text[at:]])


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])


def pseudonymised(docs: DataFrame, key: bytes, text: str = "text", back: bool = False) -> DataFrame:
    """``docs`` with pseudonyms in ``text``, and ``spans`` (kind, start, end) of them.

    ``back`` undoes it: by ``spans`` where the table has them, else by reading.
    """
    known = back and "spans" in docs.columns
    kept = docs if known else docs.drop("spans")
    place = kept.columns.index(text)

    def changed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        feistel = Feistel(key)
        for batch in batches:
            if known:
                each = [[(s["kind"], s["start"], s["end"]) for s in x or []] for x in column(batch, "spans")]
                texts = [None if t is None else restored(t, x, feistel) for t, x in zip(column(batch, text), each)]
                columns = list(batch.columns)
                columns[place] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)
                continue
            new = [(None, []) if t is None else replaced(t, feistel, back) for t in column(batch, text)]
            spans = [[dict(zip(("kind", "start", "end"), s)) for s in found] for _, found in new]
            columns = list(batch.columns)
            columns[place] = pa.array([t for t, _ in new], pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, pa.list_(_SPAN))], names=[*batch.schema.names, "spans"])

    if known:
        return kept.mapInArrow(changed, kept.schema).drop("spans")
    fields = T.StructType.fromDDL("spans array<struct<kind: string, start: int, end: int>>").fields
    return kept.mapInArrow(changed, T.StructType([*kept.schema.fields, *fields]))
