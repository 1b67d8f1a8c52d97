"""Helpers that several operators share: text hashing in numpy, Arrow batches, splits."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(divisor))


def n_words(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def blank_to_space(text: Column) -> Column:
    """The text, null as empty, with a space for every blank."""
    text = F.coalesce(text, F.lit(""))
    for c in "\t\n\x0b\f\r":
        text = F.replace(text, F.lit(c), F.lit(" "))
    return text


def words_of(text: Column) -> Column:
    """All words. Splits at one plain character, which Spark does without a pattern."""
    return F.array_remove(F.split(blank_to_space(text), " "), "")


def free_name(df: DataFrame, wish: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def set_aside(df: DataFrame, names: tuple[str, ...]) -> tuple[DataFrame, list[Column]]:
    """``df`` with its columns of these names (in any case) under free names, and what gives all columns back."""
    clash = {n.lower() for n in names}
    taken = {c.lower() for c in df.columns} | clash
    new = {}
    for c in df.columns:
        new[c] = c
        if c.lower() in clash:
            while new[c].lower() in taken:
                new[c] += "_"
            taken.add(new[c].lower())
    return df.withColumnsRenamed(new), [F.col(new[c]).alias(c) for c in df.columns]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Recent(dict):
    """A bounded memory: entries that were not asked for while ``limit`` others came are forgotten."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.older = limit, {}

    def unknown(self, keys: set) -> list:
        """Those of ``keys`` that must be computed and added; the others can be looked up until the next call."""
        if len(self) + len(keys) > self.limit:
            self.older = dict(self)
            self.clear()
        out = []
        for key in keys.difference(self):
            value = self.older.get(key)
            if value is None:
                out.append(key)
            else:
                self[key] = value
        return out


class SpanHashes:
    """64-bit hashes of short spans of a byte buffer, from one prefix sum.

    The hash of a span depends on its bytes alone, not on its place. It is a polynomial modulo
    2**64, for which long regular spans collide whatever the base; see ``word_hashes``.
    """

    def __init__(self, buffer: np.ndarray):
        powers = np.full(len(buffer) + 1, _BASE, np.uint64)
        powers[0] = 1
        np.cumprod(powers, out=powers)
        self.sums = np.zeros(len(buffer) + 1, np.uint64)
        np.cumsum((buffer.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=self.sums[1:])
        self.inverse = np.full(len(buffer) + 1, _INVERSE, np.uint64)
        self.inverse[0] = 1
        np.cumprod(self.inverse, out=self.inverse)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))


_SHORT = 32  # bytes of a word up to which the polynomial serves


def word_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words; long ones, which are rare, by a cryptographic hash."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    hashes = SpanHashes(buffer).of(starts, ends)
    for i in np.flatnonzero(ends - starts > _SHORT).tolist():
        digest = hashlib.blake2b(buffer[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        hashes[i] = int.from_bytes(digest, "little")
    return hashes


def window_hashes(words: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hashes of the windows of ``sizes`` words that begin at ``first``; the bits are mixed after each word."""
    hashes = sizes.astype(np.uint64)
    for i in range(int(sizes.max(initial=0))):
        live = sizes > i
        if live.all():
            hashes = mix(hashes * np.uint64(0x9E3779B97F4A7C15) + words[first + i])
        else:
            hashes[live] = mix(hashes[live] * np.uint64(0x9E3779B97F4A7C15) + words[first[live] + i])
    return hashes


def word_spans(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buffer of all words, starts and ends of words, and the number of words of each text.

    Texts are UTF-8; words are what blanks separate, and lie one blank apart in the buffer.
    """
    lists = [t.split() for t in texts]
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    buffer = np.frombuffer(b" ".join([b" ".join(w) for w in lists if w]), np.uint8)
    blanks = np.flatnonzero(buffer == 32)
    if counts.sum() == 0:
        return buffer, np.zeros(0, np.int64), np.zeros(0, np.int64), counts
    return buffer, np.append(0, blanks + 1), np.append(blanks, len(buffer)), counts


class Words(NamedTuple):
    """Words of consecutive texts: number of the first text, hashes of all words, words per text, class per text.

    The class is a 128-bit hash of the word sequence, empty for a text without words.
    """

    first: int
    hashes: np.ndarray
    counts: np.ndarray
    classes: list[bytes]


_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BLANK = re.compile(rb"[\t-\r ]")


def runs(text: bytes, limit: int) -> Iterator[bytes]:
    """The text in runs of about ``limit`` bytes, cut at blanks."""
    at = 0
    while at < len(text):
        blank = _BLANK.search(text, at + limit)
        end = blank.start() if blank else len(text)
        yield text[at:end]
        at = end + 1


def lower_words(texts: list[str | None], limit: int = 1 << 20) -> Iterator[Words]:
    """Words of all texts, A-Z lower-cased. A longer text than ``limit`` comes alone and is read in runs."""
    for first, part in chunks(texts, limit):
        if len(part) == 1 and len(part[0]) > limit:
            digest, hashes = hashlib.blake2b(digest_size=16), []
            for run in runs(part[0].encode("utf-8", "replace").translate(_LOWER), limit):
                buffer, starts, ends, counts = word_spans([run])
                if counts[0]:
                    digest.update((b" " if hashes else b"") + buffer.tobytes())
                    hashes.append(word_hashes(buffer, starts, ends))
            words = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
            yield Words(first, words, np.array([len(words)]), [digest.digest() if hashes else b""])
            continue
        buffer, starts, ends, counts = word_spans([t.encode("utf-8", "replace").translate(_LOWER) for t in part])
        last = np.cumsum(counts)
        view = buffer.tobytes()
        classes = [
            hashlib.blake2b(view[starts[b] : ends[e - 1]], digest_size=16).digest() if e > b else b"" for b, e in zip((last - counts).tolist(), last.tolist())
        ]
        yield Words(first, word_hashes(buffer, starts, ends), counts, classes)


def chunks(texts: list[str | None], limit: int = 1 << 20) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts of about ``limit`` characters at most (or one longer text), null as empty."""
    first, part, size = 0, [], 0
    for i, text in enumerate(texts):
        text = text or ""
        if part and size + len(text) > limit:
            yield first, part
            first, part, size = i, [], 0
        part.append(text)
        size += len(text)
    if part:
        yield first, part


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def smaller(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, so that few texts are Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
