"""Fill-in-middle: texts cut at two token borders and put together in another order.

Tokens are runs of ASCII letters and other single code points. The ends of a text's tokens
form a set of offsets in the manner of Roaring bitmaps: offsets are grouped by their upper
bits into containers of 65,536 code points, each stored as a sorted array, a bitmap or a list
of runs, whichever is smallest, with the number of members before it. "The offset after k
tokens" is a search for the container and a select within it.

Where a text is cut and in which order its parts come depends on a hash of seed and doc_id
alone, so every task and every rerun decides alike. Texts that contain a marker stay plain:
the others can be rebuilt from output and form.

Edge cases. Null and empty texts are plain, with empty output and no token. A null doc_id is
hashed as an empty number. Rows that share a doc_id are transformed each. A text of any
length is read in windows of one container, so what it needs besides itself is bounded by
its borders, two bytes each at most. Columns of the table stay, but for the text and for
columns named like the added ones, which are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logwarden.llm.common import free_name, smaller

PLAIN, PSM, SPM = "plain", "psm", "spm"
ADDED = ("n", "form", "prefix_chars", "middle_chars", "output")
_CONTAINER = 1 << 16
_ARRAY, _BITMAP, _RUNS = "array", "bitmap", "runs"


@dataclass(frozen=True)
class Params:
    seed: int = 1
    transformed_percent: int = 90
    suffix_first_percent: int = 20  # of the transformed texts
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"


class BorderSet:
    """A set of offsets in containers, with the number of members before each container."""

    def __init__(self):
        self.containers: list[tuple[str, np.ndarray, np.ndarray | None]] = []
        self.before = [0]

    def append(self, member: np.ndarray) -> None:
        """The next container, from one flag for each of its offsets."""
        size = int(np.count_nonzero(member))
        opens = member.copy()
        opens[1:] &= ~member[:-1]
        starts = np.flatnonzero(opens)
        cost = {_ARRAY: 2 * size, _BITMAP: _CONTAINER // 8, _RUNS: 4 * len(starts)}
        kind = min(cost, key=cost.get)
        if kind == _ARRAY:
            held = np.flatnonzero(member).astype(np.uint16), None
        elif kind == _RUNS:
            closes = member.copy()
            closes[:-1] &= ~member[1:]
            lengths = np.flatnonzero(closes) - starts + 1
            # members before each run, so that a rank finds its run
            held = starts.astype(np.uint16), (np.cumsum(lengths) - lengths).astype(np.uint16)
        else:
            bits = np.zeros(_CONTAINER, bool)
            bits[: len(member)] = member
            words = np.packbits(bits, bitorder="little").view(np.uint64)
            counts = np.bitwise_count(words)
            held = words, (np.cumsum(counts, dtype=np.int32) - counts).astype(np.int32)
        self.containers.append((kind, *held))
        self.before.append(self.before[-1] + size)

    def __len__(self) -> int:
        return self.before[-1]

    def select(self, rank: int) -> int:
        """The member with ``rank`` smaller ones."""
        at = int(np.searchsorted(self.before, rank, "right")) - 1
        kind, values, smaller_ones = self.containers[at]
        rank -= self.before[at]
        if kind == _ARRAY:
            local = int(values[rank])
        elif kind == _RUNS:
            run = int(np.searchsorted(smaller_ones, rank, "right")) - 1
            local = int(values[run]) + rank - int(smaller_ones[run])
        else:
            word = int(np.searchsorted(smaller_ones, rank, "right")) - 1
            bits = int(values[word])
            for _ in range(rank - int(smaller_ones[word])):
                bits &= bits - 1  # without its lowest member
            local = 64 * word + (bits & -bits).bit_length() - 1
        return at * _CONTAINER + local


def token_ends(text: str) -> BorderSet:
    """The offsets of the last code point of each token."""
    found = BorderSet()
    for start in range(0, len(text), _CONTAINER):
        # one more code point tells whether the last one ends its token
        part = text[start : start + _CONTAINER + 1]
        points = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = ((points | 32) - np.uint32(97)) < 26
        last = np.ones(min(len(part), _CONTAINER), bool)
        last[: len(letter) - 1] = ~(letter[:-1] & letter[1:])
        found.append(last)
    return found


def draws(seed: int, doc_id: int | None) -> list[int]:
    """Four numbers below 2**32 that seed and id decide."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def transformed_text(text: str, doc_id: int | None, params: Params) -> tuple[int, str, int | None, int | None, str]:
    """Tokens, form, code points of prefix and middle, and output."""
    ends = token_ends(text)
    n = len(ends)
    one, two, whether, order = draws(params.seed, doc_id)
    marked = any(m in text for m in (params.prefix, params.suffix, params.middle))
    if not text or marked or whether % 100 >= params.transformed_percent:
        return n, PLAIN, None, None, text
    units = sorted((one % (n + 1), two % (n + 1)))
    a, b = (ends.select(k - 1) + 1 if k else 0 for k in units)
    head, body, tail = text[:a], text[a:b], text[b:]
    if order % 100 < params.suffix_first_percent:
        return n, SPM, a, b - a, f"{params.suffix}{tail}{params.prefix}{head}{params.middle}{body}"
    return n, PSM, a, b - a, f"{params.prefix}{head}{params.suffix}{tail}{params.middle}{body}"


def rebuilt_text(output: str, form: str, params: Params) -> str:
    """The text that has this output and form. No part contains a marker, so the first of each divides."""
    if form == PLAIN:
        return output
    first, second = (params.prefix, params.suffix) if form == PSM else (params.suffix, params.prefix)
    one, _, rest = output.removeprefix(first).partition(second)
    two, _, body = rest.partition(params.middle)
    head, tail = (one, two) if form == PSM else (two, one)
    return head + body + tail


def transform(docs: DataFrame, params: Params = Params(), text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with ``n`` (tokens), ``form``, ``prefix_chars``, ``middle_chars`` and ``output`` in place of the text."""
    kept = docs.drop(text, *ADDED)
    key, given = free_name(kept, "key"), free_name(kept, "given")
    rows = docs.select(*kept.columns, F.col(doc_id).cast("bigint").alias(key), F.col(text).cast("string").alias(given))
    types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())

    def transformed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in smaller(batches):
            *others, keys, texts = batch.columns
            found = [transformed_text(t.as_py() or "", k, params) for t, k in zip(texts, keys.to_pylist())]
            new = [pa.array([f[i] for f in found], kind) for i, kind in enumerate(types)]
            yield pa.RecordBatch.from_arrays([*others, *new], names=[*batch.schema.names[:-2], *ADDED])

    added = T.StructType.fromDDL("n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")
    return rows.mapInArrow(transformed, T.StructType([*kept.schema.fields, *added.fields]))


def restore(rows: DataFrame, params: Params = Params(), restored: str = "restored") -> DataFrame:
    """``rows`` of ``transform`` with the texts rebuilt from ``output`` and ``form`` alone."""
    kept = rows.drop(restored)
    places = kept.columns.index("output"), kept.columns.index("form")

    def rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in smaller(batches):
            outputs, forms = (batch.column(p) for p in places)
            texts = [rebuilt_text(o.as_py(), f, params) for o, f in zip(outputs, forms.to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, restored])

    return kept.mapInArrow(rebuilt, T.StructType([*kept.schema.fields, T.StructField(restored, T.StringType())]))
