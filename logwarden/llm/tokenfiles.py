"""Token ids of texts in compact files: bit-plane blocks with a chunk index.

The ids of consecutive documents, in ascending doc_id, form segments of about a million
ids; a segment is one row of a Parquet table, so that any store takes it and a lost task
leaves nothing behind. It holds

    part, segment    its place: parts ascend with doc_id, segments within a part
    doc_ids, lengths the documents, and the ids of each (end id included)
    n_ids            their sum
    chunk_ids        the chunk index: number of ids of each chunk, all but the last the same,
    plane_bytes      and the compressed length of each of its planes
    payload          the planes of all chunks, one after another

A chunk is transposed: plane 0 has the lowest byte (or bit) of each id, and so on up to
32 bits; each plane is compressed with zstandard. Planes of high bits are empty for small
vocabularies and cost some bytes. Any chunk can be read alone by summing ``plane_bytes``.

Null and empty texts have the end id alone. Rows without doc_id come first; rows that share
a doc_id are ordered by their text. Other columns are ignored.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logwarden.llm.common import column


@dataclass(frozen=True)
class Params:
    end_id: int = 2
    segment_ids: int = 1 << 20
    chunk_ids: int = 1 << 16
    planes: str = "byte"  # or "bit"
    level: int = 3


class Words(dict):
    """Ids of words, computed when first asked for; those not asked for lately are forgotten."""

    def __init__(self, compute: Callable[[bytes], bytes], limit: int):
        super().__init__()
        self.compute, self.limit, self.older = compute, limit, {}

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        ids = self.older.get(word)
        if ids is None:
            ids = self.compute(word)
        if len(word) <= LONGEST:
            self[word] = ids
        return ids


# Longer words (texts without blanks are one word) are not remembered, so memories are bounded in bytes.
LONGEST = 64


class WordEncoder:
    """Ids of texts by the tokenizers library, with a bounded memory of words.

    For vocabularies that drop white space, lower-case text, and cut letters, single digits
    and other characters apart, with contractions as pieces of their own. Blanks then
    separate texts into words that the library encodes independently. Words of plain Latin
    letters and ASCII signs are cut here, and the library's merge model encodes each run of
    letters; all other words go through the whole library.
    """

    REMEMBERED = 400_000
    MARKS = b".,;:!?"
    PLAIN = re.compile(r"[\x21-\x26\x28-\x40\x5b-\x7eß-öø-ÿ]+")
    RUNS = re.compile(r"[a-zß-öø-ÿ]+|[^a-zß-öø-ÿ]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.letters = byte_letters()
        self.words = Words(self.word_ids, self.REMEMBERED)
        self.runs: dict[str | bytes, bytes] = {}
        self.tokenize = self.model.tokenize
        self.as_assumed = self.keeps_the_rules()

    PROBES = (
        "Plain words, it's o'clock don't we'll I'VE 3.14 x1y22 (a-b) e-mail@x.org \t\n naïve Straße ÜBER! #tag $5 50% ... --",
        "a.b,c;d:e!f?g \"quoted\" 'single' under_score [x] {y} <z> ~ ^ ` | \\ / 007 日本語 привет",
    )

    def keeps_the_rules(self) -> bool:
        """Whether the vocabulary cuts texts as this class assumes, tried on texts of all kinds of words."""
        return all(self.by_words(p) == self.whole(p) for p in self.PROBES)

    def whole(self, text: str) -> bytes:
        return packed_ids(self.library.encode(text, add_special_tokens=False).ids)

    def run_ids(self, run: str) -> bytes:
        """Of a run of letters, or of other signs."""
        if not run[0].isalpha():
            return self.whole(run)
        known = run if run.isascii() else "".join([self.letters[b] for b in run.encode()])
        return packed_ids([t.id for t in self.model.tokenize(known)])

    def word_ids(self, word: bytes) -> bytes:
        """Of a word of plain Latin letters and signs run by run, of any other as a whole."""
        runs = self.runs
        if len(runs) > self.REMEMBERED:
            runs.clear()
        body = word.rstrip(self.MARKS)
        if body.isalpha() and body.islower():  # most words: letters, and perhaps marks after them
            ids = runs.get(body)
            if ids is None:
                ids = packed_ids([t.id for t in self.tokenize(body.decode())])
                if len(body) <= LONGEST:
                    runs[body] = ids
            return ids if len(body) == len(word) else ids + self.known(word[len(body) :].decode())
        text = word.decode()
        if not self.PLAIN.fullmatch(text) or "<|" in text:
            return self.whole(text)
        return b"".join([self.known(run) for run in self.RUNS.findall(text)])

    def known(self, run: str) -> bytes:
        ids = self.runs.get(run)
        if ids is None:
            ids = self.run_ids(run)
            if len(run) <= LONGEST:
                self.runs[run] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return self.by_words(text) if self.as_assumed else self.whole(text)

    def by_words(self, text: str) -> bytes:
        raw = text.encode()
        # case matters to special tokens alone, and they begin with these two signs
        words = raw.split() if b"<|" in raw else raw.lower().split()
        return b"".join(map(self.words.__getitem__, words))


def packed_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def byte_letters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself where it is printable."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


def transposed(ids: np.ndarray, planes: str) -> list[bytes]:
    """Planes from the lowest up."""
    rows = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if planes == "byte":
        return [np.ascontiguousarray(rows[:, k]).tobytes() for k in range(4)]
    bits = np.unpackbits(rows, axis=1, bitorder="little")
    return [np.packbits(bits[:, k], bitorder="little").tobytes() for k in range(32)]


def restored(planes: list[bytes], n: int) -> np.ndarray:
    if len(planes) == 4:
        rows = np.stack([np.frombuffer(p, np.uint8) for p in planes], 1)
    else:
        bits = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") for p in planes], 1)
        rows = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(rows).view("<u4").ravel()


_SEGMENT = pa.schema(
    [
        ("segment", pa.int32()),
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
        ("n_ids", pa.int64()),
        ("chunk_ids", pa.list_(pa.int32())),
        ("plane_bytes", pa.list_(pa.list_(pa.int32()))),
        ("payload", pa.binary()),
    ]
)
_SEGMENT_DDL = (
    "segment int, doc_ids array<bigint>, lengths array<bigint>, n_ids bigint, "
    "chunk_ids array<int>, plane_bytes array<array<int>>, payload binary"
)


def packed_segment(number: int, doc_ids: list, texts: list[np.ndarray], params: Params) -> pa.RecordBatch:
    ids = np.concatenate(texts)
    squeeze = zstandard.ZstdCompressor(level=params.level).compress
    parts, lengths, chunk_ids = [], [], []
    for start in range(0, len(ids), params.chunk_ids):
        chunk = ids[start : start + params.chunk_ids]
        planes = [squeeze(p) for p in transposed(chunk, params.planes)]
        chunk_ids.append(len(chunk))
        lengths.append([len(p) for p in planes])
        parts += planes
    row = [number, doc_ids, [len(t) for t in texts], len(ids), chunk_ids, lengths, b"".join(parts)]
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _SEGMENT)], schema=_SEGMENT)


def unpacked_segment(row: dict) -> np.ndarray:
    expand = zstandard.ZstdDecompressor().decompress
    out, at, payload = [], 0, row["payload"]
    for n, lengths in zip(row["chunk_ids"], row["plane_bytes"]):
        planes = []
        for length in lengths:
            planes.append(expand(payload[at : at + length]))
            at += length
        out.append(restored(planes, n))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def write(docs: DataFrame, path: str, tokenizer_path: str, params: Params = Params()) -> None:
    """Encode ``doc_id, text`` and write the table of segments to the folder ``path``."""

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, number, doc_ids, texts, size = None, 0, [], [], 0
        end = packed_ids([params.end_id])
        for batch in batches:
            encoder = encoder or WordEncoder(tokenizer_path)
            for doc_id, text in zip(column(batch, "doc_id"), column(batch, "text")):
                doc_ids.append(doc_id)
                texts.append(np.frombuffer(encoder.encode(text or "") + end, "<u4"))
                size += len(texts[-1])
                if size >= params.segment_ids:
                    yield packed_segment(number, doc_ids, texts, params)
                    number, doc_ids, texts, size = number + 1, [], [], 0
        if texts:
            yield packed_segment(number, doc_ids, texts, params)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    # ranges ascend with the number of the partition
    ordered.mapInArrow(segments, _SEGMENT_DDL).withColumn("part", F.spark_partition_id()).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """``part, segment, before, doc_id, ids`` of each document: the ids (little-endian unsigned
    32-bit integers), and the number of ids before them in the segment."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                data = unpacked_segment(row).astype("<u4").tobytes()
                ends = np.cumsum([0, *row["lengths"]])
                n = len(row["doc_ids"])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["part"]] * n, pa.int32()),
                        pa.array([row["segment"]] * n, pa.int32()),
                        pa.array(ends[:-1], pa.int64()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array([data[4 * a : 4 * b] for a, b in zip(ends, ends[1:])], pa.binary()),
                    ],
                    names=["part", "segment", "before", "doc_id", "ids"],
                )

    rows = spark.read.parquet(path)
    return rows.mapInArrow(documents, "part int, segment int, before bigint, doc_id bigint, ids binary")


def segment_starts(spark: SparkSession, path: str) -> DataFrame:
    """``part, segment, first``: the number of ids in all segments before. Reads the index columns alone."""
    segments = spark.read.parquet(path).select("part", "segment", "n_ids")
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    # one row per written part: few, so one task numbers them
    offsets = parts.select("part", F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    inner = F.coalesce(F.sum("n_ids").over(W.partitionBy("part").orderBy("segment").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return segments.withColumn("inner", inner).join(offsets, "part").select("part", "segment", (F.col("offset") + F.col("inner")).alias("first"))
