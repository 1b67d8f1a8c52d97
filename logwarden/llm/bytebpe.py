"""Byte-level BPE encoding and decoding with a rank queue.

A vocabulary is a file of base64 tokens with their ranks, as the tiktoken library reads it;
ids are ranks. Text is cut by a pattern, and each piece is merged by itself: always the
pair of neighbours with the lowest rank, the leftmost first. A piece that is a token as a
whole becomes that token.

The queue holds the positions of all pairs of a rank in one bucket, and a bitmap of several
levels tells the lowest rank that has a bucket. Tokens form a linked list; an entry whose
pair has changed since is skipped. Many pieces share one queue, since no pair reaches across
their ends, and all pairs of the lowest rank are merged in one step; so a step costs the
same for one position or thousands, and a very long piece takes no more steps than a word.

Null and empty texts have no ids. Lone surrogates cannot occur in Spark strings. The other
columns of a row are kept, but for the text.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logwarden.llm.common import Recent, chunks, column, free_name, smaller


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class RankQueue:
    """Buckets by rank; the lowest rank is found by three levels of bitmaps."""

    def __init__(self, ranks: int):
        self.buckets: dict[int, list] = {}
        self.words = [0] * (ranks // 64 + 1)
        self.groups = [0] * (ranks // 4096 + 1)
        self.top = 0

    def push(self, rank: int, entry) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket.append(entry)
            return
        self.buckets[rank] = [entry]
        self.words[rank >> 6] |= 1 << (rank & 63)
        self.groups[rank >> 12] |= 1 << ((rank >> 6) & 63)
        self.top |= 1 << (rank >> 12)

    def push_all(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        """Add arrays of positions; ranks below 0 stand for pairs that make no token."""
        real = ranks >= 0
        ranks, positions = ranks[real], positions[real]
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        starts = [0, *(np.flatnonzero(np.diff(ranks)) + 1).tolist()] if len(ranks) else []
        for rank, a, b in zip(ranks[starts].tolist(), starts, [*starts[1:], len(ranks)]):
            self.push(rank, positions[a:b])

    def lowest(self) -> int:
        """-1 when empty."""
        if not self.top:
            return -1
        group = (self.top & -self.top).bit_length() - 1
        bits = self.groups[group]
        word = (group << 6) + (bits & -bits).bit_length() - 1
        bits = self.words[word]
        return (word << 6) + (bits & -bits).bit_length() - 1

    def take(self, rank: int) -> list:
        self.words[rank >> 6] &= ~(1 << (rank & 63))
        if not self.words[rank >> 6]:
            self.groups[rank >> 12] &= ~(1 << ((rank >> 6) & 63))
            if not self.groups[rank >> 12]:
                self.top &= ~(1 << (rank >> 12))
        return self.buckets.pop(rank)


class Vocabulary:
    """Ranks of tokens, and of the pairs of tokens that make one."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.size = max(ranks.values()) + 1
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a * self.size + b] = rank
        self.pairs = pairs
        self.keys = np.array(sorted(pairs) or [-1], np.int64)
        self.made = np.array([pairs.get(k, -1) for k in self.keys.tolist()], np.int64)
        # tokens that form a pair of a lower rank than their own: after such a merge that
        # pair goes first, before any further pair of the token's rank in the same piece
        self.early = set()
        for side in (self.keys // self.size, self.keys % self.size):
            self.early |= set(side[self.made < side].tolist())

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that two neighbours make, -1 where they make none."""
        keys = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.made[at], -1)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece, as little-endian unsigned 32-bit integers. No piece is empty."""
        token = self.bytes[np.frombuffer(b"".join(pieces), np.uint8)]
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        n = len(token)
        piece = np.repeat(np.arange(len(pieces)), sizes)
        following, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        ends = np.cumsum(sizes)
        following[ends - 1] = -1
        before[ends - sizes] = -1
        current = np.full(n, -1)  # rank of the pair that starts here; queued entries that differ are stale
        inner = np.flatnonzero(following >= 0)
        current[inner] = self.pair_ranks(token[inner], token[inner + 1])
        single = np.zeros(len(pieces), bool)  # pieces that need their merges one at a time
        upset = False
        queue = RankQueue(self.size)
        queue.push_all(current, np.arange(n))
        while (rank := queue.lowest()) >= 0:
            parts = queue.take(rank)
            i = np.unique(np.concatenate(parts)) if len(parts) > 1 else parts[0]
            i = i[current[i] == rank]
            if upset:
                i = i[~single[piece[i]]]
            if len(i) > 1:
                if rank in self.early:
                    found = self.upset(rank, i, piece, token, following, before)
                    if len(found):
                        single[found], upset = True, True
                        i = i[~single[piece[i]]]
                if (following[i[:-1]] == i[1:]).any():
                    i = apart(i, following)
            j = following[i]
            after, h = following[j], before[i]
            token[i], token[j], current[j] = rank, -1, -1
            following[i] = after
            current[i] = -1
            inside = after >= 0
            k, after = i[inside], after[inside]
            before[after] = k
            h = h[(h >= 0) & (token[h] >= 0)]  # a neighbour merged just now has its pair already
            at = np.concatenate([k, h])
            made = self.pair_ranks(token[at], token[np.concatenate([after, following[h]])])
            current[at] = made
            queue.push_all(made, at)
        alive = token >= 0
        data = token[alive].astype("<u4").tobytes()
        ends = np.cumsum(4 * np.bincount(piece[alive], minlength=len(pieces))).tolist()
        out = [data[a:b] for a, b in zip([0, *ends], ends)]
        for k in np.flatnonzero(single).tolist():
            out[k] = np.array(self.merge_singly(pieces[k]), "<u4").tobytes()
        return out

    def upset(self, rank: int, i: np.ndarray, piece, token, following, before) -> np.ndarray:
        """Pieces with several pairs of this rank, where a merge may make a pair of a lower rank."""
        several = np.zeros(len(i), bool)
        several[1:] = piece[i[1:]] == piece[i[:-1]]
        several[:-1] |= several[1:]
        i = i[several]
        made = np.full(len(i), rank)
        h, after = before[i], following[following[i]]
        lower = lambda ranks: (ranks >= 0) & (ranks < rank)
        low = (h >= 0) & lower(self.pair_ranks(token[h], made))
        low |= (after >= 0) & lower(self.pair_ranks(made, token[after]))
        low |= lower(self.pair_ranks(made, made))
        return piece[i[low]]

    def merge_singly(self, piece: bytes) -> list[int]:
        """Ids of one piece, one merge at a time."""
        token = self.bytes[np.frombuffer(piece, np.uint8)].tolist()
        pairs, size, n = self.pairs, self.size, len(piece)
        following, before = [*range(1, n), -1], list(range(-1, n - 1))
        queue = RankQueue(size)

        def offer(i: int) -> int:
            j = following[i]
            new = pairs.get(token[i] * size + token[j], -1) if j >= 0 else -1
            if new >= 0:
                queue.push(new, i)
            return new

        for i in range(n):
            offer(i)
        while (rank := queue.lowest()) >= 0:
            due = sorted(queue.take(rank))
            for k, i in enumerate(due):
                j = following[i]
                if token[i] < 0 or j < 0 or pairs.get(token[i] * size + token[j]) != rank:
                    continue  # stale
                token[i], token[j] = rank, -1
                following[i] = following[j]
                if following[i] >= 0:
                    before[following[i]] = i
                made = [offer(i)] + ([offer(before[i])] if before[i] >= 0 else [])
                if any(0 <= m < rank for m in made):  # that pair goes first
                    for rest in due[k + 1 :]:
                        queue.push(rank, rest)
                    break
        return [t for t in token if t >= 0]


def apart(positions: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Of a chain of overlapping pairs, every other one from the left."""
    linked = np.append(False, following[positions[:-1]] == positions[1:])
    index = np.arange(len(positions))
    chain = np.maximum.accumulate(np.where(linked, 0, index))
    return positions[(index - chain) % 2 == 0]


class Encoder:
    """Encodes texts; remembers the ids of words, in a bounded memory."""

    REMEMBERED = 150_000
    LONGEST = 64  # longer words, such as texts without blanks, are not remembered
    # Within a text, a blank before a non-blank always begins a piece of any pattern that
    # matches blank runs as the usual ones do; what lies between is encoded by itself. For a
    # pattern that cuts the probe in another way, the whole text is one word.
    PROBE = "A  word, it's 12 345 x1 (y)\n\n  next\tline \u00e9t\u00e9 \u65e5\u672c \u8a9e ... end \r\n z's  "
    ODD_BLANKS = re.compile(r" (?:\s|\Z)")
    WORDS = re.compile(r" (?=\S)")

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary = vocabulary
        self.pattern = regex.compile(pattern)
        # ids by word: the blank before a word is left out, and stands before the first word of a
        # text instead, which has none; no other word begins with one
        self.memory = Recent(self.REMEMBERED)
        self.tokens = {}  # ids of the tokens that are text
        for token, rank in vocabulary.ranks.items():
            try:
                self.tokens[token.decode()] = rank.to_bytes(4, "little")
            except UnicodeDecodeError:
                pass  # part of a character
        self.splits = True
        words = [self.spelt(w) for w in self.words(self.PROBE)]
        self.splits = [p for w in words for p in self.pattern.findall(w)] == self.pattern.findall(self.PROBE)

    @staticmethod
    def spelt(word: str) -> str:
        return word[1:] if word.startswith(" ") else " " + word

    def learn(self, words: list[str]) -> None:
        """Add the ids of words to the memory."""
        findall, known, memory = self.pattern.findall, self.tokens, self.memory
        due, several = {}, []
        for word in words:
            each = findall(word[1:] if word.startswith(" ") else " " + word)
            if len(each) == 1:
                found = known.get(each[0])
                if found is not None:
                    memory[word] = found
                    continue
            several.append((word, each))
            for piece in each:
                due[piece] = known.get(piece)
        merging = [piece for piece, found in due.items() if found is None]
        if merging:
            due.update(zip(merging, self.vocabulary.merge([piece.encode() for piece in merging])))
        for word, each in several:
            memory[word] = due[each[0]] if len(each) == 1 else b"".join([due[p] for p in each])

    def words(self, text: str) -> list[str]:
        """The words of a text, as the memory names them."""
        if not self.splits:
            return [" " + text]
        words = self.WORDS.split(text) if self.ODD_BLANKS.search(text) else text.split(" ")
        words[0] = " " + words[0]
        return words

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        cut = [self.words(text) for text in texts]
        due = set().union(*cut)
        long = [w for w in due if len(w) > self.LONGEST]
        due.difference_update(long)
        self.learn(self.memory.unknown(due))
        self.learn(long)
        ids_of = self.memory.__getitem__
        found = [b"".join(map(ids_of, words)) for words in cut]
        for word in long:
            del self.memory[word]
        return found


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the ids of the text (little-endian unsigned 32-bit integers) in place of the text."""
    kept = docs.drop(text, ids)
    given = free_name(kept, "given")
    rows = docs.select(*kept.columns, F.col(text).cast("string").alias(given))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in smaller(batches):
            for first, part in chunks(column(batch, given), 4 << 20):
                encoder = encoder or Encoder(Vocabulary(read_ranks(ranks_path)), pattern)
                found = pa.array(encoder.encode(part), pa.binary())
                others = [c.slice(first, len(part)) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*others, found], names=batch.schema.names[:-1] + [ids])

    return rows.mapInArrow(encoded, T.StructType([*kept.schema.fields, T.StructField(ids, T.BinaryType())]))


def decode(rows: DataFrame, ranks_path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``rows`` with the bytes that the ids stand for; null ids stay null."""
    kept = rows.drop(decoded)

    def bytes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = None
        for batch in smaller(batches):
            tokens = tokens or {rank: token for token, rank in read_ranks(ranks_path).items()}
            lists = column(batch, ids)
            found = [None if x is None else b"".join(map(tokens.__getitem__, np.frombuffer(x, "<u4").tolist())) for x in lists]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], names=[*batch.schema.names, decoded])

    return kept.mapInArrow(bytes_of, T.StructType([*kept.schema.fields, T.StructField(decoded, T.BinaryType())]))
