"""Language-model scores by deleted interpolation of word trigrams, bigrams and unigrams.

Tokens of a text are its words, A-Z lower-cased, then one end token; before the first token
stand start marks. Estimates are mixed from the lowest order up. For a token w after v,

    p2 = l2 c(v w) / c(v) + l1 c(w) / N + l0 / (V + 1)

and after u v

    p3 = k c(u v w) / c(u v) + (1 - k) p2

with counts over all training texts and weights that depend on how frequent the context is:
one set per power of two of c(v), and of c(u v). They are learned by expectation-maximisation
on a tenth of the training texts, against the counts of the other nine tenths.

How it scales. Texts are packed once into stored blocks of some megabytes. A block sends its
distinct n-grams, as sorted hash arrays with their counts, to ranges of the hashes; so a
frequent n-gram travels once per block and not once per use. A range adds the counts of all
blocks and answers each with an aligned array of totals, by which the block scores its texts.
No node ever has more than ``fan_out`` ranges to send to: with more ranges than that, blocks
send to coarse ranges in teams, a team's n-grams are merged there and sent on to finer ranges,
and answers come back the same way. So messages grow with the input, times the number of such
levels (its logarithm). Blocks and ranges have bounded sizes, which are parameters.

Edge cases. Null and empty texts consist of the end token alone. Texts without training rows
get log10(1 / (V + 1)) = 0 per token. Rows that share a doc_id are scored each; a null
doc_id counts as empty text when texts are dealt to training and held-out rows. A single very
long text is a block of its own and needs some hundred bytes of memory per word.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.llm.common import lower_words, mix, smaller
from logwarden.session import stored

_END, _START = np.uint64(1), np.uint64(2)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
# Bigrams and trigrams are told apart by the upper 52 bits of their hashes, as the lower ones do
# not compress: of 10**9 distinct ones, one in four million shares its count with another.
_KEPT = np.uint64(0xFFFFFFFFFFFFF000)
KINDS = (0, 1, 2)  # unigrams, bigrams, trigrams
COUNTED, WEIGHING, HELD_OUT = 0, 1, 2
_MEASURES = "n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


@dataclass(frozen=True)
class Params:
    # A task holds the n-grams of one block, or of one range: some hundred bytes per word.
    block_bytes: int = 4 << 20
    range_bytes: int = 4 << 20  # of text per range of n-grams
    fan_out: int = 256
    buckets: int = 65  # one per power of two of a 64-bit count, and one for contexts never counted
    rounds: int = 60
    # EM sees token statistics as a histogram with this many steps per factor of two.
    steps: int = 8


def packed(values: np.ndarray) -> bytes:
    """Byte planes, compressed; small numbers leave nearly empty planes."""
    planes = values.view(np.uint8).reshape(len(values), -1).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpacked(data: bytes, dtype: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(planes.reshape(width, -1).T).reshape(-1).view(dtype)


def token_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of all texts, end tokens included, and the tokens of each text."""
    parts, sizes = [], []
    for found in lower_words(texts):
        # words never get the hashes of the two marks
        words = np.where(found.hashes <= _START, found.hashes + np.uint64(7), found.hashes)
        parts.append(np.insert(words, np.cumsum(found.counts), _END))
        sizes.append(found.counts + 1)
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(parts), np.concatenate(sizes)


class Block:
    """Tokens of a block's texts with their distinct n-grams."""

    def __init__(self, texts: list[str | None]):
        self.tokens, self.sizes = token_hashes(texts)
        self.firsts = np.cumsum(self.sizes) - self.sizes
        self.grams, self.places, self.counts = [], [], []
        self.add(self.tokens)
        before = self.shifted(self.tokens, _START)
        self.add(mix(before * _SPREAD + self.tokens) & _KEPT)
        further = self.shifted(before, _START)
        self.add(mix(mix(further * _SPREAD + before) * _SPREAD + self.tokens) & _KEPT)

    def add(self, hashes: np.ndarray) -> None:
        distinct, place, count = np.unique(hashes, return_inverse=True, return_counts=True)
        self.grams.append(distinct)
        self.places.append(place.astype(np.int32))
        self.counts.append(count.astype(np.uint32))

    def shifted(self, values: np.ndarray, first: object) -> np.ndarray:
        """The value of the token before, ``first`` (one or one per text) at the first token of a text."""
        out = np.empty_like(values)
        out[1:] = values[:-1]
        out[self.firsts] = first
        return out

    def spread(self, totals: list[np.ndarray]) -> tuple[np.ndarray, ...]:
        """Per token: counts of the trigram, its context, the bigram, its context, and the token."""
        single, pair, triple = (totals[k][self.places[k]].astype(np.float64) for k in KINDS)
        starts = single[self.firsts + self.sizes - 1]  # as many starts as ends
        return triple, self.shifted(pair, starts), pair, self.shifted(single, starts), single


# --- blocks -----------------------------------------------------------------------------


def packed_blocks(docs: DataFrame, held_out: Column, params: Params) -> DataFrame:
    """``block, part, doc_ids, held_out, lengths, texts``: all rows, packed with others of their part.

    Stored, because blocks are numbered at random and have to be the same in every later step.
    """
    # copies of a text stay together
    weighing = F.pmod(F.xxhash64("text", F.lit("weights")), F.lit(10)) == 0
    rows = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"), held_out.alias("held_out"))
    rows = rows.withColumn("part", F.when(F.col("held_out"), HELD_OUT).when(weighing, WEIGHING).otherwise(COUNTED))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[pa.Table]] = {}
        sizes: dict[int, int] = {}

        def flushed(part: int) -> pa.RecordBatch:
            table = pa.concat_tables(held.pop(part))
            texts = [(t or "").encode("utf-8", "replace") for t in table.column("text").to_pylist()]
            sizes[part] = 0
            values = [
                pa.array([int.from_bytes(os.urandom(7), "little")], pa.int64()),
                pa.array([part], pa.int32()),
                pa.ListArray.from_arrays(pa.array([0, len(table)], pa.int32()), table.column("doc_id").combine_chunks()),
                pa.ListArray.from_arrays(pa.array([0, len(table)], pa.int32()), table.column("held_out").combine_chunks()),
                pa.array([[len(t) for t in texts]], pa.list_(pa.int32())),
                pa.array([zstandard.ZstdCompressor(level=1).compress(b"".join(texts))], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(values, names=["block", "part", "doc_ids", "held_out", "lengths", "texts"])

        for batch in smaller(batches):
            table = pa.Table.from_batches([batch])
            parts = table.column("part").to_numpy()
            lengths = np.array([0 if t is None else len(t) for t in table.column("text").to_pylist()], np.int64) + 1
            for part in np.unique(parts).tolist():
                at = np.flatnonzero(parts == part)
                # cut where a block is full
                filled = np.cumsum(lengths[at]) + sizes.get(part, 0)
                for piece in np.split(at, np.flatnonzero(np.diff(filled // params.block_bytes)) + 1):
                    held.setdefault(part, []).append(table.take(pa.array(piece)))
                    sizes[part] = sizes.get(part, 0) + int(lengths[piece].sum())
                    if sizes[part] >= params.block_bytes:
                        yield flushed(part)
        for part in list(held):
            yield flushed(part)

    schema = f"block bigint, part int, doc_ids array<{kind}>, held_out array<boolean>, lengths array<int>, texts binary"
    return stored(rows.mapInArrow(pack, schema))


def texts_of(lengths: list[int], data: bytes) -> list[str]:
    raw, ends = zstandard.ZstdDecompressor().decompress(data), np.cumsum([0, *lengths]).tolist()
    return [raw[a:b].decode() for a, b in zip(ends, ends[1:])]


# --- counts -----------------------------------------------------------------------------

_MESSAGE = [("node", pa.int64()), ("range", pa.int64()), ("kind", pa.int32()), ("grams", pa.binary()), ("counted", pa.binary()), ("weighing", pa.binary())]
_MESSAGE_DDL = "node bigint, range bigint, kind int, grams binary, counted binary, weighing binary"
_ANSWER = [("node", pa.int64()), ("range", pa.int64()), ("kind", pa.int32()), ("counted", pa.binary()), ("weighing", pa.binary()), *[(c, pa.int64()) for c in ("v", "n", "v0", "n0")]]
_ANSWER_DDL = "node bigint, range bigint, kind int, counted binary, weighing binary, v bigint, n bigint, v0 bigint, n0 bigint"


def table_of(rows: list[tuple], columns: list) -> pa.Table:
    return pa.table({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(columns)}, pa.schema(columns))


def packed_grams(grams: np.ndarray) -> bytes:
    return packed(np.diff(grams, prepend=np.uint64(0)))


def unpacked_grams(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data, np.uint64), dtype=np.uint64)


def messages(node: int, kind: int, grams: np.ndarray, counts: list[np.ndarray], bits: int, within: int, done: int) -> Iterator[tuple]:
    """Messages of a node to the ranges of ``bits`` leading bits inside range ``within`` of ``done`` bits."""
    first = within << (bits - done)
    ranges = range(first, first + (1 << (bits - done)))
    cuts = np.searchsorted(grams, np.array([r << (64 - bits) for r in ranges if r > first], np.uint64)) if bits else np.zeros(0, np.int64)
    for r, lo, hi in zip(ranges, [0, *cuts.tolist()], [*cuts.tolist(), len(grams)]):
        if hi > lo:
            yield node, r, kind, packed_grams(grams[lo:hi]), packed(counts[0][lo:hi]), packed(counts[1][lo:hi])


def sent(blocks: DataFrame, bits: int) -> DataFrame:
    """Each block's distinct n-grams with their counts, cut by range."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block, part, lengths, texts = (batch.column(c)[i].as_py() for c in range(4))
                found = Block(texts_of(lengths, texts))
                out = []
                for kind in KINDS:
                    counts = [found.counts[kind] if part == p else np.zeros_like(found.counts[kind]) for p in (COUNTED, WEIGHING)]
                    out += messages(block, kind, found.grams[kind], [c.astype(np.uint64) for c in counts], bits, 0, 0)
                yield from table_of(out, _MESSAGE).to_batches()

    return blocks.select("block", "part", "lengths", "texts").mapInArrow(send, _MESSAGE_DDL)


def unpacked_rows(table: pa.Table, kind: int) -> tuple[list[dict], np.ndarray, list[np.ndarray]]:
    """Messages of a kind, their distinct n-grams, and where each message has its own."""
    mine = table.filter(pc.equal(table.column("kind"), kind)).to_pylist()
    lists = [unpacked_grams(r.pop("grams")) for r in mine]
    # each list is sorted and distinct: places by search need no array over all of them
    distinct = np.unique(np.concatenate([np.zeros(0, np.uint64), *lists]))
    return mine, distinct, [np.searchsorted(distinct, x).astype(np.int32) for x in lists]


def summed(mine: list[dict], places: list[np.ndarray], size: int) -> np.ndarray:
    totals = np.zeros((2, size), np.uint64)
    for r, p in zip(mine, places):
        totals[COUNTED, p] += unpacked(r["counted"], np.uint64)
        totals[WEIGHING, p] += unpacked(r["weighing"], np.uint64)
    return totals


def answer(table: pa.Table) -> pa.Table:
    """For each message to a range: totals over the counted and the weighing texts, in its order.

    One more row (node -1) has the number of distinct tokens and of all tokens: ``v, n`` in all
    training texts, ``v0, n0`` in the counted ones.
    """
    out, sums, where = [], (0, 0, 0, 0), table.column("range")[0].as_py()
    for kind in KINDS:
        mine, distinct, places = unpacked_rows(table, kind)
        totals = summed(mine, places, len(distinct))
        if kind == 0:
            both = totals.sum(0)
            sums = (int((both > 0).sum()), int(both.sum()), int((totals[0] > 0).sum()), int(totals[0].sum()))
        out += [(r["node"], where, kind, packed(totals[COUNTED, p]), packed(totals[WEIGHING, p]), 0, 0, 0, 0) for r, p in zip(mine, places)]
    out.append((-1, where, 0, b"", b"", *sums))
    return table_of(out, _ANSWER)


def answered(sent_: DataFrame, nodes: int, done: int, bits: int, params: Params) -> DataFrame:
    """The answers to all messages, which are cut by ``done`` leading bits of the ``bits`` that ranges have."""
    if done >= bits:
        return sent_.groupBy("range").applyInArrow(answer, _ANSWER_DDL)
    received = stored(sent_)
    teams = math.ceil(nodes / params.fan_out)
    teamed = received.withColumn("team", F.pmod(F.xxhash64("node", F.lit(done)), F.lit(teams)))
    further = min(bits, done + params.fan_out.bit_length() - 1)

    def forward(table: pa.Table) -> pa.Table:
        team, within = table.column("team")[0].as_py(), table.column("range")[0].as_py()
        out = []
        for kind in KINDS:
            mine, distinct, places = unpacked_rows(table, kind)
            out += messages(team, kind, distinct, list(summed(mine, places, len(distinct))), further, within, done)
        return table_of(out, _MESSAGE)

    replies = stored(answered(teamed.groupBy("team", "range").applyInArrow(forward, _MESSAGE_DDL), teams, further, bits, params))

    def pass_on(key, table: pa.Table, answers: pa.Table) -> pa.Table:
        out, where = [], key[1].as_py()
        rows = sorted(answers.to_pylist(), key=lambda r: r["range"])
        for kind in KINDS:
            mine, _, places = unpacked_rows(table, kind)
            totals = [np.concatenate([np.zeros(0, np.uint64), *[unpacked(r[c], np.uint64) for r in rows if r["kind"] == kind]]) for c in ("counted", "weighing")]
            out += [(r["node"], where, kind, packed(totals[0][p]), packed(totals[1][p]), 0, 0, 0, 0) for r, p in zip(mine, places)]
        return table_of(out, _ANSWER)

    parents = replies.filter("node >= 0").withColumns({"team": F.col("node"), "within": F.shiftright("range", further - done)})
    both = teamed.groupBy("team", "range").cogroup(parents.groupBy("team", "within"))
    return both.applyInArrow(pass_on, _ANSWER_DDL).union(replies.filter("node = -1"))


def gathered(answers: pa.Table) -> list[list[np.ndarray]]:
    """Totals per kind, over counted and weighing texts, in the order of the block's n-grams."""
    rows = sorted(answers.select(["kind", "range", "counted", "weighing"]).to_pylist(), key=lambda r: r["range"])
    return [
        [np.concatenate([np.zeros(0, np.uint64), *[unpacked(r[c], np.uint64) for r in rows if r["kind"] == kind]]) for kind in KINDS]
        for c in ("counted", "weighing")
    ]


# --- weights ----------------------------------------------------------------------------


def bucket(context: np.ndarray, buckets: int) -> np.ndarray:
    """0 for contexts that were never counted, else one per power of two."""
    return np.minimum(np.where(context > 0, np.log2(np.maximum(context, 1)).astype(np.int64) + 1, 0), buckets - 1)


@dataclass(frozen=True)
class Model:
    """Sizes and weights. ``low`` has bigram, unigram and uniform weights per bucket, ``high`` the trigram's."""

    v: int
    n: int
    low: np.ndarray
    high: np.ndarray

    def lower(self, pair: np.ndarray, context: np.ndarray, single: np.ndarray, buckets: int) -> np.ndarray:
        w = self.low[bucket(context, buckets)]
        return w[:, 0] * pair / np.maximum(context, 1) + w[:, 1] * single / max(self.n, 1) + w[:, 2] / (self.v + 1)

    def probabilities(self, triple: np.ndarray, pairs: np.ndarray, pair: np.ndarray, context: np.ndarray, single: np.ndarray, buckets: int) -> np.ndarray:
        k = self.high[bucket(pairs, buckets)]
        return k * triple / np.maximum(pairs, 1) + (1 - k) * self.lower(pair, context, single, buckets)


_NEVER = -(10**6)  # of an estimate that is zero


def steps_of(ratio: np.ndarray, steps: int) -> np.ndarray:
    """Ratios as whole steps of their logarithm, far below all others where zero."""
    with np.errstate(divide="ignore"):
        return np.where(ratio > 0, np.round(np.log2(np.maximum(ratio, 1e-300)) * steps), _NEVER).astype(np.int64)


def evidence(blocks: DataFrame, answers: DataFrame, model: Model, trigrams: bool, params: Params) -> np.ndarray:
    """Histogram of the weighing texts' tokens against the counted ones: bucket, estimates, number.

    For bigrams the estimates are ratios to the uniform one; for trigrams (``model`` has the
    lower weights by then) the ratio to the lower orders. The histogram is bounded: buckets
    times ratios within the range of a count.
    """
    mine = blocks.filter(F.col("part") == WEIGHING)

    def weigh(key, rows: pa.Table, totals: pa.Table) -> pa.Table:
        names = ["bucket", "one", "two", "n"]
        if not rows.num_rows:
            return pa.table({n: pa.array([], pa.int64()) for n in names})
        block = Block(texts_of(rows.column("lengths")[0].as_py(), rows.column("texts")[0].as_py()))
        triple, pairs, pair, context, single = block.spread(gathered(totals)[0])
        if trigrams:
            lower = model.lower(pair, context, single, params.buckets)
            cells = [bucket(pairs, params.buckets), steps_of(triple / np.maximum(pairs, 1) / lower, params.steps), np.zeros(len(pairs), np.int64)]
        else:
            uniform = model.v + 1
            cells = [bucket(context, params.buckets), steps_of(pair / np.maximum(context, 1) * uniform, params.steps), steps_of(single / max(model.n, 1) * uniform, params.steps)]
        found, n = np.unique(np.stack(cells), axis=1, return_counts=True)
        return pa.table({"bucket": found[0], "one": found[1], "two": found[2], "n": n.astype(np.int64)})

    replies = answers.join(mine.select(F.col("block").alias("node")), "node", "left_semi")
    both = mine.select("block", "lengths", "texts").groupBy("block").cogroup(replies.groupBy("node"))
    counted = both.applyInArrow(weigh, "bucket bigint, one bigint, two bigint, n bigint").groupBy("bucket", "one", "two").agg(F.sum("n").alias("n"))
    return np.array([tuple(r) for r in counted.collect()], np.int64).reshape(-1, 4)


def expectation_maximised(ratios: np.ndarray, n: np.ndarray, start: np.ndarray, rounds: int) -> np.ndarray:
    """Weights of estimates whose ratios to one of them are given."""
    weights = start
    for _ in range(rounds):
        shares = ratios * weights
        shares *= (n / shares.sum(1))[:, None]
        # a thousandth of one token keeps every estimate alive, so that no text has probability 0
        weights = (shares.sum(0) + 1e-3) / (n.sum() + 1e-3 * len(start))
    return weights


def learned_weights(cells: np.ndarray, params: Params) -> np.ndarray:
    """Per bucket the weights of bigram, unigram and uniform estimate, by expectation-maximisation.

    Buckets without evidence take the weights of the nearest one below that has some.
    """
    weights = np.tile([0.5, 0.4, 0.1], (params.buckets, 1))
    weights[0] = [0.0, 0.8, 0.2]  # the context was never seen: no bigram estimate
    for b in range(params.buckets):
        mine = cells[cells[:, 0] == b]
        if not len(mine):
            if b > 1:
                weights[b] = weights[b - 1]
            continue
        ratios = np.exp2(np.where(mine[:, 1:3] <= _NEVER, -np.inf, mine[:, 1:3] / params.steps))
        weights[b] = expectation_maximised(np.column_stack([ratios, np.ones(len(mine))]), mine[:, 3].astype(float), weights[b], params.rounds)
        if b == 0:
            weights[b] = [0.0, weights[b][1] + weights[b][0], weights[b][2]]
    return weights


def learned_share(cells: np.ndarray, params: Params) -> np.ndarray:
    """Per bucket the weight of the trigram estimate against the lower orders; 0 for contexts never seen."""
    shares = np.full(params.buckets, 0.5)
    shares[0] = 0.0
    for b in range(1, params.buckets):
        mine = cells[cells[:, 0] == b]
        if len(mine):
            ratio = np.exp2(np.where(mine[:, 1] <= _NEVER, -np.inf, mine[:, 1] / params.steps))
            shares[b] = expectation_maximised(np.column_stack([ratio, np.ones(len(mine))]), mine[:, 3].astype(float), np.array([0.5, 0.5]), params.rounds)[0]
        elif b > 1:
            shares[b] = shares[b - 1]
    return shares


def score(docs: DataFrame, held_out: Column, params: Params = Params()) -> DataFrame:
    """``doc_id, held_out`` and the measures of every row; learns from rows where ``held_out`` is false.

    ``base_score`` is the add-a-half unigram score, ``score`` the model's, both log10 of the
    probability of the text.
    """
    blocks = packed_blocks(docs, held_out, params)
    size, nodes = blocks.agg(F.sum(F.aggregate("lengths", F.lit(0).cast("bigint"), lambda x, y: x + y + 1)), F.count("*")).first()
    bits = max(0, math.ceil((size or 0) / params.range_bytes) - 1).bit_length()
    done = min(bits, params.fan_out.bit_length() - 1)
    answers = stored(answered(sent(blocks, done), nodes, done, bits, params))
    sums = answers.filter("node = -1").agg(F.sum("v"), F.sum("n"), F.sum("v0"), F.sum("n0")).first()
    v, n, v0, n0 = (int(x or 0) for x in sums)
    low = learned_weights(evidence(blocks, answers, Model(v0, n0, np.zeros((0, 3)), np.zeros(0)), False, params), params)
    high = learned_share(evidence(blocks, answers, Model(v0, n0, low, np.zeros(0)), True, params), params)
    model = Model(v, n, low, high)

    def scored(key, rows: pa.Table, totals: pa.Table) -> pa.Table:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        ids = rows.column("doc_ids").combine_chunks().flatten()
        held = rows.column("held_out").combine_chunks().flatten()
        if not rows.num_rows:
            measures = [pa.array([], k) for k in kinds]
        else:
            block = Block(texts_of(rows.column("lengths")[0].as_py(), rows.column("texts")[0].as_py()))
            counted, weighing = gathered(totals)
            triple, pairs, pair, context, single = block.spread([a + b for a, b in zip(counted, weighing)])
            base = np.log10((single + 0.5) / (n + 0.5 * (v + 1)))
            total = lambda x: np.add.reduceat(x, block.firsts)
            found = np.log10(model.probabilities(triple, pairs, pair, context, single, params.buckets)) if n else np.zeros(len(single))
            values = [block.sizes, total((single > 0).astype(np.int64)), np.full(len(block.sizes), n), total(base), total(found)]
            measures = [pa.array(x, k) for x, k in zip(values, kinds)]
        return pa.Table.from_arrays([ids, held, *measures], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    whole = blocks.select("block", "doc_ids", "held_out", "lengths", "texts").groupBy("block")
    replies = answers.filter("node >= 0").groupBy("node")
    return whole.cogroup(replies).applyInArrow(scored, f"doc_id {kind}, held_out boolean, {_MEASURES}")
