"""Language identification by character models with interpolated Kneser-Ney smoothing.

One model per language, learned from a bounded sample of labelled rows. The tables of all
languages share sorted arrays of n-gram hashes, with one column of log probabilities per
language; a text goes to the language with the lowest cross-entropy per character. A text
is rejected if its best model explains it worse than the middle between two figures: how well,
on texts kept back from counting, the second-best model explains texts of that language, and
a uniform guess. It is then in none of the languages; a text that mixes known languages, or
quotes names and numbers, stays below that limit.

Null texts and texts without a letter get ``und``, score 0, and are rejected. Rows whose
language is null teach nothing. Without any labelled row all texts get ``und``. Long texts
are read in runs of a million characters, so the memory they need is that of one run.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logwarden.llm.common import column, free_name, mix

UNDETERMINED = "und"
ADDED = ("lang_pred", "score", "entropy", "entropy_next", "rejected")
_SPACE = 32


@dataclass(frozen=True)
class Params:
    order: int = 4
    # Bound of the sample: characters to learn from per language (expected value; of a longer
    # text than an eighth of it, a run of that length). The model holds at most as many n-grams.
    chars_per_language: int = 600_000
    run: int = 1 << 20  # characters of a long text that are read at a time
    # With a single language there is no second-best model: this many times the mean
    # cross-entropy of the texts kept back stands for its figure.
    single_limit: float = 2.0


def letter_kinds() -> np.ndarray:
    """Per code point: 2 a letter, 1 a mark, 0 anything else."""
    import unicodedata

    kind = {"L": 2, "M": 1}
    return np.fromiter((kind.get(unicodedata.category(chr(i))[0], 0) for i in range(0x110000)), np.uint8, 0x110000)


def normal_runs(text: str, kinds: np.ndarray, order: int, run: int) -> Iterator[np.ndarray]:
    """Lower-case letters with one space between runs of them, padded; nothing without a letter.

    A long text comes in parts, cut at blanks where there are some. Each part begins with the
    end of the one before, so that their n-grams are those of the whole.
    """
    tail, lettered, at = np.full(order - 1, _SPACE, np.uint32), False, 0
    held: list[np.ndarray] = []
    while at < len(text):
        end = at + run
        if end < len(text):
            blank = text.find(" ", end, end + run)
            end = blank if blank >= 0 else end
        points = np.frombuffer(text[at:end].lower().encode("utf-32-le", "replace"), np.uint32)
        at = end
        kind = kinds[points]
        lettered = lettered or bool((kind == 2).any())
        points = np.concatenate([tail, np.where(kind > 0, points, np.uint32(_SPACE))])
        blank = points == _SPACE
        keep = ~blank
        keep[1:] |= blank[1:] & ~blank[:-1]
        keep[: len(tail)] = True
        first = blank[len(tail) : len(tail) + 1] & blank[len(tail) - 1]
        keep[len(tail) : len(tail) + 1] &= ~first
        points = points[keep]
        if at >= len(text):
            points = np.append(points, np.uint32(_SPACE))
        tail = points[len(points) - order + 1 :]
        held.append(points)
        if lettered:
            yield from held
            held = []


def normal(text: str, kinds: np.ndarray, order: int) -> np.ndarray | None:
    """``normal_runs`` of a text in one part; None without a letter."""
    return next(normal_runs(text, kinds, order, max(1, len(text))), None)


def gram_columns(points: np.ndarray, order: int) -> list[np.ndarray]:
    n = len(points) - order + 1
    return [points[i : i + n].astype(np.uint64) for i in range(order)]


def gram_hash(columns: list[np.ndarray]) -> np.ndarray:
    x = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        x = (x + c + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
    return mix(x)


class SortedTable:
    """Rows of numbers found by a sorted array of hashes."""

    def __init__(self, hashes: np.ndarray, values: np.ndarray):
        if (hashes[1:] < hashes[:-1]).any():
            order = np.argsort(hashes, kind="stable")
            hashes, values = hashes[order], values[order]
        self.hashes, self.values = hashes, values

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers (any where absent), and whether the hash is there."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return at, self.hashes[at] == hashes

    def get(self, hashes: np.ndarray, default: float) -> np.ndarray:
        at, there = self.find(hashes)
        return np.where(there, self.values[at], default) if len(self.hashes) else np.full(len(hashes), default)


class KneserNey:
    """One language: per order the discounted share of each n-gram and the weight of each context."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, alphabet: int):
        order = grams.shape[1]
        self.order, self.uniform = order, 1.0 / alphabet
        self.shares: list[SortedTable] = []
        self.weights: list[SortedTable] = []
        for k in range(order, 0, -1):
            columns = [grams[:, i] for i in range(k)]
            context = gram_hash(columns[:-1]) if k > 1 else np.zeros(len(grams), np.uint64)
            ones, twos = (counts == 1).sum(), (counts == 2).sum()
            discount = ones / (ones + 2 * twos) if ones and twos else 0.5
            keys, group = np.unique(context, return_inverse=True)
            total = np.bincount(group, counts)
            types = np.bincount(group)
            self.shares.insert(0, SortedTable(gram_hash(columns), np.maximum(counts - discount, 0) / total[group]))
            self.weights.insert(0, SortedTable(keys, discount * types / total))
            if k > 1:  # a shorter n-gram counts once for each character seen before it
                _, first, back = np.unique(gram_hash(columns[1:]), return_index=True, return_inverse=True)
                counts = np.bincount(back).astype(float)
                grams = grams[first][:, 1:]

    def probabilities(self, grams: np.ndarray) -> np.ndarray:
        """Of the last character after the others, for n-grams of any order up to the model's."""
        p = np.full(len(grams), self.uniform)
        n = grams.shape[1]
        for k in range(1, n + 1):
            columns = [grams[:, i] for i in range(n - k, n)]
            p = self.shares[k - 1].get(gram_hash(columns), 0.0) + self.context_weights(columns[:-1], len(grams)) * p
        return p

    def context_weights(self, columns: list[np.ndarray], n: int) -> np.ndarray:
        hashes = gram_hash(columns) if columns else np.zeros(n, np.uint64)
        return self.weights[len(columns)].get(hashes, 1.0)


class Models:
    """All languages: log probabilities and log weights of every n-gram that any of them has."""

    def __init__(self, languages: list[str], order: int, run: int = Params.run):
        self.languages, self.order, self.run = languages, order, run
        self.limits = np.full(len(languages), np.inf)
        self.grams: list[SortedTable] = []
        self.contexts: list[SortedTable] = []
        self.unseen = np.zeros(len(languages))

    def learn(self, tables: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """``tables`` has the n-grams of each language and their counts."""
        alphabet = len(np.unique(np.concatenate([g.ravel() for g, _ in tables]))) + 1
        each = [KneserNey(g, c, alphabet) for g, c in tables]
        every = np.concatenate([g for g, _ in tables])
        for k in range(1, self.order + 1):
            cut = every[:, self.order - k :]
            hashes, first = np.unique(gram_hash([cut[:, i] for i in range(k)]), return_index=True)
            cut = cut[first]
            logs = np.log(np.stack([m.probabilities(cut) for m in each], 1)).astype(np.float32)
            self.grams.append(SortedTable(hashes, logs))
            heads = every[:, : k - 1]
            columns = [heads[:, i] for i in range(k - 1)]
            hashes = gram_hash(columns) if columns else np.zeros(1, np.uint64)
            hashes, first = np.unique(hashes, return_index=True)
            columns = [c[first] for c in columns]
            weights = np.stack([m.context_weights(columns, len(hashes)) for m in each], 1)
            self.contexts.append(SortedTable(hashes, np.log(weights).astype(np.float32)))
        self.unseen = np.full(len(self.languages), np.log(1.0 / alphabet))

    def plain(self) -> tuple:
        """Only arrays and strings, which any process can unpickle."""
        tables = [[(t.hashes, t.values) for t in each] for each in (self.grams, self.contexts)]
        return self.languages, self.order, self.run, self.limits, self.unseen, tables

    @staticmethod
    def of(plain: tuple) -> Models:
        languages, order, run, limits, unseen, tables = plain
        models = Models(languages, order, run)
        models.limits, models.unseen = limits, unseen
        models.grams, models.contexts = ([SortedTable(*t) for t in each] for each in tables)
        return models

    def log_sums(self, columns: list[np.ndarray]) -> np.ndarray:
        """Sum over all n-grams of the log probability, per language."""
        if not columns:
            return self.unseen
        at, there = self.grams[len(columns) - 1].find(gram_hash(columns))
        total = self.grams[len(columns) - 1].values[at[there]].sum(0, dtype=np.float64)
        if there.all():
            return total
        # unseen everywhere: the weight of the context, and the shorter n-gram
        columns = [c[~there] for c in columns]
        hashes = gram_hash(columns[:-1]) if len(columns) > 1 else np.zeros(len(columns[0]), np.uint64)
        at, there = self.contexts[len(columns) - 1].find(hashes)
        total = total + self.contexts[len(columns) - 1].values[at[there]].sum(0, dtype=np.float64)
        if len(columns) == 1:
            return total + len(columns[0]) * self.unseen
        return total + self.log_sums(columns[1:])

    def judge(self, text: str | None, kinds: np.ndarray) -> tuple[str, float, float | None, float | None, bool]:
        """Language, score, cross-entropy in nats per character, that of the next language, rejection."""
        sums, n = np.zeros(len(self.languages)), 0
        for points in normal_runs(text, kinds, self.order, self.run) if text and self.languages else ():
            if len(points) >= self.order:
                columns = gram_columns(points, self.order)
                sums, n = sums + self.log_sums(columns), n + len(columns[0])
        if not n:
            return UNDETERMINED, 0.0, None, None, True
        entropies = -sums / n
        best = int(entropies.argmin())
        # the share of the best language, as if at most 50 characters had been read
        odds = np.exp((entropies[best] - entropies) * min(50, n))
        limit = self.limits[best] * (1 + 4 / n)
        following = float(np.partition(entropies, 1)[1]) if len(entropies) > 1 else None
        return self.languages[best], float(1 / odds.sum()), float(entropies[best]), following, bool(entropies[best] > limit)


def sample(labelled: DataFrame, text: str, lang: str, params: Params) -> DataFrame:
    """Rows to learn from, as ``lang``, ``text`` and ``part``; every tenth text is kept back (part 0).

    Rows are drawn one by one, by a hash of all their plain columns: copies of a text that
    differ in another column, such as an id, are not drawn together.
    """
    plain = [F.col(f.name) for f in labelled.schema.fields if isinstance(f.dataType, T.AtomicType)]
    known = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(*plain).alias("draw"))
    known = known.filter("lang is not null and text is not null")
    # of a long text a run, from a place that its hash decides
    most, length = F.lit(params.chars_per_language // 8), F.length("text")
    start = F.pmod("draw", F.greatest(length - most, F.lit(0)) + 1).cast("int") + 1
    known = known.withColumn("text", F.when(length <= most, F.col("text")).otherwise(F.substr("text", start, most)))
    sizes = known.groupBy("lang").agg(F.sum(F.length("text")).alias("size"))
    share = F.least(F.lit(1.0), params.chars_per_language / F.col("size"))
    shares = {r["lang"]: r["share"] for r in sizes.select("lang", share.alias("share")).collect()}
    draw = F.pmod("draw", F.lit(1_000_003)) / 1_000_003.0
    limit = F.coalesce(*[F.when(F.col("lang") == k, v) for k, v in shares.items()], F.lit(0.0))
    part = F.pmod(F.xxhash64("text", F.lit("part")), F.lit(10))
    return known.filter(draw < limit).select("lang", "text", part.alias("part")).repartition("lang")


def count_grams(rows: pd.DataFrame, order: int) -> pd.DataFrame:
    """N-gram table of one language's sample."""
    kinds = letter_kinds()
    # a language that has only texts that would be kept back learns from these
    learned = rows["text"][rows["part"] != 0] if (rows["part"] != 0).any() else rows["text"]
    found = [normal(t, kinds, order) for t in learned]
    parts = [np.stack(gram_columns(p, order), 1) for p in found if p is not None]
    if not parts:
        return pd.DataFrame({"lang": [], "grams": [], "counts": []})
    grams = np.concatenate(parts)
    _, first, counts = np.unique(gram_hash(list(grams.T)), return_index=True, return_counts=True)
    return pd.DataFrame(
        {
            "lang": [rows["lang"].iloc[0]],
            "grams": [grams[first].astype("<u4").tobytes()],
            "counts": [counts.astype("<i8").tobytes()],
        }
    )


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", params: Params = Params()) -> Models | None:
    """Learn from labelled rows. The model is bounded by ``chars_per_language`` and the number of languages."""
    rows = sample(labelled, text, lang, params)
    counted = rows.groupBy("lang").applyInPandas(lambda p: count_grams(p, params.order), "lang string, grams binary, counts binary")
    tables = sorted(counted.collect(), key=lambda r: r["lang"])
    if not tables:
        return None
    unpacked = [
        (np.frombuffer(r["grams"], "<u4").reshape(-1, params.order).astype(np.uint64), np.frombuffer(r["counts"], "<i8").astype(float))
        for r in tables
    ]
    models = Models([r["lang"] for r in tables], params.order, params.run)
    models.learn(unpacked)
    held = predict(rows.filter("part = 0"), models).filter("lang_pred = lang")
    limit = F.coalesce(F.avg("entropy_next"), params.single_limit * F.avg("entropy"))
    uniform = -models.unseen[0]
    found = {r["lang"]: (r["limit"] + uniform) / 2 for r in held.groupBy("lang").agg(limit.alias("limit")).collect()}
    widest = max(found.values(), default=np.inf)
    models.limits = np.array([found.get(name, widest) for name in models.languages])
    return models


def predict(docs: DataFrame, models: Models | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score``, ``entropy``, ``entropy_next``, ``rejected`` (replaced where they exist)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(models.plain() if models else None)
    added = dict(zip(ADDED, (pa.string(), pa.float64(), pa.float64(), pa.float64(), pa.bool_())))
    kept = docs.drop(*added)
    given = free_name(kept, "judged")
    rows = kept.withColumn(given, F.col(text))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = kinds = None
        for batch in batches:
            if shared.value and known is None:
                known, kinds = Models.of(shared.value), letter_kinds()
            if known is None:
                found = [(UNDETERMINED, 0.0, None, None, True)] * batch.num_rows
            else:
                found = [known.judge(t, kinds) for t in column(batch, given)]
            columns = batch.columns[:-1] + [pa.array([f[i] for f in found], t) for i, t in enumerate(added.values())]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1] + list(added))

    new = "lang_pred string, score double, entropy double, entropy_next double, rejected boolean"
    schema = T.StructType(kept.schema.fields + T.StructType.fromDDL(new).fields)
    return rows.mapInArrow(judged, schema)


def identify(docs: DataFrame, labelled: DataFrame, params: Params = Params()) -> DataFrame:
    """Fit on ``labelled`` and judge all of ``docs``."""
    return predict(docs, fit(labelled, params=params))
