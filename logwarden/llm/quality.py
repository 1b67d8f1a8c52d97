"""Quality by hashed n-gram likelihood ratio, after plain rules. DataFrame functions alone.

Features are hashed character n-grams, in two scores. ``log_ratio`` reads word borders: the
last two characters of each word, and the characters on both sides of each gap between words.
``text_ratio`` reads the words whole: all three-character strings of each word with a space
before and after. Features are counted in a fixed number of buckets (each score its own) over
all trusted texts and over the whole corpus; a score is the mean log ratio of the two smoothed
multinomials over a document's features. A document is kept if it passes the base rules and
each score is no lower than a threshold that all but a fixed share of the trusted texts
reach. Scores are compared after rounding, so reruns agree.

Texts are scored once: the scores are stored, the thresholds are read off the stored rows. Strings
of ASCII words are cut by bytes and several trigrams of a word share a row, as cutting by characters
and rows were most of the time.

Trigrams that neither side has seen count 0 in ``text_ratio``: the trusted side is smoothed by
its share of the corpus, else unknown strings would speak for a text.

Null and empty texts have no words and fail the base rules. Without trusted rows the ratio is
0 everywhere and the base rules decide alone. Rows that share a doc_id are judged each; other
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.llm.common import words_of
from logwarden.operators.compute_once import with_struct
from logwarden.session import stored

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\f\r"


@dataclass(frozen=True)
class Params:
    buckets: int = 1 << 14
    lost_per_mille: int = 1
    grain: int = 10_000  # scores are compared in steps of 1 / grain
    trigrams_of_piece: int = 8  # trigrams of a word that share a row
    min_words: int = 50
    max_repeat_percent: int = 50


def bucket(*parts: Column, params: Params) -> Column:
    hashed, n = F.xxhash64(*parts), params.buckets
    # for a power of two the low bits are that remainder, without a division
    return (F.pmod(hashed, F.lit(n)) if n & (n - 1) else hashed.bitwiseAND(F.lit(n - 1).cast("bigint"))).cast("int")


def cut(start: Column, n: Column) -> Column:
    """``n`` characters of ``framed`` from ``start`` on, as bytes: without a walk from its beginning if all are ASCII."""
    return F.when(F.col("plain"), F.substr("bytes", start, n)).otherwise(F.substr("framed", start, n).cast("binary"))


def with_places(rows: DataFrame, words: str, params: Params) -> DataFrame:
    """One row per word (one in all without words), null where absent: its length ``size``, the buckets
    ``tail`` and ``gap`` (of the characters on both sides of the gap after it, null after the last), the
    word with a space before and after, ``framed``, its ``bytes``, and ``plain``, whether all are ASCII."""
    others, size = [c for c in rows.columns if c != words], F.col("size")
    placed = rows.select(*others, words, F.posexplode_outer(words).alias("at", "word"))
    after = F.substring(F.get(F.col(words), F.col("at") + 1), 1, 1).alias("after")
    framed = F.concat(F.lit(" "), "word", F.lit(" ")).alias("framed")
    placed = placed.select(*others, after, F.length("word").alias("size"), framed)
    plain = F.octet_length("framed") == size + 2
    placed = placed.select("*", F.col("framed").cast("binary").alias("bytes"), plain.alias("plain"))
    tail = F.when(size.isNotNull(), bucket(cut(F.greatest(size, F.lit(2)), F.least(size, F.lit(2))), params=params))
    gap = F.when(F.col("after").isNotNull(), bucket(cut(size + 1, F.lit(1)), F.col("after"), params=params))
    return placed.select(*others, "size", tail.alias("tail"), gap.alias("gap"), "framed", "bytes", "plain")


def with_pieces(placed: DataFrame, params: Params) -> DataFrame:
    """One row per ``trigrams_of_piece`` trigrams of each word (one in all without words), which begin at
    ``start`` of ``framed`` and the places after it; ``piece`` has their characters if not all are ASCII."""
    size, n = F.col("size"), params.trigrams_of_piece
    starts = F.when(size <= n, F.array(F.lit(1))).otherwise(F.sequence(F.lit(1), size, F.lit(n)))
    # most words are one piece; a long one is not walked again for each of its trigrams
    piece = F.when(~F.col("plain"), F.substr("framed", F.col("start"), F.lit(n + 2))).alias("piece")
    return placed.select("*", F.explode_outer(starts).alias("start")).select("*", piece).drop("framed")


def inner_of(i: int, params: Params) -> Column:
    """Bucket of the trigram of a piece that begins ``i`` places after its start, null beyond the word."""
    start = F.col("start") + i if i else F.col("start")
    found = F.when(F.col("plain"), F.substr("bytes", start, F.lit(3))).otherwise(F.substr("piece", F.lit(i + 1), F.lit(3)).cast("binary"))
    return F.when(start <= F.col("size"), bucket(found, params=params))


def with_base(rows: DataFrame, text: str, words: str, params: Params) -> DataFrame:
    """Add ``n_words, n_symbols, n_dup_lines, n_repeat_words, base_failed``; drops ``text``."""
    w, n = F.col(words), F.size(words)
    given = F.coalesce(F.col(text), F.lit(""))
    symbols = F.regexp_replace(given, f"[^{SYMBOLS}]+", "")
    lines = F.filter(F.split(given, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    rows = with_struct(rows, "lines", lines)
    rows = rows.withColumns(
        {
            "n_words": n.cast("bigint"),
            "n_symbols": F.length(symbols).cast("bigint"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint"),
        }
    ).drop("lines", text)
    # the last two words begin no window
    windows = F.arrays_zip(*[F.slice(w, i, F.greatest(n - 2, F.lit(0))).alias(f"w{i}") for i in (1, 2, 3)])
    triples = F.transform(windows, lambda x: F.xxhash64(x))
    rows = with_struct(rows, "triples", triples)
    t = F.col("triples")
    # sorted with their places, equal triples are neighbours; needed only where any are equal
    placed = F.sort_array(F.transform(t, lambda x, i: F.struct(x.alias("t"), i.alias("i"))))
    none = F.array().cast("array<struct<t:bigint,i:int>>")
    rows = with_struct(rows, "sorted", F.when(F.size(F.array_distinct(t)) < F.size(t), placed).otherwise(none)).drop("triples")
    s = F.col("sorted")
    same = lambda x, i: F.coalesce(F.get(s, i)["t"] == x["t"], F.lit(False))
    again = F.filter(s, lambda x, i: same(x, i + 1) | same(x, i - 1))
    rows = with_struct(rows, "places", F.sort_array(F.transform(again, lambda x: x["i"]))).drop("sorted")
    p = F.col("places")
    covered = F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1), x + 3) - x))
    rows = rows.withColumn("n_repeat_words", F.aggregate(covered, F.lit(0), lambda a, x: a + x).cast("bigint")).drop("places")
    failed = (F.col("n_words") < params.min_words) | (100 * F.col("n_repeat_words") > params.max_repeat_percent * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def log_ratios(docs: DataFrame, trusted: DataFrame, params: Params) -> tuple[list[float], list[float]]:
    """Per bucket log of trusted over raw probability, smoothed: ``buckets`` numbers for word borders, and for trigrams."""
    # trusted ids can be as many as texts: none are broadcast, and texts need no order
    marks = trusted.withColumn("trusted", F.lit(1)).hint("shuffle_hash")
    flagged = docs.select("doc_id", "text").join(marks, "doc_id", "left")
    rows = with_struct(flagged.select("text", F.coalesce("trusted", F.lit(0)).alias("trusted")), "words", words_of(F.col("text")))
    pieces = with_pieces(with_places(rows.select("trusted", "words"), "words", params), params)
    borders = [F.when(F.col("start") == 1, F.col(c)) for c in ("tail", "gap")]
    inner = [inner_of(i, params) + params.buckets for i in range(params.trigrams_of_piece)]
    found = pieces.select("trusted", F.explode(F.array(*borders, *inner)).alias("found")).filter("found is not null")
    # grouped by bucket and side at once: few keys, whatever the words are
    counts = found.groupBy((F.col("found") * 2 + F.col("trusted")).alias("key")).agg(F.count("*").alias("n"))
    counts = counts.select("n", F.shiftright("key", 1).alias("bucket"), (F.col("key") % 2).alias("trusted"))
    counts = counts.groupBy("bucket").agg(F.sum("n").alias("raw"), F.sum(F.col("n") * F.col("trusted")).alias("good"))
    raw, good = [0] * (2 * params.buckets), [0] * (2 * params.buckets)
    for b, n, g in counts.collect():  # one row per bucket at most
        raw[b], good[b] = n, g
    if not sum(good):
        return [0.0] * params.buckets, [0.0] * params.buckets
    raw, raw_inner = raw[: params.buckets], raw[params.buckets :]
    good, good_inner = good[: params.buckets], good[params.buckets :]
    every, best = sum(raw) + params.buckets, sum(good) + params.buckets
    scale = sum(raw_inner) / sum(good_inner)
    borders = [log((g + 1) / best) - log((n + 1) / every) for n, g in zip(raw, good)]
    return borders, [log((g * scale + 1) / (n + 1)) for n, g in zip(raw_inner, good_inner)]


def scored(rows: DataFrame, words: str, keys: list[str], ratios: tuple[list[float], list[float]], params: Params) -> DataFrame:
    """One row per ``keys``, which tell rows apart, with ``step`` and ``text_step``, the mean log
    ratios of word borders and trigrams in steps of 1 / grain, and ``word_chars``."""
    borders, inner = (F.split(F.lit(",".join(map(repr, r))), ",").cast("array<double>") for r in ratios)
    of = lambda table, b: F.coalesce(F.get(table, b), F.lit(0.0))
    ends = F.when(F.col("gap").isNull(), 1).otherwise(2)
    border = of(borders, F.col("tail")) + of(borders, F.col("gap"))
    placed = with_places(rows.select(*keys, words), words, params)
    placed = placed.select(*keys, "size", "framed", "bytes", "plain", border.alias("border"), ends.alias("ends"))
    # a row adds up several trigrams of a word; the first one also brings what the word counts once
    pieces, start = with_pieces(placed, params), F.col("start")
    values = [of(inner, inner_of(i, params)) for i in range(params.trigrams_of_piece)]
    first = [F.when(start == 1, F.col(c)).alias(c) for c in ("size", "border", "ends")]
    found = pieces.select(*keys, *first, F.when(start.isNotNull(), sum(values[1:], values[0])).alias("total"))
    mean = lambda total, n: F.round(F.coalesce(total, F.lit(0.0)) / F.greatest(n, F.lit(1)) * params.grain).cast("bigint")
    return found.groupBy(*keys).agg(
        mean(F.sum("border"), F.sum("ends")).alias("step"),
        mean(F.sum("total"), F.sum("size")).alias("text_step"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("word_chars"),
    )


def trusted_ids(labels: DataFrame, good: Column) -> DataFrame:
    """All distinct ids of rows that are ``good``."""
    return labels.filter(good).select("doc_id").filter("doc_id is not null").distinct()


def thresholds_of(scores: DataFrame, trusted: DataFrame, params: Params) -> tuple[int, int]:
    """For each score the step that all but ``lost_per_mille`` of the trusted texts with words reach."""
    reached = scores.filter("n_words > 0").join(trusted.hint("shuffle_hash"), "doc_id", "left_semi")
    kinds = F.explode(F.create_map(F.lit(0), "step", F.lit(1), "text_step")).alias("kind", "reached")
    # two histograms: as many rows as there are steps, which logs of counts bound
    found = reached.select(kinds).groupBy("kind", "reached").count().collect()
    return tuple(lowest([(step, n) for kind, step, n in found if kind == k], params) for k in (0, 1))


def lowest(found: list[tuple[int, int]], params: Params) -> int:
    lost, allowed = 0, sum(n for _, n in found) * params.lost_per_mille // 1000
    for step, n in sorted(found):
        lost += n
        if lost > allowed:
            return step
    return 0


def judged(docs: DataFrame, labels: DataFrame, good: Column, params: Params = Params()) -> DataFrame:
    """``doc_id``, the base measures, both scores and ``kept`` of each row; learns from rows of ``labels`` that are ``good``."""
    trusted = trusted_ids(labels, good)
    ratios = log_ratios(docs, trusted, params)
    measures = ["n_words", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    rows = with_base(with_struct(rows, "words", words_of(F.col("text"))), "text", "words", params)
    rows = stored(scored(rows, "words", ["row", "doc_id", *measures], ratios, params).drop("row"))
    threshold, text_threshold = thresholds_of(rows, trusted, params)
    verdict = ~F.col("base_failed") & (F.col("step") >= threshold) & (F.col("text_step") >= text_threshold)
    scores = [(F.col("step") / params.grain).alias("log_ratio"), (F.col("text_step") / params.grain).alias("text_ratio")]
    return rows.select("doc_id", "word_chars", *measures, *scores, verdict.alias("kept"))
