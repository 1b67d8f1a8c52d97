"""Document fingerprints from closed syncmers, with DataFrame functions alone.

A text is a sequence of units: what blanks separate in scripts that have blanks between words,
and single characters in the others (Chinese, Japanese, Thai and their like). A run of more
than 32 characters is cut behind certain letters and digits, so that a change within it
moves only the cuts near it. This holds at every length, so texts of any two lengths have
anchors in common where they have words in common. A window of
three units is a closed syncmer when the least of the hashes of its units (the inner strings) is the first or the
last. Whether a window is chosen depends on its own units only, so an edit moves or
removes anchors near the edit and no others. The fingerprint is the ``size`` least hashes of
a text's syncmers, in hexadecimal; two fingerprints are as alike as their least hashes
together have members in common.

Texts of less than three units are one anchor; null counts as empty; empty and blank texts
have no anchor and an empty fingerprint. Two empty fingerprints are alike (1), an empty one
and another are not (0). Equal texts have equal fingerprints.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logwarden.llm.common import blank_to_space, words_of
from logwarden.operators.compute_once import with_struct


@dataclass(frozen=True)
class Params:
    size: int = 64
    # Documents are put in order in ranges of about this many rows, but not in more ranges than
    # four times the session's shuffle partitions (4096 at least): a range is a task's share.
    range_rows: int = 4096
    max_ranges: int = 4096


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once and held by reference: a column of bytes would
    be copied out of its row at every use."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


# Characters that words are made of: all but blanks, control characters and scripts without blanks
# (Thai, Lao, Tibetan, Myanmar, Khmer, Chinese, Japanese, Yi, full-width forms).
_WORD = r"[^\x00-\x20\u0E00-\u109F\u1780-\u17FF\u2E80-\uA4CF\uF900-\uFAFF\uFF00-\uFFEF\x{20000}-\x{3FFFF}]"
UNITS = rf"{_WORD}{{1,32}}(?!{_WORD})|{_WORD}{{4,31}}?[aeknsyAEKNSY1579]|{_WORD}{{32}}|[^\x20\x09-\x0D]"


def units(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(UNITS), F.lit(0))


def anchor_list(text: Column, positions: bool = False) -> Column:
    """Hashes of all syncmers; with ``positions``, structs of the number of the first unit and the hash."""
    anchor = (lambda i, x: F.struct(i.alias("position"), x.alias("hash"))) if positions else lambda i, x: x
    none = F.array().cast("array<struct<position:int,hash:bigint>>" if positions else "array<bigint>")

    def of(h: Column) -> Column:
        def closed(x: Column, i: Column) -> Column:
            inner, last = F.get(h, i + 1), F.get(h, i + 2)
            return F.when(F.least(x, last) <= inner, anchor(i, F.xxhash64(x, inner, last)))

        # the last two units begin no window
        found = F.slice(F.transform(h, closed), 1, F.greatest(F.size(h) - 2, F.lit(0)))
        whole = F.array(anchor(F.lit(0), F.xxhash64(h)))
        return F.when(F.size(h) == 0, none).when(F.size(h) < 3, whole).otherwise(F.array_compact(found))

    return let(F.transform(units(F.coalesce(text, F.lit(""))), lambda u: F.xxhash64(u)), of)


def sketch(anchors: Column, params: Params) -> Column:
    """The least distinct hashes."""
    return F.slice(F.sort_array(F.array_distinct(anchors)), 1, params.size)


def as_text(hashes: Column) -> Column:
    return F.array_join(F.transform(hashes, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def likeness(a: Column, b: Column, params: Params) -> Column:
    """Share of the least hashes of both together that both have: an estimate of the Jaccard similarity."""
    least = F.slice(F.sort_array(F.array_union(a, b)), 1, params.size)
    common = F.size(F.array_intersect(F.array_intersect(least, a), b))
    return F.when(F.size(least) == 0, F.lit(1.0)).otherwise(common / F.size(least))


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint", params: Params = Params()) -> DataFrame:
    """``docs`` with the fingerprint of the text (replaced where it exists)."""
    return docs.withColumn(out, as_text(sketch(anchor_list(F.col(text)), params)))


def anchors(docs: DataFrame, text: str = "text", out: str = "anchors", params: Params = Params()) -> DataFrame:
    """``docs`` with the first unit and the hash of every syncmer, for matching by position."""
    return docs.withColumn(out, anchor_list(F.col(text), positions=True))


def with_sketch(rows: DataFrame, text: str, out: str, params: Params) -> DataFrame:
    return with_struct(rows, out, sketch(anchor_list(F.col(text)), params))


def with_next(docs: DataFrame, params: Params) -> DataFrame:
    """``doc_id, text`` rows with their sketch ``own`` and the ``next`` row's text and sketch.

    Next in descending doc_id; after the last comes the first. Rows without doc_id come last,
    rows that share one in descending order of their text. Ranges of ids are put in order
    separately, and the end of each range gets the head of the next one, so that no task
    sees all rows.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63))).alias("place"),
    )
    n = rows.count()
    most = max(params.max_ranges, 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranges = max(1, min(most, n // params.range_rows))
    shares = [i / ranges for i in range(1, ranges)]
    found = rows.agg(F.percentile_approx("place", shares, 10 * ranges)).first()[0] if shares else None
    ranged = rows.withColumn("range", range_of(F.col("place"), sorted(set(found or []))))
    # the head of each range: one row per range, and few bytes of it in one place
    places = ranged.groupBy("range").agg(F.max("place").alias("place"))
    order = W.orderBy(F.desc("range"))
    whole = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    follow = places.select("range", F.coalesce(F.lead("range").over(order), F.first("range").over(whole)).alias("headed"))
    # broadcast: as many rows of two numbers as there are ranges, which is bounded above
    heads = ranged.join(F.broadcast(places), ["range", "place"]).groupBy(F.col("range").alias("headed")).agg(F.max("text").alias("text"))
    heads = with_sketch(heads, "text", "own", params).select("headed", F.struct("text", "own").alias("head"))
    after = follow.join(heads, "headed").select(F.col("range").alias("after"), "head")
    within = W.partitionBy("range").orderBy(F.desc("place"), F.desc("text"))
    sketched = with_sketch(ranged, "text", "own", params)
    led = sketched.withColumn("next", F.lead(F.struct("text", "own")).over(within))
    # only the last row of a range has no next one in it
    joined = led.join(after, (F.col("range") == F.col("after")) & F.col("next").isNull(), "left")
    return joined.select("doc_id", "text", "own", F.coalesce("next", "head").alias("next"))


def range_of(place: Column, cuts: list[int]) -> Column:
    """The number of cuts below a place: first among every k-th of them, then among the k that follow."""
    if not cuts:
        return F.lit(0)
    array = lambda values: F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")
    k = math.isqrt(len(cuts)) + 1
    coarse = F.size(F.filter(array(cuts[::k]), lambda c: c < place))
    fine = F.size(F.filter(F.slice(array(cuts), (F.greatest(coarse, F.lit(1)) - 1) * k + 1, k), lambda c: c < place))
    return F.greatest(coarse - 1, F.lit(0)) * k + fine


def edited_pairs(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """Each text, the text edited with its successor's beginning, and the likeness of their fingerprints."""
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - cut), F.substr("next.text", F.lit(1), cut))
    rows = with_next(docs, params).withColumn("edited", edited)
    rows = with_sketch(rows, "edited", "changed", params)
    return rows.select(
        "doc_id",
        n.cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed"), params).alias("near_edited"),
        likeness(F.col("own"), F.col("next.own"), params).alias("near_next"),
    )
