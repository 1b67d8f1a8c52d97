"""Near duplicates on word shingles: SuperMinHash signatures, banding, verification, grouping.

Words lie between blanks; A-Z are lower-cased. The set of a document holds its distinct
five-word shingles, or its whole word sequence where it has fewer words. Two documents are
linked when their sets share three quarters of their union; a group is what links connect.

Edge cases. Null, empty and blank texts have an empty set and are linked with nothing.
Equal word sequences form one class before anything is compared, so any number of copies
costs one comparison. Rows without doc_id take part in no group: they keep a null
component and are kept. Rows that share a doc_id count as one document, and each of them is
reported. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logwarden.llm.common import column, lower_words, mix, window_hashes
from logwarden.session import stored


@dataclass(frozen=True)
class Params:
    words: int = 5
    similar_percent: int = 75
    # 32 bands of 4 registers miss a pair at the threshold with probability 5e-6.
    bands: int = 32
    rows: int = 4
    # Rows of a bucket that are compared in one piece: memory of a task, no limit on buckets.
    piece: int = 256


def shingle_sets(texts: list[str | None], words: int) -> Iterator[tuple[int, list[np.ndarray], list[bytes]]]:
    """For runs of texts: number of the first, sorted distinct shingle hashes and class of each.

    Texts without words have an empty set and an empty class. A very long text needs some
    tens of bytes of memory per word.
    """
    for found in lower_words(texts):
        last = np.cumsum(found.counts)
        begin = last - found.counts
        n = np.where(found.counts > 0, np.maximum(found.counts - words + 1, 1), 0)
        offsets = np.cumsum(n) - n
        where = np.repeat(begin - offsets, n) + np.arange(n.sum())
        sizes = np.repeat(np.minimum(found.counts, words), n)
        hashes = window_hashes(found.hashes, where, sizes)
        yield found.first, [np.unique(hashes[o : o + k]) for o, k in zip(offsets.tolist(), n.tolist())], found.classes


def superminhash(elements: np.ndarray, owner: np.ndarray, n: int, registers: int) -> np.ndarray:
    """SuperMinHash signatures of ``n`` sets, whose elements lie one after another in ``elements``.

    Every element walks through a random permutation of the registers; at step j it offers
    j + r, with r in [0, 1), to the j-th register of its permutation, and each register keeps
    the least offer. Ranks of an element are thus correlated: all distinct. Elements walk in
    step, so the walk of a set stops as soon as all its registers are taken: any later offer
    is larger.
    """
    signature = np.full(n * registers, np.inf)
    base = owner * registers
    permutation = None
    for step in range(registers):
        if not len(elements):
            break
        bits = mix(elements + np.uint64((2 * step + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        offer = step + (bits >> np.uint64(11)) * 2.0**-53
        pick = (step + mix(bits) % np.uint64(registers - step)).astype(np.int64)
        if permutation is None:
            place = pick
        else:
            row = np.arange(len(elements))
            place = permutation[row, pick].astype(np.int64)
            permutation[row, pick] = permutation[row, step]
        np.minimum.at(signature, base + place, offer)
        unfinished = np.isinf(signature.reshape(n, registers)).any(1)
        going = unfinished[owner]
        if permutation is None:
            permutation = np.tile(np.arange(registers, dtype=np.uint16), (int(going.sum()), 1))
            taken = pick[going]
            permutation[np.arange(len(taken)), taken] = 0
            permutation[:, 0] = np.where(taken == 0, 0, permutation[:, 0])
        else:
            permutation = permutation[going]
        elements, owner, base = elements[going], owner[going], base[going]
    return signature.reshape(n, registers)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band; equal for equal registers of the same band."""
    bits = signature.view(np.uint64).reshape(len(signature), bands, rows)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64), bits.shape[:2])
    for i in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + bits[:, :, i])
    return key.view(np.int64)


def signatures(docs: DataFrame, params: Params) -> DataFrame:
    """``doc_id, class, n_shingles, keys`` of each row; class and keys are empty without words."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for first, sets, classes in shingle_sets(column(batch, "text"), params.words):
                sizes = [len(s) for s in sets]
                full = [s for s in sets if len(s)]
                keys = np.zeros((0, params.bands), np.int64)
                if full:
                    owner = np.repeat(np.arange(len(full)), [len(s) for s in full])
                    registers = superminhash(np.concatenate(full), owner, len(full), params.bands * params.rows)
                    keys = band_keys(registers, params.bands, params.rows)
                ends = np.cumsum([0] + [params.bands * (k > 0) for k in sizes]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, len(sets)),
                        pa.array(classes, pa.binary()),
                        pa.array(sizes, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel())),
                    ],
                    names=["doc_id", "class", "n_shingles", "keys"],
                )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(signed, "doc_id bigint, class binary, n_shingles bigint, keys array<bigint>")


def full_sets(docs: DataFrame, wanted: DataFrame, params: Params) -> DataFrame:
    """``node, shingles`` for each of ``wanted`` (``class, node``): one text of it, read again."""

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            due, nodes = column(batch, "class"), batch.column(batch.schema.get_field_index("node"))
            for first, sets, classes in shingle_sets(column(batch, "text"), params.words):
                # a doc_id may come with several texts; only the one asked for counts
                hits = [i for i, c in enumerate(classes) if c == due[first + i]]
                if hits:
                    ends = np.cumsum([0] + [len(sets[i]) for i in hits]).astype(np.int32)
                    values = np.concatenate([sets[i] for i in hits]).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [nodes.take(pa.array([first + i for i in hits])), pa.ListArray.from_arrays(pa.array(ends), pa.array(values))],
                        names=["node", "shingles"],
                    )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("node"), F.col("text").cast("string").alias("text"))
    once = rows.join(wanted.select("class", "node"), "node").dropDuplicates(["node", "class", "text"])
    return once.mapInArrow(sets_of, "node bigint, shingles array<bigint>")


def confirmed(pairs: DataFrame, sets: DataFrame, params: Params) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", common.alias("n"), (F.size("sa") + F.size("sb")).alias("m"))
    return both.filter(100 * F.col("n") >= params.similar_percent * (F.col("m") - F.col("n"))).select("a", "b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges`` (``a, b``): the least node that links reach.

    Labels spread along links and then jump to the label of the label, so long chains take
    a logarithmic number of rounds. Every round is written to the shared folder.
    """
    links = stored(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct())
    first = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
    labels = stored(first.select("node", F.least("node", "b").alias("label"), F.lit(True).alias("moved")))
    while not labels.filter("moved").isEmpty():
        own = labels.select("node", "label", F.col("label").alias("own"))
        sent = links.join(labels.select(F.col("node").alias("b"), "label"), "b")
        sent = sent.select(F.col("a").alias("node"), "label", F.lit(None).cast("bigint").alias("own"))
        nearest = own.union(sent).groupBy("node").agg(F.min("label").alias("label"), F.max("own").alias("own"))
        further = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        jumped = nearest.join(further, "label").select("node", F.col("next").alias("label"), (F.col("next") != F.col("own")).alias("moved"))
        labels = stored(jumped)
    return labels.select("node", "label")


def relabelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with ``comp`` replaced by its component, where it has one."""
    known = labels.select(F.col("node").alias("comp"), "label")
    rest = [c for c in rows.columns if c != "comp"]
    return rows.join(known, "comp", "left").select(*rest, F.coalesce("label", "comp").alias("comp"))


def open_pieces(members: DataFrame, params: Params) -> DataFrame:
    """What is still to be compared, as rows ``cell, node, comp, stray``.

    In a bucket (``key``) that holds several components, its largest one needs no comparison
    within; all other rows, the strays, are compared with every row. Large buckets are cut
    into pieces, and a cell holds the strays of one piece and the rows of another.
    """
    counts = members.groupBy("key", "comp").agg(F.count("*").alias("n"))
    mixed = counts.groupBy("key").agg(F.sum("n").alias("rows"), F.count("*").alias("comps"), F.max(F.struct("n", "comp")).alias("main"))
    mixed = stored(mixed.filter("comps > 1").select("key", "rows", F.col("main.comp").alias("main"), F.col("main.n").alias("kin")))
    pieces = lambda n: F.ceil(F.col(n) / params.piece).cast("int")
    rows = members.join(mixed.select("key", "main", pieces("rows").alias("pieces"), F.ceil((F.col("rows") - F.col("kin")) / params.piece).cast("int").alias("stray_pieces")), "key")
    of = lambda n: F.pmod(F.xxhash64("node", F.lit(n)), F.col(n)).cast("int")
    rows = rows.withColumn("stray", F.col("comp") != F.col("main"))
    every = F.transform(F.sequence(F.lit(0), F.col("stray_pieces") - 1), lambda i: F.struct(i.alias("i"), of("pieces").alias("j"), F.lit(False).alias("stray")))
    mine = F.transform(F.sequence(F.lit(0), F.col("pieces") - 1), lambda j: F.struct(of("stray_pieces").alias("i"), j.alias("j"), F.lit(True).alias("stray")))
    cells = F.when(F.col("stray"), F.concat(every, mine)).otherwise(every)
    placed = rows.select("key", "node", "comp", F.explode(cells).alias("at"))
    return placed.select(F.xxhash64("key", "at.i", "at.j").alias("cell"), "node", "comp", F.col("at.stray").alias("stray"))


def similar_in_cell(nodes: np.ndarray, comps: np.ndarray, stray: np.ndarray, sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Pairs of a stray and a row of another component whose sets are similar enough.

    Common shingles are counted for all pairs at once, as a product of membership matrices
    over the shingles that at least two rows have, some thousand shingles at a time.
    """
    sizes = np.array([len(s) for s in sets])
    values, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    number = np.cumsum(count > 1) - 1
    useful = count[place] > 1
    column_of, owner = number[place[useful]], owner[useful]
    a, b = np.flatnonzero(stray), np.flatnonzero(~stray)
    common = np.zeros((len(a), len(b)), np.float32)
    step, width = 4096, int((count > 1).sum())
    order = np.argsort(column_of, kind="stable")
    column_of, owner = column_of[order], owner[order]
    for first in range(0, width, step):
        lo, hi = np.searchsorted(column_of, [first, first + step])
        matrix = np.zeros((len(sets), min(step, width - first)), np.float32)
        matrix[owner[lo:hi], column_of[lo:hi] - first] = 1
        common += matrix[a] @ matrix[b].T
    union = sizes[a][:, None] + sizes[b][None, :] - common
    hit = (100 * common >= percent * union) & (comps[a][:, None] != comps[b][None, :])
    i, j = np.nonzero(hit)
    return np.stack([nodes[a[i]], nodes[b[j]]])


def confirmed_in_cells(cells: DataFrame, sets: DataFrame, params: Params) -> DataFrame:
    """Links ``a, b`` found in the cells; every set travels once per cell and not once per pair."""
    rows = cells.join(sets, "node").repartition("cell").sortWithinPartitions("cell")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(parts)
            lists = table.column("shingles").combine_chunks()
            values, ends = lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy(zero_copy_only=False).cumsum()
            get = lambda name: table.column(name).to_numpy()
            pairs = similar_in_cell(get("node"), get("comp"), get("stray"), np.split(values, ends[:-1]), params.similar_percent)
            return pa.RecordBatch.from_arrays([pa.array(pairs[0], pa.int64()), pa.array(pairs[1], pa.int64())], names=["a", "b"])

        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            cell = batch.column(batch.schema.get_field_index("cell")).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(cell)) + 1).tolist(), len(cell)]
            for lo, hi in zip(cuts, cuts[1:]):
                if hi == lo:
                    continue
                part = batch.slice(lo, hi - lo)
                if waiting and waiting[-1].column(batch.schema.get_field_index("cell"))[0].as_py() != int(cell[lo]):
                    yield links(waiting)
                    waiting = []
                waiting.append(part)
        if waiting:
            yield links(waiting)

    return rows.mapInArrow(found, "a bigint, b bigint")


def link(members: DataFrame, sets: DataFrame, params: Params) -> DataFrame | None:
    """``node, label`` of all nodes that have a link; ``members`` is ``key, node, n`` (rows of the bucket).

    First every row is compared with one centre of its bucket, the row that shares the most
    buckets with others: usually the text that copies derive from. Rows that are in one
    component by then need no comparison among themselves; what is left is compared
    completely, in pieces. No candidate is left out.
    """
    degrees = members.groupBy("node").agg(F.sum("n").alias("degree"))
    ranked = members.join(stored(degrees), "node").select("key", "node", "degree")
    centres = stored(ranked.groupBy("key").agg(F.max(F.struct("degree", "node")).alias("c")).select("key", F.col("c.node").alias("b")))
    pairs = members.select("key", F.col("node").alias("a")).join(centres, "key").filter("a != b").select("a", "b").distinct()
    found = stored(confirmed(pairs, sets, params))
    labels = components(found)
    rows = stored(relabelled(members.select("key", "node", F.col("node").alias("comp")), labels))
    more = stored(confirmed_in_cells(open_pieces(rows, params), sets, params).distinct())
    if more.isEmpty():
        return labels
    # both rounds' links between what is known to be connected
    return components(found.union(more).union(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).filter("a != b")))


def near_duplicates(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, class`` for every row of ``docs``."""
    signed = stored(signatures(docs, params))
    filled = signed.filter("n_shingles > 0 and doc_id is not null")
    classes = stored(filled.groupBy("class").agg(F.min("doc_id").alias("node"), F.first("keys").alias("keys")))
    banded = classes.select(F.explode("keys").alias("key"), "node")
    shared = stored(banded.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"))
    members = stored(banded.join(shared, "key"))
    wanted = members.select("node").distinct().join(classes.select("class", "node"), "node")
    sets = stored(full_sets(docs, wanted, params))
    labels = link(members, sets, params)

    # stored, so that both sides of the last join are plain exchanges, which Spark splits when skewed
    found = stored(relabelled(classes.select("class", F.col("node").alias("comp")), labels).withColumnRenamed("comp", "component_id"))
    rows = signed.select("doc_id", "n_shingles", "class")
    joined = rows.filter("n_shingles > 0").join(found, "class", "left").select(*rows.columns, "component_id")
    alone = rows.filter("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    result = joined.union(alone)
    component = F.when(F.col("doc_id").isNotNull(), F.col("component_id"))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return result.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"), "class")
