"""N-gram Jaccard join by R-trees over count vectors.

The set of a document holds its distinct four-word shingles (A-Z lower-cased), or its whole
word sequence where it has fewer words. Two documents are linked when their sets share 85% of
their union; a component is what links connect.

Shingles are hashed into groups, and a document is the point of its group counts. Two sets
have at most the sum of the coordinate minima in common, which rules a pair out without
looking at the sets, and a rectangle of points likewise by its upper corner.

Points of hundreds of coordinates are all far from each other, so one tree over all of them
would rule out nothing above its leaves. The directory therefore goes by parts of the
coordinates. Linked sets of sizes a and b differ in at most r = 15 (a + b) / 185 shingles. Cut
into more than r parts, their points agree in the others, whole coordinates taken. So
documents of a size class (one per power of two; near its upper end also the next) are dealt
to one entry per part, named by a fingerprint of the part's coordinates. As in any prefix
filter, the r + 1 entries of the least names suffice. Should a document have no more than r
parts that are not empty, it is dealt again by another grouping, and in the end to one entry
for all such documents: no link is lost. Entries are joined by their name.

Each entry has a centre, its least document, and every document is compared with its centres.
All entries of a centre make a unit. Documents of a unit that are in one component by then
need no comparison among themselves. The rest of each unit is compared completely, in cells
of bounded size: an R-tree over the cell's points, packed by splits of the widest
coordinate, finds the pairs that the bound leaves, and only those documents' sets are fetched
and intersected.

Edge cases. Null, empty and blank texts have an empty set and are linked with nothing. Equal
word sequences are one point. Rows without doc_id take part in nothing and have a null
component. Rows that share a doc_id count as one document, and each is reported. Other columns
are ignored. A very long text needs some tens of bytes of memory per word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logwarden.llm import neardup
from logwarden.llm.common import column, mix
from logwarden.llm.neardup import shingle_sets  # by name: a module in a task would bring all its imports
from logwarden.session import stored


@dataclass(frozen=True)
class Params:
    words: int = 4
    similar_percent: int = 85
    spare: int = 4  # parts beyond those that differences can touch
    groupings: int = 4
    fan_out: int = 16
    # Rows of a unit that are compared in one cell: memory of a task, no limit on units.
    piece: int = 256


def most_differences(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Size of the symmetric difference that two linked sets of these sizes can have."""
    return (100 - percent) * (a + b) // (100 + percent)


def least_common(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Number of common elements from which two sets of these sizes are linked."""
    return -(-percent * (a + b) // (100 + percent))


def size_class(sizes: np.ndarray) -> np.ndarray:
    """c for sizes from 2**(c - 1) to 2**c - 1."""
    return np.frexp(sizes)[1].astype(np.int64)


# --- count vectors --------------------------------------------------------------------


def log_groups(sizes: np.ndarray) -> np.ndarray:
    """Groups as a power of two: some three shingles per group, 16 groups at least."""
    return np.maximum(size_class(sizes) - 2, 4)


def count_vectors(sets: list[np.ndarray]) -> list[np.ndarray]:
    """How many elements of each set are in each group. Groups of half the number are neighbouring pairs."""
    sizes = np.array([len(s) for s in sets], np.int64)
    bits = log_groups(sizes)
    ends = np.cumsum(1 << bits)
    values = mix(np.concatenate(sets) + np.uint64(0x632BE59BD9B4E019))
    group = values >> np.repeat(64 - bits, sizes).astype(np.uint64)
    counts = np.bincount(np.repeat(ends - (1 << bits), sizes) + group.astype(np.int64), minlength=int(ends[-1]))
    return np.split(counts.astype("<u2"), ends[:-1])


def folded(vector: np.ndarray, groups: int) -> np.ndarray:
    return vector.reshape(groups, -1).sum(1, dtype=np.int32)


def may_link(a: np.ndarray, b: np.ndarray, size_a: int, size_b: int, percent: int) -> bool:
    """Whether the bound allows a link."""
    groups = min(len(a), len(b))
    return int(np.minimum(folded(a, groups), folded(b, groups)).sum()) >= least_common(size_a, size_b, percent)


# --- directory ------------------------------------------------------------------------


def entry_names(sets: list[np.ndarray], params: Params) -> list[np.ndarray]:
    """Names of the directory entries of each set. Any two linked sets have one in common."""
    percent = params.similar_percent
    own = np.array([len(s) for s in sets], np.int64)
    largest = 100 * own // percent  # partner
    classes = size_class(own)
    above = np.flatnonzero(largest >= 1 << classes)
    # one dealing per set and class that a partner can be in
    of_set = np.concatenate([np.arange(len(sets)), above])
    classes = np.concatenate([classes, classes[above] + 1])
    top = (1 << classes) - 1
    differ = most_differences(own[of_set], np.minimum(largest[of_set], top), percent)
    most = most_differences(top, top, percent)
    parts = most + 1 + params.spare + most // 50
    names: list[list[np.ndarray]] = [[] for _ in sets]
    due = np.arange(len(of_set))
    for grouping in range(params.groupings):
        if not len(due):
            break
        elements = [sets[of_set[d]] for d in due]
        if grouping:
            elements = [np.sort(mix(e + np.uint64(grouping * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))) for e in elements]
        number = np.repeat(np.arange(len(due)), own[of_set[due]])
        values = np.concatenate(elements)
        # sorted values fall into parts in order
        part = ((values >> np.uint64(32)) * parts[due].astype(np.uint64)[number] >> np.uint64(32)).astype(np.int64)
        opens = np.flatnonzero(np.append(True, (np.diff(number) > 0) | (np.diff(part) != 0)))
        content = np.add.reduceat(mix(values + np.uint64(0xA0761D6478BD642F)), opens)
        dealing, part = number[opens], part[opens]
        place = (classes[due][dealing] << 40) + (grouping << 36) + part
        name = mix(content ^ mix(place.astype(np.uint64)))
        order = np.lexsort((name, dealing))
        name, dealing = name[order], dealing[order]
        filled = np.bincount(dealing, minlength=len(due))
        rank = np.arange(len(name)) - np.repeat(np.cumsum(filled) - filled, filled)
        chosen = rank <= differ[due][dealing]
        name, dealing = name[chosen], dealing[chosen]
        for d, found in zip(due.tolist(), np.split(name, np.cumsum(np.bincount(dealing, minlength=len(due)))[:-1])):
            names[of_set[d]].append(found)
        due = due[filled <= differ[due]]
    for d in due.tolist():
        names[of_set[d]].append(mix(np.array([(int(classes[d]) << 40) + (1 << 39)], np.uint64)))
    return [np.concatenate(n) for n in names]


def points(docs: DataFrame, params: Params) -> DataFrame:
    """``doc_id, class, n_shingles, counts, names`` of each row; the last two are empty without words."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for first, sets, classes in shingle_sets(column(batch, "text"), params.words):
                full = [s for s in sets if len(s)]
                vectors, names = (iter(count_vectors(full)), iter(entry_names(full, params))) if full else (iter(()), iter(()))
                counts = [next(vectors).tobytes() if len(s) else b"" for s in sets]
                lists = [next(names) if len(s) else np.zeros(0, np.uint64) for s in sets]
                ends = np.cumsum([0] + [len(x) for x in lists]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, len(sets)),
                        pa.array(classes, pa.binary()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(counts, pa.binary()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(lists).view(np.int64))),
                    ],
                    names=["doc_id", "class", "n_shingles", "counts", "names"],
                )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(read, "doc_id bigint, class binary, n_shingles bigint, counts binary, names array<bigint>")


# --- trees ----------------------------------------------------------------------------


class RTree:
    """Points of count vectors under rectangles, of which only the upper corner and the sizes matter."""

    def __init__(self, vectors: np.ndarray, sizes: np.ndarray, fan_out: int):
        self.order, self.fan_out = self.packed(vectors, fan_out), fan_out
        corner, least, most = vectors[self.order], sizes[self.order], sizes[self.order]
        self.levels = [(corner, least, most)]
        while len(corner) > fan_out:
            cuts = np.arange(0, len(corner), fan_out)
            corner, least, most = np.maximum.reduceat(corner, cuts), np.minimum.reduceat(least, cuts), np.maximum.reduceat(most, cuts)
            self.levels.append((corner, least, most))

    @staticmethod
    def packed(vectors: np.ndarray, fan_out: int) -> np.ndarray:
        """An order in which neighbours are near: halves by the widest coordinate, again and again."""
        waiting, out = [np.arange(len(vectors))], []
        while waiting:
            part = waiting.pop()
            if len(part) <= fan_out:
                out.append(part)
                continue
            widest = int(vectors[part].var(0).argmax())
            part = part[np.argsort(vectors[part, widest], kind="stable")]
            half = -(-len(part) // (2 * fan_out)) * fan_out  # whole leaves on the left
            waiting += [part[half:], part[:half]]
        return np.concatenate(out)

    def search(self, vectors: np.ndarray, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of queries and points that the bound lets be linked."""
        query, node = (x.ravel() for x in np.meshgrid(np.arange(len(vectors)), np.arange(len(self.levels[-1][0])), indexing="ij"))
        for depth in range(len(self.levels) - 1, -1, -1):
            corner, least, most = self.levels[depth]
            fits = (100 * sizes[query] >= percent * least[node]) & (100 * most[node] >= percent * sizes[query])
            query, node = query[fits], node[fits]
            kept = [np.zeros(0, bool)]
            for start in range(0, len(query), 1 << 13):
                q, n = query[start : start + (1 << 13)], node[start : start + (1 << 13)]
                kept.append(np.minimum(vectors[q], corner[n]).sum(1) >= least_common(sizes[q], least[n], percent))
            kept = np.concatenate(kept)
            query, node = query[kept], node[kept]
            if depth:
                below = len(self.levels[depth - 1][0])
                child = node[:, None] * self.fan_out + np.arange(self.fan_out)
                query, node = np.repeat(query, self.fan_out), child.ravel()
                query, node = query[node < below], node[node < below]
        return query, self.order[node]


def candidates(vectors: list[np.ndarray], sizes: np.ndarray, comps: np.ndarray, stray: np.ndarray, params: Params) -> np.ndarray:
    """Flags of the rows of a cell that may be linked: a stray and another row, of different components."""
    groups = min(map(len, vectors))
    points_ = np.stack([folded(v, groups) for v in vectors])
    queries, others = np.flatnonzero(stray), np.flatnonzero(~stray)
    flags = np.zeros(len(vectors), bool)
    if len(queries) and len(others):
        tree = RTree(points_[others], sizes[others], params.fan_out)
        a, b = tree.search(points_[queries], sizes[queries], params.similar_percent)
        a, b = queries[a], others[b]
        apart = comps[a] != comps[b]
        flags[a[apart]] = flags[b[apart]] = True
    return flags


def in_cells(rows: DataFrame, of_cell: Callable[[pa.Table], np.ndarray]) -> DataFrame:
    """The rows that ``of_cell`` flags, given all rows of a cell. A cell has a bounded number of rows."""
    schema = rows.schema
    names = rows.columns

    def flagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []

        def done() -> Iterator[pa.RecordBatch]:
            if waiting:
                table = pa.Table.from_batches(waiting)
                yield from table.filter(pa.array(of_cell(table))).to_batches()
                waiting.clear()

        for batch in batches:
            cell = batch.column(names.index("cell")).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(cell)) + 1).tolist(), len(cell)]
            for lo, hi in zip(cuts, cuts[1:]):
                if hi > lo:
                    if waiting and waiting[0].column(names.index("cell"))[0].as_py() != int(cell[lo]):
                        yield from done()
                    waiting.append(batch.slice(lo, hi - lo))
        yield from done()

    return rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(flagged, schema)


# --- join -----------------------------------------------------------------------------


def bounded(pairs: DataFrame, placed: DataFrame, params: Params) -> DataFrame:
    """The pairs ``a, b`` that the bound lets be linked; ``placed`` has ``node, n_shingles, counts``."""
    side = lambda c: placed.select(F.col("node").alias(c), F.col("n_shingles").alias(f"n{c}"), F.col("counts").alias(f"v{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    fits = (100 * F.col("na") >= params.similar_percent * F.col("nb")) & (100 * F.col("nb") >= params.similar_percent * F.col("na"))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [[np.frombuffer(v, "<u2") for v in batch.column(i).to_pylist()] for i in (2, 3)]
            sizes = [batch.column(i).to_pylist() for i in (4, 5)]
            flags = [may_link(*row, params.similar_percent) for row in zip(*vectors, *sizes)]
            yield batch.select([0, 1]).filter(pa.array(flags, pa.bool_()))

    return both.filter(fits).select("a", "b", "va", "vb", "na", "nb").mapInArrow(kept, "a bigint, b bigint")


def confirmed(pairs: DataFrame, sets: DataFrame, params: Params) -> DataFrame:
    """The pairs ``a, b`` that are linked, by their full sets."""
    side = lambda c: sets.select(F.col("node").alias(c), F.col("shingles").alias(f"s{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    counted = both.select("a", "b", common.alias("n"), (F.size("sa") + F.size("sb")).alias("m"))
    return counted.filter((100 + params.similar_percent) * F.col("n") >= params.similar_percent * F.col("m")).select("a", "b")


def left_in_units(pairs: DataFrame, labels: DataFrame, placed: DataFrame, params: Params) -> DataFrame:
    """Rows of cells (``cell, node, comp, stray``) that may have a link which the centres did not show."""
    members = stored(neardup.relabelled(pairs.select(F.col("b").alias("key"), F.col("a").alias("node"), F.col("a").alias("comp")), labels))
    cells = neardup.open_pieces(members, neardup.Params(piece=params.piece))
    rows = cells.join(placed.select("node", "n_shingles", "counts"), "node").select("cell", "node", "comp", "stray", "n_shingles", "counts")

    def of_cell(table: pa.Table) -> np.ndarray:
        vectors = [np.frombuffer(v, "<u2") for v in table.column("counts").to_pylist()]
        get = lambda name: table.column(name).to_numpy()
        return candidates(vectors, get("n_shingles"), get("comp"), get("stray"), params)

    return in_cells(rows, of_cell).select("cell", "node", "comp", "stray")


def links_of(docs: DataFrame, classes: DataFrame, params: Params) -> DataFrame:
    """``node, label`` of all nodes that have a link."""
    named = classes.select(F.explode("names").alias("name"), "node")
    entries = named.groupBy("name").agg(F.min("node").alias("centre"), F.count("*").alias("n"))
    entries = stored(entries.filter("n > 1").select("name", "centre"))
    pairs = stored(named.join(entries, "name").filter("node != centre").select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct())
    placed = classes.select("node", "n_shingles", "counts")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(classes.select("class", "node"), "node")
    sets = stored(neardup.full_sets(docs, wanted, neardup.Params(words=params.words)))
    near = stored(bounded(pairs, placed, params))
    found = stored(confirmed(near, sets, params))
    labels = neardup.components(found)
    cells = stored(left_in_units(pairs, labels, placed, params))
    more = stored(neardup.confirmed_in_cells(cells, sets, neardup.Params(similar_percent=params.similar_percent)).distinct())
    if more.isEmpty():
        return labels
    known = labels.select(F.col("node").alias("a"), F.col("label").alias("b")).filter("a != b")
    return neardup.components(known.union(more))


def joined(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """``doc_id, n_shingles, component_id, class`` for every row of ``docs``."""
    read = stored(points(docs, params))
    filled = read.filter("n_shingles > 0 and doc_id is not null")
    rest = [F.first(c).alias(c) for c in ("n_shingles", "counts", "names")]
    classes = stored(filled.groupBy("class").agg(F.min("doc_id").alias("node"), *rest))
    labels = links_of(docs, classes, params)
    found = stored(neardup.relabelled(classes.select("class", F.col("node").alias("comp")), labels).withColumnRenamed("comp", "component_id"))
    rows = read.select("doc_id", "n_shingles", "class")
    linked = rows.filter("n_shingles > 0").join(found, "class", "left").select(*rows.columns, "component_id")
    result = linked.union(rows.filter("n_shingles = 0").withColumn("component_id", F.col("doc_id")))
    return result.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"), "class")
