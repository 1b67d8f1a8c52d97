"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Entries become integers, so that sums and deviations are exact. The fit list holds each
distinct integer vector once; it is stored in blocks of packed integers. The components are
the leading eigenvectors of its covariance matrix, which is never formed: a pass over the
blocks multiplies the centred vectors and their transpose with a thin matrix, tasks add up
what they find, and a shuffle adds up the tasks.

A round filters a block of candidate vectors by a Chebyshev polynomial of the covariance,
one pass per degree. The polynomial is small on the unwanted part of the spectrum, from
below the least eigenvalue (bounded by some Lanczos steps, which share their passes with
plain subspace iteration) to the least Ritz value of the block, and grows fast above it.
Then come QR and a Rayleigh-Ritz projection. Vectors whose residual certifies them (against
the gap to their neighbours, or at the level of rounding) are locked, and what follows is
kept orthogonal to them. The degree is limited so that the growth of the leading vectors
does not drown the others. The driver holds matrices of the vectors' length times three
times the number of components, and nothing that grows with the number of rows.

Edge cases. Rows whose vector is null, empty, or holds null or non-finite entries (or entries
of 2**56 and more, which have no such integer) are left out. So are vectors of another
length than the commonest one (of equally common ones the greatest). A table without rows
left gives no rows. Components without variance, up to rounding, do not exist: their number
is at most the rank of the covariance. A deviation beyond 64 bits is null. Repeated rows are
whitened each and count once in the fit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logwarden.llm.common import free_name
from logwarden.session import stored

_BASE = 1_000_000
_EPS = float(np.finfo(float).eps)


@dataclass(frozen=True)
class Params:
    components: int = 16
    scale: float = 64.0
    width: int = 3  # candidate vectors per component
    lanczos: int = 8
    degree: int = 12
    growth: float = 1e10  # of the leading candidate against the least one, in one round
    rounds: int = 200
    certified: float = 1e-11  # residual against the gap between eigenvalues: angle to the true vector
    block_rows: int = 4096
    seed: int = 11


@dataclass(frozen=True)
class Whitening:
    """What ``fit`` found. ``shift + rest / n`` are the means of the integers above the base."""

    n: int
    shift: np.ndarray  # whole part of the means
    rest: np.ndarray  # sums beyond n times the shift, 0 to n - 1
    vectors: np.ndarray  # components as columns
    values: np.ndarray  # their eigenvalues, falling
    trace: float
    identity_error: float
    passes: int

    def centred(self, offsets: np.ndarray) -> np.ndarray:
        return centred(offsets, self.shift, self.rest / self.n)


def centred(offsets: np.ndarray, shift: np.ndarray, fraction: np.ndarray) -> np.ndarray:
    """Vectors less their means; whole numbers are subtracted as such, so small differences stay exact."""
    return (offsets - shift).astype(np.float64) - fraction


def integers(vector: Column, params: Params) -> Column:
    """The integers of a vector, null for vectors that are left out."""
    entry = lambda c: c.cast("double")
    # a comparison with NaN, infinity or null fails or is null
    fits = F.forall(vector, lambda c: F.coalesce(F.abs(entry(c)) < float(1 << 56), F.lit(False)))
    whole = F.transform(vector, lambda c: F.floor(entry(c) * params.scale).cast("bigint") + _BASE)
    return F.when((F.size(vector) > 0) & fits, whole)


def usable(rows: DataFrame, vector: str, name: str, params: Params) -> DataFrame:
    """``rows`` with the integers as ``name``, without the rows that are left out."""
    found = rows.withColumn(name, integers(F.col(vector), params)).filter(F.col(name).isNotNull())
    lengths = found.groupBy(F.size(name).alias("length")).agg(F.count("*").alias("n"))
    common = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    return found.filter(F.size(name) == (common["length"] if common else 0))


def matrix(lists: pa.Array) -> np.ndarray:
    """Integer vectors of one length, less the base."""
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1) - _BASE


def packed_blocks(vectors: DataFrame, params: Params) -> DataFrame:
    """``rows, kind, data, sums``: vectors less the base in the narrowest integers, and their sums."""

    def block(parts: list[np.ndarray]) -> pa.RecordBatch:
        offsets = np.concatenate(parts)
        least, most = int(offsets.min()), int(offsets.max())
        kind = next(k for k in ("<i2", "<i4", "<i8") if np.iinfo(k).min <= least and most <= np.iinfo(k).max)
        big = max(-least, most) >= 1 << 40
        sums = [int(sum(map(int, c))) for c in offsets.T] if big else offsets.sum(0).tolist()
        return pa.RecordBatch.from_arrays(
            [pa.array([len(offsets)], pa.int64()), pa.array([kind]), pa.array([offsets.astype(kind).tobytes()], pa.binary()), pa.array([list(map(str, sums))])],
            names=["rows", "kind", "data", "sums"],
        )

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, params.block_rows):
                part = matrix(batch.column(0).slice(start, params.block_rows))
                waiting.append(part)
                held += len(part)
                if held >= params.block_rows:
                    yield block(waiting)
                    waiting, held = [], 0
        if waiting:
            yield block(waiting)

    return vectors.mapInArrow(blocks, "rows bigint, kind string, data binary, sums array<string>")


class Passes:
    """Sums over the centred vectors of the fit list; every call is one pass over the blocks."""

    def __init__(self, blocks: DataFrame, n: int, shift: np.ndarray, rest: np.ndarray):
        self.blocks, self.n, self.shift, self.fraction, self.count = blocks, n, shift, rest / n, 0

    def total(self, of_block: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum of ``of_block`` (an array for a matrix of centred vectors) over all blocks."""
        shift, fraction = self.shift, self.fraction

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = None
            for batch in batches:
                for kind, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                    offsets = np.frombuffer(data.as_buffer(), kind).reshape(-1, len(shift))
                    part = of_block(centred(offsets.astype(np.int64), shift, fraction)).ravel()
                    found = part if found is None else found + part
            if found is not None:
                yield pa.RecordBatch.from_arrays([pa.array([found], pa.list_(pa.float64()))], names=["part"])

        self.count += 1
        parts = self.blocks.select("kind", "data").mapInArrow(partial, "part array<double>")
        sums = parts.select(F.posexplode("part").alias("place", "value")).groupBy("place").agg(F.sum("value").alias("value"))
        table = sums.toArrow()  # as many rows as the array has entries
        out = np.zeros(table.num_rows)
        out[table.column("place").to_numpy()] = table.column("value").to_numpy()
        return out

    def times(self, thin: np.ndarray) -> np.ndarray:
        """The covariance matrix times a thin matrix."""
        return self.total(lambda x: x.T @ (x @ thin)).reshape(thin.shape) / self.n

    def trace(self) -> float:
        return float(self.total(lambda x: np.array([np.einsum("ij,ij->", x, x)]))[0]) / self.n

    def second_moment(self, projection: np.ndarray) -> np.ndarray:
        """Covariance of the projected vectors, whose mean is 0."""
        k = projection.shape[1]
        return self.total(lambda x: (y := x @ projection).T @ y).reshape(k, k) / self.n


def orthonormal(thin: np.ndarray, against: np.ndarray) -> np.ndarray:
    """A basis of the columns, orthogonal to ``against``; twice is enough."""
    for _ in range(2):
        thin = np.linalg.qr(thin - against @ (against.T @ thin))[0]
    return thin


def warmed_up(passes: Passes, block: np.ndarray, start: np.ndarray, steps: int) -> tuple[np.ndarray, float]:
    """The block after subspace iteration, and a bound below the spectrum by Lanczos steps of ``start``."""
    basis, alphas, betas = [start / np.linalg.norm(start)], [], []
    for _ in range(steps):
        product = passes.times(np.column_stack([block, basis[-1]]))
        block = np.linalg.qr(product[:, :-1])[0]
        alphas.append(float(basis[-1] @ product[:, -1]))
        known = np.array(basis).T
        follow = product[:, -1]
        for _ in range(2):
            follow = follow - known @ (known.T @ follow)
        betas.append(float(np.linalg.norm(follow)))
        if betas[-1] <= 1e-12 * max(alphas):
            break
        basis.append(follow / betas[-1])
    off = betas[: len(alphas) - 1]
    ritz = np.linalg.eigvalsh(np.diag(alphas) + np.diag(off, 1) + np.diag(off, -1))
    return block, max(0.0, float(ritz[0]) - betas[-1])


def chebyshev(times: Callable[[np.ndarray], np.ndarray], block: np.ndarray, degree: int, low: float, high: float, top: float) -> np.ndarray:
    """A polynomial of the matrix on the block: small for eigenvalues from low to high, 1 at ``top``."""
    half, middle = (high - low) / 2, (high + low) / 2
    first = scale = half / (top - middle)
    before, now = block, (times(block) - middle * block) * scale / half
    for _ in range(2, degree + 1):
        following = 1 / (2 / first - scale)
        before, now = now, 2 * following / half * (times(now) - middle * now) - scale * following * before
        scale = following
    return now


def leading(passes: Passes, dimension: int, params: Params) -> tuple[np.ndarray, np.ndarray]:
    """Leading eigenvectors and eigenvalues of the covariance, falling, without those of no variance."""
    wanted, width = min(params.components, dimension), min(dimension, params.components * params.width)
    random = np.random.default_rng(params.seed)
    block = np.linalg.qr(random.standard_normal((dimension, width)))[0]
    low = 0.0
    if width < dimension:
        block, low = warmed_up(passes, block, random.standard_normal(dimension), min(params.lanczos, dimension - 1))
    locked, values, last = np.zeros((dimension, 0)), [], np.inf
    for _ in range(params.rounds):
        times = lambda y: (z := passes.times(y)) - locked @ (locked.T @ z)  # noqa: E731, B023
        product = times(block)
        small = block.T @ product
        ritz, turn = np.linalg.eigh((small + small.T) / 2)
        ritz, turn = ritz[::-1], turn[:, ::-1]
        block, product = block @ turn, product @ turn
        residual = np.linalg.norm(product - block * ritz, axis=0)
        greatest = max([*values, ritz[0]])
        if greatest <= 0:
            return locked[:, :0], np.zeros(0)
        need = wanted - len(values)
        gaps = np.abs(np.diff(ritz, prepend=np.inf, append=-np.inf))
        gaps = np.minimum(gaps[1:], gaps[:-1])
        worst = residual[:need].max()
        # nothing is gained any more, and what is left is rounding
        settled = width == dimension or (worst > last / 2 and worst <= 1e-12 * greatest)
        good = residual <= np.maximum(params.certified * gaps, 4 * _EPS * greatest)
        new = need if settled else int(np.append(good[:need], False).argmin())
        last = np.inf if new else worst
        locked = np.column_stack([locked, block[:, :new]])
        values += ritz[:new].tolist()
        if len(values) == wanted:
            break
        block, ritz = block[:, new:], ritz[new:]
        high, top = float(ritz[-1]), float(ritz[0])
        if top <= 1e-13 * greatest:
            break  # only rounding is left
        if high - low <= 1e-12 * greatest or top - high <= 1e-12 * greatest:
            block = orthonormal(times(block), locked)  # no interval to damp: plain subspace iteration
            continue
        ratio = np.arccosh((top - (high + low) / 2) / ((high - low) / 2))
        degree = int(np.clip(np.log(2 * params.growth) / ratio, 2, params.degree))
        block = orthonormal(chebyshev(times, block, degree, low, high, top), locked)
    else:
        raise RuntimeError(f"{wanted - len(values)} components are not certified after {params.rounds} rounds")
    order = np.argsort(values)[::-1]
    order = [i for i in order if values[i] > 1e-12 * greatest]
    return locked[:, order], np.array(values)[order]


def fit(vectors: DataFrame, name: str, params: Params = Params()) -> Whitening | None:
    """The whitening of the distinct integer vectors in column ``name``; None without any."""
    blocks = stored(packed_blocks(vectors.select(name).distinct(), params))
    n = blocks.agg(F.sum("rows")).first()[0] or 0
    if not n:
        return None
    by_place = blocks.select(F.posexplode("sums").alias("place", "sum")).groupBy("place")
    sums = by_place.agg(F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum")).collect()
    totals = [int(r["sum"]) for r in sorted(sums, key=lambda r: r["place"])]
    shift = np.array([t // n for t in totals], np.int64)
    rest = np.array([t % n for t in totals], np.int64)
    passes = Passes(blocks, n, shift, rest)
    trace = passes.trace()
    vectors_, values = leading(passes, len(totals), params) if trace > 0 else (np.zeros((len(totals), 0)), np.zeros(0))
    error = 0.0
    if len(values):
        moment = passes.second_moment(vectors_ / np.sqrt(values))
        error = float(np.abs(moment - np.eye(len(values))).max())
    return Whitening(n, shift, rest, vectors_, values, trace, error, passes.count)


def deviations(offsets: np.ndarray, model: Whitening) -> list[int | None]:
    """Sum over dimensions of (n x - S)**2 of each vector, exactly; None beyond 64 bits."""
    distance = offsets - model.shift
    rough = ((distance.astype(float) * model.n - model.rest) ** 2).sum(1)
    out: list[int | None] = [None] * len(offsets)
    safe = np.flatnonzero(rough < 2.0**62)
    exact = distance[safe] * model.n - model.rest
    for i, value in zip(safe.tolist(), (exact * exact).sum(1).tolist()):
        out[i] = value
    for i in np.flatnonzero((rough >= 2.0**62) & (rough < 2.0**64)).tolist():
        value = sum((model.n * int(d) - int(r)) ** 2 for d, r in zip(distance[i], model.rest))
        out[i] = value if value < 1 << 63 else None
    return out


def whitened(rows: DataFrame, vector: str = "embedding", params: Params = Params()) -> tuple[DataFrame, Whitening | None]:
    """The usable rows with ``deviation`` and ``whitened`` (one entry per component), and the fit.

    Columns of these names are replaced.
    """
    kept = rows.drop("deviation", "whitened")
    given = free_name(kept, "integers")
    found = usable(kept, vector, given, params)
    model = fit(found, given, params)
    added = T.StructType.fromDDL("deviation bigint, whitened array<double>")
    schema = T.StructType([*kept.schema.fields, *added.fields])
    if model is None:
        return kept.limit(0).select("*", F.lit(None).cast("bigint").alias("deviation"), F.lit(None).cast("array<double>").alias("whitened")), None
    projection = model.vectors / np.sqrt(model.values)

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets = matrix(batch.column(batch.num_columns - 1))
            values = model.centred(offsets) @ projection
            ends = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
            new = [pa.array(deviations(offsets, model), pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *new], names=[*batch.schema.names[:-1], "deviation", "whitened"])

    return found.mapInArrow(projected, schema), model
