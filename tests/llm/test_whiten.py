"""Whitening against a dense eigenvalue decomposition in numpy and exact integers in Python."""

import math

import numpy as np
import pytest

from logwarden.llm import queries, whiten

NAN, INF = float("nan"), float("inf")


def truth(vectors):
    """Remaining integer vectors by row, fit list, and the decomposition of its covariance."""
    kept = {i: [math.floor(64 * c) + 1_000_000 for c in v] for i, v in vectors if v and all(c is not None and math.isfinite(c) for c in v)}
    fit = sorted({tuple(x) for x in kept.values()})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    x = np.array(fit, float) - np.array(sums) / n
    values, parts = np.linalg.eigh(x.T @ x / n)
    return kept, n, sums, values[::-1], parts[:, ::-1]


def clustered(rows=600, size=40, seed=1, spread=(30, 12, 9, 5)):
    rng = np.random.default_rng(seed)
    strong = rng.standard_normal((len(spread), size)) * np.array(spread)[:, None]
    points = rng.standard_normal((rows, size)) + rng.standard_normal((rows, len(spread))) @ strong
    return [(i, [float(np.float32(c)) for c in p / 8]) for i, p in enumerate(points)]


def check(got, vectors, components):
    kept, n, sums, values, parts = truth(vectors)
    assert len(got) == len(kept) * components
    signs = {}
    for r in got:
        x, j = kept[r.vec_id], r.component - 1
        assert r.n == n and r.deviation == sum((n * a - s) ** 2 for a, s in zip(x, sums))
        want = (np.array(x) - np.array(sums) / n) @ parts[:, j] / np.sqrt(values[j])
        if abs(want) > 1e-3:
            signs.setdefault(j, np.sign(want * r.whitened))
        assert r.whitened == pytest.approx(signs.get(j, 1) * want, abs=1e-8)
        assert r.explained == pytest.approx(values[j] / values.sum(), rel=1e-9)
        assert r.identity_error < 1e-9


def asked(spark, vectors, tmp_path):
    rows = [(*v, "x", 1, [0.0]) for v in vectors]
    schema = "vec_id bigint, embedding array<float>, deviation string, component int, whitened array<double>"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    return queries.QUERIES["op11_whitening"](spark, str(tmp_path)).collect()


def test_awkward_rows(spark, tmp_path):
    vectors = clustered()
    copies = [(1000 + i, vectors[7][1]) for i in range(200)]
    odd = [(2000, None), (2001, [NAN] * 40), (2002, [INF] + [0.0] * 39), (2003, [None] + [0.0] * 39), (2004, [])]
    odd += [(2005, [1.0, 2.0]), (2006, [1e30] * 40)]  # another length; no such integers
    got = asked(spark, vectors + copies + odd, tmp_path)
    check(got, vectors + copies, 16)


def test_few_dimensions_need_no_filter(spark, tmp_path):
    vectors = [(i, [float(i % 7), float(i % 5) / 3, float(i % 11) * 2]) for i in range(200)]
    check(asked(spark, vectors, tmp_path), vectors, 3)


def test_components_without_variance_do_not_exist(spark, tmp_path):
    rng = np.random.default_rng(3)
    flat = rng.integers(-9, 9, (300, 2)) @ rng.integers(-3, 3, (2, 60))
    vectors = [(i, [float(c) for c in v]) for i, v in enumerate(flat)]
    check(asked(spark, vectors, tmp_path), vectors, 2)


@pytest.mark.parametrize("vectors", [[], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_nothing_to_whiten(spark, tmp_path, vectors):
    assert asked(spark, vectors, tmp_path) == []


def test_a_dominant_component_does_not_drown_the_others(spark):
    rng = np.random.default_rng(5)
    scales = np.concatenate([[50_000.0, 3000.0], 20 - 0.05 * np.arange(98)])
    turn = np.linalg.qr(rng.standard_normal((100, 100)))[0]
    points = np.floor((rng.standard_normal((3000, 100)) * scales) @ turn)
    rows = spark.createDataFrame([(i, [float(c) for c in p]) for i, p in enumerate(points)], "id int, v array<double>")
    params = whiten.Params(scale=1.0)
    found = whiten.fit(whiten.usable(rows, "v", "x", params), "x", params)
    centred = points - points.mean(0)
    values, parts = np.linalg.eigh(centred.T @ centred / len(points))
    assert found.values == pytest.approx(values[::-1][:16], rel=1e-9)
    assert np.abs((found.vectors * parts[:, ::-1][:, :16]).sum(0)) == pytest.approx(np.ones(16), abs=1e-9)
    assert found.identity_error < 1e-6 and found.passes < 120


def test_deviations_are_exact():
    n = 3_000_000_000
    model = whiten.Whitening(n, np.array([2, -5]), np.array([7, n - 1]), np.zeros((2, 0)), np.zeros(0), 1.0, 0.0, 0)
    offsets = np.array([[2, -5], [3, -5], [40, 9], [10**9, 0]])
    want = [sum((n * int(o) - n * int(s) - int(r)) ** 2 for o, s, r in zip(row, model.shift, model.rest)) for row in offsets]
    assert whiten.deviations(offsets, model) == [w if w < 2**63 else None for w in want] and want[0] < 2**63 < want[1]


def test_chebyshev_damps_the_interval():
    values = np.array([0.5, 1.0, 1.5, 2.0, 2.2, 3.0])
    out = whiten.chebyshev(lambda y: values[:, None] * y, np.ones((6, 1)), 9, 0.4, 2.0, 3.0)[:, 0]
    assert out[-1] == pytest.approx(1) and np.abs(out[:4]).max() < 1e-4 < out[4]
