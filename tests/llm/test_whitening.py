"""Whitening against numpy's dense solver and exact integers; the solver on hard spectra."""

import math

import numpy as np
import pytest

from matchspark.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x string, component string, n string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "a", "b", "c") for i, v in rows], SCHEMA).repartition(3)


def brute(rows):
    """By (id, vector): n, exact deviation, eigenvalues and |whitened|, from all distinct vectors."""
    keep = [(i, tuple(math.floor(256 * float(np.float32(c))) for c in v)) for i, v in rows
            if v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({x for _, x in keep})
    n, s = len(fit), [sum(col) for col in zip(*fit)]
    centred = np.array(fit, float) - np.array(s) / n
    e, w = np.linalg.eigh(centred.T @ centred / n)
    e, w = e[::-1][:4], w[:, ::-1][:, :4]
    out = []
    for i, x in keep:
        dev = sum((n * a - b) ** 2 for a, b in zip(x, s))
        out.append((i, x, n, dev, np.abs((np.array(x) - np.array(s) / n) @ w / np.sqrt(e))))
    return out, e / (centred ** 2).sum() * n


def test_against_dense_solver(spark):
    rng = np.random.default_rng(3)
    base = (rng.standard_normal((300, 12)) * np.linspace(1, 3, 12)).astype(np.float32)
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(base)]
    rows += [(1000 + k, rows[5][1]) for k in range(200)]                       # a hot vector is fitted once
    rows += [(None, rows[6][1]), (7, rows[7][1]), (7, rows[8][1])]             # null and repeated ids
    bad = [(2000, None), (2001, [1.0, None] + [0.0] * 10), (2002, [math.nan] * 12), (2003, [math.inf] + [0.0] * 11),
           (2004, []), (2005, [1.0, 2.0])]
    got = whitening.whiten(frame(spark, rows + bad)).collect()
    want, explained = brute(rows)
    assert len(got) == 4 * len(want)
    seen = sorted((r.vec_id or -1, r.component, r.n, r.deviation, abs(r.whitened)) for r in got)
    for g, w in zip(seen, sorted((i or -1, c + 1, n, d, float(v[c])) for i, x, n, d, v in want for c in range(4))):
        assert g[:4] == w[:4] and abs(g[4] - w[4]) < 1e-9
    by = {r.component: r.explained for r in got}
    assert np.allclose([by[c] for c in (1, 2, 3, 4)], explained, rtol=1e-12)
    assert {r.identity_error for r in got}.pop() < 1e-10
    # one sign for all rows: whitened values of distinct rows have mean 0
    one = {(r.deviation, round(r.whitened, 9)) for r in got if r.component == 1}
    assert abs(sum(v for _, v in one)) < 1e-6


@pytest.mark.parametrize("values", [
    [5, 5, 5, 5, 5, 5, 1, 1], [9, 9, 1, 1, 1, 1, 1, 1, 1], [1e8, 1e3, 1, 1e-2, 1e-4, 1e-5], [1, 1 - 1e-9, 1 - 2e-9, 1 - 3e-9, 1 - 4e-9, .1],
    [3, 2], [7, 0, 0, 0, 0], list(np.linspace(1, 2, 80)), list(1.0 + 1e-5 * np.arange(60)), [2.0] * 40])
def test_hard_spectra(values):
    rng = np.random.default_rng(len(values))
    turn, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
    matrix = turn @ np.diag(values) @ turn.T
    matrix = (matrix + matrix.T) / 2
    want = sorted([v for v in values if v > 0], reverse=True)[:4]
    e, v = whitening.top_components(matrix)
    assert np.allclose(e, want, rtol=1e-11, atol=1e-14 * max(values))
    assert np.abs(matrix @ v - v * e).max() < 1e-12 * max(values)
    assert np.allclose(v.T @ v, np.eye(len(e)), atol=1e-12)


def test_inertia_counts():
    rng = np.random.default_rng(1)
    for d in (1, 2, 3, 10, 40):
        a = rng.standard_normal((d, d))
        a = a + a.T
        e = np.linalg.eigvalsh(a)
        for shift in [*(e[:-1] + e[1:]) / 2, e[0] - 1, e[-1] + 1]:
            assert whitening.inertia(a, shift) == (e > shift).sum()
    assert whitening.inertia(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1


def test_degenerate_tables(spark):
    assert whitening.whiten(frame(spark, [(1, None)])).count() == 0
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0   # no variance
    got = whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [3.0, 2.0])])).collect()       # rank 1
    assert sorted((r.vec_id, r.component, r.deviation) for r in got) == [(1, 1, 512 ** 2), (2, 1, 512 ** 2)]
    assert {abs(round(r.whitened, 9)) for r in got} == {1.0} and {r.explained for r in got} == {1.0}
    assert {r.n for r in got} == {2}
    huge = whitening.whiten(frame(spark, [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.5, 2.0])])).collect()
    assert {r.vec_id for r in huge} == {1, 2, 3} and any(r.deviation is None for r in huge)
