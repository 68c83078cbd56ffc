"""Chebyshev-filtered iteration against a dense eigen-decomposition."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from regmine.llm import whitening
from regmine.llm.queries import op11_whitening


def table(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows],
                                 "vec_id long, embedding array<double>, x string, n int").repartition(parts)


def brute(rows, k=4):
    """{(vec_id, component): (n, deviation, whitened or its negative, explained)} per length."""
    good = [(i, tuple(math.floor(256 * c) for c in v)) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for d in {len(x) for _, x in good}:
        fit = sorted({x for _, x in good if len(x) == d})
        n, sums = len(fit), [sum(c) for c in zip(*fit)]
        xc = np.array(fit, float) - np.array(sums) / n
        values, vecs = np.linalg.eigh(xc.T @ xc / n)
        values, vecs = values[::-1][:k], vecs[:, ::-1][:, :k]
        for i, x in good:
            if len(x) == d:
                dev = sum((n * a - s) ** 2 for a, s in zip(x, sums))
                for c in range(len(values)):
                    if values[c] > 1e-9:
                        w = (np.array(x, float) - np.array(sums) / n) @ vecs[:, c] / math.sqrt(values[c])
                        out.append((i, c + 1, n, dev, w, values[c] / (xc ** 2).sum() * n))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[3]))


def check(got, want, tol=1e-8):
    got = sorted(map(tuple, got), key=lambda r: (r[0] is None, r[0] or 0, r[1], r[3]))
    assert [r[:4] for r in got] == [r[:4] for r in want]
    sign = {}
    for g, w in zip(got, want):
        if abs(w[4]) > 1e-3:
            sign.setdefault((g[1], g[2]), math.copysign(1, g[4] * w[4]))
        assert abs(g[4] * sign.get((g[1], g[2]), 1) - w[4]) < tol and abs(g[5] - w[5]) < 1e-9
        assert g[6] < 1e-8


@pytest.mark.parametrize("direct", [32, 1])
def test_equals_dense_decomposition(spark, monkeypatch, direct):
    monkeypatch.setattr(whitening, "DIRECT", direct)
    rng = np.random.default_rng(3)
    x = rng.standard_normal((300, 40)) * np.linspace(1, 0.3, 40)
    rows = [(i, list(map(float, v))) for i, v in enumerate(x)]
    rows += [(1000 + i, [0.25] * 40) for i in range(200)]                  # a hot vector counts once
    rows += [(7, rows[7][1]), (None, [0.5] * 40), (8, None), (9, [float("nan")] * 40),
             (10, [float("inf")] + [0.0] * 39), (11, [None] + [0.0] * 39), (12, [])]
    check(whitening.whiten(table(spark, rows)).collect(), brute(rows))


def test_lengths_ranks_and_empty(spark):
    rows = [(1, [1.0, 2.0]), (2, [2.0, -1.0]), (3, [0.5, 0.25]), (4, [3.0]), (5, [5.0]), (6, [5.0]),
            (7, [1.0, 1.0, 1.0]), (8, [1.0, 1.0, 1.0])]                    # the last length does not vary
    got = whitening.whiten(table(spark, rows)).collect()
    check(got, brute(rows))
    assert {r.vec_id for r in got} == {1, 2, 3, 4, 5, 6}
    assert whitening.whiten(table(spark, [])).collect() == []
    line = [(i, [i / 256, 2 * i / 256, 0.0, 0.0, 0.0]) for i in range(20)]  # rank one
    assert {r.component for r in whitening.whiten(table(spark, line)).collect()} == {1}


def test_large_values(spark):
    rows = [(1, [1e12, 0.0]), (2, [-1e12, 1.0]), (3, [1e300, 2.0])]
    got = whitening.whiten(table(spark, rows)).collect()
    assert {r.vec_id for r in got} == {1, 2, 3} and all(r.deviation is None for r in got)


class Dense:
    def __init__(self, v):
        self.v, self.d, self.passes = v, len(v), 0

    def times(self, q):
        self.passes += 1
        return self.v @ q


@pytest.mark.parametrize("spectrum", [
    np.linspace(2, 1, 64), np.r_[[5.0, 5.0, 5.0, 5.0, 4.999999], np.ones(95)], np.ones(50),
    np.r_[1e6, 10, 9.9, 9.8, np.linspace(9, 1, 96)], np.r_[np.ones(40), np.zeros(60)], np.zeros(30),
    1.0 / np.arange(1, 121) ** 2, 1 + 1e-7 * np.arange(80)])
def test_spectra(spectrum):
    rng = np.random.default_rng(1)
    basis = np.linalg.qr(rng.standard_normal((len(spectrum), len(spectrum))))[0]
    want = np.sort(spectrum)[::-1][:4]
    dense = Dense((basis * spectrum) @ basis.T)
    comps, values, rounds = whitening.leading_components(dense, 4)
    assert np.allclose(values, want, rtol=1e-10, atol=1e-12)
    assert np.allclose(dense.v @ comps, comps * values, atol=2e-11 * max(want[0], 1e-3))
    assert np.allclose(comps.T @ comps, np.eye(4), atol=1e-12)


def test_filter_damps_the_unwanted_interval():
    d = np.linspace(0, 3, 31)
    dense = Dense(np.diag(d))
    got = np.diag(whitening._filtered(dense, np.eye(31), dense.v, 2.0, 3.0, 8))
    assert abs(got[-1] - 1) < 1e-9 and np.abs(got[d <= 2]).max() < 1e-3


def test_query_on_tables(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check(op11_whitening(spark, sf).collect(), brute(rows), tol=1e-7)
