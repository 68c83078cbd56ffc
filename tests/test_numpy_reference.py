"""Statistics against direct NumPy computations on the same values."""

import numpy as np
from pyspark.sql import functions as F

from regmine.operators import stats as G

VALUES = [3, 5, 5, 8, 13, 21, 21, 21, 34, 40, 41, 55, 60, 61, 62, 80, 89, 95, 100, 110]


def frame(spark):
    return spark.createDataFrame([(float(v),) for v in VALUES], "x double")


def test_kde_matches_numpy(spark):
    x = np.array(VALUES, dtype=float)
    n, sd = len(x), x.std(ddof=1)
    bw = sd * n ** (-0.2)
    grid = np.linspace(x.min() - 3 * bw, x.max() + 3 * bw, 200)
    dens = np.exp(-0.5 * ((grid[:, None] - x[None, :]) / bw) ** 2).sum(axis=1) / (n * bw * np.sqrt(2 * np.pi))
    got = {r.point: (r.x, r.density) for r in G.kde(frame(spark), "x").collect()}
    for i in (0, 57, 123, 199):
        assert abs(got[i][0] - round(grid[i], 6)) < 1e-6
        assert abs(got[i][1] - round(dens[i], 6)) < 1e-6


def test_histogram_matches_numpy(spark):
    counts, edges = np.histogram(np.array(VALUES, dtype=float), bins=10)
    got = {r.bin: r["count"] for r in G.histogram(frame(spark), "x", bins=10).collect()}
    assert [got.get(i, 0) for i in range(10)] == counts.tolist()
    dens, _ = np.histogram(np.array(VALUES, dtype=float), bins=10, density=True)
    gotd = {r.bin: r.density for r in G.histogram(frame(spark), "x", bins=10, density=True).collect()}
    assert all(abs(gotd.get(i, 0.0) - round(d, 6)) < 1e-6 for i, d in enumerate(dens))


def test_quartiles_match_numpy(spark):
    x = np.array(VALUES, dtype=float)
    q1, q3 = np.percentile(x, [25, 75])
    r = G.spread_stats(frame(spark), "x").collect()[0]
    assert (r.q1, r.q3, r.iqr) == (round(q1, 6), round(q3, 6), round(q3 - q1, 6))
    assert abs(r.variance - round(x.var(ddof=1), 6)) < 1e-6
    b = G.box_stats(frame(spark), "x").collect()[0]
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    assert b.whisker_low == x[x >= lo].min() and b.whisker_high == x[x <= hi].max()


def test_sigma_band_matches_numpy(spark):
    x = np.array(VALUES, dtype=float)
    m, s = x.mean(), x.std(ddof=1)
    r = G.sigma_band(frame(spark), "x").collect()[0]
    assert r.inside == int(((x >= m - s) & (x <= m + s)).sum())
