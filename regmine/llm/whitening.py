"""Embedding whitening by Chebyshev-filtered subspace iteration (operator 11).

Components become integers x = floor(scale * c).  The fit list is every distinct
x once, written as a shared table.  Its covariance V (divisor n) is never formed:
a pass multiplies it with a thin block, V Q = sum of xc'(xc Q) / n over the
centred rows xc = x - mean, each task adding up its own part; tasks' sums meet in
a second, smaller step before the driver adds the last few.

A round filters the block with a Chebyshev polynomial of V that is small on
[0, b], b the block's lowest Ritz value but one, and grows fast above it (one pass a degree),
then orthonormalises by QR and solves the projected problem (Rayleigh-Ritz).
One guard column starts anew from a random direction in every round, so that a
direction the start has missed comes in.  A component is certified when its
residual |V q - e q| is at rounding level: at most ``TOLERANCE`` of the largest
eigenvalue and no longer falling.  After ``ROUNDS`` rounds without that (hardly
separated spectra) the block is doubled; as wide as the space it is exact.

Rows with a null vector or a null or non-finite entry are dropped; rows with a
null id stay.  Vectors of different lengths are different spaces, each whitened
by itself (one set of passes a length).  Equal and repeated rows count once in
the fit and each get their own result.  Components without variance (beyond the
rank, or a single distinct vector) give no rows; neither do empty tables or
empty vectors.  Scaled components beyond 2^52 are clipped; ``deviation`` is null
where it exceeds 64 bits.  Other columns, of whatever name, are left behind.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regmine.llm.common import write_shared
from regmine.llm.vectors import by_length, integer_vectors

GUARD = 5                    # block columns per wanted component, less the wanted one
DEGREE = 12                  # highest degree of a round's polynomial
GROWTH = 25.0                # most a round amplifies, as a power of e: QR keeps the rest
TOLERANCE = 1e-11            # residual of a certified component, against the largest eigenvalue
ROUNDS = 12                  # rounds before the block is doubled
DIRECT = 32                  # task sums that go to the driver without a step between
ROWS = 4096                  # rows multiplied at a time


@dataclass
class Whitening:
    """Of one vector length: rows fitted, exact sums, unit eigenvectors as
    columns, their eigenvalues, trace of V, identity error of the result."""
    n: int
    sums: list
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float
    rounds: int

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def _exact_sums(fit: DataFrame) -> dict:
    """{length: (n, exact sum per dimension)} in one pass, added up by Spark."""
    def run(batches):
        total: dict = {}
        for b in batches:
            for d, at, x in by_length(b.column(0)):
                if d:
                    n, s = total.get(d, (0, [0] * d))
                    wide = float(np.abs(x).max()) * len(x) >= 2.0 ** 62
                    s = [u + int(v) for u, v in zip(s, (x.astype(object) if wide else x).sum(axis=0))]
                    total[d] = (n + len(x), s)
        for d, (n, s) in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()),
                 pa.array([str(v) for v in s])], names=["d", "j", "n", "s"])

    got = (fit.mapInArrow(run, "d int, j int, n bigint, s string").groupBy("d", "j")
           .agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect())
    out: dict = {}
    for r in sorted(got, key=lambda r: (r["d"], r["j"])):
        out.setdefault(r["d"], (r["n"], []))[1].append(int(r["s"]))
    return out


def _summed(rows: DataFrame, work, size: int) -> np.ndarray:
    """Sum of ``work(matrix)`` (``size`` doubles) over blocks of the rows'
    vectors: one partial sum a task, met in about the root of their number."""
    def each(batches):
        total, any_row = np.zeros(size), False
        for b in batches:
            for d, _, x in by_length(b.column(0)):
                for i in range(0, len(x), ROWS):
                    total += work(x[i:i + ROWS].astype(np.float64))
                    any_row = True
        if any_row:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sum"])

    def meet(batches):
        total, any_row = np.zeros(size), False
        for b in batches:
            for raw in b.column(0).to_pylist():
                total += np.frombuffer(raw)
                any_row = True
        if any_row:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sum"])

    parts = rows.rdd.getNumPartitions()
    sums = rows.mapInArrow(each, "sum binary")
    if parts > DIRECT:
        sums = sums.repartition(math.isqrt(parts)).mapInArrow(meet, "sum binary")
    return np.sum([np.frombuffer(r["sum"]) for r in sums.collect()] or [np.zeros(size)], axis=0)


class Covariance:
    """V of the fit list's vectors of one length, as passes over them."""

    def __init__(self, fit: DataFrame, d: int, n: int, sums: list):
        self.rows, self.d, self.n = fit.where(F.size("x") == d), d, n
        self.mean = np.array([s / n for s in sums])
        self.trace = None

    def times(self, q: np.ndarray) -> np.ndarray:
        """V q by one pass, which also adds up the trace."""
        mean, k = self.mean, q.shape[1]

        def work(x):
            x = x - mean
            return np.append(x.T @ (x @ q), (x * x).sum())

        got = _summed(self.rows, work, self.d * k + 1)
        self.trace = got[-1] / self.n
        return got[:-1].reshape(self.d, k) / self.n

    def identity_error(self, comps: np.ndarray, values: np.ndarray) -> float:
        """Largest entry of |covariance of the whitened fit list - identity|."""
        mean, k, to = self.mean, len(values), comps / np.sqrt(values)

        def work(x):
            w = (x - mean) @ to
            return np.append((w.T @ w).ravel(), w.sum(axis=0))

        got = _summed(self.rows, work, k * k + k) / self.n
        cov = got[:k * k].reshape(k, k) - np.outer(got[k * k:], got[k * k:])
        return float(np.abs(cov - np.eye(k)).max())


def _filtered(cov, q, vq, low: float, top: float, degree: int) -> np.ndarray:
    """A polynomial of V times q: at most 1 in size on [0, low] before scaling,
    scaled to about 1 at ``top``.  vq = V q spares the first pass."""
    half = low / 2                                   # middle and half width of [0, low]
    sigma = first = half / (top - half)
    before, now = q, (vq - half * q) * (sigma / half)
    for _ in range(degree - 1):
        after_sigma = 1 / (2 / first - sigma)
        step = 2 * after_sigma / half * (cov.times(now) - half * now) - sigma * after_sigma * before
        before, now, sigma = now, step, after_sigma
    return now


def leading_components(cov, k: int, seed: int = 7):
    """(unit eigenvectors as columns, eigenvalues, rounds): the k largest of
    ``cov`` (d, times(q)), falling, certified as the module says."""
    d, rng = cov.d, np.random.default_rng(seed)
    k = min(k, d)
    width, rounds, last = min(d, (GUARD + 1) * k), 0, np.inf
    q = np.eye(d) if width == d else np.linalg.qr(rng.standard_normal((d, width)))[0]
    since = 0
    while True:
        vq = cov.times(q)
        values, turn = np.linalg.eigh((q.T @ vq + vq.T @ q) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq, rounds, since = q @ turn, vq @ turn, rounds + 1, since + 1
        worst = float(np.linalg.norm(vq[:, :k] - q[:, :k] * values[:k], axis=0).max())
        top = max(float(values[0]), 0.0)
        if q.shape[1] == d or worst <= TOLERANCE * top and worst > last / 2 or top == 0.0:
            return q[:, :k], np.maximum(values[:k], 0), rounds
        last = worst
        if since >= ROUNDS:                          # hardly separated: a wider block
            more = min(d, 2 * q.shape[1])
            q = np.eye(d) if more == d else np.linalg.qr(
                np.hstack([q, rng.standard_normal((d, more - q.shape[1]))]))[0]
            since, last = 0, np.inf
            continue
        low = float(values[-2])
        if low <= 1e-10 * top:                       # the block already spans what V has
            y = vq
        else:
            grow = math.acosh(max(2 * top / low - 1, 1 + 1e-9))
            y = _filtered(cov, q, vq, low, top, max(2, min(DEGREE, int(GROWTH / grow))))
        q = np.linalg.qr(np.hstack([y[:, :-1], rng.standard_normal((d, 1))]))[0]


def fit_whitening(rows: DataFrame, k: int) -> dict:
    """{vector length: Whitening} of (x array<bigint>) rows; lengths whose
    vectors do not vary have no components."""
    fit = write_shared(rows.select("x").distinct(), "whitening-fit")
    out = {}
    for d, (n, sums) in _exact_sums(fit).items():
        cov = Covariance(fit, d, n, sums)
        comps, values, rounds = leading_components(cov, k)
        kept = values > values[0] * d * 1e-14 if values[0] > 0 else np.zeros(len(values), bool)
        comps, values = comps[:, kept], values[kept]
        error = cov.identity_error(comps, values) if kept.any() else 0.0
        out[d] = Whitening(n, sums, comps, values, cov.trace, error, rounds)
    return out


def _deviation(x: np.ndarray, n: int, sums: list) -> list:
    """Exact sum over dimensions of (n * x - S)^2 per row; null beyond 64 bits."""
    most = n * float(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    if most * most * max(1, x.shape[1]) < 2.0 ** 62:
        off = x * n - np.array(sums, dtype=np.int64)
        return (off * off).sum(axis=1).tolist()
    got = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
    return [v if v < 2 ** 63 else None for v in got]


def whiten(vectors: DataFrame, k: int = 4, scale: float = 256.0, id_col: str = "vec_id",
           vec_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error):
    a row for each row with a finite vector and each of the first k components."""
    rows = integer_vectors(vectors, id_col, vec_col, scale)
    models = fit_whitening(rows, k)
    kind = rows.schema["vec_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            for d, at, x in by_length(b.column(1)):
                m = models.get(d)
                if m is None or not len(m.eigenvalues):
                    continue
                c, size = len(m.eigenvalues), len(at)
                ids = b.column(0).take(pa.array(np.repeat(at, c)))
                w = (x.astype(np.float64) - m.mean) @ m.components / np.sqrt(m.eigenvalues)
                dev = [v for v in _deviation(x, m.n, m.sums) for _ in range(c)]
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.tile(np.arange(1, c + 1), size), pa.int32()),
                     pa.array(np.full(size * c, m.n), pa.int64()), pa.array(dev, pa.int64()),
                     pa.array(w.ravel()), pa.array(np.tile(m.eigenvalues / m.trace, size)),
                     pa.array(np.full(size * c, m.identity_error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("vec_id", "x").mapInArrow(
        run, f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, "
             "identity_error double")
