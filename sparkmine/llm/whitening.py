"""Embedding whitening by a bidiagonal qd solver.

Vectors become integers ``x = floor(64 * c) + 1000000``; the fit list holds every distinct one once. Each task reduces its
centred rows block by block to one triangular factor (QR), factors are reduced again in groups, and the last ones meet on
the driver: at most ``FACTORS`` matrices of dimensions x dimensions, whatever the number of vectors. There R is made
bidiagonal by Householder reflections, dqds finds all singular values to high relative accuracy, and twisted
factorisations give the directions of the leading components (close singular values share a subspace, which inverse
iteration with the same factorisation and a Rayleigh-Ritz step take apart). No covariance matrix is formed, so
small variances keep their digits.

Scale: the integer vectors are stored once in the shared folder; the fit list is one shuffle of them with map-side
distinct (a hot vector is one row per map task). Sums, factors and the check of the result are one row or matrix per task.

Edge cases: rows whose vector is NULL, empty, or holds a NULL or non-finite entry are dropped, and so are vectors shorter
than the longest one, which have no place in a common space. Entries saturate at +-2**40 after scaling. ``deviation``
is NULL where it does not fit a long. Only components with a positive variance (above rounding) exist: an empty table or
one with a single distinct vector gives no rows. Of components with equal variance any orthonormal choice is
right. Repeated rows are all returned. Columns other than ``vec_id`` and the vector are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.session import durable

SCALE, SHIFT, LARGEST = 64, 1_000_000, 2.0**40
FACTORS = 32  # triangular factors that are reduced by one task, and that the driver gets at most
BLOCK = 4096  # rows reduced at once
EPS = np.finfo(float).eps


@dataclass(frozen=True)
class Whitening:
    """The fitted directions: columns of ``directions`` are unit eigenvectors, by falling ``variances``."""

    n: int
    sums: list[int]
    trace: float
    variances: np.ndarray
    directions: np.ndarray

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates of integer rows."""
        return _centred(x, self.n, self.sums) @ (self.directions / np.sqrt(self.variances))


# --- small dense linear algebra -----------------------------------------------------------------------------------------


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and right factor V of ``r = U B V'`` by Householder reflections."""
    b, d = r.astype(float).copy(), r.shape[1]
    v = np.eye(d)
    for k in range(d):
        _reflect(b[k:, k:])
        if k + 2 < d:
            w = _reflect(b[k:, k + 1 :].T)
            if w is not None:
                v[:, k + 1 :] -= 2 * np.outer(v[:, k + 1 :] @ w, w)
    return np.diag(b).copy(), np.diag(b, 1).copy(), v


def _reflect(block: np.ndarray) -> np.ndarray | None:
    """Reflect the rows of ``block`` in place so that its first column keeps only its first entry; the unit normal."""
    w = block[:, 0].copy()
    scale = np.abs(w).max(initial=0.0)
    if scale == 0 or not np.any(w[1:]):
        return None
    w /= scale
    w[0] += math.copysign(np.linalg.norm(w), w[0])
    w /= np.linalg.norm(w)
    block -= 2 * np.outer(w, w @ block)
    block[1:, 0] = 0
    return w


def qd_values(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Squared singular values of a bidiagonal matrix, falling, by the differential qd algorithm with shifts."""
    q, e = diagonal.astype(float) ** 2, upper.astype(float) ** 2
    norm = max(q.max(initial=0.0), e.max(initial=0.0))
    if norm == 0:
        return np.zeros(len(q))
    # A zero on the diagonal would stop the recurrence; so small a value moves no singular value noticeably.
    q = np.maximum(q / norm, 1e-280)
    found, parts = [], [(q.tolist(), (e / norm).tolist(), 0.0)]
    while parts:
        found += _deflated(*parts.pop(), parts)
    return np.sort(np.maximum(found, 0.0))[::-1] * norm


def _deflated(q: list[float], e: list[float], total: float, parts: list) -> list[float]:
    """Values of one unreduced part; where it falls apart the pieces are put on ``parts``."""
    found, tiny = [], (EPS / 8) ** 2
    while q:
        if len(q) == 1:
            return [*found, q[0] + total]
        if e[-1] <= tiny * (total + q[-1]):
            found.append(q.pop() + total)
            e.pop()
            continue
        cut = next((k for k in range(len(e) - 2, -1, -1) if e[k] <= tiny * (total + min(q[k], q[k + 1]))), None)
        if cut is not None:
            parts.append((q[: cut + 1], e[:cut], total))
            q, e = q[cut + 1 :], e[cut + 1 :]
            continue
        if q[0] * 1.5 < q[-1]:  # small values belong at the end
            q, e = q[::-1], e[::-1]
        shift = 0.98 * _last_value(q[-2], e[-2] if len(e) > 1 else 0.0, q[-1], e[-1])
        while (step := _dqds(q, e, shift)) is None:
            shift = shift / 4 if shift > 1e-3 * q[-1] else 0.0
        q, e = step
        total += shift
    return found


def _last_value(q1: float, e1: float, q2: float, e2: float) -> float:
    """The smaller eigenvalue of the trailing 2 x 2 block of the qd array, a guess of the smallest of all."""
    a, b, c = q1 + e1, q1 * e2, q2 + e2
    root = math.sqrt(max(((a - c) / 2) ** 2 + b, 0.0))
    high = (a + c) / 2 + root
    return max(min((a * c - b) / high if high else 0.0, q2), 0.0)


def _dqds(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One transform of the qd array of B'B - shift; None if the shift passes the smallest value."""
    out_q, out_e, d = [], [], q[0] - shift
    for k, upper in enumerate(e):
        if d < 0:
            return None
        pivot = d + upper
        if pivot == 0:
            return None if shift else (_nudged(q), e)
        ratio = q[k + 1] / pivot
        out_q.append(pivot)
        out_e.append(upper * ratio)
        d = d * ratio - shift
    if d < 0 or not math.isfinite(d):
        return None
    return [*out_q, d], out_e


def _nudged(q: list[float]) -> list[float]:
    return [max(x, 1e-280) for x in q]


class Twisted:
    """Twisted factorisation of ``B'B - value``: stationary qd from the top, progressive qd from the bottom, met where the pivot is least."""

    def __init__(self, diagonal: np.ndarray, upper: np.ndarray, value: float):
        n, a2, b2 = len(diagonal), diagonal**2, upper**2
        least = EPS * EPS * (float(a2.max(initial=0.0) + b2.max(initial=0.0)) or 1.0)
        off = diagonal[:-1] * upper
        self.down, self.up, self.plus, self.minus = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
        s, p = np.full(n, -value), np.full(n, a2[-1] - value)
        for k in range(n - 1):
            self.plus[k] = _away(a2[k] + s[k], least)
            self.down[k] = off[k] / self.plus[k]
            s[k + 1] = b2[k] / self.plus[k] * s[k] - value
        for k in range(n - 2, -1, -1):
            self.minus[k + 1] = _away(b2[k] + p[k + 1], least)
            self.up[k] = off[k] / self.minus[k + 1]
            p[k] = a2[k] / self.minus[k + 1] * p[k + 1] - value
        pivots = s + p + value  # of a twist at every place
        self.twist = int(np.argmin(np.abs(pivots)))
        self.pivot = _away(float(pivots[self.twist]), least)

    def vector(self) -> np.ndarray:
        """The solution of ``N' z = e`` at the twist: the eigenvector if the value is well separated."""
        return self._back(np.eye(len(self.plus))[self.twist])

    def solve(self, b: np.ndarray) -> np.ndarray:
        y, r = b.astype(float).copy(), self.twist
        for k in range(r):
            y[k + 1] -= self.down[k] * y[k]
        for k in range(len(y) - 2, r - 1, -1):
            y[k] -= self.up[k] * y[k + 1]
        pivots = np.concatenate((self.plus[:r], [self.pivot], self.minus[r + 1 :]))
        return self._back(y / pivots)

    def _back(self, z: np.ndarray) -> np.ndarray:
        for k in range(self.twist - 1, -1, -1):
            z[k] -= self.down[k] * z[k + 1]
        for k in range(self.twist, len(z) - 1):
            z[k + 1] -= self.up[k] * z[k]
        return z / np.linalg.norm(z)


def _away(x: float, least: float) -> float:
    return x if abs(x) >= least else math.copysign(least, x)


def right_vectors(diagonal: np.ndarray, upper: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Orthonormal right singular vectors of the bidiagonal matrix for its leading squared singular ``values``."""
    n = len(diagonal)
    rows = np.zeros((n, n))
    np.fill_diagonal(rows, diagonal)
    rows[np.arange(n - 1), np.arange(1, n)] = upper
    out = np.zeros((n, len(values)))
    start = np.random.default_rng(7).normal(size=(n, len(values)))
    at = 0
    while at < len(values):
        to = at + 1
        while to < len(values) and values[to - 1] - values[to] <= 1e-3 * values[to - 1]:
            to += 1
        if to == at + 1:
            out[:, at] = Twisted(diagonal, upper, values[at]).vector()
        else:
            basis = start[:, at:to]
            shifted = [Twisted(diagonal, upper, value) for value in values[at:to]]
            for _ in range(4):
                basis = np.column_stack([t.solve(basis[:, i]) for i, t in enumerate(shifted)])
                basis = np.linalg.qr(basis - out[:, :at] @ (out[:, :at].T @ basis))[0]
            image = rows @ basis
            _, turn = np.linalg.eigh(image.T @ image)
            out[:, at:to] = basis @ turn[:, ::-1]
        at = to
    # Well separated vectors are orthogonal up to rounding already; this takes away what is left.
    clean, signs = np.linalg.qr(out)
    return clean * np.sign(np.diag(signs))


def leading(r: np.ndarray, n: int, components: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Variances and directions of the leading components of rows with the triangular factor ``r``, and the total variance."""
    diagonal, upper, v = bidiagonal(r)
    values = qd_values(diagonal, upper)
    floor = values.max(initial=0.0) * (len(diagonal) * EPS) ** 2 * 64
    kept = values[:components][values[:components] > floor]
    return kept / n, v @ right_vectors(diagonal, upper, kept), float((r * r).sum()) / n


# --- distributed part ---------------------------------------------------------------------------------------------------


def integer_vectors(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """``(vec_id, x)`` of the rows whose vectors are whole and finite and as long as the longest."""
    c = F.col(vector).cast("array<double>")
    whole = F.forall(c, lambda v: v.isNotNull() & (F.abs(v) < float("inf")))  # NaN is above infinity
    scaled = F.transform(c, lambda v: F.floor(F.least(F.greatest(v * SCALE, F.lit(-LARGEST)), F.lit(LARGEST))) + SHIFT)
    found = durable(rows.where(whole & (F.size(vector) > 0)).select(F.col("vec_id"), scaled.alias("x")))
    longest = found.agg(F.max(F.size("x"))).scalar()
    return found.where(F.size("x") == longest)


def _matrix(column: pa.Array) -> np.ndarray:
    rows = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``x - S / n``: both sides lose the same integer first, so the difference is exact but for the last division."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return (x - whole) - rest


def _factor(blocks) -> np.ndarray | None:
    """Triangular factor of all rows of some blocks, a bounded number of rows at a time."""
    r = None
    for block in blocks:
        for at in range(0, len(block), BLOCK):
            part = block[at : at + BLOCK]
            r = np.linalg.qr(part if r is None else np.vstack((r, part)), mode="r")
    return r


def _reduced(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """R of the centred fit list: a factor per task, then per group of factors, until few are left."""
    dim = len(sums)

    def rows_to_factor(batches):
        r = _factor(_centred(_matrix(b.column("x")), n, sums) for b in batches if b.num_rows)
        if r is not None:
            yield pa.RecordBatch.from_arrays([pa.array([r.ravel()])], ["r"])

    def factors_to_factor(batches):
        r = _factor(m.reshape(-1, dim) for b in batches for m in b.column("r").to_numpy(zero_copy_only=False))
        if r is not None:
            yield pa.RecordBatch.from_arrays([pa.array([r.ravel()])], ["r"])

    factors = durable(fit.select("x").mapInArrow(rows_to_factor, "r array<double>"))
    while (count := factors.count()) > FACTORS:
        factors = durable(factors.repartition(math.ceil(count / FACTORS)).mapInArrow(factors_to_factor, "r array<double>"))
    r = _factor(np.array(row["r"]).reshape(-1, dim) for row in factors.collect())
    return np.vstack((r, np.zeros((dim - len(r), dim))))  # fewer rows than dimensions


def fit_whitening(vectors: DataFrame, components: int = 16) -> tuple[Whitening | None, DataFrame]:
    """The whitening of :func:`integer_vectors`, or None without any variance, and the fit list ``x``."""
    fit = durable(vectors.select("x").distinct())
    totals = fit.select(F.posexplode("x").alias("place", "v")).groupBy("place").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("s"))
    totals = totals.orderBy("place").collect()  # one row per dimension
    if not totals:
        return None, fit
    n, sums = totals[0]["n"], [int(t["s"]) for t in totals]
    r = _reduced(fit, n, sums)
    variances, directions, trace = leading(r, n, components)
    if not len(variances):
        return None, fit
    return Whitening(n, sums, trace, variances, directions), fit


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    k = len(model.variances)

    def moments(batches):
        total, square = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                z = model.project(_matrix(batch.column("x").slice(at, BLOCK)))
                total += z.sum(axis=0)
                square += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate((total, square.ravel()))])], ["m"])

    parts = fit.select("x").mapInArrow(moments, "m array<double>").select(F.posexplode("m").alias("place", "v"))
    found = parts.groupBy("place").agg(F.sum("v").alias("v")).orderBy("place").collect()  # components * (components + 1) rows
    values = np.array([row["v"] for row in found]) / model.n
    mean, square = values[:k], values[k:].reshape(k, k)
    return float(np.abs(square - np.outer(mean, mean) - np.eye(k)).max())


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Sum of ``(n * x - S)**2`` per row, exact; NULL beyond a long."""
    s = np.array(sums, dtype=object)
    reach = max((abs(n * int(v) - t) for column, t in zip(x.T, sums) for v in (column.min(), column.max())), default=0)
    if len(sums) * reach * reach < 2**63:
        scaled = n * x - s.astype(np.int64)
        return pa.array((scaled * scaled).sum(axis=1), pa.int64())
    exact = ((n * x.astype(object) - s) ** 2).sum(axis=1)
    return pa.array([int(v) if v < 2**63 else None for v in exact], pa.int64())


def whiten(rows: DataFrame, vector: str = "embedding", components: int = 16) -> DataFrame:
    """Per vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``."""
    vectors = integer_vectors(rows, vector)
    model, fit = fit_whitening(vectors, components)
    kind = dict(rows.dtypes)["vec_id"]
    schema = f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double"
    if model is None:
        return vectors.sparkSession.createDataFrame([], f"{schema}, identity_error double")
    k, shares = len(model.variances), model.variances / model.trace

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                x = _matrix(part.column("x"))
                take = pa.array(np.repeat(np.arange(len(x)), k))
                columns = [
                    part.column("vec_id").take(take),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(x) * k, model.n)),
                    _deviations(x, model.n, model.sums).take(take),
                    pa.array(model.project(x).ravel()),
                    pa.array(np.tile(shares, len(x))),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained"])

    return vectors.select("vec_id", "x").mapInArrow(run, schema).withColumn("identity_error", F.lit(identity_error(fit, model)))
