"""Whitening of embeddings by an incremental eigendecomposition.

1. Entries become integers; every distinct integer vector enters the fit list
   once. Its count and sums per dimension are exact.
2. A partition folds its vectors one by one into the eigenvalues and
   eigenvectors of its scatter about its running mean: a centred rank-one
   update each. New eigenvalues are the roots of the secular equation
   ``1 + rho * sum(z_i^2 / (d_i - mu)) = 0``, all found together by rational
   interpolation within brackets; directions with a negligible ``z_i`` or (after a
   rotation) an equal neighbour are deflated. Eigenvectors come from the
   recomputed ``z``, so that they are orthogonal to machine precision.
3. Spectra of partitions are combined in a tree, ``FAN`` a task: each
   eigenpair of one is a rank-one update of the other, and one more update
   carries the difference of the means.
4. A last pass projects all centred vectors on the basis found and sums the
   products (Rayleigh-Ritz); the small eigenproblem of that matrix turns the
   basis to eigenvectors in double precision.

What meets in a task or reaches the driver is a basis and a few matrices of the
vectors' dimension, whatever the number of rows.

Null and edge cases: vectors that are null or hold null, non-finite or
(``LIMIT``) too large entries take no part; shorter vectors count as filled up
with zeros; a null ``vec_id`` stays null; repeated rows and ids give a set of
result rows each; equal eigenvalues give some orthonormal basis of their
space; components without variance cannot be whitened and are left out, so
one distinct vector gives no rows; ``deviation`` is null where it exceeds a
long; extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import written
from shoplake.llm.vectors import matrix, usable

FACTOR = 64.0
SHIFT = 1_000_000
COMPONENTS = 16
FAN = 8
#: Variance below this share of the largest eigenvalue is rounding.
RANK = 1e-13
EPS = np.finfo(float).eps
SPECTRUM = "part long, n long, sums array<string>, mean array<double>, lam array<double>, q array<double>"
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def secular_roots(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots ``mu`` of ``1 + sum(z2_i / (d_i - mu))`` for rising ``d``, and the matrix ``d_i - mu_j``.

    A root is kept as its distance from the nearer pole, so that small
    differences to the poles keep their digits.
    """
    k = len(d)
    top = z2.sum()
    if k == 1:
        return d + top, -np.array([[top]])
    up = np.append(d[1:], d[-1] + top)
    gap = up - d
    at_mid = 1 + z2 @ (1 / (d[:, None] - (d + gap / 2)))
    low = at_mid >= 0
    low[-1] = True
    origin = np.where(low, d, up)
    delta = d[:, None] - origin[None, :]
    # brackets as distances from the origin
    lo = np.where(low, 0.0, -gap / 2)
    hi = np.where(low, gap / 2, 0.0)
    lo[-1], hi[-1] = 0.0, top
    t = (lo + hi) / 2
    below = np.tri(k).T
    j = np.arange(k)
    nxt = np.minimum(j + 1, k - 1)
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        for _ in range(60):
            w = 1 / (delta - t)
            part = w * below  # poles up to a root's left one
            psi = z2 @ part
            f = 1 + z2 @ w
            size = f - 2 * psi  # 1 + sum of absolute terms
            lo = np.where(f < 0, t, lo)
            hi = np.where(f > 0, t, hi)
            live = (np.abs(f) > 4 * EPS * size) & (hi - lo > 2 * EPS * np.maximum(np.abs(lo), np.abs(hi)))
            if not live.any():
                break
            psi1 = z2 @ (part * part)
            phi1 = z2 @ (w * w) - psi1
            a1, a2 = 1 / w[j, j], 1 / w[nxt, j]
            c = f - a1 * psi1 - a2 * phi1
            a = c * (a1 + a2) + a1 * a1 * psi1 + a2 * a2 * phi1
            b = a1 * a2 * f
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            # the last root has one pole only
            step[-1] = a1[-1] + a1[-1] * a1[-1] * psi1[-1] / (f[-1] - a1[-1] * psi1[-1])
            new = t + step
            new = np.where(np.isfinite(new) & (new > lo) & (new < hi), new, (lo + hi) / 2)
            t = np.where(live, new, t)
    return origin + t, delta - t[None, :]


def rank_one(lam: np.ndarray, q: np.ndarray, v: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors of ``q diag(lam) q' + rho v v'``, ``rho >= 0``."""
    z = q.T @ v
    length = float(z @ z)
    rho = rho * length
    if not rho > EPS * EPS * max(abs(lam[-1]), EPS):
        return lam, q
    z = z / np.sqrt(length)
    tol = 4 * EPS * max(abs(lam[-1]), rho)
    z = np.where(rho * np.abs(z) <= tol, 0.0, z)
    act = np.flatnonzero(z)
    near = np.diff(lam[act]) * np.abs(z[act][1:] * z[act][:-1]) <= tol * (z[act][1:] ** 2 + z[act][:-1] ** 2)
    if near.any():  # rotate equal neighbours: all their share goes to one of them
        lam, q = lam.copy(), q.copy()
        for i, j in zip(act[:-1], act[1:]):
            r = np.hypot(z[i], z[j])
            c, s = z[j] / r, z[i] / r
            if (lam[j] - lam[i]) * abs(c * s) <= tol:
                z[i], z[j] = 0.0, r
                qi = q[:, i].copy()
                q[:, i], q[:, j] = c * qi - s * q[:, j], s * qi + c * q[:, j]
                lam[i], lam[j] = c * c * lam[i] + s * s * lam[j], s * s * lam[i] + c * c * lam[j]
        act = np.flatnonzero(z)
    d = lam[act]
    o = np.argsort(d, kind="stable")
    act, d = act[o], d[o]
    mu, far = secular_roots(d, rho * z[act] ** 2)
    k = len(d)
    if k > 1:  # the z that these roots belong to exactly
        poles = d[None, :] - d[:, None]
        np.fill_diagonal(poles, 1.0)
        own = np.sqrt(np.abs(np.prod(-far / poles, axis=1))) * np.sign(z[act])
    else:
        own = np.ones(1)
    u = own[:, None] / far
    u /= np.sqrt((u * u).sum(axis=0))
    turned = q[:, act] @ u
    if len(act) == len(lam):
        return mu, turned  # roots lie between the poles, so they rise
    lam, q = lam.copy(), q.copy()
    lam[act], q[:, act] = mu, turned
    o = np.argsort(lam, kind="stable")
    return lam[o], q[:, o]


@dataclass
class Spectrum:
    """Count, exact sums, mean, and eigenpairs of the scatter about the mean."""

    n: int
    sums: list[int]
    mean: np.ndarray
    lam: np.ndarray
    q: np.ndarray

    @classmethod
    def empty(cls, size: int) -> Spectrum:
        return cls(0, [0] * size, np.zeros(size), np.zeros(size), np.eye(size))

    def add(self, x: np.ndarray) -> None:
        """Folds in the rows of ``x`` (integers), one rank-one update each."""
        for row in x.astype(np.float64):
            self.n += 1
            away = row - self.mean
            if self.n > 1:
                self.lam, self.q = rank_one(self.lam, self.q, away, (self.n - 1) / self.n)
            self.mean = self.mean + away / self.n
        self.sums = [a + b for a, b in zip(self.sums, x.sum(axis=0).tolist())]

    def merge(self, other: Spectrum) -> None:
        for value, vector in zip(other.lam, other.q.T):
            if value > 0:
                self.lam, self.q = rank_one(self.lam, self.q, vector, float(value))
        n = self.n + other.n
        away = other.mean - self.mean
        self.lam, self.q = rank_one(self.lam, self.q, away, self.n * other.n / n)
        self.mean = self.mean + away * (other.n / n)
        self.n, self.sums = n, [a + b for a, b in zip(self.sums, other.sums)]

    def row(self, part: int) -> dict:
        return {"part": part, "n": self.n, "sums": [str(s) for s in self.sums], "mean": self.mean.tolist(), "lam": self.lam.tolist(), "q": self.q.ravel().tolist()}

    @classmethod
    def of(cls, row) -> Spectrum:
        lam = np.array(row.lam)
        return cls(int(row.n), [int(s) for s in row.sums], np.array(row.mean), lam, np.array(row.q).reshape(len(lam), len(lam)))


def spectrum_of(fit: DataFrame) -> Spectrum | None:
    """The spectrum of ``fit (x)``: one of each partition, combined in a tree."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for b in batches:
            x = matrix(b.column(0)) - SHIFT
            if len(x):
                own = own or Spectrum.empty(x.shape[1])
                own.add(x)
        if own:
            yield pa.RecordBatch.from_pylist([own.row(TaskContext.get().partitionId())], schema=KIND)

    def combine(key, rows: pd.DataFrame) -> pd.DataFrame:
        parts = [Spectrum.of(r) for r in rows.sort_values("part").itertuples()]
        for p in parts[1:]:
            parts[0].merge(p)
        return pd.DataFrame([parts[0].row(int(key[0]))])

    spectra = written(fit.mapInArrow(fold, SPECTRUM), "spectra")
    last = spectra.select(F.max("part")).first()[0]
    while last:
        spectra = written(spectra.groupBy(F.floor(F.col("part") / FAN).cast("bigint").alias("part")).applyInPandas(combine, SPECTRUM), "spectra")
        last //= FAN
    one = spectra.first()
    return Spectrum.of(one) if one else None


KIND = pa.schema([("part", pa.int64()), ("n", pa.int64()), ("sums", pa.list_(pa.string())), ("mean", pa.list_(pa.float64())), ("lam", pa.list_(pa.float64())), ("q", pa.list_(pa.float64()))])


@dataclass
class Centre:
    """Exact mean of the fit list: ``x - sums / n``, with the whole part taken off in integers."""

    n: int
    sums: list[int]  # of x - SHIFT

    def __post_init__(self):
        self.whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        self.rest = [s % self.n for s in self.sums]

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - SHIFT - self.whole) - np.array([r / self.n for r in self.rest])

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """``sum((n * x - S)^2)``, exact; null beyond a long."""
        off = x - SHIFT - self.whole
        most = (int(np.abs(off).max(initial=0)) + 1) * self.n
        kind = np.int64 if most * most * max(1, x.shape[1]) < 1 << 62 else object
        away = off.astype(kind) * self.n - np.array(self.rest, dtype=kind)
        out = (away * away).sum(axis=1)
        return [int(v) if v < 1 << 63 else None for v in out.tolist()]


def products(fit: DataFrame, centre: Centre, basis: np.ndarray) -> np.ndarray:
    """Sum over the fit list of the products of centred vectors projected on ``basis`` (columns)."""
    k = basis.shape[1]

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for b in batches:
            y = centre.centred(matrix(b.column(0))) @ basis
            total += y.T @ y
        yield pa.RecordBatch.from_pydict({"g": pa.array([total.ravel()], pa.list_(pa.float64()))})

    sums = fit.mapInArrow(gram, "g array<double>").select(F.posexplode("g").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v"))
    out = np.zeros(k * k)
    for r in sums.collect():  # one row per pair of directions
        out[r.i] = r.v
    return out.reshape(k, k)


@dataclass
class Whitening:
    centre: Centre
    vectors: np.ndarray  # unit columns, by falling eigenvalue
    values: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    @property
    def scaled(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def fit_whitening(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of ``rows (x)``, fitted on every distinct vector once."""
    fit = written(rows.select("x").distinct(), "whitening-fit")
    found = spectrum_of(fit)
    if found is None or not found.lam[-1] > 0:
        return None
    centre = Centre(found.n, found.sums)
    basis = np.linalg.qr(found.q[:, ::-1])[0]
    covariance = products(fit, centre, basis) / found.n
    values, turn = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1], (basis @ turn)[:, ::-1]
    some = int((values[:components] > RANK * values[0]).sum())
    out = Whitening(centre, vectors[:, :some], values[:some], values[:some] / np.trace(covariance))
    whitened = products(fit, centre, out.scaled) / found.n
    out.identity_error = float(np.abs(whitened - np.eye(some)).max())
    return out


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row per usable embedding and component, as ``RESULT``."""
    rows = written(usable(embeddings, FACTOR, SHIFT), "whitening-rows")
    model = fit_whitening(rows, components)
    if model is None:
        return embeddings.sparkSession.createDataFrame([], RESULT)
    k, scaled = len(model.values), model.scaled

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column(1))
            if not len(x):
                continue
            y = model.centre.centred(x) @ scaled
            each = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_pydict({
                "vec_id": b.column(0).take(pa.array(each)),
                "component": pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                "n": pa.array(np.full(len(each), model.centre.n), pa.int64()),
                "deviation": pa.array(model.centre.deviation(x), pa.int64()).take(pa.array(each)),
                "whitened": pa.array(y.ravel()),
                "explained": pa.array(np.tile(model.explained, len(x))),
                "identity_error": pa.array(np.full(len(each), model.identity_error)),
            })

    return rows.mapInArrow(project, RESULT)
