"""Embedding whitening by pivoted Cholesky and one-sided Jacobi.

Vectors are put on an integer grid, ``x = floor(scale * c)``; the fit list has
every distinct ``x`` once. Spark sums the fit list and then its centred
scatter, one upper triangle a task, added up by cell. The driver, which holds
``d`` by ``d`` numbers and nothing that grows with the rows, factors the
covariance:

1. pivoted Cholesky, ``V[p, p] = L L'`` with ``L`` lower triangular, stopped at
   the numerical rank;
2. one-sided Jacobi directly on ``L``: columns are rotated in pairs until all
   are orthogonal, ``L J = U D``. So ``V = U D^2 U'``: squared column norms are
   the eigenvalues and normalised columns, their rows put back in the order
   before pivoting, the components.

A last pass over the fit list measures how far the covariance of the whitened
vectors is from the identity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlake.llm.common import staged
from fraudlake.llm.vectors import matrix

LARGEST = 2.0 ** 40  # entries of x from here on count as not finite: no long holds their squares
_EPS = np.finfo(float).eps


@dataclass
class Whitening:
    """``n`` fitted vectors with the integer ``sums`` per dimension; columns of
    ``components`` are unit eigenvectors of the covariance, by falling ``values``."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates of rows of ``x``."""
        centred = x - np.array(self.sums, float) / self.n
        return centred @ self.components / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int]:
        """Exact sums over dimensions of (n * x - sums) ** 2."""
        largest = int(np.abs(x).max(initial=0)) * self.n + max(map(abs, self.sums), default=0)
        kind = np.int64 if largest ** 2 * max(x.shape[1], 1) < 1 << 63 else object
        off = x.astype(kind) * self.n - np.array(self.sums, kind)
        return (off * off).sum(axis=1).tolist()


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(L, p) with ``a[p][:, p] = L L'``: L has as many columns as the numerical
    rank of the symmetric, positive semidefinite ``a``."""
    d = len(a)
    order, lower = np.arange(d), np.zeros((d, d))
    left = a.diagonal().astype(float).copy()
    least = d * _EPS * left.max(initial=0.0)
    for k in range(d):
        best = k + int(np.argmax(left[k:]))
        if left[best] <= least:
            return lower[:, :k], order
        for rows in (order, left, lower):
            rows[[k, best]] = rows[[best, k]]
        lower[k, k] = np.sqrt(left[k])
        rest = slice(k + 1, d)
        lower[rest, k] = (a[order[rest], order[k]] - lower[rest, :k] @ lower[k, :k]) / lower[k, k]
        left[rest] -= lower[rest, k] ** 2
    return lower, order


def orthogonal_columns(g: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """``g`` times a rotation that makes its columns orthogonal (one-sided Jacobi).

    A sweep meets every pair of columns once, in rounds of disjoint pairs (a
    round-robin), so a round is a few array operations. It ends when no pair
    in a sweep was farther from orthogonal than rounding.
    """
    g = g.copy()
    r = g.shape[1]
    seats = np.arange(r + r % 2)  # an odd number of columns: one of them sits out
    for _ in range(sweeps):
        worst = 0.0
        for _ in range(len(seats) - 1):
            half = len(seats) // 2
            i, j = seats[:half], seats[half:][::-1]
            i, j = i[(i < r) & (j < r)], j[(i < r) & (j < r)]
            a, b = g[:, i], g[:, j]
            aa, bb, ab = (a * a).sum(0), (b * b).sum(0), (a * b).sum(0)
            size = np.sqrt(aa * bb)
            off = np.divide(np.abs(ab), size, out=np.zeros_like(ab), where=size > 0)
            worst = max(worst, off.max(initial=0.0))
            turn = off > _EPS
            zeta = np.divide(bb - aa, 2 * ab, out=np.zeros_like(ab), where=turn)
            t = np.where(turn, np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1, zeta)), 0)
            c = 1 / np.hypot(1, t)
            g[:, i], g[:, j] = c * a - c * t * b, c * t * a + c * b
            seats = np.r_[seats[0], seats[-1], seats[1:-1]]
        if worst <= 4 * _EPS * max(len(g), 1):
            return g
    raise RuntimeError("Jacobi rotations did not settle")


def eigen(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, components) of the positive eigenvalues, falling; components are
    columns whose largest entry is positive."""
    lower, order = pivoted_cholesky(covariance)
    turned = orthogonal_columns(lower)
    norms = np.linalg.norm(turned, axis=0)
    rank = np.argsort(-norms, kind="stable")
    components = np.zeros_like(turned)
    components[order] = turned[:, rank] / norms[rank]
    peak = np.abs(components).argmax(0)
    sign = np.where(components[peak, np.arange(components.shape[1])] < 0, -1.0, 1.0)
    return norms[rank] ** 2, components * sign


def grid_rows(rows: DataFrame, scale: float = 256.0, id_col: str = "vec_id",
              vec_col: str = "embedding") -> DataFrame:
    """``vec_id`` and ``x`` (array<long>) of the rows that take part: the vector is
    not null and not empty and holds neither null nor non-finite entries, nor
    any so large that ``scale`` times it reaches 2 ** 40."""
    v = F.col("v")
    usable = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * scale) < LARGEST))
    return (rows.select(F.col(id_col).cast("long").alias("vec_id"),
                        F.col(vec_col).cast("array<double>").alias("v"))
            .filter(F.coalesce((F.size(v) > 0) & usable, F.lit(False)))
            .select("vec_id", F.transform(v, lambda c: F.floor(c * scale)).alias("x")))


def _sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total = None
    for batch in batches:
        x = _integers(batch["x"]).sum(axis=0)
        total = x.astype(object) if total is None else total + x
    if total is not None:
        yield pd.DataFrame({"i": np.arange(len(total)), "s": list(map(str, total))})


def _scatter(mean: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            y = matrix(batch["x"]) - mean
            total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pd.DataFrame({"i": i, "j": j, "v": total[i, j]})

    return run


def _integers(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), np.int64)


def fit(grid: DataFrame) -> tuple[Whitening | None, DataFrame]:
    """The whitening of ``grid`` (vec_id, x) and its staged fit list (x).

    Only vectors of the commonest length are fitted (of equally common ones, the
    longest). None if there is no vector. Driver: one number per dimension and
    one per pair of dimensions, whatever the rows.
    """
    sized = grid.select("x", F.size("x").alias("d"))
    d = sized.groupBy("d").count().orderBy(F.desc("count"), F.desc("d")).first()
    listed = staged(sized.filter(F.col("d") == (d["d"] if d else 0)).select("x").distinct(),
                    "whiten-fit")
    if d is None:
        return None, listed
    n = listed.count()
    sums = (listed.mapInPandas(_sums, "i int, s string").groupBy("i")
            .agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect())
    total = [int(r["s"]) for r in sorted(sums, key=lambda r: r["i"])]
    cells = (listed.mapInPandas(_scatter(np.array(total, float) / n), "i int, j int, v double")
             .groupBy("i", "j").agg(F.sum("v").alias("v")).collect())
    covariance = np.zeros((d["d"], d["d"]))
    for r in cells:
        covariance[r["i"], r["j"]] = covariance[r["j"], r["i"]] = r["v"] / n
    values, components = eigen(covariance)
    return Whitening(n, total, components, values, float(np.trace(covariance))), listed


def identity_error(listed: DataFrame, model: Whitening, k: int) -> float:
    """Largest absolute entry of the covariance of the first ``k`` whitened
    coordinates over the fit list, less the identity."""
    k = min(k, len(model.values))
    if not k:
        return 0.0

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(model.project(matrix(batch["x"]))[:, :k],
                               columns=[f"w{c}" for c in range(k)])

    whitened = listed.mapInPandas(run, ", ".join(f"w{c} double" for c in range(k)))
    pairs = [(a, b) for a in range(k) for b in range(a, k)]
    got = whitened.agg(*[F.covar_pop(f"w{a}", f"w{b}").alias(f"c{a}_{b}") for a, b in pairs]).first()
    return max(abs(got[f"c{a}_{b}"] - (a == b)) for a, b in pairs)


def whiten(rows: DataFrame, components: int = 4, scale: float = 256.0, id_col: str = "vec_id",
           vec_col: str = "embedding") -> DataFrame:
    """One row per vector and component: vec_id, component (from 1), n, deviation,
    whitened, explained, identity_error.

    Rows whose vector is null, empty, or holds null, non-finite or overlarge
    entries (:func:`grid_rows`) are dropped, and so are vectors of another length
    than the commonest. Zero vectors take part. Repeated rows and equal vectors
    each get their rows but count once in the fit. Null ids stay. Components
    with no variance are not returned, so a table with a single distinct vector,
    like an empty table, gives an empty result. A deviation that no long holds
    is null. Only the two columns are read.
    """
    grid = grid_rows(rows, scale, id_col, vec_col)
    model, listed = fit(grid)
    schema = ("vec_id long, component int, n long, deviation long, whitened double, "
              "explained double, identity_error double")
    if model is None or not len(model.values):
        return rows.sparkSession.createDataFrame([], schema)
    k = min(components, len(model.values))
    error = identity_error(listed, model, k)
    share = model.values[:k] / model.trace

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            x = _integers(batch["x"])
            off = [v if v < 1 << 63 else None for v in model.deviations(x)]
            m = len(batch)
            yield pd.DataFrame({
                "vec_id": batch["vec_id"].astype("Int64").repeat(k).reset_index(drop=True),
                "component": np.tile(np.arange(1, k + 1, dtype=np.int32), m),
                "n": np.full(m * k, model.n),
                "deviation": pd.array(np.repeat(np.array(off, object), k), dtype="Int64"),
                "whitened": model.project(x)[:, :k].ravel(),
                "explained": np.tile(share, m), "identity_error": np.full(m * k, error)})

    own = grid.filter(F.size("x") == len(model.sums))
    return own.mapInPandas(run, schema)
